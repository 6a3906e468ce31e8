"""Kinship random effects, saddlepoint tails and the subset sweep against dense and brute-force versions."""

import math

import numpy as np
import pytest
from conftest import genotype_frames, random_genotypes

from genolith.operators import mixed


def reml(y, x, k, d=None):
    """Dense REML variances by Newton steps with numerical care: (tau, sigma); ``d`` fixes the residual variances."""
    n, p = x.shape

    def negative(tau, sigma):
        v = tau * k + (sigma * np.eye(n) if d is None else np.diag(d))
        vi = np.linalg.inv(v)
        xvx = x.T @ vi @ x
        pm = vi - vi @ x @ np.linalg.solve(xvx, x.T @ vi)
        return pm, vi

    tau, sigma = np.var(y) / 2, np.var(y) / 2 if d is None else 1.0
    for _ in range(500):
        pm, _ = negative(tau, sigma)
        py = pm @ y
        s = 0.5 * np.array([py @ k @ py - np.trace(pm @ k), py @ py - np.trace(pm)])
        ai = 0.5 * np.array([[py @ k @ pm @ k @ py, py @ k @ pm @ py], [py @ k @ pm @ py, py @ pm @ py]])
        use = [0, 1] if d is None else [0]
        step = np.zeros(2)
        step[use] = np.linalg.solve(ai[np.ix_(use, use)], s[use])
        t, g = tau + step[0], sigma + step[1]
        t = tau / 2 if t <= 0 else t
        g = sigma / 2 if g <= 0 else g
        if abs(t - tau) + abs(g - sigma) < 1e-13 * (tau + sigma):
            break
        tau, sigma = t, g
    return tau, sigma


def pql(y, x, k):
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        mu = 1 / (1 + np.exp(-x @ beta))
        w = mu * (1 - mu)
        beta = beta + np.linalg.solve((x * w[:, None]).T @ x, x.T @ (y - mu))
    eta, tau = x @ beta, 0.5
    for _ in range(200):
        mu = 1 / (1 + np.exp(-eta))
        w = mu * (1 - mu)
        work = eta + (y - mu) / w
        new, _ = reml(work, x, k, 1 / w)
        v = new * k + np.diag(1 / w)
        vi = np.linalg.inv(v)
        b = np.linalg.solve(x.T @ vi @ x, x.T @ vi @ work)
        eta = x @ b + new * k @ vi @ (work - x @ b)
        if abs(new - tau) < 1e-12:
            break
        tau = new
    return tau, b


def grm(g):
    mean = np.nanmean(g, axis=1, keepdims=True)
    keep = ((mean > 0) & (mean < 2)).ravel()
    z = np.where(np.isnan(g), 0, (g - mean) / np.sqrt(np.maximum(mean * (1 - mean / 2), 1e-12)))[keep]
    return z.T @ z / keep.sum()


@pytest.fixture(scope="module")
def cohort(spark):
    """100 subjects with heritable traits."""
    g = random_genotypes(150, 100, seed=5)
    k = grm(g)
    rng = np.random.default_rng(8)
    x1, x2 = rng.normal(size=100), rng.integers(0, 2, 100).astype(float)
    u = np.linalg.cholesky(k + 1e-8 * np.eye(100)) @ rng.normal(size=100)
    y = 1 + 0.5 * x1 + 1.2 * u + rng.normal(size=100)
    values, vectors = np.linalg.eigh(k)
    liable = vectors[:, -8:] @ (np.sqrt(values[-8:]) * rng.normal(size=8))  # along the largest eigenvectors, where a yes/no trait tells the variance
    b = (rng.uniform(size=100) < 1 / (1 + np.exp(-(0.3 * x1 + 4 * liable)))).astype(float)
    frames = genotype_frames(spark, g)
    data = spark.createDataFrame([(i, float(y[i]), float(b[i]), float(x1[i]), float(x2[i])) for i in range(100)], "sample_key bigint, y double, b double, x1 double, x2 double").cache()
    return g, k, y, b, np.column_stack([np.ones(100), x1, x2]), data, frames


def test_products_are_those_of_the_matrix(cohort):
    g, k, _, _, _, _, (_, _, entries) = cohort
    rel = mixed.Relationship.of(entries, np.arange(100))
    b = np.random.default_rng(0).normal(size=(100, 7))
    assert rel.n_variants == 150 and np.allclose(rel.times(b), k @ b)
    for n_probes in (100, 4):
        found, back = rel.spectrum(np.ones(100), b, 2.0, n_probes)
        solved = back(found.coordinates / (2.0 * found.values + 1)[:, None])
        assert np.allclose(solved, np.linalg.solve(2.0 * k + np.eye(100), b), atol=1e-6)


@pytest.mark.parametrize("outcome", ["y", "b"])
def test_variances_equal_a_dense_solution(cohort, outcome):
    _, k, y, b, x, data, (_, _, entries) = cohort
    built = []

    def relationship(keys):
        built.append(mixed.Relationship.of(entries, keys))
        return built[-1]

    sets = {"both": ["x1", "x2"], "one": ["x1"]} if outcome == "y" else {"both": ["x1", "x2"]}
    fits = mixed.fit_mixed_models(data, outcome, sets, relationship, n_probes=100)
    for fit, columns in zip(fits, ([0, 1, 2], [0, 1])):
        design = x[:, columns]
        if outcome == "y":
            tau, sigma = reml(y, design, k)
            v = tau * k + sigma * np.eye(100)
            work = y
        else:
            tau, beta = pql(b, design, k)
            sigma, work = 1.0, None
            assert np.allclose(fit.coefficients, beta, rtol=1e-4, atol=1e-6)
        assert fit.converged and tau > 0.05 and fit.tau == pytest.approx(tau, rel=1e-4) and fit.sigma == pytest.approx(sigma, rel=1e-4)
        if work is not None:
            vi = np.linalg.inv(v)
            beta = np.linalg.solve(design.T @ vi @ design, design.T @ vi @ work)
            r = work - design @ beta
            assert np.allclose(fit.coefficients, beta, rtol=1e-4, atol=1e-6) and np.allclose(fit.residual, vi @ r, rtol=1e-3, atol=1e-5)
            aic = 100 * math.log(2 * math.pi) + np.linalg.slogdet(v)[1] + r @ vi @ r + 2 * (len(columns) + 2)
            assert fit.aic == pytest.approx(aic, rel=1e-6)
    assert len(built) == 1
    table = mixed.mixed_table(data.sparkSession, fits).collect()
    assert [r["model"] for r in table] == list(sets) and all(r["error"] is None for r in table)


def test_few_probes_come_close(cohort):
    _, k, y, _, x, data, (_, _, entries) = cohort
    tau, sigma = reml(y, x, k)
    fit = mixed.fit_mixed_models(data, "y", {"m": ["x1", "x2"]}, lambda keys: mixed.Relationship.of(entries, keys), n_probes=25)[0]
    assert fit.converged and fit.tau == pytest.approx(tau, rel=0.25) and fit.sigma == pytest.approx(sigma, rel=0.25)


def test_a_trait_without_kinship_ends_at_zero(cohort):
    _, k, _, _, x, data, (_, _, entries) = cohort
    vectors = np.linalg.eigh(k)[1]
    # Along the smallest eigenvectors only: less alike among relatives than by chance.
    y = vectors[:, :30] @ np.random.default_rng(1).normal(size=30) * 5
    rows = data.sparkSession.createDataFrame([(i, float(y[i]), float(x[i, 1])) for i in range(100)], "sample_key bigint, y double, x1 double")
    fit = mixed.fit_mixed_models(rows, "y", {"m": ["x1"], "twice": ["x1", "x1"]}, lambda keys: mixed.Relationship.of(entries, keys), n_probes=100)
    beta, *_ = np.linalg.lstsq(x[:, :2], y, rcond=None)
    assert fit[0].converged and fit[0].tau == 0 and fit[0].sigma == pytest.approx(((y - x[:, :2] @ beta) ** 2).sum() / 98, rel=1e-6)


def test_missing_values_and_singular_sets(cohort):
    _, _, _, _, _, data, (_, _, entries) = cohort
    rows = data.selectExpr("sample_key", "CASE WHEN sample_key <> 3 THEN y END AS y", "CASE WHEN sample_key % 10 <> 1 THEN x1 END AS x1", "x2", "x2 * 2 AS x3",
                           "CASE WHEN x2 > 0 THEN 'one' ELSE 'two' END AS kind")
    fits = mixed.fit_mixed_models(rows, "y", {"a": ["x1"], "b": ["x2", "x3"], "c": ["kind"]}, lambda keys: mixed.Relationship.of(entries, keys), n_probes=100)
    assert [f.n for f in fits] == [89, 89, 89] and fits[1].error == "singular" and fits[0].converged and fits[2].columns == ["(intercept)", "kind=two"]


def families(n=90, seed=2):
    """Sparse kinship of families of 1 to 6 and one chain of 12: (triplets, inbreeding, dense)."""
    rng = np.random.default_rng(seed)
    dense, pairs, at = np.eye(n), [], 0
    while at < n:
        size = 12 if at == 0 else min(int(rng.integers(1, 7)), n - at)
        for i in range(at, at + size):
            for j in range(i + 1, at + size):
                if size < 12 or j == i + 1:
                    pairs.append((j, i, 0.25) if rng.random() < 0.5 else (i, j, 0.25))
                    dense[i, j] = dense[j, i] = 0.5
                else:
                    pairs.append((i, j, 0.01))
        at += size
    selves = [(i, float(rng.uniform(-0.05, 0.1))) for i in range(0, n, 2)]
    for i, f in selves:
        dense[i, i] = 1 + f
    return pairs, selves, dense + 0.0


@pytest.fixture(scope="module")
def sparse(spark):
    pairs, selves, dense = families()
    frames = spark.createDataFrame(pairs, "id1 bigint, id2 bigint, kin double"), spark.createDataFrame(selves, "id bigint, f double")
    return {most: mixed.SparseKinship.of(*frames, np.arange(90), 0.05, most_members=most) for most in (2000, 5)}, dense, frames


@pytest.mark.parametrize("most", [2000, 5])
def test_sparse_solves_and_determinants(sparse, most):
    kinship, dense = sparse[0][most], sparse[1]
    rng = np.random.default_rng(1)
    b, d = rng.normal(size=(90, 3)), rng.uniform(0.5, 2, 90)
    assert (len(kinship.large_members) > 0) == (most == 5) and np.allclose(kinship.times(b), dense @ b)
    got, log_determinant = kinship.solve(0.7, d, b)
    whole = 0.7 * dense + np.diag(d)
    assert np.allclose(got, np.linalg.solve(whole, b), atol=1e-7) and log_determinant == pytest.approx(np.linalg.slogdet(whole)[1], abs=1e-6)
    root = 1 / np.sqrt(d)
    found, back = kinship.spectrum(root, root[:, None] * b, 0.7, 90)
    assert np.allclose(root[:, None] * back(found.coordinates / (0.7 * found.values + 1)[:, None]), got, atol=1e-7)
    scaled = root[:, None] * dense * root
    assert (found.weights * np.log1p(0.7 * found.values)).sum() == pytest.approx(np.linalg.slogdet(0.7 * scaled + np.eye(90))[1], abs=1e-6)


def test_sparse_model_equals_a_dense_one(spark, sparse):
    kinships, dense, frames = sparse
    rng = np.random.default_rng(3)
    values, vectors = np.linalg.eigh(dense)
    u = vectors @ (np.sqrt(np.maximum(values, 0)) * rng.normal(size=90))
    x1 = rng.normal(size=90)
    y, b = x1 + 1.5 * u + rng.normal(size=90), (rng.uniform(size=90) < 1 / (1 + np.exp(-2.5 * u))).astype(float)
    x = np.column_stack([np.ones(90), x1])
    data = spark.createDataFrame([(i, float(y[i]), float(b[i]), float(x1[i])) for i in range(90)], "sample_key bigint, y double, b double, x1 double")
    for outcome, (tau, sigma) in {"y": reml(y, x, dense), "b": (pql(b, x, dense)[0], 1.0)}.items():
        fit = mixed.fit_mixed_models(data, outcome, {"m": ["x1"]}, lambda keys: mixed.SparseKinship.of(*frames, keys, 0.05))[0]
        assert fit.converged and fit.tau == pytest.approx(tau, rel=1e-4, abs=1e-6) and fit.sigma == pytest.approx(sigma, rel=1e-4)


def test_mixed_score_test(cohort):
    g, k, y, _, x, data, (_, _, entries) = cohort
    rel = {}

    def relationship(keys):
        return rel.setdefault("k", mixed.Relationship.of(entries, keys))

    fit = mixed.fit_mixed_models(data, "y", {"m": ["x1", "x2"]}, relationship, n_probes=100)[0]
    got = {r["variant_key"]: r for r in mixed.mixed_score_test(entries, fit, rel["k"], 150).collect()}
    vi = np.linalg.inv(fit.tau * k + fit.sigma * np.eye(100))
    pm = vi - vi @ x @ np.linalg.solve(x.T @ vi @ x, x.T @ vi)
    filled = np.where(np.isnan(g), np.nanmean(g, axis=1, keepdims=True), g)
    score, exact = filled @ pm @ y, np.einsum("ij,jk,ik->i", filled, pm, filled)
    assert all(got[i]["score"] == pytest.approx(score[i], abs=1e-6) for i in range(150))
    # One ratio stands for all variants.
    stat = np.array([got[i]["score_stat"] for i in range(150)])
    assert np.corrcoef(stat, score / np.sqrt(exact))[0, 1] > 0.99 and np.median(np.abs(stat * np.sqrt(exact) / score - 1)) < 0.15


# ------------------------------------------------------------- saddlepoint


def logistic(x, y):
    beta = np.zeros(x.shape[1])
    for _ in range(60):
        mu = 1 / (1 + np.exp(-x @ beta))
        beta = beta + np.linalg.solve((x * (mu * (1 - mu))[:, None]).T @ x, x.T @ (y - mu))
    return 1 / (1 + np.exp(-x @ beta))


def whole_saddlepoint(s, g, mu):
    """Lugannani-Rice on both sides over all subjects, the root by bisection."""
    total = 0.0
    for target in (abs(s), -abs(s)):
        k = lambda t: np.log(1 - mu + mu * np.exp(t * g)).sum() - t * (g * mu).sum()
        slope = lambda t: (g * mu * np.exp(t * g) / (1 - mu + mu * np.exp(t * g))).sum() - (g * mu).sum()
        low, high = -200 / np.abs(g).max(), 200 / np.abs(g).max()
        for _ in range(300):
            mid = (low + high) / 2
            low, high = (mid, high) if slope(mid) < target else (low, mid)
        if abs(slope(mid) - target) > 1e-6 * abs(target):
            continue
        tilted = mu * np.exp(mid * g) / (1 - mu + mu * np.exp(mid * g))
        w = np.sign(mid) * math.sqrt(2 * (mid * target - k(mid)))
        v = mid * math.sqrt((g * g * tilted * (1 - tilted)).sum())
        total += 0.5 * math.erfc(abs(w + math.log(v / w) / w) / math.sqrt(2))
    return total


def exact_tail(s, g, mu):
    """P(|sum of g (y - mu)| >= |s|), by enumerating all outcomes of the subjects with each (g, mu)."""
    sums = {0.0: 1.0}
    for (value, m), n in __import__("collections").Counter(zip(g.round(12).tolist(), mu.round(12).tolist())).items():
        grown = {}
        for total, chance in sums.items():
            for hits in range(n + 1):
                c = chance * math.comb(n, hits) * m**hits * (1 - m) ** (n - hits)
                if c > 1e-18:
                    key = round(total + value * (hits - n * m), 9)
                    grown[key] = grown.get(key, 0.0) + c
        sums = grown
    return sum(c for t, c in sums.items() if abs(t) >= abs(s) - 1e-7)


@pytest.fixture(scope="module")
def rare_trait(spark):
    """20 cases among 200 subjects; rare variants that some of them carry."""
    from genolith.operators import association, models

    rng = np.random.default_rng(4)
    n, m = 200, 60
    case = np.zeros(n)
    case[:20] = 1
    freq = np.where(np.arange(m) % 3 == 0, 0.97, 0.03)
    g = rng.binomial(2, freq[:, None], (m, n)).astype(float)
    for v in range(0, m, 2):  # carriers among the cases
        g[v, rng.choice(20, 5, replace=False)] = 1 if freq[v] < 0.5 else 1
    g[rng.uniform(size=g.shape) < 0.02] = np.nan
    x1 = rng.normal(size=n) + 0.5 * case
    data = spark.createDataFrame([(i, float(case[i]), float(x1[i])) for i in range(n)], "sample_key bigint, b double, x1 double").cache()
    out = {}
    for name, covariates in (("plain", []), ("adjusted", ["x1"])):
        fit = models.fit_models(data, "b", {"m": covariates}, "binomial")[0]
        out[name] = association.score_model(data, "b", fit), np.column_stack([np.ones(n), x1][: 1 + len(covariates)])
    return g, case, genotype_frames(spark, g)[2], out


@pytest.mark.parametrize("name", ["plain", "adjusted"])
def test_saddlepoint_equals_the_one_over_all_subjects(rare_trait, name):
    from genolith.operators import saddlepoint

    g, case, entries, models = rare_trait
    model, x = models[name]
    held = {r["sample_key"]: r["outcome"] - r["resid"] for r in model.table.collect()}
    mu = np.array([held[i] for i in range(200)])
    assert np.allclose(mu, logistic(x, case), atol=1e-5)
    w = mu * (1 - mu)
    filled = np.where(np.isnan(g), np.nanmean(g, axis=1, keepdims=True), g)
    adjusted = filled - (filled * w) @ x @ np.linalg.inv((x * w[:, None]).T @ x) @ x.T
    score, variance = filled @ (case - mu), (adjusted**2 * w).sum(1)
    got = {r["variant_key"]: r for r in saddlepoint.saddlepoint_test(entries, model).collect()}
    corrected = 0
    for v in range(len(g)):
        r = got[v]
        assert r["score"] == pytest.approx(score[v], abs=1e-5) and r["score_var"] == pytest.approx(variance[v], rel=1e-5)
        if abs(score[v]) < 2 * math.sqrt(variance[v]) * (1 - 1e-9):
            assert r["spa_pval"] == r["score_pval"] and not r["spa"]
            continue
        corrected += r["spa"]
        want = whole_saddlepoint(score[v], adjusted[v], mu)
        # Left out: cumulants beyond the fourth of those who are not listed, and what the Newton fit leaves of its score equations.
        assert r["spa_pval"] == pytest.approx(want, rel=1e-5 if name == "plain" else 1e-4)
    assert corrected > 10


def test_saddlepoint_against_enumeration(rare_trait):
    """The normal tail is far too small for rare carriers among few cases; the saddlepoint is near the exact one."""
    from genolith.operators import saddlepoint

    g, case, entries, models = rare_trait
    mu = np.full(200, 0.1)
    got = {r["variant_key"]: r for r in saddlepoint.saddlepoint_test(entries, models["plain"][0]).collect()}
    spa, normal = [], []
    for v, r in got.items():
        if r["spa"]:
            filled = np.where(np.isnan(g[v]), np.nanmean(g[v]), g[v])
            exact = exact_tail(r["score"], filled - filled.mean(), mu)
            spa.append(math.log10(r["spa_pval"] / exact))
            normal.append(math.log10(r["score_pval"] / exact))
    assert np.abs(spa).max() < 0.35 and np.median(np.abs(spa)) < 0.15 and np.median(np.abs(normal)) > 3 * np.median(np.abs(spa))


def test_saddlepoint_of_common_variants_is_the_normal_tail():
    from genolith.operators import saddlepoint

    rng = np.random.default_rng(0)
    g, mu = rng.normal(size=20000), np.full(20000, 0.4)
    v = float((g * g * mu * (1 - mu)).sum())
    p, both = saddlepoint.two_sided(3 * math.sqrt(v), v, g, mu, (0.0, 0.0, 0.0))
    assert both and p == pytest.approx(math.erfc(3 / math.sqrt(2)), rel=0.02)
    # A sum that cannot come that far has no tail there.
    assert saddlepoint.tail(10.0, np.ones(5), np.full(5, 0.5), (0.0, 0.0, 0.0)) == 0.0


# ------------------------------------------------------------ subset sweep


@pytest.mark.parametrize("gaps", [False, True])
def test_all_1023_subsets(spark, gaps):
    from genolith.operators import models

    rng = np.random.default_rng(9)
    n = 120
    x = rng.normal(size=(n, 12))
    x[:, 11] = x[:, 10] * 2 - 1  # group j is collinear within itself
    y = x[:, 0] - x[:, 3] + rng.normal(size=n)
    held = x.copy()
    if gaps:
        held[rng.uniform(size=n) < 0.2, 2] = np.nan
        held[rng.uniform(size=n) < 0.1, 7] = np.nan
    names = [f"x{i}" for i in range(12)]
    data = spark.createDataFrame([(*[None if np.isnan(v) else float(v) for v in row], float(t)) for row, t in zip(held, y)], ", ".join(f"{c} double" for c in names) + ", y double")
    groups = {g: [names[i]] for i, g in enumerate("abcdefghi")} | {"j": ["x9", "x10"]}
    fits = models.exhaustive_search(data, "y", groups)
    assert len(fits) == 1023 and len({tuple(f.groups) for f in fits}) == 1023
    for f in fits:
        design = np.column_stack([np.ones(n), *[held[:, names.index(c)] for c in f.columns[1:]]])
        ok = ~np.isnan(design).any(1)
        beta, rss, *_ = np.linalg.lstsq(design[ok], y[ok], rcond=None)
        k = int(ok.sum())
        assert f.converged and f.n == k and np.allclose(f.coefficients, beta, atol=1e-7)
        assert f.aic == pytest.approx(k * (math.log(2 * math.pi) + math.log(rss[0] / k) + 1) + 2 * (design.shape[1] + 1), rel=1e-9)
    bad = models.exhaustive_search(data, "y", {"a": ["x0"], "j": ["x10", "x11"], "k": ["x5"]}, ["x1"])
    assert [f.error for f in bad] == [None if "j" not in f.groups else "singular" for f in bad] and all(f.columns[-1] == "x1" for f in bad)


def test_plan_with_kinship(spark, cohort):
    from genolith.operators.genotypes import GenotypeSet
    from genolith.plans import gwas

    *_, data, (variants, samples, entries) = cohort
    called = entries.selectExpr("*", "60 AS gq", "40 AS dp")
    out = gwas.association_scan(GenotypeSet(variants, samples, called), data, "y", ["x1"], search={"x2": ["x2"]}, kinship=True)
    rows = out.collect()
    assert len(rows) > 50 and {"effect_allele", "score_pval", "bonferroni"} <= set(out.columns) and all(0 <= r["score_pval"] <= 1 for r in rows if r["score_pval"] is not None)
