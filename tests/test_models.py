import math

import numpy as np
import pandas as pd
import pytest
from conftest import genotype_frames, random_genotypes
from pyspark.sql import functions as F

from genolith import session
from genolith.operators import association as assoc, genes, meta, models, ridge


@pytest.fixture(scope="module")
def subjects(spark):
    rng = np.random.default_rng(11)
    n = 40
    x1, x2, x3 = rng.normal(size=n), rng.integers(0, 2, n).astype(float), rng.normal(size=n)
    y = 1 + 2 * x1 + rng.normal(size=n)
    b = (rng.uniform(size=n) < 1 / (1 + np.exp(-x1))).astype(float)
    rows = [(i, float(y[i]), float(b[i]), float(x1[i]), float(x2[i]), None if i == 7 else float(x3[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "sample_key bigint, y double, b double, x1 double, x2 double, x3 double").cache()
    return df, y, b, np.column_stack([x1, x2, x3])


def ols(y, x):
    beta, *_ = np.linalg.lstsq(x, y, rcond=None)
    rss = float(((y - x @ beta) ** 2).sum())
    n, p = x.shape
    return beta, rss, n * (math.log(2 * math.pi) + math.log(rss / n) + 1) + 2 * (p + 1)


def test_gaussian_fit_uses_complete_rows(subjects):
    df, y, _, x = subjects
    fit = models.fit_models(df, "y", {"a": ["x1"], "c": ["x1", "x3"]})
    beta, _, aic = ols(y, np.column_stack([np.ones(40), x[:, 0]]))
    assert np.allclose(fit[0].coefficients, beta) and fit[0].aic == pytest.approx(aic)
    ok = np.arange(40) != 7
    beta, _, aic = ols(y[ok], np.column_stack([np.ones(39), x[ok][:, [0, 2]]]))
    assert fit[1].n == 39 and np.allclose(fit[1].coefficients, beta) and fit[1].aic == pytest.approx(aic)


def test_binomial_fit_reaches_the_score_equations(subjects):
    df, _, b, x = subjects
    fit = models.fit_models(df, "b", {"a": ["x1", "x2"]})[0]
    design = np.column_stack([np.ones(40), x[:, :2]])
    mu = 1 / (1 + np.exp(-design @ fit.coefficients))
    assert fit.family == "binomial" and fit.converged
    assert np.allclose(design.T @ (b - mu), 0, atol=1e-5)
    assert fit.aic == pytest.approx(-2 * np.sum(np.where(b > 0, np.log(mu), np.log(1 - mu))) + 6, rel=1e-7)


def test_subsets_are_all_there_once(spark):
    rows = models.covariate_combinations(spark, list("abcdefghij")).collect()
    assert len(rows) == 1023 and len({tuple(r["covariates"]) for r in rows}) == 1023
    sizes = [len(r["covariates"]) for r in sorted(rows, key=lambda r: r["model_index"])]
    assert sizes == sorted(sizes)


def test_forward_selection_never_beats_the_search(subjects):
    df, *_ = subjects
    groups = {"x1": ["x1"], "x2": ["x2"]}
    best = min((m for m in models.exhaustive_search(df, "y", groups) if m.converged), key=lambda m: m.aic)
    chosen = models.forward_selection(df, "y", groups)
    assert chosen.groups[0] == "x1" and chosen.aic >= best.aic - 1e-9


def null_parts(y, x):
    beta, rss, _ = ols(y, x)
    s2 = rss / (len(y) - x.shape[1])
    p = (np.eye(len(y)) - x @ np.linalg.inv(x.T @ x) @ x.T) / s2
    return p, (y - x @ beta) / s2


def filled(g):
    return np.where(np.isnan(g), np.nanmean(g, axis=1, keepdims=True), g)


def test_score_test_against_matrices(spark, genotypes, subjects):
    g, _, _, entries = genotypes
    df, y, _, x = subjects
    fit = models.fit_models(df, "y", {"a": ["x1", "x2"]})[0]
    got = {r["variant_key"]: r for r in assoc.score_test(entries, assoc.score_model(df, "y", fit)).collect()}
    p, r = null_parts(y, np.column_stack([np.ones(40), x[:, :2]]))
    full = filled(g)
    for i in range(len(g)):
        u, v = full[i] @ r, full[i] @ p @ full[i]
        assert got[i]["score"] == pytest.approx(u, rel=1e-8, abs=1e-8)
        assert got[i]["est"] == pytest.approx(u / v, rel=1e-8) and got[i]["score_pval"] == pytest.approx(math.erfc(abs(u) / math.sqrt(2 * v)), rel=1e-8)


def test_binary_score_test_against_matrices(spark, genotypes, subjects):
    g, variants, _, entries = genotypes
    df, _, b, x = subjects
    fit = models.fit_models(df, "b", {"a": ["x1"]})[0]
    table = assoc.gwas(entries, variants, assoc.score_model(df, "b", fit)).toPandas().set_index("variant_key")
    design = np.column_stack([np.ones(40), x[:, 0]])
    mu = 1 / (1 + np.exp(-design @ fit.coefficients))
    w = np.diag(mu * (1 - mu))
    p = w - w @ design @ np.linalg.inv(design.T @ w @ design) @ design.T @ w
    full = filled(g)
    for i in range(len(g)):
        assert table.loc[i, "score_stat"] == pytest.approx(full[i] @ (b - mu) / math.sqrt(full[i] @ p @ full[i]), rel=1e-6)
        assert table.loc[i, "n_cases"] == int((b[~np.isnan(g[i])] == 1).sum())


def test_smmat_in_small_chunks_against_matrices(spark, genotypes, subjects):
    g, variants, _, entries = genotypes
    df, y, _, x = subjects
    fit = models.fit_models(df, "y", {"a": ["x1"]})[0]
    regions = spark.createDataFrame([("G1", "chr1", 0, 12000), ("G2", "chr2", 3000, 30000), ("G3", "chr3", 1000, 1000)], "gene_id string, contig string, start_pos bigint, end_pos bigint")
    got = {r["gene_id"]: r for r in genes.smmat(entries, variants, regions, assoc.score_model(df, "y", fit), tile=16, chunk=4).collect()}
    p, r = null_parts(y, np.column_stack([np.ones(40), x[:, 0]]))
    full = filled(g)
    members = {"G1": [i for i in range(60) if i % 3 == 0 and 1000 + 1000 * (i // 3) <= 12000],
               "G2": [i for i in range(60) if i % 3 == 1 and 3000 <= 1000 + 1000 * (i // 3) <= 30000], "G3": [2]}
    for gene, rows in members.items():
        h = full[rows]
        u, v = h @ r, h @ p @ h.T
        one = np.ones(len(rows))
        burden = (one @ u) ** 2 / (one @ v @ one)
        pb = math.erfc(math.sqrt(burden / 2))
        assert got[gene]["burden_pval"] == pytest.approx(pb, rel=1e-6)
        if len(rows) == 1:
            assert got[gene]["theta_pval"] is None and got[gene]["smmat_pval"] == pytest.approx(pb, rel=1e-6)
            continue
        us = u - v @ one * (one @ u) / (one @ v @ one)
        vs = v - np.outer(v @ one, one @ v) / (one @ v @ one)
        t1, t2 = np.trace(vs), np.trace(vs @ vs)
        assert got[gene]["trace_sq"] == pytest.approx(t2, rel=1e-6)
        pt = genes.upper_gamma(np.array([t1 * t1 / t2 / 2]), np.array([us @ us * t1 / t2 / 2]))[0]
        x4 = -2 * (math.log(pb) + math.log(pt))
        assert got[gene]["theta_pval"] == pytest.approx(pt, rel=1e-5)
        assert got[gene]["smmat_pval"] == pytest.approx(math.exp(-x4 / 2) * (1 + x4 / 2), rel=1e-5)


def test_meta_flips_and_drops_alleles(spark):
    schema = "variant_id string, effect_allele string, other_allele string, est double, est_se double, n_obs int"
    one = spark.createDataFrame([("v", "A", "G", 0.2, 0.1, 10), ("w", "A", "G", 0.1, 0.1, 10)], schema)
    two = spark.createDataFrame([("v", "g", "a", -0.4, 0.2, 20), ("w", "A", "T", 0.5, 0.1, 20)], schema)
    out = {r["marker"]: r for r in meta.meta_analysis([one, two]).collect()}
    w = np.array([100.0, 25.0])
    assert out["v"]["effect"] == pytest.approx((0.2 * w[0] + 0.4 * w[1]) / w.sum()) and out["v"]["direction"] == "++"
    assert (out["w"]["n_studies"], out["w"]["direction"]) == (1, "+?")


def test_whole_genome_predictor_helps_a_polygenic_trait(spark):
    g = random_genotypes(150, 120, 0.02, seed=4)
    variants, _, entries = genotype_frames(spark, g)
    rng = np.random.default_rng(8)
    full = filled(g)
    z = (full - full.mean(axis=1, keepdims=True)) / full.std(axis=1, keepdims=True)
    y = z.T @ rng.normal(size=150) / 9 + rng.normal(size=120) * 0.4
    df = spark.createDataFrame([(i, float(y[i]), float(rng.normal())) for i in range(120)], "sample_key bigint, y double, c double")
    pred = ridge.whole_genome_predictor(entries, variants, df, "y", ["c"], block=20, tile=32).cache()
    out = pred.toPandas()
    assert len(out) == 120 * 3 and out["prediction"].notna().all()
    wide = out.pivot(index="sample_key", columns="contig", values="prediction").sort_index()
    assert np.corrcoef(wide.mean(axis=1), y)[0, 1] > 0.3
    tests = ridge.offset_tests(entries, variants, df, "y", ["c"], pred).toPandas()
    assert len(tests) == 150 and (tests["chisq"] >= 0).all()


def test_factor_and_yes_no_covariates(spark):
    """Text and boolean columns enter as treatment-coded indicators, in the fit and in the score model."""
    rng = np.random.default_rng(12)
    rows = []
    for i in range(120):
        race, sex, smoker = ["A", "B", "C"][i % 3], ["F", "M"][(i // 3) % 2], bool(rng.random() < 0.4)
        y = 1.0 + 2.0 * (race == "B") - 1.5 * (race == "C") + 0.5 * (sex == "M") + 0.7 * smoker + float(rng.normal(0, 0.3))
        rows.append((i, y, race, sex, smoker, float(rng.normal())))
    rows.append((120, 1.0, None, "F", True, 0.0))
    df = spark.createDataFrame(rows, "sample_key bigint, y double, race string, sex string, smoker boolean, age double")
    model = models.fit_models(df, "y", {"m": ["race", "sex", "smoker", "age"]}, "gaussian")[0]
    assert model.columns == ["(intercept)", "race=B", "race=C", "sex=M", "smoker=true", "age"] and model.n == 120
    x = np.array([[1, r[2] == "B", r[2] == "C", r[3] == "M", r[4], r[5]] for r in rows[:120]], float)
    want = np.linalg.lstsq(x, np.array([r[1] for r in rows[:120]]), rcond=None)[0]
    assert np.allclose(model.coefficients, want)
    from genolith.operators.association import score_model

    resid = score_model(df, "y", model).table.toPandas().set_index("sample_key")["resid"].sort_index() * model.dispersion
    assert np.allclose(resid, np.array([r[1] for r in rows[:120]]) - x @ want)


@pytest.mark.parametrize("listed", [10_000, 3])
def test_gene_burden_never_broadcasts_the_calls(spark, monkeypatch, listed):
    """Unfolded calls look smaller to the planner than the gene list, but only the list may go to the driver."""
    monkeypatch.setattr(session, "LISTED_KEYS", listed, raising=False)
    calls = spark.range(30).withColumnRenamed("id", "variant_key").withColumn("sample_key", F.explode(F.sequence(F.lit(0), F.lit(19)).cast("array<bigint>")))
    calls = calls.withColumn("gt", F.when((F.col("variant_key") + F.col("sample_key")) % 7 != 0, ((F.col("variant_key") * F.col("sample_key")) % 3).cast("int")))
    members = spark.createDataFrame([(f"g{k % 4}" + "x" * 5000, k) for k in range(24)], "gene_id string, variant_key bigint")
    people = spark.range(15).withColumnRenamed("id", "sample_key")
    out = genes.gene_burden(calls, members, people)
    assert "BuildLeft" not in out._jdf.queryExecution().executedPlan().toString()
    want = {}
    for k in range(24):
        for s in range(15):
            if (k + s) % 7:
                want[f"g{k % 4}", s] = want.get((f"g{k % 4}", s), 0) + k * s % 3
    assert {(r["gene_id"][:2], r["sample_key"]): r["burden"] for r in out.collect()} == want


def test_few_listed_keys_are_seen_before_rows_are_unfolded(spark, monkeypatch):
    calls = spark.range(30).withColumnRenamed("id", "variant_key").withColumn("sample_key", F.explode(F.sequence(F.lit(0), F.lit(19))))
    keys = spark.createDataFrame([(k % 14,) for k in range(20)] + [(None,)], "variant_key bigint")
    want = sorted((k, s) for k in range(14) for s in range(20))
    few = session.keep_listed(calls, keys, "variant_key")
    above, below = few._jdf.queryExecution().optimizedPlan().toString().split("Generate", 1)
    assert "Join" not in above and "Filter" in below
    monkeypatch.setattr(session, "LISTED_KEYS", 13)
    many = session.keep_listed(calls, keys, "variant_key")
    assert "LeftSemi" in many._jdf.queryExecution().optimizedPlan().toString()
    for kept in (few, many):
        assert sorted((r["variant_key"], r["sample_key"]) for r in kept.collect()) == want


@pytest.mark.parametrize("trait", ["trait", "sick"])
def test_association_scan_reads_the_calls_twice(spark, trait):
    from genolith.operators import association, models, qc
    from genolith.operators.genotypes import GenotypeSet
    from genolith.plans import gwas

    rows = [(v, s, None if (v + s) % 29 == 0 else ((v * 7 + s * s) % 5 > 2) + ((v + s * 3) % 7 > 4), 50, 30 if s else 5) for v in range(12) for s in range(60)]
    # Variant 0 has no variation; sample 0 fails; sample 1 has two subjects, sample 2 none.
    rows = [(v, s, None if gt is None else int(gt) * (v > 0), gq, dp) for v, s, gt, gq, dp in rows]
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for pdf in batches:
            read.add(len(pdf))
            yield pdf

    entries = spark.createDataFrame(rows, "variant_key bigint, sample_key bigint, gt int, gq int, dp int")
    variants = spark.createDataFrame([(v, "chr1", 100 + v, "A", "G") for v in range(12)], "variant_key bigint, contig string, pos bigint, ref string, alt string")
    samples = spark.createDataFrame([(s,) for s in range(60)], "sample_key bigint")
    subjects = spark.createDataFrame([(s, float((s * 37) % 41), float((s * 11) % 5 > 2), float(s % 2)) for s in [*range(60), 1] if s != 2],
                                     "sample_key bigint, trait double, sick double, sex double")
    counted = GenotypeSet(variants, samples, entries.repartition(3).mapInPandas(seen, entries.schema))
    got = {r["variant_key"]: r for r in gwas.association_scan(counted, subjects, trait, ["sex"]).collect()}
    assert read.value == 2 * len(rows)

    clean = gwas.quality_controlled(GenotypeSet(variants, samples, entries))
    data = subjects.where("sample_key <> 0")
    model = models.fit_models(data, trait, {"null": ["sex"]})[0]
    want = association.gwas(clean.entries, clean.variants, association.score_model(data, trait, model)).collect()
    assert want and set(got) == {r["variant_key"] for r in want}
    for r in want:
        for name, value in r.asDict().items():
            found = got[r["variant_key"]][name]
            assert found == (pytest.approx(value, rel=1e-9, abs=1e-12) if isinstance(value, float) else value), name


def test_equilibrium_test_looks_at_few_heterozygote_counts():
    import tracemalloc

    from genolith.operators import qc

    n, af = 400_000, 0.3
    het = np.full(50, int(2 * n * af * (1 - af))) + np.arange(50)
    alt = (2 * n * af - het).astype(int) // 2
    counts = [pd.Series(x) for x in (n - het - alt, het, alt)]
    tracemalloc.start()
    p = qc._hwe_batch(*counts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert 0 < p.min() < p.max() < 1
    # The table of factorials is as long as the cohort; all counts of these variants side by side would be 50 times 120,000.
    assert peak < 8 * 8 * 2 * n
