import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from genolith.operators import coloc as co, enrichment as en, expression_assoc as ea, sumstats as ss
from genolith.operators.annotation import SEVERITY, most_severe


def test_sniffing_rules():
    names = ss.sniff(["variant.id", "chr", "pos", "n.obs", "freq", "Score.pval", "Est", "Est.SE", "effect.allele", "other.allele", "n.cases"])
    assert names["SNPID"] == "variant.id" and names["PVAL"] == "Score.pval" and names["Ncases"] == "n.cases" and names["A1"] == "effect.allele"
    with pytest.raises(ValueError, match="PVAL"):
        ss.sniff(["snp", "chr", "pos", "beta"])
    with pytest.raises(ValueError, match="several"):
        ss.sniff(["snp", "MarkerName", "p"])
    with pytest.raises(ValueError, match="ProbeID"):
        ss.sniff(["snp", "p"], eqtl=True)
    assert ss.sniff(["snp", "HetPVal", "P"])["PVAL"] == "P"


def test_allele_matching_cases(spark):
    rows = [("A", "G", "a", "g", True), ("A", "G", "G", "A", True), ("A", "G", "T", "C", True), ("A", "G", "C", "T", True), ("A", "G", "A", "C", False),
            ("AT", "A", "AT", "A", True), ("AT", "A", "TA", "T", False)]
    df = spark.createDataFrame(rows, "a string, b string, c string, d string, want boolean")
    for r in df.select("*", ss.alleles_match(*[F.col(c) for c in "abcd"]).alias("got")).collect():
        assert r["got"] == r["want"]


def test_munged_z_has_the_sign_and_size(spark):
    df = spark.createDataFrame([("v", "A", "G", 100, 0.3, 0.05, -0.2)], "variant_id string, effect_allele string, other_allele string, n_obs int, freq double, score_pval double, est double")
    assert ss.munge_sumstats(df).first()["Z"] == pytest.approx(-1.959963984540054)


def loci(spark, n=60, seed=0, weights=(0.5, 0.15, 0.15, 0.1, 0.1)):
    rng = np.random.default_rng(seed)
    kind = rng.choice(5, size=n, p=weights)
    l = rng.normal(0, 1, size=(n, 5))
    l[:, 0] = 0
    for i, k in enumerate(kind):
        if k:
            l[i, k] += 8
    rows = [(f"P{i}", *map(float, l[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "ProbeID string, " + ", ".join(f"{c} double" for c in co.LIKELIHOODS)).withColumn("bed_region", F.lit(None).cast("string"))
    return df, l


def objective(a, l):
    x = l + a - math.log(np.exp(a).sum())
    top = x.max(axis=1, keepdims=True)
    return float((top.ravel() + np.log(np.exp(x - top).sum(axis=1))).sum() - 0.5 * (((a - co.PENALTY_MEAN) / 3) ** 2).sum())


def test_fitted_priors_are_a_maximum_and_posteriors_sum_to_one(spark):
    df, l = loci(spark)
    table = co.likelihood_table(df)
    prior = co.fit_priors(table)
    a = co._maximise(table, {0: np.array([2.0, -2, -2, -2, -2])}, co._softmax_weights, True, False)[0]
    best = objective(a, l)
    rng = np.random.default_rng(1)
    assert all(objective(a + rng.normal(0, 0.2, 5), l) <= best + 1e-6 for _ in range(200))
    out = co.locus_posteriors(df, prior).toPandas()
    assert np.allclose(out[[f"PP_H{h}_abf" for h in range(5)]].sum(axis=1), 1)
    bounds = co.bootstrap_priors(table, 30).toPandas()
    assert ((bounds["low"] <= bounds["mle"] + 0.05) & (bounds["mle"] <= bounds["hi"] + 0.05)).all()
    four = co.fit_priors_four(table)
    assert len(four) == 4 and 0 < four.sum() <= 1


def test_p_value_path_by_hand(spark):
    rows = [("P", f"s{i}", "1", 100 + i, 1e-3 * (i + 1), 0.3, 500, "A", "G") for i in range(6)]
    schema = "ProbeID string, SNPID string, CHR string, POS bigint, PVAL double, MAF double, N int, A1 string, A2 string"
    eqtl = spark.createDataFrame(rows, schema)
    biom = eqtl.drop("ProbeID").withColumn("Ncases", F.lit(100))
    options = co.ColocOptions(use_beta=False, match_snpid=True, min_snps=2, cc=True)
    out = co.bayes_factors(co.merged_loci(eqtl, biom, options), options).orderBy("SNPID").collect()
    from statistics import NormalDist
    z = NormalDist().inv_cdf(1 - 5e-4)
    v = 1 / (2 * 500 * 0.3 * 0.7 * 0.2 * 0.8)
    r = 0.44**2 / (0.44**2 + v)
    assert out[0]["lABF_biom"] == pytest.approx(0.5 * (math.log(1 - r) + r * z * z), rel=1e-9)
    v2 = 1 / (2 * 0.3 * 0.7 * (500 + z * z))
    terms = [0.5 * (math.log(1 - w / (w + v2)) + w / (w + v2) * z * z) for w in co.AVERAGED_VARIANCES]
    assert out[0]["lABF_eqtl"] == pytest.approx(math.log(sum(map(math.exp, terms)) / 3), rel=1e-9)


def test_few_shared_variants_give_no_locus(spark):
    schema = "ProbeID string, SNPID string, CHR string, POS bigint, PVAL double, BETA double, SE double, MAF double, N int, A1 string, A2 string"
    eqtl = spark.createDataFrame([("P", f"s{i}", "1", i, 0.1, 0.1, 0.1, 0.2, 10, "A", "G") for i in range(5)], schema)
    assert co.coloc_loci(eqtl, eqtl.drop("ProbeID"), co.ColocOptions(match_snpid=True)).count() == 0


def test_cross_tissue_statistic_against_numpy(spark):
    rng = np.random.default_rng(2)
    names, tissues = [f"v{i}" for i in range(6)], ["a", "b", "c"]
    root = rng.normal(size=(6, 6))
    cov = root @ root.T
    w = rng.normal(size=(3, 6))
    z = rng.normal(size=3)
    weights = spark.createDataFrame([("g", t, n, float(w[i, j])) for i, t in enumerate(tissues) for j, n in enumerate(names)], "gene string, tissue string, variant_id string, weight double")
    triplets = spark.createDataFrame([("g", names[i], names[j], float(cov[i, j])) for i in range(6) for j in range(i, 6)], "gene string, variant_1 string, variant_2 string, value double")
    scores = spark.createDataFrame([("g", t, float(z[i])) for i, t in enumerate(tissues)], "gene string, tissue string, zscore double")
    row = ea.cross_tissue(scores, weights, triplets, condition=1e12).first()
    c = w @ cov @ w.T
    sd = np.sqrt(np.diag(c))
    assert row["statistic"] == pytest.approx(z @ np.linalg.inv(c / np.outer(sd, sd)) @ z, rel=1e-8)
    assert row["n_indep"] == 3 and 0 < row["pvalue"] < 1


def test_closure_of_a_diamond(spark):
    edges = spark.createDataFrame([("d", "b"), ("d", "c"), ("b", "a"), ("c", "a")], "term string, parent string")
    got = {(r["term"], r["ancestor"]) for r in en.ancestors(edges).collect()}
    assert got == {(x, x) for x in "abcd"} | {("d", "b"), ("d", "c"), ("d", "a"), ("b", "a"), ("c", "a")}


def test_consequence_order(spark):
    assert len(SEVERITY) == 39
    df = spark.createDataFrame([(["intron_variant", "stop_gained"],), (["nothing"],), ([],)], "t array<string>")
    assert [r[0] for r in df.select(most_severe(F.col("t"))).collect()] == ["stop_gained", None, None]


def test_evidence_plans(spark):
    from genolith.plans.gene_evidence import coloc_evidence, expression_evidence

    assoc = spark.createDataFrame(
        [(f"v{i}", "chr1", 10 + i, "A", "G", 0.3, 0.01, 0.2 + 0.01 * i, 0.1, 100) for i in range(8)],
        "variant_id string, contig string, pos bigint, effect_allele string, other_allele string, freq double, score_pval double, est double, est_se double, n_obs int")
    panel = spark.createDataFrame([(f"p{i}", "chr1", 10 + i, "G", "A") for i in range(8)],
                                  "panel_variant_id string, chromosome string, position bigint, panel_non_effect string, panel_effect string")
    rows = [(g, f"N{g}", t, f"p{i}", 0.1 * (i + 1) + (0.05 if t == "b" else 0) * (i % 2)) for k, g in enumerate(("g1", "g2")) for t in "ab" for i in range(4 * k, 4 * k + 4)]
    weights = spark.createDataFrame(rows, "gene string, gene_name string, tissue string, variant_id string, weight double")
    cov = [(g, t, f"p{i}", f"p{j}", 0.5 if i == j else 0.1) for k, g in enumerate(("g1", "g2")) for t in "ab" for i in range(4 * k, 4 * k + 4) for j in range(i, 4 * k + 4)]
    covariance = spark.createDataFrame(cov, "gene string, tissue string, variant_1 string, variant_2 string, value double")
    out = expression_evidence(assoc, panel, weights, covariance, covariance.drop("tissue").distinct(), "trait").toPandas()
    assert set(out["tissue"]) == {"a", "b", "Meta"} and len(out) == 6
    assert out.loc[out["tissue"] == "Meta", "fdr_phenotype"].isna().all() and out.loc[out["tissue"] != "Meta", "fdr_phenotype"].notna().all()

    results = spark.createDataFrame([(f"ENSG{i}.1", 1e-6 if i < 12 else 0.5, 0.9 if i < 12 else 0.0) for i in range(60)], "ProbeID string, min_pval_biom double, PP_H4_abf double")
    annotations = spark.createDataFrame([(f"ENSG{i}", "t1" if i < 15 else "t2") for i in range(60)], "gene_id string, term string")
    edges = spark.createDataFrame([("t1", "root"), ("t2", "root")], "term string, parent string")
    ontologies = spark.createDataFrame([(t, "BP") for t in ("t1", "t2", "root")], "term string, ontology string")
    report, terms = coloc_evidence(results, annotations, edges, ontologies)
    assert report.count() == 12 and [r["go_id"] for r in terms.collect()] == ["t1"]


def test_closure_of_a_deep_graph_and_of_a_cycle(spark):
    from genolith.operators.enrichment import ancestors

    deep = spark.createDataFrame([(f"t{i}", f"t{i + 1}") for i in range(300)], "term string, parent string")
    assert ancestors(deep).count() == 301 * 302 // 2
    ring = spark.createDataFrame([(f"t{i}", f"t{(i + 1) % 7}") for i in range(7)], "term string, parent string")
    assert ancestors(ring).count() == 49
