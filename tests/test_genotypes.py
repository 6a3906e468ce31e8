import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from genolith.operators import callsets, genotypes as gt, intervals, qc, samples
from genolith.operators.genotypes import GenotypeSet


def test_triallelic_split_by_hand(spark):
    sites = spark.sql("""SELECT 'chr1' AS contig, 5L AS pos, 'A' AS ref, array('C', 'G') AS alts, 1 AS a1, 2 AS a2,
      array(10L, 3L, 4L) AS AD, array(9L, 8L, 7L, 6L, 5L, 4L) AS PL, array(0.1D, 0.2D) AS AF""")
    first, second = gt.split_multi(sites).orderBy("a_index").collect()
    # Genotypes 00 01 11 02 12 22; the first allele folds {00,02,22} {01,12} {11}.
    assert (first["alt"], first["gt"], first["AD"], first["PL"], first["AF"]) == ("C", 1, [14, 3], [4, 5, 7], [0.1])
    assert (second["alt"], second["gt"], second["AD"], second["PL"], second["AF"]) == ("G", 1, [13, 4], [7, 5, 4], [0.2])


def test_missing_call_and_fields_stay_missing(spark):
    sites = spark.sql("SELECT 'chr1' AS contig, 5L AS pos, 'A' AS ref, array('C') AS alts, CAST(NULL AS INT) AS a1, CAST(NULL AS INT) AS a2, CAST(NULL AS ARRAY<BIGINT>) AS AD")
    row = gt.split_multi(sites).first()
    assert row["gt"] is None and row["AD"] is None


def brute_hwe(hom1, het, hom2):
    n = hom1 + het + hom2
    rare, common = sorted((2 * hom1 + het, 2 * hom2 + het))
    def p(k):
        a, b = (rare - k) // 2, (common - k) // 2
        return math.factorial(n) // (math.factorial(a) * math.factorial(b) * math.factorial(k)) * 2**k
    ks = range(rare % 2, rare + 1, 2)
    total, seen = sum(p(k) for k in ks), p(het)
    return (sum(p(k) for k in ks if p(k) < seen) + sum(p(k) for k in ks if p(k) == seen) / 2) / total


def test_hwe_exact(spark):
    cases = [(0, 0, 10), (1, 5, 14), (5, 10, 5), (8, 2, 10), (0, 1, 30), (20, 3, 0)]
    df = spark.createDataFrame(cases, "a long, b long, c long").select("*", qc.hwe_mid_p("a", "b", "c").alias("p"))
    for r in df.collect():
        assert r["p"] == pytest.approx(brute_hwe(r["a"], r["b"], r["c"]), rel=1e-9)


def test_ac_window_counts_both_alleles(spark):
    df = spark.createDataFrame([(1, 0, 20), (2, 20, 0), (3, 1, 19), (4, 10, 10)], "variant_key long, ac long, ac_ref long").withColumn("an", F.lit(20))
    assert {r["variant_key"] for r in qc.ac_window(df, 0).collect()} == {3, 4}
    assert {r["variant_key"] for r in qc.ac_window(df, 1).collect()} == {4}


def test_endpoint_names(spark):
    names = spark.createDataFrame([("a.QC.VEP_annotated.mt",), ("a.QC.mt",), ("VEP_annotated",), (".x_annotated",)], "name string")
    got = [r[0] for r in names.select(gt.endpoint_name(F.col("name"), "LOF_filtered")).collect()]
    assert got == ["a.QC.LOF_filtered", "a.QC.LOF_filtered", "VEP_annotated.LOF_filtered", ".x_annotated.LOF_filtered"]


def test_range_join_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    points = [(int(i), f"chr{i % 2}", int(p)) for i, p in enumerate(rng.integers(0, 400_000, 300))]
    spans = [(int(i), f"chr{i % 2}", int(s), int(s + w)) for i, (s, w) in enumerate(zip(rng.integers(0, 400_000, 40), rng.integers(0, 200_000, 40)))]
    got = intervals.range_join(spark.createDataFrame(points, "k long, contig string, pos long"),
                               spark.createDataFrame(spans, "j long, contig string, start_pos long, end_pos long"))
    want = {(k, j) for k, c, p in points for j, d, s, e in spans if c == d and s <= p <= e}
    assert {(r["k"], r["j"]) for r in got.collect()} == want and got.count() == len(want)


def test_subset_keeps_polymorphic_only(spark, genotypes):
    g, variants, people, entries = genotypes
    kept = samples.subset_samples(GenotypeSet(variants, people, entries), people.where("sample_key < 4"))
    part = g[:, :4]
    ac, an = np.nansum(part, axis=1), 2 * (~np.isnan(part)).sum(axis=1)
    assert {r["variant_key"] for r in kept.variants.collect()} == set(np.nonzero((ac > 0) & (ac < an))[0])


def test_concordance_of_a_set_with_itself(spark, genotypes):
    _, _, _, entries = genotypes
    out = callsets.concordance(entries, entries, "sample_key").collect()
    assert all(r["discordant"] == 0 and r["frac_concordant"] == 1.0 for r in out)


def test_typed_filter(spark, genotypes):
    _, variants, people, entries = genotypes
    flagged = variants.withColumns({"typed": F.col("variant_key") < 5, "typed_only": F.lit(False)})
    kept = qc.filter_typed_ac(GenotypeSet(flagged, people, entries), 1)
    assert {r["variant_key"] for r in kept.variants.collect()} <= set(range(5))


def test_trait_pairs(spark):
    pairs = samples.trait_pairs(spark.createDataFrame([("b",), ("a",), ("c",), ("a",)], "trait string"))
    assert sorted(map(tuple, pairs.collect())) == [("a", "b"), ("a", "c"), ("b", "c")]


@pytest.mark.parametrize("by", [[], ["sample_key"], ["variant_key"], ["variant_key", "sample_key"]])
def test_paired_states_match_a_full_join(spark, by):
    """Scattered, repeated and missing entries, variants of one set only or without a key, samples of one set only."""
    rng = np.random.default_rng(5)

    def call_set(n, people, sites):
        rows = {(int(v), int(s)) for v, s in zip(rng.choice(sites, n), rng.choice(people, n))}
        rows = [(v, s, [None, 0, 1, 2][rng.integers(4)]) for v, s in rows]
        rows += [(v, s, [None, 0, 1, 2][rng.integers(4)]) for v, s, _ in rows[:20]] + [(None, int(people[0]), 1), (None, int(people[3]), None)]
        order = rng.permutation(len(rows))
        return [rows[i] for i in order]

    dense = [(100, s, s % 3) for s in range(40)]
    a, b = call_set(300, np.arange(40), np.arange(30)) + dense, call_set(300, np.arange(3, 50), np.arange(10, 45)) + dense + dense[5:9]
    common = {s for _, s, _ in a} & {s for _, s, _ in b}
    state = lambda gt: 1 if gt is None else gt + 2
    want = {}
    keys = {(v, s) for v, s, _ in a + b if s in common}
    for v, s in keys:
        left, right = ([state(g) for w, p, g in rows if (w, p) == (v, s)] for rows in (a, b))
        if v is None:
            met = [(x, 0) for x in left] + [(0, y) for y in right]
        else:
            met = [(x, y) for x in left or [0] for y in right or [0]]
        for pair in met:
            k = (*[{"variant_key": v, "sample_key": s}[c] for c in by], *pair)
            want[k] = want.get(k, 0) + 1
    frames = [spark.createDataFrame(rows, "variant_key bigint, sample_key bigint, gt int") for rows in (a, b)]
    got = callsets.paired_states(*frames, by, tile=16)
    assert {tuple(r)[:-1]: r["n"] for r in got.collect()} == want
    assert got.count() == len(want)


def test_paired_calls_are_packed_before_the_shuffle(spark, genotypes):
    _, _, _, entries = genotypes
    out = callsets.paired_states(entries, entries, ["sample_key"])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "FullOuter" not in plan and plan.count("RepartitionByExpression") == 1
    below = plan[plan.index("RepartitionByExpression"):]
    assert below.count("MapInArrow") == 2


def test_calls_out_of_range_are_refused(spark):
    bad = spark.createDataFrame([(1, 1, 3)], "variant_key bigint, sample_key bigint, gt int")
    with pytest.raises(Exception, match="0, 1, 2 or null"):
        callsets.paired_states(bad, bad).collect()


def test_sex_check_does_not_sort_the_calls(spark, genotypes):
    """The planner takes frequencies over unfolded calls for large; they are small, so the calls are joined where they are."""
    _, _, _, entries = genotypes
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = samples.impute_sex(entries, qc.call_stats(entries))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
