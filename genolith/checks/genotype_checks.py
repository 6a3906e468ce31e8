"""Queries over the genotype operators."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Window
from pyspark.sql import functions as F

from genolith import fixtures as fx
from genolith.checks.registry import genotypes, query, r, rounded
from genolith.operators import callsets, genotypes as gt, intervals, qc, samples
from genolith.session import scratch_table

# --- shared SQL of the oracles -----------------------------------------------

SAMPLE_QC = """SELECT sample_key, count(gt) / cast(count(*) AS DOUBLE) AS call_rate,
  avg(gq) AS gq_mean, min(gq) AS gq_min, max(gq) AS gq_max, stddev_pop(gq) AS gq_sd,
  avg(dp) AS dp_mean, min(dp) AS dp_min, max(dp) AS dp_max, stddev_pop(dp) AS dp_sd
  FROM fx_entries GROUP BY sample_key"""
CALLS = """SELECT variant_key, count(*) AS n_entries, count(gt) AS n_called, cast(coalesce(sum(gt), 0) AS BIGINT) AS ac,
  count(*) FILTER (gt = 0) AS n_hom_ref, count(*) FILTER (gt = 1) AS n_het, count(*) FILTER (gt = 2) AS n_hom_alt,
  2 * count(gt) AS an, cast(2 * count(gt) - coalesce(sum(gt), 0) AS BIGINT) AS ac_ref,
  CASE WHEN count(gt) > 0 THEN coalesce(sum(gt), 0) / (2e0 * count(gt)) END AS af, avg(dp) AS dp_mean, avg(gq) AS gq_mean,
  count(gt) / cast(count(*) AS DOUBLE) AS call_rate FROM {entries} GROUP BY variant_key"""
LF = "lgamma({} + 1e0)"
# Exact test by enumeration of the possible heterozygote counts.
HWE = """SELECT variant_key, sum(CASE WHEN abs(lp - lobs) < 1e-9 THEN 5e-1 * exp(lp - lmax) WHEN lp < lobs THEN exp(lp - lmax) ELSE 0 END)
    / sum(exp(lp - lmax)) AS p_hwe
  FROM (SELECT variant_key, lp, max(lp) OVER (PARTITION BY variant_key) AS lmax,
      max(CASE WHEN k = n_het THEN lp END) OVER (PARTITION BY variant_key) AS lobs
    FROM (SELECT c.variant_key, c.n_het, h.k, h.k * ln(2e0) - lgamma((least(ac, ac_ref) - h.k) / 2 + 1e0)
        - lgamma(h.k + 1e0) - lgamma((greatest(ac, ac_ref) - h.k) / 2 + 1e0) AS lp
      FROM calls c JOIN (SELECT unnest(range(0, 2100)) AS k) h
        ON h.k <= least(c.ac, c.ac_ref) AND h.k % 2 = least(c.ac, c.ac_ref) % 2) x) y GROUP BY variant_key"""
VARIANT_QC = f"WITH calls AS ({CALLS.format(entries='fx_entries')}), hwe AS ({HWE}) "


def _window(k, alias=""):
    return f"(({alias}ac > {k} AND {alias}ac < {alias}an - {k}) OR ({alias}ac_ref > {k} AND {alias}ac_ref < {alias}an - {k}))"


@query("agg1_sample_qc", f"""SELECT sample_key, round(call_rate, 8) AS call_rate, round(gq_mean, 8) AS gq_mean, gq_min, gq_max,
  round(gq_sd, 6) AS gq_sd, round(dp_mean, 8) AS dp_mean, dp_min, dp_max, round(dp_sd, 6) AS dp_sd FROM ({SAMPLE_QC}) q""")
def _(spark, d):
    out = qc.sample_qc(fx.view(spark, d, "fx_entries"))
    return rounded(rounded(out, "call_rate", "gq_mean", "dp_mean"), "gq_sd", "dp_sd", digits=6)


@query("agg2_variant_qc", VARIANT_QC + """SELECT c.variant_key, n_entries, n_called, ac, ac_ref, an, n_hom_ref, n_het, n_hom_alt,
  round(af, 8) AS af, round(dp_mean, 8) AS dp_mean, round(gq_mean, 8) AS gq_mean, round(call_rate, 8) AS call_rate,
  round(p_hwe, 7) AS p_hwe FROM calls c JOIN hwe USING (variant_key)""")
def _(spark, d):
    out = qc.variant_qc(fx.view(spark, d, "fx_entries")).select(
        "variant_key", "n_entries", "n_called", "ac", "ac_ref", "an", "n_hom_ref", "n_het", "n_hom_alt",
        "af", "dp_mean", "gq_mean", "call_rate", "p_hwe")
    return rounded(rounded(out, "af", "dp_mean", "gq_mean", "call_rate"), "p_hwe", digits=7)


@query("agg3_call_stats", f"""SELECT variant_key, ac, ac_ref, an, round(af, 8) AS af, n_hom_ref, n_hom_alt
  FROM ({CALLS.format(entries='fx_entries')}) c""")
def _(spark, d):
    out = qc.call_stats(fx.view(spark, d, "fx_entries"))
    return rounded(out.select("variant_key", "ac", "ac_ref", "an", "af", "n_hom_ref", "n_hom_alt"), "af")


@query("hwe1_mid_p", VARIANT_QC + "SELECT variant_key, round(p_hwe, 7) AS p_hwe FROM hwe")
def _(spark, d):
    stats = qc.call_stats(fx.view(spark, d, "fx_entries"))
    return stats.select("variant_key", r(qc.hwe_mid_p("n_hom_ref", "n_het", "n_hom_alt"), 7).alias("p_hwe"))


@query("agg4_qc_histogram", f"""SELECT bin, count(*) AS n, CASE WHEN bin BETWEEN 1 AND 50 THEN round(8e-1 + (bin - 1) * (2e-1 / 50), 8) END AS bin_start
  FROM (SELECT cast(CASE WHEN call_rate < 8e-1 THEN 0 WHEN call_rate > 1 THEN 51
    ELSE least(floor((call_rate - 8e-1) / ((1e0 - 8e-1) / 50)) + 1, 50) END AS INT) AS bin
  FROM ({CALLS.format(entries='fx_entries')}) c) b GROUP BY bin""")
def _(spark, d):
    stats = qc.variant_qc(fx.view(spark, d, "fx_entries"), with_hwe=False)
    return rounded(qc.qc_histogram(stats, "call_rate", *qc.QC_RANGES["call_rate"]), "bin_start")


@query("agg4_dp_call_rate_pairs", f"SELECT sample_key, round(dp_mean, 8) AS dp_mean, dp_min, round(call_rate, 8) AS call_rate FROM ({SAMPLE_QC}) q")
def _(spark, d):
    pairs = qc.dp_call_rate_pairs(qc.sample_qc(fx.view(spark, d, "fx_entries")), "sample_key")
    return rounded(pairs, "dp_mean", "call_rate")


# --- filters -----------------------------------------------------------------


@query("flt1_biallelic", "SELECT p_partkey AS variant_key FROM part WHERE p_partkey % 3 = 0")
def _(spark, d):
    sites = fx.table(spark, d, "part").selectExpr(
        "p_partkey AS variant_key", "slice(array('A', 'C', 'G', 'T'), 1, cast(p_partkey % 3 + 2 AS INT)) AS alleles")
    return gt.filter_biallelic(sites).select("variant_key")


@query("flt2_samples_qc", f"SELECT sample_key FROM ({SAMPLE_QC}) q WHERE dp_mean > 29.5e0 AND call_rate > 8.5e-1 AND gq_mean > 40")
def _(spark, d):
    return qc.passing_samples(qc.sample_qc(fx.view(spark, d, "fx_entries")), min_dp=29.5).select("sample_key")


@query("flt3_variants_qc", f"""SELECT v.variant_key, v.contig, v.pos FROM fx_variants v JOIN ({CALLS.format(entries='fx_entries')}) c
  USING (variant_key) WHERE dp_mean > 25 AND call_rate > 9e-1 AND gq_mean > 40""")
def _(spark, d):
    return qc.filter_variants_qc(genotypes(spark, d)).variants.select("variant_key", "contig", "pos")


@query("flt4_polymorphic", f"SELECT variant_key FROM ({CALLS.format(entries='fx_entries')}) c WHERE {_window(0)}")
def _(spark, d):
    return qc.filter_polymorphic(genotypes(spark, d)).variants.select("variant_key")


@query("flt5_ac_window", f"""SELECT e.variant_key, count(*) AS n FROM fx_entries e JOIN (SELECT variant_key FROM
  ({CALLS.format(entries='fx_entries')}) c WHERE {_window(10)}) k ON k.variant_key = e.variant_key GROUP BY e.variant_key""")
def _(spark, d):
    return qc.filter_ac(genotypes(spark, d), 10).entries.groupBy("variant_key").agg(F.count(F.lit(1)).alias("n"))


BY_PHENOTYPE = "(SELECT e.* FROM fx_entries e JOIN fx_samples s ON s.sample_key = e.sample_key AND s.trait > 2000)"


@query("flt6_ac_by_phenotype", f"SELECT variant_key, ac, an FROM ({CALLS.format(entries=BY_PHENOTYPE + ' p')}) c WHERE {_window(5)}")
def _(spark, d):
    g = genotypes(spark, d)
    phenotypes = g.samples.select("sample_key", F.when(F.col("trait") > 2000, F.col("trait")).alias("titer"))
    kept = qc.filter_ac_by_phenotype(g, phenotypes, "titer", 5)
    return qc.call_stats(kept.entries).select("variant_key", "ac", "an")


@query("flt7_gwas_filter", VARIANT_QC + """SELECT c.variant_key FROM calls c JOIN hwe USING (variant_key)
  WHERE af > 1e-2 AND 1 - af > 1e-2 AND p_hwe > 1e-6""")
def _(spark, d):
    return qc.gwas_filter(genotypes(spark, d)).variants.select("variant_key")


@query("flt8_singletons", f"SELECT variant_key FROM ({CALLS.format(entries='fx_entries')}) c WHERE ac = 1 OR ac_ref = 1")
def _(spark, d):
    return qc.rare_filter(genotypes(spark, d)).variants.select("variant_key")


@query("flt9_typed_ac", f"SELECT variant_key FROM ({CALLS.format(entries='fx_entries')}) c WHERE (variant_key % 5 = 0 OR variant_key % 7 = 0) AND {_window(1)}")
def _(spark, d):
    g = genotypes(spark, d)
    flagged = g.variants.withColumns({"typed": F.col("variant_key") % 5 == 0, "typed_only": F.col("variant_key") % 7 == 0})
    return qc.filter_typed_ac(replace(g, variants=flagged), 1).variants.select("variant_key")


@query("flt10_chromosome", "SELECT * FROM fx_variants WHERE contig = 'chr7'")
def _(spark, d):
    return gt.split_chromosome(fx.view(spark, d, "fx_variants"), "chr7")


@query("flt22_population_list", "SELECT c_name AS \"Subject_ID\" FROM customer WHERE c_mktsegment = 'MACHINERY'")
def _(spark, d):
    calls = fx.table(spark, d, "customer").select(F.col("c_name").alias("sample_id"), F.col("c_mktsegment").alias("population"))
    return samples.population_list(calls, "MACHINERY")


# --- projections -------------------------------------------------------------


@query("prj1_variant_id", "SELECT variant_key, contig || ':' || cast(pos AS STRING) || ':' || ref || ':' || alt AS variant_id FROM fx_variants")
def _(spark, d):
    return fx.view(spark, d, "fx_variants").select("variant_key", gt.variant_id().alias("variant_id"))


GENOTYPE_ORDER = "(VALUES (0,0,0),(1,0,1),(2,1,1),(3,0,2),(4,1,2),(5,2,2),(6,0,3),(7,1,3),(8,2,3),(9,3,3)) AS o(idx, j, k)"
MULTI = """SELECT l_orderkey * 10 + l_linenumber AS call_key, l_orderkey, l_linenumber, l_partkey % 3 + 1 AS n_alts,
  l_partkey % (l_partkey % 3 + 2) AS a1, l_suppkey % (l_partkey % 3 + 2) AS a2, l_partkey, l_suppkey FROM lineitem"""


def _calls(spark, d):
    calls = fx.sql(spark, d, MULTI)
    n = F.col("n_alts")
    array = lambda top, f: F.transform(F.sequence(F.lit(0), top.cast("int")), f)
    return calls.select(
        "l_orderkey", "l_linenumber", F.slice(F.array(*map(F.lit, "CGT")), 1, n.cast("int")).alias("alts"), "a1", "a2",
        array(n, lambda i: (F.col("l_partkey") * (i + 3) + F.col("l_suppkey")) % 47).alias("AD"),
        array((n + 1) * (n + 2) / 2 - 1, lambda i: (F.col("l_partkey") * (i + 1) * 7 + F.col("l_suppkey") * 13) % 61).alias("PL"),
        F.struct(
            array(n - 1, lambda i: (F.col("l_partkey") + i) % 9).alias("AC"),
            array(n - 1, lambda i: ((F.col("l_partkey") + i) % 9) / F.lit(20.0)).alias("AF"),
        ).alias("info"),
    )


ALTS = f"(SELECT m.*, unnest(range(1, n_alts + 1)) AS a_index FROM ({MULTI}) m)"


@query("prj2_split_multi", f"""SELECT l_orderkey, l_linenumber, a_index, substr('CGT', cast(a_index AS INT), 1) AS alt,
  CASE WHEN a1 = a_index THEN 1 ELSE 0 END + CASE WHEN a2 = a_index THEN 1 ELSE 0 END AS gt, count(*) AS n
  FROM {ALTS} a GROUP BY ALL""")
def _(spark, d):
    return gt.split_multi(_calls(spark, d)).groupBy("l_orderkey", "l_linenumber", F.col("a_index").cast("bigint").alias("a_index"), "alt", "gt").agg(
        F.count(F.lit(1)).alias("n"))


@query("prj3_split_r_sum", f"""SELECT l_orderkey, l_linenumber, a_index, cast(total - mine AS BIGINT) AS ad_other, mine AS ad_allele FROM (
  SELECT a.*, (l_partkey * (a_index + 3) + l_suppkey) % 47 AS mine,
    list_sum(list_transform(range(0, n_alts + 1), lambda i: (l_partkey * (i + 3) + l_suppkey) % 47)) AS total FROM {ALTS} a) q""")
def _(spark, d):
    return gt.split_multi(_calls(spark, d)).select("l_orderkey", "l_linenumber", F.col("a_index").cast("bigint").alias("a_index"),
                                                   F.col("AD")[0].alias("ad_other"), F.col("AD")[1].alias("ad_allele"))


@query("prj4_split_g_min", f"""SELECT l_orderkey, l_linenumber, a_index, min(CASE WHEN copies = 0 THEN x END) AS pl0,
  min(CASE WHEN copies = 1 THEN x END) AS pl1, min(CASE WHEN copies = 2 THEN x END) AS pl2 FROM (
  SELECT a.l_orderkey, a.l_linenumber, a.rid, a_index, (l_partkey * (idx + 1) * 7 + l_suppkey * 13) % 61 AS x,
    (CASE WHEN j = a_index THEN 1 ELSE 0 END) + (CASE WHEN k = a_index THEN 1 ELSE 0 END) AS copies
  FROM (SELECT x.*, row_number() OVER () AS rid FROM {ALTS} x) a JOIN {GENOTYPE_ORDER} ON idx < (n_alts + 1) * (n_alts + 2) / 2) q GROUP BY l_orderkey, l_linenumber, rid, a_index""")
def _(spark, d):
    return gt.split_multi(_calls(spark, d)).select("l_orderkey", "l_linenumber", F.col("a_index").cast("bigint").alias("a_index"),
                                                   *[F.col("PL")[i].alias(f"pl{i}") for i in range(3)])


@query("prj5_split_a_pick", f"""SELECT l_orderkey, l_linenumber, a_index, (l_partkey + a_index - 1) % 9 AS ac,
  round(((l_partkey + a_index - 1) % 9) / 20e0, 8) AS af FROM {ALTS} a""")
def _(spark, d):
    return gt.split_multi(_calls(spark, d)).select("l_orderkey", "l_linenumber", F.col("a_index").cast("bigint").alias("a_index"),
                                                   F.col("info.AC")[0].alias("ac"), r(F.col("info.AF")[0]).alias("af"))


SAMPLE_NAMES = """SELECT s_suppkey, concat('SUBJ', cast(7000 + s_suppkey AS STRING), 'T', cast(s_suppkey % 3 AS STRING),
  CASE WHEN s_suppkey % 10 = 4 THEN 'a' ELSE '' END, CASE WHEN s_suppkey % 4 = 1 THEN '_S1' ELSE '' END) AS sample_id FROM supplier"""


@query("prj6_subject_from_sample", f"""SELECT s_suppkey, sample_id, concat('SUBJ', cast(7000 + s_suppkey AS STRING)) AS subject_id
  FROM ({SAMPLE_NAMES}) q WHERE right(sample_id, 1) <> 'a'""")
def _(spark, d):
    return gt.subject_from_sample(fx.sql(spark, d, SAMPLE_NAMES))


@query("prj22_complement_base", """SELECT variant_key, CASE alt WHEN 'A' THEN 'T' WHEN 'T' THEN 'A' WHEN 'C' THEN 'G' ELSE 'C' END AS base,
  concat(ref, alt) AS longer FROM fx_variants""")
def _(spark, d):
    v = fx.view(spark, d, "fx_variants")
    return v.select("variant_key", gt.complement_base(F.col("alt")).alias("base"), gt.complement_base(F.concat("ref", "alt")).alias("longer"))


@query("prj23_strip_version", "SELECT p_partkey, concat('ENSG', cast(p_partkey AS STRING)) AS gene_id FROM part")
def _(spark, d):
    versioned = F.concat(F.lit("ENSG"), F.col("p_partkey").cast("string"), F.lit("."), F.col("p_size").cast("string"))
    return fx.table(spark, d, "part").select("p_partkey", gt.strip_version(versioned).alias("gene_id"))


@query("prj26_fill_missing", """SELECT event_id, CASE WHEN event_type = 'view' THEN 'seen' WHEN event_id % 3 = 0 THEN event_type ELSE '' END AS filled FROM events""")
def _(spark, d):
    e = fx.table(spark, d, "events")
    first = F.when(F.col("event_type") == "view", "seen")
    return e.select("event_id", gt.fill_missing(first, F.when(F.col("event_id") % 3 == 0, F.col("event_type")), F.lit("")).alias("filled"))


@query("prj32_ancestry_label", """SELECT s_suppkey, CASE WHEN s_nationkey % 6 = 0 THEN 'HISPANIC' WHEN s_suppkey % 5 = 0 THEN 'WHITE'
  WHEN s_suppkey % 5 = 1 THEN 'BLACK' WHEN s_suppkey % 5 = 2 THEN 'ASIAN' ELSE 'OTHER/UNKNOWN' END AS label FROM supplier""")
def _(spark, d):
    race = F.expr("CASE s_suppkey % 5 WHEN 0 THEN 'WHITE' WHEN 1 THEN 'JAMAICAN' WHEN 2 THEN 'KOREAN' WHEN 3 THEN 'OTHER' END")
    ethnicity = F.expr("CASE WHEN s_nationkey % 6 = 0 THEN 'HISPANIC' WHEN s_nationkey % 6 = 1 THEN 'NON-HISPANIC' END")
    return fx.table(spark, d, "supplier").select("s_suppkey", samples.ancestry_label(race, ethnicity).alias("label"))


# --- joins and set operations ------------------------------------------------

LISTED = "(SELECT e.* FROM fx_entries e JOIN fx_samples s ON s.sample_key = e.sample_key AND s.grp < 8)"


@query("joi1_subset_samples", f"SELECT variant_key, ac, an FROM ({CALLS.format(entries=LISTED + ' p')}) c WHERE {_window(0)}")
def _(spark, d):
    g = genotypes(spark, d)
    return qc.call_stats(samples.subset_samples(g, g.samples.where("grp < 8")).entries).select("variant_key", "ac", "an")


CLINICAL = """SELECT c_custkey, c_custkey % 120 AS subject_id, CASE c_nationkey % 3 WHEN 0 THEN 'Male' ELSE 'Female' END AS sex FROM customer"""
SEX = """sex_calls AS (SELECT e.sample_key, count(*) AS n_called, sum(1 - 2 * af * (1 - af)) AS expected_homs,
    count(*) FILTER (e.gt <> 1) AS observed_homs FROM fx_entries e JOIN calls c ON c.variant_key = e.variant_key
    WHERE e.gt IS NOT NULL AND af > 0 AND af < 1 GROUP BY e.sample_key),
  imputed AS (SELECT sample_key, f_stat, CASE WHEN f_stat < {female} THEN true WHEN f_stat > {male} THEN false END AS is_female
    FROM (SELECT sample_key, (observed_homs - expected_homs) / (n_called - expected_homs) AS f_stat FROM sex_calls) s)"""
CALLS_CTE = f"WITH calls AS ({CALLS.format(entries='fx_entries')}), "


@query("agg6_impute_sex", CALLS_CTE + SEX.format(female="5e-1", male="6e-1") + """
  SELECT i.sample_key, n_called, round(expected_homs, 6) AS expected_homs, observed_homs, round(f_stat, 6) AS f_stat, is_female
  FROM imputed i JOIN sex_calls USING (sample_key)""")
def _(spark, d):
    e = fx.view(spark, d, "fx_entries")
    return rounded(samples.impute_sex(e, qc.call_stats(e)), "expected_homs", "f_stat", digits=6)


MISMATCH = f"""reported AS (SELECT subject_id, string_agg(DISTINCT sex, '/' ORDER BY sex) AS reported FROM ({CLINICAL}) c GROUP BY subject_id),
  bad AS (SELECT i.sample_key AS subject_id, i.is_female, r.reported FROM imputed i JOIN reported r ON r.subject_id = i.sample_key
    WHERE (i.is_female AND reported <> 'Female') OR (NOT i.is_female AND reported <> 'Male'))"""


def _imputed(spark, d):
    e = fx.view(spark, d, "fx_entries")
    # The stand-in genotypes scatter around F = 0, so the cut lies there.
    sex = samples.impute_sex(e, qc.call_stats(e), female_threshold=0.0, male_threshold=0.01)
    return sex.select(F.col("sample_key").alias("subject_id"), "is_female")


@query("agg5_sex_mismatch", CALLS_CTE + SEX.format(female="0e0", male="1e-2") + ", " + MISMATCH + " SELECT subject_id, is_female, reported FROM bad")
def _(spark, d):
    return samples.sex_mismatch(_imputed(spark, d), fx.sql(spark, d, CLINICAL))


@query("joi2_match_samples", CALLS_CTE + SEX.format(female="0e0", male="1e-2") + ", " + MISMATCH + f"""
  SELECT sample_key AS subject_id, trait FROM fx_samples WHERE sample_key IN (SELECT subject_id FROM ({CLINICAL}) c)
  AND sample_key NOT IN (SELECT subject_id FROM bad)""")
def _(spark, d):
    clinical = fx.sql(spark, d, CLINICAL)
    subjects = fx.view(spark, d, "fx_samples").select(F.col("sample_key").alias("subject_id"), "trait")
    return samples.match_samples(subjects, clinical, samples.sex_mismatch(_imputed(spark, d), clinical))


@query("joi3_sample_difference", "SELECT s_suppkey AS sample_key FROM supplier WHERE s_suppkey NOT IN (SELECT l_suppkey FROM lineitem WHERE l_quantity > 49 AND l_discount > 8e-2 AND l_returnflag = 'R')")
def _(spark, d):
    first = fx.table(spark, d, "supplier").select(F.col("s_suppkey").alias("sample_key"))
    second = fx.table(spark, d, "lineitem").where("l_quantity > 49 AND l_discount > 8e-2 AND l_returnflag = 'R'").select(F.col("l_suppkey").alias("sample_key"))
    return samples.sample_difference(first, second)


@query("joi4_restrict_to_bed", """SELECT variant_key, contig, pos FROM fx_variants v WHERE EXISTS
  (SELECT 1 FROM fx_genes g WHERE g.contig = v.contig AND v.pos BETWEEN g.start_pos AND g.end_pos)""")
def _(spark, d):
    v = fx.view(spark, d, "fx_variants").select("variant_key", "contig", "pos")
    return intervals.restrict_to_intervals(v, fx.view(spark, d, "fx_genes"))


@query("joi5_keep_listed_sites", "SELECT variant_key, contig, pos, ref, alt FROM fx_variants WHERE variant_key IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 48)")
def _(spark, d):
    g = genotypes(spark, d)
    sites = fx.table(spark, d, "lineitem").where("l_quantity > 48").select(F.col("l_partkey").alias("variant_key"))
    return g.keep_variants(sites).variants


@query("joi13_gene_ranges", """SELECT g.gene_id, v.variant_key, v.contig, v.pos FROM fx_variants v JOIN fx_genes g
  ON g.contig = v.contig AND v.pos BETWEEN g.start_pos AND g.end_pos""")
def _(spark, d):
    v = fx.view(spark, d, "fx_variants").select("variant_key", "contig", "pos")
    return intervals.range_join(v, fx.view(spark, d, "fx_genes")).select("gene_id", "variant_key", "contig", "pos")


PANEL = "SELECT contig, pos, ref, CASE WHEN variant_key % 6 = 0 THEN 'N' ELSE alt END AS alt, variant_key AS panel_key FROM fx_variants WHERE variant_key % 4 <> 1"


@query("joi16_intersect_sites", f"""WITH panel AS ({PANEL}), m AS (SELECT v.contig AS c1, p.contig AS c2 FROM fx_variants v
  FULL OUTER JOIN panel p ON v.contig = p.contig AND v.pos = p.pos AND v.ref = p.ref AND v.alt = p.alt)
  SELECT part, contig, count(*) AS n FROM (
    SELECT 'private_first' AS part, c1 AS contig FROM m WHERE c2 IS NULL UNION ALL SELECT 'private_second', c2 FROM m WHERE c1 IS NULL
    UNION ALL SELECT 'shared_first', c1 FROM m WHERE c1 = c2 UNION ALL SELECT 'shared_second', c2 FROM m WHERE c1 = c2) q GROUP BY part, contig""")
def _(spark, d):
    parts = callsets.intersect_sites(fx.view(spark, d, "fx_variants"), fx.sql(spark, d, PANEL))
    stacked = samples.labelled_union({k: v.select("contig") for k, v in parts.items()}, "part")
    return stacked.groupBy("part", "contig").agg(F.count(F.lit(1)).alias("n"))


SECOND = """SELECT variant_key, sample_key + 5 AS sample_key, CASE WHEN (variant_key + sample_key) % 13 = 0 THEN NULL
  WHEN (variant_key * 3 + sample_key * 5) % 17 = 0 THEN 2 - gt ELSE gt END AS gt FROM fx_entries WHERE variant_key % 9 <> 0"""
SECOND_SAME = SECOND.replace("sample_key + 5 AS sample_key", "sample_key")


def _second(e, shift):
    return e.where("variant_key % 9 <> 0").selectExpr(
        "variant_key", f"sample_key + {shift} AS sample_key",
        "CASE WHEN (variant_key + sample_key) % 13 = 0 THEN NULL WHEN (variant_key * 3 + sample_key * 5) % 17 = 0 THEN 2 - gt ELSE gt END AS gt")


@query("joi17_merge_call_sets", f"""WITH merged AS (SELECT variant_key, sample_key, gt FROM fx_entries WHERE variant_key % 5 <> 0
    UNION ALL SELECT variant_key, sample_key + 100000, gt FROM ({SECOND_SAME}) s)
  SELECT variant_key, count(*) AS n_entries, count(gt) AS n_called, cast(coalesce(sum(gt), 0) AS BIGINT) AS ac FROM merged GROUP BY variant_key""")
def _(spark, d):
    g = genotypes(spark, d)
    first = g.keep_variants(g.variants.where("variant_key % 5 <> 0"))
    other = replace(g, variants=g.variants.where("variant_key % 9 <> 0"), entries=_second(g.entries, 100000),
                    samples=g.samples.withColumn("sample_key", F.col("sample_key") + 100000))
    merged = callsets.merge_call_sets(replace(first, entries=first.entries.select("variant_key", "sample_key", "gt")), other)
    return qc.call_stats(merged.entries).select("variant_key", "n_entries", "n_called", "ac")


PAIRED = f"""WITH second AS ({SECOND_SAME}), s2 AS (SELECT * FROM second{{where}}), pairs AS (
  SELECT coalesce(a.variant_key, b.variant_key) AS variant_key, coalesce(a.sample_key, b.sample_key) AS sample_key,
    CASE WHEN a.variant_key IS NULL THEN 0 WHEN a.gt IS NULL THEN 1 ELSE a.gt + 2 END AS left_state,
    CASE WHEN b.variant_key IS NULL THEN 0 WHEN b.gt IS NULL THEN 1 ELSE b.gt + 2 END AS right_state
  FROM (SELECT * FROM fx_entries WHERE variant_key % 8 <> 3) a FULL OUTER JOIN s2 b ON a.variant_key = b.variant_key AND a.sample_key = b.sample_key)"""
FRACTION = """SELECT {by}, count(*) FILTER (left_state >= 2 AND left_state = right_state) AS concordant,
  count(*) FILTER (left_state >= 2 AND right_state >= 2 AND left_state <> right_state) AS discordant,
  count(*) FILTER (left_state >= 2 AND right_state >= 2) AS total,
  CASE WHEN count(*) FILTER (left_state >= 2 AND right_state >= 2) > 0 THEN round(count(*) FILTER (left_state >= 2 AND left_state = right_state)
    / cast(count(*) FILTER (left_state >= 2 AND right_state >= 2) AS DOUBLE), 8) END AS frac_concordant FROM pairs GROUP BY {by}"""


def _two_sets(spark, d):
    e = fx.view(spark, d, "fx_entries")
    return e.where("variant_key % 8 <> 3"), _second(e, 0)


def _sample_tables(spark, d):
    s = fx.view(spark, d, "fx_samples").select("sample_key")
    return s, s


def _repeated(spark, d):
    """Whether variants repeat, and with them the entries of their samples."""
    keys = fx.view(spark, d, "fx_variants").groupBy("variant_key").agg(F.count(F.lit(1)).alias("n"))
    return keys.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0] > 1


@query("agg15_concordance_states", PAIRED.format(where="") + " SELECT left_state, right_state, count(*) AS n FROM pairs GROUP BY ALL")
def _(spark, d):
    return callsets.paired_states(*_two_sets(spark, d), samples=_sample_tables(spark, d), repeated=_repeated(spark, d))


@query("agg15_concordance_by_sample", PAIRED.format(where="") + FRACTION.format(by="sample_key"))
def _(spark, d):
    return rounded(callsets.concordance(*_two_sets(spark, d), "sample_key", _sample_tables(spark, d), _repeated(spark, d)), "frac_concordant")


@query("agg15_concordance_by_variant_typed", PAIRED.format(where=" WHERE variant_key % 5 = 0 OR variant_key % 7 = 0") + FRACTION.format(by="variant_key"))
def _(spark, d):
    first, second = _two_sets(spark, d)
    sites = fx.view(spark, d, "fx_variants").withColumns(
        {"typed": F.col("variant_key") % 5 == 0, "typed_only": F.col("variant_key") % 7 == 0, "imputed": F.col("variant_key") % 5 != 0})
    subsets = callsets.imputed_subsets(second, sites)
    return rounded(callsets.concordance(first, subsets["typed"], "variant_key", _sample_tables(spark, d), _repeated(spark, d)), "frac_concordant")


@query("joi19_ancestry_presence", """SELECT variant_id, max(CASE WHEN k % 2 = 0 THEN 1e0 ELSE 0e0 END) AS "EUR", max(CASE WHEN k % 3 = 0 THEN 1e0 ELSE 0e0 END) AS "AFR",
  max(CASE WHEN k % 5 = 0 THEN 1e0 ELSE 0e0 END) AS "EAS" FROM (SELECT variant_key AS k, concat(contig, ':', cast(pos AS STRING)) AS variant_id
  FROM fx_variants WHERE variant_key % 2 = 0 OR variant_key % 3 = 0 OR variant_key % 5 = 0) q GROUP BY variant_id""")
def _(spark, d):
    v = fx.view(spark, d, "fx_variants").selectExpr("variant_key", "concat(contig, ':', cast(pos AS STRING)) AS variant_id")
    return samples.ancestry_presence({a: v.where(F.col("variant_key") % m == 0) for a, m in (("EUR", 2), ("AFR", 3), ("EAS", 5))})


@query("agg7_distinct_by", """SELECT l_partkey, l_suppkey, l_quantity, l_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey
  ORDER BY l_quantity, l_orderkey, l_suppkey) AS rn FROM lineitem) q WHERE rn = 1""")
def _(spark, d):
    li = fx.table(spark, d, "lineitem").select("l_partkey", "l_suppkey", "l_quantity", "l_orderkey")
    return samples.distinct_by(li, ["l_partkey"], ["l_quantity", "l_orderkey", "l_suppkey"])


@query("set1_union_chromosomes", "SELECT * FROM fx_variants")
def _(spark, d):
    v = fx.view(spark, d, "fx_variants")
    return samples.union_endpoints([gt.split_chromosome(v, c) for c in [f"chr{i}" for i in range(1, 23)]])


@query("set3_clinical_minus_excluded", "SELECT DISTINCT c_custkey % 700 AS \"Subject_ID\" FROM customer EXCEPT SELECT s_suppkey FROM supplier")
def _(spark, d):
    clinical = fx.table(spark, d, "customer").selectExpr("c_custkey % 700 AS Subject_ID")
    return samples.clinical_minus_excluded(clinical, fx.table(spark, d, "supplier").selectExpr("s_suppkey AS Subject_ID"))


@query("set4_fit_samples", """SELECT DISTINCT sample_key FROM fx_samples WHERE sample_key IN (SELECT l_suppkey FROM lineitem WHERE l_quantity > 10)
  AND sample_key NOT IN (SELECT sample_key FROM fx_samples WHERE grp = 3)""")
def _(spark, d):
    s = fx.view(spark, d, "fx_samples")
    available = fx.table(spark, d, "lineitem").where("l_quantity > 10").selectExpr("l_suppkey AS sample_key")
    return samples.fit_samples(s, available, s.where("grp = 3"))


@query("set5_labelled_union", "SELECT c_custkey AS iid, c_mktsegment AS ancestry FROM customer")
def _(spark, d):
    c = fx.table(spark, d, "customer")
    return samples.labelled_union({a: c.where(F.col("c_mktsegment") == a).selectExpr("c_custkey AS iid") for a in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")})


@query("set7_trait_pairs", "WITH t AS (SELECT DISTINCT p_type AS trait FROM part) SELECT a.trait AS trait_1, b.trait AS trait_2 FROM t a JOIN t b ON a.trait < b.trait")
def _(spark, d):
    return samples.trait_pairs(fx.table(spark, d, "part").selectExpr("p_type AS trait"))


@query("win7_genome_sort", """SELECT variant_key, contig, pos, row_number() OVER (ORDER BY cast(substr(contig, 4) AS INT), pos, ref, alt) - 1 AS place FROM fx_variants""")
def _(spark, d):
    # Places come from the sorted rows themselves: written in order, numbered by file and line, earlier files counted.
    path = scratch_table(spark, "sorted")
    gt.genome_sort(fx.view(spark, d, "fx_variants")).write.parquet(path)
    part = F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("int")
    rows = spark.read.parquet(path).select("variant_key", "contig", "pos", part.alias("part"), F.col("_metadata.row_index").alias("line"))
    before = rows.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select("part", F.coalesce(F.sum("n").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return rows.join(F.broadcast(before), "part").select("variant_key", "contig", "pos", (F.col("before") + F.col("line")).alias("place"))
