"""Queries over summary statistics and colocalisation."""

from __future__ import annotations

from pyspark.sql import functions as F

from genolith import fixtures as fx
from genolith.checks.oracle_math import normal_quantile
from genolith.checks.registry import query, r, rounded
from genolith.operators import coloc as co, sumstats as ss
from genolith.session import durable

EQTL = """SELECT probe_id AS ProbeID, concat('rs', cast(variant_key AS STRING)) AS SNPID, contig AS CHR, pos AS POS, ((variant_key * 53) % 991 + 1) / 1000e0 AS PVAL, beta AS BETA, se AS SE,
  n AS N, a1 AS A1, a2 AS A2, maf AS MAF FROM fx_eqtl"""
BIOM = """SELECT concat('rs', cast(variant_key AS STRING)) AS SNPID, contig AS CHR, pos AS POS, ((variant_key * 37) % 997 + 1) / 1000e0 AS PVAL, est AS BETA, se AS SE, n_obs AS N,
  effect_allele AS A1, other_allele AS A2, freq AS F FROM fx_assoc"""
COMP = "CASE {x} WHEN 'A' THEN 'T' WHEN 'T' THEN 'A' WHEN 'C' THEN 'G' WHEN 'G' THEN 'C' ELSE {x} END"
C1, C2 = COMP.format(x="e.A1"), COMP.format(x="e.A2")
MATCH = f"((b.A1 = e.A1 AND b.A2 = e.A2) OR (b.A1 = e.A2 AND b.A2 = e.A1) OR (b.A1 = {C1} AND b.A2 = {C2}) OR (b.A1 = {C2} AND b.A2 = {C1}))"
MERGED = f"""SELECT e.ProbeID, e.SNPID, b.BETA AS bb, b.SE AS bs, b.PVAL AS bp, b.N AS bn, least(b.F, 1 - b.F) AS bm, e.BETA AS eb, e.SE AS es, e.PVAL AS ep, e.N AS en, e.MAF AS em, b.CHR, b.POS
  FROM ({EQTL}) e JOIN ({BIOM}) b ON b.SNPID = e.SNPID AND {MATCH}"""


def _abf(z, v, w):
    return f"5e-1 * (ln(1 - {w} / ({w} + {v})) + {w} / ({w} + {v}) * {z} * {z})"


L1 = _abf("(bb / bs)", "(bs * bs)", "225e-4")
EV = "(1 / (2 * em * (1 - em) * (en + eb / es * eb / es)))"
L2 = "ln((" + " + ".join(f"exp({_abf('(eb / es)', EV, w)})" for w in ("1e-2", "1e-1", "5e-1")) + ") / 3)"
FACTORS = f"SELECT *, {L1} AS l1, {L2} AS l2, ({L1}) + ({L2}) AS l12 FROM ({MERGED}) m"


def _lse(x):
    return f"max({x}) + ln(sum(exp({x} - {x}m)))"


SUMS = f"""SELECT {{keys}}, count(*) AS nsnps, arg_min(SNPID, struct_pack(a := bp, b := SNPID)) AS snp_biom, arg_min(SNPID, struct_pack(a := ep, b := SNPID)) AS snp_eqtl,
  arg_min(SNPID, struct_pack(a := -l12, b := SNPID)) AS best_causal, min(bp) AS min_pval_biom, min(ep) AS min_pval_eqtl, {_lse('l1')} AS l1, {_lse('l2')} AS l2, {_lse('l12')} AS l12
  FROM (SELECT *, max(l1) OVER w AS l1m, max(l2) OVER w AS l2m, max(l12) OVER w AS l12m FROM ({{src}}) f WINDOW w AS (PARTITION BY {{keys}})) f GROUP BY {{keys}} HAVING count(*) > {{min}}"""
LOCI = SUMS.format(keys="ProbeID", src=FACTORS, min=50)
LH = f"""SELECT ProbeID, nsnps, 0e0 AS lH0_abf, l1 - ln(nsnps) AS lH1_abf, l2 - ln(nsnps) AS lH2_abf, l1 + l2 + ln(1 - exp(l12 - l1 - l2)) - 2 * ln(nsnps) AS lH3_abf, l12 - ln(nsnps) AS lH4_abf FROM ({LOCI}) l"""
PRIORS = [1.0, co.P1, co.P2, co.P1 * co.P2, co.P12]
TERMS = [f"{t} + ln({p!r})" if "e" in repr(p) else f"{t} + ln({p!r}e0)" for t, p in zip(["0e0", "l1", "l2", "l1 + l2 + ln(1 - exp(l12 - l1 - l2))", "l12"], PRIORS)]
POST = f"""SELECT ProbeID, {', '.join(f'round(exp(t{h} - m) / (exp(t0 - m) + exp(t1 - m) + exp(t2 - m) + exp(t3 - m) + exp(t4 - m)), 7) AS PP{h}_coloc_priors' for h in range(5))} FROM (
  SELECT *, greatest(t0, t1, t2, t3, t4) AS m FROM (SELECT ProbeID, {', '.join(f'{t} AS t{h}' for h, t in enumerate(TERMS))} FROM ({LOCI}) l) t) q"""


def eqtl(spark, d):
    return fx.sql(spark, d, EQTL)


def biom(spark, d):
    return fx.sql(spark, d, BIOM)


OPTIONS = co.ColocOptions()


def factors(spark, d, options=OPTIONS):
    return co.bayes_factors(co.merged_loci(eqtl(spark, d), biom(spark, d), options), options)


@query("joi9_allele_aware_merge", f"SELECT ProbeID, SNPID, bb AS BETA_biom, eb AS BETA_eqtl FROM ({MERGED}) m")
def _(spark, d):
    return ss.allele_aware_merge(biom(spark, d), eqtl(spark, d)).select(F.col("ProbeID_eqtl").alias("ProbeID"), "SNPID", "BETA_biom", "BETA_eqtl")


@query("joi10_best_key", f"""SELECT 'chrpos' AS choice, e.ProbeID, count(*) AS n FROM ({EQTL}) e JOIN ({BIOM}) b ON b.CHR = e.CHR AND b.POS = e.POS GROUP BY e.ProbeID""")
def _(spark, d):
    other_ids = biom(spark, d).withColumn("SNPID", F.when(F.substring("SNPID", -1, 1) != "3", F.concat(F.lit("v"), "SNPID")).otherwise(F.col("SNPID")))
    b, e, choice = co.best_key(co.bare_chromosome(other_ids), co.bare_chromosome(eqtl(spark, d)))
    return b.select("SNPID").join(e, "SNPID").groupBy("ProbeID").agg(F.count(F.lit(1)).alias("n")).withColumn("choice", F.lit(choice))


EXTENT = f"SELECT ProbeID, min(CHR) AS chrom, min(POS) AS pos_start, max(POS) AS pos_end, min(PVAL) AS min_p FROM ({EQTL}) e GROUP BY ProbeID"


@query("agg16_probe_extent", EXTENT)
def _(spark, d):
    return co.probe_extent(eqtl(spark, d))


@query("joi11_locus_variants", f"SELECT x.ProbeID, b.SNPID, b.POS FROM ({BIOM}) b JOIN ({EXTENT}) x ON b.CHR = x.chrom AND b.POS BETWEEN x.pos_start AND x.pos_end")
def _(spark, d):
    return co.locus_variants(biom(spark, d), co.probe_extent(eqtl(spark, d))).select("ProbeID", "SNPID", "POS")


BED = "SELECT contig AS CHR, start_pos, end_pos, gene_id AS bed_region FROM fx_genes"


@query("joi12_split_by_region", f"SELECT m.ProbeID, m.SNPID, g.bed_region FROM ({MERGED}) m JOIN ({BED}) g ON g.CHR = m.CHR AND m.POS BETWEEN g.start_pos AND g.end_pos")
def _(spark, d):
    merged = ss.allele_aware_merge(biom(spark, d), eqtl(spark, d)).withColumnsRenamed({"ProbeID_eqtl": "ProbeID", "CHR_biom": "CHR"})
    return co.split_by_region(merged.select("ProbeID", "SNPID", "CHR", "POS_biom"), fx.sql(spark, d, BED)).select("ProbeID", "SNPID", "bed_region")


DUP = """SELECT l_orderkey, l_linenumber, concat('rs', cast(l_partkey % 50000 AS STRING)) AS SNPID, l_returnflag AS ProbeID, repeat('A', cast(l_linenumber AS INT)) AS A1, 'C' AS A2 FROM lineitem"""


@query("agg19_remove_duplicates", f"""SELECT l_orderkey, l_linenumber, SNPID, ProbeID FROM (SELECT *, count(*) OVER (PARTITION BY ProbeID, SNPID) AS n,
  row_number() OVER (PARTITION BY ProbeID, SNPID ORDER BY length(A1) + length(A2) DESC, l_orderkey, l_linenumber) AS rn FROM ({DUP}) d) q WHERE n = 1 OR rn > 1""")
def _(spark, d):
    out = co.remove_duplicates(fx.sql(spark, d, DUP), ["ProbeID", "SNPID"], co.allele_length(), ["l_orderkey", "l_linenumber"])
    return out.select("l_orderkey", "l_linenumber", "SNPID", "ProbeID")


@query("agg20_trait_sd", f"""SELECT round(sqrt(median((2 * em * (1 - em) * bn * bs * bs * (bn - 1) + 2 * em * (1 - em) * bn * bb * bb) / (bn - 1))), 8) AS sd_y FROM ({MERGED}) m""")
def _(spark, d):
    m = ss.allele_aware_merge(biom(spark, d), eqtl(spark, d))
    c = F.col
    return rounded(co.trait_sd(m, c("SE_biom") * c("SE_biom"), c("MAF_eqtl"), c("N_biom"), c("BETA_biom")), "sd_y")


@query("col2_bayes_factors", f"SELECT ProbeID, SNPID, round(l1, 7) AS l1, round(l2, 7) AS l2, round(l12, 7) AS l12 FROM ({FACTORS}) f WHERE ProbeID IN (SELECT ProbeID FROM ({LOCI}) l)")
def _(spark, d):
    out = factors(spark, d)
    return out.select("ProbeID", "SNPID", r("lABF_biom", 7).alias("l1"), r("lABF_eqtl", 7).alias("l2"), r("lABF_sum", 7).alias("l12"))


@query("agg21_log_sums", f"SELECT ProbeID, nsnps, round(l1, 6) AS l1, round(l2, 6) AS l2, round(l12, 6) AS l12, round(l1 + l2 + ln(1 - exp(l12 - l1 - l2)), 6) AS log_difference FROM ({LOCI}) l")
def _(spark, d):
    out = co.locus_sums(factors(spark, d))
    diff = co.log_diff(F.col("l1") + F.col("l2"), F.col("l12"))
    return out.select("ProbeID", "nsnps", *[r(c, 6).alias(c) for c in ("l1", "l2", "l12")], r(diff, 6).alias("log_difference"))


@query("win6_lead_snps", f"SELECT ProbeID, snp_biom, snp_eqtl, best_causal, min_pval_biom, min_pval_eqtl FROM ({LOCI}) l")
def _(spark, d):
    return co.locus_sums(factors(spark, d)).select("ProbeID", "snp_biom", "snp_eqtl", "best_causal", "min_pval_biom", "min_pval_eqtl")


@query("col4_posterior", POST)
def _(spark, d):
    sums = co.locus_sums(factors(spark, d))
    out = co.coloc_posterior(sums, p12=co.P12)
    return rounded(out.select("ProbeID", *[f"PP{h}_coloc_priors" for h in range(5)]), *[f"PP{h}_coloc_priors" for h in range(5)], digits=7)


@query("col5_locus_likelihoods", f"SELECT ProbeID, nsnps, lH0_abf, {', '.join(f'round(lH{h}_abf, 6) AS lH{h}_abf' for h in range(1, 5))} FROM ({LH}) l")
def _(spark, d):
    out = co.locus_likelihoods(co.locus_sums(factors(spark, d)))
    return rounded(out.select("ProbeID", "nsnps", *co.LIKELIHOODS), *co.LIKELIHOODS[1:], digits=6)


PV = "(1 / (2 * bn * em * (1 - em)))"  # the frequency of the eQTL set serves both
PEV = "(1 / (2 * em * (1 - em) * (en + z2 * z2)))"
P_FACTORS = f"""SELECT ProbeID, SNPID, {_abf('z1', PV, repr(co.SD_PVALUE ** 2) + 'e0')} AS l1, ln(({' + '.join(f"exp({_abf('z2', PEV, w)})" for w in ("1e-2", "1e-1", "5e-1"))}) / 3) AS l2
  FROM (SELECT *, -{normal_quantile('hb')} AS z1, -{normal_quantile('he')} AS z2 FROM (SELECT *, bp / 2 AS hb, ep / 2 AS he FROM ({MERGED}) m) h) z"""


@query("col3_p_value_factors", f"SELECT ProbeID, SNPID, round(l1, 7) AS l1, round(l2, 7) AS l2 FROM ({P_FACTORS}) f WHERE ProbeID IN (SELECT ProbeID FROM ({LOCI}) l)")
def _(spark, d):
    options = co.ColocOptions(use_beta=False)
    return factors(spark, d, options).select("ProbeID", "SNPID", r("lABF_biom", 7).alias("l1"), r("lABF_eqtl", 7).alias("l2"))


@query("col1_coloc")
def _(spark, d):
    return co.coloc(eqtl(spark, d), biom(spark, d), OPTIONS).drop("bed_region")


@query("col1_coloc_by_region")
def _(spark, d):
    # Wide blocks, so that every block keeps several variants.
    bed = fx.sql(spark, d, "SELECT contig AS CHR, start_pos, end_pos + 400000 AS end_pos, gene_id AS bed_region FROM fx_genes")
    return co.coloc(eqtl(spark, d), biom(spark, d), OPTIONS, bed)


@query("col8_coloc_fixed_priors", f"SELECT p.*, nsnps, best_causal FROM ({POST}) p JOIN ({LOCI}) l ON l.ProbeID = p.ProbeID")
def _(spark, d):
    out = co.coloc_loci(eqtl(spark, d), biom(spark, d), OPTIONS)
    pp = [f"PP{h}_coloc_priors" for h in range(5)]
    return rounded(out.select("ProbeID", "nsnps", "best_causal", *pp), *pp, digits=7)


@query("col6_fitted_priors")
def _(spark, d):
    table = co.likelihood_table(co.coloc_loci(eqtl(spark, d), biom(spark, d), OPTIONS))
    five, four = co.fit_priors(table), co.fit_priors_four(table)
    rows = [("five", h, float(p)) for h, p in enumerate(five)] + [("four", h, float(p)) for h, p in enumerate(four)]
    return spark.createDataFrame(rows, "form string, hypothesis int, weight double")


@query("col7_bootstrap_priors")
def _(spark, d):
    table = co.likelihood_table(co.coloc_loci(eqtl(spark, d), biom(spark, d), OPTIONS))
    return co.bootstrap_priors(table, 100)


@query("col9_snp_output", f"SELECT f.ProbeID, f.SNPID, round(exp(f.l12 - l.l12), 7) AS SNP_PP_H4 FROM ({FACTORS}) f JOIN ({LOCI}) l ON l.ProbeID = f.ProbeID")
def _(spark, d):
    f = durable(factors(spark, d))
    return co.snp_posterior(f, co.locus_sums(f)).select("ProbeID", "SNPID", r("SNP_PP_H4", 7).alias("SNP_PP_H4"))


REPORT = "SELECT l_orderkey, l_linenumber, l_discount * 10 AS PP_H4_abf, CASE WHEN l_tax > 4e-2 THEN 1e-6 ELSE 1e-4 END AS min_pval_biom FROM lineitem"


@query("flt19_coloc_report", f"SELECT * FROM ({REPORT}) q WHERE PP_H4_abf > 2e-1 AND min_pval_biom < 1e-5")
def _(spark, d):
    return co.coloc_report(fx.sql(spark, d, REPORT))


# --- summary statistics ------------------------------------------------------


@query("flt18_sumstats_filter", """SELECT variant_key, round(CASE WHEN f < 5e-1 THEN f ELSE 1 - f END, 8) AS "MAF" FROM (SELECT variant_key, (variant_key % 997) / 1000e0 AS f, (variant_key * 7 % 100) / 100e0 AS info FROM fx_variants) q
  WHERE info > 6e-1 AND CASE WHEN f < 5e-1 THEN f ELSE 1 - f END > 1e-3""")
def _(spark, d):
    t = fx.sql(spark, d, "SELECT variant_key, (variant_key % 997) / 1000e0 AS F, (variant_key * 7 % 100) / 100e0 AS info FROM fx_variants")
    return rounded(ss.filter_sumstats(t).select("variant_key", "MAF"), "MAF")


@query("flt23_complete_cases", "SELECT event_id, event_type, value FROM events WHERE event_type <> 'view' AND event_id % 9 <> 0")
def _(spark, d):
    t = fx.table(spark, d, "events").select("event_id", F.when(F.col("event_type") != "view", F.col("event_type")).alias("event_type"),
                                            F.when(F.col("event_id") % 9 != 0, F.col("value")).otherwise(F.lit(float("nan"))).alias("value"))
    return ss.complete_cases(t)


GTEX = """SELECT concat(contig, '_', cast(pos AS STRING), '_', ref, '_', alt, '_b38') AS variant_id, concat('ENSG', cast(variant_key % 22 AS STRING)) AS gene_id, variant_key / 100e0 AS slope, 5e-1 AS slope_se,
  1e-1 AS maf, 1e-2 AS pval_beta, contig, pos, ref, alt FROM fx_variants"""


@query("prj11_gtex_eqtl", f"""SELECT variant_id AS "SNPID", contig AS "CHR", pos AS "POS", alt AS "A1", ref AS "A2", slope AS "BETA", slope_se AS "SE", maf AS "F", pval_beta AS "PVAL", gene_id AS "ProbeID", 948 AS "N" FROM ({GTEX}) g""")
def _(spark, d):
    return ss.format_gtex_eqtl(fx.sql(spark, d, GTEX))


BIM = "SELECT cast(p_partkey % 22 + 1 AS STRING) AS chrom, concat('rs', cast(p_partkey AS STRING)) AS snpid, 0e0 AS cm, cast(p_partkey % 1700 AS BIGINT) AS pos, 'A' AS A1, p_brand AS A2 FROM part"
PASS = "SELECT concat('G', cast(l_suppkey AS STRING)) AS pid, cast(l_partkey % 22 + 1 AS STRING) AS chromTopVar, cast(l_partkey % 1700 AS BIGINT) AS startTopVar, l_discount AS nominalPVal, l_tax AS regressionSlope FROM lineitem"


@query("prj12_cohort_eqtl", f"""WITH bim AS ({BIM}), one AS (SELECT chrom, pos FROM bim GROUP BY chrom, pos HAVING count(*) = 1) SELECT pid AS "ProbeID", snpid AS "SNPID", concat('chr', chromTopVar) AS "CHR", startTopVar AS "POS",
  A1 AS "A1", A2 AS "A2", regressionSlope AS "BETA", nominalPVal AS "PVAL" FROM ({PASS}) p JOIN one ON one.chrom = chromTopVar AND one.pos = startTopVar JOIN bim ON bim.chrom = one.chrom AND bim.pos = one.pos""")
def _(spark, d):
    return ss.format_cohort_eqtl(fx.sql(spark, d, PASS), fx.sql(spark, d, BIM))


@query("agg23_sample_count", """SELECT c_custkey, (SELECT count(*) FROM supplier) AS "N" FROM customer""")
def _(spark, d):
    return ss.with_sample_count(fx.table(spark, d, "customer").select("c_custkey"), fx.table(spark, d, "supplier")).withColumn("N", F.col("N").cast("bigint"))


ASSOC = """SELECT concat(contig, ':', cast(pos AS STRING)) AS variant_id, contig, pos, effect_allele, other_allele, freq, ((variant_key * 37) % 997 + 1) / 1000e0 AS score_pval, est, se AS est_se, n_obs, variant_key FROM fx_assoc"""
PANEL = """SELECT concat('panel_', cast(variant_key AS STRING)) AS panel_variant_id, contig AS chromosome, pos AS position, CASE WHEN variant_key % 3 = 0 THEN alt ELSE ref END AS panel_non_effect,
  CASE WHEN variant_key % 3 = 0 THEN ref WHEN variant_key % 5 = 0 THEN 'N' ELSE alt END AS panel_effect FROM fx_variants WHERE variant_key % 7 <> 0"""


@query("prj9_harmonize_gwas", f"""SELECT variant_id, panel_variant_id, chromosome, position, panel_effect AS effect_allele, panel_non_effect AS non_effect_allele,
  round(CASE WHEN effect_allele = panel_effect THEN freq ELSE 1 - freq END, 8) AS frequency, score_pval AS pvalue, round(CASE WHEN effect_allele = panel_effect THEN est ELSE -est END / est_se, 8) AS zscore,
  CASE WHEN effect_allele = panel_effect THEN est ELSE -1 * est END AS effect_size, est_se AS standard_error, n_obs AS sample_size FROM ({ASSOC}) a JOIN ({PANEL}) p ON a.contig = p.chromosome AND a.pos = p.position
  AND ((effect_allele = panel_effect AND other_allele = panel_non_effect) OR (effect_allele = panel_non_effect AND other_allele = panel_effect))""")
def _(spark, d):
    return rounded(ss.harmonize_gwas(fx.sql(spark, d, ASSOC), fx.sql(spark, d, PANEL)), "frequency", "zscore")


MUNGE = f"""SELECT concat('rs', cast(variant_key % 1500 AS STRING)) AS variant_id, CASE WHEN variant_key % 10 = 0 THEN 'A' ELSE effect_allele END AS effect_allele, CASE WHEN variant_key % 10 = 0 THEN 'T' ELSE other_allele END AS other_allele,
  CASE WHEN variant_key % 19 <> 0 THEN n_obs END AS n_obs, freq, CASE WHEN variant_key % 23 = 0 THEN 0e0 ELSE score_pval END AS score_pval, est FROM ({ASSOC}) a"""


@query("prj10_munge_sumstats", f"""SELECT SNP AS "SNP", A1 AS "A1", A2 AS "A2", N AS "N" FROM (SELECT variant_id AS SNP, effect_allele AS A1, other_allele AS A2, cast(n_obs AS DOUBLE) AS N, row_number() OVER (PARTITION BY variant_id
  ORDER BY effect_allele, other_allele, n_obs, freq, score_pval, est) AS rn FROM ({MUNGE}) m WHERE n_obs IS NOT NULL AND score_pval > 0 AND score_pval <= 1 AND freq > 1e-2 AND 1 - freq > 1e-2
  AND concat(effect_allele, other_allele) NOT IN ('AT', 'TA', 'CG', 'GC')) q WHERE rn = 1""")
def _(spark, d):
    return ss.munge_sumstats(fx.sql(spark, d, MUNGE)).select("SNP", "A1", "A2", "N")


@query("prj10_munged_z", f"""SELECT SNP AS "SNP", round(CASE WHEN est > 0 THEN -1 WHEN est < 0 THEN 1 ELSE 0 END * {normal_quantile('h')}, 7) AS "Z" FROM (SELECT variant_id AS SNP, est, score_pval / 2 AS h, row_number() OVER (PARTITION BY variant_id
  ORDER BY effect_allele, other_allele, n_obs, freq, score_pval, est) AS rn FROM ({MUNGE}) m WHERE n_obs IS NOT NULL AND score_pval > 0 AND score_pval <= 1 AND freq > 1e-2 AND 1 - freq > 1e-2
  AND concat(effect_allele, other_allele) NOT IN ('AT', 'TA', 'CG', 'GC')) q WHERE rn = 1""")
def _(spark, d):
    return ss.munge_sumstats(fx.sql(spark, d, MUNGE)).select("SNP", r("Z", 7).alias("Z"))
