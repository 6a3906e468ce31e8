"""Queries over null models, association tests and meta-analysis."""

from __future__ import annotations

from pyspark.sql import functions as F

from genolith import fixtures as fx
from genolith.checks.genotype_checks import CALLS, HWE
from genolith.checks.oracle_math import two_sided
from genolith.checks.registry import genotypes, query, r, rounded
from genolith.operators import association as assoc, genes, meta, mixed, models, ranking, saddlepoint
from genolith.plans import gwas as plan


def subjects(spark, d):
    s = fx.view(spark, d, "fx_samples")
    return s.select("sample_key", "trait", F.col("is_case").cast("double").alias("is_case"), F.col("is_female").cast("double").alias("sex"),
                    F.col("grp").cast("double").alias("grp"), (F.col("sample_key") % 7).cast("double").alias("day"),
                    ((F.col("sample_key") * 37) % 41).cast("double").alias("age"))


# Residual y and one-covariate projection in closed form.
SUBJECTS = "SELECT sample_key, trait AS y, is_female AS x FROM fx_samples"
SCORE = """subj AS ({subjects}), moments AS (SELECT avg(y) AS my, avg(x) AS mx, count(*) AS n, covar_pop(y, x) AS cxy, var_pop(x) AS vx FROM subj),
  fit AS (SELECT sample_key, x - mx AS x, y - my - cxy / vx * (x - mx) AS res FROM subj, moments),
  s2 AS (SELECT sum(res * res) / (count(*) - 2) AS s2, sum(x * x) AS sxx, count(*) AS n FROM fit),
  obs AS (SELECT e.variant_key, count(*) AS n_obs, avg(e.gt) AS m FROM {entries} e JOIN fit USING (sample_key) WHERE e.gt IS NOT NULL GROUP BY e.variant_key),
  filled AS (SELECT o.variant_key, f.x, f.res, coalesce(e.gt, o.m) AS g FROM obs o CROSS JOIN fit f LEFT JOIN {entries} e ON e.variant_key = o.variant_key AND e.sample_key = f.sample_key),
  uv AS (SELECT variant_key, sum(g * res) / any_value(s2) AS score, (sum(g * g) - sum(g) * sum(g) / any_value(n) - sum(g * filled.x) * sum(g * filled.x) / any_value(sxx)) / any_value(s2) AS v FROM filled, s2 GROUP BY variant_key),
  tested AS (SELECT variant_key, n_obs, m / 2 AS freq, score, v, score / sqrt(v) AS z FROM uv JOIN obs USING (variant_key) WHERE v > 1e-9)"""


def score_oracle(entries="fx_entries", subjects=SUBJECTS):
    return SCORE.format(entries=entries, subjects=subjects)


def _fitted(spark, d, outcome="trait", covariates=("sex",)):
    data = subjects(spark, d)
    model = models.fit_models(data, outcome, {"m": list(covariates)})[0]
    return assoc.score_model(data, outcome, model)


# --- flagship ----------------------------------------------------------------

KEPT = f"""calls0 AS (SELECT * FROM ({CALLS.format(entries='fx_entries')}) c0),
  good_s AS (SELECT sample_key FROM (SELECT sample_key, avg(dp) AS dpm, avg(gq) AS gqm, count(gt) / cast(count(*) AS DOUBLE) AS cr FROM fx_entries GROUP BY sample_key) s WHERE dpm > 24 AND cr > 85e-2 AND gqm > 40),
  e1 AS (SELECT e.* FROM fx_entries e JOIN good_s USING (sample_key)),
  calls AS ({CALLS.format(entries='e1')}), hwe AS ({HWE}),
  good_v AS (SELECT c.variant_key FROM calls c JOIN hwe USING (variant_key) WHERE c.dp_mean > 25 AND c.call_rate > 9e-1 AND c.gq_mean > 40
    AND c.af > 1e-2 AND 1 - c.af > 1e-2 AND p_hwe > 1e-6),
  e2 AS (SELECT e.* FROM e1 e JOIN good_v USING (variant_key))"""


@query("gwa1_flagship", f"""WITH {KEPT}, {score_oracle('e2', SUBJECTS + ' JOIN good_s USING (sample_key)')}
  SELECT t.variant_key, v.contig, v.pos, v.alt AS effect_allele, v.ref AS other_allele, n_obs, round(freq, 8) AS freq, round(score / v, 6) AS est, round(1 / sqrt(v), 6) AS est_se,
  round(z, 6) AS score_stat, round({two_sided('z')}, 7) AS score_pval, round(least(1, {two_sided('z')} * count(*) OVER ()), 6) AS bonferroni FROM tested t JOIN fx_variants v USING (variant_key)""".replace("score / v,", "score / t.v,").replace("1 / sqrt(v)", "1 / sqrt(t.v)"))
def _(spark, d):
    out = plan.association_scan(genotypes(spark, d), subjects(spark, d), "trait", ["sex"])
    out = out.where("score_var IS NOT NULL").select("variant_key", "contig", "pos", "effect_allele", "other_allele", "n_obs", "freq", "est", "est_se", "score_stat", "score_pval", "bonferroni")
    out = rounded(rounded(out, "freq"), "est", "est_se", "score_stat", "bonferroni", digits=6)
    return rounded(out, "score_pval", digits=7)


@query("gwa1_score_test", f"WITH {score_oracle()} SELECT variant_key, n_obs, round(freq, 8) AS freq, round(score, 6) AS score, round(z, 6) AS score_stat, round({two_sided('z')}, 7) AS score_pval FROM tested")
def _(spark, d):
    out = assoc.score_test(fx.view(spark, d, "fx_entries"), _fitted(spark, d)).where("score_var IS NOT NULL")
    out = out.select("variant_key", "n_obs", r("freq").alias("freq"), r("score", 6).alias("score"), r("score_stat", 6).alias("score_stat"), r("score_pval", 7).alias("score_pval"))
    return out


@query("gwa1_score_test_binary")
def _(spark, d):
    g = genotypes(spark, d)
    return assoc.gwas(g.entries, g.variants, _fitted(spark, d, "is_case", ("sex", "age")))


@query("agg17_case_control_n", """SELECT variant_key, count(*) FILTER (is_case = 1) AS n_cases, count(*) FILTER (is_case = 0) AS n_controls
  FROM fx_entries e JOIN fx_samples s USING (sample_key) WHERE gt IS NOT NULL GROUP BY variant_key""")
def _(spark, d):
    return assoc.case_control_counts(fx.view(spark, d, "fx_entries"), subjects(spark, d), "is_case")


@query("joi18_alleles", """SELECT p.l_partkey AS variant_key, p.q, v.contig, v.pos, v.alt AS effect_allele, v.ref AS other_allele
  FROM (SELECT l_partkey * 2 AS l_partkey, sum(l_quantity) AS q FROM lineitem GROUP BY l_partkey) p LEFT JOIN fx_variants v ON v.variant_key = p.l_partkey""")
def _(spark, d):
    stats = fx.table(spark, d, "lineitem").groupBy((F.col("l_partkey") * 2).alias("variant_key")).agg(F.sum("l_quantity").alias("q"))
    return assoc.with_alleles(stats, fx.view(spark, d, "fx_variants"))


# --- summary tables ----------------------------------------------------------

TABLE = """SELECT variant_key, concat(contig, ':', cast(pos AS STRING), ':', other_allele, ':', effect_allele) AS variant_id, contig, pos, effect_allele, other_allele,
  n_obs, freq, est, se AS est_se, est / se AS score_stat, ((variant_key * 37) % 997 + 1) / 1000e0 AS score_pval FROM fx_assoc"""


def table(spark, d):
    return fx.sql(spark, d, TABLE)


@query("prj7_locuszoom", f"""SELECT contig AS "CHR", pos AS "POS", freq AS "FREQ", other_allele AS "REF", effect_allele AS "ALT", score_pval AS "PVAL", est AS "BETA", est_se AS "SE" FROM ({TABLE}) t""")
def _(spark, d):
    return assoc.to_locuszoom(table(spark, d))


MEGA = """SELECT variant_id AS "MARKERNAME", substr(contig, 4) AS "CHROMOSOME", pos AS "POSITION", n_obs AS "N", freq AS "EAF", effect_allele AS "EA", other_allele AS "NEA","""


@query("prj8_mrmega_binary", MEGA + f""" round(exp(est), 8) AS "OR", round(exp(est - 196e-2 * est_se), 8) AS "OR_95L", round(exp(est + 196e-2 * est_se), 8) AS "OR_95U" FROM ({TABLE}) t""")
def _(spark, d):
    return rounded(assoc.to_mrmega(table(spark, d).withColumn("n_cases", F.lit(1))), "OR", "OR_95L", "OR_95U")


@query("prj8_mrmega_quantitative", MEGA + f""" est AS "BETA", est_se AS "SE" FROM ({TABLE}) t""")
def _(spark, d):
    return assoc.to_mrmega(table(spark, d))


@query("flt20_plot_ready", f"SELECT variant_key, contig, round(-log10(p), 8) AS log10p FROM (SELECT *, CASE WHEN variant_key % 50 <> 0 THEN score_pval END AS p FROM ({TABLE}) t) q WHERE p > 0")
def _(spark, d):
    t = table(spark, d).withColumn("score_pval", F.when(F.col("variant_key") % 50 != 0, F.col("score_pval")))
    return rounded(assoc.plot_ready(t).select("variant_key", "contig", "log10p"), "log10p")


@query("win10_manhattan", f"""WITH t AS (SELECT *, cast(substr(contig, 4) AS INT) AS i FROM ({TABLE}) t), l AS (SELECT i, max(pos) AS len FROM t GROUP BY i),
  o AS (SELECT i, coalesce(sum(len) OVER (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off FROM l)
  SELECT variant_key, cast(pos + off AS BIGINT) AS x, round(-log10(score_pval), 8) AS log10p FROM t JOIN o USING (i)""")
def _(spark, d):
    return rounded(assoc.manhattan_table(table(spark, d)).select("variant_key", "x", "log10p"), "log10p")


@query("win9_qq_table", f"""SELECT rank, round(-log10((rank - 5e-1) / n), 8) AS expected, round(-log10(score_pval), 8) AS observed FROM
  (SELECT score_pval, row_number() OVER (ORDER BY score_pval) AS rank, count(*) OVER () AS n FROM ({TABLE}) t) q""")
def _(spark, d):
    return rounded(ranking.qq_table(table(spark, d), "score_pval"), "expected", "observed")


BH = """SELECT {cols}, round(min(least(1, p * n / k)) OVER (PARTITION BY {by} ORDER BY p ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 8) AS {fdr}, round(least(1, p * n), 8) AS {bonf} FROM (
  SELECT *, count(*) OVER (PARTITION BY {by}) AS n, count(*) OVER (PARTITION BY {by} ORDER BY p) AS k FROM ({src}) s) q"""


@query("win11_bh_adjust", BH.format(cols="variant_key, p", by="1", fdr="fdr", bonf="bonferroni", src=f"SELECT variant_key, score_pval AS p FROM ({TABLE}) t"))
def _(spark, d):
    return rounded(ranking.adjust_p(table(spark, d).select("variant_key", F.col("score_pval").alias("p")), "p"), "fdr", "bonferroni")


@query("win12_bonferroni", f"SELECT variant_key, round(least(1, score_pval * count(*) OVER ()), 8) AS bonferroni FROM ({TABLE}) t")
def _(spark, d):
    return rounded(ranking.adjust_p(table(spark, d).select("variant_key", "score_pval"), "score_pval").select("variant_key", "bonferroni"), "bonferroni")


GENE_ROWS = """SELECT l_orderkey, l_linenumber, l_returnflag AS phenotype, CASE WHEN l_suppkey % 10 = 0 THEN 'Meta' ELSE l_linestatus END AS tissue,
  ((l_partkey * 7 + l_suppkey * 13 + l_orderkey) % 4999 + 1) / 5000e0 AS p FROM lineitem"""


@query("win13_adjust_by_phenotype", BH.format(cols="l_orderkey, l_linenumber, phenotype, tissue, p", by="phenotype", fdr="fdr_phenotype", bonf="bonferroni_phenotype", src=f"SELECT * FROM ({GENE_ROWS}) g WHERE tissue <> 'Meta'")
       + f" UNION ALL SELECT l_orderkey, l_linenumber, phenotype, tissue, p, NULL, NULL FROM ({GENE_ROWS}) g WHERE tissue = 'Meta'")
def _(spark, d):
    return rounded(ranking.adjust_by_phenotype(fx.sql(spark, d, GENE_ROWS), "p"), "fdr_phenotype", "bonferroni_phenotype")


@query("agg18_gwas_report", """SELECT s.trait, round(median(z * z) / 45493642311957283e-17, 8) AS lambda, count(*) FILTER (p < 5e-8) AS gwas_hits,
  any_value(m.pcs) AS pcs, any_value(m.age) AS age, any_value(m.sex) AS sex FROM (SELECT l_returnflag AS trait, (l_quantity - 25) / 9e0 AS z, CASE WHEN l_tax > 79e-3 THEN 1e-9 ELSE 5e-1 END AS p FROM lineitem) s
  JOIN (SELECT l_returnflag AS trait, CASE l_returnflag WHEN 'A' THEN 2 WHEN 'N' THEN 0 ELSE 1 END AS pcs, l_returnflag <> 'N' AS age, l_returnflag = 'R' AS sex FROM lineitem GROUP BY l_returnflag) m ON m.trait = s.trait GROUP BY s.trait""")
def _(spark, d):
    li = fx.table(spark, d, "lineitem")
    rows = li.selectExpr("l_returnflag AS trait", "(l_quantity - 25) / 9e0 AS score_stat", "CASE WHEN l_tax > 79e-3 THEN 1e-9 ELSE 5e-1 END AS score_pval")
    described = li.select("l_returnflag").distinct().selectExpr("l_returnflag AS trait",
        "CASE l_returnflag WHEN 'A' THEN array('age', 'pc1', 'pc2') WHEN 'N' THEN array('day') ELSE array('age', 'sex', 'pc1') END AS covariates")
    return rounded(assoc.gwas_report(rows, described, {"age": "age", "sex": "sex"}), "lambda").withColumn("pcs", F.col("pcs").cast("int"))


# --- null models -------------------------------------------------------------

GROUPS = {"age": ["age"], "sex": ["sex"], "day": ["day"], "site": ["grp"]}


def _with_gaps(spark, d):
    return subjects(spark, d).withColumn("day", F.when(F.col("sample_key") % 5 != 0, F.col("day")))


@query("nul1_covariate_subsets", """SELECT covariates, cast(CASE WHEN list_contains(c, 'day') THEN known ELSE n END AS INT) AS n FROM (SELECT c, array_to_string(c, ',') AS covariates FROM (
  SELECT list_transform(list_filter(range(1, 5), lambda i: (m >> (i - 1)) % 2 = 1), lambda i: ['age', 'sex', 'day', 'grp'][i]) AS c FROM (SELECT unnest(range(1, 16)) AS m) a) b) s,
  (SELECT count(*) AS n, count(*) FILTER (sample_key % 5 <> 0) AS known FROM fx_samples) k""")
def _(spark, d):
    # Every subset of the covariate groups with the number of its complete subjects.
    fits = models.exhaustive_search(_with_gaps(spark, d), "trait", GROUPS)
    return models.models_table(spark, fits).select(F.array_join("covariates", ",").alias("covariates"), "n")


@query("nul2_exhaustive_search")
def _(spark, d):
    fits = models.exhaustive_search(subjects(spark, d), "trait", GROUPS)
    return models.models_table(spark, fits)


@query("nul2_exhaustive_search_binary")
def _(spark, d):
    fits = models.exhaustive_search(subjects(spark, d), "is_case", GROUPS)
    return models.models_table(spark, fits)


ONE = "regr_sxx(trait, {x}) AS sxx_{x}, regr_syy(trait, {x}) - regr_sxy(trait, {x}) * regr_sxy(trait, {x}) / regr_sxx(trait, {x}) AS rss_{x}"
DATA = "SELECT sample_key, trait, cast(is_female AS DOUBLE) AS sex, cast(sample_key % 7 AS DOUBLE) AS day, cast((sample_key * 37) % 41 AS DOUBLE) AS age FROM fx_samples"
AIC = "round(n * (ln(2 * pi()) + ln(rss_{x} / n) + 1) + 6, 6)"


@query("win8_best_model", f"""SELECT arg_min(model, aic) AS model, min(aic) AS aic FROM (SELECT unnest(['age', 'day', 'sex']) AS model, unnest([{', '.join(AIC.format(x=x) for x in ('age', 'day', 'sex'))}]) AS aic
  FROM (SELECT count(*) AS n, {', '.join(ONE.format(x=x) for x in ('age', 'day', 'sex'))} FROM ({DATA}) d) q) m""")
def _(spark, d):
    fits = models.fit_models(subjects(spark, d), "trait", {x: [x] for x in ("age", "day", "sex")})
    return models.best_model(models.models_table(spark, fits)).select("model", r("aic", 6).alias("aic"))


@query("nul2_gaussian_aic", f"""SELECT unnest(['age', 'day', 'sex']) AS model, unnest([{', '.join(AIC.format(x=x) for x in ('age', 'day', 'sex'))}]) AS aic, cast(n AS INT) AS n
  FROM (SELECT count(*) AS n, {', '.join(ONE.format(x=x) for x in ('age', 'day', 'sex'))} FROM ({DATA}) d) q""")
def _(spark, d):
    fits = models.fit_models(subjects(spark, d), "trait", {x: [x] for x in ("age", "day", "sex")})
    return models.models_table(spark, fits).select("model", r("aic", 6).alias("aic"), "n")


# A set of covariates can be fitted if each varies and no two of them are collinear.
FITTED = f"""SELECT unnest([var_pop(age) > 0, var_pop(age) > 0 AND var_pop(day) > 0 AND abs(corr(age, day)) < 1 - 1e-9, var_pop(sex) > 0,
  var_pop(age) > 0 AND abs(corr(age, age * 2)) < 1 - 1e-9]) AS ok FROM ({DATA}) d"""


@query("agg22_fit_summary", f"SELECT CASE WHEN ok THEN 'succeeded' ELSE 'error' END AS status, CASE WHEN NOT ok THEN 'singular' END AS error, count(*) AS n FROM ({FITTED}) f GROUP BY ALL")
def _(spark, d):
    data = subjects(spark, d).withColumn("age2", F.col("age") * 2)
    fits = models.fit_models(data, "trait", {"a": ["age"], "b": ["age", "day"], "c": ["sex"], "d": ["age", "age2"]})
    return models.fit_summary(models.models_table(spark, fits))


@query("nul3_forward_selection")
def _(spark, d):
    chosen = models.forward_selection(subjects(spark, d), "trait", GROUPS)
    return models.models_table(spark, [chosen])


@query("prj31_outcome_family", """SELECT CASE WHEN bool_or(trait <> 0 AND trait <> 1) THEN 'gaussian' ELSE 'binomial' END AS trait,
  CASE WHEN bool_or(is_case <> 0 AND is_case <> 1) THEN 'gaussian' ELSE 'binomial' END AS is_case FROM fx_samples""")
def _(spark, d):
    return subjects(spark, d).agg(models.outcome_family("trait").alias("trait"), models.outcome_family("is_case").alias("is_case"))


TEN = {"age": "(sample_key * 37) % 41", "sex": "sample_key % 2", "day": "sample_key % 7", "site": "grp", "wave": "(sample_key * 11) % 13", "batch": "(sample_key * 5) % 17",
       "plate": "(sample_key * 29) % 31", "visit": "(sample_key * 3) % 19", "lane": "(sample_key * 43) % 47", "ward": "(sample_key * 7) % 23"}


def _ten(spark, d, gaps=False):
    s = fx.view(spark, d, "fx_samples")
    value = lambda i, e: F.expr(f"CASE WHEN sample_key % {i + 23} <> 5 THEN cast({e} AS DOUBLE) END" if gaps and i < 3 else f"cast({e} AS DOUBLE)")
    return s.select("sample_key", "trait", F.col("is_case").cast("double").alias("is_case"), *[value(i, e).alias(c) for i, (c, e) in enumerate(TEN.items())])


@query("nul1_all_subsets", f"""WITH m AS (SELECT unnest(range(1, 1024)) AS m), n AS (SELECT m, count(*) AS n FROM m, fx_samples WHERE
    {' AND '.join(f"(m >> {i} & 1 = 0 OR sample_key % {i + 23} <> 5)" for i in range(3))} GROUP BY m)
  SELECT array_to_string(list_transform(list_filter(range(1, 11), lambda i: (m.m >> (i - 1)) & 1 = 1), lambda i: {list(TEN)}[i]), ',') AS covariates, cast(coalesce(n, 0) AS INT) AS n
  FROM m LEFT JOIN n ON m.m = n.m""")
def _(spark, d):
    # All subsets of ten covariate groups, three of them with gaps, with the number of complete subjects.
    fits = models.exhaustive_search(_ten(spark, d, gaps=True), "trait", {c: [c] for c in TEN})
    return models.models_table(spark, fits).select(F.array_join("covariates", ",").alias("covariates"), "n")


@query("nul2_all_subsets")
def _(spark, d):
    fits = models.exhaustive_search(_ten(spark, d), "trait", {c: [c] for c in TEN})
    return models.models_table(spark, fits)


def _relationship(spark, d, held):
    g = genotypes(spark, d)
    n = g.variants.count()

    def of(keys):
        held.append(mixed.Relationship.of(g.entries, keys, n))
        return held[-1]

    return of


@query("nul2_kinship_gaussian")
def _(spark, d):
    # Every subset of four covariate groups with the kinship effect; one Krylov space serves all.
    data = subjects(spark, d)
    sets = {",".join(s): list(s) for s in (["age"], ["sex"], ["day"], ["grp"], ["age", "sex"], ["age", "sex", "day"], ["age", "sex", "day", "grp"])}
    return mixed.mixed_table(spark, mixed.fit_mixed_models(data, "trait", sets, _relationship(spark, d, [])))


@query("nul2_kinship_binary")
def _(spark, d):
    return mixed.mixed_table(spark, mixed.fit_mixed_models(subjects(spark, d), "is_case", {"sex": ["sex"]}, _relationship(spark, d, [])))


@query("gwa1_kinship_score_test")
def _(spark, d):
    held = []
    fit = mixed.fit_mixed_models(subjects(spark, d), "trait", {"sex": ["sex"]}, _relationship(spark, d, held))[0]
    return mixed.mixed_score_test(genotypes(spark, d).entries, fit, held[0])


@query("reg2_saddlepoint")
def _(spark, d):
    return saddlepoint.saddlepoint_test(genotypes(spark, d).entries, _fitted(spark, d, "is_case"))


# --- meta-analysis -----------------------------------------------------------

STUDY = """SELECT concat(contig, ':', cast(pos AS STRING)) AS variant_id, variant_key, CASE WHEN variant_key % {swap} = 1 THEN other_allele ELSE effect_allele END AS effect_allele,
  CASE WHEN variant_key % {swap} = 1 THEN effect_allele WHEN variant_key % {odd} = 2 THEN 'N' ELSE other_allele END AS other_allele, est + {shift} AS est, se * {scale} AS est_se, n_obs FROM fx_assoc WHERE variant_key % {drop} <> 3"""
STUDIES = [STUDY.format(swap=10000019, odd=10000019, shift="0e0", scale="1e0", drop=11), STUDY.format(swap=4, odd=13, shift="2e-2", scale="15e-1", drop=7),
           STUDY.format(swap=3, odd=10000019, shift="-3e-2", scale="8e-1", drop=5)]
META = f"""WITH s0 AS ({STUDIES[0]}), s1 AS ({STUDIES[1]}), s2 AS ({STUDIES[2]}), rows AS (SELECT 0 AS study, * FROM s0 UNION ALL SELECT 1, * FROM s1 UNION ALL SELECT 2, * FROM s2),
  lead_ AS (SELECT variant_id, arg_min(effect_allele, study) AS ea, arg_min(other_allele, study) AS oa FROM rows GROUP BY variant_id),
  aligned AS (SELECT r.variant_id, study, ea, oa, n_obs, est_se, CASE WHEN effect_allele = ea THEN est ELSE -est END AS b FROM rows r JOIN lead_ l ON l.variant_id = r.variant_id
    AND ((effect_allele = ea AND other_allele = oa) OR (effect_allele = oa AND other_allele = ea))),
  sums AS (SELECT variant_id AS marker, ea, oa, count(*) AS n_studies, cast(sum(n_obs) AS BIGINT) AS n_total, sum(b / (est_se * est_se)) / sum(1 / (est_se * est_se)) AS effect, sqrt(1 / sum(1 / (est_se * est_se))) AS se,
    {', '.join(f"max(CASE WHEN study = {i} THEN CASE WHEN b > 0 THEN '+' WHEN b < 0 THEN '-' ELSE '0' END END) AS d{i}" for i in range(3))} FROM aligned GROUP BY variant_id, ea, oa)
  SELECT marker, ea AS effect_allele, oa AS other_allele, n_studies, n_total, round(effect, 8) AS effect, round(se, 8) AS se, round(effect / se, 7) AS z,
  round({two_sided('(effect / se)')}, 7) AS p, coalesce(d0, '?') || coalesce(d1, '?') || coalesce(d2, '?') AS direction FROM sums"""


@query("met1_meta_analysis", META)
def _(spark, d):
    out = meta.meta_analysis([fx.sql(spark, d, s) for s in STUDIES])
    return rounded(rounded(out, "effect", "se"), "z", "p", digits=7)


# --- gene tests --------------------------------------------------------------

MEMBERS = "members AS (SELECT g.gene_id, v.variant_key FROM fx_variants v JOIN fx_genes g ON g.contig = v.contig AND v.pos BETWEEN g.start_pos AND g.end_pos)"


@query("gen1_gene_burden", f"""WITH {MEMBERS}, b AS (SELECT gene_id, sample_key, sum(gt) AS burden FROM fx_entries e JOIN members m USING (variant_key) WHERE gt IS NOT NULL GROUP BY ALL)
  SELECT gene_id, n_site, cast(n_alt AS BIGINT) AS n_alt, n_sample_alt FROM (SELECT gene_id, count(*) AS n_site FROM members GROUP BY gene_id) s
  LEFT JOIN (SELECT gene_id, sum(burden) AS n_alt, count(*) FILTER (burden > 0) AS n_sample_alt FROM b GROUP BY gene_id) c USING (gene_id)""")
def _(spark, d):
    g = genotypes(spark, d)
    members = genes.gene_variants(g.variants, fx.view(spark, d, "fx_genes"))
    return genes.gene_counts(genes.gene_burden(g.entries, members, g.samples), members)


@query("gen1_burden_test", f"""WITH {score_oracle()}, {MEMBERS}, b AS (SELECT m.gene_id, f.sample_key, f.x, f.res, sum(coalesce(e.gt, o.m)) AS b FROM members m JOIN obs o USING (variant_key) CROSS JOIN fit f
    LEFT JOIN fx_entries e ON e.variant_key = o.variant_key AND e.sample_key = f.sample_key GROUP BY ALL)
  SELECT gene_id, round(score, 6) AS burden_score, round(score * score / v, 6) AS burden_chi2 FROM (SELECT gene_id, sum(b * res) / any_value(s2) AS score,
    (sum(b * b) - sum(b) * sum(b) / any_value(n) - sum(b * b.x) * sum(b * b.x) / any_value(sxx)) / any_value(s2) AS v FROM b, s2 GROUP BY gene_id) q""")
def _(spark, d):
    g = genotypes(spark, d)
    members = genes.gene_variants(g.variants, fx.view(spark, d, "fx_genes"))
    out = genes.burden_scores(g.entries, members, _fitted(spark, d))
    return out.select("gene_id", r("burden_score", 6).alias("burden_score"), r(F.col("burden_stat") * F.col("burden_stat"), 6).alias("burden_chi2"))


@query("gen2_smmat")
def _(spark, d):
    g = genotypes(spark, d)
    return genes.smmat(g.entries, g.variants, fx.view(spark, d, "fx_genes"), _fitted(spark, d))
