"""Queries over consequence annotation and expression."""

from __future__ import annotations

from pyspark.sql import functions as F

from genolith import fixtures as fx
from genolith.checks.registry import query, rounded
from genolith.operators import annotation as an
from genolith.sources import expression as expr

TERMS = ["stop_gained", "missense_variant", "synonymous_variant", "splice_region_variant", "intron_variant", "start_lost",
         "5_prime_UTR_variant", "frameshift_variant", "upstream_gene_variant", "unlisted_term"]
ONE = """SELECT p_partkey AS variant_key, {i} AS tx_no, concat('ENST', cast((p_partkey * 3 + {i}) % 2500 AS STRING)) AS transcript_id,
  concat('ENSG', cast((p_partkey * 3 + {i}) % 2500 % 211 AS STRING)) AS gene_id, concat('SYM', cast((p_partkey * 3 + {i}) % 2500 % 211 AS STRING)) AS gene_symbol,
  CASE WHEN (p_partkey + {i}) % 5 = 0 THEN 'lncRNA' ELSE 'protein_coding' END AS biotype,
  CASE (p_partkey * 5 + {i}) % 7 WHEN 0 THEN 'HC' WHEN 1 THEN 'LC' END AS lof, CASE WHEN p_partkey % 11 = 0 THEN 'SINGLE_EXON' END AS lof_flags,
  CASE (p_partkey * 3 + {i}) % 4 WHEN 0 THEN 'deleterious' WHEN 1 THEN 'tolerated' END AS sift_prediction,
  CASE WHEN (p_partkey + {i} * 2) % 3 = 0 THEN 'probably_damaging' ELSE 'benign' END AS polyphen_prediction, cast((p_partkey + {i}) % 4 + 1 AS INT) AS tsl,
  cast((p_partkey * 7 + {i} * 11) % 10 AS INT) AS term1, cast((p_partkey * 3 + {i} * 5) % 10 AS INT) AS term2 FROM part"""
TX = " UNION ALL ".join(ONE.format(i=i) for i in range(3))
RANK = {t: (an.SEVERITY.index(t) if t in an.SEVERITY else None) for t in TERMS}
TERM_TABLE = "(VALUES " + ", ".join(f"({i}, '{t}', {RANK[t] if RANK[t] is not None else 'NULL'})" for i, t in enumerate(TERMS)) + ") AS {a}(no, term, sev)"
# Each transcript with the more severe of its two terms.
SEVERE = f"""SELECT t.*, CASE WHEN a.sev IS NULL THEN CASE WHEN b.sev IS NULL THEN NULL ELSE b.term END WHEN b.sev IS NULL OR a.sev <= b.sev THEN a.term ELSE b.term END AS csq,
  least(coalesce(a.sev, 99), coalesce(b.sev, 99)) AS sev FROM ({TX}) t JOIN {TERM_TABLE.format(a='a')} ON a.no = term1 JOIN {TERM_TABLE.format(a='b')} ON b.no = term2"""
CODING = len(an.ALL_CODING)


def variants(spark, d):
    """Variants with an array of three transcripts each."""
    terms = F.array(*[F.lit(t) for t in TERMS])
    flat = fx.sql(spark, d, TX).withColumn("consequence_terms", F.array(F.element_at(terms, F.col("term1") + 1), F.element_at(terms, F.col("term2") + 1)))
    fields = ["tx_no", "transcript_id", "gene_id", "gene_symbol", "biotype", "lof", "lof_flags", "sift_prediction", "polyphen_prediction", "tsl", "consequence_terms"]
    return flat.groupBy("variant_key").agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("transcript_consequences"))


@query("prj24_most_severe", f"SELECT variant_key, tx_no, csq AS most_severe_consequence FROM ({SEVERE}) s")
def _(spark, d):
    return an.explode_transcripts(variants(spark, d)).select("variant_key", "tx_no", "most_severe_consequence")


@query("flt11_lof_hc", f"SELECT DISTINCT variant_key FROM ({TX}) t WHERE lof = 'HC'")
def _(spark, d):
    return an.filter_lof_hc(variants(spark, d)).select("variant_key")


@query("flt12_functional", f"""SELECT DISTINCT variant_key FROM ({TX}) t WHERE tsl = 1 AND (coalesce(lof = 'HC', false)
  OR coalesce(sift_prediction = 'deleterious' AND polyphen_prediction = 'probably_damaging', false))""")
def _(spark, d):
    return an.filter_functional(variants(spark, d)).select("variant_key")


@query("flt15_gene_list", f"SELECT variant_key, tx_no, gene_id FROM ({TX}) t WHERE gene_id IN (SELECT concat('ENSG', cast(n_nationkey * 5 AS VARCHAR)) FROM nation)")
def _(spark, d):
    listed = fx.table(spark, d, "nation").select(F.concat(F.lit("ENSG"), (F.col("n_nationkey") * 5).cast("string")).alias("g"))
    return an.filter_genes(an.explode_transcripts(variants(spark, d)), listed).select("variant_key", "tx_no", "gene_id")


@query("flt16_consequence_list", f"SELECT variant_key, tx_no, csq FROM ({SEVERE}) t WHERE biotype = 'protein_coding' AND sev < {CODING}")
def _(spark, d):
    return an.filter_csqs(an.explode_transcripts(variants(spark, d))).select("variant_key", "tx_no", F.col("most_severe_consequence").alias("csq"))


@query("flt17_homozygotes", "SELECT variant_key FROM fx_entries GROUP BY variant_key HAVING count(*) FILTER (gt = 2) >= 1")
def _(spark, d):
    from genolith.operators.qc import call_stats
    return an.filter_homs(call_stats(fx.view(spark, d, "fx_entries")), "n_hom_alt").select("variant_key")


# --- expression --------------------------------------------------------------

TISSUES = ["Liver", "Brain - Cortex", "Whole Blood"]
COLUMNS = [f"{t}.{k}" for t in TISSUES for k in range(1, 5)]
VALUE = "cast(CASE WHEN p_partkey % 211 % 20 = 7 THEN 0 ELSE (p_partkey * 13 + {j} * 7 + p_size) % 29 END AS DOUBLE)"
WIDE = "SELECT concat('ENST', cast(p_partkey AS STRING), '.', cast(p_size AS STRING)) AS transcript_id, concat('ENSG', cast(p_partkey % 211 AS STRING), '.3') AS gene_id, {cols} FROM part"
WIDE_SPARK = WIDE.format(cols=", ".join(f"{VALUE.format(j=j)} AS `{c}`" for j, c in enumerate(COLUMNS)))
LONG = " UNION ALL ".join(
    f"SELECT concat('ENST', cast(p_partkey AS STRING), '.', cast(p_size AS STRING)) AS transcript_id, concat('ENSG', cast(p_partkey % 211 AS STRING), '.3') AS gene_id, '{c}' AS sample_column, {VALUE.format(j=j)} AS x FROM part"
    for j, c in enumerate(COLUMNS))
SUMMARY = f"""SELECT split_part(transcript_id, '.', 1) AS transcript_id, split_part(gene_id, '.', 1) AS gene_id, split_part(sample_column, '.', 1) AS tissue, {{f}} AS expression
  FROM ({LONG}) l GROUP BY ALL"""
MEDIAN = SUMMARY.format(f="median(x)")


def long_expression(spark, d):
    return expr.melt(fx.sql(spark, d, WIDE_SPARK))


def summary(spark, d):
    return an.expression_by_tissue(long_expression(spark, d))


@query("src5_expression_matrix", LONG)
def _(spark, d):
    path = expr.write_wide(fx.sql(spark, d, WIDE_SPARK))
    return expr.read_expression_matrix(spark, path)


@query("agg10_median_expression", MEDIAN)
def _(spark, d):
    return summary(spark, d)


@query("agg10_mean_expression", SUMMARY.format(f="round(avg(x), 8)"))
def _(spark, d):
    return rounded(an.expression_by_tissue(long_expression(spark, d), "mean"), "expression")


@query("agg11_collect_by_transcript", f"""SELECT transcript_id, gene_id, string_agg(cast(cast(expression * 10 AS BIGINT) AS VARCHAR), ',' ORDER BY tissue) AS vector FROM ({MEDIAN}) m GROUP BY ALL""")
def _(spark, d):
    vector = F.array_join(F.transform("agg_expression", lambda x: (x * 10).cast("bigint").cast("string")), ",")
    return an.collect_by_transcript(summary(spark, d)).select("transcript_id", "gene_id", vector.alias("vector"))


@query("agg12_gene_expression", f"SELECT gene_id AS ensg, tissue, sum(expression) AS gene_expression FROM ({MEDIAN}) m GROUP BY ALL")
def _(spark, d):
    return an.gene_expression(summary(spark, d))


@query("agg14_pivot_tissues", f"""SELECT transcript_id, {', '.join(f"max(CASE WHEN tissue = '{t}' THEN expression END) AS \"{t.replace('-', '_').replace(' ', '_')}\"" for t in TISSUES)} FROM ({MEDIAN}) m GROUP BY transcript_id""")
def _(spark, d):
    return an.pivot_tissues(summary(spark, d), ["transcript_id"], "expression")


HIT = f"SELECT variant_key, transcript_id, csq, gene_id AS ensg, gene_symbol AS symbol, lof, lof_flags AS lof_flag FROM ({SEVERE}) s WHERE biotype = 'protein_coding' AND sev < {CODING}"
SUMS = f"""SELECT h.variant_key, csq, ensg, symbol, lof, lof_flag, tissue, sum(expression) AS expression FROM ({HIT}) h LEFT JOIN ({MEDIAN}) m USING (transcript_id) GROUP BY ALL"""
PEXT = f"""SELECT s.variant_key, csq, s.ensg, symbol, lof, lof_flag, avg(CASE WHEN gene_expression > 0 THEN expression / gene_expression END) AS mean_proportion FROM ({SUMS}) s
  LEFT JOIN (SELECT gene_id AS ensg, tissue, sum(expression) AS gene_expression FROM ({MEDIAN}) m GROUP BY ALL) g ON g.ensg = s.ensg AND g.tissue = s.tissue
  WHERE s.ensg IN (SELECT gene_id FROM ({MEDIAN}) m) GROUP BY ALL"""


def _hits(spark, d):
    return an.filter_csqs(an.explode_transcripts(variants(spark, d)))


@query("joi6_variant_expression", SUMS)
def _(spark, d):
    return an.variant_expression(_hits(spark, d), summary(spark, d))


SAME = " AND ".join(f"b.{k} IS NOT DISTINCT FROM p.{k}" for k in ("variant_key", "csq", "ensg", "symbol", "lof", "lof_flag"))
SHARES = f"""SELECT s.variant_key, csq, s.ensg, symbol, lof, lof_flag, s.tissue, expression / gene_expression AS proportion FROM ({SUMS}) s
  JOIN (SELECT gene_id AS ensg, tissue, sum(expression) AS gene_expression FROM ({MEDIAN}) m GROUP BY ALL) g ON g.ensg = s.ensg AND g.tissue = s.tissue WHERE gene_expression > 0"""


@query("agg13_expression_proportion", f"""SELECT p.variant_key, p.csq, p.ensg, p.symbol, p.lof, p.lof_flag, round(mean_proportion, 8) AS mean_proportion, tissue, round(proportion, 8) AS proportion
  FROM ({PEXT}) p LEFT JOIN ({SHARES}) b ON {SAME}""")
def _(spark, d):
    from genolith.session import durable
    s = durable(summary(spark, d))
    rows = an.expression_proportion(an.variant_expression(_hits(spark, d), s), an.gene_expression(s))
    return rounded(rows.select(*an.GROUP, "mean_proportion", F.explode_outer("proportions").alias("tissue", "proportion")), "mean_proportion", "proportion")


def _annotated(spark, d):
    from genolith.session import durable
    return an.annotate_pext(variants(spark, d), durable(summary(spark, d)))


@query("joi8_annotated_variants", f"""SELECT v.p_partkey AS variant_key, csq, ensg, symbol, lof, round(mean_proportion, 8) AS mean_proportion FROM part v LEFT JOIN ({PEXT}) p ON p.variant_key = v.p_partkey""")
def _(spark, d):
    rows = _annotated(spark, d).select("variant_key", F.explode_outer("tx_annotation").alias("a"))
    return rounded(rows.select("variant_key", "a.csq", "a.ensg", "a.symbol", "a.lof", "a.mean_proportion"), "mean_proportion")


@query("joi7_gene_maximum", f"""SELECT s.variant_key, s.ensg, s.csq, s.lof, s.lof_flag, s.tissue, s.expression, g.gene_expression FROM ({SUMS}) s JOIN (SELECT gene_id AS ensg, tissue, sum(expression) AS gene_expression
  FROM ({MEDIAN}) m GROUP BY ALL) g ON g.ensg = s.ensg AND g.tissue = s.tissue""")
def _(spark, d):
    from genolith.session import durable
    s = durable(summary(spark, d))
    sums = an.variant_expression(_hits(spark, d), s)
    return an.with_gene_expression(sums, an.gene_expression(s)).select("variant_key", "ensg", "csq", "lof", "lof_flag", "tissue", "expression", "gene_expression")


@query("flt13_hi_pext", f"SELECT DISTINCT variant_key FROM ({PEXT}) p WHERE mean_proportion > 1e-1")
def _(spark, d):
    return an.filter_hi_pext(_annotated(spark, d), threshold=0.1).select("variant_key")


@query("flt14_hi_pext_lof", f"SELECT DISTINCT variant_key FROM ({PEXT}) p WHERE mean_proportion > 1e-1 AND lof = 'HC'")
def _(spark, d):
    return an.filter_hi_pext_lof(_annotated(spark, d), threshold=0.1).select("variant_key")
