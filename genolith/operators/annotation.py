"""Transcript consequences and transcript-aware expression (pext)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genolith.operators.genotypes import strip_version
from genolith.operators.ranking import exact_quantile
from genolith.operators.samples import distinct_by
from genolith.session import broadcast_if_small, durable, in_more_tasks

# Consequence terms from most to least severe.
CODING_HIGH = [
    "transcript_ablation", "splice_acceptor_variant", "splice_donor_variant",
    "stop_gained", "frameshift_variant", "stop_lost",
]
CODING_MEDIUM = [
    "start_lost", "initiator_codon_variant", "transcript_amplification", "inframe_insertion", "inframe_deletion",
    "missense_variant", "protein_altering_variant", "splice_region_variant",
]
CODING_LOW = [
    "incomplete_terminal_codon_variant", "start_retained_variant", "stop_retained_variant", "synonymous_variant",
    "coding_sequence_variant",
]
NON_CODING = [
    "mature_miRNA_variant", "5_prime_UTR_variant", "3_prime_UTR_variant", "non_coding_transcript_exon_variant",
    "non_coding_exon_variant", "intron_variant", "NMD_transcript_variant", "non_coding_transcript_variant",
    "nc_transcript_variant", "upstream_gene_variant", "downstream_gene_variant", "TFBS_ablation", "TFBS_amplification",
    "TF_binding_site_variant", "regulatory_region_ablation", "regulatory_region_amplification", "feature_elongation",
    "regulatory_region_variant", "feature_truncation", "intergenic_variant",
]
SEVERITY = CODING_HIGH + CODING_MEDIUM + CODING_LOW + NON_CODING
ALL_CODING = CODING_HIGH + CODING_MEDIUM + CODING_LOW


def most_severe(terms: Column) -> Column:
    """First term of the severity order found among ``terms``."""
    order = F.array(*[F.lit(t) for t in SEVERITY])
    return F.get(F.filter(order, lambda t: F.array_contains(terms, t)), F.lit(0))


# --- variant filters over the transcript array -------------------------------


def _any(column: str, test) -> Column:
    return F.coalesce(F.exists(column, lambda x: F.coalesce(test(x), F.lit(False))), F.lit(False))


def filter_lof_hc(variants: DataFrame, column: str = "transcript_consequences") -> DataFrame:
    """Some transcript has a high-confidence loss of function."""
    return variants.where(_any(column, lambda x: x["lof"] == "HC"))


def filter_functional(variants: DataFrame, column: str = "transcript_consequences") -> DataFrame:
    """Loss of function or two damaging predictions, on a best-supported transcript."""

    def test(x: Column) -> Column:
        lof = F.coalesce(x["lof"] == "HC", F.lit(False))
        damaging = F.coalesce((x["sift_prediction"] == "deleterious") & (x["polyphen_prediction"] == "probably_damaging"), F.lit(False))
        return (lof | damaging) & (x["tsl"] == 1)

    return variants.where(_any(column, test))


def filter_hi_pext(variants: DataFrame, column: str = "tx_annotation", threshold: float = 0.9) -> DataFrame:
    return variants.where(_any(column, lambda x: x["mean_proportion"] > threshold))


def filter_hi_pext_lof(variants: DataFrame, column: str = "tx_annotation", threshold: float = 0.9) -> DataFrame:
    return variants.where(_any(column, lambda x: (x["lof"] == "HC") & (x["mean_proportion"] > threshold)))


def explode_transcripts(variants: DataFrame, column: str = "transcript_consequences") -> DataFrame:
    """One row per variant and transcript, with its most severe consequence."""
    rows = variants.select("variant_key", F.explode(column).alias("_tc")).select("variant_key", "_tc.*")
    return rows.withColumn("most_severe_consequence", most_severe(F.col("consequence_terms")))


def filter_genes(transcripts: DataFrame, genes: DataFrame | list[str], column: str = "gene_id") -> DataFrame:
    """Transcripts of the listed genes; a table of genes becomes a semi-join."""
    if isinstance(genes, list):
        return transcripts.where(F.col(column).isin(genes))
    return transcripts.join(broadcast_if_small(genes.select(F.col(genes.columns[0]).alias(column)).distinct()), column, "left_semi")


def filter_csqs(transcripts: DataFrame, terms: list[str] = ALL_CODING) -> DataFrame:
    return transcripts.where((F.col("biotype") == "protein_coding") & F.col("most_severe_consequence").isin(terms))


def filter_homs(variants: DataFrame, column: str = "homozygote_count") -> DataFrame:
    return variants.where(F.col(column) >= 1)


# --- expression --------------------------------------------------------------


def expression_by_tissue(long: DataFrame, how: str = "median") -> DataFrame:
    """Median or mean over a tissue's samples, per transcript.

    ``long`` has transcript_id, gene_id, sample_column (``Tissue.n``) and x.
    """
    rows = long.withColumn("tissue", F.element_at(F.split("sample_column", "\\."), 1))
    keys = ["transcript_id", "gene_id", "tissue"]
    if how == "median":
        # Nearly every value of a transcript differs, so counting them where they are read would hold a scan's whole split.
        rows = in_more_tasks(rows, long.count(), *keys)
        out = exact_quantile(rows, "x", 0.5, keys, "expression")
    else:
        out = rows.groupBy(*keys).agg(F.avg("x").alias("expression"))
    return out.withColumns({"transcript_id": strip_version(F.col("transcript_id")), "gene_id": strip_version(F.col("gene_id"))})


def collect_by_transcript(summary: DataFrame) -> DataFrame:
    """Tissue-ordered vector per transcript; as long as there are tissues."""
    ordered = F.array_sort(F.collect_list(F.struct("tissue", "expression")))
    out = summary.groupBy("transcript_id", "gene_id").agg(ordered.alias("values"))
    return out.withColumn("agg_expression", F.transform("values", lambda v: v["expression"]))


def gene_expression(summary: DataFrame) -> DataFrame:
    """Expression of a gene per tissue: the sum over its transcripts."""
    return summary.groupBy(F.col("gene_id").alias("ensg"), "tissue").agg(F.sum("expression").alias("gene_expression"))


def tissue_column(tissue: Column) -> Column:
    return F.regexp_replace(tissue, "[- ()]", "_")


def pivot_tissues(long: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Tissues as columns, their names made safe."""
    return long.withColumn("tissue", tissue_column(F.col("tissue"))).groupBy(*keys).pivot("tissue").agg(F.first(value))


GROUP = ["variant_key", "csq", "ensg", "symbol", "lof", "lof_flag"]


def variant_expression(transcripts: DataFrame, summary: DataFrame, rows: int = 0) -> DataFrame:
    """Expression summed over the transcripts with the same gene and consequence.

    Long form, one row per tissue; a group without any expressed transcript
    keeps one row with a NULL tissue. ``rows``: about how many transcripts and tissues there are, if known.
    """
    named = transcripts.select(
        "variant_key", "transcript_id", F.col("most_severe_consequence").alias("csq"), F.col("gene_id").alias("ensg"),
        F.col("gene_symbol").alias("symbol"), "lof", F.col("lof_flags").alias("lof_flag"))
    joined = named.join(broadcast_if_small(summary.select("transcript_id", "tissue", "expression")), "transcript_id", "left")
    return in_more_tasks(joined, rows, "variant_key").groupBy(*GROUP, "tissue").agg(F.sum("expression").alias("expression"))


def with_gene_expression(sums: DataFrame, genes: DataFrame, how: str = "inner") -> DataFrame:
    """Each sum next to its gene's expression in the tissue."""
    return sums.join(broadcast_if_small(genes), ["ensg", "tissue"], how)


def expression_proportion(sums: DataFrame, genes: DataFrame) -> DataFrame:
    """Share of the gene's expression per tissue and its mean.

    0 / 0 is no number and stays out of the mean. Genes without expression
    data drop out, as do NULL tissues.
    """
    known = genes.select("ensg").distinct()
    shares = with_gene_expression(sums.join(known, "ensg", "left_semi"), genes, "left").withColumn(
        "proportion", F.try_divide("expression", F.col("gene_expression")))
    entries = F.collect_list(F.when(F.col("tissue").isNotNull() & F.col("proportion").isNotNull(), F.struct("tissue", "proportion")))
    return shares.groupBy(*GROUP).agg(
        F.map_from_entries(F.array_sort(entries)).alias("proportions"), F.avg("proportion").alias("mean_proportion"))


def annotate_variants(variants: DataFrame, annotation: DataFrame) -> DataFrame:
    """Attach the annotation rows of a variant as an array."""
    rest = [c for c in annotation.columns if c != "variant_key"]
    nested = annotation.groupBy("variant_key").agg(F.collect_list(F.struct(*rest)).alias("tx_annotation"))
    return variants.join(nested, "variant_key", "left")


def annotate_pext(variants: DataFrame, summary: DataFrame, terms: list[str] = ALL_CODING, genes: DataFrame | list[str] | None = None,
                  gene_column: str = "gene_id", homs_only: bool = False, drop_tissues: list[str] | None = None, kind: str = "proportion") -> DataFrame:
    """Variants with the expression of the transcripts they hit.

    ``kind`` is proportion (share of the gene) or expression (sums).
    """
    base = distinct_by(variants, ["variant_key"], [c for c in variants.columns if c in ("contig", "pos", "ref", "alt")])
    if homs_only:
        base = filter_homs(base)
    hit = filter_csqs(explode_transcripts(base), terms)
    if genes is not None:
        hit = filter_genes(hit, genes, gene_column)
    totals = gene_expression(summary)
    if drop_tissues:
        summary = summary.where(~F.col("tissue").isin(drop_tissues))
        totals = totals.where(~F.col("tissue").isin(drop_tissues))
    hit = durable(hit.select("variant_key", "transcript_id", "most_severe_consequence", "gene_id", "gene_symbol", "lof", "lof_flags"))
    sums = variant_expression(hit, summary, hit.count() * summary.select("tissue").distinct().count())
    if kind == "proportion":
        rows = expression_proportion(sums, totals)
    else:
        rows = sums.groupBy(*GROUP).agg(F.map_from_entries(F.array_sort(F.collect_list(
            F.when(F.col("tissue").isNotNull(), F.struct("tissue", "expression"))))).alias("expression"))
    return annotate_variants(variants, rows)
