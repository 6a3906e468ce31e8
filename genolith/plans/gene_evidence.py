"""Association results to genes, reports and enriched terms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genolith.operators import coloc, enrichment, expression_assoc, ranking, sumstats
from genolith.session import durable


def coloc_evidence(results: DataFrame, annotations: DataFrame, edges: DataFrame, ontologies: DataFrame, min_size: int = 10) -> tuple[DataFrame, DataFrame]:
    """Reported loci and the terms enriched among colocalised genes."""
    genes = enrichment.significant_genes(results, "coloc2")
    terms = enrichment.enrichment(genes, annotations, edges, ontologies, min_size)
    return coloc.coloc_report(results), enrichment.significant_terms(terms)


def expression_evidence(assoc: DataFrame, panel: DataFrame, weights: DataFrame, covariance: DataFrame, joint_covariance: DataFrame, phenotype: str) -> DataFrame:
    """Gene report of one phenotype over its tissues and across them.

    ``weights``: gene, gene_name, tissue, variant_id, weight; ``covariance``:
    gene, tissue, variant_1, variant_2, value; ``joint_covariance``: gene,
    variant_1, variant_2, value over the variants of all tissues.
    """
    c = F.col
    harmonised = durable(sumstats.harmonize_gwas(assoc, panel))
    names = weights.select("gene", "gene_name").distinct()
    models = weights.select("gene", "tissue", "variant_id", "weight")
    tissue = durable(expression_assoc.gene_association(harmonised, models, covariance, ["gene", "tissue"]))
    adjusted = ranking.adjust_p(tissue, "pvalue", ["tissue"]).select("gene", "tissue", "pvalue", "fdr", "bonferroni")
    meta = expression_assoc.cross_tissue(tissue, models, joint_covariance)
    across = ranking.adjust_p(durable(meta), "pvalue").select("gene", F.lit("Meta").alias("tissue"), "pvalue", "fdr", "bonferroni")
    rows = adjusted.unionByName(across).join(names, "gene").withColumn("phenotype", F.lit(phenotype))
    return expression_assoc.gene_report(rows.select("gene", "gene_name", "pvalue", "fdr", "bonferroni", "phenotype", c("tissue")))
