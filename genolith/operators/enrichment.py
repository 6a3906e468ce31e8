"""Ontology enrichment of significant genes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genolith.functions.special import hypergeometric_sf
from genolith.operators.genotypes import strip_version
from genolith.operators.ranking import adjust_p
from genolith.session import broadcast_if_small, durable


def significant_genes(results: DataFrame, kind: str) -> DataFrame:
    """(gene_id, significant): colocalised or associated genes, ids without version."""
    c = F.col
    if kind == "coloc2":
        gene, hit = c("ProbeID"), (c("min_pval_biom") <= 0.05) & (c("PP_H4_abf") >= 0.1)
    else:
        gene, hit = c("gene"), c("pvalue") <= 0.01
    return results.select(strip_version(gene).alias("gene_id"), hit.alias("significant"))


def ancestors(edges: DataFrame) -> DataFrame:
    """(term, ancestor) pairs of the ontology graph, each term its own ancestor.

    Newly found pairs are joined with all known ones, so the length of the paths
    doubles with each round; only new pairs are kept, so it ends, on cycles too.
    """
    up = edges.select("term", F.col("parent").alias("ancestor")).distinct()
    terms = up.select("term").union(up.select("ancestor")).distinct()
    frontier = durable(up.where("term <> ancestor"))
    known = durable(terms.select("term", F.col("term").alias("ancestor")).unionByName(frontier))
    while not frontier.isEmpty():
        onward = known.where("term <> ancestor").select(F.col("term").alias("via"), "ancestor")
        step = frontier.select("term", F.col("ancestor").alias("via")).join(onward, "via").select("term", "ancestor").distinct()
        frontier = durable(step.join(known, ["term", "ancestor"], "left_anti"))
        known = durable(known.unionByName(frontier))
    return known


def enrichment(genes: DataFrame, annotations: DataFrame, edges: DataFrame, ontologies: DataFrame, min_size: int = 10) -> DataFrame:
    """One-sided Fisher test per term, annotations passed on to all ancestors.

    ``genes``: gene_id, significant (the universe); ``annotations``: gene_id,
    term; ``ontologies``: term, ontology. Adjusted over all terms together.
    """
    c = F.col
    flagged = genes.groupBy("gene_id").agg(F.bool_or("significant").alias("significant"))
    closure = broadcast_if_small(ancestors(edges).join(ontologies.withColumnRenamed("term", "ancestor"), "ancestor"))
    placed = durable(
        annotations.select("gene_id", "term").distinct().join(flagged, "gene_id").join(closure, "term")
        .select("gene_id", "significant", "ontology", c("ancestor").alias("go_id")).distinct())
    # Genes with any annotation in an ontology make up its universe.
    universe = placed.select("ontology", "gene_id", "significant").distinct().groupBy("ontology").agg(
        F.count(F.lit(1)).alias("universe"), F.count_if("significant").alias("drawn"))
    terms = placed.groupBy("ontology", "go_id").agg(F.count(F.lit(1)).alias("annotated"), F.count_if("significant").alias("n_significant"))
    table = terms.where(c("annotated") >= min_size).join(F.broadcast(universe), "ontology")
    expected = c("annotated") * c("drawn") / c("universe")
    table = table.withColumns({
        "expected": expected,
        "p_value": hypergeometric_sf(c("n_significant"), c("universe"), c("annotated"), c("drawn")),
        "fold_enrichment": F.try_divide(c("n_significant").cast("double"), expected),
    })
    return adjust_p(durable(table), "p_value", bh="adj_p_value", bonferroni="_b").drop("_b")


def significant_terms(table: DataFrame, threshold: float = 0.05) -> DataFrame:
    floored = table.withColumn("adj_p_value", F.greatest("adj_p_value", F.lit(1e-300)))
    return floored.where(F.col("adj_p_value") <= threshold).select("go_id", "adj_p_value")


def cluster_names(wide: DataFrame, narrow: DataFrame) -> DataFrame:
    """Terms of the narrow clustering with their representative in the wide one.

    Members that represent a cluster stay; the name is the representative's
    description among them, empty when it is not there.
    """
    c = F.col
    order = ["cluster_representative", "member_description"]
    first = lambda df, value: df.groupBy("cluster_member").agg(F.min(F.struct(*order))[value].alias(f"_{value}"))
    kept = narrow.join(narrow.select(c("cluster_representative").alias("cluster_member")).distinct(), "cluster_member", "left_semi")
    named = kept.join(first(wide, "cluster_representative"), "cluster_member", "left").withColumnRenamed("_cluster_representative", "real_representative")
    described = first(kept, "member_description").withColumnsRenamed({"cluster_member": "real_representative", "_member_description": "_name"})
    out = named.join(described, "real_representative", "left")
    log_p = F.greatest(F.lit(0.0), F.coalesce(-F.log10(F.when(c("member_p_value") > 0, c("member_p_value"))), F.lit(0.0)))
    return out.select("cluster_member", "cluster_representative", "real_representative", F.coalesce("_name", F.lit("")).alias("cluster_name"), log_p.alias("log10_p"))
