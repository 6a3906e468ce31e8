"""Single-variant score tests, their tables and reports."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from genolith.functions.special import CHI2_1_MEDIAN, chi2_1_sf
from genolith.operators.genotypes import contig_index
from genolith.operators.models import INTERCEPT, FittedModel, with_factors
from genolith.operators.ranking import exact_quantile
from genolith.session import broadcast_if_small


@dataclass
class ScoreModel:
    """What a score test needs per subject.

    ``table``: sample_key, outcome, resid, weight and z0..zk, covariates made
    orthonormal under the weights, so a variance correction is a plain sum of
    squares. ``totals``: cohort sums of resid, weight and weight * z.
    """

    table: DataFrame
    z: list[str]
    totals: dict[str, float]
    family: str


def score_model(data: DataFrame, outcome: str, model: FittedModel, offset: str | None = None) -> ScoreModel:
    """Residuals, weights and orthonormal covariates of a fitted null model."""
    covariates = model.columns[1:]
    data = with_factors(data, covariates)
    complete = data.where(
        F.col(outcome).isNotNull() & ~F.isnan(F.col(outcome).cast("double")) & _all_present(covariates)
    )
    terms = [F.lit(float(b)) * (F.lit(1.0) if c == INTERCEPT else F.col(f"`{c}`").cast("double")) for b, c in zip(model.coefficients, model.columns)]
    eta = sum(terms[1:], terms[0])
    if offset:
        eta = eta + F.col(offset)
    if model.family == "gaussian":
        mu, weight, scale = eta, F.lit(1.0 / model.dispersion), 1.0 / model.dispersion
    else:
        mu = F.lit(1.0) / (F.lit(1.0) + F.exp(-eta))
        weight, scale = mu * (F.lit(1.0) - mu), 1.0
    y = F.col(outcome).cast("double")
    base = complete.select(
        "sample_key", y.alias("outcome"), ((y - mu) * scale).alias("resid"), weight.alias("weight"),
        *[(F.lit(1.0) if c == INTERCEPT else F.col(f"`{c}`").cast("double")).alias(f"x{i}") for i, c in enumerate(model.columns)],
    )
    p = len(model.columns)
    pairs = [(i, j) for i in range(p) for j in range(i, p)]
    sums = base.agg(*[F.sum(F.col("weight") * F.col(f"x{i}") * F.col(f"x{j}")).alias(f"s{i}_{j}") for i, j in pairs]).first()
    xwx = np.zeros((p, p))
    for i, j in pairs:
        xwx[i, j] = xwx[j, i] = sums[f"s{i}_{j}"]
    rotate = np.linalg.inv(np.linalg.cholesky(xwx)).T
    z = [f"z{k}" for k in range(p)]
    table = base.select(
        "sample_key", "outcome", "resid", "weight",
        *[sum((F.lit(float(rotate[i, k])) * F.col(f"x{i}") for i in range(1, p)), F.lit(float(rotate[0, k])) * F.col("x0")).alias(z[k]) for k in range(p)],
    )
    total = table.agg(F.sum("resid").alias("resid"), F.sum("weight").alias("weight"),
                      *[F.sum(F.col("weight") * F.col(c)).alias(c) for c in z]).first().asDict()
    return ScoreModel(table, z, total, model.family)


def _all_present(columns: list[str]) -> Column:
    ok = F.lit(True)
    for c in columns:
        ok = ok & F.col(f"`{c}`").isNotNull() & ~F.isnan(F.col(f"`{c}`").cast("double"))
    return ok


def subject_sums(model: ScoreModel, cases: bool = False) -> DataFrame:
    """What a call adds up per sample: rows, residual, weight and weighted covariates of its subject; with ``cases`` also case and control rows."""
    w = F.col("weight")
    by_outcome = [F.count_if(F.col("outcome") == 1).alias("case_rows"), F.count_if(F.col("outcome") == 0).alias("control_rows")]
    return model.table.groupBy("sample_key").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("resid").alias("resid"), F.sum(w).alias("weight"), *[F.sum(w * F.col(z)).alias(z) for z in model.z],
        *(by_outcome if cases else []))


def score_aggregates(model: ScoreModel) -> list[Column]:
    """Sums per variant over calls next to their ``subject_sums``; missing calls and samples without a subject add nothing."""
    g = F.col("gt").cast("double")
    called = lambda name: F.when(F.col("gt").isNotNull(), F.col(name))
    return [
        F.coalesce(F.sum(called("n_rows")), F.lit(0)).alias("n_obs"), F.sum(g * F.col("n_rows")).alias("_g"), F.sum(g * F.col("resid")).alias("_gr"),
        F.sum(called("resid")).alias("_r"), F.sum(g * g * F.col("weight")).alias("_wgg"), F.sum(called("weight")).alias("_w"),
        *[F.sum(g * F.col(z)).alias(f"_g{z}") for z in model.z], *[F.sum(called(z)).alias(f"_{z}") for z in model.z]]


def case_aggregates() -> list[Column]:
    """Called cases and controls per variant, over calls next to ``subject_sums`` with cases."""
    called = lambda name: F.coalesce(F.sum(F.when(F.col("gt").isNotNull(), F.col(name))), F.lit(0))
    return [called("case_rows").alias("n_cases"), called("control_rows").alias("n_controls")]


def scores(sums: DataFrame, model: ScoreModel, *more: str) -> DataFrame:
    """Per variant: n_obs, mean, score, variance ``_v`` and covariate products ``zg`` of ``score_aggregates``.

    Missing calls take the variant's mean; the cohort totals minus the called samples' sums give their part.
    """
    sums = sums.where(F.col("n_obs") > 0).withColumn("mean", F.col("_g") / F.col("n_obs"))
    mean, t = F.col("mean"), model.totals
    products = {z: F.col(f"_g{z}") + mean * (F.lit(t[z]) - F.col(f"_{z}")) for z in model.z}
    variance = F.col("_wgg") + mean * mean * (F.lit(t["weight"]) - F.col("_w"))
    for part in products.values():
        variance = variance - part * part
    return sums.select(
        "variant_key", "n_obs", "mean",
        (F.col("_gr") + mean * (F.lit(t["resid"]) - F.col("_r"))).alias("score"),
        variance.alias("_v"), F.array(*products.values()).alias("zg"), *more,
    )


def score_sums(entries: DataFrame, model: ScoreModel) -> DataFrame:
    """``scores`` of the entries.

    One aggregate over the entries: partial sums per variant leave each task,
    not genotypes.
    """
    called = entries.where(F.col("gt").isNotNull()).select("variant_key", "sample_key", "gt")
    return scores(called.join(broadcast_if_small(subject_sums(model)), "sample_key").groupBy("variant_key").agg(*score_aggregates(model)), model)


def tested(sums: DataFrame, *more: str) -> DataFrame:
    """Score, variance, effect and p-value per variant of ``scores``."""
    # A site without variation leaves rounding noise only.
    out = sums.select(
        "variant_key", "n_obs", (F.col("mean") / 2).alias("freq"), "score", F.when(F.col("_v") > 1e-9, F.col("_v")).alias("score_var"), *more)
    out = out.withColumn("score_stat", F.col("score") / F.sqrt("score_var"))
    named = {
        "score_pval": chi2_1_sf(F.col("score_stat") * F.col("score_stat")),
        "est": F.col("score") / F.col("score_var"),
        "est_se": F.lit(1.0) / F.sqrt("score_var"),
    }
    return out.withColumns(named).select(*[c for c in out.columns if c not in more], *named, *more)


def score_test(entries: DataFrame, model: ScoreModel) -> DataFrame:
    """Score, variance, effect and p-value per variant, missing calls at the mean."""
    return tested(score_sums(entries, model))


def case_control_counts(entries: DataFrame, subjects: DataFrame, outcome: str = "outcome") -> DataFrame:
    """Called cases and controls per variant."""
    called = entries.where(F.col("gt").isNotNull()).join(broadcast_if_small(subjects.select("sample_key", outcome)), "sample_key")
    return called.groupBy("variant_key").agg(
        F.count_if(F.col(outcome) == 1).alias("n_cases"), F.count_if(F.col(outcome) == 0).alias("n_controls"))


def with_alleles(assoc: DataFrame, variants: DataFrame) -> DataFrame:
    """Position and alleles; the alternate allele is the effect allele."""
    named = variants.select("variant_key", "contig", "pos", F.col("alt").alias("effect_allele"), F.col("ref").alias("other_allele"))
    return assoc.join(named, "variant_key", "left")


def gwas(entries: DataFrame, variants: DataFrame, model: ScoreModel) -> DataFrame:
    """Association table: score tests, alleles and, for binary traits, case counts."""
    assoc = with_alleles(score_test(entries, model), variants)
    if model.family == "binomial":
        assoc = assoc.join(case_control_counts(entries, model.table), "variant_key", "left")
    return assoc


# Column names of the text form of an association table.
EXPORT_NAMES = {"variant_id": "variant.id", "contig": "chr", "n_obs": "n.obs", "score": "Score", "score_stat": "Score.Stat",
                "score_pval": "Score.pval", "est": "Est", "est_se": "Est.SE", "effect_allele": "effect.allele",
                "other_allele": "other.allele", "n_cases": "n.cases", "n_controls": "n.controls"}


def export_names(assoc: DataFrame) -> DataFrame:
    return assoc.withColumnsRenamed({k: v for k, v in EXPORT_NAMES.items() if k in assoc.columns})


def to_locuszoom(assoc: DataFrame) -> DataFrame:
    c = F.col
    return assoc.select(c("contig").alias("CHR"), c("pos").alias("POS"), c("freq").alias("FREQ"), c("other_allele").alias("REF"),
                        c("effect_allele").alias("ALT"), c("score_pval").alias("PVAL"), c("est").alias("BETA"), c("est_se").alias("SE"))


def to_mrmega(assoc: DataFrame) -> DataFrame:
    """Odds ratio with 95% bounds for binary traits, else beta and standard error."""
    c = F.col
    base = [c("variant_id").alias("MARKERNAME"), F.substring("contig", 4, 100).alias("CHROMOSOME"), c("pos").alias("POSITION"),
            c("n_obs").alias("N"), c("freq").alias("EAF"), c("effect_allele").alias("EA"), c("other_allele").alias("NEA")]
    if "n_cases" not in assoc.columns:
        return assoc.select(*base, c("est").alias("BETA"), c("est_se").alias("SE"))
    low, high = F.exp(c("est") - 1.96 * c("est_se")), F.exp(c("est") + 1.96 * c("est_se"))
    out = assoc.select(*base, F.exp("est").alias("OR"), low.alias("OR_95L"), high.alias("OR_95U"))
    return out.where((c("OR_95L") > 0) & (c("OR_95U") != float("inf")))


def plot_ready(assoc: DataFrame, p: str = "score_pval") -> DataFrame:
    """Finite -log10 p on the autosomes, X and Y."""
    value = -F.log10(F.when(F.col(p) > 0, F.col(p)))
    return assoc.withColumn("log10p", value).where(F.col("log10p").isNotNull() & ~F.isnan("log10p") & (contig_index() < 25))


def manhattan_table(assoc: DataFrame, p: str = "score_pval") -> DataFrame:
    """Cumulative genome position; the offsets come from one row per chromosome."""
    ready = plot_ready(assoc, p).withColumn("contig_idx", contig_index())
    lengths = ready.groupBy("contig_idx").agg(F.max("pos").alias("length"))
    before = W.orderBy("contig_idx").rowsBetween(W.unboundedPreceding, -1)
    offsets = lengths.select("contig_idx", F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset"))
    return ready.join(F.broadcast(offsets), "contig_idx").withColumn("x", F.col("pos") + F.col("offset")).drop("offset")


def gwas_report(assoc: DataFrame, models: DataFrame, covariates: dict[str, str], n_pcs: int = 10, threshold: float = 5e-8) -> DataFrame:
    """Per trait: genomic control, hits, components and covariates of its model.

    ``covariates`` maps report columns to covariate names; ``models`` has
    trait and covariates.
    """
    squared = assoc.withColumn("_sq", F.col("score_stat") * F.col("score_stat"))
    median = exact_quantile(squared, "_sq", 0.5, ["trait"], "_median")
    hits = assoc.groupBy("trait").agg(F.count_if(F.col("score_pval") < threshold).alias("gwas_hits"))
    pcs = F.size(F.array_intersect("covariates", F.array(*[F.lit(f"pc{i}") for i in range(1, n_pcs + 1)])))
    described = models.select("trait", pcs.alias("pcs"), *[F.array_contains("covariates", c).alias(name) for name, c in covariates.items()])
    return median.select("trait", (F.col("_median") / CHI2_1_MEDIAN).alias("lambda")).join(hits, "trait").join(described, "trait")
