"""Sample and variant quality control.

Statistics come from one aggregate over the long entries; Spark combines
partial sums map-side, so a common variant or a large sample never becomes one
task's data.
"""

from __future__ import annotations

from dataclasses import replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from genolith.operators.genotypes import GenotypeSet


def _field_stats(name: str) -> list:
    return [
        F.avg(name).alias(f"{name}_mean"),
        F.min(name).alias(f"{name}_min"),
        F.max(name).alias(f"{name}_max"),
        F.stddev_pop(name).alias(f"{name}_sd"),
    ]


def sample_qc(entries: DataFrame) -> DataFrame:
    """Call rate, GQ and DP statistics per sample."""
    return entries.groupBy("sample_key").agg(
        (F.count("gt") / F.count(F.lit(1))).alias("call_rate"), *_field_stats("gq"), *_field_stats("dp")
    )


def _call_aggregates() -> list:
    return [
        F.count(F.lit(1)).alias("n_entries"),
        F.count("gt").alias("n_called"),
        F.coalesce(F.sum("gt"), F.lit(0)).cast("bigint").alias("ac"),
        F.count_if(F.col("gt") == 0).alias("n_hom_ref"),
        F.count_if(F.col("gt") == 1).alias("n_het"),
        F.count_if(F.col("gt") == 2).alias("n_hom_alt"),
    ]


def _with_frequencies(stats: DataFrame) -> DataFrame:
    an = F.col("n_called") * 2
    return (
        stats.withColumn("an", an)
        .withColumn("ac_ref", F.col("an") - F.col("ac"))
        .withColumn("af", F.when(F.col("an") > 0, F.col("ac") / F.col("an")))
    )


def call_stats(entries: DataFrame) -> DataFrame:
    """Allele counts (``ac_ref``, ``ac``), number, frequency and homozygote counts."""
    return _with_frequencies(entries.groupBy("variant_key").agg(*_call_aggregates()))


def variant_qc(entries: DataFrame, with_hwe: bool = True, more: list | None = None) -> DataFrame:
    """Call counts, rates and GQ and DP statistics per variant; ``more`` aggregates are taken in the same pass."""
    stats = _with_frequencies(
        entries.groupBy("variant_key").agg(*_call_aggregates(), *_field_stats("gq"), *_field_stats("dp"), *(more or []))
    ).withColumn("call_rate", F.col("n_called") / F.col("n_entries"))
    if with_hwe:
        stats = stats.withColumn("p_hwe", hwe_mid_p("n_hom_ref", "n_het", "n_hom_alt"))
    return stats


#: Heterozygote counts worked on at once.
HWE_CELLS = 2_000_000


#: Cells whose log weight is that far below both the largest and the observed one are lost in rounding.
HWE_DEPTH = 60.0


def _hwe_batch(hom1: pd.Series, het: pd.Series, hom2: pd.Series) -> pd.Series:
    counts = np.stack([np.minimum(hom1, hom2), het, np.maximum(hom1, hom2)], axis=1).astype(np.int64)
    distinct, back = np.unique(counts, axis=0, return_inverse=True)
    limit = int(counts.sum(axis=1).max()) * 2 + 2 if len(counts) else 2
    log_fact = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, limit)))])
    rare, common, het_ = 2 * distinct[:, 0] + distinct[:, 1], 2 * distinct[:, 2] + distinct[:, 1], distinct[:, 1]

    def log_weight(r: np.ndarray, c: np.ndarray, cell: np.ndarray) -> np.ndarray:
        hets = 2 * cell + r % 2
        return hets * np.log(2.0) - log_fact[(r - hets) // 2] - log_fact[hets] - log_fact[(c - hets) // 2]

    def first_cell(low: np.ndarray, high: np.ndarray, test) -> np.ndarray:
        """The first cell of each variant that passes; ``high`` where none before it does."""
        low, high = low.copy(), high.copy()
        while (low < high).any():
            mid = np.minimum((low + high) // 2, np.maximum(high - 1, low))
            passed = test(mid)
            low, high = np.where(passed | (low >= high), low, mid + 1), np.where(passed & (low < high), mid, high)
        return low

    # The weights rise to one peak and fall again; only the cells around it that count are summed, about the root of the cohort's size.
    none, top, seen = np.zeros(len(distinct), np.int64), rare // 2, (het_ - rare % 2) // 2
    weight_at = lambda cell: log_weight(rare, common, cell)
    peak = first_cell(none, top, lambda cell: weight_at(cell + 1) <= weight_at(cell))
    floor = np.minimum(weight_at(peak), weight_at(seen)) - HWE_DEPTH
    begin = first_cell(none, peak, lambda cell: weight_at(cell) >= floor)
    sizes = first_cell(peak, top + 1, lambda cell: weight_at(cell) < floor) - begin
    result = np.empty(len(distinct))
    # The cells of many variants side by side, a bounded number at a time.
    ends = np.cumsum(sizes)
    first = 0
    while first < len(distinct):
        last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + HWE_CELLS, side="right")))
        part = slice(first, last)
        starts = np.concatenate([[0], np.cumsum(sizes[part])[:-1]])
        owner = np.repeat(np.arange(last - first), sizes[part])
        log_p = log_weight(rare[part][owner], common[part][owner], np.arange(len(owner)) - starts[owner] + begin[part][owner])
        weight = np.exp(log_p - np.maximum.reduceat(log_p, starts)[owner])
        observed = log_p[starts + (seen - begin)[part]][owner]
        tie = np.abs(log_p - observed) < 1e-9
        mass = np.where(tie, 0.5 * weight, np.where(log_p < observed, weight, 0.0))
        result[part] = np.add.reduceat(mass, starts) / np.add.reduceat(weight, starts)
        first = last
    return pd.Series(result[back.reshape(-1)])


def hwe_mid_p(hom_ref: str, het: str, hom_alt: str):
    """Exact Hardy-Weinberg mid-p value from genotype counts."""
    return F.pandas_udf(_hwe_batch, T.DoubleType())(hom_ref, het, hom_alt)


def qc_histogram(df: DataFrame, column: str, low: float, high: float, bins: int = 50) -> DataFrame:
    """Bin counts; bin 0 holds values below ``low``, ``bins + 1`` those above ``high``."""
    x = F.col(column).cast("double")
    inside = F.least(F.floor((x - low) / ((high - low) / bins)) + 1, F.lit(bins))
    bin_index = F.when(x < low, 0).when(x > high, bins + 1).otherwise(inside).cast("int")
    return (
        df.where(x.isNotNull() & ~F.isnan(x))
        .groupBy(bin_index.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("bin_start", F.when(F.col("bin").between(1, bins), low + (F.col("bin") - 1) * ((high - low) / bins)))
    )


# Histogram ranges of the standard QC report.
QC_RANGES = {"call_rate": (0.8, 1.0), "gq_mean": (10.0, 70.0), "dp_mean": (20.0, 50.0),
             "gq_min": (10.0, 70.0), "dp_min": (20.0, 50.0)}


def dp_call_rate_pairs(stats: DataFrame, key: str) -> DataFrame:
    return stats.select(key, "dp_mean", "dp_min", "call_rate")


# --- filters -----------------------------------------------------------------


def passing_samples(stats: DataFrame, min_dp=24, min_call_rate=0.85, min_gq=40) -> DataFrame:
    return stats.where((F.col("dp_mean") > min_dp) & (F.col("call_rate") > min_call_rate) & (F.col("gq_mean") > min_gq))


def passing_variants(stats: DataFrame, min_dp=25, min_call_rate=0.9, min_gq=40) -> DataFrame:
    return passing_samples(stats, min_dp, min_call_rate, min_gq)


def filter_samples_qc(g: GenotypeSet, **limits) -> GenotypeSet:
    return g.keep_samples(passing_samples(sample_qc(g.entries), **limits))


def filter_variants_qc(g: GenotypeSet, **limits) -> GenotypeSet:
    return g.keep_variants(passing_variants(variant_qc(g.entries, with_hwe=False), **limits))


def ac_window(stats: DataFrame, k: int = 0) -> DataFrame:
    """Some allele has k < AC < AN - k (with k = 0: the site is polymorphic)."""
    inside = [(F.col(c) > k) & (F.col(c) < F.col("an") - k) for c in ("ac", "ac_ref")]
    return stats.where(inside[0] | inside[1])


def filter_polymorphic(g: GenotypeSet) -> GenotypeSet:
    return g.keep_variants(ac_window(call_stats(g.entries), 0))


def filter_ac(g: GenotypeSet, k: int = 10) -> GenotypeSet:
    return g.keep_variants(ac_window(call_stats(g.entries), k))


def filter_ac_by_phenotype(g: GenotypeSet, phenotypes: DataFrame, phenotype: str, k: int = 5) -> GenotypeSet:
    with_value = phenotypes.where(F.col(phenotype).isNotNull()).select("sample_key").distinct()
    return filter_ac(g.keep_samples(with_value), k)


def common_in_equilibrium(stats: DataFrame, min_af=0.01, min_p=1e-6) -> DataFrame:
    return stats.where((F.col("af") > min_af) & (1 - F.col("af") > min_af) & (F.col("p_hwe") > min_p))


def gwas_filter(g: GenotypeSet) -> GenotypeSet:
    stats = call_stats(g.entries).withColumn("p_hwe", hwe_mid_p("n_hom_ref", "n_het", "n_hom_alt"))
    return g.keep_variants(common_in_equilibrium(stats))


def singletons(stats: DataFrame) -> DataFrame:
    return stats.where((F.col("ac") == 1) | (F.col("ac_ref") == 1))


def rare_filter(g: GenotypeSet) -> GenotypeSet:
    return g.keep_variants(singletons(call_stats(g.entries)))


def filter_typed_ac(g: GenotypeSet, k: int = 1) -> GenotypeSet:
    """Genotyped (not only imputed) sites inside the allele-count window."""
    typed = g.variants.where(F.col("typed") | F.col("typed_only"))
    return filter_ac(replace(g, variants=typed, entries=g.entries.join(typed.select("variant_key"), "variant_key", "left_semi")), k)
