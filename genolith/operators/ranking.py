"""Ranks, percentiles, medians and p-value adjustment without a global window.

A window without partitions would sort the whole table in one task. Here equal
values are first counted together (which also takes the sting out of a value
shared by a third of the rows), the distinct values are range-partitioned and
checkpointed so that every later step sees the same ranges, and each range gets
the totals of the ranges before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from genolith.functions.special import normal_quantile
from genolith.session import durable, in_more_tasks


def cumulative_counts(df: DataFrame, value: str, by: list[str] | None = None) -> DataFrame:
    """Distinct non-null values per group with their place in the order.

    Columns: ``by``, ``value``, ``n`` (rows with the value), ``before`` (rows
    with a smaller one), ``total`` (rows in the group), ``_range``.
    """
    by = by or []
    counted = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))
    ranged = durable(counted.repartitionByRange(*by, value).withColumn("_range", F.spark_partition_id()))
    rows = ranged.count()
    ranged = in_more_tasks(ranged, rows, *by, "_range")
    # One row per group and range: at most groups + partitions rows.
    sums = ranged.groupBy(*by, "_range").agg(F.sum("n").alias("_sum"))
    if by:
        sums = in_more_tasks(sums, rows, *by)
    order = W.partitionBy(*by).orderBy("_range")
    offsets = sums.select(
        *by, "_range",
        F.coalesce(F.sum("_sum").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_offset"),
        F.sum("_sum").over(W.partitionBy(*by)).alias("total"),
    )
    inside = W.partitionBy(*by, "_range").orderBy(value).rowsBetween(W.unboundedPreceding, -1)
    return (
        ranged.join(offsets, [*by, "_range"])
        .withColumn("before", F.col("_offset") + F.coalesce(F.sum("n").over(inside), F.lit(0)))
        .drop("_offset")
    )


def attach(df: DataFrame, per_value: DataFrame, value: str, by: list[str], columns: list[str]) -> DataFrame:
    """Bring per-value results back to the rows; a NULL value gets NULLs."""
    return df.join(per_value.select(*by, value, *columns), [*by, value], "left")


def percentile_rank(df: DataFrame, value: str, out: str | None = None, by: list[str] | None = None) -> DataFrame:
    """Average rank divided by the number of values."""
    by, out = by or [], out or f"{value}_percentile"
    counts = cumulative_counts(df, value, by).withColumn(
        out, (F.col("before") + (F.col("n") + 1) / 2) / F.col("total")
    )
    return attach(df, counts, value, by, [out])


def irnt(df: DataFrame, value: str, out: str | None = None, offset: bool = False) -> DataFrame:
    """Inverse-rank normal transform.

    The largest value has percentile 1 and so becomes +infinity; with
    ``offset`` the ranks are shifted by one half, which keeps it finite.
    """
    out = out or f"{value}_irnt"
    counts = cumulative_counts(df, value)
    rank = F.col("before") + (F.col("n") + 1) / 2
    share = (rank - 0.5) / F.col("total") if offset else rank / F.col("total")
    return attach(df, counts.withColumn("_share", share).withColumn(out, normal_quantile(F.col("_share"))), value, [], [out])


def exact_quantile(df: DataFrame, value: str, q: float = 0.5, by: list[str] | None = None, out: str = "quantile") -> DataFrame:
    """Interpolated quantile per group; no group's values are held together."""
    by = by or []
    counts = cumulative_counts(df, value, by)
    place = (F.col("total") - 1) * F.lit(q)
    low, high = F.floor(place), F.ceil(place)
    covers = lambda i: (F.col("before") <= i) & (i < F.col("before") + F.col("n"))
    picked = counts.groupBy(*by).agg(
        F.max(F.when(covers(low), F.col(value))).alias("_low"),
        F.max(F.when(covers(high), F.col(value))).alias("_high"),
        F.max(place - low).alias("_part"),
    )
    return picked.select(*by, (F.col("_low") + (F.col("_high") - F.col("_low")) * F.col("_part")).alias(out))


def adjust_p(df: DataFrame, p: str, by: list[str] | None = None, bh: str = "fdr", bonferroni: str = "bonferroni") -> DataFrame:
    """Benjamini-Hochberg step-up and Bonferroni adjusted p-values.

    adj(i) is the smallest of min(1, p(j) n / j) over j >= i; the smallest over
    later ranges comes from one row per range.
    """
    by = by or []
    counts = cumulative_counts(df, p, by).withColumn(
        "_raw", F.least(F.lit(1.0), F.col(p) * F.col("total") / (F.col("before") + F.col("n")))
    )
    after = W.partitionBy(*by).orderBy("_range").rowsBetween(1, W.unboundedFollowing)
    later = counts.groupBy(*by, "_range").agg(F.min("_raw").alias("_min")).select(
        *by, "_range", F.min("_min").over(after).alias("_later")
    )
    inside = W.partitionBy(*by, "_range").orderBy(p).rowsBetween(0, W.unboundedFollowing)
    adjusted = (
        counts.withColumn("_suffix", F.min("_raw").over(inside))
        .join(later, [*by, "_range"])
        .withColumn(bh, F.least("_suffix", F.coalesce("_later", F.lit(1.0))))
        .withColumn(bonferroni, F.least(F.lit(1.0), F.col(p) * F.col("total")))
    )
    return attach(df, adjusted, p, by, [bh, bonferroni])


def adjust_by_phenotype(df: DataFrame, p: str = "pvalue", phenotype: str = "phenotype", tissue: str = "tissue") -> DataFrame:
    """Adjust within each phenotype; cross-tissue (``Meta``) rows stay NULL and uncounted."""
    single = df.withColumn("_p", F.when(F.col(tissue) != "Meta", F.col(p)))
    return adjust_p(single, "_p", [phenotype], "fdr_phenotype", "bonferroni_phenotype").drop("_p")


def qq_table(df: DataFrame, p: str) -> DataFrame:
    """Observed against expected -log10 p, one row per input row.

    Tied p-values take consecutive ranks; the expected value of the i-th
    smallest of n is (i - 1/2) / n.
    """
    counts = cumulative_counts(df.where((F.col(p) > 0) & (F.col(p) <= 1)), p)
    ranks = counts.select(p, "total", F.explode(F.sequence(F.col("before") + 1, F.col("before") + F.col("n"))).alias("rank"))
    return ranks.select(
        "rank",
        (-F.log10((F.col("rank") - 0.5) / F.col("total"))).alias("expected"),
        (-F.log10(F.col(p))).alias("observed"),
    )


def dense_index(df: DataFrame, key: str, out: str) -> DataFrame:
    """0, 1, 2, ... in key order for a table of distinct keys."""
    return cumulative_counts(df.select(key), key).select(key, F.col("before").cast("bigint").alias(out))
