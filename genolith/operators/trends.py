"""Ordered per-subject series: rises, falls, resettable counters.

The visits are range-partitioned by (subject, time), so a subject with a third
of all rows is spread over many tasks. Every task condenses its stretch of a
subject's series to one row; the stretches then meet in a small window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def _stretches(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return df.repartitionByRange(*keys, *order).withColumn("_part", F.spark_partition_id())


def _fell(now: Column, before: Column) -> Column:
    """Negative relative change, also for negative starting values."""
    return F.when(before >= 0, now < before).otherwise(now > before)


def _rose(now: Column, before: Column) -> Column:
    return F.when(before >= 0, now > before).otherwise(now < before)


def series_summary(df: DataFrame, keys: list[str], order: list[str], value: str, missing: float | None = None) -> DataFrame:
    """Per key: ``n_values``, ``fell``, ``rose``, ``last_value``, ``counter_total``.

    Missing values are skipped (so each value is compared with the last known
    one) unless ``missing`` gives a code to put in their place.
    ``counter_total`` adds up the peaks of a counter that restarts from a
    smaller value.
    """
    x = F.col(value).cast("double")
    series = df.select(*keys, *order, (x if missing is None else F.coalesce(x, F.lit(float(missing)))).alias("_x"))
    series = _stretches(series.where(F.col("_x").isNotNull()), keys, order)
    place = F.struct(*order)
    before = F.lag("_x").over(W.partitionBy(*keys, "_part").orderBy(*order))
    now = F.col("_x")
    parts = (
        series.withColumn("_before", before)
        .groupBy(*keys, "_part")
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.min_by("_x", place).alias("_first"),
            F.max_by("_x", place).alias("_last"),
            F.bool_or(_fell(now, F.col("_before"))).alias("_fell"),
            F.bool_or(_rose(now, F.col("_before"))).alias("_rose"),
            F.sum(F.when(now < F.col("_before"), F.col("_before"))).alias("_peaks"),
        )
    )
    # One row per key and stretch: at most keys + partitions rows in all.
    linked = parts.withColumn("_previous", F.lag("_last").over(W.partitionBy(*keys).orderBy("_part")))
    return linked.groupBy(*keys).agg(
        F.sum("_n").alias("n_values"),
        F.coalesce(F.bool_or(F.coalesce("_fell", F.lit(False)) | F.coalesce(_fell(F.col("_first"), F.col("_previous")), F.lit(False))), F.lit(False)).alias("fell"),
        F.coalesce(F.bool_or(F.coalesce("_rose", F.lit(False)) | F.coalesce(_rose(F.col("_first"), F.col("_previous")), F.lit(False))), F.lit(False)).alias("rose"),
        F.max_by("_last", "_part").alias("last_value"),
        (
            F.sum(
                F.coalesce("_peaks", F.lit(0.0))
                + F.coalesce(F.when(F.col("_first") < F.col("_previous"), F.col("_previous")), F.lit(0.0))
            )
            + F.max_by("_last", "_part")
        ).alias("counter_total"),
    )


def ever_changed(
    df: DataFrame, keys: list[str], order: list[str], value: str, prefix: str, min_count: int = 3, missing: float | None = None
) -> DataFrame:
    """``<prefix>_ever_decreased`` / ``_ever_increased``; NULL with fewer than ``min_count`` values."""
    enough = F.col("n_values") >= min_count
    return series_summary(df, keys, order, value, missing).select(
        *keys,
        F.when(enough, F.col("fell")).alias(f"{prefix}_ever_decreased"),
        F.when(enough, F.col("rose")).alias(f"{prefix}_ever_increased"),
    )


def resettable_total(df: DataFrame, keys: list[str], order: list[str], value: str, out: str) -> DataFrame:
    """Sum of the peaks of a counter that may restart."""
    return series_summary(df, keys, order, value).select(*keys, F.col("counter_total").alias(out))


def resettable_total_legacy(df: DataFrame, keys: list[str], order: list[str], value: str, out: str) -> DataFrame:
    """The historical form: 0 without a restart; at each restart the peak before it
    plus the largest value still to come.
    """
    series = df.where(F.col(value).isNotNull()).select(*keys, *order, F.col(value).cast("double").alias("_x"))
    series = _stretches(series, keys, order)
    inside = W.partitionBy(*keys, "_part").orderBy(*order)
    rows = series.withColumns(
        {
            "_before": F.lag("_x").over(inside),
            "_ahead": F.max("_x").over(inside.rowsBetween(0, W.unboundedFollowing)),
            "_is_first": F.row_number().over(inside) == 1,
        }
    )
    place = F.struct(*order)
    parts = series.groupBy(*keys, "_part").agg(F.max_by("_x", place).alias("_last"), F.max("_x").alias("_max"))
    across = W.partitionBy(*keys).orderBy("_part")
    parts = parts.select(
        *keys, "_part",
        F.lag("_last").over(across).alias("_previous"),
        F.max("_max").over(across.rowsBetween(1, W.unboundedFollowing)).alias("_later"),
    )
    before = F.when(F.col("_is_first"), F.col("_previous")).otherwise(F.col("_before"))
    restart = F.when(F.col("_x") < before, before + F.greatest("_ahead", F.coalesce("_later", F.col("_ahead"))))
    return rows.join(parts, [*keys, "_part"]).groupBy(*keys).agg(F.coalesce(F.sum(restart), F.lit(0.0)).alias(out))
