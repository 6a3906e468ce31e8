"""Point-in-interval joins through genome bins.

Every interval is unfolded over the fixed-width bins it touches; a point lies
in one bin, so an equi-join on (contig, bin) plus the exact range test finds
each pair once. No pairwise scan of a chromosome takes place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genolith.session import broadcast_if_small

BIN_WIDTH = 1 << 16


def genome_bin(pos: Column, width: int = BIN_WIDTH) -> Column:
    return F.floor(pos / F.lit(width)).cast("bigint")


def binned(intervals: DataFrame, start: str, end: str, width: int = BIN_WIDTH) -> DataFrame:
    return intervals.withColumn(
        "_bin", F.explode(F.sequence(genome_bin(F.col(start), width), genome_bin(F.col(end), width)))
    )


def range_join(
    points: DataFrame,
    intervals: DataFrame,
    pos: str = "pos",
    start: str = "start_pos",
    end: str = "end_pos",
    contig: str = "contig",
    how: str = "inner",
    width: int = BIN_WIDTH,
) -> DataFrame:
    """Points with the closed intervals holding them; column names other than ``contig`` must differ."""
    left = points.withColumn("_bin", genome_bin(F.col(pos), width))
    bins = broadcast_if_small(binned(intervals.withColumnRenamed(contig, "_contig"), start, end, width).withColumnRenamed("_bin", "_ibin"))
    condition = (
        (F.col(contig) == F.col("_contig"))
        & (F.col("_bin") == F.col("_ibin"))
        & (F.col(pos) >= F.col(start))
        & (F.col(pos) <= F.col(end))
    )
    joined = left.join(bins, condition, how)
    return joined.drop("_bin", "_contig", "_ibin")


def restrict_to_intervals(points: DataFrame, bed: DataFrame, start="start_pos", end="end_pos") -> DataFrame:
    """Points inside any interval, each once."""
    return range_join(points, bed, start=start, end=end, how="left_semi")
