"""Expression matrices: one row per transcript, one column per sample."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from genolith.session import scratch_table

IDS = ["transcript_id", "gene_id"]


def melt(wide: DataFrame) -> DataFrame:
    """(transcript_id, gene_id, sample_column, x)."""
    values = [c for c in wide.columns if c not in IDS]
    numeric = wide.select(*IDS, *[F.col(f"`{c}`").cast("double").alias(c) for c in values])
    return numeric.unpivot(IDS, [F.col(f"`{c}`") for c in values], "sample_column", "x")


def read_expression_matrix(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """Read the text matrix and melt it; the header gives the sample columns."""
    header = spark.read.option("sep", sep).option("header", True).csv(path).columns
    schema = T.StructType([T.StructField(c, T.StringType() if c in IDS else T.DoubleType()) for c in header])
    return melt(spark.read.option("sep", sep).option("header", True).schema(schema).csv(path))


def write_wide(wide: DataFrame, path: str | None = None, sep: str = "\t") -> str:
    path = path or scratch_table(wide.sparkSession, "expression")
    wide.write.mode("overwrite").option("sep", sep).option("header", True).csv(path)
    return path
