"""The registered queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from genolith import fixtures as fx
from genolith.operators.genotypes import GenotypeSet

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(function):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = fx.with_views(oracle)
        return function

    return register


def r(column, digits: int = 8) -> Column:
    """Rounded double, so sums taken in another order compare equal."""
    c = F.col(column) if isinstance(column, str) else column
    return F.round(c.cast("double"), digits)


def rounded(df: DataFrame, *columns: str, digits: int = 8) -> DataFrame:
    return df.withColumns({c: r(c, digits) for c in columns})


def genotypes(spark: SparkSession, sf_dir: str) -> GenotypeSet:
    return GenotypeSet(*[fx.view(spark, sf_dir, f"fx_{n}") for n in ("variants", "samples", "entries")])
