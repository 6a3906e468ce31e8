"""Connected components of a large edge list, and greedy removals per component."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genolith.session import durable, in_few_tasks

#: Pairs that one task settles in order.
TASK_PAIRS = 200_000


def _sides(edges: DataFrame) -> DataFrame:
    both = F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v")))
    return edges.select(F.inline(both))


def _is_stars(edges: DataFrame) -> bool:
    """Whether every distinct (a, b) edge leads from a node of its own to a node that is no edge's start."""
    ends = edges.select(F.inline(F.array(F.struct(F.col("a").alias("node"), F.lit(1).alias("out")), F.struct(F.col("b").alias("node"), F.lit(0).alias("out")))))
    uses = ends.groupBy("node").agg(F.sum("out").alias("starts"), F.count(F.lit(1)).alias("n"))
    # A start has one edge and is no end; an end is never a start.
    return uses.where((F.col("starts") > 0) & (F.col("n") > 1)).isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of the nodes of (a, b) edges; root is the smallest node of the component.

    Alternates hooking every larger neighbour, then every smaller one, to a
    node's least neighbour. Both are a minimum per node and a join, so a node with
    many neighbours is never gathered. It ends when the edges are stars; their
    number never grows.
    """
    edges = durable(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    size = edges.count()
    while not _is_stars(edges):
        sides = _sides(edges)
        least = sides.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = sides.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b")
        large = durable(in_few_tasks(large, size))
        joined = large.join(large.groupBy("a").agg(F.min("b").alias("m")), "a")
        hooked = joined.select(F.inline(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))))
        edges = durable(in_few_tasks(hooked.where("a <> b").distinct(), size))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def remove_until_apart(edges: DataFrame, solve: Callable[[pd.DataFrame], list[int]], one_round: Callable[[DataFrame], DataFrame],
                       task_pairs: int = TASK_PAIRS) -> DataFrame:
    """(node): nodes to remove so that no (a, b, ...) edge is left.

    Components do not touch each other, so tasks settle whole ones with ``solve``,
    many small ones together. A component of more than ``task_pairs`` edges goes
    through rounds (``one_round`` gives the nodes that the same rule removes first)
    until what is left falls apart. Every round removes a node, so it ends.
    """
    spark = edges.sparkSession
    removed = spark.createDataFrame([], "node bigint")
    names = edges.columns
    left = durable(edges)
    while not left.isEmpty():
        rooted = durable(left.join(components(left).withColumnRenamed("node", "a"), "a"))
        sizes = rooted.groupBy("root").agg(F.count(F.lit(1)).alias("pairs"))
        small = sizes.where(F.col("pairs") <= task_pairs).select("root")
        total = rooted.join(small, "root").count()
        parts = max(1, -(-total // max(task_pairs // 4, 1)))
        if total:
            dealt = rooted.join(small, "root").withColumn("part", F.pmod(F.xxhash64("root"), F.lit(parts)))
            solved = dealt.groupBy("part").applyInPandas(lambda pdf: pd.DataFrame({"node": solve(pdf[names])}, dtype="int64"), "node bigint")
            removed = removed.unionByName(durable(solved))
        left = durable(rooted.join(small, "root", "left_anti").select(*names))
        if not left.isEmpty():
            gone = durable(one_round(left))
            removed = removed.unionByName(gone)
            left = durable(left.join(gone.withColumnRenamed("node", "a"), "a", "left_anti").join(gone.withColumnRenamed("node", "b"), "b", "left_anti").select(*names))
    return removed
