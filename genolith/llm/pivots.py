"""Exact top-k search by inner product over a pivot-distance index.

Vectors get one component more, which makes them all equally long, so that the
largest inner product is the smallest distance. A vector's key is its nearest
pivot and its distance to it; equal-width rings of the distance cut every pivot's
vectors into annuli. A query expands annuli by their lower bound
|d(query, pivot) - d(vector, pivot)| and stops when the bound passes its k-th
distance. The annuli's directory has at most PIVOTS * RINGS rows whatever the
input; annuli and their queries are cut into blocks of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from genolith.session import durable

PIVOTS = 48
RINGS = 24
#: Rows (by hash of the id) that the pivots are chosen from.
SAMPLE = 4096
BLOCK_ROWS = 2048
#: Annuli that a query visits in each round; the last round visits all that the bound leaves.
EXPANSION = (6, 48, None)


def usable(vectors: DataFrame, scale: float = 256.0) -> DataFrame:
    """vec_id and the components floor(scale * x) of the vectors that take part.

    Null ids, null vectors and those with null or non-finite components stay out.
    Of rows with one id the smallest vector counts. Shorter vectors are padded
    with zeros when they meet longer ones.
    """
    x = F.col("embedding").cast("array<double>")
    good = F.col("vec_id").isNotNull() & x.isNotNull() & F.coalesce(
        F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))), F.lit(False))
    whole = vectors.where(good).select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda c: F.floor(c * scale)).alias("v"))
    return whole.groupBy("vec_id").agg(F.min("v").alias("v"))


def _matrix(column, width: int) -> np.ndarray:
    out = np.zeros((len(column), width), np.int64)
    for i, v in enumerate(column):
        out[i, : len(v)] = v
    return out


def _lifted(x: np.ndarray, longest: float) -> np.ndarray:
    x = x.astype(np.float64)
    return np.column_stack([x, np.sqrt(np.maximum(longest - (x * x).sum(1), 0.0))])


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * a @ b.T, 0.0))


def choose_pivots(vectors: DataFrame, width: int, longest: float, count: int = PIVOTS) -> np.ndarray:
    """A few rounds of k-means from spread starting points over a bounded sample."""
    sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()
    x = _lifted(_matrix([r["v"] for r in sample], width), longest)
    chosen, near = [0], np.full(len(x), np.inf)
    while len(chosen) < min(count, len(x)):
        near = np.minimum(near, _distances(x, x[chosen[-1:]])[:, 0])
        if near.max() <= 0:
            break
        chosen.append(int(near.argmax()))
    pivots = x[chosen]
    for _ in range(5):
        owner = _distances(x, pivots).argmin(1)
        pivots = np.stack([x[owner == p].mean(0) if (owner == p).any() else pivots[p] for p in range(len(pivots))])
    return pivots


def _cross(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact integer inner products."""
    top = float(np.abs(queries).max(initial=0)) * float(np.abs(rows).max(initial=0)) * queries.shape[1]
    if top < 2**52:
        return (queries.astype(np.float64) @ rows.astype(np.float64).T).astype(np.int64)
    return queries @ rows.T


def best_rows(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int):
    """(query position, row position, score) of every query's k best rows but its own, ties to smaller ids."""
    order = np.argsort(ids, kind="stable")
    ids, rows = ids[order], rows[order]
    scores = _cross(queries, rows)
    least = np.iinfo(np.int64).min
    scores[query_ids[:, None] == ids[None]] = least
    kth = np.partition(scores, max(scores.shape[1] - k, 0), axis=1)[:, max(scores.shape[1] - k, 0)]
    above = scores > kth[:, None]
    level = scores == kth[:, None]
    take = above | (level & (level.cumsum(1) <= (k - above.sum(1))[:, None]))
    q, r = np.nonzero(take & (scores > least))
    return q, ids[r], scores[q, r]


class PivotIndex:
    """The keyed vectors, the pivots and the directory of annuli."""

    def __init__(self, vectors: DataFrame):
        self.vectors = durable(vectors)
        width, longest = self.vectors.agg(F.max(F.size("v")), F.max(F.aggregate("v", F.lit(0.0), lambda a, c: a + c * c))).first()
        self.width, self.longest = width or 0, float(longest or 0.0)
        if not self.width:
            return
        pivots = choose_pivots(self.vectors, self.width, self.longest)
        radius = 2.0 * np.sqrt(self.longest) + 1e-9
        width, longest, self.pivots = self.width, self.longest, pivots

        def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                d = _distances(_lifted(_matrix(batch.column("v").to_pylist(), width), longest), pivots)
                p = d.argmin(1)
                near = d[np.arange(len(p)), p]
                ring = np.minimum((near / radius * RINGS * 2).astype(np.int64), RINGS - 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(p * RINGS + ring, pa.int32()), pa.array(near), batch.column("vec_id"), batch.column("v")],
                    ["annulus", "distance", "vec_id", "v"])

        self.keyed = durable(self.vectors.mapInArrow(key, "annulus int, distance double, vec_id long, v array<long>"))
        rows = self.keyed.groupBy("annulus").agg(F.count(F.lit(1)).alias("n"), F.min("distance"), F.max("distance")).collect()
        rows.sort()
        self.annuli = np.array([r[0] for r in rows])
        self.counts = np.array([r[1] for r in rows])
        self.inner = np.array([r[2] for r in rows])
        self.outer = np.array([r[3] for r in rows])

    def search(self, queries: DataFrame, k: int) -> DataFrame:
        """query_id, rank, vec_id and score of the k best other vectors of every (vec_id, v) query row."""
        empty = "query_id long, rank int, vec_id long, score long"
        spark = queries.sparkSession
        if not self.width:
            return spark.createDataFrame([], empty)
        queries = durable(queries)
        best = spark.createDataFrame([], "query_id long, vec_id long, score long")
        seen = None
        for reach in EXPANSION:
            visits = durable(self._visits(queries, best, k, seen, reach))
            found = self._visit(queries, visits, k)
            order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
            best = durable(best.unionByName(found).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).drop("rank"))
            seen = visits.select("query_id", "annulus") if seen is None else seen.unionByName(visits.select("query_id", "annulus"))
        return best.select("query_id", F.row_number().over(order).alias("rank"), "vec_id", "score")

    def _visits(self, queries: DataFrame, best: DataFrame, k: int, seen: DataFrame | None, reach: int | None) -> DataFrame:
        """(query_id, v, annulus) that the next round looks at: nearest bounds first, within the k-th distance."""
        worst = best.groupBy("query_id").agg(F.min("score").alias("kth"), F.count(F.lit(1)).alias("held"))
        done = (seen.groupBy("query_id").agg(F.collect_list("annulus").alias("done")) if seen is not None
                else queries.limit(0).select(F.col("vec_id").alias("query_id"), F.array().cast("array<int>").alias("done")))
        state = queries.select(F.col("vec_id").alias("query_id"), "v").join(worst, "query_id", "left").join(done, "query_id", "left")
        pivots, width, longest = self.pivots, self.width, self.longest
        annuli, inner, outer = self.annuli, self.inner, self.outer

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = _matrix(batch.column("v").to_pylist(), width).astype(np.float64)
                to_pivot = _distances(np.column_stack([x, np.zeros(len(x))]), pivots)[:, annuli // RINGS]
                bound = np.maximum(np.maximum(to_pivot - outer, inner - to_pivot), 0.0)
                held, kth = batch.column("held").to_pylist(), batch.column("kth").to_pylist()
                where, which = [], []
                for i, gone in enumerate(batch.column("done").to_pylist()):
                    limit = np.inf
                    if held[i] == k:
                        limit = np.sqrt(max((x[i] ** 2).sum() + longest - 2.0 * kth[i], 0.0))
                    open_ = ~np.isin(annuli, gone or [])
                    near = np.flatnonzero(open_ & (bound[i] <= limit * (1 + 1e-9) + 1e-3))
                    near = near[np.argsort(bound[i][near], kind="stable")][:reach]
                    where += [i] * len(near)
                    which += annuli[near].tolist()
                take = pa.array(where, pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column("query_id").take(take), pa.array(which, pa.int32())], ["query_id", "annulus"])

        return state.mapInArrow(run, "query_id long, annulus int")

    def _visit(self, queries: DataFrame, visits: DataFrame, k: int) -> DataFrame:
        """The k best of every visited annulus, block of rows by block of queries."""
        asked = {r[0]: r[1] for r in visits.groupBy("annulus").count().collect()}
        parts = {int(a): (-(-int(n) // BLOCK_ROWS), -(-asked[int(a)] // BLOCK_ROWS)) for a, n in zip(self.annuli, self.counts) if int(a) in asked}
        spark = visits.sparkSession
        plan = F.broadcast(spark.createDataFrame([(a, r, q) for a, (r, q) in parts.items()], "annulus int, row_parts int, query_parts int"))
        rows = self.keyed.select("annulus", "vec_id", "v").join(plan, "annulus").withColumn(
            "row_part", F.pmod(F.xxhash64("vec_id"), F.col("row_parts")).cast("int")).withColumn(
            "query_part", F.explode(F.sequence(F.lit(0), F.col("query_parts") - 1))).select("annulus", "row_part", "query_part", "vec_id", "v")
        asks = visits.join(queries.select(F.col("vec_id").alias("query_id"), "v"), "query_id").join(plan, "annulus").withColumn(
            "query_part", F.pmod(F.xxhash64("query_id"), F.col("query_parts")).cast("int")).withColumn(
            "row_part", F.explode(F.sequence(F.lit(0), F.col("row_parts") - 1))).select("annulus", "row_part", "query_part", "query_id", "v")
        width = self.width

        def score(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            if not len(left) or not len(right):
                return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
            ids = left["query_id"].to_numpy()
            q, found, scores = best_rows(ids, _matrix(left["v"], width), right["vec_id"].to_numpy(), _matrix(right["v"], width), k)
            return pd.DataFrame({"query_id": ids[q], "vec_id": found, "score": scores})

        keys = ["annulus", "row_part", "query_part"]
        return asks.groupBy(*keys).cogroup(rows.groupBy(*keys)).applyInPandas(score, "query_id long, vec_id long, score long")
