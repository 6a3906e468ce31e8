import numpy as np
import pytest
from pyspark.sql import functions as F

from genolith.operators import blocks


def test_tiles_hold_the_calls_in_any_order(spark):
    """Dense, scattered and repeated calls, and tiles that are no multiple of four."""
    rng = np.random.default_rng(2)
    g = rng.integers(-1, 3, (9, 23))
    rows = [(v, s, None if g[v, s] < 0 else int(g[v, s])) for v in range(9) for s in range(23) if v != 4 or s % 7 == 0]
    rows = [rows[i] for i in rng.permutation(len(rows))] + rows[:40]
    entries = spark.createDataFrame(rows, "variant_key bigint, sample_key bigint, gt int").coalesce(1)
    tiles, n = blocks.sample_tiles(spark.range(23).withColumnRenamed("id", "sample_key"), 10)
    found = blocks.genotype_tiles(entries.withColumn("vb", (F.col("variant_key") % 2).cast("int")), tiles, 10).collect()
    want = g.copy()
    want[4, [s for s in range(23) if s % 7]] = -1
    assert n == 23 and len(found) == 6
    for row in found:
        mat = blocks.calls(row["mat"], 10)
        width = min(10, 23 - 10 * row["t"])
        assert mat.shape == (len(row["keys"]), 10) and (mat[:, width:] == -1).all()
        assert (mat[:, :width] == want[row["keys"], 10 * row["t"]: 10 * row["t"] + width]).all()


def test_calls_are_packed_before_the_shuffle(spark, genotypes):
    _, _, people, entries = genotypes
    tiles, _ = blocks.sample_tiles(people, 16)
    plan = blocks.genotype_tiles(entries.withColumn("vb", F.lit(0)), tiles, 16)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("FlatMapGroupsInPandas") < plan.index("Exchange hashpartitioning(vb") < plan.index("MapInArrow")


def test_a_variant_split_over_batches_is_whole(spark, monkeypatch):
    """More calls than are packed at once, in order and interleaved."""
    monkeypatch.setattr(blocks, "PACK_ROWS", 64)
    tiles, _ = blocks.sample_tiles(spark.range(50).withColumnRenamed("id", "sample_key"), 50)
    entries = spark.range(500).selectExpr("id div 50 AS variant_key", "id % 50 AS sample_key", "cast(id % 3 AS INT) AS gt")
    for order in ("variant_key", "sample_key"):
        one = entries.coalesce(1).sortWithinPartitions(order).withColumn("vb", F.lit(0))
        row, = blocks.genotype_tiles(one, tiles, 50).collect()
        assert (blocks.calls(row["mat"], 50) == np.arange(500).reshape(10, 50) % 3).all()


def test_words_hold_the_calls_of_packed_calls(spark):
    """Tiles of several words, none of them full; absent, missing, scattered and few calls; more words than are packed at once."""
    rng = np.random.default_rng(7)
    rows = [(v, s, [None, 0, 1, 2][rng.integers(4)]) for v in range(30) for s in range(333) if v % 5 or s % 90 == 3]
    rows = [rows[i] for i in rng.permutation(len(rows))]
    entries = spark.createDataFrame(rows + [(None, 3, 1), (4, 999, 1)], "variant_key bigint, sample_key bigint, gt int").repartition(3)
    tiles, _ = blocks.sample_tiles(spark.range(333).withColumnRenamed("id", "sample_key"), 150)

    def codes(packed):
        found = {}
        for row in packed.collect():
            tile = found.setdefault((row["variant_key"], row["t"]), np.zeros(150, np.uint8))
            blocks.put_codes(tile, row["listed"], row["packed"])
        return {(v, t * 150 + i): int(c) for (v, t), tile in found.items() for i, c in enumerate(tile) if c}

    want = {(v, s): 1 if g is None else g + 2 for v, s, g in rows}
    assert codes(blocks.unique_calls(entries, tiles, 150)) == codes(blocks.packed_calls(entries, tiles, 150)) == want


def test_only_words_go_to_python(spark, genotypes):
    _, _, people, entries = genotypes
    tiles, _ = blocks.sample_tiles(people, 16)
    plan = blocks.unique_calls(entries, tiles, 16)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("MapInArrow") < plan.index("Aggregate")


def test_repeated_calls_are_found_and_refused(spark):
    tiles, _ = blocks.sample_tiles(spark.range(100).withColumnRenamed("id", "sample_key"), 100)
    once = spark.range(300).selectExpr("id div 100 AS variant_key", "id % 100 AS sample_key", "cast(id % 3 AS INT) AS gt")
    twice = once.unionByName(spark.createDataFrame([(1, 70, None)], once.schema))
    assert not blocks.has_repeated_calls(once, tiles) and blocks.has_repeated_calls(twice, tiles)
    with pytest.raises(Exception, match="several calls of one variant"):
        blocks.unique_calls(twice, tiles, 100).collect()


def test_tiles_are_built_from_words(spark, genotypes):
    _, _, people, entries = genotypes
    tiles, _ = blocks.sample_tiles(people, 16)
    found = blocks.genotype_tiles(entries, tiles, 16, blocks.hashed_block(60, 20))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("MapInArrow") < plan.index("Aggregate")
    plain = blocks.genotype_tiles(entries.withColumn("vb", blocks.hashed_block(60, 20)), tiles, 16)
    listed = blocks.genotype_tiles(entries, tiles, 16, entries.select("variant_key", blocks.hashed_block(60, 20).alias("vb")).distinct())
    held = [sorted((r["vb"], r["t"], tuple(r["keys"]), bytes(r["mat"])) for r in x.collect()) for x in (found, plain, listed)]
    assert held[0] == held[1] == held[2]
