"""Mixing sources to target weights by a low-discrepancy schedule.

Every source's documents, shuffled, form a stream of words that is cut into
blocks of equal length and may be run through again. The points
``frac(i * golden ratio)`` of the slots i are mapped through the cumulative
target shares to sources; the slots of a source, ranked, take its blocks in turn.
So any stretch of the schedule holds the sources close to their shares. All steps
are DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from genolith.llm.common import WORD, row_key, text_or_empty
from genolith.session import durable

GOLDEN = 0.6180339887498949
BLOCK_WORDS = 1024
#: Ranks are counted within cells of the schedule and of the shuffled streams, so that no source is one task's work.
SLOT_CELL = 4096
STREAM_CELLS = 256
SHUFFLE_SEED = 11


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def source_totals(sized: DataFrame) -> DataFrame:
    """source, source_size and documents per source; null is a source of its own."""
    return sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("documents"))


def _ranked(totals: DataFrame) -> DataFrame:
    """Position of every source by code point, null last, counted cell by cell.

    The cell is the beginning of the name: cells are counted first, so only
    one row per cell meets in one window.
    """
    cell = F.coalesce(F.substring(F.hex(F.encode("source", "UTF-8")), 1, 6), F.lit("~"))
    cells = totals.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n"))
    before = cells.select("cell", F.coalesce(F.sum("n").over(
        Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("cell").orderBy(F.hex(F.encode("source", "UTF-8"))))
    return totals.withColumn("cell", cell).join(before, "cell").select(
        "source", "source_size", "documents", (F.col("before") + inside - 1).alias("position"))


def source_targets(sized: DataFrame, weights: list[float], epochs: float, share: float) -> DataFrame:
    """source, source_size and target of every source.

    ``weights`` repeat over the sources by code point. The targets sum to
    ``share`` of all sizes, none above ``epochs`` times its source's size; what a
    capped source leaves goes to the others by weight. Each round caps at least
    one source more or ends, and only sums reach the driver.
    """
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("position") % len(weights) + 1).cast("int"))
    table = durable(_ranked(source_totals(sized)).withColumn("weight", weight).withColumn("cap", F.col("source_size") * epochs))
    total = table.agg(F.sum("source_size")).first()[0] or 0
    budget, level, seen = share * total, None, -1
    while True:
        capped = F.lit(False) if level is None else F.col("cap") <= level * F.col("weight")
        fixed, free, n = table.agg(F.sum(F.when(capped, F.col("cap"))), F.sum(F.when(~capped, F.col("weight"))), F.count_if(capped)).first()
        if not free or n == seen:
            break
        seen, level = n, (budget - (fixed or 0.0)) / free
    level = F.lit(0.0 if level is None else level)
    return durable(table.select("source", "source_size", F.least(F.col("cap"), level * F.col("weight")).alias("target")))


def streams(sized: DataFrame) -> DataFrame:
    """``sized`` with the place of every document in its source's shuffled stream.

    Adds cell, pos (unique with source and cell) and begin, the words before it.
    """
    order = F.xxhash64(F.lit(SHUFFLE_SEED), "key")
    cell = F.shiftrightunsigned(order, 64 - (STREAM_CELLS.bit_length() - 1)).cast("int")
    celled = sized.withColumn("ord", F.shiftrightunsigned(order, 1)).withColumn("cell", cell)
    sums = celled.groupBy("source", "cell").agg(F.sum("size").alias("words"))
    before = sums.select("source", "cell", F.coalesce(F.sum("words").over(
        Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    inside = Window.partitionBy("source", "cell").orderBy("ord", "key")
    placed = celled.withColumn("pos", F.row_number().over(inside)).withColumn(
        "inner", F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    keyed = before.select(F.col("source").alias("s"), F.col("cell").alias("c"), "before")
    return placed.join(keyed, F.col("source").eqNullSafe(F.col("s")) & (F.col("cell") == F.col("c"))).withColumn(
        "begin", F.col("before") + F.col("inner")).drop("s", "c", "before", "inner", "ord")


def schedule(targets: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """slot, source and rank: the rank-th block of its source fills the slot.

    A source whose blocks have all been placed leaves its further points unused,
    and blocks that the points have not reached follow at the end.
    """
    spark = targets.sparkSession
    total = targets.agg(F.sum("target")).first()[0] or 0.0
    slots = int(-(-total // block))
    quota = F.ceil(F.round("target") / block).cast("long")
    order = Window.orderBy(F.col("source").asc_nulls_last())
    shares = targets.where(F.col("target") > 0).withColumn("upto", F.sum("target").over(order) / F.lit(total or 1.0)).withColumn(
        "from", F.coalesce(F.lag("upto").over(order), F.lit(0.0))).select("source", "from", "upto", quota.alias("quota"))
    # Points and shares meet on a grid of the unit interval: a share lies in every grid cell that it touches.
    grid = 1024
    point = F.expr(f"pmod(id * {GOLDEN}D, 1D)")
    points = spark.range(slots).select(F.col("id").alias("slot"), point.alias("point")).withColumn("g", F.floor(F.col("point") * grid).cast("int"))
    parts = shares.withColumn("g", F.explode(F.sequence(F.floor(F.col("from") * grid).cast("int"), F.floor(F.col("upto") * grid).cast("int"))))
    hits = points.join(parts, "g").where((F.col("point") >= F.col("from")) & (F.col("point") < F.col("upto"))).select("slot", "source", "quota")
    celled = hits.withColumn("cell", F.floor(F.col("slot") / SLOT_CELL))
    counts = celled.groupBy("source", "cell").count()
    before = counts.select(F.col("source").alias("s"), F.col("cell").alias("c"), F.coalesce(F.sum("count").over(
        Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("source", "cell").orderBy("slot")) - 1
    ranked = celled.withColumn("inside", inside).join(before, F.col("source").eqNullSafe(F.col("s")) & (F.col("cell") == F.col("c"))).select(
        "slot", "source", (F.col("before") + F.col("inside")).alias("rank"), "quota").where("rank < quota").drop("quota")
    reached = counts.groupBy(F.col("source").alias("s")).agg(F.sum("count").alias("reached"))
    late = shares.join(reached, F.col("source").eqNullSafe(F.col("s")), "left").withColumn("reached", F.coalesce("reached", F.lit(0))).where(
        "reached < quota").select("source", F.explode(F.sequence(F.col("reached"), F.col("quota") - 1)).alias("rank"))
    return ranked.unionByName(late.select(F.lit(slots).cast("long").alias("slot"), "source", "rank"))


def mix_pieces(placed: DataFrame, slots: DataFrame, targets: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """The placed documents' words in every slot: one row per document and block of its source, or one with null slot.

    Adds target, slot, epoch, start (in the document) and length.
    """
    t = targets.select(F.col("source").alias("s"), "source_size", "target")
    d = placed.join(F.broadcast(t) if _few(t) else t, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    limit = F.round("target").cast("long")
    run = F.explode_outer(F.when(F.col("size") > 0, F.expr("filter(sequence(0L, 1L), e -> begin + e * source_size < round(target))"))).alias("epoch")
    d = d.select("*", run).withColumn("at", F.col("begin") + F.col("epoch") * F.col("source_size"))
    d = d.withColumn("upto", F.least(F.col("at") + F.col("size"), limit))
    first, last = F.floor(F.col("at") / block).cast("long"), F.floor((F.col("upto") - 1) / block).cast("long")
    d = d.select("*", F.explode_outer(F.when(F.col("epoch").isNotNull(), F.sequence(first, last))).alias("block"))
    s = slots.select("slot", F.col("source").alias("s"), F.col("rank").alias("b"))
    j = d.join(s, F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b")), "left").drop("s", "b")
    begin = F.greatest(F.col("at"), F.col("block") * block)
    end = F.least(F.col("upto"), (F.col("block") + 1) * block)
    return j.withColumn("start", F.when(F.col("slot").isNotNull(), begin - F.col("at"))).withColumn(
        "length", F.when(F.col("slot").isNotNull(), end - begin)).drop("at", "upto")


def _few(table: DataFrame, limit: int = 100_000) -> bool:
    """Whether a written table has at most ``limit`` rows and its names at most 200 bytes each."""
    rows, width = table.agg(F.count(F.lit(1)), F.max(F.octet_length("s"))).first()
    return rows <= limit and (width or 0) <= 200


def mix(docs: DataFrame, weights: list[float], share: float = 1.5, epochs: int = 2, block: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, size, source, source_size, target, taken and place in the schedule of every document.

    The place is the first and last slot that hold words of the document (null if
    none do) and how many pieces of it are in slots; what is taken follows from the
    targets, the slots from the points.
    Null text has no words. Null sources form one source, last in the order.
    Rows with equal ids are documents of their own; documents without words take
    part with taken 0. An empty table gives no rows. Extra columns are ignored.
    ``epochs`` above 2 would need a longer run of the streams.
    """
    if not 0 < epochs <= 2 or share > epochs:
        raise ValueError("a source is run through at most twice, and the share must fit")
    return _mixed(docs, weights, share, epochs, block).drop("key")


def _mixed(docs: DataFrame, weights: list[float], share: float, epochs: int, block: int) -> DataFrame:
    """The rows of ``mix`` with the key of the whole row."""
    sized = durable(docs.select(_key().alias("key"), F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                                word_count(text_or_empty()).alias("size")))
    targets = source_targets(sized, weights, epochs, share)
    placed = durable(streams(sized))
    pieces = mix_pieces(placed, schedule(targets, block), targets, block)
    return pieces.groupBy("source", "cell", "pos", "key", "doc_id", "size", "source_size", "target").agg(
        F.coalesce(F.sum("length"), F.lit(0)).alias("taken"), F.min("slot").alias("first_slot"), F.max("slot").alias("last_slot"),
        F.count("slot").alias("slots")).drop("cell", "pos")


def _key():
    return row_key("doc_id", "source", "text")


def mixed_documents(docs: DataFrame, weights: list[float], share: float = 1.5, epochs: int = 2) -> DataFrame:
    """The mix as documents: a row for every run through a document, cut to the words that the mix takes.

    Only the document at a source's target is cut; its words are then parted by
    single spaces and ``n_chars``, if there, is counted anew. Documents that the mix
    leaves out, those without words among them, go. Identical rows share evenly
    what they take together.
    """
    taken = _mixed(docs, weights, share, epochs, BLOCK_WORDS).where("taken > 0").groupBy(F.col("key").alias("__key")).agg(
        F.max("size").alias("__size"), F.round(F.sum("taken") / F.count(F.lit(1))).cast("long").alias("__taken")).where("__taken > 0")
    joined = docs.withColumn("__key", _key()).join(taken, "__key")
    runs = F.explode(F.expr("transform(sequence(0L, (__taken - 1) div __size), e -> least(__size, __taken - e * __size))"))
    joined = joined.select("*", runs.alias("__words"))
    cut = F.col("__words") < F.col("__size")
    text = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), F.lit(1), F.col("__words").cast("int")), " ")
    joined = joined.withColumn("text", F.when(cut, text).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        joined = joined.withColumn("n_chars", F.when(cut, F.length("text")).otherwise(F.col("n_chars")))
    return joined.select(*docs.columns)
