"""Source divergence audit: how far a source's terms are from those of other sources and of its language.

Every (language, source) group gives each kept term of its language a smoothed share. The
divergence of two groups sums a function of both shares over all kept terms; a share depends
on the term's count, its level, alone. So terms are rows of a one-hot matrix with a column per
(group, level), level 0 included, and the matrix' transpose times itself holds the joint table of
levels of every two groups at once. The products are taken block by block of terms and tile by tile of
groups, in floating point on counts far below 2^24, hence exact; each cell is then priced once,
however many terms share its two levels. Blocks hold terms of like frequency, so that few levels occur.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from genolith.llm.common import BLOCK_BYTES, blocks, text_or_empty
from genolith.session import durable

#: Documents of a language that a kept term occurs in at least.
LEAST_DOCUMENTS = 10
SHARE_UNIT = 1_000_000_000
TOP_TERMS = 10
#: Terms of a block, and one-hot columns of a tile.
BLOCK_TERMS, TILE_COLUMNS = 512, 1024
#: Distinct (group, term) counts that a task holds before it passes them on.
MOST_HELD = 1 << 20
COUNT_SCHEMA = "lang string, source string, term string, n long, documents long"

#: What each byte becomes: letters lower-cased, other ASCII a space, all else itself.
TERM_BYTES = np.array([b if b > 127 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256)], np.uint8)


def _terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(codes, documents, dictionary): every term occurrence of a block of texts."""
    texts = texts.cast(pa.large_string())
    if texts.buffers()[2] is None or not len(texts):
        return np.empty(0, np.int64), np.empty(0, np.int64), pa.array([], pa.large_string())
    data = TERM_BYTES[np.frombuffer(texts.buffers()[2], np.uint8)]
    plain = pa.Array.from_buffers(pa.large_string(), len(texts), [None, texts.buffers()[1], pa.py_buffer(data)], offset=texts.offset)
    lists = pc.ascii_split_whitespace(plain)
    doc = pc.list_parent_indices(lists).to_numpy()
    encoded = lists.flatten().dictionary_encode()
    codes = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    empty = pc.index(encoded.dictionary, pa.scalar("", encoded.dictionary.type)).as_py()
    keep = codes != empty
    return codes[keep], doc[keep], encoded.dictionary


def term_counts(docs: DataFrame) -> DataFrame:
    """``COUNT_SCHEMA``: occurrences of every term in every group and how many of its documents hold it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0

        def flushed() -> list[pa.RecordBatch]:
            merged = pa.concat_tables(held).group_by(["lang", "source", "term"]).aggregate([("n", "sum"), ("documents", "sum")])
            merged = merged.select(["lang", "source", "term", "n_sum", "documents_sum"]).rename_columns(["lang", "source", "term", "n", "documents"])
            return merged.combine_chunks().to_batches()

        for block in blocks(batches, "text", BLOCK_BYTES // 3):
            codes, doc, dictionary = _terms(block.column("text"))
            if not len(codes):
                continue
            lang, source = block.column("lang").dictionary_encode(), block.column("source").dictionary_encode()
            groups = lang.indices.to_numpy().astype(np.int64) * len(source.dictionary) + source.indices.to_numpy()
            per_doc, times = np.unique(doc * len(dictionary) + codes, return_counts=True)
            key = groups[per_doc // len(dictionary)] * len(dictionary) + per_doc % len(dictionary)
            cells, which, documents = np.unique(key, return_inverse=True, return_counts=True)
            group, term = cells // len(dictionary), cells % len(dictionary)
            held.append(pa.table({
                "lang": lang.dictionary.take(pa.array(group // len(source.dictionary))).cast(pa.string()),
                "source": source.dictionary.take(pa.array(group % len(source.dictionary))).cast(pa.string()),
                "term": dictionary.take(pa.array(term)).cast(pa.string()),
                "n": np.bincount(which, times).astype(np.int64), "documents": documents.astype(np.int64)}))
            rows += len(cells)
            if rows > MOST_HELD:
                yield from flushed()
                held.clear()
                rows = 0
        if held:
            yield from flushed()

    counted = docs.mapInArrow(run, COUNT_SCHEMA)
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("documents").alias("documents"))


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SHARE_UNIT * (count + 2) / (total + 2 * terms)), in whole numbers; null where there are no terms."""
    whole = "decimal(38,0)"
    above = F.lit(SHARE_UNIT).cast("decimal(10,0)") * (count.cast("decimal(19,0)") + F.lit(2).cast("decimal(1,0)")).cast("decimal(20,0)")
    below = (total.cast("decimal(19,0)") + F.lit(2).cast("decimal(1,0)") * terms.cast("decimal(18,0)")).cast(whole)
    # The remainder is taken off first, so that the quotient is whole.
    above = above.cast(whole)
    return F.when(below > 0, (F.lit(1) + ((above - above % below) / below).cast("long"))).cast("long")


def priced(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / (p + q)) of shares, which stay below 2^30."""
    return (p - q) * (p - q) // (p + q)


def joint_values(group: np.ndarray, share: np.ndarray, terms: np.ndarray, n_terms: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(left group, right group, value summed over the block's terms), tile by tile.

    One row per (term, group), every group with every term: the group's number, the share, the term's number.
    """
    # One-hot columns are the (group, level) pairs; equal shares of a group are one level.
    order = np.lexsort((share, group))
    group, share, terms = group[order], share[order], terms[order]
    new = np.concatenate([[True], (group[1:] != group[:-1]) | (share[1:] != share[:-1])])
    column = np.cumsum(new) - 1
    owner, level = group[new], share[new]
    firsts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    bounds = np.append(firsts, len(owner))
    # Tiles of whole groups.
    tiles, start = [], 0
    for i in range(1, len(bounds)):
        if i == len(bounds) - 1 or bounds[i + 1] - bounds[start] > TILE_COLUMNS:
            tiles.append((start, i))
            start = i
    rows = np.searchsorted(column, np.arange(len(owner) + 1))

    def one_hot(tile: tuple[int, int]) -> np.ndarray:
        a, z = bounds[tile[0]], bounds[tile[1]]
        out = np.zeros((n_terms, z - a), np.float32)
        s = slice(rows[a], rows[z])
        out[terms[s], column[s] - a] = 1
        return out

    for i, left in enumerate(tiles):
        x = one_hot(left)
        for right in tiles[i:]:
            y = x if right is left else one_hot(right)
            joint = np.rint(x.T @ y).astype(np.int64)
            p, q = level[bounds[left[0]]:bounds[left[1]]], level[bounds[right[0]]:bounds[right[1]]]
            worth = joint * priced(p[:, None], q[None, :])
            own, other = firsts[left[0]:left[1]], firsts[right[0]:right[1]]
            value = np.add.reduceat(np.add.reduceat(worth, own - own[0], axis=0), other - other[0], axis=1)
            a, b = np.meshgrid(owner[own], owner[other], indexing="ij")
            keep = a < b
            yield a[keep], b[keep], value[keep]


def kept_terms(counts: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """lang, term and n (occurrences in the language) of the terms in enough documents."""
    return counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("documents").alias("documents")).where(
        F.col("documents") >= least).drop("documents")


def audit(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """lang, source, part, item, value and rank.

    Part ``pair`` ranks all other sources of the language by their divergence, part ``term``
    the group's ten terms that add most to its excess over the language. Null text, language and source count
    as empty ones. Texts of any length are counted whole. Ties go to the smaller item by bytes. Repeated rows and ids count as
    documents each; groups without terms have their pairs, with the value 0 where the language keeps no term. Extra columns
    are ignored; an empty table gives no rows.
    """
    rows = docs.select(text_or_empty().alias("text"), text_or_empty("lang").alias("lang"), text_or_empty("source").alias("source"))
    counts = durable(term_counts(rows))
    kept = durable(kept_terms(counts, least_documents))
    entries = durable(counts.drop("documents").join(kept, ["lang", "term"]))

    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("lang_n").alias("lang_total"))
    totals = entries.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = rows.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0, ["total", "terms", "lang_total"])
    numbered = Window.partitionBy("lang").orderBy("source")
    groups = durable(groups.withColumn("g", F.row_number().over(numbered).cast("int")).withColumn("zero", share(F.lit(0), F.col("total"), F.col("terms"))))
    shares = durable(entries.join(groups, ["lang", "source"]).select(
        "lang", "source", "g", "term", "n", "lang_n", share(F.col("n"), F.col("total"), F.col("terms")).alias("p"),
        share(F.col("lang_n"), F.col("lang_total"), F.col("terms")).alias("q")))
    return _pairs(shares, kept, groups).unionByName(_top_terms(shares))


def _ranked(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(order).cast("int")).select("lang", "source", "part", "item", "value", "rank")


def _top_terms(shares: DataFrame) -> DataFrame:
    p, q = F.col("p"), F.col("q")
    value = F.expr("(p - q) * (p - q) div (p + q)")
    rows = shares.where(p > q).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), value.alias("value"))
    return _ranked(rows).where(F.col("rank") <= TOP_TERMS)


def _pairs(shares: DataFrame, kept: DataFrame, groups: DataFrame) -> DataFrame:
    # Blocks: terms of a language within a factor of two in frequency, dealt by hash into parts of about BLOCK_TERMS.
    classed = kept.withColumn("class", F.floor(F.log2(F.col("lang_n"))).cast("int"))
    parts = classed.groupBy("lang", "class").agg(F.ceil(F.count(F.lit(1)) / BLOCK_TERMS).cast("int").alias("parts"))
    dealt = durable(classed.join(parts, ["lang", "class"]).select(
        "lang", "term", "class", F.pmod(F.xxhash64("term"), F.col("parts")).cast("int").alias("part")))
    cells = shares.join(dealt, ["lang", "term"]).select("lang", "class", "part", "term", "g", "p")
    listed = durable(dealt.select("lang", "class", "part").distinct().join(groups.select("lang", "g", "zero"), "lang"))

    def product(key: tuple, cells: pd.DataFrame, listed: pd.DataFrame) -> pd.DataFrame:
        """All of a block's joint tables, priced and summed."""
        term, names = pd.factorize(cells["term"])
        place = pd.Series(np.arange(len(listed)), listed["g"].to_numpy())
        share = np.repeat(listed["zero"].to_numpy()[:, None], len(names), axis=1)
        share[place.loc[cells["g"]].to_numpy(), term] = cells["p"].to_numpy()
        group = np.repeat(listed["g"].to_numpy(), len(names))
        found = list(joint_values(group, share.ravel(), np.tile(np.arange(len(names)), len(listed)), len(names)))
        a, b, value = (np.concatenate([f[k] for f in found]) for k in range(3))
        return pd.DataFrame({"lang": key[0], "a": a, "b": b, "value": value})

    blocked = cells.groupBy("lang", "class", "part").cogroup(listed.groupBy("lang", "class", "part")).applyInPandas(
        product, "lang string, a int, b int, value long")
    summed = blocked.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = summed.unionByName(summed.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    names = groups.select("lang", F.col("g").alias("a"), "source")
    items = groups.select("lang", F.col("g").alias("b"), F.col("source").alias("item"))
    every = names.join(items, "lang").where("a <> b").join(both, ["lang", "a", "b"], "left")
    return _ranked(every.select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).alias("value")))
