"""Bounded matrix blocks: genotype tiles and sums of partial products.

Dense steps never hold a whole genotype matrix. Entries are packed in the tasks that
hold them and grouped to tiles of at most ``block`` variants by ``tile`` samples; products of tiles are added up
in sorted order, one running sum at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genolith.operators.ranking import dense_index
from genolith.session import broadcast_if_small, durable

TILE = 1024
BLOCK = 1024
MISSING = -1


def to_bytes(a: np.ndarray) -> bytes:
    return np.ascontiguousarray(a, dtype=np.float64).tobytes()


def from_bytes(b: bytes, *shape: int) -> np.ndarray:
    a = np.frombuffer(b, dtype=np.float64)
    return a.reshape(shape) if shape else a


def sum_blocks(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Add up equally shaped blocks per key.

    The rows of a key arrive next to each other, so a task keeps one sum.
    """
    columns = [*keys, value]
    schema = df.select(*columns).schema

    def running(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, total = None, None
        for pdf in batches:
            out = []
            for row in pdf.itertuples(index=False):
                key, part = tuple(row[:-1]), np.frombuffer(row[-1], dtype=np.float64)
                if key == last:
                    total += part
                    continue
                if last is not None:
                    out.append((*last, total.tobytes()))
                last, total = key, part.copy()
            if out:
                yield pd.DataFrame(out, columns=columns)
        if last is not None:
            yield pd.DataFrame([(*last, total.tobytes())], columns=columns)

    return df.select(*columns).repartition(*keys).sortWithinPartitions(*keys).mapInPandas(running, schema)


def accumulate(df: DataFrame, keys: list[str], function, salt: Column | None = None) -> DataFrame:
    """Sum ``function(row)`` per key: (keys, block).

    Rows are brought together by key and streamed, so a task holds one running
    sum. ``salt`` spreads a key over several tasks; their sums are then added.
    """
    by = [*keys, "salt"]
    spread = df.withColumn("salt", F.lit(0) if salt is None else salt)
    columns = [*keys, "block"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.select(*keys).schema.fields) + ", block binary"

    def running(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, total = None, None
        for pdf in batches:
            out = []
            for row in pdf.itertuples(index=False):
                key = tuple(getattr(row, k) for k in by)
                if key == last:
                    total += function(row)
                    continue
                if last is not None:
                    out.append((*last[:-1], to_bytes(total)))
                last, total = key, np.array(function(row), dtype=np.float64)
            if out:
                yield pd.DataFrame(out, columns=columns)
        if last is not None:
            yield pd.DataFrame([(*last[:-1], to_bytes(total))], columns=columns)

    summed = spread.repartition(*by).sortWithinPartitions(*by).mapInPandas(running, schema)
    return summed if salt is None else sum_blocks(summed, keys, "block")


def map_rows(df: DataFrame, function, schema: str) -> DataFrame:
    """One output row (a tuple) per input row of blocks."""
    names = [f.strip().split()[0] for f in schema.split(",")]

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame([function(row) for row in pdf.itertuples(index=False)], columns=names)

    return df.mapInPandas(apply, schema)


def sample_tiles(samples: DataFrame, tile: int = TILE) -> tuple[DataFrame, int]:
    """(sample_key, t, ls): tile number and place in it, and the sample count."""
    index = dense_index(samples.select("sample_key").distinct(), "sample_key", "idx")
    tiles = durable(index.select("sample_key", (F.col("idx") / tile).cast("int").alias("t"), (F.col("idx") % tile).cast("int").alias("ls")))
    return tiles, tiles.count()


def hashed_block(n_variants: int, block: int = BLOCK) -> Column:
    """Variant block by hash: about ``block`` variants each, no index needed."""
    return F.pmod(F.xxhash64("variant_key"), F.lit(max(1, -(-n_variants // block)))).cast("int")


#: Calls that a task looks at together to pack them.
PACK_ROWS = 1 << 18
#: Codes of packed calls: no entry, no call; 2, 3 and 4 stand for 0, 1 and 2 copies.
ABSENT, NO_CALL = 0, 1
_TRIPLES = np.stack(np.unravel_index(np.arange(125), (5, 5, 5)), axis=1).astype(np.uint8)
_QUADS = np.stack([np.arange(256) >> s & 3 for s in (0, 2, 4, 6)], axis=1).astype(np.int8) - 1


def packed_calls(entries: DataFrame, tiles: DataFrame, tile: int = TILE) -> DataFrame:
    """(variant_key, vb, t, listed, packed): a variant's calls in a tile of samples, put together before they are shuffled.

    Tasks take the calls as they come. Calls of a variant and tile that lie together become codes of the whole tile,
    three to a byte; scattered and repeated ones are listed with their places. Several rows may share a variant and tile.
    ``entries`` may carry the block number ``vb``. Calls of samples outside ``tiles`` or without a variant are left out.
    """
    gt = F.col("gt")
    code = F.when(gt.isNull(), NO_CALL).when(gt.between(0, 2), gt + 2).otherwise(ABSENT)
    place = F.col("t").cast("bigint") * tile + F.col("ls")
    block = F.col("vb").cast("int") if "vb" in entries.columns else F.lit(0)
    placed = entries.where(F.col("variant_key").isNotNull()).join(broadcast_if_small(tiles), "sample_key").select(
        "variant_key", block.alias("vb"), (place * 8 + code).alias("x"))
    width = 3 * -(-tile // 3)
    kind = entries.schema["variant_key"].dataType.simpleString()

    def settle(v: np.ndarray, vb: np.ndarray, x: np.ndarray, last: bool) -> tuple[pa.RecordBatch | None, tuple]:
        if not (x & 7).all():
            raise ValueError("calls must be 0, 1, 2 or null")
        ids, place = v if v.dtype.kind == "i" else pd.factorize(v)[0], x >> 3
        t = place // tile
        starts = np.flatnonzero(np.concatenate([[True], (ids[1:] != ids[:-1]) | (t[1:] != t[:-1])]))
        end = len(v)
        if len(starts) * 8 > len(v):
            order = np.lexsort((t, ids))
            v, vb, x, ids, place, t = (a[order] for a in (v, vb, x, ids, place, t))
            starts = np.flatnonzero(np.concatenate([[True], (ids[1:] != ids[:-1]) | (t[1:] != t[:-1])]))
        elif not last and len(starts) > 1:
            # The last variant and tile may go on in the next batch.
            end, starts = starts[-1], starts[:-1]
        rest = (v[end:], vb[end:], x[end:])
        size = np.diff(np.append(starts, end))
        x, ls = x[:end], (place - t * tile)[:end]
        dense = size * 12 >= tile
        run = np.repeat(np.arange(len(starts)), size)
        mats = np.zeros((int(dense.sum()), width), np.uint8)
        flat = (np.cumsum(dense) - 1)[run] * width + ls
        loose = np.flatnonzero(~dense[run])
        tight = np.flatnonzero(dense[run])
        mats.ravel()[flat[tight]] = (x[tight] & 7).astype(np.uint8)
        if np.count_nonzero(mats) < len(tight):
            # Repeated calls: the first of each place stays in the tile.
            first = np.sort(np.unique(flat[tight], return_index=True)[1])
            mats.ravel()[flat[tight][first]] = (x[tight][first] & 7).astype(np.uint8)
            loose = np.sort(np.concatenate([loose, np.delete(tight, first)]))
        bytes_of = mats[:, 0::3] * np.uint8(25) + mats[:, 1::3] * np.uint8(5) + mats[:, 2::3]
        payload = [row.tobytes() for row in bytes_of]
        at = starts[dense]
        if len(loose):
            entry = (ls[loose] << 3 | x[loose] & 7).astype("<u4")
            cuts = np.flatnonzero(np.concatenate([[True], run[loose][1:] != run[loose][:-1]]))
            payload += [part.tobytes() for part in np.split(entry, cuts[1:])]
            at = np.concatenate([at, starts[run[loose][cuts]]])
        out = pa.RecordBatch.from_arrays(
            [pa.array(v[at]), pa.array(vb[at], pa.int32()), pa.array(t[at], pa.int32()), pa.array(np.arange(len(at)) >= len(mats)), pa.array(payload, pa.binary())],
            names=["variant_key", "vb", "t", "listed", "packed"])
        return out, rest

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(tuple(c.to_numpy(zero_copy_only=False) for c in batch.columns))
            size += batch.num_rows
            if size >= PACK_ROWS:
                out, rest = settle(*map(np.concatenate, zip(*held)), last=False)
                yield out
                held, size = [rest], len(rest[0])
        if size:
            yield settle(*map(np.concatenate, zip(*held)), last=True)[0]

    return placed.mapInArrow(pack, f"variant_key {kind}, vb int, t int, listed boolean, packed binary")


#: Samples of a word of calls.
WORD = 64


def word_places(tiles: DataFrame, tile: int = TILE) -> DataFrame:
    """(sample_key, word, bit): the word of samples that a sample is in, numbered over all tiles, and its bit there."""
    words = -(-tile // WORD)
    return tiles.select("sample_key", (F.col("t") * words + F.floor(F.col("ls") / WORD)).cast("int").alias("word"), F.expr(f"shiftleft(1L, ls % {WORD})").alias("bit"))


def call_words(entries: DataFrame, tiles: DataFrame, tile: int = TILE, *more: Column) -> DataFrame:
    """(variant_key, [vb], word, none, zero, one, two, *more): which samples of a word have no call, 0, 1 or 2 copies, as bits.

    An aggregate in the tasks that hold the calls; nothing but words leaves the JVM. ``more`` are further aggregates.
    A sample with several calls of a variant has a bit for each kind of them.
    """
    gt, bit, none = F.col("gt"), F.col("bit"), F.lit(0).cast("bigint")
    held = lambda wanted: F.bit_or(F.when(wanted, bit).otherwise(none))
    two = F.when(gt == 2, bit).when(gt.isNull() | gt.isin(0, 1), none).otherwise(F.raise_error(F.lit("calls must be 0, 1, 2 or null")).cast("bigint"))
    placed = entries.where(F.col("variant_key").isNotNull()).join(broadcast_if_small(word_places(tiles, tile)), "sample_key")
    keys = ["variant_key", *(["vb"] if "vb" in entries.columns else []), "word"]
    return placed.groupBy(*keys).agg(
        held(gt.isNull()).alias("none"), held(gt == 0).alias("zero"), held(gt == 1).alias("one"), F.bit_or(two).alias("two"), *more)


def has_repeated_calls(entries: DataFrame, tiles: DataFrame) -> bool:
    """Whether a sample of ``tiles`` has several calls of one variant; a pass over the calls."""
    placed = entries.where(F.col("variant_key").isNotNull()).join(broadcast_if_small(word_places(tiles)), "sample_key")
    words = placed.groupBy("variant_key", "word").agg(F.count(F.lit(1)).alias("n"), F.bit_or("bit").alias("held"))
    return words.where(F.col("n") != F.bit_count("held")).agg(F.count(F.lit(1))).first()[0] > 0


def _word_codes(none: np.ndarray, zero: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Codes of the samples of each word; of several calls the larger code."""
    codes = np.zeros((len(none), WORD), np.uint8)
    for code, bits in enumerate((none, zero, one, two), NO_CALL):
        np.maximum(codes, np.unpackbits(np.ascontiguousarray(bits, "<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little") * np.uint8(code), out=codes)
    return codes


def packed_words(words: DataFrame, tile: int = TILE) -> DataFrame:
    """The rows of ``packed_calls``, from the words of ``call_words``; without ``vb`` the block is 0."""
    words_a_tile, width = -(-tile // WORD), 3 * -(-tile // 3)
    block = F.col("vb").cast("int") if "vb" in words.columns else F.lit(0)
    kind = words.schema["variant_key"].dataType.simpleString()

    def settle(v: np.ndarray, vb: np.ndarray, word: np.ndarray, *bits: np.ndarray, last: bool) -> tuple[pa.RecordBatch, tuple]:
        ids, t = v if v.dtype.kind == "i" else pd.factorize(v)[0], word // words_a_tile
        begins = lambda: np.flatnonzero(np.concatenate([[True], (ids[1:] != ids[:-1]) | (t[1:] != t[:-1])]))
        starts, end = begins(), len(v)
        if len(starts) > 1 and len(starts) * min(8, words_a_tile) > len(v):
            order = np.lexsort((word, ids))
            v, vb, word, ids, t, *bits = (a[order] for a in (v, vb, word, ids, t, *bits))
            starts = begins()
        elif not last and len(starts) > 1:
            # The last variant and tile may go on in the next batch.
            end, starts = starts[-1], starts[:-1]
        rest = tuple(a[end:] for a in (v, vb, word, *bits))
        codes = _word_codes(*[b[:end] for b in bits])
        size = np.diff(np.append(starts, end))
        run = np.repeat(np.arange(len(starts)), size)
        calls_held = np.add.reduceat(np.count_nonzero(codes, axis=1), starts)
        dense = calls_held * 12 >= tile
        mats = np.zeros((int(dense.sum()), words_a_tile, WORD), np.uint8)
        tight = dense[run]
        mats[(np.cumsum(dense) - 1)[run[tight]], (word[:end] % words_a_tile)[tight]] = codes[tight]
        flat = mats.reshape(len(mats), words_a_tile * WORD)
        if flat.shape[1] < width:
            flat = np.pad(flat, ((0, 0), (0, width - flat.shape[1])))
        bytes_of = flat[:, 0:width:3] * np.uint8(25) + flat[:, 1:width:3] * np.uint8(5) + flat[:, 2:width:3]
        payload = [row.tobytes() for row in bytes_of]
        at = starts[dense]
        loose = np.flatnonzero(~tight)
        if len(loose):
            row, place = np.nonzero(codes[loose])
            entry = ((word[loose[row]] % words_a_tile * WORD + place) << 3 | codes[loose[row], place]).astype("<u4")
            cuts = np.flatnonzero(np.concatenate([[True], run[loose[row]][1:] != run[loose[row]][:-1]]))
            payload += [part.tobytes() for part in np.split(entry, cuts[1:])]
            at = np.concatenate([at, starts[run[loose[row]][cuts]]])
        out = pa.RecordBatch.from_arrays(
            [pa.array(v[at]), pa.array(vb[at], pa.int32()), pa.array(t[at], pa.int32()), pa.array(np.arange(len(at)) >= len(mats)), pa.array(payload, pa.binary())],
            names=["variant_key", "vb", "t", "listed", "packed"])
        return out, rest

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(tuple(c.to_numpy(zero_copy_only=False) for c in batch.columns))
            size += batch.num_rows
            if size * 4 >= PACK_ROWS:
                out, rest = settle(*map(np.concatenate, zip(*held)), last=False)
                yield out
                held, size = [rest], len(rest[0])
        if size:
            yield settle(*map(np.concatenate, zip(*held)), last=True)[0]

    sent = words.select("variant_key", block.alias("vb"), "word", "none", "zero", "one", "two")
    return sent.mapInArrow(pack, f"variant_key {kind}, vb int, t int, listed boolean, packed binary")


def stored_words(words: DataFrame, *more: str) -> DataFrame:
    """``call_words``, written with two bits a call; places without a call are as those without an entry, of several calls the larger stays."""
    c = F.col
    low = c("two").bitwiseOR(c("zero").bitwiseAND(F.bitwise_not(c("one"))))
    written = durable(words.select("variant_key", "word", low.alias("low"), c("one").bitwiseOR(c("two")).alias("high"), *more))
    only = lambda a, b: c(a).bitwiseAND(F.bitwise_not(c(b)))
    return written.select("variant_key", "word", F.lit(0).cast("bigint").alias("none"), only("low", "high").alias("zero"), only("high", "low").alias("one"),
                          c("low").bitwiseAND(c("high")).alias("two"), *more)


def unique_calls(entries: DataFrame, tiles: DataFrame, tile: int = TILE) -> DataFrame:
    """``packed_calls`` of calls of which no sample has two of one variant; raises where one has."""
    words = call_words(entries, tiles, tile, F.count(F.lit(1)).alias("n"))
    held = F.bit_count(F.col("none").bitwiseOR(F.col("zero")).bitwiseOR(F.col("one")).bitwiseOR(F.col("two")))
    one = F.when(F.col("n") == held, F.col("none")).otherwise(F.raise_error(F.lit("a sample has several calls of one variant")).cast("bigint"))
    return packed_words(words.withColumn("none", one), tile)


def dense_codes(packed: bytes, tile: int) -> np.ndarray:
    """Codes of a whole tile."""
    return _TRIPLES[np.frombuffer(packed, np.uint8)].reshape(-1)[:tile]


def listed_codes(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Places and codes of listed calls."""
    x = np.frombuffer(packed, "<u4")
    return x >> 3, (x & 7).astype(np.uint8)


def put_codes(codes: np.ndarray, listed: bool, packed: bytes) -> None:
    """Put packed calls into the codes of one variant in a tile; of a repeated call the larger code stays."""
    if listed:
        np.maximum.at(codes, *listed_codes(packed))
    else:
        np.maximum(codes, dense_codes(packed, len(codes)), out=codes)


def put_rows(codes: np.ndarray, row: np.ndarray, listed: np.ndarray, packed: np.ndarray) -> None:
    """``put_codes`` of many packed rows, each into the row of ``codes`` that ``row`` gives."""
    whole = np.flatnonzero(~listed.astype(bool))
    if len(whole) and len(np.unique(row[whole])) == len(whole):
        found = _TRIPLES[np.frombuffer(b"".join(packed[whole]), np.uint8)].reshape(len(whole), -1)[:, :codes.shape[1]]
        codes[row[whole]] = np.maximum(codes[row[whole]], found)
        rest = np.flatnonzero(listed.astype(bool))
    else:
        rest = np.arange(len(row))
    for i in rest:
        put_codes(codes[row[i]], listed[i], packed[i])


def four_a_byte(codes: np.ndarray) -> bytes:
    """Rows of codes, none of them ABSENT, as ``calls`` reads them."""
    c = np.pad(codes - np.uint8(NO_CALL), ((0, 0), (0, -codes.shape[1] % 4)))
    return (c[:, 0::4] | c[:, 1::4] << 2 | c[:, 2::4] << 4 | c[:, 3::4] << 6).tobytes()


def genotype_tiles(entries: DataFrame, tiles: DataFrame, tile: int = TILE, block: Column | DataFrame | None = None) -> DataFrame:
    """(vb, t, keys, mat): calls, variants by samples, four to a byte (``calls`` reads them).

    ``entries`` carry the block number ``vb``, or ``block`` gives it: an expression of ``variant_key`` or the table
    (variant_key, vb) of the variants to keep. ``tiles`` come from ``sample_tiles``. A group holds one block of variants by one tile of
    samples, whatever the size of the cohort. Of a repeated entry the larger call counts.
    """

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        keys, row = np.unique(pdf["variant_key"].to_numpy(), return_inverse=True)
        codes = np.full((len(keys), tile), NO_CALL, dtype=np.uint8)
        put_rows(codes, row, pdf["listed"].to_numpy(), pdf["packed"].to_numpy())
        return pd.DataFrame({"vb": [pdf["vb"].iloc[0]], "t": [pdf["t"].iloc[0]], "keys": [keys], "mat": [four_a_byte(codes)]})

    packed = packed_words(in_blocks(call_words(entries, tiles, tile), block), tile)
    return packed.groupBy("vb", "t").applyInPandas(pack, "vb int, t int, keys array<bigint>, mat binary")


def in_blocks(words: DataFrame, block: Column | DataFrame | None) -> DataFrame:
    """``words`` with their block number ``vb``, by an expression of ``variant_key`` or the table (variant_key, vb) of the variants to keep."""
    if block is None:
        return words
    if isinstance(block, DataFrame):
        return words.join(broadcast_if_small(block.select("variant_key", "vb")), "variant_key")
    return words.withColumn("vb", block)


def calls(mat: bytes, tile: int = TILE) -> np.ndarray:
    """int8 calls of a tile, -1 for no call."""
    return _QUADS[np.frombuffer(mat, dtype=np.uint8)].reshape(-1, 4 * -(-tile // 4))[:, :tile]


def align(keys: np.ndarray, mat: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Rows of ``mat`` in the order of ``wanted``; absent variants have no calls."""
    if len(keys) == len(wanted) and np.array_equal(keys, wanted):
        return mat
    out = np.full((len(wanted), mat.shape[1]), MISSING, dtype=mat.dtype)
    place = np.searchsorted(wanted, keys)
    place = np.minimum(place, len(wanted) - 1)
    here = wanted[place] == keys
    out[place[here]] = mat[here]
    return out
