"""Helpers shared by the operators: ids, words, blocks of text, native word expressions."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are maximal runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words longer than this are hashed one by one.
LONG_WORD = 40
#: Text worked on at once by a task, in bytes.
BLOCK_BYTES = 6 << 20


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def row_key(*columns: str) -> Column:
    """A 64-bit key of a row's values; equal rows have equal keys."""
    return F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in columns])


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of 64-bit hashes (uint64 in, uint64 out)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def blocks(batches: Iterator[pa.RecordBatch], column: str, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut to blocks of about ``limit`` bytes of ``column`` (a longer row is a block of its own)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        ends = np.cumsum(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def release_memory() -> None:
    """Give a task's freed memory back, since Spark keeps its Python worker for later tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


@dataclass
class Words:
    """The words of a block: ``codes`` into ``dictionary``, document d's at ``starts[d]:starts[d + 1]``."""

    codes: np.ndarray
    starts: np.ndarray
    dictionary: pa.Array


def words_of(texts: pa.Array, lower: bool = True) -> Words:
    """Words of a block of texts (no nulls); ``lower`` lower-cases A-Z first."""
    if lower:
        texts = pc.ascii_lower(texts)
    lists = pc.ascii_split_whitespace(texts)
    offsets = lists.offsets.to_numpy()
    encoded = lists.flatten().dictionary_encode()
    codes = encoded.indices.to_numpy(zero_copy_only=False)
    dictionary = encoded.dictionary
    starts = (offsets - offsets[0]).astype(np.int64)
    empty = pc.index(dictionary, pa.scalar("", dictionary.type)).as_py()
    if empty >= 0:
        keep = codes != empty
        starts = np.concatenate([[0], np.cumsum(keep)])[starts]
        codes = codes[keep]
    return Words(codes, starts, dictionary)


def word_hashes(dictionary: pa.Array) -> np.ndarray:
    """64-bit hashes of the words of a dictionary: byte by byte over all words at once, long words one by one."""
    n = len(dictionary)
    if not n:
        return np.empty(0, np.uint64)
    offsets = np.frombuffer(dictionary.buffers()[1], np.int32)[dictionary.offset: dictionary.offset + n + 1].astype(np.int64)
    data = np.frombuffer(dictionary.buffers()[2], np.uint8)
    lengths = np.diff(offsets)
    out = lengths.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    order = np.argsort(-lengths, kind="stable")
    order = order[np.searchsorted(-lengths[order], -LONG_WORD):]  # shorter words only, longest first
    sizes = -lengths[order]
    at, value = offsets[order], out[order]
    for j in range(LONG_WORD):
        m = np.searchsorted(sizes, -j)  # words of more than j bytes
        if not m:
            break
        value[:m] = (value[:m] ^ data[at[:m] + j]) * np.uint64(0xFF51AFD7ED558CCD)
        value[:m] ^= value[:m] >> np.uint64(32)
    out[order] = mix(value)
    for i in np.flatnonzero(lengths > LONG_WORD):
        out[i] = xxhash.xxh64_intdigest(data[offsets[i]:offsets[i + 1]].tobytes())
    return out


#: Odd multipliers of the five words of a shingle.
SHINGLE_FACTORS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)


def shingle_hashes(words: Words, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the word shingles of every document, repeats included, and where each document starts.

    A document with fewer than ``size`` words gives its whole sequence as one
    shingle, one without words none.
    """
    hashed = word_hashes(words.dictionary)[words.codes] if len(words.codes) else np.empty(0, np.uint64)
    n = np.diff(words.starts)
    short = np.flatnonzero((n > 0) & (n < size))
    rolled = np.zeros(len(hashed), np.uint64)
    for j in range(size):
        m = len(hashed) - j
        if m > 0:
            rolled[:m] += hashed[j:] * SHINGLE_FACTORS[j]
    rolled = mix(rolled)
    counts = np.where(n >= size, n - size + 1, 0)
    keep = np.zeros(len(hashed) + 1, np.int64)
    full = np.flatnonzero(counts)
    np.add.at(keep, words.starts[full], 1)
    np.add.at(keep, words.starts[full] + counts[full], -1)
    keep = np.cumsum(keep[:-1]) > 0
    for d in short:
        a, b = words.starts[d], words.starts[d + 1]
        with np.errstate(over="ignore"):
            value = np.uint64(len(range(a, b))) + np.sum(hashed[a:b] * SHINGLE_FACTORS[: b - a], dtype=np.uint64)
        rolled[a] = mix(np.array([value]))[0]
        keep[a] = True
        counts[d] = 1
    return rolled[keep], np.concatenate([[0], np.cumsum(counts)])


def gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... of all the runs, one after another."""
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)
