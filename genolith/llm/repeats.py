"""Repeated passages by two-stage suffix sorting.

Every ``LENGTH``-byte window has an anchor, its least ``GRAM``-byte hash, so equal
windows have equal anchors at equal places. Runs of windows with one anchor form
stretches. Anchors that occur once end there; equal stretches (copies, insides of
shared passages) are repeated as a whole. What is left, stretches that share an
anchor but differ, is compared by suffix arrays: suffixes smaller than their
successors are sorted directly, the others induced by scanning the buckets in
order, and neighbours with a common prefix of the window's length are repeats.
Anchors with very many different stretches are compared window by window instead.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genolith.llm.common import gather, mix, row_key, text_or_empty
from genolith.session import durable

LENGTH, GRAM = 200, 32
#: Different stretches of an anchor that one suffix array takes.
MOST_STRETCHES = 4096
#: Bytes of stretches in one suffix array, and of text hashed at once.
ARRAY_BYTES = 2 << 20
SLICE_BYTES = 1 << 20
BASE = 0x9E3779B97F4A7C15
_BELOW = np.uint64((1 << 24) - 1)


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64."""
    n = 2 * SLICE_BYTES + 4 * LENGTH
    inverse = pow(BASE, -1, 1 << 64)
    out = []
    for base in (BASE, inverse):
        steps = np.full(n, base, np.uint64)
        steps[0] = 1
        out.append(np.multiply.accumulate(steps))
    return out[0], out[1]


class Hashes:
    """Polynomial hashes of any range of a byte buffer."""

    def __init__(self, data: np.ndarray):
        power, self.inverse = _powers()
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, length) -> np.ndarray:
        return mix((self.sums[start + length] - self.sums[start]) * self.inverse[start])

    def grams(self, length: int) -> np.ndarray:
        n = len(self.sums) - length
        return mix((self.sums[length:] - self.sums[:n]) * self.inverse[:n])


def stretches(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """(text, first window, windows, anchor hash, stretch hash) of the texts at ``starts`` of a buffer."""
    owners = np.flatnonzero(lengths >= length)
    none = np.empty(0, np.int64)
    if not len(owners):
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    hashes = Hashes(data)
    grams = hashes.grams(gram)
    least = (grams & ~_BELOW) | np.arange(len(grams), dtype=np.uint64)
    width, wide = 1, length - gram + 1
    while width * 2 <= wide:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if wide > width:
        least = np.minimum(least[: len(least) - (wide - width)], least[wide - width:])
    windows = lengths[owners] - length + 1
    at = gather(starts[owners], windows)
    owner = np.repeat(owners, windows)
    anchor = (least[at] & _BELOW).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])]))
    n = np.diff(np.concatenate([new, [len(at)]]))
    first = at[new]
    return owner[new], first - starts[owner[new]], n, grams[anchor[new]], hashes.of(first, n + length - 1)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(buffer, starts, lengths, rows, offsets): texts packed into buffers; long ones in overlapping slices."""
    for batch in batches:
        column = batch.column("text").cast(pa.large_binary())
        offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset: column.offset + len(column) + 1]
        data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] else np.empty(0, np.uint8)
        parts, rows, begins, held = [], [], [], 0
        for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
            for s in range(a, max(a + 1, b - LENGTH + 1), SLICE_BYTES):
                part = data[s: min(b, s + SLICE_BYTES + LENGTH - 1)]
                if held and held + len(part) > SLICE_BYTES:
                    yield _packed(batch, parts, rows, begins)
                    parts, rows, begins, held = [], [], [], 0
                parts.append(part)
                rows.append(i)
                begins.append(s - a)
                held += len(part)
        if parts:
            yield _packed(batch, parts, rows, begins)


def _packed(batch, parts, rows, begins):
    lengths = np.array([len(p) for p in parts], np.int64)
    return batch, np.concatenate(parts), np.cumsum(lengths) - lengths, lengths, np.array(rows, np.int64), np.array(begins, np.int64)


def anchored(rows: DataFrame) -> DataFrame:
    """The stretches of every (key, text) row: key, start, n (windows), anchor, stretch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, starts, lengths, owners, begins in _slices(batches):
            part, first, n, anchor, stretch = stretches(data, starts, lengths)
            if len(part):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key").take(pa.array(owners[part])), pa.array(first + begins[part], pa.int64()), pa.array(n, pa.int32()),
                     pa.array(anchor.view(np.int64)), pa.array(stretch.view(np.int64))], ["key", "start", "n", "anchor", "stretch"])

    return rows.select("key", "text").where(F.octet_length("text") >= LENGTH).mapInArrow(run, "key long, start long, n int, anchor long, stretch long")


# ------------------------------------------------------------ suffix arrays


def _words(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The eight bytes at each place as one sortable number."""
    view = np.lib.stride_tricks.sliding_window_view(data, 8)
    return np.ascontiguousarray(view[at]).view(">u8").ravel().astype(np.uint64)


def _directly(data: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """The suffixes at ``at`` sorted by their first ``depth`` bytes."""
    order = at[np.argsort(_words(data, at), kind="stable")]
    key = _words(data, order)
    group = np.cumsum(np.concatenate([[0], key[1:] != key[:-1]])) if len(at) else np.empty(0, np.int64)
    tied = np.arange(len(order))
    for offset in range(8, depth, 8):
        size = np.bincount(group[tied] - group[tied[0]]) if len(tied) else np.empty(0, int)
        tied = tied[size[group[tied] - group[tied[0]]] > 1] if len(tied) else tied
        if not len(tied):
            break
        key = _words(data, order[tied] + offset)
        rank = np.lexsort((key, group[tied]))
        order[tied] = order[tied[rank]]
        key, owner = key[rank], group[tied]
        new = np.concatenate([[False], (key[1:] != key[:-1]) & (owner[1:] == owner[:-1])])
        # A new number for each split keeps groups apart; places before the split keep theirs.
        heads = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | new[1:]]))
        group[tied] = np.repeat(tied[heads], np.diff(np.concatenate([heads, [len(tied)]])))
        # Untied groups must not share numbers with the new ones: all numbers become first places.
        whole = np.setdiff1d(np.arange(len(order)), tied, assume_unique=True)
        if offset == 8 and len(whole):
            group[whole] = whole
    return order


def suffix_order(data: np.ndarray, wanted: np.ndarray, depth: int) -> np.ndarray:
    """The places ``wanted`` (a mask) in the order of their suffixes to ``depth`` bytes.

    ``data`` ends each string with at least ``depth`` + 8 zeros. Suffixes smaller
    than their successors are sorted directly. A suffix larger than its successor
    follows from it: scanning the buckets of first bytes upwards, every sorted
    suffix puts its predecessor at the end of what its bucket holds so far.
    """
    n = len(data)
    nxt = np.concatenate([data[1:], [0]]).astype(np.int16) - data
    # Within a run of equal bytes the byte after the run decides.
    places = np.where(nxt != 0, np.arange(n), n - 1)
    after = np.minimum.accumulate(places[::-1])[::-1]
    smaller = nxt[after] > 0  # the suffix is smaller than its successor
    # Chains of larger suffixes are followed to a smaller one.
    need = wanted.copy()
    edge = np.flatnonzero(wanted & ~smaller & (after >= 0))
    while len(edge):
        edge = edge[edge + 1 < n] + 1
        edge = edge[~need[edge]]
        need[edge] = True
        edge = edge[~smaller[edge] & (data[edge] > 0)]
    direct = np.flatnonzero(need & (smaller | (data == 0)))
    direct = _directly(data, direct, depth)
    by_byte = np.searchsorted(data[direct], np.arange(257))
    larger = need & ~(smaller | (data == 0))
    pending: list[list[np.ndarray]] = [[] for _ in range(256)]
    out = []
    for c in range(256):
        induced = list(pending[c])
        front = np.concatenate(induced) if induced else np.empty(0, np.int64)
        while len(front):  # longer runs of the byte
            front = front[front > 0] - 1
            front = front[larger[front] & (data[front] == c)]
            if len(front):
                induced.append(front)
        bucket = np.concatenate([*induced, direct[by_byte[c]:by_byte[c + 1]]]) if induced else direct[by_byte[c]:by_byte[c + 1]]
        pending[c] = []
        if not len(bucket):
            continue
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[larger[before] & (data[before] > c)]
        if len(before):
            first = data[before]
            order = np.argsort(first, kind="stable")
            before, first = before[order], first[order]
            cuts = np.flatnonzero(np.concatenate([[True], first[1:] != first[:-1]]))
            for a, b in zip(cuts, [*cuts[1:], len(before)]):
                pending[int(first[a])].append(before[a:b])
    order = np.concatenate(out) if out else np.empty(0, np.int64)
    return order[wanted[order]]


def repeated_windows(pieces: list[bytes], windows: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(piece, window) of the windows whose bytes start anywhere else in the pieces too."""
    pad = np.zeros(length + 16, np.uint8)
    sizes = np.array([len(p) for p in pieces], np.int64)
    data = np.concatenate([x for p in pieces for x in (np.frombuffer(p, np.uint8), pad)])
    starts = np.concatenate([[0], np.cumsum(sizes + len(pad))])[:-1]
    wanted = np.zeros(len(data), bool)
    wanted[gather(starts, windows)] = True
    order = suffix_order(data, wanted, length)
    # Adjacent common prefixes, as far as the window's length.
    same = np.arange(len(order) - 1)
    for offset in range(0, length, 8):
        step = min(offset, length - 8)
        same = same[_words(data, order[same] + step) == _words(data, order[same + 1] + step)]
    hit = np.zeros(len(order), bool)
    hit[same] = True
    hit[same + 1] = True
    at = np.sort(order[hit])
    piece = np.searchsorted(starts, at, side="right") - 1
    return piece, at - starts[piece]


def _runs(piece: np.ndarray, window: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted (piece, window) as runs: piece, first window, windows."""
    new = np.flatnonzero(np.concatenate([[True], (piece[1:] != piece[:-1]) | (window[1:] != window[:-1] + 1)]))
    return piece[new], window[new], np.diff(np.concatenate([new, [len(piece)]]))


SPAN_SCHEMA = "key long, start long, n int"


def _by_suffix_arrays(pieces: DataFrame) -> DataFrame:
    """Spans of repeated windows in the pieces that occur once, group of anchors by group."""

    def solve(rows: list[tuple]) -> pa.RecordBatch | None:
        keys, starts, windows, counts = (np.array([r[i] for r in rows], np.int64) for i in (1, 2, 3, 4))
        piece, window = repeated_windows([r[5] for r in rows], windows)
        once = counts[piece] == 1
        if not once.any():
            return None
        piece, first, n = _runs(piece[once], window[once])
        return pa.RecordBatch.from_arrays([pa.array(keys[piece]), pa.array(starts[piece] + first), pa.array(n, pa.int32())], ["key", "start", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("anchor", "key", "start", "n", "count", "piece"))):
                if size > ARRAY_BYTES and row[0] != held[-1][0]:
                    if (out := solve(held)) is not None:
                        yield out
                    held, size = [], 0
                held.append(row)
                size += len(row[5])
        if held and (out := solve(held)) is not None:
            yield out

    spread = pieces.select("anchor", "key", "start", "n", "count", "piece").repartition("anchor").sortWithinPartitions("anchor")
    return spread.mapInArrow(run, SPAN_SCHEMA)


def _by_windows(pieces: DataFrame) -> DataFrame:
    """The same spans for anchors with very many stretches: windows counted by two 64-bit hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, start, n, count, piece in zip(*(batch.column(c).to_pylist() for c in ("key", "start", "n", "count", "piece"))):
                data = np.frombuffer(piece, np.uint8)
                hashes, at = Hashes(data), np.arange(n)
                second = mix(hashes.of(at, LENGTH // 2) * np.uint64(31) + hashes.of(at + LENGTH // 2, LENGTH - LENGTH // 2))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, key)), pa.array(start + at), pa.array(np.full(n, count)), pa.array(hashes.of(at, LENGTH).view(np.int64)), pa.array(second.view(np.int64))],
                    ["key", "start", "count", "h", "g"])

    windows = durable(pieces.select("key", "start", "n", "count", "piece").mapInArrow(run, "key long, start long, count long, h long, g long"))
    often = windows.groupBy("h", "g").agg(F.sum("count").alias("total")).where("total > 1").drop("total")
    return windows.where(F.col("count") == 1).join(often, ["h", "g"]).select("key", "start", F.lit(1).alias("n"))


def repeated_spans(rows: DataFrame, most: int = MOST_STRETCHES) -> DataFrame:
    """(key, start, n): runs of windows whose bytes also start elsewhere, for (key, text) rows."""
    every = durable(anchored(rows))
    # What joins by a possibly hot anchor is written first, so that Spark can split the anchor's rows.
    often = durable(every.groupBy("anchor").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("anchor"))
    shared = durable(every.join(often, "anchor"))
    kinds = durable(shared.groupBy("anchor", "stretch", "n").agg(F.count(F.lit(1)).alias("count"), F.min(F.struct("key", "start")).alias("first")))
    whole = shared.join(kinds.where("count > 1").select("anchor", "stretch", "n"), ["anchor", "stretch", "n"]).select("key", "start", "n")
    differing = durable(kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds"), F.min("count").alias("least")).where("kinds > 1 and least = 1").select("anchor", "kinds"))
    open_ = kinds.join(differing, "anchor").select("first.key", F.struct(F.col("first.start").alias("start"), "n", "anchor", "count", "kinds").alias("s"))
    asked = open_.groupBy("key").agg(F.collect_list("s").alias("asked"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["anchor", "kinds", "key", "start", "n", "count", "piece"]
        kinds_ = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
        for batch in batches:
            found, size = [], 0
            for key, text, asked_ in zip(*(batch.column(c).to_pylist() for c in ("key", "text", "asked"))):
                data = text.encode()
                for s in asked_:
                    piece = data[s["start"]: s["start"] + s["n"] + LENGTH - 1]
                    found.append((s["anchor"], s["kinds"], key, s["start"], s["n"], s["count"], piece))
                    size += len(piece)
                if size > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds_)], names)
                    found, size = [], 0
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds_)], names)

    # Rows with equal keys are equal texts: each gives the same pieces, of which one is enough.
    texts = rows.select("key", "text").join(asked, "key")
    pieces = durable(texts.mapInArrow(cut, "anchor long, kinds long, key long, start long, n int, count long, piece binary")).dropDuplicates(["key", "start"])
    few, many = pieces.where(F.col("kinds") <= most), pieces.where(F.col("kinds") > most)
    return durable(whole.unionByName(_by_suffix_arrays(few)).unionByName(_by_windows(many)).distinct())


def _removed(starts: list[int], counts: list[int], length: int) -> list[tuple[int, int]]:
    """Maximal byte runs covered by the windows."""
    out: list[list[int]] = []
    for a, n in sorted(zip(starts, counts)):
        b = a + n + length - 1
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


RESULT_SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def remove_repeats(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every document (and ``kept``, its remaining bytes).

    Null text is empty. Repeated rows are documents of their own, so each is
    a copy of the other. Texts under ``LENGTH`` bytes keep everything. Extra columns
    are ignored, null ids are kept, an empty table gives no rows. Remaining bytes
    may cut a character, so ``kept`` is binary.
    """
    rows = docs.select(row_key("doc_id", "text").alias("key"), F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    spans = repeated_spans(rows).groupBy("key").agg(F.collect_list("start").alias("starts"), F.collect_list("n").alias("counts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for doc_id, text, starts, counts in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "starts", "counts"))):
                data = text.encode()
                gone = _removed(starts or [], counts or [], LENGTH)
                if gone:
                    edges = [0, *(x for run_ in gone for x in run_), len(data)]
                    kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
                else:
                    kept = data
                found.append((doc_id, len(data), len(data) - len(kept), len(gone), hashlib.sha256(kept).hexdigest(), kept))
            kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
            columns = [pa.array(c, k) for c, k in zip(zip(*found), kinds)] if found else [pa.array([], k) for k in kinds]
            yield pa.RecordBatch.from_arrays(columns[: None if with_text else 5], names[: None if with_text else 5])

    return rows.join(spans, "key", "left").mapInArrow(run, RESULT_SCHEMA + (", kept binary" if with_text else ""))
