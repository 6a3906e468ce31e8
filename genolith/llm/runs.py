"""Periodic runs of words, found by internal pattern matching.

A run is a stretch of words with smallest period q, at least ``max(24, 3 q)`` words
long, that no neighbouring word extends. Every run holds a block of the ladder
8, 12, 16, 24, 32, ... (powers of two and their three-halves) that starts on the
block's grid, is at least q long, and recurs q words later inside the run. A block
that long recurs in its neighbouring window at multiples of q only, so the
occurrences form a progression whose difference is the candidate period. They are
looked up in a suffix array of the document by range successor on a wavelet tree.
Candidates are then extended word by word, so nothing rests on hashes.

Each document is worked on by itself inside a task and nothing is shuffled. A task
holds some forty bytes per word of its block of texts (a longer text is a block of its own).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genolith.llm.common import BLOCK_BYTES, blocks, text_or_empty, words_of

#: A run has at least this many words and this many periods.
LEAST_WORDS, LEAST_PERIODS = 24, 3
#: The shortest block of the ladder; LEAST_WORDS leaves room for it, its grid and a period of its length.
FIRST_BLOCK = LEAST_WORDS // 3
RUN_SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, strongest int, text string"


class WaveletTree:
    """Range counts and quantiles over a permutation of 0..n-1, for many queries at once."""

    def __init__(self, values: np.ndarray):
        self.n = len(values)
        self.bits = max(1, int(self.n - 1).bit_length())
        self.zeros: list[np.ndarray] = []
        for bit in reversed(range(self.bits)):
            one = (values >> bit) & 1
            before = np.zeros(self.n + 1, np.int32)
            np.cumsum(1 - one, out=before[1:])
            self.zeros.append(before)
            values = np.concatenate([values[one == 0], values[one == 1]])

    def below(self, left: np.ndarray, right: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many values of each [left, right) are below ``bound`` (at most n - 1)."""
        count = np.zeros(len(left), np.int64)
        for level, before in enumerate(self.zeros):
            one = (bound >> (self.bits - 1 - level)) & 1 == 1
            low, high = before[left].astype(np.int64), before[right].astype(np.int64)
            count += np.where(one, high - low, 0)
            left, right = np.where(one, before[-1] + left - low, low), np.where(one, before[-1] + right - high, high)
        return count

    def quantile(self, left: np.ndarray, right: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The value with k smaller ones in each [left, right)."""
        out = np.zeros(len(left), np.int64)
        for before in self.zeros:
            low, high = before[left].astype(np.int64), before[right].astype(np.int64)
            one = k >= high - low
            k = np.where(one, k - (high - low), k)
            left, right = np.where(one, before[-1] + left - low, low), np.where(one, before[-1] + right - high, high)
            out = out * 2 + one
        return out

    def successor(self, left: np.ndarray, right: np.ndarray, value: np.ndarray) -> np.ndarray:
        """The least value above ``value`` in each [left, right), -1 where there is none."""
        out = np.full(len(left), -1, np.int64)
        some = np.flatnonzero(value < self.n - 1)
        k = self.below(left[some], right[some], value[some] + 1)
        has = k < right[some] - left[some]
        some = some[has]
        out[some] = self.quantile(left[some], right[some], k[has])
        return out


def _refine(rank: np.ndarray, active: np.ndarray, nxt: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One doubling: (active places in their new order, their new ranks, whether each is alone now).

    ``active`` lists, in order of rank, the places whose rank is shared; a rank is the place
    of its group's first suffix in the suffix array.
    """
    own = rank[active].astype(np.int64)
    key = own * (len(rank) + 1) + nxt
    order = np.argsort(key, kind="stable")
    key, active = key[order], active[order]
    new = np.concatenate([[True], key[1:] != key[:-1]])
    group = np.concatenate([[True], own[1:] != own[:-1]])  # the old groups stay where they were
    at = np.arange(len(active))
    place = own + at - np.maximum.accumulate(np.where(group, at, 0))
    ranks = np.maximum.accumulate(np.where(new, place, 0))
    alone = new & np.concatenate([new[1:], [True]])
    return active, ranks, alone


def candidates(codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, period): a block of every run and the distance to where it recurs.

    ``codes`` are the words of documents that begin at ``starts`` (which ends with the number of words).
    """
    n, sizes = len(codes), np.diff(starts)
    nothing = np.empty(0, np.int64), np.empty(0, np.int64)
    longest = int(sizes.max(initial=0)) // LEAST_PERIODS
    if longest < 1 or int(sizes.max()) < LEAST_WORDS:
        return nothing
    doc = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    end = starts[1:][doc]
    # Depth 1: suffixes of one document that begin with the same word.
    key = doc.astype(np.int64) * (int(codes.max()) + 1) + codes
    active = np.argsort(key, kind="stable")
    sorted_key = key[active]
    new = np.concatenate([[True], sorted_key[1:] != sorted_key[:-1]])
    ranks = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.empty(n, np.int32)
    rank[active] = ranks
    active = active[~(new & np.concatenate([new[1:], [True]]))]
    del key, sorted_key, doc

    def following(places: np.ndarray, depth: int) -> np.ndarray:
        """Ranks ``depth`` words on, plus one; 0 past the document's end."""
        at = places + depth
        inside = at < end[places]
        out = np.zeros(len(places), np.int64)
        out[inside] = rank[at[inside]] + 1
        return out

    depth, held, levels = 1, None, []
    while len(active) and (held is None or depth < longest):
        # Three-halves of the next depth need the present ranks behind it.
        before = rank.copy() if held is None and 2 * depth >= FIRST_BLOCK else None
        if held is not None:
            behind = following(held, 2 * depth)
        active, ranks, alone = _refine(rank, active, following(active, depth))
        rank[active] = ranks
        active = active[~alone]
        depth *= 2
        if held is None and depth >= FIRST_BLOCK:
            # Only blocks that recur matter from here on.
            held = np.sort(active)
            at = held + depth
            behind = np.where(at < end[held], before[np.minimum(at, n - 1)].astype(np.int64) + 1, 0)
        if held is not None and len(held):
            levels.append((depth, rank[held].copy(), behind))
    if held is None or not len(held):
        return nothing

    # The suffix array of the recurring blocks; values are places among them.
    order = np.argsort(rank[held], kind="stable")
    where = np.empty(len(held), np.int64)
    where[order] = np.arange(len(held))
    tree = WaveletTree(order.astype(np.int32))
    first = starts[:-1][np.searchsorted(starts, held, side="right") - 1]
    found, shorter = [nothing], 0
    for depth, own, behind in levels:
        for block, grid in ((depth, depth // 2 if depth > FIRST_BLOCK else depth), (depth + depth // 2, depth // 2)):
            if shorter >= longest:
                break
            sorted_own = own[order]
            cut = np.concatenate([[True], sorted_own[1:] != sorted_own[:-1]])
            if block > depth:
                sorted_behind = behind[order]
                cut[1:] |= sorted_behind[1:] != sorted_behind[:-1]
            groups = np.flatnonzero(cut)
            asked = np.flatnonzero(((held - first) % grid == 0) & (held + block <= end[held]))
            g = np.searchsorted(groups, where[asked], side="right") - 1
            left, right = groups[g], np.append(groups, len(held))[g + 1]
            several = right - left > 1
            asked, left, right = asked[several], left[several], right[several]
            nearest = tree.successor(left, right, asked)
            hit = nearest >= 0
            place, period = held[asked[hit]], held[nearest[hit]] - held[asked[hit]]
            fits = (period > shorter) & (period <= block)
            found.append((place[fits], period[fits]))
            shorter = block
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _same_until(codes: np.ndarray, at: int, period: int, stop: int) -> int:
    """The first place from ``at`` on, below ``stop``, whose word differs from that ``period`` on."""
    step = 64
    while at < stop:
        to = min(at + step, stop)
        differs = codes[at:to] != codes[at + period:to + period]
        if differs.any():
            return at + int(differs.argmax())
        at, step = to, step * 4
    return stop


def _same_since(codes: np.ndarray, at: int, period: int, stop: int) -> int:
    """The least place such that all from it to ``at`` equal those ``period`` on."""
    step = 64
    while at > stop:
        to = max(at - step, stop)
        differs = codes[to:at] != codes[to + period:at + period]
        if differs.any():
            return at - int(differs[::-1].argmax())
        at, step = to, step * 4
    return stop


def find_runs(codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """(document, start in it, length, period) of every run, by document, start and period."""
    place, period = candidates(codes, starts)
    order = np.lexsort((place, period))
    out, last, until = [], 0, 0
    for x, q in zip(place[order].tolist(), period[order].tolist()):
        if q == last and x < until:
            continue  # inside the stretch just measured
        d = int(np.searchsorted(starts, x, side="right")) - 1
        until, last = _same_until(codes, x, q, int(starts[d + 1]) - q), q
        since = _same_since(codes, x, q, int(starts[d]))
        if until + q - since >= max(LEAST_WORDS, LEAST_PERIODS * q):
            out.append((d, since - int(starts[d]), until + q - since, q))
    return np.array(sorted(set(out)), np.int64).reshape(-1, 4)


def planted(ids: list[int | None], starts: np.ndarray) -> np.ndarray:
    """Where each word comes from when a tenth of the documents, by crc32 of the id, repeats a stretch to its end.

    A test pattern for audits of the finder; a null id changes nothing.
    """
    source = np.arange(int(starts[-1]))
    for d, doc_id in enumerate(ids):
        n = int(starts[d + 1] - starts[d])
        if doc_id is None or not n:
            continue
        g, kind = divmod(zlib.crc32(str(doc_id).encode()), 10)
        if kind == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            source[starts[d] + a:starts[d + 1]] = starts[d] + a + np.arange(n - a) % p
    return source


def strongest_run(runs: np.ndarray) -> int | None:
    """Index of the run with the greatest length / period, then the least start, then the least period."""
    best = None
    for i, (start, length, period) in enumerate(runs.tolist()):
        if best is not None:
            s, n, q = runs[best].tolist()
            more = length * q - n * period
            if (-more, start, period) >= (0, s, q):
                continue
        best = i
    return best


def periodic_runs(docs: DataFrame, plant: bool = False) -> DataFrame:
    """doc_id, n_words, runs (by start, then period), strongest (index from 0, null without runs) and text.

    ``text`` is the document's words joined by one space, without those that a run repeats
    after its first period. With ``plant`` the documents are changed by ``planted`` first.

    Null and empty texts have no words, no runs and an empty text. Texts of any length are
    searched whole. Of equally strong runs the first by start, then period, is the strongest. Equal rows give equal
    rows; null ids stay; extra columns are ignored; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", BLOCK_BYTES // 3):
            words = words_of(block.column("text"), lower=False)
            codes, starts = words.codes, words.starts
            if plant and len(codes):
                codes = codes[planted(block.column("doc_id").to_pylist(), starts)]
            runs = find_runs(codes, starts)
            begins = np.searchsorted(runs[:, 0], np.arange(len(starts)))
            dropped = np.zeros(len(codes) + 1, np.int64)
            np.add.at(dropped, starts[runs[:, 0]] + runs[:, 1] + runs[:, 3], 1)
            np.add.at(dropped, starts[runs[:, 0]] + runs[:, 1] + runs[:, 2], -1)
            kept = np.cumsum(dropped[:-1]) == 0
            offsets = np.concatenate([[0], np.cumsum(kept)])[starts]
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), words.dictionary.take(pa.array(codes[kept])))
            fields = [pa.array(np.ascontiguousarray(runs[:, k])) for k in (1, 2, 3)]
            strongest = [strongest_run(runs[a:z, 1:]) for a, z in zip(begins[:-1], begins[1:])]
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), pa.array(np.diff(starts)),
                 pa.ListArray.from_arrays(pa.array(begins, pa.int32()), pa.StructArray.from_arrays(fields, ["start", "length", "period"])),
                 pa.array(strongest, pa.int32()), pc.binary_join(lists, " ")],
                ["doc_id", "n_words", "runs", "strongest", "text"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, RUN_SCHEMA)


def run_digests(found: DataFrame) -> DataFrame:
    """The rows of ``periodic_runs`` as counts, the strongest run and digests of the runs and the collapsed text."""
    line = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    return found.withColumn("best", F.when(F.col("strongest").isNotNull(), F.get("runs", F.col("strongest")))).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, "").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("text").cast("binary"), 256).alias("collapsed_sha256"))
