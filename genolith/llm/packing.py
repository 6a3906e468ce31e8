"""Best-fit packing with swap-based local search.

Documents become token pieces of at most ``capacity`` ids; only longer ones are
cut. The pieces are packed group by group: best fit decreasing first, then a
local search over all underfull sequences that moves one piece, exchanges one
for one or two for one as long as that fills the partner better, so that the
emptiest sequences lose their pieces and vanish; partners are looked up by free
room and piece lengths. The sequences that stay underfull are dealt into other
groups and packed again, until one group holds what is left or a round makes no
fewer sequences. Only (key, length) rows travel; ids stay in their table.
"""

from __future__ import annotations

import heapq
import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from genolith.llm.common import blocks, gather, text_or_empty
from genolith.session import durable

CAPACITY = 2048
END_ID = 0
#: Pieces that one packing task holds.
GROUP = 6000
#: A sequence this full is left as it is between the rounds.
SETTLED = 0.999
PIECE_SCHEMA = "item long, doc_id long, piece int, start long, length long, ids_crc32 long"

# ----------------------------------------------------------------- tokens


def _byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies, by the public rule."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class WordTokenizer:
    """Ids of white-space-free words under a lower-casing word-end BPE vocabulary.

    The vocabulary never merges over white space, so that a text's ids are those
    of its words, one after another. Each distinct word of a block is encoded once.
    Words of printable ASCII and Latin-1 letters go, joined, through a merge
    table with the word end as a trailing space; all others through the
    tokenizer itself.
    """

    SAFE = "^[\\x21-\\x7EÀ-ÖØ-öø-ÿ]+$"
    LETTERS = "^[A-Za-zÀ-ÖØ-öø-ÿ]+$"
    LETTERS_AND_STOP = "^[A-Za-zÀ-ÖØ-öø-ÿ]+[.,]$"

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(path)
        spec = json.load(open(path, encoding="utf-8"))
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pattern = split
        self.special = [t["content"] for t in spec["added_tokens"]]
        alphabet = _byte_alphabet()

        def as_bytes(token: str) -> bytes:
            end = token.endswith("</w>")
            return bytes(alphabet[c] for c in (token[:-4] if end else token)) + b" " * end

        atoms = [bytes([b]) for b in range(256)] + [bytes([b]) + b" " for b in range(256) if b != 32]
        merged = []
        for m in spec["model"]["merges"]:
            a, b = m.split(" ") if isinstance(m, str) else m
            merged.append(as_bytes(a) + as_bytes(b))
        order = list(dict.fromkeys(atoms + merged))
        ranks = {token: i for i, token in enumerate(order)}
        self.newline = ranks[b"\n"]
        self.to_id = np.full(len(order), -1, np.int64)
        for token, i in spec["model"]["vocab"].items():
            if token not in self.special and (r := ranks.get(as_bytes(token))) is not None:
                self.to_id[r] = i
        self.merges = tiktoken.Encoding("words", pat_str=r"[^ \n]+ |\n", mergeable_ranks=ranks, special_tokens={})

    def _kinds(self, words: pa.Array) -> list[tuple[np.ndarray, object]]:
        """(places, way of spacing out) of the words that the merge table takes, by kind."""
        special = np.zeros(len(words), bool)
        for token in self.special:
            special |= pc.match_substring(words, token).to_numpy(zero_copy_only=False)
        left, kinds = ~special, []
        for pattern, spaced in (
            (self.LETTERS, lambda w: pc.binary_join_element_wise(w, "", " ")),
            (self.LETTERS_AND_STOP, lambda w: pc.binary_join_element_wise(pc.utf8_slice_codeunits(w, 0, -1), pc.utf8_slice_codeunits(w, -1), "", " ")),
            (self.SAFE, lambda w: pc.replace_substring_regex(w, "(" + self.pattern + ")", "\\1 ")),
        ):
            hit = left & pc.match_substring_regex(words, pattern).to_numpy(zero_copy_only=False)
            left &= ~hit
            kinds.append((np.flatnonzero(hit), spaced))
        return [*kinds, (np.flatnonzero(left | special), None)]

    def encode_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, offsets) of distinct words without white space."""
        lengths = np.zeros(len(words), np.int64)
        parts, owners = [], []
        for places, spaced in self._kinds(words):
            if not len(places):
                continue
            own = words.take(pa.array(places))
            if spaced is None:
                encoded = [e.ids for e in self.exact.encode_batch(own.to_pylist(), add_special_tokens=False)]
                lengths[places] = [len(e) for e in encoded]
                parts.append(np.fromiter((i for e in encoded for i in e), np.int64))
            else:
                lines = spaced(pc.utf8_lower(own))
                joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(lines)], pa.int32()), lines), "\n")[0].as_py() + "\n"
                ranks = np.asarray(self.merges.encode_ordinary(joined), dtype=np.int64)
                ends = np.flatnonzero(ranks == self.newline)
                lengths[places] = np.diff(np.concatenate([[-1], ends])) - 1
                parts.append(self.to_id[ranks[ranks != self.newline]])
            owners.append(places)
        offsets = np.concatenate([[0], np.cumsum(lengths)])
        out = np.empty(offsets[-1], np.int64)
        if parts:
            owners = np.concatenate(owners)
            out[gather(offsets[:-1][owners], lengths[owners])] = np.concatenate(parts)
        return out, offsets

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, document offsets) of a block of texts."""
        lists = pc.ascii_split_whitespace(texts)
        places = lists.offsets.to_numpy().astype(np.int64)
        encoded = lists.flatten().dictionary_encode()
        codes = encoded.indices.to_numpy(zero_copy_only=False)
        flat, offsets = self.encode_words(encoded.dictionary)
        lengths = np.diff(offsets)[codes] if len(codes) else np.empty(0, np.int64)
        ids = flat[gather(offsets[codes], lengths)] if len(codes) else flat
        ends = np.concatenate([[0], np.cumsum(lengths)])
        return ids, ends[places - places[0]]


@lru_cache(maxsize=2)
def _tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def pieces_of(ids: np.ndarray, ends: np.ndarray, capacity: int, end_id: int):
    """Per piece of every document, its end id included: (document, piece, start, length, crc of the ids)."""
    for d in range(len(ends) - 1):
        own = np.empty(ends[d + 1] - ends[d] + 1, "<u4")
        own[:-1] = ids[ends[d]:ends[d + 1]]
        own[-1] = end_id
        for p, start in enumerate(range(0, len(own), capacity)):
            cut = own[start:start + capacity]
            yield d, p, start, len(cut), zlib.crc32(cut.tobytes()), cut


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """The token pieces of every document: ``PIECE_SCHEMA`` (and ``ids`` if asked for).

    Null text counts as empty and gives the end id alone. ``item`` numbers the
    pieces, so that those of repeated and null ids stay apart.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first = TaskContext.get().partitionId() << 33
        tokenizer = _tokenizer(tokenizer_path)
        for block in blocks(batches, "text"):
            ids, ends = tokenizer.encode(block.column("text"))
            found = list(pieces_of(ids, ends, capacity, end_id))
            where = np.fromiter((f[0] for f in found), np.int64, len(found))
            columns = [pa.array(first + np.arange(len(found))), block.column("doc_id").take(pa.array(where)), pa.array([f[1] for f in found], pa.int32()),
                       pa.array([f[2] for f in found], pa.int64()), pa.array([f[3] for f in found], pa.int64()), pa.array([f[4] for f in found], pa.int64())]
            names = ["item", "doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.array([f[5].astype(np.int32) for f in found], pa.list_(pa.int32())))
                names.append("ids")
            first += len(found)
            yield pa.RecordBatch.from_arrays(columns, names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, PIECE_SCHEMA + (", ids array<int>" if with_ids else ""))


# ---------------------------------------------------------------- packing


def best_fit(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Bin of every item: longest first, each into the fullest bin that still takes it."""
    room_of: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_rooms = 0  # bit r is set while a bin with room r is open
    bins = np.empty(len(lengths), np.int64)
    made = 0
    for i in np.argsort(-lengths, kind="stable"):
        n = int(lengths[i])
        fits = open_rooms >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            b = room_of[room].pop()
            if not room_of[room]:
                open_rooms ^= 1 << room
        else:
            b, room = made, capacity
            made += 1
        bins[i] = b
        if room > n:
            room_of[room - n].append(b)
            open_rooms |= 1 << (room - n)
    return bins


class _Partners:
    """Underfull bins by what they can take.

    A bin with room r that gives up pieces of together d (none, one or two) takes a piece
    of size s if d < s <= d + r, and is left with d + r - s. ``heaps[d + r]`` holds (d, bin,
    version, pieces); entries of earlier versions of a bin are dropped when they come up.
    """

    def __init__(self, capacity: int):
        self.heaps: list[list[tuple[int, int, int, tuple[int, ...]]]] = [[] for _ in range(capacity + 1)]
        # No entry of a heap gives up less than this.
        self.least = np.full(capacity + 1, capacity + 1)
        self.version: dict[int, int] = {}

    def drop(self, b: int) -> None:
        self.version[b] = self.version.get(b, 0) + 1

    def put(self, b: int, content: list[int], size: list[int], room: int) -> None:
        self.drop(b)
        if room <= 0:
            return
        kinds: dict[int, list[int]] = {}
        for i in content:
            kinds.setdefault(size[i], []).append(i)
        out: dict[int, tuple[int, ...]] = {0: ()}
        sizes = list(kinds)
        for x in sizes:
            out[x] = (kinds[x][0],)
        for k, x in enumerate(sizes):
            if len(kinds[x]) > 1:
                out.setdefault(2 * x, (kinds[x][0], kinds[x][1]))
            for y in sizes[k + 1:]:
                out.setdefault(x + y, (kinds[x][0], kinds[y][0]))
        for d, pieces in out.items():
            heapq.heappush(self.heaps[d + room], (d, b, self.version[b], pieces))
            if d < self.least[d + room]:
                self.least[d + room] = d

    def find(self, n: int, upto: int) -> tuple[int, tuple[int, ...]] | None:
        """(bin, pieces it gives up) that a piece of size ``n`` fills best, among those left with less than ``upto`` room."""
        for v in (np.flatnonzero(self.least[n:n + upto] < n) + n).tolist():
            heap = self.heaps[v]
            while heap and self.version[heap[0][1]] != heap[0][2]:
                heapq.heappop(heap)
            self.least[v] = heap[0][0] if heap else len(self.least)
            if heap and heap[0][0] < n:
                return heap[0][1], heap[0][3]
        return None


def improve(lengths: np.ndarray, bins: np.ndarray, capacity: int, steps: list[tuple[int, int, int]] | None = None) -> np.ndarray:
    """Local search over the underfull bins; returns the bins of the items.

    A bin is emptied, emptiest first: each of its pieces goes to the bin that it
    fills best, by a move or in exchange for one or two pieces that are together
    shorter, if the other bin then holds more than this one did. So every step adds
    to the sum of squared fills (by 2 * change * (other + change - own)) and the search
    ends; a bin whose pieces all leave is gone, and the displaced pieces come back to
    the bin being emptied. All underfull bins are gone through until no step is left.
    ``steps`` takes (own fill, other fill, change) of every step.
    """
    content: dict[int, list[int]] = {}
    for i, b in enumerate(bins.tolist()):
        content.setdefault(b, []).append(i)
    size = lengths.tolist()
    fill = {b: sum(size[i] for i in c) for b, c in content.items()}
    least = -(-sum(size) // capacity)
    partners = _Partners(capacity)
    for b, c in content.items():
        partners.put(b, c, size, capacity - fill[b])
    gained = True
    while gained and len(content) > least:
        gained = False
        for source in sorted((b for b in content if fill[b] < capacity), key=lambda b: (fill[b], b)):
            if len(content) == least:
                break
            if fill[source] == capacity:
                continue  # filled up meanwhile
            partners.drop(source)
            own = content[source]
            active = True
            while active and own:
                active = False
                for i in sorted(own, key=lambda i: -size[i]):
                    found = partners.find(size[i], capacity - fill[source])
                    if found is None:
                        continue
                    b, out = found
                    own.remove(i)
                    own.extend(out)
                    content[b] = [k for k in content[b] if k not in out] + [i]
                    change = size[i] - sum(size[k] for k in out)
                    if steps is not None:
                        steps.append((fill[source], fill[b], change))
                    fill[b] += change
                    fill[source] -= change
                    partners.put(b, content[b], size, capacity - fill[b])
                    active = gained = True
                    break
            if own:
                partners.put(source, own, size, capacity - fill[source])
            else:
                del content[source]
    result = np.empty(len(lengths), np.int64)
    for b, c in content.items():
        result[c] = b
    return result


def pack_group(lengths: np.ndarray, capacity: int = CAPACITY, given: np.ndarray | None = None) -> np.ndarray:
    """Bins of the items of one group, never more than the ``given`` ones."""
    least = -(-int(lengths.sum()) // capacity)
    bins = best_fit(lengths, capacity)
    if bins.max(initial=-1) + 1 > least:
        bins = improve(lengths, bins, capacity)
        if given is not None and len(np.unique(bins)) > least:
            bins = min(bins, improve(lengths, given, capacity), key=lambda b: len(np.unique(b)))
    return bins


def _pack_round(items: DataFrame, groups: int, number: int, capacity: int) -> DataFrame:
    """Pack (item, length) in ``groups`` groups; adds seq (unique over the rounds), fill, and head (1 in one row of each sequence, else 0).

    Items that have a seq come with their whole sequence, so that no group ends with more of them.
    """
    again = "seq" in items.columns

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "item"], ascending=[False, True], kind="stable", ignore_index=True)
        lengths = frame["length"].to_numpy()
        _, heads, bins = np.unique(pack_group(lengths, capacity, frame["seq"].to_numpy() if again else None), return_index=True, return_inverse=True)
        bins = bins.astype(np.int64)
        fill = np.bincount(bins, lengths).astype(np.int64)
        head = np.zeros(len(bins), np.int32)
        head[heads] = 1
        return pd.DataFrame({"item": frame["item"], "length": lengths, "seq": (np.int64(number) << 50) + (frame["grp"].to_numpy() << 22) + bins, "fill": fill[bins], "head": head})

    keyed = items.withColumn("grp", F.pmod(F.xxhash64("seq" if again else "item", F.lit(number)), F.lit(groups)).cast("long"))
    return keyed.groupBy("grp").applyInPandas(run, "item long, length long, seq long, fill long, head int")


def pack(items: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """Pack (item, length) rows, lengths 1 to ``capacity`` and items unique, into few sequences.

    Returns item, length, sequence_id and offset. Full items stand alone. Every
    round packs groups of about ``group`` items and keeps the well-filled
    sequences; the others are packed again in other groups, until one group holds
    them or that makes no fewer sequences of them.
    """
    full = items.where(F.col("length") >= capacity).select("item", "length", F.col("item").alias("seq"))
    full = full.withColumn("seq", -F.col("item") - 1)
    rest = items.where(F.col("length") < capacity).select("item", "length")
    done = [full]
    number = 0
    left, sequences = rest.count(), None
    settled = F.col("fill") >= SETTLED * capacity
    while left:
        number += 1
        groups = -(-left // group)
        packed = durable(_pack_round(rest, groups, number, capacity))
        made, still, left = packed.agg(F.sum("head"), F.sum(F.when(~settled, F.col("head")).otherwise(0)), F.count_if(~settled)).first()
        if groups == 1 or made == sequences:
            done.append(packed.select("item", "length", "seq"))
            break
        done.append(packed.where(settled).select("item", "length", "seq"))
        rest, sequences = packed.where(~settled).select("item", "length", "seq"), still
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out.withColumn("offset", F.sum("length").over(
        Window.partitionBy("seq").orderBy("item").rowsBetween(Window.unboundedPreceding, -1))).select(
        "item", "length", F.col("seq").alias("sequence_id"), F.coalesce("offset", F.lit(0)).alias("offset"))


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece of every document: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Extra columns are ignored, null texts are empty, repeated and null doc_ids
    are documents of their own, an empty table gives no rows, a text longer than
    a sequence is cut into pieces. The order inside a sequence is by row number.
    """
    pieces = durable(token_pieces(docs, tokenizer_path, capacity, end_id))
    placed = pack(pieces.select("item", "length"), capacity)
    return pieces.join(placed.drop("length"), "item").select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", F.col("offset").cast("long").alias("offset"))
