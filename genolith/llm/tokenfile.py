"""Token files: canonical length-limited Huffman codes of ids, decoded by table in independent blocks.

One codebook serves the whole corpus. It comes from global id counts, so that the
code lengths are optimal within ``MAX_BITS`` (package-merge), and only the lengths
are stored: codes are dealt in order of (length, id). A file is

    magic, number of ids (u32), bytes of the packed lengths (u32), zlib of one length byte per id
    frames, one after another:
        documents (u64), ids (u64), bits (u64), ids per block (u32)
        doc_id (i64) and whether it is null (u8), per document; ids (u64), per document
        bit offset of every block (u64)
        the code bits, first bit highest

all little-endian. A block is decoded from its own bit offset, so a frame's blocks go
through the table side by side, and a slice of the corpus reads only the blocks it
needs. Documents ascend by id over the files (null ids first); the directory names
each frame's file, place and first position, one row per frame of about a million ids.

Tasks write files under names of their own and report them in the directory, a table that Spark
commits, so files of lost or repeated tasks are never read.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from genolith.llm.common import BLOCK_BYTES, blocks, text_or_empty
from genolith.llm.packing import WordTokenizer
from genolith.session import durable, scratch_table

END_ID = 1
#: Longest code; a vocabulary that needs more gets what it needs.
MAX_BITS = 20
#: Ids of a block, and ids that a frame holds at least (the last one of a file may hold fewer).
BLOCK_IDS, FRAME_IDS = 512, 1 << 20
#: Frames' bytes that one reading task gets, about.
TASK_BYTES = 8 << 20
MAGIC = b"HUFIDS01"
FRAME_HEAD = struct.Struct("<QQQI")
DIRECTORY_SCHEMA = "file string, first_doc long, first_tie long, seq int, header long, offset long, length long, documents long, n_ids long"
TOKEN_SCHEMA = "doc_id long, tie long, n_tokens long, ids binary"


# ------------------------------------------------------------------ codebook


def code_lengths(counts: np.ndarray, limit: int) -> np.ndarray:
    """Optimal prefix-code lengths of at most ``limit`` bits by package-merge; 0 where the count is 0."""
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.uint8)
    n = len(used)
    if n <= 1:
        out[used] = 1
        return out
    if n > 1 << limit:
        raise ValueError(f"{n} ids do not fit codes of {limit} bits")
    used = used[np.argsort(counts[used], kind="stable")]
    weights = counts[used].astype(np.float64) if counts.sum() * limit > 1 << 62 else counts[used].astype(np.int64)
    merged, leaf_levels = weights, [np.ones(n, bool)]
    for _ in range(limit - 1):
        packages = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate([weights, packages])
        order = np.argsort(both, kind="stable")  # leaves before packages of the same weight
        merged = both[order]
        leaf_levels.append(order < n)
    # The 2n - 2 cheapest items of the last list; each leaf among the taken adds a bit.
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for leaf in reversed(leaf_levels):
        leaves = int(leaf[:take].sum())
        lengths[:leaves] += 1
        take = 2 * (take - leaves)
    out[used] = lengths
    return out


@dataclass
class Codebook:
    """Canonical codes of the ids with a length above 0."""

    lengths: np.ndarray

    def __post_init__(self):
        order = np.lexsort((np.arange(len(self.lengths)), self.lengths))
        order = order[self.lengths[order] > 0]
        self.order, sizes = order, self.lengths[order].astype(np.int64)
        self.bits = int(sizes.max(initial=1))
        # The code of an id, at full width, is what the codes before it take.
        room = np.int64(1) << (self.bits - sizes)
        begin = np.cumsum(room) - room
        self.codes = np.zeros(len(self.lengths), np.int64)
        self.codes[order] = begin >> (self.bits - sizes)
        self.room = room

    def table(self) -> tuple[np.ndarray, np.ndarray]:
        """(id, length) by the next ``bits`` bits; combinations that no code begins with have length 0."""
        ids, sizes = np.zeros(1 << self.bits, np.int32), np.zeros(1 << self.bits, np.uint8)
        total = int(self.room.sum())
        ids[:total] = np.repeat(self.order, self.room)
        sizes[:total] = np.repeat(self.lengths[self.order], self.room)
        return ids, sizes

    def dump(self) -> bytes:
        packed = zlib.compress(self.lengths.astype(np.uint8).tobytes(), 9)
        return MAGIC + struct.pack("<II", len(self.lengths), len(packed)) + packed

    @staticmethod
    def load(data: bytes) -> Codebook:
        n, size = struct.unpack_from("<II", data, len(MAGIC))
        if data[: len(MAGIC)] != MAGIC:
            raise ValueError("not a token file")
        start = len(MAGIC) + 8
        lengths = np.frombuffer(zlib.decompress(data[start:start + size]), np.uint8)
        if len(lengths) != n:
            raise ValueError("the code lengths are damaged")
        return Codebook(lengths)


def encode(ids: np.ndarray, book: Codebook, every: int = BLOCK_IDS) -> tuple[bytes, np.ndarray, int]:
    """(code bytes, bit offsets of the blocks, bits)."""
    sizes = book.lengths[ids].astype(np.int64)
    ends = np.cumsum(sizes)
    at = ends - sizes
    bits = int(ends[-1]) if len(ends) else 0
    # A code and the bits before it in its first byte fit into five bytes.
    word = book.codes[ids] << (40 - sizes - (at & 7))
    first, length = at >> 3, bits // 8 + 6
    out = np.zeros(length, np.int64)
    for k in range(5):
        # Codes share bytes but no bits, so sums are unions.
        out[k:] += np.bincount(first, (word >> (32 - 8 * k)) & 255, minlength=length)[: length - k].astype(np.int64)
    return out[: -(-bits // 8)].astype(np.uint8).tobytes(), at[::every].copy(), bits


def decode(data: np.ndarray, offsets: np.ndarray, counts: np.ndarray, table: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The ids of blocks that begin at bit ``offsets`` of ``data`` and hold ``counts`` ids, one block after another."""
    if not len(counts):
        return np.empty(0, np.int32)
    ids, sizes = table
    bits = int(len(ids)).bit_length() - 1
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    word = np.zeros(len(padded) - 4, np.uint64)
    for k in range(5):
        word |= padded[k:len(padded) - 4 + k] << np.uint64(32 - 8 * k)
    word, steps, mask = word.astype(np.int64), int(counts.max()), (1 << bits) - 1
    out = np.zeros((steps, len(counts)), np.int32)
    at, lanes = offsets.astype(np.int64), np.arange(len(counts))
    shortest = int(counts.min())
    for step in range(steps):
        if step >= shortest:
            left = counts[lanes] > step
            if not left.all():
                at, lanes = at[left], lanes[left]
        code = (word[at >> 3] >> (40 - bits - (at & 7))) & mask
        size = sizes[code]
        out[step, lanes] = ids[code]
        at = at + size
        if not size.all():
            raise ValueError("the code bits are damaged")
    return out.T[np.arange(steps) < counts[:, None]]


# ------------------------------------------------------------------- frames


def pack_frame(doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray, book: Codebook, every: int = BLOCK_IDS) -> bytes:
    payload, offsets, bits = encode(ids, book, every)
    return b"".join([
        FRAME_HEAD.pack(len(doc_ids), len(ids), bits, every), np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
        np.array([d is None for d in doc_ids], np.uint8).tobytes(), lengths.astype("<u8").tobytes(), offsets.astype("<u8").tobytes(), payload])


@dataclass
class Frame:
    """A frame read back; ``ids`` decodes the blocks that hold positions first..last of the frame."""

    doc_ids: list[int | None]
    lengths: np.ndarray
    offsets: np.ndarray
    payload: np.ndarray
    n_ids: int
    every: int

    @staticmethod
    def parse(data: bytes) -> Frame:
        documents, n_ids, bits, every = FRAME_HEAD.unpack_from(data)
        at = FRAME_HEAD.size

        def part(kind: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, count, at)
            at += out.nbytes
            return out

        doc_ids, nulls, lengths = part("<i8", documents), part("u1", documents), part("<u8", documents).astype(np.int64)
        offsets = part("<u8", -(-n_ids // every)).astype(np.int64)
        payload = part("u1", -(-bits // 8))
        return Frame([None if z else d for d, z in zip(doc_ids.tolist(), nulls.tolist())], lengths, offsets, payload, n_ids, every)

    def ids(self, table: tuple[np.ndarray, np.ndarray], first: int = 0, last: int | None = None) -> np.ndarray:
        last = self.n_ids if last is None else min(last, self.n_ids)
        if first >= last:
            return np.empty(0, np.int32)
        a, z = first // self.every, -(-last // self.every)
        counts = np.minimum(self.every, self.n_ids - np.arange(a, z) * self.every)
        return decode(self.payload, self.offsets[a:z], counts, table)[first - a * self.every: last - a * self.every]


# --------------------------------------------------------------------- jobs


def token_ids(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """``TOKEN_SCHEMA``: every document's ids with the end id, in bytes of the least fitting width, and a hash that orders equal doc_ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = WordTokenizer(tokenizer_path)
        kind = id_type(tokenizer.exact.get_vocab_size())
        for block in blocks(batches, "text", BLOCK_BYTES // 3):
            ids, ends = tokenizer.encode(block.column("text"))
            n = np.diff(ends) + 1
            whole = np.insert(ids, ends[1:], end_id).astype(kind)
            offsets = np.concatenate([[0], np.cumsum(n)]) * kind.itemsize
            binary = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(whole)])
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), block.column("tie"), pa.array(n), binary], ["doc_id", "tie", "n_tokens", "ids"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.withColumn("tie", F.xxhash64("text")).mapInArrow(run, TOKEN_SCHEMA)


def id_type(vocabulary: int) -> np.dtype:
    return np.dtype("<u2" if vocabulary <= 1 << 16 else "<u4")


def _flat(column: pa.Array, kind: np.dtype) -> np.ndarray:
    """The ids of all rows of a binary column."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset: column.offset + len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]].view(kind) if data and len(column) else np.empty(0, kind)


def codebook(tokens: DataFrame, vocabulary: int, max_bits: int = MAX_BITS) -> Codebook:
    """The codebook of the global id counts; a row per id that occurs reaches the driver, never more than the vocabulary."""
    kind = id_type(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(vocabulary, np.int64)
        for batch in batches:
            total += np.bincount(_flat(batch.column("ids"), kind), minlength=vocabulary)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["id", "n"])

    found = tokens.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(vocabulary, np.int64)
    counts[found["id"].to_numpy()] = found["n"].to_numpy()
    return Codebook(code_lengths(counts, max(max_bits, (vocabulary - 1).bit_length())))


def write_token_files(tokens: DataFrame, book: Codebook, vocabulary: int, folder: str, frame_ids: int = FRAME_IDS, every: int = BLOCK_IDS) -> DataFrame:
    """Write the ids in ascending doc_id order; returns the directory of frames with ``base``, the ids before each."""
    kind = id_type(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        name, header = f"{uuid.uuid4().hex}.ids", book.dump()
        out, at, seq, first = None, len(header), 0, None
        doc_ids: list[int | None] = []
        lengths: list[np.ndarray] = []
        parts: list[np.ndarray] = []
        found: list[tuple] = []
        held = 0

        def flush():
            nonlocal out, at, seq, held
            if out is None:
                out = store.open_output_stream(f"{base}/{name}", compression=None)
                out.write(header)
            data = pack_frame(doc_ids, np.concatenate(lengths), np.concatenate(parts), book, every)
            out.write(data)
            found.append((name, first[0], first[1], seq, len(header), at, len(data), len(doc_ids), held))
            at, seq, held = at + len(data), seq + 1, 0
            doc_ids.clear(), lengths.clear(), parts.clear()

        for whole in batches:
            for batch in blocks(iter([whole]), "ids", frame_ids * kind.itemsize):
                if first is None:
                    first = batch.column("doc_id")[0].as_py(), batch.column("tie")[0].as_py()
                doc_ids += batch.column("doc_id").to_pylist()
                n = batch.column("n_tokens").to_numpy()
                lengths.append(n)
                parts.append(_flat(batch.column("ids"), kind).copy())
                held += int(n.sum())
                if held >= frame_ids:
                    flush()
        if doc_ids:
            flush()
        if out is not None:
            out.close()
        columns = list(zip(*found)) or [()] * 9
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32()] + [pa.int64()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                         ["file", "first_doc", "first_tie", "seq", "header", "offset", "length", "documents", "n_ids"])

    spread = tokens.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    frames = durable(spread.mapInArrow(run, DIRECTORY_SCHEMA))
    # One row per file, that is per writing task; ranges never share a (doc_id, tie), so first rows order the files.
    files = frames.groupBy("file", "first_doc", "first_tie").agg(F.sum("n_ids").alias("n"))
    order = Window.orderBy(F.col("first_doc").asc_nulls_first(), "first_tie")
    before = files.select("file", (F.sum("n").over(order) - F.col("n")).alias("before"))
    inside = Window.partitionBy("file").orderBy("seq")
    based = frames.join(before, "file").withColumn("base", F.col("before") + F.sum("n_ids").over(inside) - F.col("n_ids"))
    return durable(based.select("file", "seq", "header", "offset", "length", "documents", "n_ids", "base"))


def _read_frames(rows: list[dict], folder: str) -> Iterator[tuple[dict, Frame, tuple[np.ndarray, np.ndarray]]]:
    """Range-read frames; a file's codebook is read once, and the last decoding table is kept."""
    store, base = fs.FileSystem.from_uri(folder)
    known, table = None, None
    for row in rows:
        with store.open_input_file(f"{base}/{row['file']}") as f:
            head = f.read(row["header"])
            if head != known:
                known, table = head, Codebook.load(head).table()
            f.seek(row["offset"])
            data = f.read(row["length"])
        yield row, Frame.parse(data), table


def read_token_files(directory: DataFrame, folder: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document of the files (and its ``ids``, if asked for)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, frame, table in _read_frames(batch.to_pylist(), folder):
                ids = frame.ids(table).astype("<u4")
                ends = np.cumsum(frame.lengths)
                starts = ends - frame.lengths
                crc = [zlib.crc32(ids[a:z].tobytes()) for a, z in zip(starts.tolist(), ends.tolist())]
                columns = [pa.array(frame.doc_ids, pa.int64()), pa.array(starts + row["base"]), pa.array(frame.lengths), pa.array(crc, pa.int64())]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.append(starts, len(ids)), pa.int32()), pa.array(ids.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    size = directory.agg(F.sum("length")).first()[0] or 0
    # The directory is tiny, so the number of reading tasks is named, or they would be merged into one.
    dealt = directory.repartition(max(1, -(-int(size) // TASK_BYTES)), "file", "offset")
    return dealt.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else ""))


def read_slice(directory: DataFrame, folder: str, first: int, last: int) -> DataFrame:
    """(position, ids): the ids at corpus positions first..last - 1, a row per frame, decoding only the blocks that hold them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, frame, table in _read_frames(batch.to_pylist(), folder):
                a = max(first - row["base"], 0)
                ids = frame.ids(table, a, last - row["base"])
                yield pa.RecordBatch.from_arrays([pa.array([row["base"] + a]), pa.array([ids.tolist()], pa.list_(pa.int32()))], ["position", "ids"])

    touched = directory.where((F.col("base") < last) & (F.col("base") + F.col("n_ids") > first))
    return touched.mapInArrow(run, "position long, ids array<int>")


def write_documents(spark: SparkSession, docs: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> tuple[DataFrame, str]:
    """(directory, folder) of the token files of all documents.

    Null and empty texts have the end id alone. Null doc_ids come first, equal ones in
    the order of a hash of their texts, equal rows once each. Texts of any length are one document, in a
    frame of their own where they are longer. Extra columns are ignored; an empty table gives an empty directory.
    """
    from tokenizers import Tokenizer

    vocabulary = max(Tokenizer.from_file(tokenizer_path).get_vocab_size(), end_id + 1)
    tokens = durable(token_ids(docs, tokenizer_path, end_id))
    folder = scratch_table(spark, "tokens")
    return write_token_files(tokens, codebook(tokens, vocabulary), vocabulary, folder), folder
