"""WARC archives with a two-level capture index.

Captures are written as gzip members, one record each, into archive files of
the shared folder; equal payloads are stored once and revisited. The index sorts
the captures by reversed-host URL key into compressed blocks and keeps one
directory entry per block. A look-up bisects the files' first keys, then a file's
directory, and reads the few block and record ranges it needs.

Tasks write files under names of their own and report them in a table that Spark
commits, so files of lost or repeated tasks are never read.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genolith.session import durable, scratch_table

#: Payloads below this are stored every time.
LEAST_REVISITED = 100
#: Parts that the rows of one payload are dealt to when they meet their first capture.
SALTS = 16
BLOCK_ENTRIES = 2048
ARCHIVE_BYTES = 1 << 30
WARC_DATE = "1970-01-01T00:00:00Z"
CAPTURE_SCHEMA = "key string, page_id long, file string, offset long, length long"
DIRECTORY_SCHEMA = "first_key string, last_key string, file string, offset long, length long, entries long"
RECORD_SCHEMA = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary"
_URL = re.compile(r"^(?:([a-zA-Z][a-zA-Z0-9+.-]*):)?//(?:[^/?#@]*@)?([^/?#:]*)(?::(\d+))?(.*)$", re.S)


def url_key(url: str | None) -> str:
    """Sortable key of a URL: host labels reversed, then path and query; '' for null."""
    if not url:
        return ""
    m = _URL.match(url.strip())
    if not m:
        return re.sub(r"\s", "", url)
    host = ",".join(reversed(m[2].lower().split(".")))
    port = f":{m[3]}" if m[3] and m[3] not in ("80", "443") else ""
    rest = re.sub(r"\s", "", m[4].split("#")[0]) or "/"
    return f"{host}{port}){rest}"


def _open(path: str):
    """(file system, path in it) of a folder; any store that the URI names."""
    return fs.FileSystem.from_uri(path)


# ------------------------------------------------------------------ records


def first_captures(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, digest and refers_to (null: stored here).

    Payloads that occur once need no look-up: only the repeated ones form the
    other side of the join, copied ``SALTS`` times, and each page meets one copy.
    """
    payload = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    repeated = rows.where(F.octet_length("payload") >= LEAST_REVISITED).groupBy("digest").agg(
        F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    copies = repeated.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    return salted.join(copies, ["digest", "salt"], "left").select(
        "page_id", "url", "payload", "digest",
        F.when(F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id")).alias("refers_to"))


def _urn(page_id: int | None) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record; a revisit keeps the HTTP header and leaves the payload out."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Target-URI: {re.sub(r'[\x00-\x20\x7f]', lambda m: f'%{ord(m[0]):02X}', url or '')}",
        f"WARC-Date: {WARC_DATE}", f"WARC-Record-ID: {_urn(page_id)}", f"WARC-Payload-Digest: sha256:{digest}",
    ]
    if refers_to is not None:
        head += [f"WARC-Refers-To: {_urn(refers_to)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}", "", ""]
    return "\r\n".join(head).encode() + body + b"\r\n\r\n"


def parse(data: bytes) -> tuple:
    """``RECORD_SCHEMA`` of a record's bytes; a response's digest and size come from what was read."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in head.decode().split("\r\n")[1:])
    body = rest[: int(fields["Content-Length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    stated = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    number = lambda urn: int(urn[len("<urn:x-page:"):-1]) if len(urn) > len("<urn:x-page:>") else None
    page_id, url = number(fields["WARC-Record-ID"]), fields["WARC-Target-URI"]
    if fields["WARC-Type"] == "revisit":
        return page_id, size, stated, "revisit", number(fields["WARC-Refers-To"]), url, None
    digest = hashlib.sha256(payload).hexdigest()
    if digest != stated or len(payload) != size:
        raise ValueError(f"the record of page {page_id} is damaged")
    return page_id, size, digest, "response", None, url, payload


def write_archives(captures: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the rows of ``first_captures`` to ``folder``; returns ``CAPTURE_SCHEMA``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _open(folder)
        store.create_dir(base, recursive=True)
        out, name, at = None, None, 0
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                if out is None or at >= archive_bytes:
                    if out is not None:
                        out.close()
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = store.open_output_stream(f"{base}/{name}", compression=None)
                pack = zlib.compressobj(6, zlib.DEFLATED, 31)
                data = pack.compress(record(row["page_id"], row["url"], row["payload"], row["digest"], row["refers_to"])) + pack.flush()
                out.write(data)
                found.append((url_key(row["url"]), row["page_id"], name, at, len(data)))
                at += len(data)
            columns = list(zip(*found)) or [()] * 5
            kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["key", "page_id", "file", "offset", "length"])
        if out is not None:
            out.close()

    return durable(captures.mapInArrow(run, CAPTURE_SCHEMA))


# -------------------------------------------------------------------- index


def build_index(captures: DataFrame, folder: str, entries: int = BLOCK_ENTRIES) -> DataFrame:
    """Sort the captures into compressed blocks in ``folder``; returns the directory, one row per block.

    Every index file has its part of the directory beside it. Ranges are cut by key and place, so the captures of one URL may span blocks and files.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _open(folder)
        store.create_dir(base, recursive=True)
        name, at, lines, found = f"{uuid.uuid4().hex}.idx", 0, [], []
        out = None

        def flush():
            nonlocal at, out
            if out is None:
                out = store.open_output_stream(f"{base}/{name}", compression=None)
            data = zlib.compress("\n".join(lines).encode())
            out.write(data)
            found.append((lines[0].split(" ")[0], lines[-1].split(" ")[0], name, at, len(data), len(lines)))
            at += len(data)
            lines.clear()

        for batch in batches:
            for key, page_id, file, offset, length in zip(*(batch.column(c).to_pylist() for c in ("key", "page_id", "file", "offset", "length"))):
                lines.append(f"{key} {'' if page_id is None else page_id} {file} {offset} {length}")
                if len(lines) == entries:
                    flush()
        if lines:
            flush()
        if out is not None:
            out.close()
            with store.open_output_stream(f"{base}/{name}.dir", compression=None) as sparse:
                sparse.write(zlib.compress("\n".join(f"{first} {last} {place} {size}" for first, last, _, place, size, _ in found).encode()))
        columns = list(zip(*found)) or [()] * 6
        kinds = [pa.string()] * 3 + [pa.int64()] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["first_key", "last_key", "file", "offset", "length", "entries"])

    spread = captures.repartitionByRange("key", "file", "offset").sortWithinPartitions("key", "file", "offset")
    return durable(spread.mapInArrow(run, DIRECTORY_SCHEMA))


def _entries(store, base: str, file: str, offset: int, length: int) -> Iterator[tuple]:
    """Range-read one block: (key, page_id, file, offset, length)."""
    with store.open_input_file(f"{base}/{file}") as f:
        f.seek(offset)
        lines = zlib.decompress(f.read(length)).decode().split("\n")
    for line in lines:
        key, page_id, name, at, size = line.rsplit(" ", 4)
        yield key, int(page_id) if page_id else None, name, int(at), int(size)


def scan_index(directory: DataFrame, folder: str) -> DataFrame:
    """All entries of the index, block by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _open(folder)
        for batch in batches:
            for row in batch.to_pylist():
                columns = list(zip(*_entries(store, base, row["file"], row["offset"], row["length"])))
                kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["key", "page_id", "file", "offset", "length"])

    parts = directory.sparkSession.conf.get("spark.sql.shuffle.partitions")
    return directory.repartition(int(parts), "file", "offset").mapInArrow(run, CAPTURE_SCHEMA)


def lookup(urls: DataFrame, directory: DataFrame, folder: str) -> DataFrame:
    """url and the index entries of its captures, for the distinct URLs of a column ``url`` (null asks nothing)."""
    asked = urls.select("url").where("url is not null").distinct()
    return _search(asked.mapInArrow(_with_key, "url string, key string"), directory, folder)


def lookup_keys(urls: DataFrame, directory: DataFrame, folder: str) -> DataFrame:
    """The index entries under the keys of a column ``url``, each entry once; null has the empty key, as in the index."""
    asked = urls.select("url").distinct().mapInArrow(_with_key, "url string, key string").select("key").distinct()
    return _search(asked.select(F.col("key").alias("url"), "key"), directory, folder).drop("url")


def _with_key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = [url_key(u) for u in batch.column("url").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("url"), pa.array(keys, pa.string())], ["url", "key"])


def _search(asked: DataFrame, directory: DataFrame, folder: str) -> DataFrame:
    """(url, key) rows with the entries of their key.

    Level one, the key range of every index file (as many as index tasks), is
    bisected where the key is; level two, a file's directory, in the task that has
    the file's keys in order, so that each block is read once for all of them. The
    entries of a popular key lie in as many files as it fills and leave in batches.
    """
    tops = sorted(directory.groupBy("file").agg(F.min("first_key"), F.max("last_key")).collect(), key=lambda r: (r[1], r[2]))
    files, firsts, lasts = [r[0] for r in tops], [r[1] for r in tops], [r[2] for r in tops]

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(url, key, files[i]) for url, key in zip(batch.column("url").to_pylist(), batch.column("key").to_pylist())
                     for i in range(bisect_left(lasts, key), bisect_right(firsts, key))]
            columns = list(zip(*found)) or [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], ["url", "key", "file"])

    def batch_of(found: list) -> pa.RecordBatch:
        columns = list(zip(*found)) or [()] * 6
        kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["url", "key", "page_id", "file", "offset", "length"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _open(folder)
        name, held, found = None, None, []
        for batch in batches:
            for url, key, file in zip(*(batch.column(c).to_pylist() for c in ("url", "key", "file"))):
                if file != name:
                    with store.open_input_file(f"{base}/{file}.dir") as f:
                        parts = [(first, last, int(at), int(size)) for first, last, at, size in
                                 (line.split(" ") for line in zlib.decompress(f.read()).decode().split("\n"))]
                    ends, name, held = [p[1] for p in parts], file, None
                at = bisect_left(ends, key)
                while at < len(parts) and parts[at][0] <= key:
                    if held != at:
                        block = list(_entries(store, base, file, *parts[at][2:]))
                        keys, held = [e[0] for e in block], at
                    found += [(url, *e) for e in block[bisect_left(keys, key):bisect_right(keys, key)]]
                    at += 1
                    if len(found) >= BLOCK_ENTRIES:
                        yield batch_of(found)
                        found = []
        yield batch_of(found)

    routed = asked.mapInArrow(route, "url string, key string, file string")
    return routed.repartitionByRange("file", "key").sortWithinPartitions("file", "key").mapInArrow(search, "url string, " + CAPTURE_SCHEMA)


def read_records(entries: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """Range-read and parse the records of index entries: ``RECORD_SCHEMA`` (payload null unless asked for)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _open(folder)
        name, source = None, None
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
        names = [c.split(" ")[0] for c in RECORD_SCHEMA.split(", ")]
        for batch in batches:
            found, held = [], 0
            for file, offset, length in zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length"))):
                if file != name:
                    if source is not None:
                        source.close()
                    name, source = file, store.open_input_file(f"{base}/{file}")
                source.seek(offset)
                row = parse(zlib.decompress(source.read(length), 31))
                found.append(row if payloads else (*row[:-1], None))
                held += len(row[-1] or b"") if payloads else 0
                if held > 32 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)], names)
                    found, held = [], 0
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)], names)
        if source is not None:
            source.close()

    return entries.repartitionByRange("file", "offset").sortWithinPartitions("file", "offset").mapInArrow(run, RECORD_SCHEMA)


def archive(spark: SparkSession, pages: DataFrame, folder: str | None = None) -> tuple[DataFrame, str]:
    """Write and index all pages; returns the index directory and the folder.

    Null html is an empty payload, null url an empty key, null page_ids are kept
    and never first while another id is there; repeated rows are captures of their
    own, and all those with the first id are responses. An empty table gives an
    empty index. Extra columns are ignored.
    """
    folder = folder or scratch_table(spark, "warc")
    return build_index(write_archives(first_captures(pages), folder), folder), folder
