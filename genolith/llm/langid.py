"""Language identification by Bayesian evidence fusion.

The posterior of a language multiplies a host prior, the likelihood of the text's
byte trigrams, and the probabilities of the declared language and the address
suffix given the language. Trigram models, the two evidence tables and the host
counts all come from grouped aggregation; host priors are smoothed from global over
domain to host, the document's own vote left out. ``und`` is a language of its
own, in which all trigrams are equally likely.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genolith.llm.common import blocks, release_memory, row_key, text_or_empty
from genolith.session import durable

BUCKETS = 1 << 15
#: Suffixes that have probabilities of their own.
MOST_SUFFIXES = 512
#: Text worked on at once, in bytes: a byte takes some fifty in arrays.
TEXT_BYTES = 1 << 20
#: Languages whose trigram weights a task unfolds at once, and (row, language) cells that it works on at once.
LANGUAGE_BLOCK, CELLS = 64, 1 << 21
UNKNOWN = "und"
UNKNOWN_PRIOR = 0.01
#: Trigrams that a text counts for at most, and how many overlapping ones make one independent observation.
MOST_TRIGRAMS, OVERLAP = 300, 3.0
SMOOTHING = 0.05
DOMAIN_WEIGHT, HOST_WEIGHT = 20.0, 10.0
EVIDENCE_SMOOTHING = 1.0
LEAST_POSTERIOR = 0.5
SALTS = 16


def _trigrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, starts): the hashed byte trigrams of each text, A-Z lower-cased; those with a digit say nothing and are left out."""
    lowered = pc.ascii_lower(texts).cast(pa.large_binary())
    offsets = np.frombuffer(lowered.buffers()[1], np.int64)[lowered.offset: lowered.offset + len(lowered) + 1]
    data = np.frombuffer(lowered.buffers()[2], np.uint8)[offsets[0]: offsets[-1]] if lowered.buffers()[2] else np.empty(0, np.uint8)
    starts = offsets - offsets[0]
    n = np.maximum(np.diff(starts) - 2, 0)
    if not n.sum():
        return np.empty(0, np.int32), np.zeros(len(texts) + 1, np.int64)
    wide = data.astype(np.uint32)
    code = (wide[:-2] << np.uint32(16)) | (wide[1:-1] << np.uint32(8)) | wide[2:]
    bucket = ((code * np.uint32(2654435761)) >> np.uint32(17)).astype(np.int32)
    inside = np.ones(len(bucket) + 2, bool)
    ends = starts[1:]
    filled = np.diff(starts) > 0
    inside[ends[filled] - 1] = False
    inside[np.maximum(ends - 2, starts[:-1])[filled]] = False
    # The last two places of a text start no trigram; in a shorter text no place does.
    digit = (data >= 48) & (data <= 57)
    inside = inside[: len(bucket)] & ~(digit[:-2] | digit[1:-1] | digit[2:])
    before = np.concatenate([[0], np.cumsum(inside)])
    return bucket[inside], before[np.minimum(starts, len(bucket))]


def base_language(declared: Column) -> Column:
    """``en`` of ``en-US`` or ``EN_us``; null of null or empty."""
    code = F.lower(F.regexp_extract(F.trim(declared.cast("string")), "^([A-Za-z]{2,8})", 1))
    return F.when(code != "", code)


@dataclass
class TextModel:
    """Languages (the last is UNKNOWN), their shares, and log probabilities of the trigram buckets.

    Language c has ``weights[starts[c]:starts[c + 1]]`` at its ``buckets`` and ``absent[c]`` at all others.
    """

    languages: list[str]
    starts: np.ndarray
    buckets: np.ndarray
    weights: np.ndarray
    absent: np.ndarray
    shares: np.ndarray

    def table(self, first: int) -> np.ndarray:
        """Weights of all buckets (rows) for LANGUAGE_BLOCK languages from ``first`` on."""
        last = min(first + LANGUAGE_BLOCK, len(self.languages))
        out = np.empty((BUCKETS, last - first))
        out[:] = self.absent[first:last]
        a, z = self.starts[first], self.starts[last]
        out[self.buckets[a:z], np.repeat(np.arange(last - first), np.diff(self.starts[first:last + 1]))] = self.weights[a:z]
        return out


def _slices(batch: pa.RecordBatch, languages: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices of at most CELLS cells."""
    step = max(1, CELLS // languages)
    for i in range(0, batch.num_rows, step):
        yield batch.slice(i, step)


def train(docs: DataFrame, text: str = "text", label: str = "lang") -> TextModel:
    """Trigram counts of every labelled text, added up per language; rows without label or text add nothing.

    Every label is a language. Only the (language, bucket) cells that occur reach the driver.
    """
    rows = docs.select(base_language(F.col(label)).alias("label"), text_or_empty(text).alias("text")).where("label is not null")
    sizes = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    names = sorted(name for name in sizes if name != UNKNOWN)
    code = {name: i for i, name in enumerate(names)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}

        def flushed() -> pa.RecordBatch:
            cells = [(c * BUCKETS + np.flatnonzero(counts), counts[counts > 0]) for c, counts in sums.items()]
            sums.clear()
            found = [np.concatenate([x[k] for x in cells]) if cells else np.empty(0, np.int64) for k in range(2)]
            return pa.RecordBatch.from_arrays([pa.array(x) for x in found], ["cell", "n"])

        for block in blocks(batches, "text", TEXT_BYTES):
            bucket, starts = _trigrams(block.column("text"))
            own = np.array([code.get(x, -1) for x in block.column("label").to_pylist()], np.int64)
            for c in np.unique(own[own >= 0]).tolist():
                # The texts of one language after another, without an array over all of them.
                n = np.bincount(np.concatenate([bucket[starts[d]:starts[d + 1]] for d in np.flatnonzero(own == c)]), minlength=BUCKETS)
                sums[c] = sums[c] + n if c in sums else n
                if len(sums) > LANGUAGE_BLOCK:
                    yield flushed()
        yield flushed()
        release_memory()

    cells, n = np.empty(0, np.int64), np.empty(0, np.int64)
    if names:
        table = rows.mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
        cells, n = table["cell"].to_numpy(), table["n"].to_numpy()
        order = np.argsort(cells)
        cells, n = cells[order], n[order]
    own = cells // BUCKETS
    totals = np.bincount(own, n, minlength=len(names)) + SMOOTHING * BUCKETS
    starts = np.searchsorted(own, np.arange(len(names) + 2))
    absent = np.append(np.log(SMOOTHING / totals), -np.log(BUCKETS))
    shares = np.array([sizes[x] for x in names], float)
    shares = np.append(shares / max(shares.sum(), 1.0) * (1 - UNKNOWN_PRIOR), UNKNOWN_PRIOR)
    return TextModel([*names, UNKNOWN], starts, (cells % BUCKETS).astype(np.int32), np.log((n + SMOOTHING) / totals[own]), absent, shares / shares.sum())


CAPTURE_COLUMNS = ["key", "declared", "suffix", "host", "domain"]


def text_evidence(captures: DataFrame, model: TextModel, keep: list[str]) -> DataFrame:
    """Adds trigrams (how many), letters (whether there are any), loglik and best to the captures; drops the text."""
    sent = captures.sparkSession.sparkContext.broadcast(model)
    fields = ", ".join(f"`{k}` {captures.schema[k].dataType.simpleString()}" for k in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        prior, size = np.log(model.shares), len(model.languages)
        kept = model.table(0) if size <= LANGUAGE_BLOCK else None
        for block in (part for whole in blocks(batches, "text", TEXT_BYTES) for part in _slices(whole, size)):
            texts = block.column("text")
            bucket, starts = _trigrams(texts)
            n = np.diff(starts)
            sums = np.zeros((len(n), size))
            some = np.flatnonzero(n)
            for first in range(0, size if len(some) else 0, LANGUAGE_BLOCK):
                weights = model.table(first) if kept is None else kept
                for c in range(weights.shape[1]):
                    sums[some, first + c] = np.add.reduceat(weights[bucket, c], starts[:-1][some], dtype=np.float64)
            scale = np.minimum(n, MOST_TRIGRAMS) / np.maximum(n, 1) / OVERLAP
            loglik = sums * scale[:, None]
            best = (loglik + prior).argmax(1)
            letters = pc.match_substring_regex(texts, r"\p{L}")
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1) * size, pa.int32()), pa.array(loglik.ravel()))
            yield pa.RecordBatch.from_arrays([*(block.column(k) for k in keep), pa.array(n), letters, lists, pa.array(best, pa.int32())],
                                             [*keep, "trigrams", "letters", "loglik", "best"])
        release_memory()

    return captures.mapInArrow(run, f"{fields}, trigrams long, letters boolean, loglik array<double>, best int")


@dataclass
class Evidence:
    """log P(value | language) of the listed values and of all others together (None); only counts above zero are held."""

    counts: dict[str | None, tuple[list[int], list[int]]]
    totals: np.ndarray

    def row(self, value: str | None) -> np.ndarray:
        which, n = self.counts.get(value, self.counts[None])
        seen = np.full(len(self.totals), EVIDENCE_SMOOTHING)
        seen[which] += n
        out = np.log(seen / self.totals)
        # An undetermined text says nothing about what is declared.
        out[-1] = -np.log(len(self.counts))
        return out


def _table(rows: DataFrame, column: str, values: list[str], languages: int) -> Evidence:
    listed = rows.sparkSession.createDataFrame([(v,) for v in values], "value string")
    found = rows.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("name"), "best").count()
    found = found.join(F.broadcast(listed), F.col("name") == F.col("value"), "left").groupBy("value", "best").agg(F.sum("count").alias("n")).collect()
    counts: dict[str | None, tuple[list[int], list[int]]] = {v: ([], []) for v in [*values, None]}
    totals = np.full(languages, EVIDENCE_SMOOTHING * len(counts))
    for r in found:
        which, n = counts[r["value"]]
        which.append(r["best"])
        n.append(r["n"])
        totals[r["best"]] += r["n"]
    return Evidence(counts, totals)


def identify(captures: DataFrame, model: TextModel, keep: list[str]) -> DataFrame:
    """``keep`` columns, language, posterior, text_language and accepted of every capture.

    ``captures`` holds key, text, declared, suffix, host and domain, the last four
    nullable: missing evidence multiplies nothing, and captures without a host
    share the global prior. Accepted are those with letters whose likeliest
    language is not UNKNOWN and has a posterior of LEAST_POSTERIOR or more.
    """
    names, n = model.languages, len(model.languages)
    columns = list(dict.fromkeys([*keep, *CAPTURE_COLUMNS]))
    scored = durable(text_evidence(captures.select(*columns, "text"), model, columns))
    declared = _table(scored, "declared", names[:-1], n)
    common = [r["suffix"] for r in scored.where("suffix is not null").groupBy("suffix").count().orderBy(F.desc("count"), "suffix").limit(MOST_SUFFIXES).collect()]
    suffixes = _table(scored, "suffix", common, n)

    def dense(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
        """``keys`` and the votes of all languages, zeros too."""
        votes = rows.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("best", "n"))).alias("votes"))
        every = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.coalesce(F.element_at("votes", i), F.lit(0)).cast("double"))
        return votes.select(*keys, every.alias(name))

    hosts = durable(scored.where("host is not null").groupBy("host", "domain", "best").agg(F.count(F.lit(1)).alias("n")))
    domains = dense(hosts.groupBy("domain", "best").agg(F.sum("n").alias("n")), ["domain"], "domain_votes").withColumnRenamed("domain", "m")
    by_host = dense(hosts, ["host", "domain"], "host_votes").withColumnRenamed("host", "h")
    both = by_host.join(domains, F.col("domain").eqNullSafe(F.col("m"))).select("h", "m", "host_votes", "domain_votes")
    copies = both.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = scored.withColumn("salt", F.pmod(F.xxhash64("key", F.lit(3)), F.lit(SALTS)).cast("int"))
    salted = salted.withColumn("part", F.coalesce("host", F.concat(F.lit("\x00"), F.col("key").cast("string"))))
    joined = salted.join(copies, (F.col("part") == F.col("h")) & (salted["salt"] == copies["salt"]) & F.col("domain").eqNullSafe(F.col("m")), "left").select(
        *columns, "letters", "loglik", "best", "host_votes", "domain_votes")
    shares = model.shares
    fields = ", ".join(f"`{k}` {captures.schema[k].dataType.simpleString()}" for k in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in _slices(whole, n)):
            loglik = np.array(batch.column("loglik").to_pylist())
            own = np.zeros((batch.num_rows, n))
            own[np.arange(len(own)), batch.column("best").to_numpy()] = 1
            missing = [0.0] * n
            domain = np.array([v or missing for v in batch.column("domain_votes").to_pylist()])
            host = np.array([v or missing for v in batch.column("host_votes").to_pylist()])
            domain = np.maximum(domain - own, 0)
            host = np.maximum(host - own, 0)
            prior = (domain + DOMAIN_WEIGHT * shares) / (domain.sum(1, keepdims=True) + DOMAIN_WEIGHT)
            prior = (host + HOST_WEIGHT * prior) / (host.sum(1, keepdims=True) + HOST_WEIGHT)
            x = np.log(prior) + loglik
            for column, table in (("declared", declared), ("suffix", suffixes)):
                values = batch.column(column).to_pylist()
                rows = {v: table.row(v) for v in set(values) - {None}}
                x += np.array([missing if v is None else rows[v] for v in values])
            x = np.exp(x - x.max(1, keepdims=True))
            x /= x.sum(1, keepdims=True)
            top = x.argmax(1)
            posterior = x[np.arange(len(x)), top]
            accepted = batch.column("letters").to_numpy(zero_copy_only=False) & (top < n - 1) & (posterior >= LEAST_POSTERIOR)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in keep), pa.array([names[i] for i in top]), pa.array(posterior),
                 pa.array([names[i] for i in batch.column("best").to_numpy()]), pa.array(accepted)],
                [*keep, "language", "posterior", "text_language", "accepted"])

    return joined.mapInArrow(run, f"{fields}, language string, posterior double, text_language string, accepted boolean")


def document_captures(docs: DataFrame) -> DataFrame:
    """Documents as captures: the language column is the declaration, the source the host."""
    nothing = F.lit(None).cast("string")
    return docs.select(row_key("doc_id", "lang", "source", "text").alias("key"), F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"),
                       base_language(F.col("lang")).alias("declared"), nothing.alias("suffix"), F.col("source").cast("string").alias("host"), nothing.alias("domain"))


def page_captures(pages: DataFrame) -> DataFrame:
    """Pages as captures: text without markup, the html tag's language, host, domain and suffix of the URL."""
    html = text_or_empty("html")
    text = F.regexp_replace(F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " "), r"<[^>]*>", " ")
    host = F.lower(F.regexp_extract(F.coalesce(F.col("url").cast("string"), F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1))
    host = F.when(host != "", host)
    lang = F.regexp_extract(html, r"""(?is)<html[^>]*\blang\s*=\s*["']?([A-Za-z-]+)""", 1)
    return pages.select(row_key("page_id", "url", "html").alias("key"), F.col("page_id").cast("long").alias("page_id"), text.alias("text"), base_language(lang).alias("declared"),
                        F.regexp_extract(host, r"([^.]+)$", 1).alias("suffix"), host.alias("host"), F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1).alias("domain"))


def identify_documents(docs: DataFrame) -> DataFrame:
    """doc_id, key, language, posterior, text_language, accepted.

    Null and empty texts have no letters and are not accepted. Null language or
    source is missing evidence. Repeated rows get the same result each; extra
    columns are ignored; an empty table gives no rows.
    """
    return identify(document_captures(docs), train(docs), ["doc_id", "key"])


def accepted_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose language is identified."""
    good = identify_documents(docs).where("accepted").select(F.col("key").alias("__key")).distinct()
    return docs.withColumn("__key", row_key("doc_id", "lang", "source", "text")).join(good, "__key", "left_semi").drop("__key")
