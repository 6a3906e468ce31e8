"""Hashed maximum-entropy language model with a class-factored softmax.

A token's probability is that of its class given the text before it, times its own
within the class. The class logits add weights of hashed features: the word before
(n-gram), the word two before (skip) and the pair of their classes. Within a class a
word's logit adds its log count and a hashed weight of (class before, word). The
rarest words share one class, in which they follow their add-one counts, unknown
words included, so that the probabilities of all words and one unknown sum to 1.

Counts and weights come from all training texts: words are counted exactly, and every
task runs Adagrad over its texts from the shared weights; the token-weighted mean
of the changes starts the next round. Tables on the driver have fixed sizes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genolith.llm.common import blocks, mix, text_or_empty, word_hashes, words_of
from genolith.session import durable

#: Words with their own weights, and words whose exact counts every task holds; the others are looked up by a join.
HEAD, EXACT = 1 << 15, 1 << 20
CLASSES, FEATURE_ROWS, OWN_ROWS, PAIR_WEIGHTS = 48, 4096, 2048, 1 << 18
#: Most frequent words whose neighbourhood decides a word's class.
SIGNPOSTS = 32
ROUNDS, STEP, PAIR_STEP, BATCH_TOKENS = 2, 0.15, 0.1, 1 << 15
#: Training tokens that one task runs through.
TASK_TOKENS = 4_000_000
END_HASH = np.uint64(0x5851F42D4C957F2D)
DELTA_FLOATS = 1 << 14
_LOG10 = np.log(10.0)


def held_out(doc_id: str = "doc_id") -> Column:
    """crc32 of the id's text modulo 7 is 2; a null id counts as an empty text."""
    return F.crc32(F.encode(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), "UTF-8")) % 7 == 2


def word_counts(rows: DataFrame) -> DataFrame:
    """(hash, n) of every token of the texts; one end token a text. Tasks add up before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, ends = [], 0, 0

        def merged():
            h = np.concatenate([x[0] for x in held])
            n = np.concatenate([x[1] for x in held])
            order = np.argsort(h)
            h, n = h[order], n[order]
            new = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
            return h[new], np.add.reduceat(n, new)

        def batch_of(h, n):
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n.astype(np.int64))], ["hash", "n"])

        for block in blocks(batches, "text"):
            words = words_of(block.column("text"))
            ends += block.num_rows
            if len(words.codes):
                n = np.bincount(words.codes, minlength=len(words.dictionary))
                held.append((word_hashes(words.dictionary)[n > 0], n[n > 0]))
                size += len(words.dictionary)
            if size > 2_000_000:
                h, n = merged()
                if len(h) > 1_000_000:
                    yield batch_of(h, n)
                    held, size = [], 0
                else:
                    held, size = [(h, n)], len(h)
        if ends:
            held.append((np.array([END_HASH]), np.array([ends])))
            yield batch_of(*merged())

    return rows.mapInArrow(run, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """Exact counts of the frequent words by rank, and totals over all words."""

    hashes: np.ndarray  # by rank
    counts: np.ndarray
    total: int
    distinct: int
    least: int  # words with fewer occurrences are not in the table
    head: int

    def __post_init__(self):
        self.order = np.argsort(self.hashes)
        self.sorted = self.hashes[self.order]
        self.tail_total = self.total - int(self.counts[: self.head].sum())
        self.tail_distinct = self.distinct - self.head
        self.end = int(np.flatnonzero(self.hashes == END_HASH)[0])

    @property
    def rows(self) -> np.ndarray:
        """Feature row of every rank: frequent words have their own."""
        rank = np.arange(len(self.hashes))
        return np.where(rank < OWN_ROWS, rank, self.hashed_row(self.hashes)).astype(np.int32)

    @staticmethod
    def hashed_row(hashes: np.ndarray) -> np.ndarray:
        return OWN_ROWS + (mix(hashes) % np.uint64(FEATURE_ROWS - OWN_ROWS)).astype(np.int64)

    def codes(self, hashes: np.ndarray) -> np.ndarray:
        """Rank of each word, or -1 - feature row of a word that is not in the table."""
        at = np.minimum(np.searchsorted(self.sorted, hashes), len(self.sorted) - 1)
        return np.where(self.sorted[at] == hashes, self.order[at], -1 - self.hashed_row(hashes)).astype(np.int32)


def vocabulary(counts: DataFrame) -> Vocabulary | None:
    """The words of at least so many occurrences that at most EXACT pass; None without tokens."""
    level = F.floor(F.log2("n") * 8).cast("int")
    levels = counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("words"), F.sum("n").alias("tokens"), F.min("n").alias("least")).collect()
    if not levels:
        return None
    least, room = None, EXACT
    for r in sorted(levels, key=lambda r: -r["level"]):
        room -= r["words"]
        if room < 0:
            break
        least = r["least"]
    end = np.array([END_HASH]).view(np.int64)[0]
    chosen = counts.where((F.col("n") >= least) | (F.col("hash") == int(end)))
    table = chosen.toArrow()
    hashes = table["hash"].to_numpy().view(np.uint64)
    n = table["n"].to_numpy()
    order = np.lexsort((hashes, -n))
    hashes, n = hashes[order], n[order]
    # Singletons stay out of the head: their class stands for the unseen words.
    head = min(HEAD, int((n >= 2).sum()))
    place = int(np.flatnonzero(hashes == END_HASH)[0])
    if place >= head:  # the end token always has its own weights
        move = np.concatenate([[place], np.delete(np.arange(len(n)), place)])
        hashes, n, head = hashes[move], n[move], max(head, 1)
    return Vocabulary(hashes, n, int(sum(r["tokens"] for r in levels)), int(sum(r["words"] for r in levels)), int(least), head)


ENCODED_SCHEMA = "row_id long, doc_id long, held_out boolean, codes array<int>, tail array<long>"


def encoded(rows: DataFrame, shared) -> DataFrame:
    """Texts as codes with the end token, and the hashes of the words that are not in the table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        vocabulary: Vocabulary = shared.value
        row = TaskContext.get().partitionId() << 33
        for block in blocks(batches, "text"):
            words = words_of(block.column("text"))
            hashes = word_hashes(words.dictionary)
            if len(hashes):
                code = vocabulary.codes(hashes)[words.codes]
            else:
                code = np.empty(0, np.int32)
            n = block.num_rows
            stops = words.starts[1:]
            codes = np.insert(code, stops, vocabulary.end).astype(np.int32)
            lost = code < 0
            tail = hashes[words.codes[lost]].view(np.int64) if lost.any() else np.empty(0, np.int64)
            tail_starts = np.concatenate([[0], np.cumsum(lost)])[words.starts]
            yield pa.RecordBatch.from_arrays([
                pa.array(row + np.arange(n)), block.column("doc_id"), block.column("held_out"),
                pa.ListArray.from_arrays(pa.array(words.starts + np.arange(n + 1), pa.int32()), pa.array(codes)),
                pa.ListArray.from_arrays(pa.array(tail_starts, pa.int32()), pa.array(tail))], ["row_id", "doc_id", "held_out", "codes", "tail"])
            row += n

    return rows.mapInArrow(run, ENCODED_SCHEMA)


def _code_blocks(batches: Iterator[pa.RecordBatch], tokens: int = 1 << 20) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, codes, starts) of about so many tokens."""
    for batch in batches:
        column = batch.column("codes")
        offsets = column.offsets.to_numpy().astype(np.int64)
        a = 0
        while a < batch.num_rows:
            b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + tokens, side="right")) - 1)
            part = column.slice(a, b - a)
            yield batch.slice(a, b - a), part.flatten().to_numpy(), offsets[a:b + 1] - offsets[a]
            a = b


def _before(codes: np.ndarray, starts: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The codes one and two places before; the end token stands before a text."""
    one = np.concatenate([[end], codes[:-1]]).astype(np.int64)
    two = np.concatenate([[end, end], codes[:-2]]).astype(np.int64)[: len(codes)]
    one[starts[:-1]] = end
    two[starts[:-1]] = end
    return one, two


# ------------------------------------------------------------------ classes


def neighbour_counts(texts: DataFrame, head: int) -> DataFrame:
    """(cell, n): how often a head word stands after or before each signpost word; at most HEAD * 2 * SIGNPOSTS cells."""
    width = 2 * SIGNPOSTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(head * width, np.int64)
        for _, codes, _ in _code_blocks(batches):
            a, b = codes[:-1].astype(np.int64), codes[1:].astype(np.int64)
            after = (a >= 0) & (a < SIGNPOSTS) & (b >= 0) & (b < head)
            before = (b >= 0) & (b < SIGNPOSTS) & (a >= 0) & (a < head)
            sums += np.bincount(b[after] * width + a[after], minlength=len(sums))
            sums += np.bincount(a[before] * width + SIGNPOSTS + b[before], minlength=len(sums))
        cells = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(sums[cells])], ["cell", "n"])

    return texts.select("codes").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))


def word_classes(cells: np.ndarray, counts: np.ndarray, head: int) -> np.ndarray:
    """Class of every head word: k-means of the neighbourhoods' square-root profiles."""
    profile = np.zeros(head * 2 * SIGNPOSTS, np.float32)
    profile[cells] = np.sqrt(counts)
    profile = profile.reshape(head, -1)
    norm = np.linalg.norm(profile, axis=1, keepdims=True)
    profile = profile / np.maximum(norm, 1.0)
    k = min(CLASSES, head)
    weight = np.minimum(norm[:, 0], 30.0)
    centres, near = [0], np.full(head, np.inf, np.float32)
    for _ in range(k - 1):
        near = np.minimum(near, ((profile - profile[centres[-1]]) ** 2).sum(1))
        centres.append(int((near * weight).argmax()))
    means = profile[centres].copy()
    for _ in range(10):
        owner = (profile @ means.T - (means**2).sum(1) / 2).argmax(1)
        for c in range(k):
            own = owner == c
            if own.any():
                means[c] = np.average(profile[own], axis=0, weights=weight[own] + 1e-3)
    return owner.astype(np.int64)


# ------------------------------------------------------------------- model


class Model:
    """Weights of the model, all of fixed size."""

    def __init__(self, vocabulary: Vocabulary, classes: np.ndarray):
        self.end, self.head = vocabulary.end, vocabulary.head
        self.tail = CLASSES  # class of all words beyond the head
        self.of_class = np.concatenate([classes, [self.tail]])
        self.rows = vocabulary.rows
        self.log_counts = np.log(vocabulary.counts[: self.head].astype(np.float64))
        size = np.bincount(classes, vocabulary.counts[: self.head], minlength=CLASSES + 1).astype(np.float64)
        size[self.tail] = vocabulary.tail_total + 1
        # A class without words keeps a negligible share of the probability.
        bias = np.log(np.maximum(size, 1e-9) / size.sum())
        n = CLASSES + 1
        self.shapes = [(FEATURE_ROWS, n), (FEATURE_ROWS, n), (n * n, n), (1, n), (PAIR_WEIGHTS,)]
        self.weights = [np.zeros(s, np.float32) for s in self.shapes]
        self.weights[3][0] = bias
        # Place of the weight of (class before, word): one column a class before.
        word = np.arange(self.head, dtype=np.uint64)
        self.pairs = np.stack([(mix(word * np.uint64(n) + np.uint64(c)) % np.uint64(PAIR_WEIGHTS)).astype(np.int32) for c in range(n)])

    def flat(self) -> np.ndarray:
        return np.concatenate([w.ravel() for w in self.weights])

    def add(self, change: np.ndarray) -> None:
        at = 0
        for w in self.weights:
            w += change[at: at + w.size].reshape(w.shape)
            at += w.size

    def features(self, codes: np.ndarray, starts: np.ndarray):
        """(class, rows of the three feature tables, class before) of every token."""
        one, two = _before(codes, starts, self.end)
        row = lambda c: np.where(c >= 0, self.rows[np.maximum(c, 0)], -1 - c)
        cls = lambda c: self.of_class[np.where((c >= 0) & (c < self.head), c, self.head)]
        c1 = cls(one)
        return cls(codes.astype(np.int64)), row(one), row(two), c1 * (CLASSES + 1) + cls(two), c1

    def logits(self, r1: np.ndarray, r2: np.ndarray, r3: np.ndarray) -> np.ndarray:
        x = self.weights[0][r1]
        x += self.weights[1][r2]
        x += self.weights[2][r3]
        x += self.weights[3]
        return x

    def word_logits(self) -> np.ndarray:
        return self.log_counts + self.weights[4][self.pairs]

    def word_normalisers(self, logits: np.ndarray) -> np.ndarray:
        """log sums of exp of the word logits by (class before, class)."""
        top = logits.max()
        out = np.full((CLASSES + 1, CLASSES + 1), -np.inf)
        classes = self.of_class[: self.head]
        with np.errstate(divide="ignore"):
            for c in range(CLASSES + 1):
                out[c] = np.log(np.bincount(classes, np.exp(logits[c] - top), minlength=CLASSES + 1)) + top
        return out

    def log_probabilities(self, codes: np.ndarray, starts: np.ndarray, tables) -> np.ndarray:
        """Natural log probability of every token's class, and of the word in it for head words."""
        logits, normalisers = tables
        target, r1, r2, r3, c1 = self.features(codes, starts)
        out = np.empty(len(codes))
        for s in range(0, len(codes), BATCH_TOKENS):
            part = slice(s, s + BATCH_TOKENS)
            x = self.logits(r1[part], r2[part], r3[part])
            x -= x.max(1, keepdims=True)
            chosen = x[np.arange(len(x)), target[part]].astype(np.float64)
            out[part] = chosen - np.log(np.exp(x).sum(1, dtype=np.float64))
        own = np.flatnonzero((codes >= 0) & (codes < self.head))
        word, before = codes[own], c1[own]
        out[own] += logits[before, word] - normalisers[before, target[own]]
        return out


def _train(model: Model, blocks_: Iterator[tuple]) -> int:
    """Adagrad over the texts, batch by batch; returns the tokens seen."""
    squares = [np.full(s, 1e-6, np.float32) for s in model.shapes]
    classes, head, n = model.of_class[: model.head], model.head, CLASSES + 1
    seen, since = 0, 0
    observed = np.zeros((n, head))

    def word_step():
        logits = model.word_logits()
        share = np.exp(logits - model.word_normalisers(logits)[:, classes])
        by_class = np.stack([np.bincount(classes, observed[c], minlength=n) for c in range(n)])
        change = observed - share * by_class[:, classes]
        g = np.bincount(model.pairs.ravel(), change.ravel(), minlength=PAIR_WEIGHTS).astype(np.float32)
        squares[4] += g * g
        model.weights[4] += PAIR_STEP * g / np.sqrt(squares[4])
        observed[:] = 0

    for _, codes, starts in blocks_:
        target, *rows, c1 = model.features(codes, starts)
        for s in range(0, len(codes), BATCH_TOKENS):
            part = slice(s, s + BATCH_TOKENS)
            t = target[part]
            g = model.logits(*(r[part] for r in rows))
            g -= g.max(1, keepdims=True)
            np.exp(g, out=g)
            g /= g.sum(1, keepdims=True)
            g[np.arange(len(t)), t] -= 1
            for k, r in enumerate(rows):
                place = r[part]
                order = np.argsort(place, kind="stable")
                place = place[order]
                new = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
                total, place = np.add.reduceat(g[order], new, axis=0), place[new]
                h = squares[k][place] + total * total
                squares[k][place] = h
                model.weights[k][place] -= STEP * total / np.sqrt(h)
            total = g.sum(0, keepdims=True)
            squares[3] += total * total
            model.weights[3] -= STEP / 10 * total / np.sqrt(squares[3])
        own = (codes >= 0) & (codes < head)
        observed += np.bincount(c1[own] * head + codes[own], minlength=n * head).reshape(n, head)
        seen += len(codes)
        since += len(codes)
        if since >= 4 * BATCH_TOKENS:
            word_step()
            since = 0
    if since:
        word_step()
    return seen


def train_round(texts: DataFrame, model: Model) -> np.ndarray:
    """Token-weighted mean change of the weights over the tasks.

    A task sends its change in blocks; the changes of a block are added up in a
    stream, so no task holds more than a few blocks.
    """
    shared = texts.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import copy

        own = copy.deepcopy(shared.value)
        before = own.flat()
        seen = _train(own, _code_blocks(batches))
        if seen:
            change = (own.flat() - before).astype(np.float64) * seen
            for at in range(0, len(change), DELTA_FLOATS):
                yield pa.RecordBatch.from_arrays([pa.array([at // DELTA_FLOATS], pa.int32()), pa.array([float(seen)]), pa.array([change[at: at + DELTA_FLOATS].astype(np.float32).tobytes()], pa.binary())],
                                                 ["block", "tokens", "change"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list] = {}
        for batch in batches:
            for block, tokens, change in zip(*(batch.column(c).to_pylist() for c in ("block", "tokens", "change"))):
                values = np.frombuffer(change, np.float32).astype(np.float64)
                if block in sums:
                    sums[block][0] += tokens
                    sums[block][1] += values
                else:
                    sums[block] = [tokens, values]
        for block, (tokens, values) in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([tokens]), pa.array([values.tobytes()], pa.binary())], ["block", "tokens", "change"])

    schema = "block int, tokens double, change binary"
    changes = durable(texts.select("codes").mapInArrow(run, schema))
    sums = {r["block"]: np.frombuffer(r["change"], np.float64) / r["tokens"] for r in changes.repartition("block").mapInArrow(add, schema).collect()}
    shared.destroy()
    return np.concatenate([sums[b] for b in sorted(sums)]).astype(np.float32) if sums else np.zeros_like(model.flat())


def score_documents(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document.

    Learns from the documents that are not held out. Null text is empty and has
    the end token only; null ids are in training; repeated rows are documents of
    their own. Without training documents every token is unknown: both scores
    are 0 then, the one event having probability 1. Extra columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), text_or_empty().alias("text"))
    counts = durable(word_counts(rows.where("not held_out").select("text")))
    words = vocabulary(counts)
    if words is None:
        n = (F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")) + 1).cast("long")
        return rows.select("doc_id", "held_out", n.alias("n_tokens"), F.lit(0).cast("long").alias("n_known"), F.lit(0).cast("long").alias("train_tokens"),
                           F.lit(0.0).alias("base_score"), F.lit(0.0).alias("score"))
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(words)
    texts = durable(encoded(rows, shared))
    training = texts.where("not held_out").select("row_id", "codes")
    cells = neighbour_counts(training, words.head).toArrow()
    model = Model(words, word_classes(cells["cell"].to_numpy(), cells["n"].to_numpy(), words.head))
    tasks = max(1, -(-words.total // (TASK_TOKENS * rounds)))
    for r in range(rounds):
        model.add(train_round(training.where(F.pmod(F.xxhash64("row_id"), F.lit(rounds)) == r).coalesce(tasks), model))
    scored = durable(_scored(texts, model, words, shared))
    lost = scored.where("size(tail) > 0").select("row_id", F.explode("tail").alias("hash")).groupBy("row_id", "hash").agg(F.count(F.lit(1)).alias("times"))
    rare = counts.where(F.col("n") < words.least)
    c = F.coalesce("n", F.lit(0))
    base, own = words.total + words.distinct + 1, words.tail_total + words.tail_distinct + 1
    late = lost.join(rare, "hash", "left").groupBy("row_id").agg(
        F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("late_known"),
        F.sum(F.col("times") * F.log10((c + 1) / F.lit(float(base)))).alias("late_base"),
        F.sum(F.col("times") * F.log10((c + 1) / F.lit(float(own)))).alias("late_score"))
    zero = lambda name: F.coalesce(F.col(name), F.lit(0))
    return scored.drop("tail").join(late, "row_id", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + zero("late_known")).cast("long").alias("n_known"), F.lit(words.total).cast("long").alias("train_tokens"),
        (F.col("base") + zero("late_base")).alias("base_score"), (F.col("own") + zero("late_score")).alias("score"))


def _scored(texts: DataFrame, model: Model, words: Vocabulary, shared) -> DataFrame:
    """Sums over the tokens in the table, and the hashes of the others."""
    sent = texts.sparkSession.sparkContext.broadcast(model)
    schema = "row_id long, doc_id long, held_out boolean, n_tokens long, known long, base double, own double, tail array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, words = sent.value, shared.value
        logits = model.word_logits()
        tables = logits, model.word_normalisers(logits)
        base = np.log10((words.counts + 1.0) / (words.total + words.distinct + 1.0))
        rest = np.log10((words.counts + 1.0) / (words.tail_total + words.tail_distinct + 1.0))
        for rows, codes, starts in _code_blocks(batches):
            own = model.log_probabilities(codes, starts, tables) / _LOG10
            known = codes >= 0
            rank = np.maximum(codes, 0)
            own += np.where(codes >= model.head, rest[rank], 0.0)
            at = starts[:-1]
            sums = [np.add.reduceat(x, at) for x in (known.astype(np.int64), np.where(known, base[rank], 0.0), own)]
            yield pa.RecordBatch.from_arrays([rows.column("row_id"), rows.column("doc_id"), rows.column("held_out"), pa.array(np.diff(starts)),
                                              pa.array(sums[0]), pa.array(sums[1]), pa.array(sums[2]), rows.column("tail")],
                                             ["row_id", "doc_id", "held_out", "n_tokens", "known", "base", "own", "tail"])

    return texts.mapInArrow(run, schema)


def is_held_out(doc_id: int | None) -> bool:
    """The same split in Python."""
    return zlib.crc32(str("" if doc_id is None else doc_id).encode()) % 7 == 2
