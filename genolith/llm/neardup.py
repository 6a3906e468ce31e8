"""Near-duplicate detection: banded MinHash candidates, sequential Bayesian verification, exact links.

Texts with equal shingle sets form a class. Classes whose signatures agree in a
band are candidates. A candidate pair's sketches are compared batch by batch and
dropped as soon as the posterior probability of a similarity at the threshold
falls below ``MISS``; survivors are confirmed on their full shingle sets. To know
the components, not all pairs of a large group are confirmed: every class meets
the busiest class of its band groups first; then, round by round, only its
likeliest partners in other components. At last the groups that still hold several components are
settled block by block: survivors of the test are confirmed on the full sets in place, and only the links that
join components leave the task, fewer than the block has members.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from genolith.llm.common import BLOCK_BYTES, WORD, blocks, gather, mix, row_key, shingle_hashes, text_or_empty, words_of
from genolith.operators.graph import components
from genolith.session import durable, in_few_tasks

BANDS, ROWS = 32, 4
#: Hashes of a sketch; the first BANDS * ROWS make the bands.
HASHES = 256
#: Hashes compared when the posterior is looked at: each batch is as large as all before it.
LOOKS = (16, 32, 64, 128, 256)
#: Posterior probability of a linked pair below which a pair is dropped.
MISS = 1e-7
SHINGLE = 5
#: Links are pairs with 100 * intersection >= LINK_PERCENT * union.
LINK_PERCENT = 75
#: Members of a band group that one comparison block holds.
BLOCK_MEMBERS = 1024
#: Partners of other components that a class gets per block before groups are settled whole.
PARTNERS = 4
#: Rows of comparison blocks that a task compares at least.
TASK_MEMBERS = 8 * BLOCK_MEMBERS
#: Bytes of shingle sets that one comparison block holds, and set elements that are looked up at once.
BLOCK_SETS, LOOKUPS = 8 << 20, 1 << 21


def _factors() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240607)
    return rng.integers(0, 2**32, HASHES, dtype=np.uint32) | np.uint32(1), rng.integers(0, 2**32, HASHES, dtype=np.uint32)


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, starts): the sorted distinct shingles of each text."""
    hashes, starts = shingle_hashes(words_of(texts), SHINGLE)
    sets = [np.unique(hashes[a:b]) for a, b in zip(starts[:-1], starts[1:])]
    ends = np.cumsum([0] + [len(s) for s in sets])
    return (np.concatenate(sets) if sets else np.empty(0, np.uint64)), ends


def least_matches(percent: float = LINK_PERCENT, miss: float = MISS) -> dict[int, int]:
    """Matches that a pair needs after each batch for P(similarity >= threshold | matches) >= miss.

    With a uniform prior the posterior after s of m matches is Beta(s + 1, m - s + 1),
    whose upper tail at x is the binomial P(X <= s) with m + 1 draws. Sketches
    keep 8 bits a hash, so unequal ones agree once in 256.
    """
    x = percent / 100 + (1 - percent / 100) / 256
    need = {}
    for m in LOOKS:
        tail, s = 0.0, -1
        while tail < miss:
            s += 1
            tail += comb(m + 1, s) * x**s * (1 - x) ** (m + 1 - s)
        need[m] = s
    return need


NEEDED = least_matches()


def surviving(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions that survive all batches, their matches) of row-wise sketch pairs."""
    alive, matches, done = np.arange(len(left)), np.zeros(len(left), np.int64), 0
    for m, need in NEEDED.items():
        matches = matches + np.count_nonzero(left[:, done:m] == right[:, done:m], axis=1)
        done = m
        keep = matches >= need
        if not keep.all():
            alive, matches, left, right = alive[keep], matches[keep], left[keep], right[keep]
    return alive, matches


def _sketches(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, HASHES)


SIGNATURE_SCHEMA = "key long, doc_id long, n_shingles long, node long, sketch binary, bands array<long>"


def signatures(docs: DataFrame) -> DataFrame:
    """Per document: key of the row, size and hash (node) of its shingle set, sketch and band keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _factors()
        for block in blocks(batches, "text", BLOCK_BYTES // 3):
            hashes, ends = shingle_sets(block.column("text"))
            n = np.diff(ends)
            some = np.flatnonzero(n)
            nodes = np.zeros(len(n), np.uint64)
            sketch, bands = np.zeros((len(n), HASHES), np.uint8), np.zeros((len(n), BANDS), np.uint64)
            if len(some):
                starts = ends[:-1][some]
                nodes[some] = mix(np.add.reduceat(mix(hashes + np.uint64(0x5851F42D4C957F2D)), starts) + n[some].astype(np.uint64))
                low = (hashes >> np.uint64(32)).astype(np.uint32)
                full = np.empty((len(some), HASHES), np.uint32)
                for j in range(HASHES):
                    full[:, j] = np.minimum.reduceat(low * a[j] + b[j], starts)
                sketch[some] = (full & np.uint32(255)).astype(np.uint8)
                for band in range(BANDS):
                    value = np.full(len(some), band + 1, np.uint64)
                    for r in range(ROWS):
                        value = mix(value * np.uint64(0x9E3779B97F4A7C15) + full[:, band * ROWS + r])
                    bands[some, band] = value
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1) * BANDS, pa.int32()), pa.array(bands.ravel().view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [block.column("key"), block.column("doc_id"), pa.array(n, pa.int64()), pa.array(nodes.view(np.int64)),
                 pa.array([s.tobytes() for s in sketch], pa.binary()), lists],
                ["key", "doc_id", "n_shingles", "node", "sketch", "bands"])

    return docs.mapInArrow(run, SIGNATURE_SCHEMA)


def _pruned(pairs: DataFrame) -> DataFrame:
    """(a, b, matches) of the (a, b, sketch_a, sketch_b) pairs that survive the sequential test."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                alive, matches = surviving(_sketches(batch.column("sketch_a")), _sketches(batch.column("sketch_b")))
                take = pa.array(alive)
                yield pa.RecordBatch.from_arrays([batch.column("a").take(take), batch.column("b").take(take), pa.array(matches)], ["a", "b", "matches"])

    return pairs.mapInArrow(run, "a long, b long, matches long")


def _with_sketches(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    sketch = classes.select("node", "sketch")
    one = pairs.join(sketch.select(F.col("node").alias("a"), F.col("sketch").alias("sketch_a")), "a")
    return one.join(sketch.select(F.col("node").alias("b"), F.col("sketch").alias("sketch_b")), "b").select("a", "b", "sketch_a", "sketch_b")


def _linked(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b) of the pairs whose full shingle sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(iter([batch]), "text_a", BLOCK_BYTES // 3):
                left, la = shingle_sets(block.column("text_a"))
                right, ra = shingle_sets(block.column("text_b"))
                good = []
                for i in range(block.num_rows):
                    x, y = left[la[i]:la[i + 1]], right[ra[i]:ra[i + 1]]
                    shared = len(np.intersect1d(x, y, assume_unique=True))
                    if 100 * shared >= LINK_PERCENT * (len(x) + len(y) - shared):
                        good.append(i)
                take = pa.array(good, pa.int64())
                yield pa.RecordBatch.from_arrays([block.column("a").take(take), block.column("b").take(take)], ["a", "b"])

    one = pairs.select("a", "b").join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    both = one.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(run, "a long, b long")


def _cut(members: DataFrame, parts: Column, extra: list[str]) -> DataFrame:
    """Every two parts of a group as a block (band, i, j); rows of one part meet in the block i = j only."""
    cut = members.withColumn("parts", parts.cast("int")).withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    columns = ["part", "node", "root", "size", "sketch", "bands", *extra]
    cut = cut.select("band", other, *columns).select("band", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), *columns)
    return cut.repartition("band", "i", "j").sortWithinPartitions("band", "i", "j", "node")


def _by_blocks(batches: Iterator[pa.RecordBatch], compare: Callable[[pa.Table], pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``compare`` of tables of whole blocks, as many as have come."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        same = np.ones(held.num_rows, bool)
        for c in ("band", "i", "j"):
            same &= held.column(c).to_numpy() == held.column(c)[-1].as_py()
        whole = int(np.argmax(same))  # rows of the last block are contiguous
        if whole:
            yield compare(held.slice(0, whole))
            held = held.slice(whole)
    if held is not None and held.num_rows:
        yield compare(held)


def _candidates(rows: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(left, right, matches) of the row pairs of different components that survive the test.

    Rows d apart are compared for all blocks at once, so small groups cost no call of their own.
    A pair counts in the first band that it shares only, and sets whose sizes differ too much cannot be linked.
    """
    band, i, j, part, node, root, size = (rows.column(c).to_numpy() for c in ("band", "i", "j", "part", "node", "root", "size"))
    sketch = _sketches(rows.column("sketch").combine_chunks())
    bands = rows.column("bands").combine_chunks().flatten().to_numpy().reshape(-1, BANDS)
    group = np.cumsum(np.concatenate([[True], (band[1:] != band[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])]))
    at, d = np.arange(len(node)), 1
    while len(at):
        at = at[at + d < len(node)]
        at = at[group[at] == group[at + d]]
        close = 100 * np.minimum(size[at], size[at + d]) >= LINK_PERCENT * np.maximum(size[at], size[at + d])
        apart = (part[at] != part[at + d]) | (i[at] == j[at])
        pairs = at[(root[at] != root[at + d]) & (node[at] != node[at + d]) & close & apart]
        for s in range(0, len(pairs), 1 << 15):
            p = pairs[s:s + (1 << 15)]
            first = (bands[p] == bands[p + d]).argmax(1)
            p = p[bands[p, first] == band[p]]
            alive, matches = surviving(sketch[p], sketch[p + d])
            if len(alive):
                yield p[alive], p[alive] + d, matches
        d += 1


def _likely_pairs(members: DataFrame) -> DataFrame:
    """(a, b) of different components within each band group: the PARTNERS likeliest of either end in a block.

    ``members``: band, node, root, size, sketch, bands, n (members of the group).
    """

    def likeliest(left: np.ndarray, right: np.ndarray, matches: np.ndarray) -> np.ndarray:
        """Positions of the pairs that are among the best of one of their ends."""
        if not len(left):
            return np.arange(0)
        chosen = []
        for own in (left, right):
            order = np.lexsort((-matches, own))
            first = np.concatenate([[True], own[order][1:] != own[order][:-1]])
            place = np.arange(len(order)) - np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))
            chosen.append(order[place < PARTNERS])
        return np.unique(np.concatenate(chosen))

    def compare(rows: pa.Table) -> pa.RecordBatch:
        node = rows.column("node").to_numpy()
        held, count = [(np.empty(0, np.int64),) * 3], 0
        for found in _candidates(rows):
            held.append(found)
            count += len(found[0])
            if count > 1 << 18:  # keep no more than what may still be among the best
                left, right, matches = (np.concatenate([h[k] for h in held]) for k in range(3))
                best = likeliest(left, right, matches)
                held, count = [(left[best], right[best], matches[best])], 0
        left, right, matches = (np.concatenate([h[k] for h in held]) for k in range(3))
        best = likeliest(left, right, matches)
        a, b = node[left[best]], node[right[best]]
        return pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], ["a", "b"])

    return _cut(members, F.ceil(F.col("n") / BLOCK_MEMBERS), []).mapInArrow(lambda batches: _by_blocks(batches, compare), "a long, b long")


def _shared(keys: np.ndarray, codes: np.ndarray, ends: np.ndarray, size: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Intersection sizes of the sets of row pairs; ``keys`` are row * size + code of all rows, in order."""
    out = np.zeros(len(left), np.int64)
    lengths = np.diff(ends)[right]
    cuts = [0, *(np.flatnonzero(np.diff(np.cumsum(lengths) // LOOKUPS)) + 1).tolist(), len(left)]
    for a, z in zip(cuts[:-1], cuts[1:]):
        if a == z:
            continue
        asked = codes[gather(ends[right[a:z]], lengths[a:z])] + np.repeat(left[a:z] * size, lengths[a:z])
        found = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
        out[a:z] = np.add.reduceat((keys[found] == asked).astype(np.int64), np.cumsum(lengths[a:z]) - lengths[a:z])
    return out


def _joining_links(members: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b): confirmed links that join components, for every pair of different components within the band groups.

    Each block carries its members' full shingle sets, so that survivors of the test are confirmed in place. Pairs
    that the block's links have already joined are passed over; a block yields fewer links than it has members.
    """

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", BLOCK_BYTES // 3):
            hashes, ends = shingle_sets(block.column("text"))
            held = [hashes[a:z].tobytes() for a, z in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays([block.column("node"), pa.array(held, pa.binary())], ["node", "shingles"])

    def compare(rows: pa.Table) -> pa.RecordBatch:
        node, root = rows.column("node").to_numpy(), rows.column("root").to_pylist()
        held = rows.column("shingles").to_pylist()
        ends = np.concatenate([[0], np.cumsum([len(h) // 8 for h in held])])
        size, lengths = None, np.diff(ends)
        joined: dict[int, int] = {}

        def find(x: int) -> int:
            while (up := joined.get(x, x)) != x:
                joined[x] = joined.get(up, up)
                x = up
            return x

        links = []
        for left, right, _ in _candidates(rows):
            apart = np.fromiter((find(root[x]) != find(root[y]) for x, y in zip(left.tolist(), right.tolist())), bool, len(left))
            left, right = left[apart], right[apart]
            if not len(left):
                continue
            if size is None:  # most blocks have no survivor and need no codes
                universe, codes = np.unique(np.frombuffer(b"".join(held), np.uint64), return_inverse=True)
                size = len(universe)
                keys = codes + np.repeat(np.arange(len(held)) * size, lengths)
            both = _shared(keys, codes, ends, size, left, right)
            good = 100 * both >= LINK_PERCENT * (lengths[left] + lengths[right] - both)
            for x, y in zip(left[good].tolist(), right[good].tolist()):
                p, q = find(root[x]), find(root[y])
                if p != q:
                    joined[p] = q
                    links.append((int(node[x]), int(node[y])))
        a, b = zip(*links) if links else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    # Sets travel only with members that a test has left a partner.
    contested = durable(_contested(members).distinct())
    if contested.isEmpty():
        return members.sparkSession.createDataFrame([], "a long, b long")
    held = durable(members.join(contested, "node"))
    sizes = held.groupBy("band").agg((F.sum("size") * 8).alias("bytes"))
    wanted = durable(texts.join(contested, "node", "left_semi").mapInArrow(sets, "node long, shingles binary"))
    parts = F.greatest(F.ceil(F.col("n") / BLOCK_MEMBERS), F.ceil(F.col("bytes") / BLOCK_SETS))
    sized = held.join(sizes, "band")
    rows = sized.agg(F.sum(parts)).first()[0] or 0
    cut = in_few_tasks(_cut(sized.join(wanted, "node"), parts, ["shingles"]), rows, TASK_MEMBERS)
    return cut.mapInArrow(lambda batches: _by_blocks(batches, compare), "a long, b long")


def _contested(members: DataFrame) -> DataFrame:
    """(node) of the members with a partner of another component that survives the test, once a block."""

    def compare(rows: pa.Table) -> pa.RecordBatch:
        node, some = rows.column("node").to_numpy(), np.zeros(rows.num_rows, bool)
        for left, right, _ in _candidates(rows):
            some[left] = some[right] = True
        return pa.RecordBatch.from_arrays([pa.array(np.unique(node[some]))], ["node"])

    parts = F.ceil(F.col("n") / BLOCK_MEMBERS)
    cut = in_few_tasks(_cut(members, parts, []), members.agg(F.sum(parts)).first()[0] or 0, TASK_MEMBERS)
    return cut.mapInArrow(lambda batches: _by_blocks(batches, compare), "node long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """key, doc_id, n_shingles, component_id and kept of every document.

    Texts without words (null and empty ones too) have no shingles and stay
    alone. Rows with equal ids are documents of their own; equal rows share a key.
    Null ids never name a component unless it has no other. Extra columns are
    ignored; an empty table gives no rows. A pair at the threshold is missed with
    probability (1 - 0.75 ** ROWS) ** BANDS (5e-6) by the bands and about MISS a look by the test.
    """
    return _rooted_duplicates(docs).drop("root")


def _rooted_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``near_duplicates`` with the root of their component, a node (null without words): two components may carry one id."""
    rows = docs.select(row_key("doc_id", "text").alias("key"), F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    signed = durable(signatures(rows))
    some = signed.where("n_shingles > 0")
    classes = durable(some.groupBy("node").agg(F.min("doc_id").alias("first_id"), F.min("key").alias("key"), F.max("n_shingles").alias("size"),
                                               F.first("sketch").alias("sketch"), F.first("bands").alias("bands")))
    every = classes.select("node", F.explode("bands").alias("band"))
    # What joins by a possibly hot key is written first, so that Spark can split the key's rows.
    groups = durable(in_few_tasks(every.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), BANDS * classes.count()))
    members = durable(every.join(groups, "band"))
    narrow = members.count()

    # Every class meets the busiest class of its band groups, which in a group of edited copies is nearest to all.
    busy = members.groupBy("node").agg(F.sum("n").alias("busy"))
    hubs = durable(in_few_tasks(members.join(busy, "node").groupBy("band").agg(F.max(F.struct("busy", "node")).getField("node").alias("hub")), narrow))
    met = members.join(hubs, "band").where("node <> hub").select("node", "hub").distinct()
    sketched = _pruned(_with_sketches(met.select(F.col("node").alias("a"), F.col("hub").alias("b")), classes))
    first = Window.partitionBy("a").orderBy(F.desc("matches"), "b")
    chosen = sketched.withColumn("place", F.row_number().over(first)).where("place = 1")
    tried = durable(in_few_tasks(chosen.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), narrow))

    wanted = members.select("node").distinct()
    texts = durable(rows.join(classes.select("key", "node").join(wanted, "node"), "key").groupBy("node").agg(F.first("text").alias("text")))
    roots = components(durable(_linked(tried, texts)))
    # Pairs of different components within the band groups: the likeliest first, then all that are left.
    likely = _likely_pairs(_mixed_groups(members, roots, classes)).distinct()
    batch = durable(in_few_tasks(likely.join(tried, ["a", "b"], "left_anti"), narrow))
    if not batch.isEmpty():
        roots = components(_joined(roots, durable(_linked(batch, texts))))
    mixed = durable(_mixed_groups(members, roots, classes))
    if not mixed.isEmpty():
        last = durable(_joining_links(mixed, texts))
        if not last.isEmpty():
            roots = components(_joined(roots, last))
    rooted = classes.select("node", "first_id").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = rooted.join(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), "root").select("node", "root", "component_id")
    grouped = some.select("key", "doc_id", "n_shingles", "node").join(named, "node").drop("node")
    nothing = F.lit(None).cast("long")
    alone = signed.where("n_shingles = 0").select("key", "doc_id", "n_shingles", nothing.alias("root"), F.col("doc_id").alias("component_id"))
    return grouped.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """(a, b): new links and, for those before them, what they have joined: an edge from each node to its root."""
    return roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(links)


def _mixed_groups(members: DataFrame, roots: DataFrame, classes: DataFrame) -> DataFrame:
    """band, node, root, size, sketch, bands and n of the band groups that hold more than one component."""
    rooted = durable(members.select("band", "node", "n").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
    several = rooted.groupBy("band").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("band")
    several = durable(in_few_tasks(several, rooted.count()))
    return rooted.join(several, "band").join(classes.select("node", "size", "sketch", "bands"), "node")


def without_near_duplicates(docs: DataFrame) -> DataFrame:
    """One row of every component: that of its least id, null ids last, and of its smallest key.

    Rows without words are near nothing and all stay, equal ones too.
    """
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "key")
    found = _rooted_duplicates(docs).where("root is not null")
    first = found.groupBy("root").agg(F.min(order).getField("key").alias("__key")).select("__key")
    worded = text_or_empty().rlike(WORD)
    keyed = docs.where(worded).withColumn("__key", row_key("doc_id", "text")).join(first, "__key")
    return keyed.dropDuplicates(["__key"]).drop("__key").unionByName(docs.where(~worded))
