"""Source divergence, token files and periodic runs against plain versions."""

import hashlib
import heapq
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from genolith.llm import divergence, packing, queries, runs, tokenfile
from genolith.session import durable, scratch_table
from tests.llm.brute import LOWER, WORDS
from tests.llm.conftest import SF

# ------------------------------------------------------------- periodic runs


def brute_runs(w):
    n, out = len(w), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and w[j] == w[j + q]:
                j += 1
            size = j - i + q
            if j > i and size >= max(24, 3 * q) and not any(all(w[k] == w[k + p] for k in range(i, i + size - p)) for p in range(1, q)):
                out.append((i, size, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_document(doc_id, text):
    w = WORDS.findall(text or "")
    n = len(w)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    found = brute_runs(w)
    gone = {i for s, size, q in found for i in range(s + q, s + size)}
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2])) if found else None
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2], sha("".join(f"{s},{size},{q}\n" for s, size, q in found)),
            sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


PARTS = st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=14), st.floats(1, 8)), max_size=5)


@settings(max_examples=300, deadline=None)
@given(st.lists(PARTS, min_size=1, max_size=3))
def test_runs_equal_brute_force(documents):
    held = [np.concatenate([np.resize(root, int(len(root) * times)) for root, times in parts] or [np.empty(0, int)]) for parts in documents]
    codes, starts = np.concatenate(held).astype(np.int32), np.cumsum([0, *map(len, held)])
    got = [tuple(r) for r in runs.find_runs(codes, starts).tolist()]
    assert got == [(d, *r) for d, w in enumerate(held) for r in brute_runs(w.tolist())]


def test_long_periods_and_progressions():
    rng = np.random.default_rng(5)
    root = rng.integers(0, 9, 700)
    w = np.concatenate([rng.integers(0, 9, 333), np.resize(root, 2100), rng.integers(0, 9, 100), np.zeros(5000, int), np.resize(rng.integers(0, 2, 97), 97 * 3 + 1)])
    got = runs.find_runs(w.astype(np.int32), np.array([0, len(w)])).tolist()
    assert [r[3] for r in got if r[2] >= 290] == [700, 1, 97] and all(w[s + q:s + n].tolist() == w[s:s + n - q].tolist() for _, s, n, q in got)


def test_wavelet_tree():
    rng = np.random.default_rng(0)
    for n in (1, 2, 7, 64, 100):
        values = rng.permutation(n)
        tree = runs.WaveletTree(values)
        left = rng.integers(0, n, 200)
        right = np.minimum(left + rng.integers(1, n + 1, 200), n)
        x = rng.integers(0, n, 200)
        want = [min((v for v in values[a:z] if v > b), default=-1) for a, z, b in zip(left, right, x)]
        assert tree.successor(left, right, x).tolist() == want


def test_equally_strong_runs():
    assert runs.strongest_run(np.array([[5, 30, 3], [5, 40, 4], [9, 30, 3]])) == 0
    assert runs.strongest_run(np.array([[5, 29, 3], [7, 100, 10], [8, 50, 5]])) == 1
    assert runs.strongest_run(np.empty((0, 3), int)) is None


def repeated(odd):
    loop = odd.where("doc_id = 0").withColumn("text", F.lit("go on and on " * 40 + "stop " * 30 + "end"))
    return odd.unionByName(loop).unionByName(loop.withColumn("doc_id", F.lit(None).cast("long")))


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_run_digests(spark, docs, odd, empty):
    for rows in (docs, repeated(odd)):
        got = runs.run_digests(runs.periodic_runs(rows.repartition(3), plant=True)).select(COLUMNS).collect()
        want = [brute_document(r["doc_id"], r["text"]) for r in rows.where("length(text) < 60000 or text is null").collect()]
        whole = Counter(map(tuple, got))
        assert all(whole[k] >= n for k, n in Counter(want).items()) and len(got) == rows.count()
    assert runs.periodic_runs(empty).count() == 0


# -------------------------------------------------------------- token files


def huffman_cost(counts):
    heap = [c for c in counts if c]
    heapq.heapify(heap)
    total = 0
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        total += a + b
        heapq.heappush(heap, a + b)
    return total


def best_limited(counts, limit):
    """Least cost of prefix codes of at most ``limit`` bits, over all falling length lists that fill the code space."""
    weights = sorted((c for c in counts if c), reverse=True)
    best = [float("inf")]

    def go(i, last, room, cost):
        if cost >= best[0]:
            return
        if i == len(weights):
            if room >= 0:
                best[0] = cost
            return
        for size in range(last, limit + 1):
            if room >= (1 << (limit - size)) + (len(weights) - i - 1):
                go(i + 1, size, room - (1 << (limit - size)), cost + weights[i] * size)

    go(0, 1, 1 << limit, 0)
    return best[0]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 60), min_size=2, max_size=8), st.integers(3, 5))
def test_code_lengths_are_optimal(counts, limit):
    if np.count_nonzero(counts) < 2:
        return
    counts = np.array(counts)
    sizes = tokenfile.code_lengths(counts, limit).astype(int)
    assert (counts * sizes).sum() == best_limited(counts.tolist(), limit) and sizes.max() <= limit
    assert (tokenfile.code_lengths(counts, 20).astype(int) * counts).sum() == huffman_cost(counts.tolist())


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 400), st.integers(0, 3000), st.sampled_from([1, 3, 64]), st.integers(0, 9))
def test_ids_come_back(vocabulary, n, every, seed):
    rng = np.random.default_rng(seed)
    ids = np.minimum(rng.geometric(0.05, n) - 1, vocabulary - 1) if n else np.empty(0, int)
    book = tokenfile.Codebook(tokenfile.code_lengths(np.bincount(ids, minlength=vocabulary), 12))
    again = tokenfile.Codebook.load(book.dump())
    codes = sorted(f"{again.codes[i]:0{again.lengths[i]}b}" for i in np.flatnonzero(again.lengths))
    assert all(not b.startswith(a) for a, b in zip(codes, codes[1:]))
    lengths = np.array([n // 2, 0, n - n // 2])
    frame = tokenfile.Frame.parse(tokenfile.pack_frame([None, 4, -7], lengths, ids, book, every))
    table = again.table()
    assert frame.ids(table).tolist() == ids.tolist() and frame.doc_ids == [None, 4, -7] and frame.lengths.tolist() == lengths.tolist()
    assert frame.ids(table, n // 3, n // 2).tolist() == ids[n // 3: n // 2].tolist()


def test_token_files(spark, docs, odd, empty):
    path = queries.tokenizer_path()
    tokenizer = packing.WordTokenizer(path).exact
    for rows in (docs, odd):
        directory, folder = tokenfile.write_documents(spark, rows.repartition(3), path)
        got = sorted(tokenfile.read_token_files(directory, folder, with_ids=True).collect(), key=lambda r: r["start"])
        want = Counter((r["doc_id"], tuple([*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 1])) for r in rows.collect())
        assert Counter((r["doc_id"], tuple(r["ids"])) for r in got) == want
        at, flat = 0, []
        for r in got:
            assert r["start"] == at and r["n_tokens"] == len(r["ids"]) and r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
            at += len(r["ids"])
            flat += r["ids"]
        ids = [r["doc_id"] for r in got]
        assert ids == sorted(ids, key=lambda d: (d is not None, d or 0))
        parts = sorted(tokenfile.read_slice(directory, folder, 700, 2500).collect(), key=lambda r: r["position"])
        assert [i for r in parts for i in r["ids"]] == flat[700:2500]
    directory, folder = tokenfile.write_documents(spark, empty, path)
    assert tokenfile.read_token_files(directory, folder).count() == 0


def test_frames_of_one_file_and_many_files(spark, docs):
    path = queries.tokenizer_path()
    tokens = durable(tokenfile.token_ids(docs, path))
    book, folder = tokenfile.codebook(tokens, 49408), scratch_table(spark, "tokens")
    directory = tokenfile.write_token_files(tokens, book, 49408, folder, frame_ids=1000, every=64)
    assert directory.count() > 20
    got = tokenfile.read_token_files(directory, folder).toPandas().sort_values("start")
    assert got["doc_id"].is_monotonic_increasing and (got["start"].to_numpy()[1:] == got["n_tokens"].cumsum().to_numpy()[:-1]).all()


# --------------------------------------------------------- source divergence

TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute_audit(rows, least):
    """(lang, source, part, item, value, rank) of (text, lang, source) rows."""
    held = [((t or ""), (lang or ""), (s or "")) for t, lang, s in rows]
    counts, documents, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in held:
        groups[lang].add(source)
        found = TERM.findall(text.translate(LOWER))
        counts[lang, source].update(found)
        documents[lang].update(set(found))
    out = []
    for lang, sources in groups.items():
        kept = sorted(t for t, n in documents[lang].items() if n >= least)

        def shares(counter):
            total = sum(counter[t] for t in kept)
            return {t: 1 + 1000000000 * (counter[t] + 2) // (total + 2 * len(kept)) for t in kept}

        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(sum((counts[lang, s] for s in sources), Counter()))
        price = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            parts = {"pair": [(o, sum(price(p[s][t], p[o][t]) for t in kept)) for o in sources - {s}],
                     "term": [(t, price(p[s][t], q[t])) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]}
            for part, items in parts.items():
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, rank) for rank, (item, value) in enumerate(ranked, 1) if part == "pair" or rank <= 10]
    return sorted(out)


@pytest.mark.parametrize("least", [1, 2, 10])
def test_divergence(docs, odd, empty, least):
    for rows in (docs.unionByName(odd.select(docs.columns)), odd):
        got = divergence.audit(rows.repartition(3), least)
        assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
        assert sorted(map(tuple, got.collect())) == brute_audit([(r["text"], r["lang"], r["source"]) for r in rows.collect()], least)
    assert divergence.audit(empty, least).count() == 0


def test_terms_are_letters_and_all_beyond_ascii():
    text = "Ab1cÉé_x\x00y z\x85w´日本-K  [q]^{r}~\x7f"
    codes, doc, dictionary = divergence._terms(pa.array(["skip", text, ""])[1:])
    assert [dictionary[int(c)].as_py() for c in codes] == TERM.findall(text.translate(LOWER)) and set(doc.tolist()) == {0}


def test_products_of_many_groups_go_tile_by_tile(monkeypatch):
    rng = np.random.default_rng(3)
    share = rng.integers(1, 9, (30, 50)) * 10**8
    want = {(a, b): int(divergence.priced(share[a], share[b]).sum()) for a in range(30) for b in range(a + 1, 30)}
    for columns in (7, 20, 1024):
        monkeypatch.setattr(divergence, "TILE_COLUMNS", columns)
        parts = divergence.joint_values(np.repeat(np.arange(30), 50), share.ravel(), np.tile(np.arange(50), 30), 50)
        assert {(int(a), int(b)): int(v) for x in parts for a, b, v in zip(*x)} == want


def test_shares_of_large_counts(spark):
    row = spark.range(1).select(divergence.share(F.lit(9 * 10**15), F.lit(10**16), F.lit(10**9)).alias("p"), divergence.share(F.lit(0), F.lit(0), F.lit(0)).alias("none")).first()
    assert row["p"] == 1 + 1000000000 * (9 * 10**15 + 2) // (10**16 + 2 * 10**9) and row["none"] is None
