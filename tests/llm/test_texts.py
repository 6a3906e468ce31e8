"""Fingerprints, near duplicates, repeats and languages."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from genolith.llm import fingerprints, langid, neardup, repeats
from genolith.llm.common import shingle_hashes, word_hashes, words_of
from genolith.operators import graph
from tests.llm.brute import jaccard, near_components, shingles, without_repeats, words


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aB \t\n\x0b é", max_size=30), min_size=1, max_size=8))
def test_words_and_shingles_of_a_block(texts):
    found = words_of(pa.array(texts))
    held = found.dictionary.to_pylist()
    for d, t in enumerate(texts):
        assert [held[c] for c in found.codes[found.starts[d]:found.starts[d + 1]]] == words(t)
    hashes, starts = shingle_hashes(found)
    same = {}
    for d, t in enumerate(texts):
        own = frozenset(hashes[starts[d]:starts[d + 1]].tolist())
        assert len(own) == len(shingles(t))
        assert same.setdefault(shingles(t), own) == own


def test_word_hashes_do_not_depend_on_the_block():
    long = "y" * 90
    a = word_hashes(pa.array(["b", "abc", long, "é" * 5]))
    b = word_hashes(pa.array([long, "zzz", "abc", "é" * 5, "b", "x" * 200]))
    assert a.tolist() == b[[4, 2, 0, 3]].tolist() and len(set(b.tolist())) == 6


# -------------------------------------------------------------- fingerprints


def test_fingerprints_of_documents(docs):
    got = {r["doc_id"]: r for r in fingerprints.fingerprint_documents(docs).collect()}
    rows = sorted(docs.select("doc_id", "text").collect(), reverse=True)
    errors = []
    for i, (doc_id, text) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        edited = text[: len(text) - len(text) // 2] + after[: len(text) // 2]
        r = got[doc_id]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert (r["fingerprint"] == r["edited_fingerprint"]) == (text == edited)
        errors += [abs(r["near_edited"] - jaccard(text, edited)), abs(r["near_next"] - jaccard(text, after))]
    assert len(got) == len(rows) and max(errors) < 0.15 and np.mean(errors) < 0.03


def test_fingerprints_of_odd_rows(odd, empty):
    rows = fingerprints.fingerprint_documents(odd).collect()
    assert len(rows) == odd.count() and fingerprints.fingerprint_documents(empty).count() == 0
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[3]["fingerprint"] == by_id[4]["fingerprint"] == by_id[5]["fingerprint"] == ""
    assert by_id[0]["fingerprint"] == by_id[1]["fingerprint"] and len(by_id[0]["fingerprint"]) == 512
    assert by_id[None]["near_next"] is None and by_id[4]["near_next"] == 1.0 and by_id[6]["near_next"] == 0.0


def test_sparse_fingerprints_are_unbiased(spark):
    """Few shingles, so nearly all bins are borrowed."""
    rng = np.random.default_rng(5)
    pairs = []
    for k in range(150):
        a = [f"q{k}_{x}" for x in rng.integers(0, 10**6, 40)]
        pairs.append((" ".join(a), " ".join(a[:22] + [f"z{k}_{x}" for x in range(18)])))
    frame = spark.createDataFrame(pairs, "a string, b string")
    found = [r[0] for r in frame.select(fingerprints.likeness(fingerprints.sketch(F.col("a")), fingerprints.sketch(F.col("b")))).collect()]
    assert abs(np.mean(found) - np.mean([jaccard(a, b) for a, b in pairs])) < 0.02


# ------------------------------------------------------------ near duplicates


def test_near_duplicates_against_brute_force(docs):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    want, sizes = near_components(rows)
    got = {r["doc_id"]: r for r in neardup.near_duplicates(docs).collect()}
    for (doc_id, _), component, n in zip(rows, want, sizes):
        assert (got[doc_id]["component_id"], got[doc_id]["n_shingles"], got[doc_id]["kept"]) == (component, n, component == doc_id)


def test_chain_of_near_copies_is_one_component(spark):
    """Neighbours are linked, the ends are not: only the chain joins them."""
    text = [f"t{i}" for i in range(200)]
    chain = []
    for i in range(40):
        chain.append((100 - i, " ".join(text)))
        text[i * 5] = f"changed{i}"
    others = [(200 + i, " ".join(f"o{i}_{j}" for j in range(60))) for i in range(20)]
    frame = spark.createDataFrame(chain + others, "doc_id long, text string")
    want, _ = near_components(chain + others)
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(frame).collect()}
    assert [got[d] for d, _ in chain + others] == want and len(set(want)) == 21


def test_near_duplicates_of_odd_rows(odd, empty):
    rows = neardup.near_duplicates(odd).collect()
    assert len(rows) == odd.count() and neardup.near_duplicates(empty).count() == 0
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[1]["component_id"] == by_id[2]["component_id"] == 0 and by_id[3]["n_shingles"] == 0 and by_id[3]["kept"]
    assert by_id[10]["component_id"] == 9 and by_id[None]["component_id"] is None
    kept = neardup.without_near_duplicates(odd)
    assert kept.columns == odd.columns
    ids = sorted(r[0] if r[0] is not None else -1 for r in kept.select("doc_id").collect())
    assert ids == [-1, 0, 3, 4, 5, 6, 7, 8, 9, 12]


def test_components_that_share_an_id_or_have_none_keep_a_row_each(spark):
    text = lambda w, n=40: " ".join(f"{w}{i}" for i in range(n))
    rows = [(None, text("a"), "s"), (None, text("b"), "s"), (None, text("b") + " more", "s"), (7, text("c"), "s"), (7, text("d"), "s"), (8, text("d"), "s"),
            (None, text("e"), "s"), (9, text("e"), "s"), (3, " ", "x"), (3, " ", "y"), (3, " ", "y"), (None, None, "x"), (None, None, "y"), (None, "", "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = [tuple(r) for r in neardup.without_near_duplicates(frame).collect()]
    of_b = [r for r in kept if r[1] and r[1].startswith("b0")]
    assert len(of_b) == 1 and of_b[0] in rows
    assert sorted(map(repr, [r for r in kept if r not in of_b])) == sorted(map(repr, [rows[0], rows[3], rows[4], rows[7], *rows[8:]]))


def test_blocks_larger_than_a_group_find_the_same_pairs(spark, monkeypatch):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 256, (12, neardup.HASHES), dtype=np.uint8)
    rows = []
    for i in range(60):
        s = base[i % 12].copy()
        s[rng.integers(0, neardup.HASHES, 8)] ^= 1
        rows.append((i % 2, i, i, 50, s.tobytes(), [i % 2] * neardup.BANDS, 30))
    frame = spark.createDataFrame(rows, "band long, node long, root long, size long, sketch binary, bands array<long>, n long")
    monkeypatch.setattr(neardup, "PARTNERS", 60)
    want = {(r["a"], r["b"]) for r in neardup._likely_pairs(frame).collect()}
    monkeypatch.setattr(neardup, "BLOCK_MEMBERS", 7)
    assert {(r["a"], r["b"]) for r in neardup._likely_pairs(frame).collect()} == want and len(want) > 50


def test_a_group_near_the_threshold(spark, monkeypatch):
    """Hundreds of texts 60 to 85 % alike: brute-force components, in whole blocks and in small ones, with few rows."""
    rng = np.random.default_rng(11)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(500):
        words = list(base)
        for place in rng.choice(150, int(rng.integers(1, 8)), replace=False):
            words[place] = f"x{rng.integers(0, 400)}"
        rows.append((i, " ".join(words)))
    want, _ = near_components(rows)
    assert 20 < len(set(want)) < 450
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    counted = []
    joining = neardup._joining_links
    monkeypatch.setattr(neardup, "_joining_links", lambda m, t: counted.append(neardup.durable(joining(m, t))) or counted[-1])
    for members, sets in ((1024, 8 << 20), (60, 1 << 16)):
        monkeypatch.setattr(neardup, "BLOCK_MEMBERS", members)
        monkeypatch.setattr(neardup, "BLOCK_SETS", sets)
        got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(frame).collect()}
        assert [got[i] for i in range(500)] == want
    assert counted and all(c.groupBy("a", "b").count().count() < 500 * 32 for c in counted)


def test_shared_counts(monkeypatch):
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 90, rng.integers(0, 40))) for _ in range(30)]
    ends, codes = np.concatenate([[0], np.cumsum(list(map(len, sets)))]), np.concatenate(sets)
    left, right = rng.integers(0, 30, 200), rng.integers(0, 30, 200)
    some = np.array([len(sets[r]) > 0 for r in right])
    left, right = left[some], right[some]
    keys = codes + np.repeat(np.arange(30) * 90, np.diff(ends))
    for lookups in (1, 50, 1 << 21):
        monkeypatch.setattr(neardup, "LOOKUPS", lookups)
        assert neardup._shared(keys, codes, ends, 90, left, right).tolist() == [len(np.intersect1d(sets[a], sets[b])) for a, b in zip(left, right)]


def test_sequential_test_keeps_similar_pairs():
    rng = np.random.default_rng(0)
    left = rng.integers(0, 256, (4000, neardup.HASHES), dtype=np.uint8)
    right = np.where(rng.random(left.shape) < 0.78, left, rng.integers(0, 256, left.shape, dtype=np.uint8)).astype(np.uint8)
    far = np.where(rng.random(left.shape) < 0.3, left, rng.integers(0, 256, left.shape, dtype=np.uint8)).astype(np.uint8)
    assert len(neardup.surviving(left, right)[0]) == 4000 and len(neardup.surviving(left, far)[0]) < 10


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1001 + i) for i in range(50)] + [(5, 5)]
    got = dict(map(tuple, graph.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert all(got[i] == 0 for i in range(301)) and all(got[1000 + i] == 1000 for i in range(51)) and len(got) == 352


def test_rounds_over_a_small_graph_take_few_tasks(spark, monkeypatch):
    """Many shuffle partitions do not make a task and a file each for a few edges."""
    tasks = []
    write = graph.durable
    monkeypatch.setattr(graph, "durable", lambda df: tasks.append(df.rdd.getNumPartitions()) or write(df))
    settings = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        edges = spark.createDataFrame([(i, i + 1) for i in range(30)], "a long, b long")
        assert {r["root"] for r in graph.components(edges).collect()} == {0}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(tasks) > 3 and max(tasks[1:]) <= spark.sparkContext.defaultParallelism


def test_new_links_join_what_is_joined(spark):
    """Components of stars and new links are those of all links."""
    old = [(2, 1), (3, 2), (9, 8), (7, 8), (20, 21)]
    new = [(3, 7), (30, 31)]
    frame = lambda rows: spark.createDataFrame(rows, "a long, b long")
    got = sorted(map(tuple, graph.components(neardup._joined(graph.components(frame(old)), frame(new))).collect()))
    assert got == sorted(map(tuple, graph.components(frame(old + new)).collect())) and dict(got)[9] == 1


# -------------------------------------------------------------------- repeats


@settings(max_examples=120, deadline=None)
@given(st.lists(st.binary(min_size=0, max_size=50).map(lambda b: bytes(x % 3 for x in b)), min_size=1, max_size=6), st.sampled_from([8, 11, 16]))
def test_suffix_arrays_find_repeated_windows(pieces, length):
    pieces = [p for p in pieces if len(p) >= length]
    if not pieces:
        return
    windows = np.array([len(p) - length + 1 for p in pieces])
    piece, window = repeats.repeated_windows(pieces, windows, length)
    seen = {}
    for i, p in enumerate(pieces):
        for w in range(windows[i]):
            seen.setdefault(p[w:w + length], []).append((i, w))
    assert list(zip(piece.tolist(), window.tolist())) == sorted(x for v in seen.values() if len(v) > 1 for x in v)


def test_suffix_order_sorts():
    rng = np.random.default_rng(2)
    text = np.concatenate([rng.integers(1, 4, 400).astype(np.uint8), np.full(30, 2, np.uint8), rng.integers(0, 256, 200).astype(np.uint8), np.zeros(64, np.uint8)])
    wanted = np.zeros(len(text), bool)
    wanted[:630] = True
    data = text.tobytes()
    order = repeats.suffix_order(text, wanted, 48)
    assert [data[i:i + 48] for i in order] == sorted(data[i:i + 48] for i in range(630))


@pytest.mark.parametrize("most", [repeats.MOST_STRETCHES, 1])
def test_removed_repeats_against_brute_force(spark, docs, most, monkeypatch):
    """With ``most`` 1 all open anchors go window by window."""
    monkeypatch.setattr(repeats.repeated_spans, "__defaults__", (most,))
    rows = docs.select("doc_id", "text").orderBy("doc_id").collect()
    want = without_repeats([r["text"].encode() for r in rows], repeats.LENGTH)
    got = {r["doc_id"]: r for r in repeats.remove_repeats(docs, with_text=True).collect()}
    for r, (n, removed, spans, kept) in zip(rows, want):
        g = got[r["doc_id"]]
        assert (g["n_bytes"], g["n_removed"], g["n_spans"], bytes(g["kept"])) == (n, removed, spans, kept)
        assert g["kept_sha256"] == hashlib.sha256(kept).hexdigest()


def test_repeats_within_one_text_and_over_slices(spark, monkeypatch):
    monkeypatch.setattr(repeats, "SLICE_BYTES", 1000)
    rng = np.random.default_rng(4)
    letters = lambda n: "".join(map(chr, rng.integers(97, 123, n)))
    passage = letters(230)
    texts = [letters(1500) + passage + letters(900) + passage[5:] + letters(40), "a" * 700, letters(199), passage[:200], passage[1:200], letters(3000)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in repeats.remove_repeats(frame, with_text=True).collect()}
    for i, (n, removed, spans, kept) in enumerate(without_repeats([t.encode() for t in texts], repeats.LENGTH)):
        assert (got[i]["n_removed"], got[i]["n_spans"], bytes(got[i]["kept"])) == (removed, spans, kept)


def test_repeats_of_odd_rows(odd, empty):
    rows = odd.select("doc_id", "text").collect()
    want = sorted(x[:3] for x in without_repeats([(r["text"] or "").encode() for r in rows if r["doc_id"] != 6], repeats.LENGTH))
    got = repeats.remove_repeats(odd).collect()
    assert sorted((r["n_bytes"], r["n_removed"], r["n_spans"]) for r in got if r["doc_id"] != 6) == want
    assert repeats.remove_repeats(empty).count() == 0


# ------------------------------------------------------------------ languages


def test_languages_of_documents(docs):
    got = {r["doc_id"]: r for r in langid.identify_documents(docs).collect()}
    labels = {r["doc_id"]: r["lang"] for r in docs.collect()}
    assert np.mean([got[d]["language"] == lang for d, lang in labels.items()]) > 0.98
    assert all(r["accepted"] for r in got.values())


def test_evidence_decides_where_the_text_does_not(spark, docs):
    model = langid.train(docs)
    rows = [(i, "1 2 3 4 x", None, None, "host-de", "d") for i in range(2)]
    text = {r["lang"]: r["text"] for r in docs.orderBy("doc_id").collect()}
    rows += [(10 + i, text["de"], None, None, "host-de", "d") for i in range(40)]
    rows += [(100, "a", "fr", None, None, None), (101, text["en"], "fr", None, None, None), (102, "", "en", None, None, None)]
    rows += [(200 + i, text["es"], "es", "es", None, None) for i in range(30)] + [(300, "b", None, "es", None, None)]
    rows += [(400 + i, text["en"], None, "com", None, None) for i in range(30)]
    frame = spark.createDataFrame(rows, "key long, text string, declared string, suffix string, host string, domain string")
    got = {r["key"]: r for r in langid.identify(frame, model, ["key"]).collect()}
    assert got[0]["language"] == "de" and got[101]["language"] == "en" and got[300]["language"] == "es"
    assert not got[102]["accepted"] and got[101]["accepted"]


def test_every_label_is_a_language(spark):
    """70 languages of their own syllables; the last are the rarest."""
    rng = np.random.default_rng(5)
    rows = []
    for c in range(70):
        syllables = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 4)) for _ in range(8)]
        for d in range(4 if c < 64 else 3):
            rows.append((len(rows), " ".join(rng.choice(syllables, 60)), f"{chr(97 + c // 26)}{chr(97 + c % 26)}", "s"))
    got = {r["doc_id"]: r for r in langid.identify_documents(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert all((got[d]["language"], got[d]["text_language"], got[d]["accepted"]) == (lang, lang, True) for d, _, lang, _ in rows)


def test_languages_of_odd_rows(odd, empty):
    rows = langid.identify_documents(odd).collect()
    assert len(rows) == odd.count() and langid.identify_documents(empty).count() == 0
    accepted = {r["doc_id"]: r["accepted"] for r in rows}
    assert not accepted[3] and not accepted[4] and not accepted[5] and not accepted[12] and accepted[0]
    kept = langid.accepted_documents(odd)
    assert kept.columns == odd.columns and kept.where("doc_id = 1").count() == 2


def test_page_captures(spark):
    page = '<!DOCTYPE html><html lang="en-US"><head><script>var x = "<b>";</script></head><body><p>Some <b>words</b></p></body></html>'
    frame = spark.createDataFrame([(1, "https://user@www.Example.co.uk:80/a?b", page), (2, None, None), (3, "nonsense", "plain")], "page_id long, url string, html string")
    got = {r["page_id"]: r for r in langid.page_captures(frame).collect()}
    assert (got[1]["declared"], got[1]["suffix"], got[1]["host"], got[1]["domain"]) == ("en", "uk", "www.example.co.uk", "co.uk")
    assert got[1]["text"].split() == ["Some", "words"] and got[2]["host"] is None and got[3]["text"] == "plain"
