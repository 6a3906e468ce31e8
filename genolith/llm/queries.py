"""The registered queries of the operators and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genolith.llm import divergence, fingerprints, langid, maxent, mixing, neardup, packing, pivots, repeats, runs, secret_scan, tokenfile, warc
from genolith.llm.common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(function):
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return register


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_secret_scan")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "place", "finding", "source", *[F.round(c, 6).alias(c) for c in secret_scan.FEATURES], "probability", "is_secret")


@query("op2_document_fingerprints")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(read(spark, sf_dir, "documents"))


WARC_SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM p WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first_id IS NULL OR page_id IS NOT DISTINCT FROM first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""


@query("op3_warc_archive", WARC_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    directory, folder = warc.archive(spark, pages)
    records = warc.read_records(warc.lookup_keys(pages, directory, folder), folder, payloads=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op4_maxent_scores")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent.score_documents(read(spark, sf_dir, "documents"))


TOP_SQL = """
WITH v AS (SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


@query("op5_pivot_search", TOP_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = pivots.PivotIndex(pivots.usable(read(spark, sf_dir, "embeddings")))
    return index.search(index.vectors.where("vec_id % 50 = 0"), 5)


@query("op8_near_duplicates")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(read(spark, sf_dir, "documents")).drop("key")


@query("op6_language_id")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = langid.identify_documents(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "language", "posterior", "text_language", F.col("accepted").alias("kept"))


@query("op6_page_languages")
def op6_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = langid.train(read(spark, sf_dir, "documents"))
    return langid.identify(langid.page_captures(read(spark, sf_dir, "pages")), model, ["page_id"])


@query("op7_repeated_passages")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(read(spark, sf_dir, "documents"))


#: Weights of the sources by code point, repeated.
MIX_WEIGHTS = [3.0, 1.0, 2.0]


@query("op9_source_mix")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read(spark, sf_dir, "documents"), MIX_WEIGHTS)
    return mixed.select("doc_id", "size", "source", "source_size", "target", "taken", "first_slot", "last_slot", "slots")


@query("op10_best_fit_packing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"), tokenizer_path())


AUDIT_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT row, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS lang_n FROM w GROUP BY 1, 2 HAVING count(DISTINCT row) >= 10),
l AS (SELECT lang, count(*) AS terms, sum(lang_n) AS lang_total FROM k GROUP BY 1),
e AS (SELECT w.lang, source, w.term, count(*) AS n FROM w JOIN k ON w.lang = k.lang AND w.term = k.term GROUP BY 1, 2, 3),
g AS (SELECT s.lang, s.source, coalesce(l.terms, 0) AS terms, coalesce(lang_total, 0) AS lang_total,
    coalesce((SELECT sum(n) FROM e WHERE e.lang = s.lang AND e.source = s.source), 0) AS total
  FROM (SELECT DISTINCT lang, source FROM d) s LEFT JOIN l ON s.lang = l.lang),
x AS (SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n, CAST(1 + CAST(1000000000 AS HUGEINT) * (coalesce(n, 0) + 2) // (total + 2 * terms) AS HUGEINT) AS p,
    CAST(1 + CAST(1000000000 AS HUGEINT) * (lang_n + 2) // (lang_total + 2 * terms) AS HUGEINT) AS q
  FROM g JOIN k ON g.lang = k.lang LEFT JOIN e ON e.lang = g.lang AND e.source = g.source AND e.term = k.term),
f AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM x a JOIN x b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value
    FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM x WHERE n > 0 AND p > q),
o AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM r)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INT) AS rank FROM o WHERE part = 'pair' OR rank <= 10
"""


@query("op11_source_divergence", AUDIT_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read(spark, sf_dir, "documents"))


@query("op12_token_files")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    directory, folder = tokenfile.write_documents(spark, read(spark, sf_dir, "documents"), tokenizer_path())
    return tokenfile.read_token_files(directory, folder)


@query("op13_periodic_runs")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.run_digests(runs.periodic_runs(read(spark, sf_dir, "documents"), plant=True))
