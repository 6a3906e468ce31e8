"""Secret scanning with a random forest against false positives.

Candidates are words with a long run of key-like characters and a digit, values
assigned to credential names, lines of private-key blocks, and passwords in connection strings. Each is described by its length, character
transitions, coverage by dictionary words, the names before it and its neighbouring
words; a random forest trained on labelled findings says which are secrets.
DataFrame functions and Spark's own forest only.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genolith.llm.common import GAP, row_key, text_or_empty
from genolith.session import durable

#: Runs of key-like characters of this length, with a digit among them.
LONG_RUN = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])[A-Za-z0-9+/_-]{16,}={0,2}"
NAMES = r"(?:secret|token|passw(?:or)?d|passwd|pwd|api[ _-]?key|access[ _-]?key|private[ _-]?key|auth|credential|bearer)"
ASSIGNED = rf"(?i)\b[\w.-]*{NAMES}[\w.-]*[\"']?\s*(?:=|:|:=|=>)\s*[\"']?[^\s\"']{{8,}}"
NAME_WORD = rf"(?i){NAMES}"
#: A name of two words right before the value.
TWO_WORD_NAME = r"(?i)\b(?:api|access|private|secret)\s+key[\"']?\s*(?:[=:]+>?)?\s*\S+$"
#: The lines of private-key blocks, cut short or not, and the password of user:password@host.
KEY_BLOCK = r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----([^-]*)"
CONNECTION = r"[A-Za-z][A-Za-z0-9+.-]*://[^\s/:@]*:([^\s/@]{8,})@"
PLACEHOLDER = r"^[$<{%*\[]"
#: Published shapes of keys; they count as findings when training data are made.
KNOWN_SHAPE = r"^(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|AIza[0-9A-Za-z_-]{35}|sk-[A-Za-z0-9_-]{20,}|eyJ[A-Za-z0-9_-]{10,}.*)$"
EDGES = r"^[\"'`(<\[{,;:]+|[\"'`)>\]},;:.!?*#%&$]+$"
#: Labelled findings that the forest is fitted on at most, half of them of each label, chosen by hash.
MOST_LABELLED = 20_000
#: A label with fewer findings than this is repeated that often, so that hardly a tree's draw misses it; weights keep its share.
REPEATS = 16
TREES, DEPTH = 20, 6
#: Documents a letter sequence must stand in to count as a dictionary word.
LEAST_WORD_COUNT = 3
LEAST_PROBABILITY = 0.5
MARK = "[SECRET]"
FEATURES = [
    "length", "letters", "digits", "uppers", "others", "kinds", "transitions", "distinct", "hexadecimal", "longest_letters", "coverage",
    "assigned", "named", "named_near", "quoted", "path_like", "url_like", "separators", "next_plain",
]

#: Those that a value has from its surroundings.
CONTEXT = ["assigned", "named", "named_near", "quoted"]


def candidates(docs: DataFrame) -> DataFrame:
    """One row per candidate word: key, doc_id, source, place (word number), finding (the bare value), its neighbours, and role ('block', 'connection' or null).

    Only documents in which a pattern matches are cut into words. A text without
    a candidate gives no row.
    """
    rows = docs.select(row_key("doc_id", "text").alias("key"), F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), text_or_empty().alias("text"))
    rows = rows.where(F.col("text").rlike(LONG_RUN) | F.col("text").rlike(ASSIGNED) | F.col("text").rlike(KEY_BLOCK) | F.col("text").rlike(CONNECTION))
    # A line of a key block is a word of 8 base64 characters or more between its marks.
    lines = F.filter(F.split(F.array_join(F.regexp_extract_all("text", F.lit(KEY_BLOCK), F.lit(1)), " "), GAP), lambda w: w.rlike(r"^[A-Za-z0-9+/=]{8,}$"))
    words = rows.select("key", "doc_id", "source", F.split("text", GAP).alias("words"), lines.alias("lines"))
    bare = lambda w: F.regexp_replace(F.regexp_replace(w, r"^[\w.-]+[\"']?(?:=|:|:=|=>)(?=[\"']?[^\s=])", ""), EDGES, "")

    def described(w: Column, i: Column, all_: Column) -> Column:
        before = F.concat_ws(" ", F.get(all_, i - 3), F.get(all_, i - 2), F.get(all_, i - 1))
        role = F.when(in_block(w), "block").when(w.rlike(CONNECTION), "connection")
        return F.struct(role.alias("role"), i.alias("place"), w.alias("word"), before.alias("before"), F.coalesce(F.get(all_, i + 1), F.lit("")).alias("after"))

    is_run = lambda w: w.rlike(LONG_RUN)
    in_block = lambda w: F.array_contains("lines", w)
    near = lambda i, all_: F.concat_ws(" ", F.get(all_, i - 3), F.get(all_, i - 2), F.get(all_, i - 1))
    is_value = lambda w, i, all_: F.concat_ws(" ", near(i, all_), w).rlike(rf"{ASSIGNED}$") & (F.length(w) >= 8)
    picked = F.filter(
        F.element_at(F.transform(F.array("words"), lambda a: F.transform(a, lambda w, i: F.when(is_run(w) | is_value(w, i, a) | in_block(w) | w.rlike(CONNECTION), described(w, i, a)))), 1),
        lambda s: s.isNotNull())
    flat = words.select("key", "doc_id", "source", F.explode(picked).alias("c")).select("key", "doc_id", "source", "c.*")
    finding = F.when(F.col("role") == "connection", F.regexp_extract("word", CONNECTION, 1)).when(F.col("role") == "block", F.col("word")).otherwise(bare(F.col("word")))
    return flat.withColumn("finding", finding).where(F.length("finding") >= 8)


def _share(text: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(text, pattern, "")) / F.greatest(F.length(text), F.lit(1))


def dictionary(docs: DataFrame) -> DataFrame:
    """word: lower-case letter sequences of 3 to 15 that the corpus holds often enough; counted over all texts."""
    plain = F.explode(F.regexp_extract_all(F.lower(text_or_empty()), F.lit(r"(?<![a-z0-9])[a-z]{3,15}(?![a-z0-9])"), F.lit(0)))
    return docs.select(plain.alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST_WORD_COUNT).select("word")


def described(found: DataFrame, words: DataFrame) -> DataFrame:
    """The candidates with their ``FEATURES`` as doubles."""
    f = F.col("finding")
    kind = f
    for pattern, mark in (("[a-z]", "a"), ("[A-Z]", "B"), ("[0-9]", "0"), ("[^aB0]", "-")):
        kind = F.regexp_replace(kind, pattern, mark)
    parts = found.withColumn("shape", kind).withColumn("id", F.monotonically_increasing_id())
    parts = durable(parts)
    runs = parts.select("id", F.explode(F.regexp_extract_all(F.lower("finding"), F.lit("[a-z]{3,15}"), F.lit(0))).alias("word"))
    covered = runs.join(words, "word").groupBy("id").agg(F.sum(F.length("word")).alias("covered"))
    rows = parts.join(covered, "id", "left")
    # What stands in a key block or before a host's @ has its name from there, and the address around it is not its own.
    placed = F.col("role").isNotNull()
    phrase = F.concat_ws(" ", "before", "word")
    n = F.greatest(F.length("finding"), F.lit(1))
    changes = F.length(F.regexp_replace(F.col("shape"), r"(.)\1*", "x")) - 1
    values = {
        "length": n, "letters": _share(f, "[^A-Za-z]"), "digits": _share(f, "[^0-9]"), "uppers": _share(f, "[^A-Z]"), "others": _share(f, "[A-Za-z0-9]"),
        "kinds": F.size(F.array_distinct(F.split("shape", ""))), "transitions": changes / n, "distinct": F.size(F.array_distinct(F.split("finding", ""))) / n,
        "hexadecimal": f.rlike("^[0-9a-fA-F]+$"), "longest_letters": F.array_max(F.transform(F.split("finding", "[^A-Za-z]+"), F.length)) / n,
        "coverage": F.coalesce("covered", F.lit(0)) / n,
        "assigned": placed | phrase.rlike(r"(?:=|:)[\s\"']*\S+$"), "named": placed | phrase.rlike(TWO_WORD_NAME) | F.concat_ws(" ", F.regexp_extract("before", r"(\S+(?:\s+[=:]+>?)?)$", 1), "word").rlike(NAME_WORD),
        "named_near": F.col("before").rlike(NAME_WORD), "quoted": F.col("word").rlike("[\"'`]"), "path_like": ~placed & (f.rlike(r"/\w+/") | F.col("word").rlike(r"^\.?\.?/")),
        "url_like": ~placed & F.col("word").rlike(r"(?i)^(?:https?|ftp)://|www\."), "separators": _share(f, "[^_/=+-]"), "next_plain": F.col("after").rlike(r"^[A-Za-z,.]+$"),
    }
    return rows.select(*found.columns, *[values[c].cast("double").alias(c) for c in FEATURES])


def context_labels(features: DataFrame) -> DataFrame:
    """Labelled findings where no reviewed ones exist: label 1 or 0, and rows that neither rule decides stay out.

    Positive are keys of published shapes, mixed values in an assignment to a credential
    name, lines of key blocks, and passwords in connection strings that are no
    placeholders; negative are values of digits alone, URLs, paths, and words that
    the dictionary covers by half, where no credential name stands. Values that alternate
    like keys are no paths. Other unassigned values stay out. A key is one
    without its context too: positives come a second time without it, so that the
    forest judges bare values by themselves.
    """
    mixed = (F.col("digits") > 0.1) & (F.col("letters") > 0.1) & (F.col("coverage") < 0.5)
    placed = (F.col("role") == "block") | ((F.col("role") == "connection") & (F.col("coverage") < 0.5) & ~F.col("finding").rlike(PLACEHOLDER))
    positive = F.col("finding").rlike(KNOWN_SHAPE) | F.coalesce(placed, F.lit(False)) | (mixed & (F.col("assigned") == 1) & (F.col("named") == 1))
    path = (F.col("path_like") == 1) & ((F.col("transitions") < 0.4) | (F.col("digits") == 0))
    negative = (F.col("named") == 0) & ((F.col("letters") == 0) | (F.col("url_like") == 1) | path | (F.col("coverage") >= 0.5))
    rows = features.withColumn("label", F.when(positive, 1.0).when(negative, 0.0)).where("label is not null")
    # Passwords are told by their place alone.
    keys = rows.where((F.col("label") == 1) & mixed & (F.col("length") >= 16))
    return rows.unionByName(keys.withColumns({c: F.lit(0.0) for c in CONTEXT}))


def training_rows(labelled: DataFrame) -> DataFrame:
    """``FEATURES``, label and weight: up to half of MOST_LABELLED rows of each label, weighted to the labels' true shares."""
    counts = {r["label"]: r["count"] for r in labelled.groupBy("label").count().collect()}
    parts = []
    for label, n in sorted(counts.items()):
        most = MOST_LABELLED // 2
        copies = REPEATS if n * REPEATS < most else 1
        part = labelled.where(F.col("label") == label).orderBy(F.xxhash64("finding", "key", "place"), *FEATURES).limit(most)
        part = part.select(*FEATURES, "label", F.lit(n / min(n, most) / copies).alias("weight"))
        parts.append(part.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies)))).drop("copy"))
    rows = parts[0] if parts else labelled.select(*FEATURES, "label", F.lit(1.0).alias("weight"))
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return durable(rows)


def train_forest(labelled: DataFrame, seed: int = 7) -> RandomForestClassificationModel | float:
    """Forest over ``FEATURES`` and label of the ``training_rows``; a constant where only one label occurs among them."""
    rows = training_rows(labelled)
    seen = rows.agg(F.min("label"), F.max("label")).first()
    if seen[0] is None or seen[0] == seen[1]:
        return float(seen[0] or 0.0)
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows).select("features", "label", "weight")
    return RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=seed, subsamplingRate=0.8, weightCol="weight").fit(rows)


def judged(features: DataFrame, forest) -> DataFrame:
    """Adds probability and is_secret."""
    if isinstance(forest, float):
        out = features.withColumn("probability", F.lit(forest))
    else:
        seen = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(features)
        out = forest.transform(seen).withColumn("probability", vector_to_array("probability")[1]).drop("features", "rawPrediction", "prediction")
    return out.withColumn("is_secret", F.col("probability") >= LEAST_PROBABILITY)


def scan(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """Every candidate of every document with probability and is_secret.

    ``labelled``: reviewed findings with ``FEATURES`` and label; made from context
    if none. Null texts give no candidates, null ids and sources stay null, repeated
    rows are scanned each, extra columns are ignored, an empty table gives no rows.
    """
    features = durable(described(candidates(docs), dictionary(docs)))
    return judged(features, train_forest(context_labels(features) if labelled is None else labelled))


def redact(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """The documents with every secret replaced by ``MARK``; n_chars, if there, is counted anew where a text changes."""
    found = scan(docs, labelled).where("is_secret").groupBy(F.col("key").alias("__key")).agg(F.collect_set("finding").alias("__secrets"))
    keyed = docs.withColumn("__key", row_key("doc_id", "text")).join(found, "__key", "left")
    # Longer secrets first, so that one within another leaves nothing behind.
    ordered = F.array_sort("__secrets", lambda a, b: F.length(b) - F.length(a))
    clean = F.aggregate(ordered, F.col("text"), lambda t, s: F.replace(t, s, F.lit(MARK)))
    out = keyed.withColumn("text", F.when(F.col("__secrets").isNotNull(), clean).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("__secrets").isNotNull(), F.length("text")).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)
