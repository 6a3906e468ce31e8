"""Document fingerprints: one-permutation MinHash, densified and packed.

Every word shingle is hashed once. The high bits choose one of ``BINS`` bins, the
least hash of a bin is its value. An empty bin borrows from a bin drawn by
hashes of (bin, attempt) until one is filled, the same draws for every document.
The low ``BITS`` bits of the values are packed into longs. Likeness counts agreeing
bins and takes away the agreements that unequal values give by chance. All steps
are DataFrame functions over one row; nothing is exploded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from genolith.llm.common import GAP, ascii_lower, text_or_empty
from genolith.session import durable

BINS, BITS = 256, 8
SHINGLE = 5
#: Draws before a bin takes the filled bin with the least hash of (bin, filled bin).
DRAWS = 24
WORDS_PER_BIN_LONG = 64 // BITS
_BIN_SHIFT = 62 - (BINS.bit_length() - 1)


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """Words of a text, A-Z lower-cased."""
    return F.filter(F.split(ascii_lower(text), GAP), lambda w: w != "")


def shingles(text: Column, size: int = SHINGLE) -> Column:
    """62-bit hashes of the word shingles; the whole sequence is one if shorter, none without words."""

    def roll(h: Column) -> Column:
        n = F.size(h)
        several = F.transform(F.sequence(F.lit(1), n - (size - 1)), lambda i: F.xxhash64(*[F.get(h, i + (k - 1)) for k in range(size)]))
        return F.when(n >= size, several).when(n > 0, F.array(F.xxhash64(F.concat(F.array(n.cast("long")), h)))).otherwise(F.array().cast("array<long>"))

    hashed = F.transform(words(text), lambda w: F.xxhash64(w))
    return F.transform(_let(hashed, roll), lambda h: F.shiftrightunsigned(h, 2))


def _first_of_bins(hashes: Column) -> Column:
    """The least hash of every bin in bin order; an empty bin holds its largest possible value."""
    ends = F.array(*[F.lit(((b + 1) << _BIN_SHIFT) - 1) for b in range(BINS)])
    ordered = F.sort_array(F.concat(hashes, ends))
    bin_of = lambda x: F.shiftright(x, _BIN_SHIFT)
    return _let(ordered, lambda a: F.filter(a, lambda x, i: (i == 0) | (bin_of(x) != bin_of(F.get(a, i - 1)))))


def _densified(firsts: Column) -> Column:
    """Values of all bins, empty ones filled by optimal densification; null without any shingle."""
    end = lambda b: F.shiftleft((b + 1).cast("long"), _BIN_SHIFT) - 1
    missing = F.lit(None).cast("long")

    def fill(v: Column) -> Column:
        def drawn(b: Column) -> Column:
            tries = [F.get(v, F.shiftright(F.xxhash64(b, F.lit(t)), 64 - (BINS.bit_length() - 1)).bitwiseAND(BINS - 1).cast("int")) for t in range(DRAWS)]
            filled = F.filter(F.transform(v, lambda x, j: F.when(x.isNotNull(), F.struct(F.xxhash64(b, F.lit(-1), j).alias("o"), x.alias("x")))), lambda s: s.isNotNull())
            return F.coalesce(*tries, F.array_min(filled).getField("x"))

        return F.transform(v, lambda x, b: F.coalesce(x, drawn(b)))

    values = F.transform(firsts, lambda x, b: F.when(x == end(b), missing).otherwise(x))
    return _let(values, lambda v: F.when(F.exists(v, lambda x: x.isNotNull()), fill(v)))


def sketch(text: Column) -> Column:
    """Packed fingerprint: array of BINS * BITS / 64 longs; empty for a text without words."""
    mask, per = (1 << BITS) - 1, WORDS_PER_BIN_LONG

    def pack(v: Column) -> Column:
        parts = lambda w: [F.shiftleft(F.get(v, w * per + k).bitwiseAND(mask), BITS * k) for k in range(per)]

        def word(w: Column) -> Column:
            out, *rest = parts(w)
            for p in rest:
                out = out.bitwiseOR(p)
            return out

        return F.transform(F.sequence(F.lit(0), F.lit(BINS // per - 1)), word)

    dense = _densified(_first_of_bins(shingles(text)))
    return F.coalesce(_let(dense, lambda v: F.when(v.isNotNull(), pack(v))), F.array().cast("array<long>"))


def likeness(a: Column, b: Column) -> Column:
    """Estimated similarity of two packed fingerprints, bias of the low bits removed, 0 to 1.

    Two texts without words are alike (1), one without words is unlike any other (0).
    """

    def unequal(x: Column, y: Column) -> Column:
        d = x.bitwiseXOR(y)
        step = BITS // 2
        while step:
            d = d.bitwiseOR(F.shiftrightunsigned(d, step))
            step //= 2
        ones = sum(1 << (BITS * k) for k in range(WORDS_PER_BIN_LONG))
        return F.bit_count(d.bitwiseAND(F.lit(ones)))

    apart = F.aggregate(F.zip_with(a, b, unequal), F.lit(0), lambda s, x: s + x)
    chance = 1.0 / (1 << BITS)
    same = (1 - apart / F.lit(float(BINS)) - chance) / (1 - chance)
    return F.when(F.size(a) != F.size(b), 0.0).when(F.size(a) == 0, 1.0).otherwise(F.greatest(F.lit(0.0), same))


def as_text(packed: Column) -> Column:
    """Hexadecimal form of a packed fingerprint."""
    return F.array_join(F.transform(packed, lambda w: F.lpad(F.lower(F.hex(w)), 16, "0")), "")


def next_ids(ids: DataFrame) -> DataFrame:
    """doc_id and next_id of distinct ids: the next one in descending order, after the last the first.

    Ranges are ordered on their own; the first id of the next range closes each.
    """
    ranged = durable(ids.select("doc_id").distinct().repartitionByRange(F.desc("doc_id")).select("doc_id", F.spark_partition_id().alias("part")))
    heads = ranged.groupBy("part").agg(F.max("doc_id").alias("head"))
    down = Window.orderBy("part")
    follow = heads.select("part", F.coalesce(F.lead("head").over(down), F.first("head").over(down)).alias("follow"))
    inside = F.lead("doc_id").over(Window.partitionBy("part").orderBy(F.desc("doc_id")))
    return ranged.withColumn("inside", inside).join(follow, "part").select("doc_id", F.coalesce("inside", "follow").alias("next_id"))


def edited_texts(docs: DataFrame) -> DataFrame:
    """doc_id, next_id, n_chars, text, edited text and the next document's sketch (``following``) of every document.

    The last floor(n / 2) code points give way to the first as many of the next
    document. A document sends what is needed of its text, and its sketch, to the
    one before it; both sides of that join are dealt out by the same id, so the
    texts are shuffled once.
    """
    # Either side names its columns anew, so that both are the same rows to the planner and one shuffle serves both.
    def named(column: str) -> DataFrame:
        return docs.select(F.col("doc_id").cast("long").alias(column), text_or_empty().alias("text")).where(F.col(column).isNotNull())

    sizes = durable(named("doc").groupBy("doc").agg(F.max(F.length("text")).alias("most")).withColumnRenamed("doc", "doc_id"))
    order = next_ids(sizes).join(sizes, "doc_id")
    # For every document: whose text it continues, and how much of it is wanted at most.
    wanted = order.select(F.col("next_id").alias("other"), F.col("doc_id").alias("for_id"), F.floor(F.col("most") / 2).cast("int").alias("need"))
    sent = named("other").join(wanted, "other").select(
        "for_id", F.struct(F.expr("substring(text, 1, need)").alias("head"), sketch(F.col("text")).alias("following"), F.col("other").alias("next_id")).alias("sent"))
    heads = sent.groupBy(F.col("for_id").alias("own")).agg(F.min("sent").alias("sent"))
    joined = named("own").join(heads, "own").select(F.col("own").alias("doc_id"), "text", "sent.*")
    alone = docs.where("doc_id is null").select(F.lit(None).cast("long").alias("doc_id"), text_or_empty().alias("text"), F.lit("").alias("head"),
                                                F.lit(None).cast("array<long>").alias("following"), F.lit(None).cast("long").alias("next_id"))
    both = joined.unionByName(alone).withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), (F.col("n_chars") - half).cast("int")), F.substring(F.col("head"), F.lit(1), half))
    return both.select("doc_id", "next_id", "n_chars", "text", edited.alias("edited"), "following")


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next.

    Null text is empty; texts without words have an empty fingerprint. Of rows
    with one id the smallest needed beginning stands for "the next document"; a row
    with null id has no next one, is cut in half and gets near_next null. A lone
    document is its own next one. Extra columns are ignored, an empty table gives no rows.
    """
    texts = edited_texts(docs)
    prints = F.struct(sketch(F.col("text")).alias("own"), sketch(F.col("edited")).alias("changed"), F.col("following").alias("following"))
    # A generator, so that each sketch is worked out once.
    results = F.inline(F.transform(F.array(prints), lambda s: F.struct(
        as_text(s.own).alias("fingerprint"), as_text(s.changed).alias("edited_fingerprint"), likeness(s.own, s.changed).alias("near_edited"),
        F.when(s.following.isNotNull(), likeness(s.own, s.following)).alias("near_next"))))
    return texts.select("doc_id", "n_chars", F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"), results)
