"""Stored endpoints and text exports."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genolith.operators.genotypes import GenotypeSet, contig_index, variant_id
from genolith.operators.ranking import dense_index
from genolith.session import broadcast_if_small, durable

#: Calls that the lines of one shard hold, where the number of shards is not given.
SHARD_CALLS = 4_000_000


def write_endpoint(df: DataFrame, path: str, partition: str | None = "contig") -> str:
    """Parquet, replaced as a whole, one folder per chromosome."""
    writer = df.write.mode("overwrite")
    if partition and partition in df.columns:
        writer = writer.partitionBy(partition)
    writer.parquet(path)
    return path


def write_table(df: DataFrame, path: str, sep: str = "\t", na: str = "NA", digits: int | None = None, header: bool = True) -> str:
    """Delimited text; doubles with a fixed number of decimals when asked."""
    if digits is not None:
        doubles = [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")]
        df = df.withColumns({c: F.regexp_replace(F.format_number(c, digits), ",", "") for c in doubles})
    df.write.mode("overwrite").option("sep", sep).option("header", header).option("nullValue", na).csv(path)
    return path


def bim_table(variants: DataFrame) -> DataFrame:
    """Variant list; ``chr`` goes only when every chromosome name has it."""
    every = bool(variants.agg(F.bool_and(F.col("contig").startswith("chr"))).first()[0])
    chrom = F.regexp_replace("contig", "^chr", "") if every else F.col("contig")
    return variants.select(chrom.alias("chrom"), variant_id().alias("varid"), F.lit(0.0).alias("pos_cm"), F.col("pos").alias("pos_bp"),
                           F.col("alt").alias("a1"), F.col("ref").alias("a2"))


def write_bim(variants: DataFrame, path: str) -> str:
    return write_table(bim_table(variants), path, header=False)


def kinship_to_grm(kin_self: DataFrame, kin_between: DataFrame, scale: float = 2.0) -> tuple[DataFrame, DataFrame]:
    """Relationship triplets (id1, id2, nsnp, kin) with integer ids, and the id list.

    Self-kinship is (1 + f) / 2; values carry four decimals.
    """
    ids = dense_index(kin_self.select("id"), "id", "i").select("id", (F.col("i") + 1).cast("int").alias("i"))
    both = kin_self.select(F.col("id").alias("id1"), F.col("id").alias("id2"), "nsnp", (0.5 * (1 + F.col("f"))).alias("kin")).unionByName(
        kin_between.select("id1", "id2", "nsnp", "kin"))
    numbered = both.join(ids.select(F.col("id").alias("id1"), F.col("i").alias("n1")), "id1").join(
        ids.select(F.col("id").alias("id2"), F.col("i").alias("n2")), "id2")
    kin = F.format_number(F.col("kin") * scale, 4)
    grm = numbered.select(F.col("n1").alias("id1"), F.col("n2").alias("id2"), "nsnp", F.regexp_replace(kin, ",", "").alias("kin"))
    return grm.orderBy("id1", "id2"), ids


def vcf_lines(g: GenotypeSet) -> tuple[DataFrame, str]:
    """One text line per variant, and the column header line.

    A VCF line holds every sample of its variant and the header names them all,
    so both are as long as the cohort.
    """
    index = dense_index(g.samples.select("sample_key"), "sample_key", "idx")
    names = [str(row["sample_key"]) for row in index.orderBy("idx").toLocalIterator()]
    gt = F.when(F.col("gt") == 0, "0/0").when(F.col("gt") == 1, "0/1").when(F.col("gt") == 2, "1/1").otherwise("./.")
    field = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("."))
    text = F.concat_ws(":", gt, field("dp"), field("gq"))
    calls = g.entries.join(broadcast_if_small(index), "sample_key").groupBy("variant_key").agg(
        F.array_sort(F.collect_list(F.struct("idx", text.alias("text")))).alias("calls"))
    # A variant with an entry for every sample is written as it stands; only
    # one with gaps has its places looked up.
    complete = F.transform("calls", lambda x: x["text"])
    lookup = F.map_from_entries("calls")
    gaps = F.transform(F.sequence(F.lit(0), F.lit(len(names) - 1)), lambda i: F.coalesce(F.try_element_at(lookup, i.cast("bigint")), F.lit("./.:.:.")))
    filled = F.when(F.size("calls") == len(names), complete).when(F.col("calls").isNotNull(), gaps).otherwise(
        F.array_repeat(F.lit("./.:.:."), len(names)))
    # The variants are the hashed side: the texts of all calls are neither sorted nor broadcast.
    rows = g.variants.hint("shuffle_hash").join(calls, "variant_key", "left")
    line = F.concat_ws("\t", "contig", F.col("pos").cast("string"), variant_id(), "ref", "alt", F.lit("."), F.lit("."), F.lit("."), F.lit("GT:DP:GQ"), F.array_join(filled, "\t"))
    header = "\t".join(["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT", *names])
    kept = [c for c in ("contig", "pos", "ref", "alt", "shard") if c in rows.columns]
    return rows.select(*kept, line.alias("value")), header


def vcf_shards(g: GenotypeSet, n: int | None = None) -> tuple[DataFrame, str]:
    """The (value) lines in genome order, a range of the genome per task, and the column header line.

    The ranges come from the variants alone, so the calls are put to text once; a range
    partitioning of the lines would first make all of them to look at their places.
    """
    if n is None:
        cores = g.entries.sparkSession.sparkContext.defaultParallelism
        n = max(cores, -(-g.variants.count() * g.samples.count() // SHARD_CALLS))
    ranged = g.variants.select("variant_key", "contig", "pos", "ref", "alt", contig_index().alias("_c")).repartitionByRange(n, "_c", "pos")
    shards = durable(ranged.withColumn("shard", F.spark_partition_id()).drop("_c"))
    lines, header = vcf_lines(replace(g, variants=shards))
    placed = lines.withColumn("_c", contig_index()).repartitionById(n, F.col("shard")).sortWithinPartitions("_c", "pos", "ref", "alt")
    return placed.select("value"), header


META = "##fileformat=VCFv4.2"


def write_vcf_shards(g: GenotypeSet, path: str, n: int = 1000) -> str:
    """Genome-ordered text shards, each with its own header."""
    lines, header = vcf_shards(g, n)
    return write_with_header(lines, [META, header], path)


def write_with_header(lines: DataFrame, header: list[str], path: str) -> str:
    """The (value) lines as text, every file of them under its own header."""

    def headed(batches):
        import pandas as pd

        first = True
        for pdf in batches:
            if first and len(pdf):
                yield pd.DataFrame({"value": header})
                first = False
            yield pdf[["value"]]

    lines.mapInPandas(headed, "value string").write.mode("overwrite").text(path)
    return path
