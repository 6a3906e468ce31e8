"""The genotype set (variants, samples, entries) and its row-level transforms."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class GenotypeSet:
    """Long-form genotypes.

    ``variants``: variant_key, contig, pos, ref, alt, ...
    ``samples``: sample_key, ...
    ``entries``: variant_key, sample_key, gt (0/1/2, NULL = no call), gq, dp, ...
    """

    variants: DataFrame
    samples: DataFrame
    entries: DataFrame

    def keep_variants(self, keys: DataFrame) -> "GenotypeSet":
        keys = keys.select("variant_key")
        return replace(
            self,
            variants=self.variants.join(keys, "variant_key", "left_semi"),
            entries=self.entries.join(keys, "variant_key", "left_semi"),
        )

    def keep_samples(self, keys: DataFrame) -> "GenotypeSet":
        keys = keys.select("sample_key")
        return replace(
            self,
            samples=self.samples.join(keys, "sample_key", "left_semi"),
            entries=self.entries.join(keys, "sample_key", "left_semi"),
        )

    def drop_samples(self, keys: DataFrame) -> "GenotypeSet":
        keys = keys.select("sample_key")
        return replace(
            self,
            samples=self.samples.join(keys, "sample_key", "left_anti"),
            entries=self.entries.join(keys, "sample_key", "left_anti"),
        )


def variant_id(contig="contig", pos="pos", ref="ref", alt="alt") -> Column:
    """``chr:pos:ref:alt``."""
    return F.concat_ws(":", F.col(contig), F.col(pos).cast("string"), F.col(ref), F.col(alt))


def contig_index(contig="contig") -> Column:
    """Genome order: 1..22, X = 23, Y = 24, M = 25; other names sort last."""
    bare = F.regexp_replace(F.col(contig) if isinstance(contig, str) else contig, "^chr", "")
    return (
        F.when(bare.rlike("^[0-9]{1,2}$"), bare.try_cast("int"))
        .when(bare == "X", 23)
        .when(bare == "Y", 24)
        .when(bare.isin("M", "MT"), 25)
        .otherwise(99)
    )


def genome_sort(df: DataFrame) -> DataFrame:
    return df.orderBy(contig_index(), "pos", *[c for c in ("ref", "alt") if c in df.columns])


def split_chromosome(df: DataFrame, contig: str) -> DataFrame:
    return df.where(F.col("contig") == contig)


def filter_biallelic(variants: DataFrame, alleles="alleles") -> DataFrame:
    return variants.where(F.size(alleles) == 2)


# --- multi-allelic sites -----------------------------------------------------


def downcode(a1: Column, a2: Column, a_index: Column) -> Column:
    """Copies of one alternate allele in a diploid call; NULL without a call."""
    return (a1 == a_index).cast("int") + (a2 == a_index).cast("int")


def split_r_sum(values: Column, a_index: Column) -> Column:
    """Per-allele counts folded to [all other alleles, this allele]."""
    total = F.aggregate(values, F.lit(0).cast("bigint"), lambda s, x: s + x)
    mine = F.element_at(values, a_index + 1).cast("bigint")
    return F.when(values.isNotNull(), F.array(total - mine, mine))


def split_a_pick(values: Column, a_index: Column) -> Column:
    """Per-alternate values reduced to this alternate's."""
    return F.when(values.isNotNull(), F.array(F.try_element_at(values, a_index)))


def split_g_min(values: Column, a_index: Column) -> Column:
    """Per-genotype scores: the smallest among the genotypes that fold to 0, 1 or 2 copies.

    Genotype (j, k), j <= k, sits at index k(k+1)/2 + j.
    """
    with_calls = F.transform(
        values,
        lambda x, i: F.struct(x.alias("x"), _pair_low(i).alias("j"), _pair_high(i).alias("k")),
    )

    def smallest(copies: int) -> Column:
        matching = F.filter(
            with_calls,
            lambda g: ((g["j"] == a_index).cast("int") + (g["k"] == a_index).cast("int")) == copies,
        )
        return F.array_min(F.transform(matching, lambda g: g["x"]))

    return F.when(values.isNotNull(), F.array(smallest(0), smallest(1), smallest(2)))


def _pair_high(i: Column) -> Column:
    return F.floor((F.sqrt(i * 8 + 1.0) - 1) / 2).cast("int")


def _pair_low(i: Column) -> Column:
    high = _pair_high(i)
    return (i - high * (high + 1) / 2).cast("int")


def split_multi(
    sites: DataFrame,
    r_fields: tuple[str, ...] = ("AD", "F1R2", "F2R1"),
    g_fields: tuple[str, ...] = ("GP", "PL", "PRI"),
    a_fields: tuple[str, ...] = ("AF",),
    info_fields: tuple[str, ...] = ("AC", "AF", "MLEAC", "MLEAF"),
) -> DataFrame:
    """One row per alternate allele of a call table.

    ``sites`` has contig, pos, ref, alts (array), a1, a2 (called allele
    numbers) and any of the array fields; ``info`` may be a struct of arrays.
    """
    exploded = sites.select("*", F.posexplode("alts").alias("_p", "alt"))
    a_index = (F.col("_p") + 1).cast("int")
    out = exploded.withColumn("a_index", a_index).withColumn("gt", downcode(F.col("a1"), F.col("a2"), F.col("a_index")))
    index = F.col("a_index")
    for name, rule in (
        [(f, split_r_sum) for f in r_fields] + [(f, split_g_min) for f in g_fields] + [(f, split_a_pick) for f in a_fields]
    ):
        if name in sites.columns:
            out = out.withColumn(name, rule(F.col(name), index))
    if "info" in sites.columns:
        present = [f.name for f in sites.schema["info"].dataType.fields]
        out = out.withColumn(
            "info",
            F.struct(*[
                (split_a_pick(F.col(f"info.{f}"), index) if f in info_fields else F.col(f"info.{f}")).alias(f)
                for f in present
            ]),
        )
    return out.drop("_p", "alts", "a1", "a2")


def complement_base(base: Column) -> Column:
    """A<->T, C<->G for single bases; longer alleles stay as they are."""
    return F.when(F.length(base) == 1, F.translate(base, "ATGC", "TACG")).otherwise(base)


def strip_version(gene: Column) -> Column:
    return F.element_at(F.split(gene, "\\."), 1)


def fill_missing(first: Column, *fallbacks: Column) -> Column:
    return F.coalesce(first, *fallbacks)


def subject_from_sample(samples: DataFrame, sample="sample_id") -> DataFrame:
    """Drop re-sequenced samples (ids ending in ``a``), then name the subject."""
    s = F.col(sample)
    subject = F.element_at(F.split(F.element_at(F.split(s, "_"), 1), "T"), 1)
    return samples.where(~s.endswith("a")).withColumn("subject_id", subject)


def endpoint_name(name: Column, suffix: str) -> Column:
    """Replace a trailing ``*_annotated`` part of an endpoint's name, else append."""
    stem = F.regexp_replace(name, r"\.mt$", "")
    return F.concat(F.regexp_replace(stem, r"(?<=.)\.[^.]*_annotated$", ""), F.lit(f".{suffix}"))
