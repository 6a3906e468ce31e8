"""Sample matching: subsets, sex checks, ancestry lists, id set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from genolith.operators.genotypes import GenotypeSet
from genolith.operators.qc import filter_polymorphic
from genolith.session import broadcast_if_small, durable


def subset_samples(g: GenotypeSet, sample_list: DataFrame) -> GenotypeSet:
    """Keep the listed samples and the variants still polymorphic among them."""
    return filter_polymorphic(g.keep_samples(sample_list))


def without_clinical_record(samples: DataFrame, clinical: DataFrame, key="subject_id") -> DataFrame:
    return samples.join(clinical.select(key).distinct(), key, "left_anti")


def match_samples(samples: DataFrame, clinical: DataFrame, mismatched: DataFrame, key="subject_id") -> DataFrame:
    """Samples with a clinical record and no sex mismatch, one row per subject."""
    kept = samples.join(clinical.select(key).distinct(), key, "left_semi").join(mismatched.select(key), key, "left_anti")
    return distinct_by(kept, [key], [c for c in kept.columns if c != key])


def sample_difference(first: DataFrame, second: DataFrame, key="sample_key") -> DataFrame:
    return first.select(key).join(second.select(key), key, "left_anti")


def distinct_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the first in ``order``; an aggregate, so no group is sorted."""
    rest = [c for c in df.columns if c not in keys]
    ordered = order + [c for c in rest if c not in order]
    picked = df.groupBy(*keys).agg(F.min(F.struct(*ordered)).alias("_first"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"_first.{c}").alias(c) for c in df.columns])


def reported_sex(clinical: DataFrame, key="subject_id", sex="sex") -> DataFrame:
    return clinical.groupBy(key).agg(F.array_join(F.array_sort(F.collect_set(sex)), "/").alias("reported"))


def sex_mismatch(imputed: DataFrame, clinical: DataFrame, key="subject_id") -> DataFrame:
    """Subjects whose imputed sex contradicts the reported one; NULL imputation never does."""
    joined = imputed.join(reported_sex(clinical, key), key, "inner")
    expected = F.when(F.col("is_female"), "Female").otherwise("Male")
    return joined.where(F.col("is_female").isNotNull() & (F.col("reported") != expected))


def impute_sex(entries: DataFrame, stats: DataFrame, female_threshold=0.5, male_threshold=0.6) -> DataFrame:
    """Inbreeding coefficient per sample over called sites.

    Expected homozygosity of a site is 1 - 2p(1-p) with p the cohort's allele
    frequency; monomorphic sites carry no information and are left out.
    """
    # Written, so that counting and sending them reads the calls once; joined by size, so that the calls need no sort.
    freq = durable(stats.where((F.col("af") > 0) & (F.col("af") < 1)).select(
        "variant_key", (1 - 2 * F.col("af") * (1 - F.col("af"))).alias("e_hom")
    ))
    sums = (
        entries.where(F.col("gt").isNotNull())
        .join(broadcast_if_small(freq), "variant_key")
        .groupBy("sample_key")
        .agg(
            F.count(F.lit(1)).alias("n_called"),
            F.sum("e_hom").alias("expected_homs"),
            F.count_if(F.col("gt") != 1).alias("observed_homs"),
        )
    )
    f = (F.col("observed_homs") - F.col("expected_homs")) / (F.col("n_called") - F.col("expected_homs"))
    return sums.withColumn("f_stat", f).withColumn(
        "is_female",
        F.when(F.col("f_stat") < female_threshold, True).when(F.col("f_stat") > male_threshold, False),
    )


# Record codes that map to a broad ancestry label.
BLACK_CODES = ["AFRICAN-AMERICAN", "GHANAIAN", "GUINEAN", "HAITIAN", "JAMAICAN", "NIGERIAN",
               "OTHER: WEST AFRICAN", "OTHER: NORTH AFRICAN", "TRINIDADIAN"]
ASIAN_CODES = ["ASIAN INDIAN", "BANGLADESHI", "CHINESE", "FILIPINO", "JAPANESE", "KOREAN",
               "LAOTIAN", "INDONESIAN", "SINGAPOREAN"]


def ancestry_label(race: Column, ethnicity: Column) -> Column:
    """Hispanic ethnicity wins over any race code."""
    return (
        F.when(ethnicity == "HISPANIC", "HISPANIC")
        .when(race.isin(ASIAN_CODES), "ASIAN")
        .when(race.isin(BLACK_CODES), "BLACK")
        .when(race == "WHITE", "WHITE")
        .otherwise("OTHER/UNKNOWN")
    )


def population_list(calls: DataFrame, population: str, sample="sample_id", pop="population") -> DataFrame:
    return calls.where(F.col(pop) == population).select(F.col(sample).alias("Subject_ID"))


def clinical_minus_excluded(clinical: DataFrame, excluded: DataFrame, key="Subject_ID") -> DataFrame:
    return clinical.select(key).distinct().subtract(excluded.select(key))


def fit_samples(requested: DataFrame, available: DataFrame, left_out: DataFrame | None = None, key="sample_key") -> DataFrame:
    """Ids a model is fitted on: requested and available, minus those left out."""
    kept = requested.select(key).distinct().join(available.select(key), key, "left_semi")
    return kept if left_out is None else kept.join(left_out.select(key), key, "left_anti")


def labelled_union(lists: dict[str, DataFrame], label="ancestry") -> DataFrame:
    """Sample lists stacked with the name of their list."""
    return reduce(DataFrame.unionByName, [df.withColumn(label, F.lit(name)) for name, df in lists.items()])


def union_endpoints(parts: list[DataFrame]) -> DataFrame:
    """Chromosome endpoints or result shards stacked by column name."""
    return reduce(DataFrame.unionByName, parts)


def trait_pairs(traits: DataFrame, trait="trait") -> DataFrame:
    """Unordered pairs of distinct trait names, each name joined to its later ones.

    The list of names is rolled into every row and unfolded, so the pairs need
    no product of two tables. The names come from a registry, not from data.
    """
    names = traits.select(trait).distinct().groupBy().agg(F.array_sort(F.collect_set(trait)).alias("names"))
    first = names.select("names", F.posexplode("names").alias("i", "trait_1"))
    later = F.slice(F.col("names"), F.col("i") + 2, F.size("names"))
    return first.select("trait_1", F.explode(later).alias("trait_2"))


def ancestry_presence(sites: dict[str, DataFrame], key="variant_id") -> DataFrame:
    """1.0 / 0.0 per ancestry for every site seen in any of them."""
    stacked = labelled_union({a: df.select(key) for a, df in sites.items()})
    return stacked.groupBy(key).agg(
        *[F.max((F.col("ancestry") == a).cast("double")).alias(a) for a in sites]
    )


def first_rows_per_key(df: DataFrame, key: str, order: list[str], n: int) -> DataFrame:
    """The first ``n`` rows per key; Spark prunes each partition before the shuffle."""
    w = W.partitionBy(key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")
