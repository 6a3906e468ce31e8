"""Summary statistics: column detection, filters, harmonising, munging."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genolith.functions.special import normal_upper_quantile
from genolith.operators.genotypes import complement_base
from genolith.operators.samples import distinct_by

# Patterns of the column names of summary statistics.
PATTERNS = {
    "SNPID": r"snp|SNP|MarkerName|variant.id",
    "CHR": r"^CHROM$|^chr$|^CHR$|^Chromosome$|^chr_name$",
    "POS": r"^pos$|^bp$|^bp_hg19$|^position|^chrom_start$",
    "BETA": r"^beta$|^b$|^effect$|^or$|OR.A1|BMIadjMainEffects|^Est$",
    "F": r"^F$|freq|FRQ|MAF",
    "PVAL": r"^p$|pval|Pvalue|P.value|P.val|BMIadjMainP|^Score\.pval$",
    "SE": r"^se|^StdErr$|BMIadjMainSE|^Est\.SE$",
    "A1": r"A1|Allele1|^effect\.allele$",
    "A2": r"A2|Allele2|^other\.allele$",
    "N": r"^N$|^TotalSampleSize$|^SAMPLE_SIZE$|^n\.obs$",
    "Ncases": r"^N_CASES$|^N_CASE$|^Ncases$|^n\.cases$",
    "Ncontrols": r"^N_CONTROLS$|^N_CONTROL$|^Ncontrols|^n\.controls$",
    "info": r"INFO|RSQ",
    "Z": r"^Z$|zscore",
    "ProbeID": r"ProbeID",
}
UNIQUE = ["SNPID", "CHR", "POS", "BETA", "SE", "PVAL"]


def sniff(columns: list[str], eqtl: bool = False) -> dict[str, str]:
    """Standard name -> column, or an error when it cannot be told."""
    found = {name: [c for c in columns if re.search(pattern, c, re.IGNORECASE)] for name, pattern in PATTERNS.items()}
    found["F"] = found["F"][:1]
    first = found["PVAL"][:1]
    if first and re.search("het", first[0], re.IGNORECASE):
        # A p-value of heterogeneity is not the one of the effect.
        first = [c for c in columns if re.search("^p", c, re.IGNORECASE)]
    found["PVAL"] = first
    missing = [n for n in ("SNPID", "PVAL") if not found[n]]
    if missing:
        raise ValueError(f"columns not recognised: {', '.join(missing)}")
    ambiguous = [n for n in UNIQUE if len(found[n]) > 1]
    if ambiguous:
        raise ValueError(f"several columns match: {', '.join(ambiguous)}")
    if eqtl and not found["ProbeID"]:
        raise ValueError("column ProbeID is missing")
    if not eqtl:
        found.pop("ProbeID")
    return {name: matched[0] for name, matched in found.items() if matched}


NUMERIC = ["POS", "BETA", "F", "PVAL", "SE", "N", "Ncases", "Ncontrols", "info", "Z"]


def standard_columns(df: DataFrame, eqtl: bool = False) -> DataFrame:
    """Only the recognised columns, under their standard names."""
    names = sniff(df.columns, eqtl)
    picked = [F.col(f"`{c}`").try_cast("double").alias(n) if n in NUMERIC and n != "POS"
              else F.col(f"`{c}`").try_cast("bigint").alias(n) if n == "POS"
              else F.col(f"`{c}`").cast("string").alias(n) for n, c in names.items()]
    out = df.select(*picked)
    if not (("BETA" in names and "SE" in names) or "PVAL" in names):
        raise ValueError("need BETA and SE, or PVAL")
    return out


def folded(freq: Column) -> Column:
    """Minor allele frequency."""
    return F.when(freq < 0.5, freq).otherwise(F.lit(1.0) - freq)


def filter_sumstats(df: DataFrame, info_filter: float = 0.6, maf_filter: float = 0.001) -> DataFrame:
    """Imputation quality and minor allele frequency filters, where the columns exist."""
    for c in [c for c in df.columns if "info" in c]:
        df = df.where(F.col(c) > info_filter)
    if "MAF" in df.columns:
        return df.where(F.col("MAF") > maf_filter)
    if "F" in df.columns:
        return df.withColumn("MAF", folded(F.col("F").cast("double"))).where(F.col("MAF") > maf_filter)
    return df


def complete_cases(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows without NULL or NaN."""
    return df.na.drop(subset=columns or df.columns)


def format_gtex_eqtl(eqtl: DataFrame, n: int = 948) -> DataFrame:
    """``chr_pos_ref_alt_build`` ids to the standard columns."""
    part = lambda i: F.element_at(F.split("variant_id", "_"), i)
    c = F.col
    return eqtl.select(
        c("variant_id").alias("SNPID"), part(1).alias("CHR"), part(2).cast("bigint").alias("POS"), part(4).alias("A1"), part(3).alias("A2"),
        c("slope").alias("BETA"), c("slope_se").alias("SE"), c("maf").alias("F"), c("pval_beta").alias("PVAL"), c("gene_id").alias("ProbeID"),
        F.lit(n).alias("N"))


def with_sample_count(eqtl: DataFrame, sample_list: DataFrame) -> DataFrame:
    """The number of individuals on the list as N."""
    return eqtl.withColumn("N", F.lit(sample_list.count()))


def single_allele_sites(bim: DataFrame) -> DataFrame:
    """Sites whose position holds one variant only."""
    once = bim.groupBy("chrom", "pos").agg(F.count(F.lit(1)).alias("_n")).where("_n = 1")
    return bim.join(once.select("chrom", "pos"), ["chrom", "pos"], "left_semi")


def format_cohort_eqtl(eqtl: DataFrame, bim: DataFrame) -> DataFrame:
    """Nominal-pass results with the alleles of the single-allele sites."""
    sites = single_allele_sites(bim).select(F.col("chrom").alias("chromTopVar"), F.col("pos").alias("startTopVar"), "snpid", "A1", "A2")
    c = F.col
    return eqtl.join(sites, ["chromTopVar", "startTopVar"]).select(
        c("pid").alias("ProbeID"), c("snpid").alias("SNPID"), F.concat(F.lit("chr"), c("chromTopVar")).alias("CHR"), c("startTopVar").alias("POS"),
        "A1", "A2", c("regressionSlope").alias("BETA"), c("nominalPVal").alias("PVAL"))


def alleles_match(a1: Column, a2: Column, b1: Column, b2: Column) -> Column:
    """Same, swapped, complementary, or complementary and swapped; any case."""
    a1, a2, b1, b2 = (F.upper(x) for x in (a1, a2, b1, b2))
    c1, c2 = complement_base(b1), complement_base(b2)
    return ((a1 == b1) & (a2 == b2)) | ((a1 == b2) & (a2 == b1)) | ((a1 == c1) & (a2 == c2)) | ((a1 == c2) & (a2 == c1))


def allele_aware_merge(left: DataFrame, right: DataFrame, key: str = "SNPID") -> DataFrame:
    """Equi-join on the marker with compatible alleles; suffixes ``_biom`` and ``_eqtl``."""
    a = left.select(key, *[F.col(c).alias(f"{c}_biom") for c in left.columns if c != key])
    b = right.select(key, *[F.col(c).alias(f"{c}_eqtl") for c in right.columns if c != key])
    return a.join(b, key).where(alleles_match(F.col("A1_biom"), F.col("A2_biom"), F.col("A1_eqtl"), F.col("A2_eqtl")))


def harmonize_gwas(assoc: DataFrame, panel: DataFrame) -> DataFrame:
    """Standard names, z-score and the reference panel's id.

    ``panel``: panel_variant_id, chromosome, position, panel_non_effect,
    panel_effect. Alleles swapped against the panel flip the effect.
    """
    c = F.col
    named = assoc.select(
        c("variant_id"), c("contig").alias("chromosome"), c("pos").alias("position"), c("effect_allele"), c("other_allele").alias("non_effect_allele"),
        c("freq").alias("frequency"), c("score_pval").alias("pvalue"), c("est").alias("effect_size"), c("est_se").alias("standard_error"),
        c("n_obs").alias("sample_size"))
    joined = named.join(panel, ["chromosome", "position"])
    same = (c("effect_allele") == c("panel_effect")) & (c("non_effect_allele") == c("panel_non_effect"))
    swapped = (c("effect_allele") == c("panel_non_effect")) & (c("non_effect_allele") == c("panel_effect"))
    sign = F.when(same, 1.0).otherwise(-1.0)
    return joined.where(same | swapped).select(
        "variant_id", "panel_variant_id", "chromosome", "position", c("panel_effect").alias("effect_allele"),
        c("panel_non_effect").alias("non_effect_allele"), F.when(same, c("frequency")).otherwise(1 - c("frequency")).alias("frequency"), "pvalue",
        (sign * c("effect_size") / c("standard_error")).alias("zscore"), (sign * c("effect_size")).alias("effect_size"), "standard_error", "sample_size")


def strand_ambiguous(a1: Column, a2: Column) -> Column:
    return F.upper(a2) == complement_base(F.upper(a1))


def munge_sumstats(assoc: DataFrame, min_maf: float = 0.01) -> DataFrame:
    """Rows fit for LD-score regression, with a signed z-score.

    Drops missing values, p outside (0, 1], rare variants, alleles other than
    single bases, strand-ambiguous pairs and repeated ids.
    """
    c = F.col
    named = assoc.select(
        c("variant_id").alias("SNP"), F.upper("effect_allele").alias("A1"), F.upper("other_allele").alias("A2"), c("n_obs").cast("double").alias("N"),
        c("freq").alias("FRQ"), c("score_pval").alias("P"), c("est").alias("EST"))
    kept = complete_cases(named).where((c("P") > 0) & (c("P") <= 1) & (folded(c("FRQ")) > min_maf))
    base = ["A", "C", "G", "T"]
    kept = kept.where(c("A1").isin(base) & c("A2").isin(base) & (c("A1") != c("A2")) & ~strand_ambiguous(c("A1"), c("A2")))
    once = distinct_by(kept, ["SNP"], ["A1", "A2", "N", "FRQ", "P", "EST"])
    return once.select("SNP", "A1", "A2", "N", (F.signum("EST") * normal_upper_quantile(c("P") / 2)).alias("Z"))
