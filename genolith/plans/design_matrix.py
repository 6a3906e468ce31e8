"""Clinical visits, batches and components joined to one design matrix."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genolith.operators import clinical as cl
from genolith.session import durable

KEY = cl.KEY


def phenotypes(visits: DataFrame, viral_loads: DataFrame | None = None, order: list[str] = cl.ORDER,
               missing_severity: float | None = None) -> DataFrame:
    """All phenotypes of a subject that need no other subject."""
    df = (
        cl.clinical_rollup(visits, order)
        .join(cl.trend_flags(visits, order, missing_severity), KEY, "left")
        .join(cl.any_prefix(visits, ["COMORBID", "ENCOUNTER_COMORBID"], "any_comorbidity"), KEY, "left")
        .join(cl.post_acute(visits), KEY, "left")
        .join(cl.date_phenotypes(visits, order), KEY, "left")
    )
    df = cl.contrast_phenotypes(df)
    if viral_loads is not None:
        df = cl.viral_load_phenotypes(df, viral_loads)
    df = cl.invert_outcomes(cl.severity_scales(df))
    hours = F.col("icu_hours_cumulative")
    df = df.withColumn("icu_hours_cumulative", F.when(hours != 0, hours))
    return cl.add_age_sex_terms(df).withColumn("is_hispanic", cl.is_hispanic(F.col("ethnicity")))


def named_components(pcs: DataFrame, prefix: str = "", suffix: str = "", n: int = 10, key: str = KEY) -> DataFrame:
    """The first ``n`` components as ``<prefix>pc1<suffix>``, ..."""
    components = [c for c in pcs.columns if c != key][:n]
    return pcs.select(key, *[F.col(c).alias(f"{prefix}pc{i}{suffix}") for i, c in enumerate(components, 1)])


def array_batches(visits: DataFrame, batches: DataFrame, order: list[str] = cl.ORDER) -> DataFrame:
    """First known genotyping-array batch among a subject's blood samples."""
    known = visits.join(batches.distinct(), visits["Uncorrected_Blood_Sample"] == batches["sample"])
    return known.groupBy(KEY).agg(cl.first_value(F.col("batch"), order).alias("gsa_batch"))


def flowcell_columns(flowcells: DataFrame, dropped: list[str] | None = None) -> DataFrame:
    """Multi-batch flag and one column per flowcell, keyed by subject."""
    kept = flowcells if not dropped else flowcells.where(~F.col("sample").isin(dropped))
    named = kept.select(F.element_at(F.split("sample", "T"), 1).alias(KEY), "flowcells")
    flags = named.select(KEY, cl.multi_batch().alias("multi_batch"))
    return flags.join(cl.one_hot(named, KEY, "flowcells", "flowcell_", "+"), KEY, "left")


def assemble(df: DataFrame, tables: list[DataFrame]) -> DataFrame:
    """Left joins of per-subject tables; all sides are keyed by subject."""
    return reduce(lambda a, b: a.join(b, KEY, "left"), tables, df)


def design_matrix(visits: DataFrame, viral_loads: DataFrame | None = None, flowcells: DataFrame | None = None,
                  batches: DataFrame | None = None, components: dict[tuple[str, str], DataFrame] | None = None,
                  transforms: list[str] | None = None, order: list[str] = cl.ORDER) -> DataFrame:
    # One row per subject: written once, as the cohort minimum and the ranks read it again.
    df = cl.recruitment_day(durable(phenotypes(visits, viral_loads, order)))
    names = cl.CONTINUOUS if transforms is None else transforms
    df = cl.transformed(df, [c for c in names if c in df.columns])
    extra = []
    if flowcells is not None:
        extra.append(flowcell_columns(flowcells))
    if batches is not None:
        extra.append(array_batches(visits, batches, order))
    for (prefix, suffix), pcs in (components or {}).items():
        extra.append(named_components(pcs, prefix, suffix))
    return assemble(df, extra)


def replication_matrix(visits: DataFrame, excluded: DataFrame, pcs: DataFrame, order: list[str]) -> DataFrame:
    """Replication cohort: subjects with components, minus the excluded ids."""
    return (
        cl.replication_rollup(visits, order)
        .join(excluded.select(KEY), KEY, "left_anti")
        .join(named_components(pcs), KEY, "inner")
    )


# --- files for the whole-genome regression tool ------------------------------


def phenotype_table(matrix: DataFrame, phenotypes: list[str]) -> DataFrame:
    """FID, IID and the phenotypes as whole numbers."""
    return matrix.select(
        F.col(KEY).alias("FID"), F.col(KEY).alias("IID"), *[F.round(F.col(p).cast("double"), 0).cast("int").alias(p) for p in phenotypes]
    )


# Ancestry groups whose components enter the covariate file.
GROUPS = ["eur", "afr", "amr", "sas", "eas", "white", "black", "hispanic", "asian"]


def covariate_names(matrix: DataFrame, groups: list[str] = GROUPS, n: int = 10) -> list[str]:
    names = ["age", "sex_M", "age_sex", "age_squared", "recruitment_date"]
    names += sorted(c for c in matrix.columns if c.startswith(("flowcell_",)))
    names += sorted(c for c in matrix.columns if c.startswith("gsa_batch_"))
    stems = [""] + [f"{g}_" for g in groups]
    names += [f"{s}pc{i}{imp}" for s in stems for imp in ("", "_imputed") for i in range(1, n + 1)]
    return [c for c in names if c in matrix.columns]


def covariate_table(matrix: DataFrame, groups: list[str] = GROUPS) -> DataFrame:
    """FID, IID, sex and array batch as 0/1 columns, and the numeric covariates."""
    out = matrix.withColumn("sex_M", F.coalesce((F.col("sex") == "M").cast("int"), F.lit(0)))
    if "gsa_batch" in matrix.columns:
        batches = cl.one_hot(matrix, KEY, "gsa_batch", "gsa_batch_")
        out = out.join(batches, KEY, "left").fillna(0, [c for c in batches.columns if c != KEY])
    return out.select(F.col(KEY).alias("FID"), F.col(KEY).alias("IID"), *covariate_names(out, groups))
