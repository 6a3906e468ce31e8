"""Clinical visits to one row per subject.

One conditional aggregate replaces the separate passes over all visits, visits
within the encounter and ICU visits; only ordered questions (did a score ever
fall) take a second pass.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genolith.functions.special import normal_quantile
from genolith.operators.ranking import cumulative_counts
from genolith.operators.trends import ever_changed, series_summary

KEY = "Subject_ID"
ORDER = ["Event_Date", "Visit_Order"]

# The three severity levels in order.
SEVERITY_LEVELS = ["Moderate COVID-19", "Severe COVID-19", "Severe COVID-19 with EOD"]


def severity_code(column: str | Column = "Severity") -> Column:
    """1, 2, 3 for the ordered levels, NULL when missing."""
    c = F.col(column) if isinstance(column, str) else column
    return reduce(lambda w, i: w.when(c == SEVERITY_LEVELS[i], float(i + 1)), range(1, 3), F.when(c == SEVERITY_LEVELS[0], 1.0))


def any_true(condition: Column) -> Column:
    """True if any row is true; NULL rows count as false."""
    return F.coalesce(F.bool_or(condition), F.lit(False))


def first_value(value: Column, order: list[str], keep: Column | None = None) -> Column:
    """First non-null value in visit order, as an aggregate with partial sums."""
    present = value.isNotNull() if keep is None else value.isNotNull() & keep
    return F.min(F.when(present, F.struct(*order, value.alias("_v"))))["_v"]


def last_value(value: Column, order: list[str], keep: Column | None = None) -> Column:
    present = value.isNotNull() if keep is None else value.isNotNull() & keep
    return F.max(F.when(present, F.struct(*order, value.alias("_v"))))["_v"]


def _within(value: Column) -> Column:
    return F.when(F.col("COVID19_Within_Encounter"), value)


def _any_within(condition: Column) -> Column:
    """False without a true row, NULL for a subject without encounter rows."""
    return F.bool_or(_within(F.coalesce(condition, F.lit(False))))


def clinical_rollup(visits: DataFrame, order: list[str] = ORDER) -> DataFrame:
    """Maxima, first and last values and any-of flags per subject."""
    c = F.col
    code = severity_code()
    inside = c("COVID19_Within_Encounter")
    return visits.groupBy(KEY).agg(
        F.max("Age").alias("age"),
        first_value(c("Sex"), order).alias("sex"),
        first_value(c("Race_From_Consent"), order).alias("race"),
        first_value(c("Ethnicity_From_Consent"), order).alias("ethnicity"),
        any_true(c("COVID19_Ever_Positive")).alias("ever_covid"),
        any_true(inside).alias("covid_encounter"),
        first_value(c("Date_Of_First_Sample"), order).alias("recruitment_date"),
        _any_within(c("ICU_Status")).alias("ever_icu"),
        F.max(_within(c("SOFA_Score"))).alias("max_sofa"),
        F.max(_within(c("WHO_Ordinal"))).alias("max_who"),
        F.max(_within(F.when(c("WHO_Ordinal") < 8, c("WHO_Ordinal")))).alias("max_who_minus_death"),
        _any_within(c("COVID19_Deceased_Within_Encounter")).alias("deceased"),
        _any_within(c("SARSCoV2_Recovery_Status") == "Recovered").alias("recovered"),
        _any_within(c("Encounter_Discharge_Date").isNotNull()).alias("discharged"),
        F.max(_within(c("Serology_Highest_Titer"))).alias("highest_titer"),
        F.max(_within(c("Serology_Highest_Titer_AGM_Only"))).alias("highest_titer_agm_only"),
        _any_within(code == 1).alias("severity_ever_moderate"),
        _any_within(code == 2).alias("severity_ever_severe"),
        _any_within(code == 3).alias("severity_ever_eod"),
        F.bool_and(_within(F.coalesce(code == 1, F.lit(True)))).alias("_only_moderate"),
        F.max(_within(code)).alias("max_severity_3value"),
        first_value(code, order, inside).alias("severity_at_admission"),
        first_value(c("WHO_Ordinal"), order, inside).alias("who_at_admission"),
        last_value(code, order, inside).alias("severity_at_discharge"),
        last_value(c("WHO_Ordinal"), order, inside).alias("who_at_discharge"),
        *[F.max(_within(c(f"Viral_Load_CN{i}_per_mL"))).alias(f"max_viral_load_cn{i}") for i in (1, 2, 3)],
        F.max(F.when(c("ICU_Status"), c("SOFA_Score"))).alias("max_sofa_icu_only"),
    ).withColumn(
        "max_severity_moderate",
        F.when(F.col("_only_moderate").isNotNull(), F.coalesce(F.col("max_severity_3value") == 1, F.lit(False))),
    ).drop("_only_moderate")


def trend_flags(visits: DataFrame, order: list[str] = ORDER, missing_severity: float | None = None) -> DataFrame:
    """Rises and falls of SOFA, WHO and severity within the encounter, of SOFA in ICU, and ICU hours.

    The five series are stacked under a measure name and summarised together.
    """
    c = F.col
    severity = severity_code() - 1
    if missing_severity is not None:
        severity = F.coalesce(severity, F.lit(float(missing_severity)))
    series = {
        "sofa": _within(c("SOFA_Score")),
        "who": _within(c("WHO_Ordinal")),
        "severity": _within(severity),
        "icu": F.when(c("ICU_Status"), c("SOFA_Score")),
        "hours": _within(c("ICU_Hours_Since_Entry")),
    }
    long = visits.select(KEY, *order, *[x.cast("double").alias(m) for m, x in series.items()]).unpivot(
        [KEY, *order], list(series), "measure", "x")
    summary = series_summary(long, [KEY, "measure"], order, "x")

    def of(measure: str, value: Column) -> Column:
        return F.max(F.when(c("measure") == measure, value))

    enough = c("n_values") >= 3
    flags = [
        of(m, F.when(enough, c(source))).alias(name + suffix)
        for m, name, suffix in (("sofa", "sofa_ever_{}", ""), ("who", "who_ever_{}", ""), ("severity", "severity_ever_{}", ""),
                                ("icu", "sofa_ever_{}", "_icu_only"))
        for source, name in (("fell", name.format("decreased")), ("rose", name.format("increased")))
    ]
    return summary.groupBy(KEY).agg(*flags, of("hours", c("counter_total")).alias("icu_hours_cumulative"))


def any_prefix(visits: DataFrame, prefixes: list[str], out: str, without: str | None = None, key: str = KEY) -> DataFrame:
    """Any flag among the columns with one of the prefixes, in any visit."""
    names = [c for c in visits.columns if any(c.startswith(p) for p in prefixes) and not (without and without in c)]
    anything = reduce(or_, [F.coalesce(F.col(c).cast("boolean"), F.lit(False)) for c in names], F.lit(False))
    return visits.groupBy(key).agg(F.bool_or(anything).alias(out))


def post_acute(visits: DataFrame, key: str = KEY) -> DataFrame:
    """Post-acute flags; NULL for subjects without any follow-up event."""
    names = [c for c in visits.columns
             if c.startswith(("Post_COVID19_Symptom", "Post_COVID19_New_Fatigue")) and "None" not in c]
    symptom = reduce(or_, [F.coalesce(F.col(c).cast("boolean"), F.lit(False)) for c in names], F.lit(False))
    sums = visits.groupBy(key).agg(
        F.bool_or(symptom).alias("_symptoms"),
        any_true(F.col("Post_COVID19_Quality_Of_Life") == "Worse").alias("_quality"),
        F.count("Post_COVID19_Event_Name").alias("_events"),
    )
    seen = F.col("_events") > 0
    either = F.col("_symptoms") | F.col("_quality")
    return sums.select(
        key,
        F.when(seen, F.col("_symptoms")).alias("post_acute_symptoms"),
        F.when(seen, F.col("_quality")).alias("post_acute_quality_of_life"),
        F.when(seen, either).alias("HGI_post_acute_NQ13"),
        either.alias("HGI_post_acute_NQ23"),
    )


def contrast_phenotypes(df: DataFrame) -> DataFrame:
    """Case/control contrasts; a death counts as a case in each of them."""
    c = F.col
    return (
        df.withColumn("discharged", c("discharged") & ~c("deceased"))
        .withColumn("recovered_not_deceased", c("recovered") & ~c("deceased"))
        .withColumn("deceased_vs_recovered", F.when(c("deceased"), True).when(c("recovered"), False))
        .withColumn("deceased_vs_discharged", F.when(c("deceased"), True).when(c("discharged"), False))
        .withColumn("max_who", F.when(c("deceased"), 8.0).otherwise(c("max_who")))
        .withColumn("severity_ever_increased_counting_death", c("severity_ever_increased") | c("deceased"))
        .withColumn("severity_ever_decreased_counting_discharge", c("severity_ever_decreased") | c("discharged"))
    )


def viral_load_phenotypes(df: DataFrame, loads: DataFrame) -> DataFrame:
    """Blood viral load score and detection, also limited to severe disease."""
    first = loads.groupBy(KEY).agg(F.min(F.struct("row", "bitscore"))["bitscore"].alias("blood_viral_load_bitscore"))
    severe = F.col("severity_ever_severe") | F.col("severity_ever_eod")
    return (
        df.join(first, KEY, "left")
        .withColumn("blood_viral_load_bitscore_severe_only", F.when(severe, F.col("blood_viral_load_bitscore")))
        .withColumn("blood_viral_load_detected", F.when(F.col("covid_encounter"), F.col("blood_viral_load_bitscore").isNotNull()))
        .withColumn("blood_viral_load_detected_severe_only", F.when(severe, F.col("blood_viral_load_detected")))
    )


def severity_scales(df: DataFrame) -> DataFrame:
    """Threshold flags (a missing severity counts as below) and the four-level scale."""
    at = lambda c, test: F.coalesce(test(F.col(c)), F.lit(False))
    return (
        df.withColumn("severe_at_admission", at("severity_at_admission", lambda x: x >= 2))
        .withColumn("eod_at_admission", at("severity_at_admission", lambda x: x == 3))
        .withColumn("severe_at_discharge", at("severity_at_discharge", lambda x: x >= 2))
        .withColumn("eod_at_discharge", at("severity_at_discharge", lambda x: x == 3))
        .withColumn("max_severity_4value", F.when(F.col("deceased"), 4.0).otherwise(F.col("max_severity_3value")))
    )


# Outcomes that are good news and get their sense inverted.
GOOD_OUTCOMES = ["recovered", "discharged", "recovered_not_deceased", "sofa_ever_decreased", "who_ever_decreased",
                 "severity_ever_decreased", "severity_ever_decreased_counting_discharge"]


def invert_outcomes(df: DataFrame, columns: list[str] = GOOD_OUTCOMES) -> DataFrame:
    return df.withColumns({c: ~F.col(c) for c in columns if c in df.columns})


def _days(end: Column, start: Column) -> Column:
    return F.datediff(end, start).cast("double")


def date_phenotypes(visits: DataFrame, order: list[str] = ORDER, key: str = KEY) -> DataFrame:
    """Day counts between onset, encounter and ICU with their validity ranges.

    The encounter length is blanked when the *onset* gap is negative.
    """
    c = F.col
    dates = visits.groupBy(key).agg(
        first_value(c("COVID19_Symptoms_Reported_Onset_Date"), order).alias("_onset"),
        first_value(c("COVID19_Encounter_Start_Date"), order).alias("_start"),
        first_value(c("COVID19_Encounter_End_Date"), order).alias("_end"),
        first_icu_date(order).alias("first_icu_date"),
    )
    onset_gap = _days(c("_start"), c("_onset"))
    length = _days(c("_end"), c("_start"))
    onset_icu = _days(c("first_icu_date"), c("_onset"))
    icu_gap = _days(c("first_icu_date"), c("_start"))
    return dates.select(
        key,
        "first_icu_date",
        F.when(onset_gap.between(0, 30), onset_gap).alias("days_onset_to_encounter"),
        F.when(onset_gap.isNull() | (onset_gap >= 0), length).alias("covid_encounter_days"),
        F.when(onset_icu >= 0, onset_icu).alias("days_onset_to_icu"),
        F.when(icu_gap.between(0, 60), icu_gap).alias("days_encounter_to_icu"),
    )


def first_icu_date(order: list[str] = ORDER) -> Column:
    """Aggregate: date of the first ICU visit within the encounter."""
    return first_value(F.col("Event_Date"), order, F.col("ICU_Status") & F.col("COVID19_Within_Encounter"))


def recruitment_day(df: DataFrame, column: str = "recruitment_date") -> DataFrame:
    """Days since the first recruitment of the cohort."""
    start = df.agg(F.min(column)).first()[0]
    return df.withColumn(column, _days(F.col(column), F.lit(start)))


def add_age_sex_terms(df: DataFrame) -> DataFrame:
    return (
        df.withColumn("sex", F.substring("sex", 1, 1))
        .withColumn("age_sex", F.col("age") * F.coalesce((F.col("sex") == "F").cast("int"), F.lit(0)))
        .withColumn("age_squared", F.col("age") * F.col("age"))
    )


def is_hispanic(ethnicity: Column) -> Column:
    return F.when(ethnicity.isNotNull() & (ethnicity != "Unknown / Not Reported"), ethnicity == "Hispanic or Latino")


# Phenotypes that get percentile, inverse-rank and log versions.
CONTINUOUS = ["max_sofa", "max_sofa_icu_only", "max_who", "max_who_minus_death", "highest_titer", "highest_titer_agm_only",
              "max_viral_load_cn1", "max_viral_load_cn2", "max_viral_load_cn3", "days_onset_to_encounter",
              "covid_encounter_days", "days_onset_to_icu", "days_encounter_to_icu", "icu_hours_cumulative",
              "blood_viral_load_bitscore", "blood_viral_load_bitscore_severe_only", "max_severity_3value",
              "max_severity_4value", "severity_at_admission", "who_at_admission", "severity_at_discharge", "who_at_discharge"]


def log_phenotype(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(f"{column}_log", F.log1p(column))


def transformed(df: DataFrame, columns: list[str] = CONTINUOUS, key: str = KEY) -> DataFrame:
    """Percentile, inverse-rank normal and log1p versions of the named columns.

    The columns are stacked to (name, value) rows, so all of them share one
    ranking job.
    """
    if not columns:
        return df
    for c in columns:
        df = log_phenotype(df, c)
    long = df.select(key, *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(key, columns, "name", "value")
    long = long.where(F.col("value").isNotNull())
    counts = cumulative_counts(long, "value", ["name"]).withColumn(
        "share", (F.col("before") + (F.col("n") + 1) / 2) / F.col("total"))
    ranked = long.join(counts.select("name", "value", "share"), ["name", "value"])
    at = lambda c: F.max(F.when(F.col("name") == c, F.col("share")))
    wide = ranked.groupBy(key).agg(*[at(c).alias(f"{c}_percentile") for c in columns])
    wide = wide.withColumns({f"{c}_irnt": normal_quantile(F.col(f"{c}_percentile")) for c in columns})
    return df.join(wide, key, "left")


def one_hot(df: DataFrame, key: str, column: str, prefix: str, sep: str | None = None) -> DataFrame:
    """0/1 columns per category; with ``sep`` a row may hold several."""
    values = F.explode(F.split(column, f"\\Q{sep}\\E")) if sep else F.col(column)
    long = df.select(key, values.alias("_value")).where(F.col("_value").isNotNull())
    named = long.select(key, F.concat(F.lit(prefix), "_value").alias("_value"), F.lit(1).alias("_one"))
    wide = named.groupBy(key).pivot("_value").agg(F.max("_one"))
    return wide.fillna(0)


def multi_batch(column: str = "flowcells") -> Column:
    return F.col(column).contains("+")


# --- replication cohort ------------------------------------------------------


def encounter_days(visits: DataFrame, key: str = KEY, limit: int = 15) -> DataFrame:
    """First end minus first start among positive rows; NULL above ``limit`` days."""
    span = visits.where("COVID19_Positive").groupBy(key).agg(
        _days(F.min("Encounter_End_Date"), F.min("Encounter_Start_Date")).alias("_days"))
    return span.select(key, F.when(F.col("_days") <= limit, F.col("_days")).alias("covid_encounter_days"))


def replication_rollup(visits: DataFrame, order: list[str], key: str = KEY) -> DataFrame:
    code = severity_code()
    base = visits.groupBy(key).agg(
        F.max("AGE").alias("age"),
        first_value(F.col("GENDER"), order).alias("sex"),
        F.max("WHO_Ordinal").alias("max_who"),
        F.max(F.when(F.col("WHO_Ordinal") < 8, F.col("WHO_Ordinal"))).alias("max_who_minus_death"),
        any_true(code == 2).alias("severity_ever_severe"),
        any_true(code == 3).alias("severity_ever_eod"),
        F.coalesce(F.max(code) == 1, F.lit(False)).alias("max_severity_moderate"),
    )
    who = ever_changed(visits, [key], order, "WHO_Ordinal", "who", min_count=0)
    severity = ever_changed(visits.withColumn("_severity", code - 1), [key], order, "_severity", "severity", min_count=0)
    out = base.join(who, key, "left").join(severity, key, "left").join(encounter_days(visits, key), key, "left")
    never = {c: F.coalesce(F.col(c), F.lit(False)) for c in who.columns + severity.columns if c != key}
    out = invert_outcomes(out.withColumns(never), ["severity_ever_decreased", "who_ever_decreased"])
    return add_age_sex_terms(log_phenotype(out, "covid_encounter_days"))
