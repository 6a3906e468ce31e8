"""Queries over the clinical operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from genolith import fixtures as fx
from genolith.checks.oracle_math import normal_quantile
from genolith.checks.registry import query, r, rounded
from genolith.operators import clinical as cl, ranking, trends
from genolith.plans import design_matrix as dm

ORDER = ["Event_Date", "Visit_Order"]


def visits(spark, d):
    return fx.view(spark, d, "fx_clinical")


def _first(x, where=""):
    cond = f"{x} IS NOT NULL" + (f" AND {where}" if where else "")
    return f"arg_min({x}, Event_Date * 1 ) FILTER ({cond})"


def _pick(function, x, where=""):
    cond = f"({x}) IS NOT NULL" + (f" AND {where}" if where else "")
    return f"{function}({x}, struct_pack(a := Event_Date, b := Visit_Order)) FILTER ({cond})"


IN = "COVID19_Within_Encounter"
CODE = "(CASE Severity WHEN 'Moderate COVID-19' THEN 1e0 WHEN 'Severe COVID-19' THEN 2e0 WHEN 'Severe COVID-19 with EOD' THEN 3e0 END)"


def _any_in(x):
    return f"bool_or(coalesce({x}, false)) FILTER ({IN})"


ROLLUP = f"""SELECT Subject_ID, max(Age) AS age, {_pick('arg_min', 'Sex')} AS sex, {_pick('arg_min', 'Race_From_Consent')} AS race,
  {_pick('arg_min', 'Ethnicity_From_Consent')} AS ethnicity, coalesce(bool_or(COVID19_Ever_Positive), false) AS ever_covid,
  coalesce(bool_or({IN}), false) AS covid_encounter, {_pick('arg_min', 'Date_Of_First_Sample')} AS recruitment_date,
  {_any_in('ICU_Status')} AS ever_icu, max(SOFA_Score) FILTER ({IN}) AS max_sofa, max(WHO_Ordinal) FILTER ({IN}) AS max_who,
  max(WHO_Ordinal) FILTER ({IN} AND WHO_Ordinal < 8) AS max_who_minus_death, {_any_in('COVID19_Deceased_Within_Encounter')} AS deceased,
  {_any_in("SARSCoV2_Recovery_Status = 'Recovered'")} AS recovered, {_any_in('Encounter_Discharge_Date IS NOT NULL')} AS discharged,
  max(Serology_Highest_Titer) FILTER ({IN}) AS highest_titer, max(Serology_Highest_Titer_AGM_Only) FILTER ({IN}) AS highest_titer_agm_only,
  {_any_in(f'{CODE} = 1')} AS severity_ever_moderate, {_any_in(f'{CODE} = 2')} AS severity_ever_severe, {_any_in(f'{CODE} = 3')} AS severity_ever_eod,
  max({CODE}) FILTER ({IN}) AS max_severity_3value, {_pick('arg_min', CODE, IN)} AS severity_at_admission,
  {_pick('arg_min', 'WHO_Ordinal', IN)} AS who_at_admission, {_pick('arg_max', CODE, IN)} AS severity_at_discharge,
  {_pick('arg_max', 'WHO_Ordinal', IN)} AS who_at_discharge, max(Viral_Load_CN1_per_mL) FILTER ({IN}) AS max_viral_load_cn1,
  max(Viral_Load_CN2_per_mL) FILTER ({IN}) AS max_viral_load_cn2, max(Viral_Load_CN3_per_mL) FILTER ({IN}) AS max_viral_load_cn3,
  max(SOFA_Score) FILTER (ICU_Status) AS max_sofa_icu_only,
  CASE WHEN count(*) FILTER ({IN}) > 0 THEN coalesce(max({CODE}) FILTER ({IN}) = 1, false) END AS max_severity_moderate
  FROM fx_clinical GROUP BY Subject_ID"""


@query("agg8_clinical_rollup", ROLLUP)
def _(spark, d):
    return cl.clinical_rollup(visits(spark, d), ORDER)


ANY = """SELECT Subject_ID, bool_or(coalesce(COMORBID_Asthma, false) OR coalesce(ENCOUNTER_COMORBID_Diabetes, false)) AS any_comorbidity
  FROM fx_clinical GROUP BY Subject_ID"""
POST = """SELECT Subject_ID, CASE WHEN n > 0 THEN s END AS post_acute_symptoms, CASE WHEN n > 0 THEN q END AS post_acute_quality_of_life,
  CASE WHEN n > 0 THEN s OR q END AS HGI_post_acute_NQ13, s OR q AS HGI_post_acute_NQ23 FROM (SELECT Subject_ID,
  bool_or(Post_COVID19_Symptom_Cough OR Post_COVID19_New_Fatigue) AS s, coalesce(bool_or(Post_COVID19_Quality_Of_Life = 'Worse'), false) AS q,
  count(Post_COVID19_Event_Name) AS n FROM fx_clinical GROUP BY Subject_ID) p"""


@query("agg9_any_comorbidity", ANY)
def _(spark, d):
    return cl.any_prefix(visits(spark, d), ["COMORBID", "ENCOUNTER_COMORBID"], "any_comorbidity")


@query("agg9_post_acute", POST)
def _(spark, d):
    return cl.post_acute(visits(spark, d))


def _trend(value, prefix, where, min_count=3, table="fx_clinical"):
    """Compare each known value with the one before it."""
    return f"""SELECT Subject_ID, CASE WHEN count(*) >= {min_count} THEN coalesce(bool_or(x < p), false) END AS {prefix}_ever_decreased,
  CASE WHEN count(*) >= {min_count} THEN coalesce(bool_or(x > p), false) END AS {prefix}_ever_increased
  FROM (SELECT Subject_ID, x, lag(x) OVER (PARTITION BY Subject_ID ORDER BY Event_Date, Visit_Order) AS p
    FROM (SELECT Subject_ID, Event_Date, Visit_Order, {value} AS x FROM {table} WHERE {where}) v WHERE x IS NOT NULL) w GROUP BY Subject_ID"""


HOURS = f"""SELECT Subject_ID, sum(CASE WHEN next IS NULL OR next < x THEN x ELSE 0 END) AS icu_hours_cumulative FROM (SELECT Subject_ID, x,
  lead(x) OVER (PARTITION BY Subject_ID ORDER BY Event_Date, Visit_Order) AS next FROM (SELECT Subject_ID, Event_Date, Visit_Order,
  ICU_Hours_Since_Entry AS x FROM fx_clinical WHERE {IN} AND ICU_Hours_Since_Entry IS NOT NULL) v) w GROUP BY Subject_ID"""


@query("win1_sofa_ever_changed", _trend("SOFA_Score", "sofa", IN))
def _(spark, d):
    return trends.ever_changed(visits(spark, d).where(IN), ["Subject_ID"], ORDER, "SOFA_Score", "sofa")


@query("win1_severity_ever_changed", _trend("severity_code", "severity", "within_encounter",
       table="(SELECT subject_id AS Subject_ID, visit_ts AS Event_Date, visit_id AS Visit_Order, severity_code, within_encounter FROM fx_visits) f"))
def _(spark, d):
    v = fx.view(spark, d, "fx_visits").where("within_encounter").withColumnRenamed("subject_id", "Subject_ID")
    return trends.ever_changed(v, ["Subject_ID"], ["visit_ts", "visit_id"], "severity_code", "severity")


@query("win1_replication_form", _trend("WHO_Ordinal", "who", "true", 0))
def _(spark, d):
    return trends.ever_changed(visits(spark, d), ["Subject_ID"], ORDER, "WHO_Ordinal", "who", min_count=0)


@query("win2_resettable_hours", HOURS)
def _(spark, d):
    return trends.resettable_total(visits(spark, d).where(IN), ["Subject_ID"], ORDER, "ICU_Hours_Since_Entry", "icu_hours_cumulative")


@query("win2_resettable_hours_legacy", f"""SELECT Subject_ID, sum(CASE WHEN x < p THEN p + ahead ELSE 0 END) AS hours FROM (SELECT Subject_ID, x,
  lag(x) OVER w AS p, max(x) OVER (PARTITION BY Subject_ID ORDER BY Event_Date, Visit_Order ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ahead
  FROM (SELECT Subject_ID, Event_Date, Visit_Order, ICU_Hours_Since_Entry AS x FROM fx_clinical WHERE {IN} AND ICU_Hours_Since_Entry IS NOT NULL) v
  WINDOW w AS (PARTITION BY Subject_ID ORDER BY Event_Date, Visit_Order)) q GROUP BY Subject_ID""")
def _(spark, d):
    return trends.resettable_total_legacy(visits(spark, d).where(IN), ["Subject_ID"], ORDER, "ICU_Hours_Since_Entry", "hours")


PERCENTILE = """SELECT event_id, value, round((rank() OVER (ORDER BY value) + (count(*) OVER (PARTITION BY value) - 1) / 2e0)
  / count(*) OVER (), 8) AS value_percentile FROM events"""


@query("win3_percentile_rank", PERCENTILE)
def _(spark, d):
    return rounded(ranking.percentile_rank(fx.table(spark, d, "events").select("event_id", "value"), "value"), "value_percentile")


@query("win3_percentile_rank_by_group", PERCENTILE.replace("OVER (ORDER BY value)", "OVER (PARTITION BY event_type ORDER BY value)")
       .replace("PARTITION BY value", "PARTITION BY event_type, value").replace("OVER ()", "OVER (PARTITION BY event_type)").replace("event_id,", "event_id, event_type,"))
def _(spark, d):
    e = fx.table(spark, d, "events").select("event_id", "event_type", "value")
    return rounded(ranking.percentile_rank(e, "value", by=["event_type"]), "value_percentile")


SHARE = """SELECT event_id, value, (rank() OVER (ORDER BY value) + (count(*) OVER (PARTITION BY value) - 1) / 2e0) / count(*) OVER () AS p,
  (rank() OVER (ORDER BY value) + (count(*) OVER (PARTITION BY value) - 1) / 2e0 - 5e-1) / count(*) OVER () AS h FROM events"""


@query("win4_irnt", f"SELECT event_id, value, CASE WHEN p < 1 THEN round({normal_quantile('p')}, 7) END AS value_irnt, p = 1 AS is_largest, round({normal_quantile('h')}, 7) AS value_irnt_finite FROM ({SHARE}) s")
def _(spark, d):
    e = fx.table(spark, d, "events").select("event_id", "value")
    out = ranking.irnt(ranking.irnt(e, "value"), "value", "value_irnt_finite", offset=True)
    out = out.withColumn("is_largest", F.col("value_irnt") == float("inf"))
    return rounded(out.withColumn("value_irnt", F.when(~F.col("is_largest"), F.col("value_irnt"))), "value_irnt", "value_irnt_finite", digits=7)


@query("win5_first_icu_date", f"SELECT Subject_ID, cast({_pick('arg_min', 'Event_Date', f'ICU_Status AND {IN}')} AS VARCHAR) AS first_icu_date FROM fx_clinical GROUP BY Subject_ID")
def _(spark, d):
    return visits(spark, d).groupBy("Subject_ID").agg(cl.first_icu_date(ORDER).cast("string").alias("first_icu_date"))


DATES = f"""SELECT Subject_ID, {_pick('arg_min', 'COVID19_Symptoms_Reported_Onset_Date')} AS o, {_pick('arg_min', 'COVID19_Encounter_Start_Date')} AS s,
  {_pick('arg_min', 'COVID19_Encounter_End_Date')} AS e, {_pick('arg_min', 'Event_Date', f'ICU_Status AND {IN}')} AS i FROM fx_clinical GROUP BY Subject_ID"""
DATE_PHENOTYPES = f"""SELECT Subject_ID, cast(i AS VARCHAR) AS first_icu_date, CASE WHEN s - o BETWEEN 0 AND 30 THEN cast(s - o AS DOUBLE) END AS days_onset_to_encounter,
  CASE WHEN o IS NULL OR s - o >= 0 THEN cast(e - s AS DOUBLE) END AS covid_encounter_days, CASE WHEN i - o >= 0 THEN cast(i - o AS DOUBLE) END AS days_onset_to_icu,
  CASE WHEN i - s BETWEEN 0 AND 60 THEN cast(i - s AS DOUBLE) END AS days_encounter_to_icu FROM ({DATES}) q"""


@query("prj15_date_phenotypes", DATE_PHENOTYPES)
def _(spark, d):
    return cl.date_phenotypes(visits(spark, d), ORDER).withColumn("first_icu_date", F.col("first_icu_date").cast("string"))


@query("prj16_recruitment_day", """SELECT o_orderkey, cast(cast(o_orderdate AS DATE) - min(cast(o_orderdate AS DATE)) OVER () AS DOUBLE) AS recruitment_date FROM orders""")
def _(spark, d):
    return cl.recruitment_day(fx.table(spark, d, "orders").selectExpr("o_orderkey", "cast(o_orderdate AS DATE) AS recruitment_date"))


@query("prj13_age_sex_terms", """SELECT c_custkey, age, left(sex, 1) AS sex, CASE WHEN sex = 'Female' THEN age ELSE 0 END AS age_sex, age * age AS age_squared
  FROM (SELECT c_custkey, cast(20 + c_custkey % 70 AS INT) AS age, CASE c_nationkey % 3 WHEN 0 THEN 'Female' WHEN 1 THEN 'Male' END AS sex FROM customer) c""")
def _(spark, d):
    return cl.add_age_sex_terms(fx.sql(spark, d, """SELECT c_custkey, cast(20 + c_custkey % 70 AS INT) AS age,
      CASE c_nationkey % 3 WHEN 0 THEN 'Female' WHEN 1 THEN 'Male' END AS sex FROM customer"""))


@query("prj14_is_hispanic", """SELECT Subject_ID, Visit_Order, CASE WHEN Ethnicity_From_Consent = 'Unknown / Not Reported' THEN NULL
  ELSE Ethnicity_From_Consent = 'Hispanic or Latino' END AS is_hispanic FROM fx_clinical""")
def _(spark, d):
    return visits(spark, d).select("Subject_ID", "Visit_Order", cl.is_hispanic(F.col("Ethnicity_From_Consent")).alias("is_hispanic"))


@query("prj17_severity_scales", f"""SELECT Subject_ID, severity_at_admission, coalesce(severity_at_admission >= 2, false) AS severe_at_admission,
  coalesce(severity_at_admission = 3, false) AS eod_at_admission, coalesce(severity_at_discharge >= 2, false) AS severe_at_discharge,
  coalesce(severity_at_discharge = 3, false) AS eod_at_discharge, CASE WHEN deceased THEN 4e0 ELSE max_severity_3value END AS max_severity_4value FROM ({ROLLUP}) q""")
def _(spark, d):
    return cl.severity_scales(cl.clinical_rollup(visits(spark, d), ORDER)).select(
        "Subject_ID", "severity_at_admission", "severe_at_admission", "eod_at_admission", "severe_at_discharge", "eod_at_discharge", "max_severity_4value")


CONTRASTS = f"""SELECT q.Subject_ID, recovered, discharged AND NOT deceased AS discharged, deceased, recovered AND NOT deceased AS recovered_not_deceased,
  CASE WHEN deceased THEN true WHEN recovered THEN false END AS deceased_vs_recovered,
  CASE WHEN deceased THEN true WHEN discharged AND NOT deceased THEN false END AS deceased_vs_discharged,
  CASE WHEN deceased THEN 8e0 ELSE max_who END AS max_who, severity_ever_increased OR deceased AS severity_ever_increased_counting_death,
  severity_ever_decreased OR (discharged AND NOT deceased) AS severity_ever_decreased_counting_discharge
  FROM ({ROLLUP}) q LEFT JOIN ({_trend(CODE, 'severity', IN)}) t ON t.Subject_ID = q.Subject_ID"""
CONTRAST_COLUMNS = ["Subject_ID", "recovered", "discharged", "deceased", "recovered_not_deceased", "deceased_vs_recovered",
                    "deceased_vs_discharged", "max_who", "severity_ever_increased_counting_death", "severity_ever_decreased_counting_discharge"]


def _contrasts(spark, d):
    v = visits(spark, d)
    severity = trends.ever_changed(v.where(IN).withColumn("_s", cl.severity_code()), ["Subject_ID"], ORDER, "_s", "severity")
    return cl.contrast_phenotypes(cl.clinical_rollup(v, ORDER).join(severity, "Subject_ID", "left")).select(CONTRAST_COLUMNS)


@query("prj19_contrasts", CONTRASTS)
def _(spark, d):
    return _contrasts(spark, d)


@query("prj18_invert_outcomes", f"""SELECT Subject_ID, NOT recovered AS recovered, NOT discharged AS discharged, NOT recovered_not_deceased AS recovered_not_deceased,
  NOT severity_ever_decreased_counting_discharge AS severity_ever_decreased_counting_discharge, deceased FROM ({CONTRASTS}) c""")
def _(spark, d):
    return cl.invert_outcomes(_contrasts(spark, d)).select(
        "Subject_ID", "recovered", "discharged", "recovered_not_deceased", "severity_ever_decreased_counting_discharge", "deceased")


@query("prj20_log_phenotype", "SELECT event_id, round(ln(1 + value), 8) AS value_log FROM events")
def _(spark, d):
    return rounded(cl.log_phenotype(fx.table(spark, d, "events").select("event_id", "value"), "value").select("event_id", "value_log"), "value_log")


FLOWCELLS = """SELECT concat('P', cast(s_suppkey AS STRING), 'T1') AS sample, CASE s_suppkey % 4 WHEN 0 THEN 'HA' WHEN 1 THEN 'HA+HB' WHEN 2 THEN 'HB+HC+HD' ELSE 'HD' END AS flowcells FROM supplier"""
HOT = ", ".join(f"cast(('+' || flowcells || '+') LIKE '%+{f}+%' AS INT) AS flowcell_{f}" for f in ("HA", "HB", "HC", "HD"))


@query("prj21_one_hot_flowcells", f"SELECT sample, {HOT} FROM ({FLOWCELLS}) f")
def _(spark, d):
    return cl.one_hot(fx.sql(spark, d, FLOWCELLS), "sample", "flowcells", "flowcell_", "+")


@query("prj30_multi_batch", f"SELECT substr(sample, 1, length(sample) - 2) AS \"Subject_ID\", flowcells LIKE '%+%' AS multi_batch, {HOT} FROM ({FLOWCELLS}) f WHERE sample <> 'P7T1'")
def _(spark, d):
    return dm.flowcell_columns(fx.sql(spark, d, FLOWCELLS), ["P7T1"])


LOADS = """SELECT event_id AS row, user_id AS Subject_ID, value AS bitscore FROM events WHERE event_type = 'purchase' AND user_id % 4 <> 1"""


@query("prj29_viral_load", f"""SELECT q.Subject_ID, b AS blood_viral_load_bitscore, CASE WHEN s THEN b END AS blood_viral_load_bitscore_severe_only,
  CASE WHEN covid_encounter THEN b IS NOT NULL END AS blood_viral_load_detected, CASE WHEN s AND covid_encounter THEN b IS NOT NULL END AS blood_viral_load_detected_severe_only
  FROM (SELECT *, severity_ever_severe OR severity_ever_eod AS s FROM ({ROLLUP}) r) q LEFT JOIN (SELECT Subject_ID, arg_min(bitscore, row) AS b FROM ({LOADS}) l GROUP BY Subject_ID) l
  ON l.Subject_ID = q.Subject_ID""")
def _(spark, d):
    out = cl.viral_load_phenotypes(cl.clinical_rollup(visits(spark, d), ORDER), fx.sql(spark, d, LOADS))
    return out.select("Subject_ID", "blood_viral_load_bitscore", "blood_viral_load_bitscore_severe_only", "blood_viral_load_detected", "blood_viral_load_detected_severe_only")


REPLICATION = """SELECT user_id AS Subject_ID, event_id AS Visit_Order, cast(ts AS DATE) AS Event_Date, cast(30 + user_id % 50 AS INT) AS AGE,
  CASE WHEN user_id % 2 = 0 THEN 'Female' ELSE 'Male' END AS GENDER, cast(cast(floor(value) AS BIGINT) % 9 AS DOUBLE) AS WHO_Ordinal,
  CASE WHEN user_id % 8 < 3 THEN 'Moderate COVID-19' WHEN event_type = 'click' THEN 'Severe COVID-19' WHEN event_type = 'purchase' THEN 'Severe COVID-19 with EOD' END AS Severity,
  (event_type <> 'view') AS COVID19_Positive, cast(DATE '2023-12-25' + cast(event_id % 23 AS INT) AS DATE) AS Encounter_Start_Date,
  cast(DATE '2023-12-25' + cast(event_id % 23 + user_id % 31 AS INT) AS DATE) AS Encounter_End_Date FROM events"""
SPAN = f"""SELECT Subject_ID, CASE WHEN min(Encounter_End_Date) - min(Encounter_Start_Date) <= 15 THEN cast(min(Encounter_End_Date) - min(Encounter_Start_Date) AS DOUBLE) END
  AS covid_encounter_days FROM ({REPLICATION}) r WHERE COVID19_Positive GROUP BY Subject_ID"""
PCS = """SELECT vec_id AS Subject_ID, embedding FROM embeddings"""


@query("prj28_encounter_days", SPAN)
def _(spark, d):
    return cl.encounter_days(fx.sql(spark, d, REPLICATION))


@query("joi15_replication_matrix", f"""WITH rep AS ({REPLICATION}) SELECT b.*, NOT coalesce(w.who_ever_decreased, false) AS who_ever_decreased, coalesce(w.who_ever_increased, false) AS who_ever_increased,
    NOT coalesce(s.severity_ever_decreased, false) AS severity_ever_decreased, coalesce(s.severity_ever_increased, false) AS severity_ever_increased, covid_encounter_days,
    round(ln(1 + covid_encounter_days), 8) AS covid_encounter_days_log, {', '.join(f'round(cast(embedding[{i}] AS DOUBLE), 6) AS pc{i}' for i in range(1, 11))}
  FROM (SELECT Subject_ID, max(AGE) AS age, max(left(GENDER, 1)) AS sex, max(WHO_Ordinal) AS max_who, max(WHO_Ordinal) FILTER (WHO_Ordinal < 8) AS max_who_minus_death,
    bool_or(coalesce({CODE} = 2, false)) AS severity_ever_severe, bool_or(coalesce({CODE} = 3, false)) AS severity_ever_eod, coalesce(max({CODE}) = 1, false) AS max_severity_moderate,
    max(CASE WHEN GENDER = 'Female' THEN AGE ELSE 0 END) AS age_sex, max(AGE * AGE) AS age_squared FROM rep GROUP BY Subject_ID) b
  LEFT JOIN ({_trend('WHO_Ordinal', 'who', 'true', 0, 'rep')}) w ON w.Subject_ID = b.Subject_ID LEFT JOIN ({_trend(CODE, 'severity', 'true', 0, 'rep')}) s ON s.Subject_ID = b.Subject_ID
  LEFT JOIN ({SPAN}) e ON e.Subject_ID = b.Subject_ID JOIN ({PCS}) p ON p.Subject_ID = b.Subject_ID WHERE b.Subject_ID NOT IN (SELECT s_suppkey * 3 FROM supplier)""")
def _(spark, d):
    pcs = fx.sql(spark, d, PCS).select("Subject_ID", *[r(F.col("embedding")[i], 6).alias(f"v{i}") for i in range(12)])
    excluded = fx.table(spark, d, "supplier").selectExpr("s_suppkey * 3 AS Subject_ID")
    return rounded(dm.replication_matrix(fx.sql(spark, d, REPLICATION), excluded, pcs, ORDER), "covid_encounter_days_log")


BATCHES = "SELECT DISTINCT concat('B', cast(o_orderkey % 500 AS STRING)) AS sample, concat('TD', cast(o_orderkey % 4 AS STRING)) AS batch FROM orders WHERE o_orderkey % 500 % 3 = 0"
MATRIX = f"""SELECT q.Subject_ID, q.age, left(q.sex, 1) AS sex, cast(q.recruitment_date - min(q.recruitment_date) OVER () AS DOUBLE) AS recruitment_date,
  any_comorbidity, post_acute_symptoms, HGI_post_acute_NQ13, days_onset_to_encounter, covid_encounter_days, CASE WHEN icu_hours_cumulative <> 0 THEN icu_hours_cumulative END AS icu_hours_cumulative,
  sofa_ever_increased, NOT sofa_ever_decreased AS sofa_ever_decreased, NOT q.recovered AS recovered, CASE WHEN deceased THEN 8e0 ELSE q.max_who END AS max_who,
  gsa_batch, multi_batch, flowcell_HA, flowcell_HD, round(cast(embedding[1] AS DOUBLE), 6) AS pc1, round(cast(embedding[10] AS DOUBLE), 6) AS pc10, round(cast(embedding[2] AS DOUBLE), 6) AS eur_pc2_imputed
  FROM ({ROLLUP}) q LEFT JOIN ({ANY}) a ON a.Subject_ID = q.Subject_ID LEFT JOIN ({POST}) pa ON pa.Subject_ID = q.Subject_ID LEFT JOIN ({DATE_PHENOTYPES}) dp ON dp.Subject_ID = q.Subject_ID
  LEFT JOIN ({HOURS}) h ON h.Subject_ID = q.Subject_ID LEFT JOIN ({_trend('SOFA_Score', 'sofa', IN)}) t ON t.Subject_ID = q.Subject_ID
  LEFT JOIN (SELECT Subject_ID, {_pick('arg_min', 'batch')} AS gsa_batch FROM fx_clinical JOIN ({BATCHES}) b ON b.sample = Uncorrected_Blood_Sample GROUP BY Subject_ID) g ON g.Subject_ID = q.Subject_ID
  LEFT JOIN (SELECT substr(sample, 2, length(sample) - 3) AS k, flowcells LIKE '%+%' AS multi_batch, {HOT} FROM ({FLOWCELLS}) f) f ON f.k = cast(q.Subject_ID AS STRING)
  LEFT JOIN ({PCS}) p ON p.Subject_ID = q.Subject_ID"""


def _matrix(spark, d):
    pcs = fx.sql(spark, d, PCS).select("Subject_ID", *[r(F.col("embedding")[i], 6).alias(f"v{i}") for i in range(12)])
    cells = fx.sql(spark, d, FLOWCELLS).withColumn("sample", F.expr("substr(sample, 2)"))
    batches = fx.sql(spark, d, BATCHES)
    return dm.design_matrix(visits(spark, d), flowcells=cells, batches=batches, components={("", ""): pcs, ("eur_", "_imputed"): pcs},
                            transforms=[], order=ORDER)


@query("joi14_design_matrix", MATRIX)
def _(spark, d):
    return _matrix(spark, d).select(
        "Subject_ID", "age", "sex", "recruitment_date", "any_comorbidity", "post_acute_symptoms", "HGI_post_acute_NQ13", "days_onset_to_encounter",
        "covid_encounter_days", "icu_hours_cumulative", "sofa_ever_increased", "sofa_ever_decreased", "recovered", "max_who", "gsa_batch", "multi_batch",
        "flowcell_HA", "flowcell_HD", "pc1", "pc10", "eur_pc2_imputed")


@query("joi14_design_matrix_transformed")
def _(spark, d):
    loads = fx.sql(spark, d, LOADS)
    return dm.design_matrix(visits(spark, d), viral_loads=loads, transforms=["max_sofa", "days_onset_to_encounter", "blood_viral_load_bitscore"], order=ORDER).drop(
        "first_icu_date")


@query("prj27_phenotype_table", f"""SELECT Subject_ID AS "FID", Subject_ID AS "IID", cast(HGI_post_acute_NQ13 AS INT) AS "HGI_post_acute_NQ13",
  cast(HGI_post_acute_NQ23 AS INT) AS "HGI_post_acute_NQ23" FROM ({POST}) p""")
def _(spark, d):
    return dm.phenotype_table(cl.post_acute(visits(spark, d)), ["HGI_post_acute_NQ13", "HGI_post_acute_NQ23"])


@query("prj27_covariate_table", f"""SELECT Subject_ID AS "FID", Subject_ID AS "IID", age, CASE WHEN sex = 'M' THEN 1 ELSE 0 END AS "sex_M", CASE WHEN sex = 'F' THEN age ELSE 0 END AS age_sex, age * age AS age_squared,
  recruitment_date, flowcell_HA, flowcell_HD, {', '.join(f"CASE WHEN gsa_batch = 'TD{i}' THEN 1 ELSE 0 END AS \"gsa_batch_TD{i}\"" for i in range(4))}, pc1, pc10, eur_pc2_imputed FROM ({MATRIX}) m""")
def _(spark, d):
    return dm.covariate_table(_matrix(spark, d)).select("FID", "IID", "age", "sex_M", "age_sex", "age_squared", "recruitment_date", "flowcell_HA", "flowcell_HD",
                                                        *[f"gsa_batch_TD{i}" for i in range(4)], "pc1", "pc10", "eur_pc2_imputed")
