"""Stand-in genotype, visit and statistics views over the driver's tables.

Each view is plain SQL that Spark and DuckDB both accept; ``with_views`` puts
the needed ones in front of an oracle query as common table expressions.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_GT = """CASE WHEN h3 = 0 THEN NULL ELSE (CASE WHEN h1 < f THEN 1 ELSE 0 END) + (CASE WHEN h2 < f THEN 1 ELSE 0 END) END"""
_HASHES = """variant_key, sample_key, 5 + (variant_key * 37) % 400 AS f,
  (variant_key * 7919 + sample_key * 104729 + variant_key * sample_key * 31 + sample_key * sample_key * 17) % 1009 AS h1,
  (variant_key * 6101 + sample_key * 15013 + variant_key * sample_key * 57 + sample_key * sample_key * 29) % 1013 AS h2,
  (variant_key * 13 + sample_key * 7 + variant_key * sample_key) % (11 + variant_key % 30) AS h3"""

VIEWS: dict[str, str] = {
    "fx_variants": """SELECT p_partkey AS variant_key,
  concat('chr', cast(p_partkey % 22 + 1 AS STRING)) AS contig,
  cast(1000 + 5000 * floor(p_partkey / 22e0) + p_partkey % 7 AS BIGINT) AS pos,
  CASE p_partkey % 4 WHEN 0 THEN 'A' WHEN 1 THEN 'C' WHEN 2 THEN 'G' ELSE 'T' END AS ref,
  CASE p_partkey % 4 WHEN 0 THEN 'G' WHEN 1 THEN 'T' WHEN 2 THEN 'C' ELSE 'A' END AS alt
FROM part""",
    "fx_samples": """SELECT s_suppkey AS sample_key, s_acctbal AS trait,
  CASE WHEN s_acctbal > 5000 THEN 1 ELSE 0 END AS is_case, s_nationkey AS grp, s_suppkey % 2 AS is_female
FROM supplier""",
    # The oracle spells the variants-by-samples grid as a cross join; Spark
    # generates the sample keys per variant (see ``entries``).
    "fx_entries": f"""SELECT variant_key, sample_key, {_GT} AS gt, cast(20 + h1 % 60 AS INT) AS gq, cast(15 + h2 % 30 AS INT) AS dp
FROM (SELECT {_HASHES} FROM (SELECT p_partkey AS variant_key, s_suppkey AS sample_key FROM part CROSS JOIN supplier) g) q""",
    "fx_visits": """SELECT user_id AS subject_id, ts AS visit_ts, event_id AS visit_id,
  cast(cast(floor(value) AS BIGINT) % 9 AS DOUBLE) AS who_score,
  CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 1 WHEN 'purchase' THEN 2 ELSE NULL END AS severity_code,
  (event_type = 'error') AS icu_status, (event_type <> 'signup') AS within_encounter
FROM events""",
    "fx_clinical": """SELECT user_id AS Subject_ID, event_id AS Visit_Order, cast(ts AS DATE) AS Event_Date,
  cast(30 + user_id % 50 + event_id % 2 AS INT) AS Age, CASE WHEN user_id % 2 = 0 THEN 'Female' ELSE 'Male' END AS Sex,
  CASE user_id % 4 WHEN 0 THEN 'White' WHEN 1 THEN 'Black' WHEN 2 THEN 'Asian' END AS Race_From_Consent,
  CASE user_id % 5 WHEN 0 THEN 'Hispanic or Latino' WHEN 1 THEN 'Unknown / Not Reported' WHEN 3 THEN 'Not Hispanic or Latino' END AS Ethnicity_From_Consent,
  CASE WHEN event_id % 6 <> 0 THEN user_id % 7 <> 0 END AS COVID19_Ever_Positive,
  (event_type <> 'signup' AND user_id % 7 <> 0) AS COVID19_Within_Encounter,
  cast(DATE '2020-03-01' + cast(user_id % 90 AS INT) AS DATE) AS Date_Of_First_Sample,
  CASE WHEN event_id % 10 <> 9 THEN event_type = 'error' END AS ICU_Status,
  CASE WHEN event_type = 'error' THEN cast((event_id * 7) % 50 AS DOUBLE) END AS ICU_Hours_Since_Entry,
  CASE WHEN event_id % 4 <> 0 THEN cast((event_id * 11) % 9 AS DOUBLE) END AS SOFA_Score,
  cast(cast(floor(value) AS BIGINT) % 9 AS DOUBLE) AS WHO_Ordinal,
  (user_id % 11 = 0 AND event_type = 'purchase') AS COVID19_Deceased_Within_Encounter,
  CASE WHEN user_id % 3 = 0 AND event_type = 'click' THEN 'Recovered' ELSE 'Not recovered' END AS SARSCoV2_Recovery_Status,
  CASE WHEN user_id % 4 <> 0 AND event_type = 'view' THEN cast(ts AS DATE) END AS Encounter_Discharge_Date,
  CASE WHEN event_id % 3 = 0 THEN value END AS Serology_Highest_Titer,
  CASE WHEN event_id % 5 = 0 THEN value * 2 END AS Serology_Highest_Titer_AGM_Only,
  CASE WHEN user_id % 8 < 3 THEN 'Moderate COVID-19' WHEN event_type = 'view' THEN 'Moderate COVID-19'
    WHEN event_type = 'click' THEN 'Severe COVID-19' WHEN event_type = 'purchase' THEN 'Severe COVID-19 with EOD' END AS Severity,
  CASE WHEN event_id % 2 = 0 THEN value * 3 END AS Viral_Load_CN1_per_mL, CASE WHEN event_id % 2 = 1 THEN value * 5 END AS Viral_Load_CN2_per_mL,
  value * 7 AS Viral_Load_CN3_per_mL,
  CASE WHEN event_id % 2 = 0 THEN user_id % 9 = 1 END AS COMORBID_Asthma, (event_id % 600 = 7) AS ENCOUNTER_COMORBID_Diabetes,
  (event_id % 200 = 3) AS Post_COVID19_Symptom_Cough, true AS Post_COVID19_Symptom_None, (event_id % 300 = 4) AS Post_COVID19_New_Fatigue,
  CASE WHEN event_id % 140 = 5 THEN 'Worse' WHEN event_id % 2 = 0 THEN 'Same' END AS Post_COVID19_Quality_Of_Life,
  CASE WHEN user_id % 3 = 1 THEN 'visit' END AS Post_COVID19_Event_Name,
  CASE WHEN event_id % 3 <> 0 THEN cast(DATE '2023-12-20' + cast(user_id % 40 AS INT) AS DATE) END AS COVID19_Symptoms_Reported_Onset_Date,
  cast(DATE '2023-12-25' + cast(user_id % 23 AS INT) AS DATE) AS COVID19_Encounter_Start_Date,
  cast(DATE '2023-12-25' + cast(user_id % 23 + user_id % 31 AS INT) AS DATE) AS COVID19_Encounter_End_Date,
  concat('B', cast(event_id % 500 AS STRING)) AS Uncorrected_Blood_Sample
FROM events""",
    "fx_assoc": """SELECT variant_key, contig, pos, alt AS effect_allele, ref AS other_allele,
  ((variant_key * 37) % 101 - 50) / 200e0 AS est, 5e-2 + ((variant_key * 13) % 17) / 100e0 AS se,
  1e-2 + ((variant_key * 29) % 480) / 1000e0 AS freq, 600 AS n_obs
FROM fx_variants""",
    "fx_eqtl": """SELECT concat('GENE', cast(p.p_partkey % 22 + 1 AS STRING)) AS probe_id, v.variant_key, v.contig, v.pos,
  CASE WHEN v.variant_key % 3 = 0 THEN v.ref ELSE v.alt END AS a1,
  CASE WHEN v.variant_key % 3 = 0 THEN v.alt WHEN v.variant_key % 11 = 0 THEN 'T' ELSE v.ref END AS a2,
  ((v.variant_key * 53) % 97 - 48) / 150e0 AS beta, 4e-2 + ((v.variant_key * 7) % 19) / 100e0 AS se,
  1e-2 + ((v.variant_key * 31) % 480) / 1000e0 AS maf, 948 AS n
FROM part p JOIN fx_variants v ON v.variant_key = p.p_partkey""",
    "fx_genes": """SELECT n_nationkey AS gene_key, n_name AS gene_id, concat('chr', cast(n_nationkey % 22 + 1 AS STRING)) AS contig,
  cast(500 + 400 * n_nationkey AS BIGINT) AS start_pos, cast(500 + 400 * n_nationkey + 60000 AS BIGINT) AS end_pos
FROM nation""",
}

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _names(sql: str, known) -> list[str]:
    return [w for w in known if re.search(rf"\b{w}\b", sql)]


def ctes(sql: str) -> list[tuple[str, str]]:
    """The views ``sql`` needs, in dependency order."""
    found: dict[str, str] = {}

    def visit(text: str) -> None:
        for name in _names(text, VIEWS):
            if name not in found:
                visit(VIEWS[name])
                found[name] = VIEWS[name]

    visit(sql)
    return list(found.items())


def with_views(sql: str) -> str:
    """Prefix ``sql`` (which may start with its own WITH) with the views it uses."""
    views = ctes(sql)
    if not views:
        return sql
    head = ",\n".join(f"{n} AS ({q})" for n, q in views)
    body = sql.strip()
    if body[:5].upper() == "WITH ":
        return f"WITH {head},\n{body[5:]}"
    return f"WITH {head}\n{body}"


SAMPLE_STEP = 4096
#: Calls that a task generates at most, about.
TASK_CALLS = 1 << 26


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One genotype call per variant and sample.

    Every variant generates its own sample keys in steps, so the grid needs no
    join and stays partitioned like the variant table.
    """
    suppliers = table(spark, sf_dir, "supplier")
    top, rows = suppliers.agg(F.max("s_suppkey"), F.countDistinct("s_suppkey")).first()
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("variant_key"))
    cores = spark.sparkContext.defaultParallelism
    tasks = max(cores, int(spark.conf.get("spark.sql.shuffle.partitions")), -(-parts.count() * rows // TASK_CALLS))
    parts = parts.repartition(tasks, "variant_key")
    # The terms of the hashes that are a variant's own are worked out once, not per call.
    parts = parts.selectExpr(
        "variant_key", "5 + (variant_key * 37) % 400 AS f", "11 + variant_key % 30 AS m3", "variant_key * 7919 AS a1", "variant_key * 31 + 104729 AS b1",
        "variant_key * 6101 AS a2", "variant_key * 57 + 15013 AS b2", "variant_key * 13 AS a3", "variant_key + 7 AS b3")
    step = F.lit(SAMPLE_STEP).cast("long")
    grid = (
        parts.withColumn("low", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(top).cast("long"), step)))
        .withColumn("sample_key", F.explode(F.sequence(F.col("low"), F.least(F.col("low") + step - 1, F.lit(top).cast("long")))))
        .drop("low")
    )
    if rows != top + 1:
        grid = grid.join(suppliers.select(F.col("s_suppkey").alias("sample_key")), "sample_key", "left_semi")
    return grid.selectExpr(
        "variant_key", "sample_key", "f", "(a1 + (b1 + sample_key * 17) * sample_key) % 1009 AS h1",
        "(a2 + (b2 + sample_key * 29) * sample_key) % 1013 AS h2", "(a3 + b3 * sample_key) % m3 AS h3",
    ).selectExpr(
        "variant_key", "sample_key", f"{_GT} AS gt", "cast(20 + h1 % 60 AS INT) AS gq", "cast(15 + h2 % 30 AS INT) AS dp"
    )


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A stand-in view as a DataFrame."""
    if name == "fx_entries":
        return entries(spark, sf_dir)
    return sql(spark, sf_dir, f"SELECT * FROM {name}")


def sql(spark: SparkSession, sf_dir: str, query: str) -> DataFrame:
    """Run plain SQL on the driver tables and views (not on ``fx_entries``)."""
    text = with_views(query)
    used = _names(text, TABLES)
    args = {}
    for name in used:
        text = re.sub(rf"\b(FROM|JOIN)\s+{name}\b", rf"\1 {{{name}}}", text, flags=re.IGNORECASE)
        args[name] = table(spark, sf_dir, name)
    text = re.sub(r"\{(\w+)\}(?!\s+(?:AS\s+)?(?:[a-z]\b|src\b))", r"{\1} \1", text)
    return spark.sql(text, **args)
