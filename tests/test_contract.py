"""Registered queries against their SQL on the smallest tables."""

import sys

import duckdb
import pytest

sys.path.insert(0, "tools")

import __spark_entry__ as contract
from check_oracle import normal
from genolith.fixtures import TABLES

SF = "/root/testdata/sf0.001"
QUICK = [
    "agg1_sample_qc", "agg2_variant_qc", "agg3_call_stats", "agg4_qc_histogram", "agg6_impute_sex", "flt3_variants_qc", "flt6_ac_by_phenotype", "prj2_split_multi",
    "prj3_split_r_sum", "prj4_split_g_min", "joi1_subset_samples", "joi4_restrict_to_bed", "joi16_intersect_sites", "agg15_concordance_by_sample",
    "agg8_clinical_rollup", "agg9_post_acute", "prj15_date_phenotypes", "prj19_contrasts", "joi15_replication_matrix", "win1_severity_ever_changed",
    "win2_resettable_hours", "win3_percentile_rank_by_group", "win9_qq_table", "win11_bh_adjust", "win13_adjust_by_phenotype", "agg18_gwas_report",
    "gwa1_score_test", "agg17_case_control_n", "met1_meta_analysis", "gen1_gene_burden", "prj8_mrmega_binary", "flt12_functional", "prj24_most_severe",
    "agg10_median_expression", "joi9_allele_aware_merge", "agg19_remove_duplicates", "prj9_harmonize_gwas", "prj12_cohort_eqtl", "prx1_gene_association",
    "go2_term_closure", "joi20_cluster_names", "src1_read_table", "src7_sniffed_sumstats", "src9_flowcells", "snk5_grm_triplets", "kin1_robust_kinship",
]


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries()) and len(contract.queries()) > 150


@pytest.mark.parametrize("name", QUICK)
def test_against_sql(spark, oracle, name):
    got = normal(contract.queries()[name](spark, SF).toPandas())
    want = normal(oracle.execute(contract.oracle_sql()[name]).df())
    assert list(got.columns) == list(want.columns)
    assert got.equals(want)


def test_entry(spark):
    df = contract.entry(spark)
    assert {"variant_key", "score_pval", "bonferroni"} <= set(df.columns) and df.count() > 0
