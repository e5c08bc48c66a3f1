"""The driver's contract, and the SQL check of one query per family (CIVICFRAME_ALL=1 runs all)."""

import os

import pytest

import __spark_entry__ as entry_points
from tests.check_oracle import compare, duck

DIRECTORY = "/root/testdata/sf0.001"
FAST = (
    "s4_cross_party_donors", "s5_moving_average_top_recipients", "a9_key_value_table", "a11_heading_and_list_text",
    "a12_profile_sections", "a16_latest_response", "b10_dictionary_recode", "b13_quality_flags", "b20_first_per_key",
    "b25_check_suite", "c4_full_join_chain", "c11_key_audit", "d8_group_median", "d14_pivot_wide", "d20_right_closed_bins",
    "d21_threshold_curve", "d25_h_index", "e1_running_sum", "e4_rank_deciles", "e5_value_deciles", "f6_random_split",
    "f9_poisson_bootstrap", "h7_phone_format", "h13_jaro_winkler", "i5_cluster_robust_ols", "i10_placebo_outcome_hc2",
    "i11_permutation_test", "i15_bh_adjust", "i28_rolling_backtest", "i31_kaplan_meier", "j4_tfidf", "k1_validate_records",
    "k7_merge_chunks", "l6_pagerank", "m5_points_in_polygons", "m8_rasterize", "n3_comparison_vectors", "n9_precision_recall",
    "t1_daily_monitor",
)
ALL = os.environ.get("CIVICFRAME_ALL") == "1"


def test_entry_runs(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["id", "name", "gift_date", "amount", "cumulative_amount", "moving_avg"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(entry_points.oracle_sql()) if ALL else FAST)
def test_same_rows_as_sql(spark, name):
    df = entry_points.queries()[name](spark, DIRECTORY)
    problem, _ = compare(df, duck(DIRECTORY), entry_points.oracle_sql()[name])
    assert problem is None, problem
