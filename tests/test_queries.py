"""Registered queries against their SQL. All of them with WATTLOOM_ALL=1, otherwise
a selection that covers each family."""

import os

import pytest

from tests.compare import connect, differences
from wattloom.catalog import CHECK_SQL, QUERIES

SF = "/root/testdata/sf0.001"
SELECTED = [
    "p01_sensor_split", "p02_pivot_key", "p06_drop_null_rows", "p09_numeric_coercion",
    "p10_envelope_routing", "j02_align_predictions", "j05_schedule_lookup", "j07_calendar_spine",
    "a01_pivot_mean", "a02_resample_mean", "a09_appliance_realism", "a11_daily_stats",
    "a15_validate_feature", "a17_shared_density", "a18_residual_histogram", "a19_ingest_counts",
    "a22_weekend_spans", "w02_back_fill", "w03_temporal_split", "w04_contiguous_folds",
    "w05_prefix_subset", "w07_empirical_cdf", "f02_parse_timestamp", "f06_half_even_round",
    "f10_json_decode", "f12_topics", "m02_linear_regression", "m05_two_sample_ks",
    "m07_evaluate", "m08_paired_t_test", "m09_train_test_gap", "m10_cv_stability",
    "m12_learning_curve", "m13_residual_moments", "m14_permutation_importance",
    "m15_feature_power", "m14_fitted_fifty_repeats", "m15_fitted_fifty_repeats", "s03_load_wide", "s04_load_long", "s05_headerless",
    "s08_load_smart_home", "st01_ingest", "st03_status_check", "st04_running_counters",
    "st06_stream_bins", "k02_build_features", "k02_all_sensors", "k02_mixed_folder",
    "a01_sensors_as_rows", "a03_a04_a05_over_all_sensors",
]
NAMES = sorted(QUERIES) if os.environ.get("WATTLOOM_ALL") else SELECTED


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_names_exist():
    assert set(SELECTED) <= set(QUERIES)
    assert set(CHECK_SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    if name in CHECK_SQL:
        assert differences(df, con, CHECK_SQL[name]) is None
    else:
        assert df.count() > 0
