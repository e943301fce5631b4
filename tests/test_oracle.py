"""Every query with an oracle returns exactly what DuckDB returns."""

import pytest

import __spark_entry__ as entry
from tests import oracle

# large all-pairs joins with no equality condition must not appear anywhere
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_matches_oracle(spark, con, sf_dir, name):
    _, problem = oracle.compare(spark, con, name, sf_dir)
    assert problem in (None, "no rows"), problem


def test_names_and_keys():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 180


PLANNED = [
    "A9_percentile_rank", "D7_drift_report", "EV16_metrics_per_split", "F3_spearman", "P14_feature_statistics",
    "PM4_run_summary", "S6_oversample", "S8_smote", "S9_adasyn", "S10_tomek_links", "W5_rolling_over_cut_ranges",
    "W6_entity_rolling", "B7_feedback_metrics", "EV5_threshold_sweep", "PM6_weekly_drift",
]


@pytest.mark.parametrize("name", PLANNED)
def test_no_all_pairs_join(spark, sf_dir, name):
    df = entry.queries()[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(bad in plan for bad in FORBIDDEN), plan


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["Class", "hour", "n", "amount_mean", "amount_log_mean", "v_mean", "v_std"]
    assert df.count() > 24
