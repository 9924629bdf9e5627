"""Plan shape: the panel shuffles once for binning and once by entity; every
later window and per-entity aggregate reuses that partitioning."""

import pytest

import __spark_entry__ as E
from panelkit.plans.inspect import has_operator, shuffle_count
from tests.conftest import SF_SMALL

TWO_SHUFFLES = ["flagship_kpis", "p_fill_event_hourly", "w_features_event_hourly", "d_decompose_event_hourly",
                "o_outliers_event", "o_residual_stats", "d_model_detect_event", "e_acf_event_returns"]


@pytest.mark.parametrize("name", TWO_SHUFFLES)
def test_two_shuffles(spark, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
    df = E.queries()[name](spark, SF_SMALL)
    assert shuffle_count(df) <= 2, name


@pytest.mark.parametrize("name", ["flagship_kpis", "d_model_detect_event", "p_resample_last", "o_outlier_summary"])
def test_hash_aggregates_only(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    assert not has_operator(df, "SortAggregate")


@pytest.mark.parametrize("name", ["t_display_ranking", "a_correlation", "e_event_labels", "a_kde", "k_landing_subset"])
def test_no_cartesian(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    assert not has_operator(df, "CartesianProduct") and not has_operator(df, "BroadcastNestedLoopJoin")


def test_scan_pruning_and_pushdown(spark):
    df = E.queries()["s_panel_scan"](spark, SF_SMALL)
    from panelkit.plans.inspect import physical_plan

    plan = physical_plan(df)
    orders_scan = [ln for ln in plan.split("\n") if "FileScan parquet" in ln and "o_orderdate" in ln][0]
    # the date range reaches the scan, and only the needed columns are read
    assert "GreaterThanOrEqual(o_orderdate" in orders_scan and "LessThanOrEqual(o_orde" in orders_scan
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>" in orders_scan


def test_scorer_does_not_shuffle_observations(spark):
    df = E.queries()["o_score_observations"](spark, SF_SMALL)
    assert has_operator(df, "BroadcastHashJoin") and shuffle_count(df) == 0
