import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelkit.config import PanelConfig
from panelkit.operators.features import add_features
from panelkit.operators.resample import gap_stats, resample_fill
from tests.conftest import make_panel


def _weekly(spark, rows, **kw):
    return resample_fill(make_panel(spark, rows), PanelConfig(**kw)).orderBy("entity", "idx").toPandas()


def test_gap_run_fill(spark):
    # weekly values 10, (4 empty weeks), 20 -> ffill 2, then linear, as specified
    rows = [("a", "2024-01-07", 10), ("a", "2024-02-11", 20)]
    w = _weekly(spark, rows)
    assert list(w["ts"].astype(str)) == ["2024-01-07", "2024-01-14", "2024-01-21", "2024-01-28", "2024-02-04", "2024-02-11"]
    np.testing.assert_allclose(w["close"], [10, 10, 10, 10 + 10 / 3, 10 + 20 / 3, 20])
    assert w["raw_close"].isna().sum() == 4
    assert not w["has_gap"].any()
    assert list(w["pos"]) == list(range(6))


def test_sunday_label_and_last_value(spark):
    # Monday..Sunday belong to the week labelled by that Sunday; last by (ts, tb)
    rows = [("a", "2024-01-01", 1), ("a", "2024-01-07", 2), ("a", "2024-01-07", 3), ("a", "2024-01-08", 4)]
    w = _weekly(spark, rows)
    assert list(w["ts"].astype(str)) == ["2024-01-07", "2024-01-14"]
    assert list(w["raw_close"]) == [3.0, 4.0]


def test_last_skips_null_in_bin(spark):
    rows = [("a", "2024-01-01", 1), ("a", "2024-01-02", None), ("a", "2024-01-09", 5)]
    w = _weekly(spark, rows)
    assert list(w["raw_close"]) == [1.0, 5.0]


def test_all_null_entity_untouched(spark):
    rows = [("a", "2024-01-01", None), ("a", "2024-01-20", None), ("b", "2024-01-01", 1)]
    w = _weekly(spark, rows)
    a = w[w.entity == "a"]
    assert a["close"].isna().all() and a["has_gap"].all() and len(a) == 3
    g = gap_stats(resample_fill(make_panel(spark, rows), PanelConfig())).toPandas().set_index("entity")
    assert bool(g.loc["a", "all_null"]) and not bool(g.loc["b", "all_null"])


def test_one_row_and_empty(spark):
    w = _weekly(spark, [("a", "2024-01-03", 7)])
    assert len(w) == 1 and w["close"].iloc[0] == 7
    empty = make_panel(spark, []).limit(0)
    assert resample_fill(empty, PanelConfig()).count() == 0


def test_matches_pandas_on_random_holes(spark):
    rng = np.random.default_rng(7)
    days = pd.date_range("2021-01-01", periods=400, freq="D")
    keep = rng.random(400) > 0.85
    vals = np.round(100 + rng.standard_normal(400).cumsum(), 2)
    rows = [("x", str(d.date()), float(v)) for d, v, k in zip(days, vals, keep) if k]
    s = pd.Series([v for (_, _, v) in rows], index=pd.to_datetime([r[1] for r in rows]))
    ref = s.resample("W").last().ffill(limit=2).interpolate(method="linear", limit_direction="both")
    got = _weekly(spark, rows)
    assert list(got["ts"].astype(str)) == [str(d.date()) for d in ref.index]
    np.testing.assert_allclose(got["close"].to_numpy(), ref.to_numpy(), rtol=0, atol=1e-9)


def test_hourly_and_monthly(spark):
    rows = [("a", "2024-01-01 00:10", 1), ("a", "2024-01-01 00:50", 2), ("a", "2024-01-01 03:05", 5)]
    w = _weekly(spark, rows, freq="h", period=24)
    assert len(w) == 4 and list(w["raw_close"].fillna(-1)) == [2, -1, -1, 5]
    m = _weekly(spark, [("a", "2024-01-15", 1), ("a", "2024-04-02", 4)], freq="ME")
    assert list(m["ts"].astype(str)) == ["2024-01-31", "2024-02-29", "2024-03-31", "2024-04-30"]


def test_features(spark):
    rows = [("a", str(dt.date(2020, 12, 27) + dt.timedelta(days=7 * k)), 100 + k) for k in range(8)]
    f = add_features(resample_fill(make_panel(spark, rows), PanelConfig()), PanelConfig()).orderBy("idx").toPandas()
    assert pd.isna(f["returns"].iloc[0]) and pd.isna(f["returns_simple"].iloc[0])
    np.testing.assert_allclose(f["returns"].iloc[1], np.log(101 / 100))
    assert f["rolling_mean_4"].isna().sum() == 3
    np.testing.assert_allclose(f["rolling_std_4"].iloc[3], np.std([100, 101, 102, 103], ddof=1))
    # ISO week: 2021-01-03 is week 53 of 2020
    assert int(f.loc[f["ts"].astype(str) == "2021-01-03", "week_of_year"].iloc[0]) == 53
    assert {"lag_1", "lag_2", "lag_4", "month", "quarter", "year"} <= set(f.columns)


def test_zero_and_negative_closes(spark):
    rows = [("a", "2024-01-07", 5), ("a", "2024-01-14", 0), ("a", "2024-01-21", -2), ("a", "2024-01-28", 3)]
    f = add_features(resample_fill(make_panel(spark, rows), PanelConfig()), PanelConfig()).orderBy("idx").toPandas()
    # ln of a non-positive ratio and division by zero give NULL, never an error
    assert f["returns"].isna().sum() == 4
    assert pd.isna(f["returns_simple"].iloc[2]) and f["returns_simple"].iloc[1] == -1.0


@pytest.mark.parametrize("tbs, last", [((-5, 3), 1), ((3, -5), 0), ((None, -(1 << 63) + 1), 1), ((-(1 << 63) + 1, None), 0), (((1 << 63) - 1, 10 ** 18), 0)])
def test_last_row_by_any_tiebreak(spark, tbs, last):
    from panelkit.operators.resample import resample_last

    at = dt.datetime(2024, 1, 3, 12)
    rows = [("a", at, float(k), tb) for k, tb in enumerate(tbs)]
    # an earlier row never wins, however large its tiebreak
    rows.append(("a", at - dt.timedelta(microseconds=1), 9.0, (1 << 63) - 1))
    rows += [("old", dt.datetime(1890, 1, 1), 1.0, 1), ("late", dt.datetime(9000, 1, 1), 2.0, 1)]
    got = {r.entity: r.raw_close for r in resample_last(spark.createDataFrame(rows, "entity string, ts timestamp, close double, tb long")).collect()}
    assert got == {"a": float(last), "old": 1.0, "late": 2.0}
