import datetime as dt
import math

from panelkit.config import PanelConfig
from panelkit.plans import document as dc
from panelkit.plans.runner import run, write_all
from tests.conftest import make_panel

D = dt.datetime(2024, 1, 7)


def _tables(spark):
    kpis = spark.createDataFrame([("a", 1.0, 2.0, D, 3.0), ("b", math.nan, math.inf, None, None)],
                                 "entity string, total_return_pct double, peak_value double, peak_date timestamp, current_close double")
    prices = spark.createDataFrame(
        [("a", "M2", 2, 0.2, D), ("a", "M1", 1, 0.1, D), ("a", "M2", 1, math.nan, D), ("a", None, 1, 9.0, D), ("c", "M1", 1, 1.0, D)],
        "entity string, model string, step int, yhat double, date timestamp")
    dec = spark.createDataFrame([("b", 1, D, 2.0, "additive", 52), ("b", 0, D, 1.0, "additive", 52)],
                                "entity string, pos int, ts timestamp, observed double, model string, period int")
    cmp = spark.createDataFrame([("a", "M1", 1.5, "M1", False), ("a", "M2", None, "M1", False)],
                                "entity string, model string, rmse double, best_model string, high_mape boolean")
    return {"kpis": kpis, "price_forecast": prices, "decomposition": dec, "model_comparison": cmp}


def test_sections_nest_by_the_schema_and_read_back(spark, tmp_path):
    dc.write_documents(spark, _tables(spark), str(tmp_path))
    d = {r.entity: r for r in dc.read_documents(spark, str(tmp_path)).collect()}
    assert set(d) == {"a", "b"}  # c has no KPIs
    assert d["b"].kpis.total_return_pct is None and d["b"].kpis.peak_value is None  # NaN, infinite
    f = d["a"].forecast
    assert set(f) == {"M1", "M2"}  # a row without model has no place in the map
    assert [r.step for r in f["M2"]] == [1, 2] and [r.yhat for r in f["M2"]] == [None, 0.2]
    assert f["M1"][0].date == D and f["M1"][0].price_forecast is None  # a column that the table lacks
    assert d["b"].forecast is None and d["a"].decomposition is None and d["a"].series is None
    x = d["b"].decomposition
    assert (x.model, x.period, [p.pos for p in x.points], [p.observed for p in x.points]) == ("additive", 52, [0, 1], [1.0, 2.0])
    c = d["a"].comparison
    assert c.best_model == "M1" and c.metrics["M1"].rmse == 1.5 and c.metrics["M2"].rmse is None


def test_empty_tables_and_repeated_rows(spark, tmp_path):
    t = {n: x.limit(0) for n, x in _tables(spark).items()}
    dc.write_documents(spark, t, str(tmp_path / "none"))
    assert dc.read_documents(spark, str(tmp_path / "none")).count() == 0
    t = _tables(spark)
    t["price_forecast"] = t["price_forecast"].unionByName(t["price_forecast"])
    doc = {r.entity: r for r in dc.document(spark, t).collect()}
    assert [r.step for r in doc["a"].forecast["M2"]] == [1, 1, 2, 2]  # rows are not told apart


def test_batch_run_writes_documents_and_rows(spark, tmp_path):
    rows = [(e, str(dt.date(2020, 1, 5) + dt.timedelta(7 * i)), 100 + 10 * math.sin(i * k) + i)
            for k, e in enumerate(("x", "y"), 1) for i in range(60)]
    cfg = PanelConfig(freq="W", period=12)
    t = run(spark, make_panel(spark, rows), cfg)
    names = ("kpis", "series", "decomposition", "stationarity", "outliers", "outlier_summary", "residual_stats",
             "price_forecast", "metadata", "best_worst", "ranking", "residual_histogram", "residual_normal_curve", "landing_subset")
    write_all({n: t[n] for n in names}, str(tmp_path))
    path = f"{tmp_path}/documents"
    d = {r.entity: r for r in dc.read_documents(spark, path).collect()}
    assert set(d) == {"x", "y"}
    assert len(d["x"].series.values) == len(d["x"].series.returns) == 60 and d["x"].series.returns[0] is None
    assert len(d["y"].decomposition.points) == 60 and d["y"].decomposition.period == 12
    assert [r.step for r in d["y"].forecast["AR1"]] == list(range(1, 13))
    assert d["x"].stationarity.n == 59 and d["x"].outlier_summary["count"] == len(d["x"].outliers or [])
    m = {r.entity: r for r in dc.read_run_table(spark, path, "metadata").collect()}
    assert m["x"].n_periods == 60 and m["x"].first_date == dt.datetime(2020, 1, 5) and m["x"].resample_freq == "W"
    assert [r["rank"] for r in dc.read_run_table(spark, path, "ranking").orderBy("rank").collect()] == [1, 2]
    assert dc.read_run_table(spark, path, "best_worst").first().n_entities == 2
