import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from panelkit.operators import folds as fo
from panelkit.operators import forecast as fc
from panelkit.operators.models import arima_search, full_rows, run_arima
from panelkit.operators.trend import run_trend
from panelkit.operators.gbt import run_gbt


def _series(spark, data):
    rows = []
    for e, ys in data.items():
        for i, v in enumerate(ys):
            rows.append((e, i, (pd.Timestamp("2015-01-04") + pd.Timedelta(days=7 * i)).to_pydatetime(), float(v)))
    df = spark.createDataFrame(rows, "entity string, idx long, ts timestamp, returns double")
    return fo.target_series(df.withColumn("ts", F.to_date("ts")), "returns")


def test_walk_forward_folds(spark):
    s = _series(spark, {"a": np.arange(100, dtype=float)})
    f = fo.walk_forward(s, 5, 12).toPandas()
    size = 100 // 6
    for k in range(5):
        g = f[f.fold == k]
        start = 100 - (5 - k) * size
        assert set(g[g.role == "train"]["i"]) == set(range(start))
        assert sorted(g[g.role == "test"]["i"]) == list(range(start, start + min(size, 12)))
    h = fo.holdout(s, 0.2).toPandas()
    assert (h.role == "train").sum() == int(100 * 0.8)


def test_ar1_closed_form_matches_recursion(spark):
    rng = np.random.default_rng(4)
    y = np.zeros(200)
    for t in range(1, 200):
        y[t] = 0.3 + 0.6 * y[t - 1] + rng.standard_normal()
    s = _series(spark, {"a": y})
    fut = fc.ar1_forecast(s, 5).orderBy("step").toPandas()
    phi, c = np.polyfit(y[:-1], y[1:], 1)
    v, ref = y[-1], []
    for _ in range(5):
        v = c + phi * v
        ref.append(v)
    np.testing.assert_allclose(fut["yhat"], ref, rtol=1e-9)
    assert (fut["upper"] > fut["yhat"]).all() and (np.diff(fut["upper"] - fut["lower"]) > 0).all()


def test_metrics(spark):
    pred = spark.createDataFrame([("a", "m", 0, 1.0, 1.5), ("a", "m", 0, 2.0, 1.0), ("a", "m", 0, 0.0, 0.5)],
                                 "entity string, model string, fold int, y double, yhat double")
    m = fc.error_metrics(pred).toPandas().iloc[0]
    e = np.array([-0.5, 1.0, -0.5])
    y = np.array([1.0, 2.0, 0.0])
    p = np.array([1.5, 1.0, 0.5])
    np.testing.assert_allclose(m["rmse"], np.sqrt(np.mean(e ** 2)))
    np.testing.assert_allclose(m["mape"], np.mean(np.abs(e / (np.abs(y) + 1e-10))) * 100)
    np.testing.assert_allclose(m["smape"], np.mean(2 * np.abs(e) / (np.abs(y) + np.abs(p) + 1e-10)) * 100)
    np.testing.assert_allclose(m["r2"], 1 - np.sum(e ** 2) / (np.sum((y - y.mean()) ** 2) + 1e-10))
    np.testing.assert_allclose(m["residual_std"], np.std(e))


def test_arima_contract(spark):
    rng = np.random.RandomState(42)
    x = np.diff(rng.randn(100).cumsum())
    mod, z = arima_search(x, 0, 12)
    assert math.isfinite(mod.aic) and mod.stable()
    s = _series(spark, {"a": x})
    r = run_arima(full_rows(s), 5, 12, d=0).toPandas()
    fut = r[r.role == "future"]
    assert len(fut) == 5 and {"yhat", "lower", "upper"} <= set(fut.columns)
    assert (fut["lower"] < fut["yhat"]).all() and (fut["yhat"] < fut["upper"]).all()
    assert r["error"].isna().all()


def test_model_failure_isolated(spark):
    s = _series(spark, {"ok": np.random.default_rng(0).standard_normal(80), "tiny": [0.1, 0.2, 0.3]})
    r = run_trend(s, fo.fold_slots(cv=False), 4, 7.0).toPandas()
    assert r[r.entity == "tiny"]["error"].notna().all()
    assert sorted(r[(r.entity == "ok") & (r.role == "future")]["step"]) == [1, 2, 3, 4]


def test_gbt_pooled(spark):
    rng = np.random.default_rng(1)
    s = _series(spark, {"a": np.sin(np.arange(60) / 3) + rng.standard_normal(60) * 0.1,
                        "b": np.cos(np.arange(60) / 3) + rng.standard_normal(60) * 0.1})
    r = run_gbt(full_rows(s), 6, 12, max_iter=5).toPandas()
    fut = r[r.role == "future"]
    assert len(fut) == 12 and fut["yhat"].notna().all()


def test_gbt_runs_to_the_last_test_step_and_reports_short_series(spark):
    rng = np.random.default_rng(2)
    s = _series(spark, {"a": np.sin(np.arange(60) / 3) + rng.standard_normal(60) * 0.1, "tiny": [0.1, 0.2, 0.3]})
    r = run_gbt(fo.holdout(s, 0.3).unionByName(full_rows(s)), 4, 12, max_iter=3).toPandas()
    test = r[(r.entity == "a") & (r.role == "test")]
    assert sorted(test["step"]) == list(range(1, 19))  # 18 test rows, beyond the horizon of 4
    assert sorted(r[(r.entity == "a") & (r.role == "future")]["step"]) == [1, 2, 3, 4]
    tiny = r[r.entity == "tiny"]
    assert set(tiny["role"]) == {"error"} and set(tiny["fold"]) == {-1, -2} and tiny["error"].notna().all()


def test_compiled_trees_equal_the_model_here_and_in_duckdb(spark):
    import duckdb
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.regression import GBTRegressor

    from panelkit.operators.gbt import compile_trees, ensemble, recursion

    rng = np.random.default_rng(6)
    x = rng.standard_normal((400, 3))
    y = np.where(x[:, 0] > 0.2, x[:, 1], -x[:, 2]) + 1e-7 * x[:, 0]
    df = spark.createDataFrame([(k % 2, [float(v) for v in r], float(t)) for k, (r, t) in enumerate(zip(x, y))], "fold int, win array<double>, ys double")
    fits = {f: GBTRegressor(labelCol="ys", maxIter=8, maxDepth=3, seed=1).fit(df.where(F.col("fold") == f).select("ys", array_to_vector("win").alias("features"))) for f in (0, 1)}
    models = {f: m.toDebugString for f, m in fits.items()}
    got = df.select("fold", "win", ensemble(models).alias("p"), recursion(models, 3, "2 + fold").alias("path")).toPandas()
    for f, m in fits.items():
        g = got[got.fold == f]
        rows = np.stack(g["win"])
        predict = lambda a: np.array([r.prediction for r in m.transform(spark.createDataFrame([(v.tolist(),) for v in a], "w array<double>").select(array_to_vector("w").alias("features"))).collect()])  # noqa: B023, E731
        np.testing.assert_allclose(g["p"], predict(rows), rtol=1e-12)
        state, path = rows, np.stack(g["path"])
        assert path.shape == (len(rows), 2 + f)
        for k in range(2 + f):
            p = predict(state)
            np.testing.assert_allclose(path[:, k], p, rtol=1e-9)
            state = np.column_stack([state[:, 1:], path[:, k]])
        windows = pd.DataFrame({"win": list(rows)})  # noqa: F841 - read by the query
        there = duckdb.sql(f"SELECT {compile_trees(models[f], lambda j: f'win[{j + 1}]')} AS p FROM windows").df()
        np.testing.assert_allclose(there["p"], g["p"], rtol=1e-12)


def test_gbt_without_any_long_series(spark):
    r = run_gbt(full_rows(_series(spark, {"tiny": [0.1, 0.2, 0.3]})), 4, 12).toPandas()
    assert list(r["role"]) == ["error"]


def test_price_target_passes_through(spark):
    f = spark.createDataFrame([("a", "m", 1, 5.0, 4.0, 7.0)], "entity string, model string, step int, yhat double, lower double, upper double")
    last = spark.createDataFrame([("a", 2.0)], "entity string, last_price double")
    r = fc.to_price(f, last, target="close").first()
    assert (r["price_forecast"], r["price_lower"], r["price_upper"], r["ci_width"]) == (5.0, 4.0, 7.0, 3.0)


def test_zero_and_ar1_future(spark):
    from panelkit.config import PanelConfig
    from panelkit.plans.queries_models import labelled_rows, model_jobs

    y = np.random.default_rng(3).standard_normal(60)
    cfg = PanelConfig(freq="ME", horizon=3, cv_folds=2)
    rows = labelled_rows(_series(spark, {"a": y}), cfg, holdout=True)
    r = model_jobs(rows, cfg, ("AR1", "Zero")).toPandas()
    for m in ("AR1", "Zero"):
        g = r[r.model == m]
        assert sorted(g[g.role == "future"]["step"]) == [1, 2, 3]
        assert sorted(g[(g.role == "future")]["i"]) == [60, 61, 62]
        assert len(g[(g.role == "test") & (g.fold == -1)]) == 12
        assert set(g[(g.role == "test") & (g.fold >= 0)]["fold"]) == {0, 1}
    z = r[(r.model == "Zero") & (r.role == "future")]
    np.testing.assert_allclose(z["upper"], 1.959963984540054 * np.std(y))


def test_validation_query_covers_every_registered_model(monkeypatch):
    from panelkit.plans import queries_models as qm

    asked = {}
    monkeypatch.setattr(qm, "features", lambda spark, sf: None)
    monkeypatch.setattr(qm, "model_tables", lambda f, cfg, models=tuple(qm.MODEL_REGISTRY): asked.update(models=models) or {"validation_metrics": None})
    qm.k_model_validation(None, "")
    assert set(asked["models"]) == set(qm.MODEL_REGISTRY)


def test_validation_keeps_a_model_without_forecasts(spark):
    from panelkit.operators.forecast import validation

    cols = "entity string, model string, fold int, role string, i int, y double, yhat double"
    rows = [("a", "good", f, "test", 8 + k, float(k), k + 0.5) for f in (-1, 0, 1) for k in range(3)]
    pred = spark.createDataFrame(rows + [("a", "failed", 0, "error", None, None, None), ("b", "failed", -1, "train", 1, 2.0, None)], cols)
    series = spark.createDataFrame([("a", f, "train", k, float(k)) for f in (-1, 0, 1) for k in range(8)], "entity string, fold int, role string, i int, y double")
    got = {(r.entity, r.model): r for r in validation(pred, series).collect()}
    assert set(got) == {("a", "good"), ("a", "failed"), ("b", "failed")}
    assert got["a", "good"].rmse == 0.5 and got["a", "good"].cv_rmse == 0.5 and got["a", "good"].mase == 0.5
    assert all(v is None for key in (("a", "failed"), ("b", "failed")) for v in got[key][2:])
