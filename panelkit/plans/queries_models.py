"""Model jobs and the multi-model comparison."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelkit.config import PanelConfig
from panelkit.functions.scalar import round_half_up
from panelkit.operators import folds as fo
from panelkit.operators import forecast as fc
from panelkit.operators import stattests as st
from panelkit.operators.gbt import run_gbt
from panelkit.operators.models import full_rows, run_arima
from panelkit.operators.trend import run_trend
from panelkit.plans.catalog import final, register
from panelkit.plans.queries_core import W, features
from panelkit.session import checkpoint_dir

MODEL_ORDER = {"ARIMA": 0, "Trend": 1, "GBT": 2, "AR1": 3, "Zero": 4}
_FIT_COLS = (("spec", "string"), ("aic", "double"), ("bic", "double"), ("sigma", "double"),
             ("fit_time_s", "double"), ("error", "string"))


def _with_fit_cols(df: DataFrame) -> DataFrame:
    return df.select("*", *[F.lit(None).cast(t).alias(c) for c, t in _FIT_COLS if c not in df.columns])


@dataclass(frozen=True)
class Labelled:
    """The folds a model job runs over: the series, the full fit (fold -2), and if asked
    the walk-forward folds and the hold-out (fold -1)."""
    series: DataFrame
    cfg: PanelConfig
    cv: bool = True
    holdout: bool = False

    @property
    def slots(self) -> list:
        """The folds as positions, for jobs that look running sums up."""
        return fo.fold_slots(self.cfg.cv_folds, self.cfg.horizon, self.cfg.test_size, True, self.cv, self.holdout)

    @property
    def rows(self) -> DataFrame:
        """The folds as labelled rows, one copy per fold, for jobs that fit each anew."""
        out = full_rows(self.series)
        if self.cv:
            out = out.unionByName(fo.walk_forward(self.series, self.cfg.cv_folds, self.cfg.horizon))
        return out.unionByName(fo.holdout(self.series, self.cfg.test_size)) if self.holdout else out

    def checkpoint(self) -> Labelled:
        checkpoint_dir(self.series.sparkSession)
        return replace(self, series=self.series.checkpoint(eager=True))


def _zero(folds: Labelled, cfg: PanelConfig) -> DataFrame:
    return fc.zero_predict(folds.rows).unionByName(fc.zero_forecast(folds.series, cfg.horizon))


# M5: model registry, name -> job over the folds (one PRED table each)
MODEL_REGISTRY = {
    "ARIMA": lambda folds, cfg: run_arima(folds.rows, cfg.horizon, cfg.seasonal_period),
    "Trend": lambda folds, cfg: run_trend(folds.series, folds.slots, cfg.horizon, cfg.step_days),
    "GBT": lambda folds, cfg: run_gbt(folds.rows, cfg.horizon, cfg.lookback),
    "AR1": lambda folds, cfg: fc.ar1_jobs(folds.series, folds.slots, cfg.horizon),
    "Zero": _zero,
}


def _series(spark, sf):
    return fo.target_series(features(spark, sf), "returns")


def labelled_rows(series: DataFrame, cfg: PanelConfig, holdout: bool = False, cv: bool = True) -> Labelled:
    """Full fit (fold -2), ``cv_folds`` walk-forward folds unless declined and, if asked, the hold-out (fold -1)."""
    return Labelled(series, cfg, cv, holdout)


def model_jobs(folds: Labelled, cfg: PanelConfig = W, models=tuple(MODEL_REGISTRY)) -> DataFrame:
    """Every model over ``labelled_rows``, as one long PRED table (plus fit columns)."""
    unknown = [m for m in models if m not in MODEL_REGISTRY]
    if unknown:
        raise ValueError(f"models not registered: {unknown}; available: {sorted(MODEL_REGISTRY)}")
    out = None
    for m in models:
        r = _with_fit_cols(MODEL_REGISTRY[m](folds, cfg))
        out = r if out is None else out.unionByName(r)
    return out


def forecast_tables(features: DataFrame, pred: DataFrame, cfg: PanelConfig) -> tuple[DataFrame, DataFrame]:
    """The future rows of PRED as dated forecasts and as dated price paths."""
    future = pred.where(F.col("role") == "future")
    ends = features.groupBy("entity").agg(F.max("idx").alias("last_idx"))
    last = (features.where(F.col("close").isNotNull()).groupBy("entity")
            .agg(F.max_by("close", "idx").alias("last_price")))
    dates = fo.future_dates(ends, cfg.freq, cfg.horizon)
    prices = fc.to_price(future, last).join(dates.withColumnRenamed("ts", "date"), ["entity", "step"])
    return fc.dated(future, dates), prices


def model_tables(features: DataFrame, cfg: PanelConfig, models=tuple(MODEL_REGISTRY)) -> dict[str, DataFrame]:
    """Every table that rests on the model jobs, from one checkpointed PRED table:
    comparison, summary, forecasts with dates, price paths and their change,
    hold-out + walk-forward validation and its macro average, residuals."""
    checkpoint_dir(features.sparkSession)
    folds = labelled_rows(fo.target_series(features, "returns"), cfg, holdout=True).checkpoint()
    series = folds.series
    pred = model_jobs(folds, cfg, models).checkpoint(eager=True)
    forecasts, prices = forecast_tables(features, pred, cfg)
    valid = fc.validation(pred, fo.holdout(series, cfg.test_size))
    t = {
        "model_comparison": comparison(pred),
        "forecasts": forecasts,
        "price_forecast": prices,
        "forecast_change": fc.forecast_change(prices),
        "validation_metrics": valid,
        "validation_macro": fc.macro_average(valid),
        "model_residuals": residuals(pred, series),
    }
    if "ARIMA" in models:
        t["model_summary"] = fit_all(series, cfg, pred.where(F.col("model") == "ARIMA"))
    return t


def residuals(pred: DataFrame, series: DataFrame) -> DataFrame:
    """M8: dated in-sample residuals of the full fits."""
    ins = pred.where((F.col("role") == "insample") & (F.col("fold") == -2))
    return ins.join(series.select("entity", "i", "ts"), ["entity", "i"]).select(
        "entity", "model", "i", "ts", "y", "yhat", (F.col("y") - F.col("yhat")).alias("residual"))


@register("m1_arima_forecast")
def m1_arima_forecast(spark, sf):
    """Seasonal ARIMA (Hannan-Rissanen, AIC order search) 12-step forecasts."""
    s = _series(spark, sf)
    r = run_arima(full_rows(s), 12, 52)
    return r.where(F.col("role").isin("future", "error")).drop("y", "fit_time_s")  # a time differs at every run


def _trend_ctes() -> str:
    """The trend fit by brute force, from labelled rows ``rws``: the design written out row
    by row for each fold, its full moment matrix by a self-join, Gauss-Jordan elimination
    as a recursion over the columns. Ends with ``tp``, the PRED rows."""
    key = "entity, fold"
    design = "SELECT p.entity, p.fold, p.role, p.i, p.y"
    return f"""tt AS (SELECT entity, fold, role, step, i, y, CAST(datediff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS DOUBLE) AS t FROM rws),
fx AS (SELECT {key}, count(*) AS n, min(t) AS t0, max(t) AS t1, greatest(CAST(floor(count(*) * 0.8) AS INTEGER), 1) AS hist
       FROM tt WHERE role = 'train' GROUP BY ALL HAVING count(*) >= 10),
cp AS (SELECT DISTINCT {key}, CAST(round_even(j * (hist - 1) / 25.0, 0) AS INTEGER) AS pos FROM fx CROSS JOIN (SELECT unnest(generate_series(1, 25)) AS j)),
cq AS (SELECT {key}, row_number() OVER (PARTITION BY {key} ORDER BY pos) AS j, (tt.t - t0) / (t1 - t0) AS c
       FROM cp JOIN tt USING ({key}) JOIN fx USING ({key}) WHERE pos > 0 AND tt.i = pos),
pt AS (SELECT tt.*, (t - t0) / (t1 - t0) AS x FROM tt JOIN fx USING ({key}) UNION ALL
       SELECT {key}, 'future', CAST(step AS INTEGER), CAST(n - 1 + step AS INTEGER), NULL, t1 + 7 * step, (t1 + 7 * step - t0) / (t1 - t0)
       FROM fx CROSS JOIN (SELECT unnest(generate_series(1, 12)) AS step) WHERE fold = -2),
dz AS ({design}, 0 AS o, 1.0 AS v FROM pt p UNION ALL {design}, 1, x FROM pt p
  UNION ALL {design}, 1 + j, greatest(x - c, 0) FROM pt p JOIN cq USING ({key})
  UNION ALL {design}, 100 + k, sin(2 * pi() * k * t / 365.25) FROM pt p CROSS JOIN (SELECT unnest(generate_series(1, 10)) AS k)
  UNION ALL {design}, 200 + k, cos(2 * pi() * k * t / 365.25) FROM pt p CROSS JOIN (SELECT unnest(generate_series(1, 10)) AS k)),
td AS (SELECT * FROM dz WHERE role = 'train'),
gs AS (SELECT a.entity, a.fold, a.o AS oi, b.o AS oj, sum(a.v * b.v) AS s FROM td a JOIN td b ON a.entity = b.entity AND a.fold = b.fold AND a.i = b.i GROUP BY ALL),
gm AS (SELECT {key}, oi, oj, s + CASE WHEN oi <> oj OR oi < 2 THEN 0 WHEN oi < 100 THEN 1.0 ELSE 0.01 END AS s FROM gs
       UNION ALL SELECT {key}, o, 1000, sum(v * y) FROM td GROUP BY ALL),
gr AS (SELECT {key}, oi, list(s ORDER BY oj) AS r FROM gm GROUP BY ALL),
gj AS (SELECT {key}, 1 AS k, list(r ORDER BY oi) AS m, list(oi ORDER BY oi) AS os FROM gr GROUP BY {key} UNION ALL
       SELECT {key}, k + 1, list_transform(m, lambda r, q: CASE WHEN q = k THEN list_transform(r, lambda z: z / m[k][k])
         ELSE list_transform(r, lambda z, w: z - r[k] / m[k][k] * m[k][w]) END), os FROM gj WHERE k <= len(m)),
cb AS (SELECT {key}, unnest(os) AS o, unnest(list_transform(m, lambda r: r[len(r)])) AS beta FROM gj WHERE k = len(m) + 1),
fv AS (SELECT {key}, i, sum(v * beta) AS yhat FROM dz JOIN cb USING ({key}, o) GROUP BY ALL),
sg AS (SELECT {key}, stddev_pop(y - yhat) AS sigma FROM pt JOIN fv USING ({key}, i) WHERE role = 'train' GROUP BY ALL),
tp AS (SELECT {key}, 'Trend' AS model, CASE role WHEN 'train' THEN 'insample' ELSE role END AS role, step, i, y, yhat,
         yhat - 1.959963984540054 * sigma AS lower, yhat + 1.959963984540054 * sigma AS upper, sigma
       FROM pt JOIN fv USING ({key}, i) JOIN sg USING ({key}) WHERE role <> 'train' OR fold = -2)"""


def _trend_sql(*more: str, rows: str) -> str:
    from panelkit.plans.queries_forecast import SER
    from panelkit.plans.sqlref import features_ctes

    return "WITH RECURSIVE " + ",\n".join([features_ctes("nation"), SER, rows, _trend_ctes(), *more]) + "\n"


def _trend_forecast_sql() -> str:
    from panelkit.plans.queries_forecast import full_cte

    return _trend_sql("""o AS (SELECT *, 'trend+yearly(10)' AS spec, CAST(NULL AS DOUBLE) AS aic, CAST(NULL AS DOUBLE) AS bic,
  CAST(NULL AS VARCHAR) AS error FROM tp WHERE role = 'future')""", rows=full_cte()) + final(
        "o", "entity model fold role step i yhat:8 lower:8 upper:8 spec aic bic sigma:8 error")


@register("m2_trend_forecast", _trend_forecast_sql(), scale=8)
def m2_trend_forecast(spark, sf):
    """M2: trend + yearly seasonality forecasts with residual-based intervals."""
    f = labelled_rows(_series(spark, sf), W, cv=False)
    r = MODEL_REGISTRY["Trend"](f, W)
    return r.where(F.col("role").isin("future", "error")).drop("y", "fit_time_s")  # a time differs at every run


def _trend_validation_sql() -> str:
    from panelkit.plans.queries_forecast import METRICS, folds_cte, hold_cte

    rows = ",\n".join([folds_cte("rwf"), hold_cte("rwh"), """rws AS (SELECT entity, ts, i, y, fold, role, step FROM rwf
  UNION ALL SELECT entity, ts, i, y, fold, role, step FROM rwh)"""])
    cv = METRICS("(SELECT * FROM tp WHERE role = 'test' AND fold >= 0)", ["entity", "model", "fold"], names=("c0", "cm"))
    ho = METRICS("(SELECT * FROM tp WHERE role = 'test' AND fold = -1)", ["entity", "model", "fold"], "signed", names=("h0", "hm"))
    return _trend_sql(cv, ho, """cv AS (SELECT entity, model, avg(rmse) AS cv_rmse, stddev_pop(rmse) AS cv_rmse_std, avg(mae) AS cv_mae,
  stddev_pop(mae) AS cv_mae_std, avg(mape) AS cv_mape, stddev_pop(mape) AS cv_mape_std, count(*) AS n_folds FROM cm GROUP BY ALL),
nv AS (SELECT entity, avg(ad) AS naive_mae, count(*) AS n_train FROM
      (SELECT entity, abs(y - lag(y) OVER (PARTITION BY entity ORDER BY i)) AS ad FROM rwh WHERE role = 'train') GROUP BY entity),
o AS (SELECT hm.entity, hm.model, mae, rmse, mape, CASE WHEN nv.n_train >= 2 AND naive_mae <> 0 THEN mae / naive_mae END AS mase, nv.n_train, hm.n AS n_test,
        cv.* EXCLUDE (entity, model) FROM hm JOIN nv USING (entity) JOIN cv ON cv.entity = hm.entity)""", rows=rows) + final(
        "o", "entity model mae:9 rmse:9 mape:s9 mase:9 n_train n_test cv_rmse:9 cv_rmse_std:9 cv_mae:9 cv_mae_std:9 cv_mape:s9 cv_mape_std:s9 n_folds")


@register("m2_trend_validation", _trend_validation_sql(), scale=9, overrides=dict.fromkeys(("mape", "cv_mape", "cv_mape_std"), "s9"))
def m2_trend_validation(spark, sf):
    """M7/M9/K3: hold-out and walk-forward metrics of the trend model; six folds from one pass of running sums."""
    s = _series(spark, sf)
    pred = run_trend(s, fo.fold_slots(W.cv_folds, W.horizon, W.test_size, full=False, hold=True))
    return fc.validation(pred, fo.holdout(s, W.test_size))


@register("m3_gbt_forecast")
def m3_gbt_forecast(spark, sf):
    """Pooled gradient-boosted lag-window model, recursive 12-step forecast."""
    s = _series(spark, sf)
    r = run_gbt(full_rows(s), 12, 12)
    return r.where(F.col("role").isin("future", "error"))


def _residuals_sql() -> str:
    from panelkit.plans.queries_forecast import AR, full_cte

    return _trend_sql(AR, """ip AS (SELECT entity, model, i, y, yhat FROM tp WHERE role = 'insample'
  UNION ALL SELECT entity, model, i, y, yhat FROM pred WHERE role = 'insample'),
o AS (SELECT entity, model, ip.i, ser.ts, ip.y, yhat, ip.y - yhat AS residual FROM ip JOIN ser USING (entity, i))""", rows=full_cte()) + final(
        "o", "entity model i ts y:8 yhat:8 residual:8")


@register("m8_insample_residuals", _residuals_sql(), scale=8)
def m8_insample_residuals(spark, sf):
    """M8: in-sample predictions and residuals of the trend and the AR(1) model, from their
    coefficient tables (the ARIMA rows are ``m8_arima_residuals``)."""
    s = _series(spark, sf)
    return residuals(model_jobs(labelled_rows(s, W, cv=False), W, ("Trend", "AR1")), s)


@register("m8_arima_residuals")
def m8_arima_residuals(spark, sf):
    """M8: in-sample predictions and residuals of the ARIMA model."""
    s = _series(spark, sf)
    return residuals(run_arima(full_rows(s)), s)


def comparison(pred: DataFrame) -> DataFrame:
    """Per entity and model in-sample metrics + cv_rmse + fit time;
    best model = lowest RMSE (model order breaks ties); high-MAPE flag."""
    ins = fc.error_metrics(pred.where((F.col("role") == "insample") & (F.col("fold") == -2)), ("entity", "model"))
    cvm = fc.error_metrics(pred.where((F.col("role") == "test") & (F.col("fold") >= 0)), ("entity", "model", "fold"))
    cv = fc.cv_summary(cvm).select("entity", "model", "cv_rmse")
    fit = (pred.where(F.col("fold") == -2).groupBy("entity", "model")
           .agg(F.max("fit_time_s").alias("training_time_s"), F.max("error").alias("error")))
    # from the fits, so that a failed (entity, model) keeps its row and its error
    m = fit.join(ins, ["entity", "model"], "left").join(cv, ["entity", "model"], "left")
    order = F.create_map(*[x for k, v in MODEL_ORDER.items() for x in (F.lit(k), F.lit(v))])
    part = Window.partitionBy("entity")
    m = m.withColumn("_rank", F.when(F.col("rmse").isNotNull(), F.struct(F.col("rmse"), order[F.col("model")])))
    best = F.min_by("model", "_rank").over(part)
    return m.select("entity", "model", "rmse", "mae", "mape", "smape", "r2", "residual_std", "cv_rmse",
                    F.round("training_time_s", 2).alias("training_time_s"), "error",
                    best.alias("best_model"),
                    F.max(F.col("mape") > 100).over(part).alias("high_mape"))


@register("m13_model_comparison")
def m13_model_comparison(spark, sf):
    """Three models, in-sample metrics, walk-forward CV RMSE, best model."""
    checkpoint_dir(spark)
    pred = model_jobs(labelled_rows(_series(spark, sf), W).checkpoint(), W).checkpoint(eager=True)
    return comparison(pred).drop("training_time_s")


def _comparison_sql() -> str:
    from panelkit.plans.queries_forecast import AR, METRICS, folds_cte, full_cte

    rows = ",\n".join([folds_cte("rwf"), full_cte("rwl"), """rws AS (SELECT entity, idx, ts, i, y, n, fold, role, step FROM rwl
  UNION ALL SELECT entity, idx, ts, i, y, n, fold, role, step FROM rwf)"""])
    return _trend_sql(
        AR, """prd AS (SELECT entity, model, fold, role, y, yhat FROM pred UNION ALL SELECT entity, model, fold, role, y, yhat FROM tp
        UNION ALL SELECT entity, 'Zero', fold, CASE role WHEN 'train' THEN 'insample' ELSE role END, y, 0.0 FROM rws)""",
        METRICS("(SELECT * FROM prd WHERE role = 'insample' AND fold = -2)", ["entity", "model"], names=("i0", "it")),
        METRICS("(SELECT * FROM prd WHERE role = 'test')", ["entity", "model", "fold"]),
        "cv AS (SELECT entity, model, avg(rmse) AS cv_rmse FROM mt GROUP BY ALL)",
        """cm AS (SELECT it.*, cv.cv_rmse, CAST(NULL AS VARCHAR) AS error,
          first_value(it.model) OVER (PARTITION BY it.entity ORDER BY rmse, CASE it.model WHEN 'Trend' THEN 1 WHEN 'AR1' THEN 3 ELSE 4 END) AS best_model,
          bool_or(mape > 100) OVER (PARTITION BY it.entity) AS high_mape
        FROM it LEFT JOIN cv ON it.entity = cv.entity AND it.model = cv.model)""", rows=rows) + final(
            "cm", "entity model rmse:9 mae:9 mape:s9 smape:s9 r2:9 residual_std:9 cv_rmse:9 error best_model high_mape")


@register("m13_direct_comparison", _comparison_sql(), scale=9, overrides={"mape": "s9", "smape": "s9"})
def m13_direct_comparison(spark, sf):
    """The comparison table over the three models SQL can express."""
    folds = labelled_rows(_series(spark, sf), W).checkpoint()
    return comparison(model_jobs(folds, W, ("Trend", "AR1", "Zero"))).drop("training_time_s")


@register("k_model_forecasts")
def k_model_forecasts(spark, sf):
    """Every model's future steps with dates and price paths."""
    f = features(spark, sf)
    checkpoint_dir(spark)
    folds = labelled_rows(fo.target_series(f, "returns"), W, cv=False).checkpoint()
    pred = model_jobs(folds, W).checkpoint(eager=True)
    return forecast_tables(f, pred, W)[1]


@register("k_model_validation")
def k_model_validation(spark, sf):
    """Every model's hold-out and walk-forward metrics per entity."""
    return model_tables(features(spark, sf), W)["validation_metrics"]


def fit_all(series: DataFrame, cfg: PanelConfig = W, arima: DataFrame | None = None) -> DataFrame:
    """Stationarity -> ARIMA order -> residual diagnostics per entity,
    ranked by AIC; healthy iff residuals not autocorrelated and |cv - rmse| / rmse < 0.5.
    ``arima``: PRED rows of the ARIMA job, when they are there already."""
    stat = st.stationarity(series.select("entity", "idx", F.col("y").alias("returns")), "returns")
    checkpoint_dir(series.sparkSession)
    # grouped fits are the expensive part and feed five tables: cut them out once
    r = arima if arima is not None else MODEL_REGISTRY["ARIMA"](labelled_rows(series, cfg), cfg).checkpoint(eager=True)
    fit = (r.where(F.col("fold") == -2).groupBy("entity")
           .agg(F.first("spec", True).alias("spec"), F.first("aic", True).alias("aic"),
                F.first("bic", True).alias("bic"), F.first("error", True).alias("error"))
           .select("entity", F.split("spec", "x")[0].alias("order"), F.split("spec", "x")[1].alias("seasonal_order"),
                   "aic", "bic", "error"))
    res = r.where(F.col("role") == "insample").select("entity", F.col("i").alias("idx"),
                                                       (F.col("y") - F.col("yhat")).alias("resid"))
    lb = st.ljung_box(res, "resid", 10).select("entity", "lb_pvalue", "autocorrelated")
    jb = st.jarque_bera(res, "resid").select("entity", "jb_stat", "jb_pvalue")
    ins = fc.error_metrics(r.where((F.col("role") == "insample") & (F.col("fold") == -2)), ("entity", "model")).select("entity", "rmse")
    cv = fc.cv_summary(fc.error_metrics(r.where((F.col("role") == "test") & (F.col("fold") >= 0)),
                                        ("entity", "model", "fold"))).select("entity", "cv_rmse")
    out = (fit.join(stat.select("entity", "adf_pval", "kpss_pval", "d_suggested"), "entity", "left")
           .join(lb, "entity", "left").join(jb, "entity", "left").join(ins, "entity", "left").join(cv, "entity", "left"))
    gap = F.coalesce(F.try_divide(F.abs(F.col("cv_rmse") - F.col("rmse")), F.col("rmse")), F.lit(0.0))
    out = out.select("*", (~F.coalesce(F.col("autocorrelated"), F.lit(False)) & (gap < 0.5)).alias("healthy"),
                     round_half_up(F.col("aic"), 2).alias("aic_2dp"), round_half_up(F.col("bic"), 2).alias("bic_2dp"),
                     round_half_up(F.col("lb_pvalue"), 4).alias("lb_pvalue_4dp"))
    from panelkit.operators.ranking import global_rank
    return global_rank(out, [F.col("aic").asc_nulls_last(), F.col("entity")], "aic_rank")


@register("m12_fit_all")
def m12_fit_all(spark, sf):
    """Per-entity model summary ranked by AIC."""
    return fit_all(_series(spark, sf))
