"""Folds, AR(1) baseline jobs, CV, hold-out, accuracy metrics, price paths."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelkit.operators import folds as fo
from panelkit.operators import forecast as fc
from panelkit.plans.catalog import final, register
from panelkit.plans.queries_core import features
from panelkit.plans.sqlref import features_ctes

SER = """ser AS (SELECT entity, idx, ts, CAST(row_number() OVER (PARTITION BY entity ORDER BY idx) - 1 AS INTEGER) AS i,
                 returns AS y, count(*) OVER (PARTITION BY entity) AS n FROM feats WHERE returns IS NOT NULL)"""

def folds_cte(name: str = "rws") -> str:
    """The labelled rows of the walk-forward folds."""
    return f"""fg AS (SELECT s.*, g.fold, n // 6 AS fold_size, least(n // 6, 12) AS take
       FROM ser s CROSS JOIN (SELECT CAST(unnest(generate_series(0, 4)) AS INTEGER) AS fold) g WHERE n >= 6),
fr AS (SELECT *, CASE WHEN i < n - (5 - fold) * fold_size THEN 'train'
                      WHEN i < n - (5 - fold) * fold_size + take THEN 'test' END AS role,
              i - (n - (5 - fold) * fold_size) + 1 AS step0 FROM fg),
{name} AS (SELECT entity, idx, ts, i, y, n, fold, role, CAST(CASE WHEN role = 'test' THEN step0 END AS INTEGER) AS step
        FROM fr WHERE role IS NOT NULL AND take >= 2 AND fold_size >= 1)"""


def hold_cte(name: str = "rws") -> str:
    """The labelled rows of the hold-out."""
    return f"""{name} AS (SELECT *, -1 AS fold, CASE WHEN i < CAST(floor(n * 0.8) AS INTEGER) THEN 'train' ELSE 'test' END AS role,
                CASE WHEN i >= CAST(floor(n * 0.8) AS INTEGER) THEN i - CAST(floor(n * 0.8) AS INTEGER) + 1 END AS step FROM ser)"""


def full_cte(name: str = "rws") -> str:
    """The rows of the full fit."""
    return f"""{name} AS (SELECT *, -2 AS fold, 'train' AS role, CAST(NULL AS INTEGER) AS step FROM ser)"""


FOLDS, HOLD, FULL = folds_cte(), hold_cte(), full_cte()

AR = """l AS (SELECT *, CASE WHEN role = 'train' THEN lag(y) OVER (PARTITION BY entity, fold ORDER BY i) END AS ylag FROM rws),
f1 AS (SELECT *, regr_slope(CASE WHEN role = 'train' THEN y END, ylag) OVER p AS phi0,
                 regr_intercept(CASE WHEN role = 'train' THEN y END, ylag) OVER p AS c0,
                 avg(CASE WHEN role = 'train' THEN y END) OVER p AS mean0,
                 max(CASE WHEN role = 'train' THEN i END) OVER p AS i_last
       FROM l WINDOW p AS (PARTITION BY entity, fold)),
f2 AS (SELECT *, coalesce(phi0, 0.0) AS phi, CASE WHEN phi0 IS NULL THEN mean0 ELSE c0 END AS c FROM f1),
f3 AS (SELECT *, sum(CASE WHEN role = 'train' AND ylag IS NOT NULL THEN (y - c - phi * ylag) * (y - c - phi * ylag) END) OVER p AS ssr,
                 count(CASE WHEN role = 'train' AND ylag IS NOT NULL THEN 1 END) OVER p AS np,
                 max(CASE WHEN role = 'train' AND i = i_last THEN y END) OVER p AS y_last
       FROM f2 WINDOW p AS (PARTITION BY entity, fold)),
f4 AS (SELECT *, sqrt(ssr / greatest(np - 2, 1)) AS sigma, i - i_last AS h FROM f3),
pred AS (SELECT entity, 'AR1' AS model, fold, 'test' AS role, step, i, y,
           CASE WHEN abs(phi - 1) < 1e-12 THEN y_last + c * h ELSE c * (1 - pow(phi, h)) / (1 - phi) + pow(phi, h) * y_last END AS yhat
         FROM f4 WHERE role = 'test'
         UNION ALL
         SELECT entity, 'AR1', fold, 'insample', NULL, i, y, c + phi * ylag FROM f4 WHERE role = 'train' AND ylag IS NOT NULL)"""


def METRICS(src, keys, variant="abs", names=("mt0", "mt")):
    ape = ("abs((y - yhat) / (abs(y) + 1e-10))" if variant == "abs"
           else "abs((y - yhat) / CASE WHEN y <> 0 THEN y ELSE 1e-10 END)")
    k = ", ".join(keys)
    return f"""{names[0]} AS (SELECT {k}, y, y - yhat AS e, {ape} AS ape, 2.0 * abs(y - yhat) / (abs(y) + abs(yhat) + 1e-10) AS sm,
                 avg(y) OVER (PARTITION BY {k}) AS ym FROM {src} WHERE y IS NOT NULL AND yhat IS NOT NULL),
{names[1]} AS (SELECT {k}, sqrt(avg(e * e)) AS rmse, avg(abs(e)) AS mae, avg(ape) * 100 AS mape, avg(sm) * 100 AS smape,
              1 - sum(e * e) / (sum((y - ym) * (y - ym)) + 1e-10) AS r2, stddev_pop(e) AS residual_std, count(*) AS n
       FROM {names[0]} GROUP BY {k})"""


def _with(*ctes):
    return "WITH " + features_ctes("nation") + ",\n" + ",\n".join(ctes) + "\n"


def _series(spark, sf):
    return fo.target_series(features(spark, sf), "returns")


@register("p_holdout_split", _with(SER, HOLD, """c AS (SELECT entity, count_if(role = 'train') AS n_train, count_if(role = 'test') AS n_test,
  max(CASE WHEN role = 'train' THEN ts END) AS last_train_ts, min(CASE WHEN role = 'test' THEN ts END) AS first_test_ts FROM rws GROUP BY entity)""")
    + final("c", "entity n_train n_test last_train_ts first_test_ts"))
def p_holdout_split(spark, sf):
    """Positional 80/20 split of each entity's returns."""
    r = fo.holdout(_series(spark, sf), 0.2)
    return r.groupBy("entity").agg(
        F.count_if(F.col("role") == "train").alias("n_train"), F.count_if(F.col("role") == "test").alias("n_test"),
        F.max(F.when(F.col("role") == "train", F.col("ts"))).alias("last_train_ts"),
        F.min(F.when(F.col("role") == "test", F.col("ts"))).alias("first_test_ts"))


@register("p_walk_forward_folds", _with(SER, FOLDS, """c AS (SELECT entity, fold, count_if(role = 'train') AS n_train, count_if(role = 'test') AS n_test,
  min(CASE WHEN role = 'test' THEN i END) AS test_start, max(step) AS max_step FROM rws GROUP BY ALL)""")
    + final("c", "entity fold n_train n_test test_start max_step"))
def p_walk_forward_folds(spark, sf):
    """P10: 5 expanding folds, test size n // 6 cut to 12 steps."""
    r = fo.walk_forward(_series(spark, sf), 5, 12)
    return r.groupBy("entity", "fold").agg(
        F.count_if(F.col("role") == "train").alias("n_train"), F.count_if(F.col("role") == "test").alias("n_test"),
        F.min(F.when(F.col("role") == "test", F.col("i"))).alias("test_start"), F.max("step").alias("max_step"))


@register("p_future_dates", _with("""lastb AS (SELECT entity, max(idx) AS last_idx FROM feats GROUP BY entity),
fut AS (SELECT entity, CAST(unnest(generate_series(1, 12)) AS INTEGER) AS step, last_idx FROM lastb),
d AS (SELECT entity, step, DATE '1970-01-04' + CAST((last_idx + step) * 7 AS INTEGER) AS ts FROM fut)""")
    + final("d", "entity step ts"))
def p_future_dates(spark, sf):
    """12 weekly dates after each entity's last week (last excluded)."""
    f = features(spark, sf)
    last = f.groupBy("entity").agg(F.max("idx").alias("last_idx"))
    return fo.future_dates(last, "W", 12)


@register("m_ar1_cv", _with(SER, FOLDS, AR, METRICS("(SELECT * FROM pred WHERE role = 'test')", ["entity", "model", "fold"]),
                            """cv AS (SELECT entity, model, avg(rmse) AS cv_rmse, stddev_pop(rmse) AS cv_rmse_std, avg(mae) AS cv_mae,
  stddev_pop(mae) AS cv_mae_std, avg(mape) AS cv_mape, stddev_pop(mape) AS cv_mape_std, count(*) AS n_folds FROM mt GROUP BY ALL)""")
    + final("cv", "entity model cv_rmse:9 cv_rmse_std:9 cv_mae:9 cv_mae_std:9 cv_mape:s10 cv_mape_std:s10 n_folds"),
    scale=9, overrides={"cv_mape": "s10", "cv_mape_std": "s10"})
def m_ar1_cv(spark, sf):
    """Walk-forward CV of the AR(1) baseline (fold mean and population std)."""
    pred = fc.ar1_jobs(_series(spark, sf), fo.fold_slots(5, 12, full=False))
    return fc.cv_summary(fc.error_metrics(pred, ("entity", "model", "fold")))


HOLDOUT_SQL_CTES = (SER, HOLD, AR, METRICS("(SELECT * FROM pred WHERE role = 'test')", ["entity", "model", "fold"], "signed"),
                    """nv AS (SELECT entity, avg(ad) AS naive_mae, count(*) AS n_train FROM
      (SELECT entity, abs(y - lag(y) OVER (PARTITION BY entity ORDER BY i)) AS ad FROM rws WHERE role = 'train') GROUP BY entity),
ho AS (SELECT mt.entity, mt.model, mt.mae, mt.rmse, mt.mape,
              CASE WHEN nv.n_train >= 2 AND nv.naive_mae <> 0 THEN mt.mae / nv.naive_mae END AS mase, nv.n_train, mt.n AS n_test
       FROM mt LEFT JOIN nv ON mt.entity = nv.entity)""")


@register("m_ar1_holdout", _with(*HOLDOUT_SQL_CTES) + final("ho", "entity model mae:9 rmse:9 mape:s10 mase:9 n_train n_test"),
          scale=9, overrides={"mape": "s10"})
def m_ar1_holdout(spark, sf):
    """80/20 hold-out of the AR(1) baseline with MASE."""
    rows = fo.holdout(_series(spark, sf), 0.2)
    return fc.holdout_report(fc.ar1_predict(rows), rows)


@register("a_macro_average", _with(*HOLDOUT_SQL_CTES, """ma AS (SELECT model, avg(mae) AS mae, avg(rmse) AS rmse, avg(mape) AS mape, avg(mase) AS mase FROM ho GROUP BY model)""")
    + final("ma", "model mae:9 rmse:9 mape:s10 mase:9"), scale=9, overrides={"mape": "s10"})
def a_macro_average(spark, sf):
    """Macro average over entities (nulls ignored)."""
    rows = fo.holdout(_series(spark, sf), 0.2)
    return fc.macro_average(fc.holdout_report(fc.ar1_predict(rows), rows))


@register("g_insample_metrics", _with(SER, FULL, AR, METRICS("(SELECT * FROM pred WHERE role = 'insample')", ["entity", "model"]))
    + final("mt", "entity model rmse:9 mae:9 mape:s10 smape:s10 r2:9 residual_std:9 n"),
    scale=9, overrides={"mape": "s10", "smape": "s10"})
def g_insample_metrics(spark, sf):
    """In-sample rmse, mae, mape, smape, r2, residual std of the AR(1) fit."""
    s = _series(spark, sf)
    rows = s.select("*", F.lit(-2).alias("fold"), F.lit("train").alias("role"), F.lit(None).cast("int").alias("step"))
    pred = fc.ar1_predict(rows)
    return fc.error_metrics(pred.where(F.col("role") == "insample"), ("entity", "model"))


FUT = """fit AS (SELECT entity, fold, any_value(phi) AS phi, any_value(c) AS c, any_value(sigma) AS sigma, any_value(y_last) AS y_last,
                 any_value(i_last) AS i_last FROM f4 GROUP BY entity, fold),
fx AS (SELECT *, CAST(unnest(generate_series(1, 12)) AS INTEGER) AS step FROM fit),
fut AS (SELECT entity, 'AR1' AS model, step,
          CASE WHEN abs(phi - 1) < 1e-12 THEN y_last + c * step ELSE c * (1 - pow(phi, step)) / (1 - phi) + pow(phi, step) * y_last END AS yhat,
          sigma * sqrt(CASE WHEN abs(phi * phi - 1) < 1e-12 THEN CAST(step AS DOUBLE) ELSE (1 - pow(phi, 2 * step)) / (1 - phi * phi) END) AS se
        FROM fx),
fb AS (SELECT entity, model, step, yhat, yhat - 1.959963984540054 * se AS lower, yhat + 1.959963984540054 * se AS upper FROM fut),
lp AS (SELECT entity, arg_max(close, idx) AS last_price FROM feats WHERE close IS NOT NULL GROUP BY entity),
pp AS (SELECT fb.*, lp.last_price,
          lp.last_price * exp(sum(yhat) OVER c) AS price_forecast, lp.last_price * exp(sum(lower) OVER c) AS price_lower,
          lp.last_price * exp(sum(upper) OVER c) AS price_upper
       FROM fb JOIN lp USING (entity)
       WINDOW c AS (PARTITION BY entity, model ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
ppw AS (SELECT *, price_upper - price_lower AS ci_width FROM pp)"""


def _prices(spark, sf):
    f = features(spark, sf)
    s = fo.target_series(f, "returns")
    fut = fc.ar1_forecast(s, 12)
    last = f.where(F.col("close").isNotNull()).groupBy("entity").agg(F.max_by("close", "idx").alias("last_price"))
    return fc.to_price(fut, last)


@register("m_price_forecast", _with(SER, FULL, AR, FUT)
    + final("ppw", "entity model step yhat:9 lower:9 upper:9 last_price:6 price_forecast:s10 price_lower:s10 price_upper:s10 ci_width:s10"),
    scale=9, overrides={"last_price": 6, "price_forecast": "s10", "price_lower": "s10", "price_upper": "s10", "ci_width": "s10"})
def m_price_forecast(spark, sf):
    """12-step AR(1) return forecast with 95 % interval, turned into prices."""
    return _prices(spark, sf)


@register("m_forecast_change", _with(SER, FULL, AR, FUT, """ch AS (SELECT entity, model, arg_max(price_forecast, step) AS final_price,
  any_value(last_price) AS last_price, arg_min(ci_width, step) AS ci_first, arg_max(ci_width, step) AS ci_last FROM ppw GROUP BY ALL),
cc AS (SELECT *, (final_price - last_price) / NULLIF(last_price, 0) * 100 AS change_pct,
              (ci_last - ci_first) / NULLIF(ci_first, 0) * 100 AS ci_growth_pct,
              (ci_last - ci_first) / NULLIF(ci_first, 0) * 100 > 100 AS ci_widens FROM ch)""")
    + final("cc", "entity model final_price:s10 last_price:6 change_pct:s10 ci_first:s10 ci_last:s10 ci_growth_pct:s10 ci_widens"),
    scale=6, overrides={"final_price": "s10", "change_pct": "s10", "ci_first": "s10", "ci_last": "s10", "ci_growth_pct": "s10"})
def m_forecast_change(spark, sf):
    """Forecast change vs last price and CI widening."""
    return fc.forecast_change(_prices(spark, sf))
