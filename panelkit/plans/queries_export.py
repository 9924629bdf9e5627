"""Export-shaped queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelkit.functions.scalar import round_half_up, strip_suffix
from panelkit.operators import eda
from panelkit.operators import folds as fo
from panelkit.operators import forecast as fc
from panelkit.plans import export as ex
from panelkit.plans.catalog import final, register
from panelkit.plans.queries_core import H, W, features, panel
from panelkit.plans.queries_eda import TR
from panelkit.plans.queries_forecast import AR, FULL, FUT, SER
from panelkit.plans.sqlref import features_ctes, rnd
from panelkit.sources.files import with_cache_fallback


def _with(*ctes):
    return "WITH " + features_ctes("nation") + ",\n" + ",\n".join(ctes) + "\n"


@register("k_series_arrays", _with("""a AS (SELECT entity, list(strftime(ts, '%Y-%m-%d') ORDER BY ts) AS dates,
  list(""" + rnd("close", 6) + """ ORDER BY ts) AS "values" FROM feats GROUP BY entity)""") + 'SELECT entity, dates, "values" FROM a')
def k_series_arrays(spark, sf):
    """Per-entity ISO dates and values arrays, ordered by date."""
    a = ex.series_arrays(features(spark, sf), "close", "values")
    return a.select("entity", "dates", F.transform("values", lambda v: round_half_up(v, 6)).alias("values"))


@register("k_landing_subset", _with(TR, """bw AS (SELECT (SELECT entity FROM tr ORDER BY total_return DESC, entity DESC LIMIT 1) AS best_entity,
                          (SELECT entity FROM tr ORDER BY total_return ASC, entity ASC LIMIT 1) AS worst_entity),
ids AS (SELECT best_entity AS entity, 'best' AS side FROM bw UNION ALL SELECT worst_entity, 'worst' FROM bw),
d0 AS (SELECT entity, idx, ts, close, max(close) OVER (PARTITION BY entity ORDER BY idx ROWS UNBOUNDED PRECEDING) AS peak FROM v),
d AS (SELECT entity, idx, ts, close, CASE WHEN peak = 0 THEN 0.0 ELSE (close - peak) / peak * 100 END AS drawdown FROM d0),
o AS (SELECT d.*, ids.side FROM d JOIN ids USING (entity))""") + final("o", "entity idx ts close:6 drawdown:9 side"),
    overrides={"drawdown": 9})
def k_landing_subset(spark, sf):
    """Best and worst entity series with drawdown for the landing page."""
    f = features(spark, sf)
    return ex.landing_subset(f, eda.best_worst(f))


@register("k_forecasts_dated", _with(SER, FULL, AR, FUT, """lastb AS (SELECT entity, max(idx) AS last_idx FROM feats GROUP BY entity),
k AS (SELECT fb.entity, fb.model, fb.step, DATE '1970-01-04' + CAST((lastb.last_idx + fb.step) * 7 AS INTEGER) AS date,
             fb.yhat AS forecast, fb.lower AS lower_bound, fb.upper AS upper_bound FROM fb JOIN lastb USING (entity))""")
    + final("k", "entity model step date forecast:9 lower_bound:9 upper_bound:9"), scale=9)
def k_forecasts_dated(spark, sf):
    """Forecasts table keeping the forecast date (fixes the lost index)."""
    f = features(spark, sf)
    fut = fc.ar1_forecast(fo.target_series(f, "returns"), 12)
    dates = fo.future_dates(f.groupBy("entity").agg(F.max("idx").alias("last_idx")), "W", 12)
    return fut.join(dates, ["entity", "step"]).select(
        "entity", "model", "step", F.col("ts").alias("date"), F.col("yhat").alias("forecast"),
        F.col("lower").alias("lower_bound"), F.col("upper").alias("upper_bound"))


@register("s_cache_fallback", """WITH fresh AS (SELECT event_type AS entity, CAST(ts AS TIMESTAMP) AS ts, CAST(value AS DOUBLE) AS close FROM events),
cache AS (SELECT o_orderpriority AS entity, CAST(o_orderdate AS TIMESTAMP) AS ts, CAST(o_totalprice AS DOUBLE) AS close FROM orders),
u AS (SELECT * FROM fresh UNION ALL SELECT * FROM cache WHERE entity NOT IN (SELECT DISTINCT entity FROM fresh)),
g AS (SELECT entity, count(*) AS n_rows, min(ts) AS first_ts, max(ts) AS last_ts FROM u GROUP BY entity)
SELECT * FROM g""")
def s_cache_fallback(spark, sf):
    """Per entity, fresh rows when it has any, else the cached rows (left anti join)."""
    fresh = panel(spark, sf, "event").select("entity", "ts", "close")
    cache = panel(spark, sf, "priority").select("entity", "ts", "close")
    u = with_cache_fallback(fresh, cache)
    return u.groupBy("entity").agg(F.count("*").alias("n_rows"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


@register("t_display_ranking", _with(TR, """r AS (SELECT regexp_replace(entity, '\\.SA$', '') AS display, entity,
  """ + rnd("total_return * 100", 1) + """ AS return_pct_1dp,
  (SELECT max(total_return) FROM tr) / NULLIF((SELECT min(total_return) FROM tr), 0) AS best_worst_ratio FROM tr)""")
    + final("r", "display entity return_pct_1dp:1 best_worst_ratio:9"), overrides={"return_pct_1dp": 1, "best_worst_ratio": 9})
def t_display_ranking(spark, sf):
    """Display names without the exchange suffix, returns in % (1 dp), best/worst ratio."""
    return display_ranking(features(spark, sf))


def display_ranking(f):
    r = eda.total_returns(f)
    # one scalar from a global aggregate, brought back as a literal (no join)
    ratio = eda.best_worst(f).select(F.try_divide(F.col("best_return"), F.col("worst_return"))).first()[0]
    return r.withColumn("best_worst_ratio", F.lit(ratio).cast("double")).select(
        strip_suffix(F.col("entity")).alias("display"), "entity",
        round_half_up(F.col("total_return") * 100, 1).alias("return_pct_1dp"), "best_worst_ratio")


@register("k_metadata", _with("""m AS (SELECT count(DISTINCT entity) AS n_entities, list(DISTINCT entity ORDER BY entity) AS tickers,
  min(ts) AS first_date, max(ts) AS last_date, 'W' AS resample_freq, 12 AS forecast_horizon, 52 AS seasonal_period FROM feats)""")
    + "SELECT * FROM m")
def k_metadata(spark, sf):
    """Metadata record derived from the panel (entities, span, frequency, horizon, period)."""
    f = features(spark, sf)
    return f.agg(F.count_distinct("entity").alias("n_entities"),
                 F.array_sort(F.collect_set("entity")).alias("tickers"),
                 F.min("ts").alias("first_date"), F.max("ts").alias("last_date"),
                 F.lit(W.freq).alias("resample_freq"), F.lit(W.horizon).alias("forecast_horizon"),
                 F.lit(W.seasonal_period).alias("seasonal_period"))


def _validation_sql() -> str:
    import re

    from panelkit.plans.queries_forecast import FOLDS, HOLDOUT_SQL_CTES, METRICS

    cv_chain = ",\n".join([FOLDS, AR, METRICS("(SELECT * FROM pred WHERE role = 'test')", ["entity", "model", "fold"]),
                           """cv AS (SELECT entity, model, avg(rmse) AS cv_rmse, stddev_pop(rmse) AS cv_rmse_std, avg(mae) AS cv_mae,
  stddev_pop(mae) AS cv_mae_std, avg(mape) AS cv_mape, stddev_pop(mape) AS cv_mape_std, count(*) AS n_folds FROM mt GROUP BY ALL)"""])
    for name in ("fg", "fr", "rws", "l", "f1", "f2", "f3", "f4", "pred", "mt0", "mt"):
        cv_chain = re.sub(rf"\b{name}\b(?=\s+AS \(|\s+WINDOW|\s*\)|\s+WHERE|\s+GROUP|\s*$|\s+CROSS)", f"{name}_cv", cv_chain)
        cv_chain = cv_chain.replace(f"FROM {name} ", f"FROM {name}_cv ").replace(f"FROM {name})", f"FROM {name}_cv)")
    j = """vm AS (SELECT ho.*, cv.cv_rmse, cv.cv_rmse_std, cv.cv_mae, cv.cv_mae_std, cv.cv_mape, cv.cv_mape_std, cv.n_folds
       FROM ho LEFT JOIN cv ON ho.entity = cv.entity AND ho.model = cv.model)"""
    return (_with(SER, *HOLDOUT_SQL_CTES[1:], cv_chain, j)
            + final("vm", "entity model mae:9 rmse:9 mape:s10 mase:9 n_train n_test cv_rmse:9 cv_rmse_std:9 "
                          "cv_mae:9 cv_mae_std:9 cv_mape:s10 cv_mape_std:s10 n_folds"))


@register("k_validation_metrics", _validation_sql(), scale=9,
          overrides={"mape": "s10", "cv_mape": "s10", "cv_mape_std": "s10"})
def k_validation_metrics(spark, sf):
    """K3: validation table = hold-out metrics joined with walk-forward CV (mean, std) per entity."""
    f = features(spark, sf)
    s = fo.target_series(f, "returns")
    rows = fo.holdout(s, 0.2)
    ho = fc.holdout_report(fc.ar1_predict(rows), rows)
    folds = fo.walk_forward(s, 5, 12)
    cv = fc.cv_summary(fc.error_metrics(fc.ar1_predict(folds).where(F.col("role") == "test"), ("entity", "model", "fold")))
    return ho.join(cv, ["entity", "model"], "left")


@register("s_csv_roundtrip", "WITH " + features_ctes("nation").split(",\nlagged0 AS")[0] + "\n"
          + final("weekly", "entity idx ts raw_close:6 close:6 pos has_gap"))
def s_csv_roundtrip(spark, sf):
    """The panel written as CSV text (entity, Date, Close, tb) into
    the shared checkpoint folder, read back through the CSV source (text ->
    number and date coercion), then resampled and filled: equals the Parquet path."""
    import uuid

    from panelkit.operators.resample import resample_fill
    from panelkit.session import checkpoint_dir
    from panelkit.sources.files import load_file

    path = f"{checkpoint_dir(spark).rstrip('/')}/csv-{uuid.uuid4().hex}.csv"
    p = panel(spark, sf, "nation")
    (p.select("entity", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("Date"),
              F.format_string("%.17g", F.col("close")).alias("Close"), F.col("tb").cast("string").alias("tb"))
     .write.option("header", True).csv(path))
    raw = load_file(spark, path, "entity", "Date", "Close", extra={"tb": "long"})
    return resample_fill(raw, W).select("entity", "idx", "ts", "raw_close", "close", "pos", "has_gap")
