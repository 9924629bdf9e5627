"""Explicit schemas of the long tables (never inferred)."""

from pyspark.sql import types as T

RAW = T.StructType([
    T.StructField("entity", T.StringType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("close", T.DoubleType()),
])

STATS = T.StructType([
    T.StructField("entity", T.StringType()),
    T.StructField("mean", T.DoubleType()),
    T.StructField("std", T.DoubleType()),
    T.StructField("q1", T.DoubleType()),
    T.StructField("q3", T.DoubleType()),
    T.StructField("iqr", T.DoubleType()),
    T.StructField("threshold", T.DoubleType()),
])

OBSERVATIONS = T.StructType([
    T.StructField("entity_id", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("value", T.DoubleType()),
])

# the exported document of one entity (plans.document)
DOCUMENT = """entity string,
  kpis struct<total_return_pct: double, peak_value: double, peak_date: timestamp, current_close: double>,
  series struct<dates: array<string>, `values`: array<double>, returns: array<double>>,
  decomposition struct<model: string, period: int,
    points: array<struct<pos: int, ts: timestamp, observed: double, trend: double, seasonal: double, resid: double>>>,
  stationarity struct<n: bigint, adf_stat: double, adf_pval: double, adf_lag: int, adf_stationary: boolean, kpss_stat: double,
    kpss_pval: double, kpss_lags: int, kpss_stationary: boolean, d_suggested: int, error: string>,
  outliers array<struct<date: timestamp, value: double, residual: double, lower_bound: double, upper_bound: double, severity: string>>,
  outlier_summary struct<count: bigint, pct_total: double>,
  residual_stats struct<mean: double, std: double, q1: double, q3: double, iqr: double, threshold: double>,
  forecast map<string, array<struct<step: int, date: timestamp, yhat: double, lower: double, upper: double,
    price_forecast: double, price_lower: double, price_upper: double, ci_width: double>>>,
  residuals map<string, array<struct<i: int, ts: timestamp, y: double, yhat: double, residual: double>>>,
  comparison struct<best_model: string, high_mape: boolean, metrics: map<string, struct<rmse: double, mae: double, mape: double,
    smape: double, r2: double, residual_std: double, cv_rmse: double, training_time_s: double, error: string>>>,
  models struct<`order`: string, seasonal_order: string, aic: double, bic: double, rmse: double, cv_rmse: double, lb_pvalue: double,
    autocorrelated: boolean, jb_stat: double, jb_pvalue: double, healthy: boolean, aic_rank: bigint, error: string>"""

# the tables of rows beside the documents
METADATA = """entity string, first_date timestamp, last_date timestamp, n_periods bigint, n_values bigint,
  value_column string, resample_freq string, forecast_horizon int, seasonal_period int"""
OVERALL = "best_entity string, best_return double, worst_entity string, worst_return double, n_entities bigint"
RANKING = "entity string, total_return double, return_pct_1dp double, rank bigint"
MODEL_RANKING = "entity string, `order` string, aic double, rank bigint"
