"""The exported documents, written as JSON, read back by their schema and compared section
by section with the SQL of the tables they were built from (K7-K10, S15, T1, A3, A15).
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from panelkit.functions.scalar import round_half_up
from panelkit.operators import eda
from panelkit.operators import folds as fo
from panelkit.operators import forecast as fc
from panelkit.operators import stattests as st
from panelkit.operators.decompose import decompose
from panelkit.operators.outliers import detect_outliers, outlier_summary, residual_stats
from panelkit.plans import document as dc
from panelkit.plans import export as ex
from panelkit.plans import queries_eda, queries_stats  # noqa: F401  (their SQL is reused)
from panelkit.plans import queries_models as qm
from panelkit.plans.catalog import ORACLES, final, register
from panelkit.plans.queries_core import H, W, features, weekly
from panelkit.plans.queries_decomp import _outlier_sql
from panelkit.plans.queries_forecast import AR, full_cte
from panelkit.plans.sqlref import decomp_ctes, decomp_final_cte, features_ctes, rnd_sig, weekly_ctes
from panelkit.session import checkpoint_dir

#: The models of the documents here: those whose rows SQL can give too.
MODELS = ("Trend", "AR1", "Zero")


def event_document(spark, sf):
    """The hourly panel with its outliers: series, KPIs, outliers and their share, statistics, AR(1) forecast."""
    wk = weekly(spark, sf, "event", H)  # one panel, with outliers, for all sections
    f = features(spark, sf, "event", H)
    return dc.document(spark, {
        "kpis": eda.kpis(f),
        "series": ex.series_arrays(f, "close", "values", more=("returns",)),
        "outliers": detect_outliers(wk, H.seasonal_period),
        "outlier_summary": outlier_summary(wk, H.seasonal_period),
        "residual_stats": residual_stats(wk, H.seasonal_period),
        "price_forecast": fc.ar1_forecast(fo.target_series(f, "returns"), 12),
    })


def nation_tables(spark, sf, *names):
    """The named tables of the weekly panel (all when none is named), and the KPIs. The
    panel, and the rows of the models where a table rests on them, are written once."""
    checkpoint_dir(spark)
    f = features(spark, sf).checkpoint(eager=True)
    P = W.seasonal_period
    build = {
        "kpis": lambda: eda.kpis(f),
        "series": lambda: ex.series_arrays(f, "close", "values", more=("returns",)),
        "decomposition": lambda: decompose(f, P),
        "stationarity": lambda: st.stationarity(f, "returns"),
        "outliers": lambda: detect_outliers(f, P),
        "outlier_summary": lambda: outlier_summary(f, P),
        "residual_stats": lambda: residual_stats(f, P),
        "metadata": lambda: dc.metadata(f, W),
        "best_worst": lambda: eda.best_worst(f),
        "ranking": lambda: eda.return_ranking(f),
    }
    names = {"kpis", *(names or (*build, "price_forecast", "model_residuals", "model_comparison"))}
    out = {n: build[n]() for n in build if n in names}
    if names - set(build):
        folds = qm.labelled_rows(fo.target_series(f, "returns"), W, cv="model_comparison" in names)
        pred = qm.model_jobs(folds, W, MODELS).checkpoint(eager=True)
        models = {"price_forecast": lambda: qm.forecast_tables(f, pred, W)[1],
                  "model_residuals": lambda: qm.residuals(pred.where("model <> 'Zero'"), folds.series),
                  "model_comparison": lambda: qm.comparison(pred)}
        out |= {n: models[n]() for n in models if n in names}
    return out


def _written(spark, sf, *names) -> str:
    """A folder of its own with the documents of these tables."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/documents-{uuid.uuid4().hex}"
    dc.write_documents(spark, nation_tables(spark, sf, *names), path)
    return path


def _date(c: str):
    """The section's timestamp as the day that the weekly panel has."""
    return F.to_date(c)


# ------------------------------------------------------------------ one section at a time
def _series_rows(doc):
    zipped = F.posexplode(F.arrays_zip("series.dates", "series.values", "series.returns"))
    return doc.select("entity", zipped).select(
        "entity", F.col("col.dates").alias("date"), "pos", F.col("col.values").alias("value"), F.col("col.returns").alias("returns"))


def _decomposition_rows(doc):
    return doc.select("entity", "decomposition.model", "decomposition.period", F.inline("decomposition.points")).withColumn("ts", _date("ts"))


def _keyed_rows(doc, section):
    return doc.select("entity", F.explode(section).alias("model", "rows")).select("entity", "model", F.inline("rows"))


def _forecast_rows(doc):
    return _keyed_rows(doc, "forecast").withColumn("date", _date("date"))


def _residual_rows(doc):
    return _keyed_rows(doc, "residuals").withColumn("ts", _date("ts"))


def _comparison_rows(doc):
    m = doc.select("entity", "comparison.best_model", "comparison.high_mape", F.explode("comparison.metrics").alias("model", "x"))
    return m.select("entity", "model", "best_model", "high_mape", "x.*").drop("training_time_s")  # a time differs at every run


def _outlier_rows(doc):
    return doc.select("entity", F.inline("outliers")).withColumn("date", _date("date"))


SERIES_SQL = "WITH " + features_ctes("nation") + """,
o AS (SELECT entity, strftime(ts, '%Y-%m-%d') AS date, CAST(row_number() OVER (PARTITION BY entity ORDER BY ts) - 1 AS INTEGER) AS pos,
             close AS value, returns FROM feats)
""" + final("o", "entity date pos value:6 returns:9")
DECOMPOSITION_SQL = ("WITH " + weekly_ctes("nation", "W") + decomp_ctes(52) + decomp_final_cte(52) + "\n"
                     + final("dec", "entity ts pos observed:4 trend:4 seasonal:4 resid:4 model period"))
OUTLIERS_SQL = _outlier_sql("nation", "W", 52, 4)
#: The three models' next 12 weeks, with dates and price paths.
FORECAST_SQL = qm._trend_sql(AR, """ar AS (SELECT DISTINCT entity, phi, c, sigma, y_last FROM f4),
sp AS (SELECT CAST(unnest(generate_series(1, 12)) AS INTEGER) AS step),
ah AS (SELECT *, CASE WHEN abs(phi - 1) < 1e-12 THEN y_last + c * step ELSE c * (1 - pow(phi, step)) / (1 - phi) + pow(phi, step) * y_last END AS yhat,
        1.959963984540054 * sigma * sqrt(CASE WHEN abs(phi * phi - 1) < 1e-12 THEN CAST(step AS DOUBLE) ELSE (1 - pow(phi, 2 * step)) / (1 - phi * phi) END) AS half
       FROM ar CROSS JOIN sp),
zh AS (SELECT entity, step, 1.959963984540054 * sd AS half FROM (SELECT entity, stddev_pop(y) AS sd FROM ser GROUP BY entity) CROSS JOIN sp),
fu AS (SELECT entity, model, step, yhat, lower, upper FROM tp WHERE role = 'future' UNION ALL
       SELECT entity, 'AR1', step, yhat, yhat - half, yhat + half FROM ah UNION ALL SELECT entity, 'Zero', step, 0.0, -half, half FROM zh),
lp AS (SELECT entity, arg_max(close, idx) AS last_price FROM feats WHERE close IS NOT NULL GROUP BY entity),
lb AS (SELECT entity, max(idx) AS last_idx FROM feats GROUP BY entity),
pw AS (SELECT fu.*, DATE '1970-01-04' + CAST((last_idx + step) * 7 AS INTEGER) AS date, last_price * exp(sum(yhat) OVER c) AS price_forecast,
         last_price * exp(sum(lower) OVER c) AS price_lower, last_price * exp(sum(upper) OVER c) AS price_upper
       FROM fu JOIN lp USING (entity) JOIN lb USING (entity)
       WINDOW c AS (PARTITION BY entity, model ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
o AS (SELECT *, price_upper - price_lower AS ci_width FROM pw)""", rows=full_cte()) + final(
    "o", "entity model step date yhat:8 lower:8 upper:8 price_forecast:s8 price_lower:s8 price_upper:s8 ci_width:s8")
PRICES = dict.fromkeys(("price_forecast", "price_lower", "price_upper", "ci_width"), "s8")


@register("k_document_series", SERIES_SQL, overrides={"returns": 9})
def k_document_series(spark, sf):
    """K7/K9: the series section (dates, values, returns), read back."""
    return _series_rows(dc.read_documents(spark, _written(spark, sf, "series")))


@register("k_document_decomposition", DECOMPOSITION_SQL, scale=4)
def k_document_decomposition(spark, sf):
    """The decomposition section, read back."""
    return _decomposition_rows(dc.read_documents(spark, _written(spark, sf, "decomposition")))


@register("k_document_stationarity", ORACLES["x_stationarity_returns"], scale=8)
def k_document_stationarity(spark, sf):
    """The stationarity section, read back."""
    return dc.read_documents(spark, _written(spark, sf, "stationarity")).select("entity", "stationarity.*")


def _event_section(spark, sf, name):
    path = f"{checkpoint_dir(spark).rstrip('/')}/documents-{uuid.uuid4().hex}"
    ex.write_table(event_document(spark, sf), path, "json")
    return ex.read_document(spark, path).select("entity", f"{name}.*")


@register("k_document_outlier_share", ORACLES["o_outlier_summary"])
def k_document_outlier_share(spark, sf):
    """Count and share of outliers in the documents of the hourly panel, read back."""
    return _event_section(spark, sf, "outlier_summary")


@register("k_document_residual_stats", ORACLES["o_residual_stats"])
def k_document_residual_stats(spark, sf):
    """Residual statistics in the documents of the hourly panel, read back."""
    return _event_section(spark, sf, "residual_stats")


@register("k_document_forecast", FORECAST_SQL, scale=8, overrides=PRICES)
def k_document_forecast(spark, sf):
    """Every model's forecast section with dates and price paths, read back."""
    return _forecast_rows(dc.read_documents(spark, _written(spark, sf, "price_forecast")))


@register("k_document_residuals", ORACLES["m8_insample_residuals"], scale=8)
def k_document_residuals(spark, sf):
    """K7/M8: every model's dated residuals, read back."""
    return _residual_rows(dc.read_documents(spark, _written(spark, sf, "model_residuals")))


@register("k_document_comparison", ORACLES["m13_direct_comparison"], scale=9, overrides={"mape": "s9", "smape": "s9"})
def k_document_comparison(spark, sf):
    """The comparison section (best model, metrics by model), read back."""
    return _comparison_rows(dc.read_documents(spark, _written(spark, sf, "model_comparison")))


# ------------------------------------------------------------------ the tables of rows
METADATA_SQL = "WITH " + features_ctes("nation") + """
SELECT entity, CAST(min(ts) AS TIMESTAMP) AS first_date, CAST(max(ts) AS TIMESTAMP) AS last_date, count(*) AS n_periods, count(close) AS n_values,
       'close' AS value_column, 'W' AS resample_freq, 12 AS forecast_horizon, 52 AS seasonal_period FROM feats GROUP BY entity"""


@register("k_document_metadata", METADATA_SQL)
def k_document_metadata(spark, sf):
    """The run's metadata as rows, one per entity, read back."""
    return dc.read_run_table(spark, _written(spark, sf, "metadata"), "metadata")


@register("k_document_overall", ORACLES["a_best_worst"], scale=9)
def k_document_overall(spark, sf):
    """K7/A3: the overall KPIs, read back."""
    return dc.read_run_table(spark, _written(spark, sf, "best_worst"), "best_worst")


@register("k_document_ranking", ORACLES["a_total_return_rank"], overrides={"total_return": 9, "return_pct_1dp": 1})
def k_document_ranking(spark, sf):
    """The ranking by total return, read back."""
    return dc.read_run_table(spark, _written(spark, sf, "ranking"), "ranking")


# ------------------------------------------------------------------ the whole document
#: A section: its rows, a column whose sum stands for them, and the decimals of that column in the SQL.
PARTS = {"series": (_series_rows, "value", 6, SERIES_SQL), "decomposition": (_decomposition_rows, "trend", 4, DECOMPOSITION_SQL),
         "stationarity": (lambda d: d.select("entity", "stationarity.*"), "adf_stat", 8, ORACLES["x_stationarity_returns"]),
         "outliers": (_outlier_rows, "residual", 4, OUTLIERS_SQL), "forecast": (_forecast_rows, "upper", 8, FORECAST_SQL),
         "residuals": (_residual_rows, "yhat", 8, ORACLES["m8_insample_residuals"]),
         "comparison": (_comparison_rows, "rmse", 9, ORACLES["m13_direct_comparison"])}
KEYED = ("forecast", "residuals", "comparison")


def _digest_sql() -> str:
    def part(name):
        model = "model" if name in KEYED else "CAST(NULL AS VARCHAR)"
        _, value, _, sql = PARTS[name]
        return (f"SELECT entity, '{name}' AS section, {model} AS model, count(*) AS n, count({value}) AS n_values, "
                f"{rnd_sig(f'sum({value})', 7)} AS total FROM ({sql}) GROUP BY ALL")

    return "\nUNION ALL ".join(part(name) for name in PARTS)


@register("k_document", _digest_sql(), overrides={"total": "s7"})
def k_document(spark, sf):
    """K7/K8/K9: the whole document with every section, read back; per entity, section and
    model its number of rows, of values, and the sum of the rounded values."""
    doc = dc.read_documents(spark, _written(spark, sf))
    out = None
    for name, (rows, value, scale, _) in PARTS.items():
        r = rows(doc)
        keys = ["entity", F.lit(name).alias("section"), (F.col("model") if name in KEYED else F.lit(None).cast("string")).alias("model")]
        g = r.select(*keys, round_half_up(F.col(value), scale).alias("v")).groupBy("entity", "section", "model").agg(
            F.count("*").alias("n"), F.count("v").alias("n_values"), F.sum("v").alias("total"))
        out = g if out is None else out.unionByName(g)
    return out


@register("k_document_text")
def k_document_text(spark, sf):
    """K7/K8/K9: the documents of the hourly panel as JSON text."""
    doc = event_document(spark, sf)
    return doc.select("entity", F.to_json(F.struct(*[c for c in doc.columns if c != "entity"])).alias("document"))
