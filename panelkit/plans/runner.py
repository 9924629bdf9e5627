"""End-to-end batch run: RAW panel -> every table, lazily, then written.

The filled panel (the only input every later table shares) is cut from its
lineage once with a reliable checkpoint into ``spark.checkpoint.dir`` (the
shared folder the cluster names), so losing an executor never replays the
raw scan and aggregation, and the dozens of downstream plans do not
recompute it. A plan that reads it shuffles at most by entity again, on the
binned panel (small next to the raw rows).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.config import PanelConfig
from panelkit.operators import eda, folds as fo, forecast as fc, stattests as st
from panelkit.operators.decompose import decompose, decompose_components, model_detection
from panelkit.operators.features import add_features
from panelkit.operators.outliers import detect_outliers, outlier_summary, residual_stats
from panelkit.operators.resample import gap_stats, resample_fill
from panelkit.plans import export as ex
from panelkit.plans.document import metadata, write_documents
from panelkit.session import checkpoint_dir


def prepare(spark: SparkSession, raw: DataFrame, cfg: PanelConfig, checkpoint: bool = True) -> DataFrame:
    feats = add_features(resample_fill(raw, cfg), cfg)
    if checkpoint:
        checkpoint_dir(spark)
        feats = feats.checkpoint(eager=True)
    return feats


def run(spark: SparkSession, raw: DataFrame, cfg: PanelConfig | None = None, models: bool = False,
        checkpoint: bool = True) -> dict[str, DataFrame]:
    """All tables of the run, lazy (``models=True`` adds the grouped model jobs)."""
    cfg = cfg or PanelConfig()
    P = cfg.seasonal_period
    f = prepare(spark, raw, cfg, checkpoint)
    series = fo.target_series(f, "returns")
    vol = eda.rolling_volatility(f, 12)
    t = {
        "features": f,
        "gap_stats": gap_stats(f),
        "kpis": eda.kpi_report(f),
        "ranking": eda.return_ranking(f),
        "best_worst": eda.best_worst(f),
        "series": ex.series_arrays(f, "close", "values", more=("returns",)),
        "metadata": metadata(f, cfg),
        "landing_subset": ex.landing_subset(f, eda.best_worst(f)),
        "calendar_heatmap": eda.calendar_means(f, "close", 1.0, "mean_close"),
        "monthly_returns": eda.calendar_means(f, "returns", 100.0, "mean_return_pct"),
        "seasonal_box": eda.seasonal_box(eda.restrict(f, eda.top_entities(f, 5))),
        "sigma_band": eda.sigma_band(f),
        "histogram": eda.histogram(eda.restrict(f, eda.top_entities(f, 4))),
        "kde": eda.kde(eda.restrict(f, eda.top_entities(f, 4))),
        "probplot": eda.probability_plot(eda.restrict(f, eda.top_entities(f, 4))),
        "volatility": vol,
        "vol_threshold": eda.volatility_threshold(vol),
        "drawdown": eda.drawdown(f),
        "top_bottom": eda.top_bottom_rebased(f, 3),
        "event_labels": eda.series_with_labels(f),
        "acf": st.acf(f, "close"),
        "pacf": st.pacf(f, "close"),
        "decomposition": decompose(f, P),
        "model_detection": model_detection(f, P),
        "outliers": detect_outliers(f, P, cfg.anomaly_multiplier),
        "outlier_summary": outlier_summary(f, P, cfg.anomaly_multiplier),
        "residual_stats": residual_stats(f, P, cfg.anomaly_multiplier),
        "stationarity": st.stationarity(f, "returns"),
        "ljung_box": st.ljung_box(f, "returns"),
        "jarque_bera": st.jarque_bera(f, "returns"),
        "correlation": eda.correlation_matrix(f),
    }
    resid = decompose_components(f, P).select("entity", "idx", F.col("resid_add").alias("resid"))
    t["residual_histogram"] = eda.histogram(resid, "auto", "resid")
    t["residual_normal_curve"] = eda.normal_curve(resid, "resid")
    ar1 = fc.ar1_jobs(series, fo.fold_slots(cfg.cv_folds, cfg.horizon, cfg.test_size, hold=True), cfg.horizon)
    t["ar1_cv"] = fc.cv_summary(fc.error_metrics(ar1.where((F.col("role") == "test") & (F.col("fold") >= 0)),
                                                 ("entity", "model", "fold")))
    if models:
        from panelkit.plans.queries_models import model_tables

        t |= model_tables(f, cfg)
    else:
        fut = ar1.where(F.col("role") == "future")
        ends = f.groupBy("entity").agg(F.max("idx").alias("last_idx"))
        last = f.where(F.col("close").isNotNull()).groupBy("entity").agg(F.max_by("close", "idx").alias("last_price"))
        t["forecasts"] = fc.dated(fut, fo.future_dates(ends, cfg.freq, cfg.horizon))
        t["price_forecast"] = fc.to_price(fut, last)
        t["validation_metrics"] = fc.validation(ar1, fo.holdout(series, cfg.test_size))
    return t


# the tables that are also written as CSV
CSV_TABLES = ("outliers", "residual_stats", "model_summary", "validation_metrics", "forecasts")


def write_all(tables: dict[str, DataFrame], out_dir: str) -> None:
    """Every table as Parquet; the CSV files of the CLI as CSV; the JSON
    documents from the written tables, so that nothing is computed twice for them."""
    spark = next(iter(tables.values())).sparkSession
    for name, df in tables.items():
        ex.write_table(df, f"{out_dir}/{name}", "parquet")
    written = {name: spark.read.schema(df.schema).parquet(f"{out_dir}/{name}") for name, df in tables.items()}
    for name in CSV_TABLES:
        if name in tables:
            ex.write_table(written[name], f"{out_dir}/csv/{name}", "csv")
    if "kpis" in tables:
        write_documents(spark, written, f"{out_dir}/documents")
