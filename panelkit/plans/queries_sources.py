"""Source, sink and refresh queries (S1, S4-S9, S12-S15, K5-K8, R3, U3), the model's
lag windows (W13, W14), and labels over a panel that reaches the event windows (P12, P13, J3, E4).

Files written here go to a folder of their own under ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from panelkit.config import PanelConfig
from panelkit.functions.scalar import round_half_up
from panelkit.operators import eda
from panelkit.operators import folds as fo
from panelkit.operators.outliers import residual_stats
from panelkit.plans import export as ex
from panelkit.plans.catalog import ORACLES, final, register
from panelkit.plans.queries_core import H, W, features, panel, weekly
from panelkit.plans.queries_decomp import SCORE_SQL, event_stream, write_monitor_stats
from panelkit.plans.queries_document import event_document
from panelkit.plans.queries_eda import VOL
from panelkit.plans.queries_export import display_ranking
from panelkit.plans.sqlref import PANELS, features_ctes, rnd
from panelkit.session import checkpoint_dir
from panelkit.sources.files import load_panel, load_stats


def _folder(spark, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


# ------------------------------------------------------------------ sources
@register("s_load_dirty_csv", """WITH r AS (SELECT event_type AS entity,
  CASE WHEN event_id % 17 <> 0 THEN CAST(ts AS TIMESTAMP) END AS ts,
  CASE WHEN event_id % 7 <> 0 AND event_id % 11 <> 0 AND event_id % 13 <> 0 THEN CAST(value AS DOUBLE) END AS close,
  event_id AS tb FROM events WHERE event_type IN ('click', 'purchase', 'error'))
""" + final("r", "entity ts close:6 tb"))
def s_load_dirty_csv(spark, sf):
    """Events as CSV text in which every 7th number is
    no number, every 11th is NaN, every 13th infinite and every 17th date is no date;
    loaded through the source dispatch with an entity list, non-finite values nulled."""
    path = _folder(spark, "dirty") + ".csv"
    k = F.col("tb")
    text = (F.when(k % 7 == 0, "n/a").when(k % 11 == 0, "NaN").when(k % 13 == 0, "Infinity")
            .otherwise(F.format_string("%.17g", F.col("close"))))
    date = F.when(k % 17 == 0, "no date").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    (panel(spark, sf, "event").select("entity", date.alias("Date"), text.alias("Close"), F.col("tb").cast("string").alias("tb"))
     .write.option("header", True).csv(path))
    cfg = PanelConfig(entities=("click", "purchase", "error"))
    return ex.null_non_finite(load_panel(spark, "file", cfg, path=path, extra={"tb": "long"}))


@register("s_load_csv_range", "WITH raw AS (" + PANELS["priority"] + """)
SELECT entity, ts, """ + rnd("close", 6) + """ AS close FROM raw
WHERE ts BETWEEN TIMESTAMP '1996-03-01' AND TIMESTAMP '1997-02-28'""")
def s_load_csv_range(spark, sf):
    """An inclusive date range over dates kept as text (the range the JDBC source pushes down)."""
    path = _folder(spark, "range") + ".csv"
    (panel(spark, sf, "priority").select("entity", F.date_format("ts", "yyyy-MM-dd").alias("Date"),
                                         F.format_string("%.17g", F.col("close")).alias("Close"))
     .write.option("header", True).csv(path))
    return load_panel(spark, "file", PanelConfig(start_date="1996-03-01", end_date="1997-02-28"), path=path)


@register("s_load_table", "WITH raw AS (" + PANELS["priority"] + """)
SELECT entity, ts, """ + rnd("close", 6) + """ AS close FROM raw
WHERE entity IN ('1-URGENT', '5-LOW') AND ts >= TIMESTAMP '1998-01-01'""")
def s_load_table(spark, sf):
    """A table source with an entity list and an open range."""
    cfg = PanelConfig(start_date="1998-01-01", entities=("1-URGENT", "5-LOW"))
    return load_panel(spark, "table", cfg, df=panel(spark, sf, "priority"))


# ------------------------------------------------------------------ sinks and what reads them
@register("s_stats_csv", ORACLES["o_residual_stats"])
def s_stats_csv(spark, sf):
    """Residual statistics written as CSV and loaded with their schema."""
    path = _folder(spark, "stats") + ".csv"
    ex.write_table(residual_stats(weekly(spark, sf, "event", H), H.seasonal_period), path, "csv")
    return load_stats(spark, path)


@register("k_cache_folders", "WITH raw AS (" + PANELS["priority"] + """)
SELECT entity, count(*) AS n_rows, count(close) AS n_close, min(ts) AS first_ts, max(ts) AS last_ts,
       """ + rnd("sum(close)", 2) + " AS sum_close FROM raw GROUP BY entity", overrides={"sum_close": 2})
def k_cache_folders(spark, sf):
    """K6: the cache, one folder per entity, read back."""
    path = _folder(spark, "cache")
    ex.write_table(panel(spark, sf, "priority"), path, partition_by="entity")
    return spark.read.parquet(path).groupBy("entity").agg(
        F.count("*").alias("n_rows"), F.count("close").alias("n_close"), F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"), F.sum("close").alias("sum_close"))


def _document(spark, sf):
    path = _folder(spark, "document")
    ex.write_table(event_document(spark, sf), path, "json")
    return ex.read_document(spark, path)


@register("s_document_outliers", ORACLES["o_outliers_event"])
def s_document_outliers(spark, sf):
    """The outlier section of the exported documents, read back with the fixed schema."""
    return _document(spark, sf).select("entity", F.inline("outliers"))


@register("s_document_series", "WITH " + features_ctes("event", "h") + """,
k AS (SELECT entity, arg_max(close, ts) AS current_close FROM feats WHERE close IS NOT NULL GROUP BY entity),
o AS (SELECT entity, strftime(ts, '%Y-%m-%d') AS date, CAST(row_number() OVER (PARTITION BY entity ORDER BY ts) - 1 AS INTEGER) AS pos,
             close AS value, current_close FROM feats JOIN k USING (entity))
""" + final("o", "entity date pos value:6 current_close:6"))
def s_document_series(spark, sf):
    """Series and KPI sections of the exported documents, read back."""
    d = _document(spark, sf).select("entity", "kpis.current_close", F.posexplode(F.arrays_zip("series.dates", "series.values")))
    return d.select("entity", F.col("col.dates").alias("date"), "pos", F.col("col.values").alias("value"), "current_close")


@register("r_stream_refresh", SCORE_SQL.replace("* 1.5 AS threshold", "* 3.0 AS threshold"))
def r_stream_refresh(spark, sf):
    """Two versions of the statistics; the refreshing monitor scores by the later one."""
    from panelkit.streaming.monitor import run_monitor

    base = _folder(spark, "refresh")
    for version, multiplier in ((1, 1.5), (2, 3.0)):
        write_monitor_stats(spark, sf, f"{base}/stats", multiplier, version)
    run_monitor(spark, event_stream(spark, sf), f"{base}/stats", f"{base}/log", f"{base}/ckpt", refresh_stats=True)
    return spark.read.parquet(f"{base}/log").drop("epoch")


@register("r_refresh_changed", "SELECT *, CASE WHEN entity = 'click' THEN 2 ELSE 1 END AS version FROM (" + ORACLES["o_residual_stats"] + ")")
def r_refresh_changed(spark, sf):
    """A first state in which one entity lacks a tenth of its rows, refreshed with the
    whole panel: only that entity is computed again, and all rows equal a full computation."""
    from panelkit.plans.refresh import current, refresh

    base = _folder(spark, "state")
    raw = panel(spark, sf, "event")
    for rows in (raw.where((F.col("entity") != "click") | (F.col("tb") % 10 != 0)), raw):
        refresh(spark, rows, base, lambda f, cfg: {"residual_stats": residual_stats(f, cfg.seasonal_period)}, H)
    return current(spark, base, "residual_stats")


QUANTILES = (0.0, 0.05, 0.5, 0.95, 1.0)


@register("a_vol_quantiles_sketch", "WITH " + features_ctes("nation") + ",\n" + VOL + """,
o AS (SELECT CAST(q AS DOUBLE) AS q, n, CASE WHEN q = 0 THEN lo WHEN q = 1 THEN hi END AS extreme, true AS within
      FROM (SELECT count(volatility) AS n, min(volatility) AS lo, max(volatility) AS hi FROM vol) CROSS JOIN (SELECT unnest([0, 0.05, 0.5, 0.95, 1]) AS q))
""" + final("o", "q:2 n extreme:9 within"), scale=9, overrides={"q": 2})
def a_vol_quantiles_sketch(spark, sf):
    """Quantiles of the rolling volatility from sketches kept per entity: one entity
    changes, its sketch alone is built again, and all are merged. ``within``: the exact rank of
    the answer, counted over all values, is at most ``RANK_ERROR`` from the one asked for."""
    from panelkit.operators.sketches import RANK_ERROR, merged, quantile_sketches
    from panelkit.plans.refresh import current, refresh

    base = _folder(spark, "sketches")
    raw = panel(spark, sf, "nation")

    def build(f, cfg):
        return {"volatility_sketch": quantile_sketches(eda.rolling_volatility(f, 12), "volatility")}

    for rows in (raw.where((F.col("entity") != "NATION_3") | (F.col("tb") % 10 != 0)), raw):
        refresh(spark, rows, base, build, W)
    m = merged(current(spark, base, "volatility_sketch"))
    # one row of five numbers, as a scalar subquery of the counting pass
    found = m.select(F.array(*[F.kll_sketch_get_quantile_double("sketch", F.lit(q)) for q in QUANTILES])).scalar()
    n_kept = m.select("n").scalar()
    vol = eda.rolling_volatility(features(spark, sf), 12).where(F.col("volatility").isNotNull()).select("volatility", found.alias("found"))
    v = F.col("volatility")
    ranks = vol.agg(F.count("*").alias("n"), F.any_value("found").alias("found"), *[
        f.alias(f"{side}{j}") for j in range(len(QUANTILES))
        for side, f in (("lt", F.count_if(v < F.col("found")[j])), ("le", F.count_if(v <= F.col("found")[j])))])
    rows = [F.struct(F.lit(q).alias("q"), F.col("found")[j].alias("value"), (F.col(f"lt{j}") / F.col("n")).alias("lo"),
                     (F.col(f"le{j}") / F.col("n")).alias("hi")) for j, q in enumerate(QUANTILES)]
    r = ranks.select(n_kept.alias("kept"), "n", F.inline(F.array(*rows)))
    ok = (F.col("lo") - RANK_ERROR <= F.col("q")) & (F.col("q") <= F.col("hi") + RANK_ERROR)
    return r.select("q", F.col("kept").alias("n"), F.when(F.col("q").isin(0.0, 1.0), F.col("value")).alias("extreme"),
                    (ok & (F.col("kept") == F.col("n"))).alias("within"))


# ------------------------------------------------------------------ lag windows of the pooled model
@register("w_lag_windows", "WITH " + features_ctes("nation") + """,
s AS (SELECT entity, idx, ts, returns AS y, min(returns) OVER p AS lo, max(returns) OVER p AS hi
      FROM feats WHERE returns IS NOT NULL WINDOW p AS (PARTITION BY entity)),
z AS (SELECT *, coalesce((y - lo) / NULLIF(hi - lo, 0), 0.0) AS ys,
             row_number() OVER (PARTITION BY entity ORDER BY idx) - 1 AS i FROM s),
x AS (SELECT entity, CAST(i AS INTEGER) AS i, y, ys, ys * (hi - lo) + lo AS back,
             list(""" + rnd("ys", 9) + """) OVER (PARTITION BY entity ORDER BY idx ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING) AS win FROM z)
""" + final("x", "entity i y:9 ys:9 back:9 win", "i >= 12"), scale=9)
def w_lag_windows(spark, sf):
    """Min-max scaled returns, their inverse, and the 12 scaled values before each."""
    from panelkit.operators.gbt import lag_windows, scaled
    from panelkit.operators.models import full_rows

    s = lag_windows(scaled(full_rows(fo.target_series(features(spark, sf), "returns"))), 12)
    return s.where(F.size("win") == 12).select(
        "entity", "i", "y", "ys", (F.col("ys") * (F.col("hi") - F.col("lo")) + F.col("lo")).alias("back"),
        F.transform("win", lambda v: round_half_up(v, 9)).alias("win"))


# ------------------------------------------------------------------ labels on recent dates, ids with a suffix
def _recent(sql: str) -> str:
    return sql.replace(PANELS["nation"], PANELS["recent"])


@register("e_event_labels_recent", _recent(ORACLES["e_event_labels"]))
def e_event_labels_recent(spark, sf):
    """Labels on a panel from 2020 on, so every window has rows."""
    return eda.series_with_labels(features(spark, sf, "recent"))


@register("t_display_ranking_recent", _recent(ORACLES["t_display_ranking"]),
          overrides={"return_pct_1dp": 1, "best_worst_ratio": 9})
def t_display_ranking_recent(spark, sf):
    """Half of the ids carry the exchange suffix."""
    return display_ranking(features(spark, sf, "recent"))
