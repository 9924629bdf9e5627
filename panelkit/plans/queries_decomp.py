"""Decomposition, outliers, residual statistics and anomaly scoring queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelkit.config import PanelConfig
from panelkit.operators.anomaly import score
from panelkit.operators.decompose import decompose, model_detection
from panelkit.operators.outliers import (
    detect_outliers, outlier_summary, residual_stats, severity_counts,
)
from panelkit.plans.catalog import final, register
from panelkit.plans.queries_core import H, W, weekly
from panelkit.plans.sqlref import SEVERITY_SQL, decomp_ctes, decomp_final_cte, fence_cte, weekly_ctes
from panelkit.sources import tables

DAILY = PanelConfig(freq="D", period=52)


def _sql(panel, freq, P, tail, more=""):
    return "WITH " + weekly_ctes(panel, freq) + decomp_ctes(P) + more + "\n" + tail


def _dec_cols(scale):
    return f"entity ts pos observed:6 trend:{scale} seasonal:{scale} resid:{scale} model period"


for _name, _panel, _freq, _cfg, _scale in (
        ("d_decompose_priority", "priority", "W", W, 5),
        ("d_decompose_event_hourly", "event", "h", H, 6),
        ("d_decompose_event_small", "event_small", "h", H, 10),
        ("d_decompose_event_daily_short", "event", "D", DAILY, 6)):
    def _mk(panel=_panel, cfg=_cfg):
        def q(spark, sf):
            return decompose(weekly(spark, sf, panel, cfg), cfg.seasonal_period)
        q.__doc__ = f"D1-D7: decomposition of the {panel} panel ({cfg.freq}, period {cfg.seasonal_period})."
        return q

    register(_name, _sql(_panel, _freq, _cfg.seasonal_period, final("dec", _dec_cols(_scale)),
                         decomp_final_cte(_cfg.seasonal_period)), scale=_scale,
             overrides={"observed": 6})(_mk())


def _detect_sql(panel, freq, P, scale):
    return _sql(panel, freq, P, final("md", "entity n var_add:s9 var_mul:s9 model"), f""",
md AS (SELECT entity, n, any_value(var_add) AS var_add, any_value(var_mul) AS var_mul, any_value(model) AS model FROM comp GROUP BY entity, n
       UNION ALL SELECT entity, n, NULL, NULL, 'additive' FROM s WHERE n < {2 * P} GROUP BY entity, n)""")


for _name, _panel, _freq, _cfg, _scale in (
        ("d_model_detect_nation", "nation", "W", W, 2),
        ("d_model_detect_event", "event", "h", H, 6),
        ("d_model_detect_event_small", "event_small", "h", H, 12)):
    def _mk2(panel=_panel, cfg=_cfg):
        def q(spark, sf):
            return model_detection(weekly(spark, sf, panel, cfg), cfg.seasonal_period)
        q.__doc__ = f"D5/A17: residual variances of both models and the choice, {panel} panel."
        return q

    register(_name, _detect_sql(_panel, _freq, _cfg.seasonal_period, _scale),
             overrides={"var_add": "s9", "var_mul": "s9"})(_mk2())


def _outlier_sql(panel, freq="h", P=24, scale=6):
    return ("WITH " + weekly_ctes(panel, freq) + decomp_ctes(P) + fence_cte(1.5) + f""",
o AS (SELECT entity, ts AS date, x AS value, resid AS residual, lower_bound, upper_bound, {SEVERITY_SQL} AS severity
      FROM fb WHERE resid < lower_bound OR resid > upper_bound)
""" + final("o", f"entity date value:{scale} residual:{scale} lower_bound:{scale} upper_bound:{scale} severity"))


@register("o_outliers_event", _outlier_sql("event"))
def o_outliers_event(spark, sf):
    """O1/O2: IQR outliers of additive residuals with severity (high side)."""
    return detect_outliers(weekly(spark, sf, "event", H), 24, 1.5)


@register("o_outliers_event_reflected", _outlier_sql("event_reflected"))
def o_outliers_event_reflected(spark, sf):
    """O1/O2 on 1000 - value: the low-side outliers."""
    return detect_outliers(weekly(spark, sf, "event_reflected", H), 24, 1.5)


@register("o_residual_stats", "WITH " + weekly_ctes("event", "h") + decomp_ctes(24) + """,
st AS (SELECT entity, avg(resid_add) AS mean, stddev_samp(resid_add) AS std, quantile_cont(resid_add, 0.25) AS q1,
              quantile_cont(resid_add, 0.75) AS q3 FROM comp GROUP BY entity),
r AS (SELECT *, q3 - q1 AS iqr, (q3 - q1) * 1.5 AS threshold FROM st)
""" + final("r", "entity mean:6 std:6 q1:6 q3:6 iqr:6 threshold:6"))
def o_residual_stats(spark, sf):
    """Residual mean, std, q1, q3, iqr, threshold per entity."""
    return residual_stats(weekly(spark, sf, "event", H), 24, 1.5)


@register("o_outlier_summary", "WITH " + weekly_ctes("event", "h") + decomp_ctes(24) + fence_cte(1.5) + """,
sm AS (SELECT entity, count_if(resid < lower_bound OR resid > upper_bound) AS count,
              count_if(resid < lower_bound OR resid > upper_bound) / any_value(n) * 100 AS pct_total FROM fb GROUP BY entity)
""" + final("sm", "entity count pct_total:6"))
def o_outlier_summary(spark, sf):
    """Outlier count and share of points per entity (zero-outlier entities kept)."""
    return outlier_summary(weekly(spark, sf, "event", H), 24, 1.5)


@register("o_severity_counts", "WITH " + weekly_ctes("event_reflected", "h") + decomp_ctes(24) + fence_cte(1.5) + f""",
o AS (SELECT entity, {SEVERITY_SQL} AS severity FROM fb WHERE resid < lower_bound OR resid > upper_bound),
c AS (SELECT entity, severity, count(*) AS count FROM o GROUP BY ALL)
""" + final("c", "entity severity count"))
def o_severity_counts(spark, sf):
    """Outliers per entity and severity (reflected panel: low side)."""
    return severity_counts(detect_outliers(weekly(spark, sf, "event_reflected", H), 24, 1.5))


SCORE_SQL = ("WITH " + weekly_ctes("event", "h") + decomp_ctes(24) + """,
st AS (SELECT entity, avg(resid_add) AS mean, (quantile_cont(resid_add, 0.75) - quantile_cont(resid_add, 0.25)) * 1.5 AS threshold
       FROM comp GROUP BY entity),
obs AS (SELECT event_type AS entity_id, CAST(ts AS TIMESTAMP) AS timestamp, CAST(value AS DOUBLE) AS value, 'e' || CAST(event_id AS VARCHAR) AS obs_id FROM events
        UNION ALL
        SELECT o_orderpriority, CAST(o_orderdate AS TIMESTAMP), CAST(o_totalprice AS DOUBLE), 'o' || CAST(o_orderkey AS VARCHAR) FROM orders),
v AS (SELECT o.entity_id, o.timestamp, o.value, o.obs_id,
        CASE WHEN st.entity IS NULL THEN false ELSE coalesce(abs(o.value - st.mean) > st.threshold, false) END AS is_anomaly,
        CASE WHEN st.entity IS NULL THEN 0.0 ELSE abs(o.value - st.mean) END AS deviation,
        CASE WHEN st.entity IS NULL THEN 0.0 ELSE st.threshold END AS threshold,
        CASE WHEN st.entity IS NULL THEN 'unknown'
             WHEN abs(o.value - st.mean) > st.threshold AND abs(o.value - st.mean) > st.threshold * 2 THEN 'high'
             WHEN abs(o.value - st.mean) > st.threshold THEN 'medium' ELSE 'none' END AS severity,
        CASE WHEN st.entity IS NULL THEN 'No stats for entity ' || coalesce(o.entity_id, 'None') END AS error
      FROM obs o LEFT JOIN st ON o.entity_id = st.entity)
""" + final("v", "entity_id timestamp value:6 obs_id is_anomaly deviation:6 threshold:6 severity error"))


@register("o_score_observations", SCORE_SQL)
def o_score_observations(spark, sf):
    """Score every observation against stored residual stats;
    unknown entities (order priorities) get severity 'unknown'."""
    stats = residual_stats(weekly(spark, sf, "event", H), 24, 1.5)
    # one row per entity, counted before it is broadcast: the observations
    # (the big side) are never shuffled
    return score(tables.observations(spark, sf), stats, max_rows=H.broadcast_max_rows)


@register("r_stream_score", SCORE_SQL)
def r_stream_score(spark, sf):
    """The same scorer over a Structured Streaming source (events and
    orders files read as streams), appended to a Parquet log with a checkpoint
    (availableNow trigger); the log is read back."""
    import uuid

    from panelkit.session import checkpoint_dir
    from panelkit.streaming.monitor import run_monitor

    base = f"{checkpoint_dir(spark).rstrip('/')}/monitor-{uuid.uuid4().hex}"
    write_monitor_stats(spark, sf, f"{base}/stats", 1.5, 1)
    run_monitor(spark, event_stream(spark, sf), f"{base}/stats", f"{base}/log", f"{base}/ckpt")
    return spark.read.parquet(f"{base}/log")


def write_monitor_stats(spark, sf, path, multiplier, version):
    from panelkit.streaming.monitor import write_stats

    write_stats(residual_stats(weekly(spark, sf, "event", H), 24, multiplier), path, version)


def event_stream(spark, sf):
    """Events and orders files as one stream of observations."""
    ev_schema = spark.read.parquet(f"{sf}/events.parquet").schema
    od_schema = spark.read.parquet(f"{sf}/orders.parquet").schema
    ev = (spark.readStream.schema(ev_schema).option("pathGlobFilter", "events.parquet").parquet(sf)
          .select(F.col("event_type").alias("entity_id"), F.col("ts").cast("timestamp").alias("timestamp"),
                  F.col("value").cast("double").alias("value"),
                  F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("obs_id")))
    od = (spark.readStream.schema(od_schema).option("pathGlobFilter", "orders.parquet").parquet(sf)
          .select(F.col("o_orderpriority").alias("entity_id"), F.col("o_orderdate").cast("timestamp").alias("timestamp"),
                  F.col("o_totalprice").cast("double").alias("value"),
                  F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("obs_id")))
    return ev.unionByName(od)


def _resid(spark, sf):
    from panelkit.operators.decompose import decompose_components

    c = decompose_components(weekly(spark, sf, "event", H), 24)
    return c.select("entity", "idx", F.col("resid_add").alias("resid"))


@register("a_residual_histogram", _sql("event", "h", 24, final("r", "entity bin bins bin_left:6 bin_right:6 bin_center:6 count density:9"), """,
rs AS (SELECT entity, resid_add AS x FROM comp),
st AS (SELECT entity, CASE WHEN min(x) = max(x) THEN min(x) - 0.5 ELSE min(x) END AS lo,
              CASE WHEN min(x) = max(x) THEN max(x) + 0.5 ELSE max(x) END AS hi, count(*) AS n,
              CAST(least(greatest(count(*) // 10, 8), 40) AS INTEGER) AS nb FROM rs GROUP BY entity),
h AS (SELECT rs.entity, least(CAST(floor((x - lo) * nb / (hi - lo)) AS INTEGER), nb - 1) AS bin FROM rs JOIN st USING (entity)),
g AS (SELECT entity, unnest(generate_series(0, nb - 1)) AS bin FROM st),
c AS (SELECT g.entity, CAST(g.bin AS INTEGER) AS bin, count(h.bin) AS count FROM g LEFT JOIN h ON g.entity = h.entity AND g.bin = h.bin GROUP BY ALL),
r AS (SELECT c.entity, c.bin, nb AS bins, lo + c.bin * ((hi - lo) / nb) AS bin_left, lo + (c.bin + 1) * ((hi - lo) / nb) AS bin_right,
             ((lo + c.bin * ((hi - lo) / nb)) + (lo + (c.bin + 1) * ((hi - lo) / nb))) / 2 AS bin_center,
             c.count, c.count / (n * ((hi - lo) / nb)) AS density FROM c JOIN st USING (entity))"""),
          overrides={"density": 9})
def a_residual_histogram(spark, sf):
    """A10: residual histogram with clip(n // 10, 8, 40) bins per entity, bin centres, densities."""
    from panelkit.operators.eda import histogram

    return histogram(_resid(spark, sf), "auto", "resid")


@register("a_residual_normal_curve", _sql("event", "h", 24, final("nc", "entity i x:6 density:9 mu:9 sigma:9"), """,
g AS (SELECT entity, avg(resid_add) AS mu, stddev_pop(resid_add) AS sigma, min(resid_add) AS lo, max(resid_add) AS hi FROM comp GROUP BY entity),
gx AS (SELECT *, CAST(unnest(generate_series(0, 199)) AS INTEGER) AS i FROM g),
nc AS (SELECT entity, i, lo + i * (hi - lo) / 199 AS x,
              CASE WHEN sigma > 0 THEN 1.0 / (sigma * sqrt(2 * pi())) * exp(-0.5 * ((lo + i * (hi - lo) / 199 - mu) / sigma) * ((lo + i * (hi - lo) / 199 - mu) / sigma)) END AS density,
              mu, sigma FROM gx)"""), scale=9, overrides={"x": 6})
def a_residual_normal_curve(spark, sf):
    """A10: normal curve (mean, population std) over the residual range, 200 points."""
    from panelkit.operators.eda import normal_curve

    return normal_curve(_resid(spark, sf), "resid", 200)


RESID_SCORE_SQL = ("WITH " + weekly_ctes("event", "h") + decomp_ctes(24) + """,
fi AS (SELECT entity, min(idx) AS first_idx FROM comp GROUP BY entity),
kbb AS (SELECT entity, any_value(kb) AS kb, any_value(bb) AS bb FROM ols GROUP BY entity),
sp AS (SELECT entity, pos % 24 AS phase, any_value(seasonal_add) AS s FROM comp GROUP BY ALL),
st AS (SELECT comp.entity, avg(resid_add) AS mean, (quantile_cont(resid_add, 0.75) - quantile_cont(resid_add, 0.25)) * 1.5 AS threshold
       FROM comp GROUP BY comp.entity),
obs AS (SELECT event_type AS entity_id, CAST(ts AS TIMESTAMP) AS timestamp, CAST(value AS DOUBLE) AS value, 'e' || CAST(event_id AS VARCHAR) AS obs_id FROM events
        UNION ALL
        SELECT o_orderpriority, CAST(o_orderdate AS TIMESTAMP), CAST(o_totalprice AS DOUBLE), 'o' || CAST(o_orderkey AS VARCHAR) FROM orders),
ob AS (SELECT o.*, st.entity, st.mean, st.threshold, kbb.kb, kbb.bb,
              CAST(floor(epoch(date_trunc('hour', o.timestamp)) / 3600) AS BIGINT) - fi.first_idx AS pos
       FROM obs o LEFT JOIN st ON o.entity_id = st.entity LEFT JOIN fi ON o.entity_id = fi.entity LEFT JOIN kbb ON o.entity_id = kbb.entity),
ex AS (SELECT ob.*, kb * pos + bb + sp.s AS expected FROM ob LEFT JOIN sp ON ob.entity = sp.entity AND ((ob.pos % 24) + 24) % 24 = sp.phase),
v AS (SELECT entity_id, timestamp, value, obs_id,
        CASE WHEN entity IS NULL THEN false ELSE coalesce(abs(value - expected - mean) > threshold, false) END AS is_anomaly,
        CASE WHEN entity IS NULL THEN 0.0 ELSE abs(value - expected - mean) END AS deviation,
        CASE WHEN entity IS NULL THEN 0.0 ELSE threshold END AS threshold,
        CASE WHEN entity IS NULL THEN 'unknown'
             WHEN abs(value - expected - mean) > threshold AND abs(value - expected - mean) > threshold * 2 THEN 'high'
             WHEN abs(value - expected - mean) > threshold THEN 'medium' ELSE 'none' END AS severity,
        CASE WHEN entity IS NULL THEN 'No stats for entity ' || coalesce(entity_id, 'None') END AS error
      FROM ex)
""" + final("v", "entity_id timestamp value:6 obs_id is_anomaly deviation:6 threshold:6 severity error"))


@register("o_score_residual_mode", RESID_SCORE_SQL)
def o_score_residual_mode(spark, sf):
    """O4 (residual mode): value minus the decomposition's expected value
    (back-edge trend line + seasonal phase) against the residual mean and
    threshold; unknown entities as in raw mode."""
    from panelkit.operators.outliers import residual_model

    model = residual_model(weekly(spark, sf, "event", H), 24, 1.5)
    return score(tables.observations(spark, sf), model, max_rows=H.broadcast_max_rows,
                 mode="residual", freq="h", period=24)
