"""Sources, resampling, gap fill, features and the flagship KPI query."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelkit.config import PanelConfig
from panelkit.operators import eda
from panelkit.operators.features import add_features
from panelkit.operators.resample import gap_stats, resample_fill, resample_last
from panelkit.functions.scalar import round_half_up
from panelkit.plans.catalog import final, register
from panelkit.plans.sqlref import PANELS, features_ctes, index_sql, label_sql, rnd, weekly_ctes
from panelkit.sources import tables

W = PanelConfig(freq="W")
H = PanelConfig(freq="h", period=24)


def panel(spark, sf, name):
    if name == "nation":
        return tables.nation_panel(spark, sf)
    if name == "recent":
        return tables.recent_panel(spark, sf)
    if name == "priority":
        return tables.priority_panel(spark, sf)
    if name.startswith("event"):
        variant = {"event": "plain", "event_reflected": "reflected", "event_small": "small"}[name]
        return tables.event_panel(spark, sf, variant)
    raise ValueError(name)


def weekly(spark, sf, name="nation", cfg=W):
    return resample_fill(panel(spark, sf, name), cfg)


def features(spark, sf, name="nation", cfg=W):
    return add_features(weekly(spark, sf, name, cfg), cfg)


# ------------------------------------------------------------------ flagship
FLAGSHIP_SQL = "WITH " + features_ctes("nation") + """,
v AS (SELECT * FROM feats WHERE close IS NOT NULL),
dd AS (SELECT entity, ts, (close - max(close) OVER (PARTITION BY entity ORDER BY idx ROWS UNBOUNDED PRECEDING))
          / NULLIF(max(close) OVER (PARTITION BY entity ORDER BY idx ROWS UNBOUNDED PRECEDING), 0) * 100 AS dd FROM v),
mx AS (SELECT entity, max(close) AS peak_value, arg_max(close, ts) AS current_close,
              (arg_max(close, ts) / NULLIF(arg_min(close, ts), 0) - 1) * 100 AS total_return_pct,
              count(*) AS n_periods FROM v GROUP BY entity),
pk AS (SELECT v.entity, min(v.ts) AS peak_date FROM v JOIN mx ON v.entity = mx.entity AND v.close = mx.peak_value GROUP BY v.entity),
md AS (SELECT entity, min(dd) AS max_drawdown_pct FROM dd GROUP BY entity),
mdd AS (SELECT dd.entity, min(dd.ts) AS max_drawdown_date FROM dd JOIN md ON dd.entity = md.entity AND dd.dd = md.max_drawdown_pct GROUP BY dd.entity),
vol AS (SELECT entity, stddev_samp(returns) AS return_vol, avg(returns) AS mean_return FROM feats GROUP BY entity),
k AS (SELECT mx.*, pk.peak_date, md.max_drawdown_pct, mdd.max_drawdown_date, vol.return_vol, vol.mean_return
      FROM mx JOIN pk USING (entity) JOIN md USING (entity) JOIN mdd USING (entity) JOIN vol USING (entity))
""" + final("k", "entity total_return_pct:6 peak_value:6 peak_date current_close:6 n_periods "
                 "max_drawdown_pct:6 max_drawdown_date return_vol:9 mean_return:9")


@register("flagship_kpis", FLAGSHIP_SQL, overrides={"return_vol": 9, "mean_return": 9})
def flagship_kpis(spark, sf):
    """nation panel -> weekly last -> fill -> returns -> KPIs + max drawdown."""
    return eda.kpi_report(features(spark, sf))


# ------------------------------------------------------------------ sources
@register("s_panel_scan", "WITH raw AS (" + PANELS["nation"] + """)
SELECT entity, count(*) AS n_rows, count(close) AS n_close, min(ts) AS first_ts, max(ts) AS last_ts,
       """ + rnd("sum(close)", 2) + """ AS sum_close FROM raw
WHERE ts BETWEEN TIMESTAMP '1995-01-01' AND TIMESTAMP '1999-12-31'
GROUP BY entity""", overrides={"sum_close": 2})
def s_panel_scan(spark, sf):
    """Panel scan with an inclusive date range pushed to the scan."""
    raw = tables.nation_panel(spark, sf, start="1995-01-01", end="1999-12-31")
    return raw.groupBy("entity").agg(F.count("*").alias("n_rows"), F.count("close").alias("n_close"),
                                     F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"),
                                     round_half_up(F.sum("close"), 2).alias("sum_close"))


# ------------------------------------------------------------------ resample / fill
_lab = label_sql("ts", "W")
RESAMPLE_SQL = "WITH raw AS (" + PANELS["nation"] + "), " + f"""ranked AS (
  SELECT entity, {index_sql(_lab, 'W')} AS idx, {_lab} AS ts, close,
         row_number() OVER (PARTITION BY entity, {_lab} ORDER BY (close IS NULL), ts DESC, tb DESC) AS rn
  FROM raw)
SELECT entity, idx, close AS raw_close FROM ranked WHERE rn = 1"""


@register("p_resample_last", RESAMPLE_SQL)
def p_resample_last(spark, sf):
    """Last non-null value per entity and Sunday-ending week."""
    return resample_last(panel(spark, sf, "nation"), "W")


def _weekly_sql(name, freq):
    return "WITH " + weekly_ctes(name, freq) + "\n" + final("weekly", "entity idx ts raw_close:6 close:6 pos has_gap")


@register("p_fill_nation_weekly", _weekly_sql("nation", "W"))
def p_fill_nation_weekly(spark, sf):
    """Weekly spine between first and last week, ffill<=2, linear, edges."""
    return weekly(spark, sf, "nation").select("entity", "idx", "ts", "raw_close", "close", "pos", "has_gap")


@register("p_fill_priority_weekly", _weekly_sql("priority", "W"))
def p_fill_priority_weekly(spark, sf):
    return weekly(spark, sf, "priority").select("entity", "idx", "ts", "raw_close", "close", "pos", "has_gap")


@register("p_fill_event_hourly", _weekly_sql("event", "h"))
def p_fill_event_hourly(spark, sf):
    """Hourly bins labelled by the hour start."""
    return weekly(spark, sf, "event", H).select("entity", "idx", "ts", "raw_close", "close", "pos", "has_gap")


@register("p_fill_event_daily", _weekly_sql("event", "D"))
def p_fill_event_daily(spark, sf):
    return weekly(spark, sf, "event", PanelConfig(freq="D")).select(
        "entity", "idx", "ts", "raw_close", "close", "pos", "has_gap")


def _register_calendar(name: str, freq: str):
    @register(name, _weekly_sql("nation", freq))
    def query(spark, sf):
        return weekly(spark, sf, "nation", PanelConfig(freq=freq)).select(
            "entity", "idx", "ts", "raw_close", "close", "pos", "has_gap")

    query.__doc__ = f"P2/P3: the nation panel on the {freq} calendar, filled."


for _name, _freq in (("p_fill_nation_monthly", "ME"), ("p_fill_nation_quarterly", "QE"), ("p_fill_nation_yearly", "YE")):
    _register_calendar(_name, _freq)


@register("p_gap_stats", "WITH " + weekly_ctes("event", "h") + """,
g AS (SELECT entity, count(*) AS n_periods, count_if(raw_close IS NULL) AS n_gaps,
             count_if(raw_close IS NULL) / count(*) AS gap_share, count(raw_close) = 0 AS all_null,
             count_if(has_gap) AS gaps_left FROM weekly GROUP BY entity)
""" + final("g", "entity n_periods n_gaps gap_share:9 all_null gaps_left"), overrides={"gap_share": 9})
def p_gap_stats(spark, sf):
    """P5: gaps per entity before filling, share, all-null flag, gaps left."""
    return gap_stats(weekly(spark, sf, "event", H))


_FEAT_COLS = ("entity idx ts raw_close:6 close:6 pos has_gap returns:9 returns_simple:9 lag_1:6 lag_2:6 lag_4:6 "
              "rolling_mean_4:6 rolling_std_4:4 rolling_min_4:6 rolling_max_4:6 month quarter year week_of_year")


@register("w_features_nation", "WITH " + features_ctes("nation") + "\n" + final("feats", _FEAT_COLS),
          overrides={"returns": 9, "returns_simple": 9, "rolling_std_4": 4})
def w_features_nation(spark, sf):
    """log/simple returns, lags, full-window rolling stats, calendar."""
    return features(spark, sf)


_FEAT_COLS_H = _FEAT_COLS.replace("rolling_mean_4", "rolling_mean_3").replace("rolling_std_4", "rolling_std_3") \
    .replace("rolling_min_4", "rolling_min_3").replace("rolling_max_4", "rolling_max_3")


@register("w_features_event_hourly", "WITH " + features_ctes("event", "h") + "\n" + final("feats", _FEAT_COLS_H),
          overrides={"returns": 9, "returns_simple": 9, "rolling_std_3": 4})
def w_features_event_hourly(spark, sf):
    """Same features on the hourly panel (rolling window 3)."""
    return features(spark, sf, "event", H)
