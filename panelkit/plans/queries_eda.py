"""Exploratory statistics queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelkit.operators import eda
from panelkit.plans.catalog import final, register
from panelkit.plans.queries_core import features
from panelkit.plans.sqlref import features_ctes, rnd
from panelkit.functions.scalar import norm_ppf_sql

# total return per entity (> 1 observation), as SQL over ``feats``
TR = """v AS (SELECT * FROM feats WHERE close IS NOT NULL),
tr AS (SELECT entity, arg_min(close, ts) AS first_close, arg_max(close, ts) AS last_close, count(*) AS n_obs,
              arg_max(close, ts) / NULLIF(arg_min(close, ts), 0) - 1 AS total_return
       FROM v GROUP BY entity HAVING count(*) > 1)"""


def _with(*ctes):
    return "WITH " + features_ctes("nation") + ",\n" + ",\n".join(ctes) + "\n"


def top_sql(k, asc=False):
    d = "ASC" if asc else "DESC"
    return f"(SELECT entity FROM tr ORDER BY total_return {d}, entity LIMIT {k})"


@register("a_total_return_rank", _with(TR, """r AS (SELECT entity, total_return, """ + rnd("total_return * 100", 1) + """ AS return_pct_1dp,
  row_number() OVER (ORDER BY total_return DESC, entity) AS rank FROM tr)""")
    + final("r", "entity total_return:9 return_pct_1dp:1 rank"), overrides={"total_return": 9, "return_pct_1dp": 1})
def a_total_return_rank(spark, sf):
    """Total return per entity, ranked (desc; entity name breaks ties)."""
    return eda.return_ranking(features(spark, sf))


@register("a_best_worst", _with(TR, """b AS (SELECT
  (SELECT entity FROM tr ORDER BY total_return DESC, entity DESC LIMIT 1) AS best_entity,
  (SELECT max(total_return) FROM tr) AS best_return,
  (SELECT entity FROM tr ORDER BY total_return ASC, entity ASC LIMIT 1) AS worst_entity,
  (SELECT min(total_return) FROM tr) AS worst_return,
  (SELECT count(*) FROM tr) AS n_entities)""") + final("b", "best_entity best_return:9 worst_entity worst_return:9 n_entities"),
    overrides={"best_return": 9, "worst_return": 9})
def a_best_worst(spark, sf):
    """A3: best and worst entity by total return."""
    return eda.best_worst(features(spark, sf))


@register("a_calendar_heatmap", _with("""c AS (SELECT entity, year(ts) AS year, month(ts) AS month, sum(close ORDER BY idx) / count(close) AS mean_close
  FROM feats WHERE close IS NOT NULL GROUP BY ALL)""") + final("c", "entity year month mean_close:6"),
    )
def a_calendar_heatmap(spark, sf):
    """Mean close per entity, year and month (all entities)."""
    return eda.calendar_means(features(spark, sf), "close", 1.0, "mean_close")


@register("a_monthly_returns", _with("""c AS (SELECT entity, year(ts) AS year, month(ts) AS month, sum(returns ORDER BY idx) / count(returns) * 100 AS mean_return_pct
  FROM feats WHERE returns IS NOT NULL GROUP BY ALL)""") + final("c", "entity year month mean_return_pct:8"),
    overrides={"mean_return_pct": 8})
def a_monthly_returns(spark, sf):
    """Mean log return x 100 per entity, year and month."""
    return eda.calendar_means(features(spark, sf), "returns", 100.0, "mean_return_pct")


@register("a_seasonal_box", _with(TR, f"""b AS (SELECT entity, month(ts) AS month, count(*) AS n,
  quantile_cont(close, [0.0, 0.25, 0.5, 0.75, 1.0]) AS q FROM v WHERE entity IN {top_sql(5)} GROUP BY ALL),
bb AS (SELECT entity, month, n, q[1] AS min, q[2] AS q1, q[3] AS median, q[4] AS q3, q[5] AS max FROM b)""")
    + final("bb", "entity month n min:6 q1:6 median:6 q3:6 max:6"), scale=6)
def a_seasonal_box(spark, sf):
    """Five-number summary by month for the top 5 entities."""
    f = features(spark, sf)
    return eda.seasonal_box(eda.restrict(f, eda.top_entities(f, 5)), "month")


@register("a_sigma_band", _with("""s AS (SELECT entity, ts, returns AS value, avg(returns) OVER p AS mean, stddev_samp(returns) OVER p AS std
  FROM feats WHERE returns IS NOT NULL WINDOW p AS (PARTITION BY entity)),
b AS (SELECT *, mean + 2 * std AS upper, mean - 2 * std AS lower FROM s),
o AS (SELECT *, value > upper OR value < lower AS outside FROM b)""")
    + final("o", "entity ts value:9 mean:9 std:9 upper:9 lower:9 outside"), scale=9)
def a_sigma_band(spark, sf):
    """Returns with the mean +- 2 sample std band and the outside flag."""
    return eda.sigma_band(features(spark, sf), "returns", 2.0)


@register("a_correlation", _with("""v AS (SELECT entity, ts, close FROM feats WHERE close IS NOT NULL),
ne AS (SELECT count(DISTINCT entity) AS e FROM v),
d AS (SELECT ts FROM v GROUP BY ts HAVING count(*) = (SELECT e FROM ne)),
c AS (SELECT v.* FROM v JOIN d USING (ts)),
m AS (SELECT a.entity AS e1, b.entity AS e2, corr(a.close, b.close) AS corr, count(*) AS n_dates
      FROM c a JOIN c b ON a.ts = b.ts GROUP BY ALL)""") + final("m", "e1 e2 corr:6 n_dates"))
def a_correlation(spark, sf):
    """Pearson correlation matrix on complete cases (long form)."""
    return eda.correlation_matrix(features(spark, sf))


@register("a_histogram", _with(TR, f"""s AS (SELECT entity, close AS x FROM v WHERE entity IN {top_sql(4)}),
st AS (SELECT entity, CASE WHEN min(x) = max(x) THEN min(x) - 0.5 ELSE min(x) END AS lo,
              CASE WHEN min(x) = max(x) THEN max(x) + 0.5 ELSE max(x) END AS hi, count(*) AS n FROM s GROUP BY entity),
h AS (SELECT s.entity, least(CAST(floor((x - lo) * 30 / (hi - lo)) AS INTEGER), 29) AS bin FROM s JOIN st USING (entity)),
g AS (SELECT entity, unnest(generate_series(0, 29)) AS bin FROM st),
c AS (SELECT g.entity, CAST(g.bin AS INTEGER) AS bin, count(h.bin) AS count FROM g LEFT JOIN h ON g.entity = h.entity AND g.bin = h.bin GROUP BY ALL),
r AS (SELECT c.entity, c.bin, 30 AS bins, lo + c.bin * ((hi - lo) / 30) AS bin_left, lo + (c.bin + 1) * ((hi - lo) / 30) AS bin_right,
             ((lo + c.bin * ((hi - lo) / 30)) + (lo + (c.bin + 1) * ((hi - lo) / 30))) / 2 AS bin_center,
             c.count, c.count / (n * ((hi - lo) / 30)) AS density FROM c JOIN st USING (entity))""")
    + final("r", "entity bin bins bin_left:6 bin_right:6 bin_center:6 count density:15"), overrides={"density": 15})
def a_histogram(spark, sf):
    """30-bin density histogram of closes for the top 4 entities."""
    f = features(spark, sf)
    return eda.histogram(eda.restrict(f, eda.top_entities(f, 4)), 30, "close")


@register("a_kde", _with(TR, f"""s AS (SELECT entity, close AS x FROM v WHERE entity IN {top_sql(4)}),
st AS (SELECT entity, min(x) AS lo, max(x) AS hi, stddev_samp(x) AS sd, count(*) AS n FROM s GROUP BY entity HAVING count(*) > 1 AND stddev_samp(x) > 0),
g AS (SELECT entity, lo, hi, n, sd * pow(CAST(n AS DOUBLE), -0.2) AS h, unnest(generate_series(0, 199)) AS i FROM st),
k AS (SELECT g.entity, CAST(g.i AS INTEGER) AS i, lo + g.i * (hi - lo) / 199 AS x,
             sum(exp(-0.5 * ((lo + g.i * (hi - lo) / 199 - s.x) / h) * ((lo + g.i * (hi - lo) / 199 - s.x) / h)) / (h * sqrt(2 * pi()))) / n AS density
      FROM g JOIN s ON g.entity = s.entity GROUP BY g.entity, g.i, lo, hi, n)""")
    + final("k", "entity i x:6 density:15"), overrides={"density": 15})
def a_kde(spark, sf):
    """Gaussian KDE (Scott bandwidth) on a 200-point grid, top 4 entities."""
    f = features(spark, sf)
    return eda.kde(eda.restrict(f, eda.top_entities(f, 4)), 200, "close")


_M = """(CASE WHEN i = n THEN pow(0.5, 1.0 / n) WHEN i = 1 THEN 1 - pow(0.5, 1.0 / n) ELSE (i - 0.3175) / (n + 0.365) END)"""


@register("e_probplot", _with(TR, f"""s AS (SELECT entity, close AS osr, row_number() OVER (PARTITION BY entity ORDER BY close, ts) AS i,
  count(*) OVER (PARTITION BY entity) AS n FROM v WHERE entity IN {top_sql(4)}),
p AS (SELECT entity, i, n, osr, {norm_ppf_sql(_M)} AS osm FROM s),
f AS (SELECT *, regr_slope(osr, osm) OVER e AS slope, regr_intercept(osr, osm) OVER e AS intercept, corr(osm, osr) OVER e AS r
      FROM p WINDOW e AS (PARTITION BY entity))""") + final("f", "entity i n osr:6 osm:9 slope:4 intercept:4 r:9"),
    overrides={"osm": 9, "slope": 4, "intercept": 4, "r": 9})
def e_probplot(spark, sf):
    """Normal probability plot (Filliben medians, inverse normal) + fit line, top 4."""
    f = features(spark, sf)
    return eda.probability_plot(eda.restrict(f, eda.top_entities(f, 4)), "close").select(
        "entity", F.col("i").cast("long").alias("i"), "n", "osr", "osm", "slope", "intercept", "r")


VOL = """rv AS (SELECT entity, ts, idx, returns FROM feats WHERE returns IS NOT NULL),
vol0 AS (SELECT entity, ts, CASE WHEN count(returns) OVER w = 12 THEN stddev_samp(returns) OVER w END AS volatility,
                count(*) OVER (PARTITION BY entity) AS n
         FROM rv WINDOW w AS (PARTITION BY entity ORDER BY idx ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)),
vol AS (SELECT entity, ts, volatility FROM vol0 WHERE n >= 12)"""


@register("e_volatility", _with(VOL) + final("vol", "entity ts volatility:9"), scale=9)
def e_volatility(spark, sf):
    """12-period rolling volatility of returns, all entities."""
    return eda.rolling_volatility(features(spark, sf), 12)


@register("a_vol_threshold", _with(VOL, """t AS (SELECT coalesce(quantile_cont(volatility, 0.95), 0.05) AS threshold FROM vol)""")
    + final("t", "threshold:9"), scale=9)
def a_vol_threshold(spark, sf):
    """Pooled 95th percentile of rolling volatility (exact, distributed sort)."""
    return eda.volatility_threshold(eda.rolling_volatility(features(spark, sf), 12), 0.95, 0.05)


DD = """dd0 AS (SELECT entity, idx, ts, close, max(close) OVER (PARTITION BY entity ORDER BY idx ROWS UNBOUNDED PRECEDING) AS running_max
  FROM feats WHERE close IS NOT NULL),
dd AS (SELECT *, (close - running_max) / NULLIF(running_max, 0) * 100 AS drawdown_pct,
              (close - running_max) / NULLIF(running_max, 0) * 100 < -20 AS severe FROM dd0)"""


@register("e_drawdown", _with(DD) + final("dd", "entity idx ts close:6 running_max:6 drawdown_pct:9 severe"),
          overrides={"drawdown_pct": 9})
def e_drawdown(spark, sf):
    """Running maximum, drawdown % and severe flag, all entities."""
    return eda.drawdown(features(spark, sf))


@register("e_max_drawdown", _with(DD, """m AS (SELECT entity, min(drawdown_pct) AS max_drawdown_pct FROM dd GROUP BY entity),
r AS (SELECT m.entity, m.max_drawdown_pct, min(dd.ts) AS max_drawdown_date FROM m JOIN dd
      ON m.entity = dd.entity AND dd.drawdown_pct = m.max_drawdown_pct GROUP BY ALL)""")
    + final("r", "entity max_drawdown_pct:9 max_drawdown_date"), overrides={"max_drawdown_pct": 9})
def e_max_drawdown(spark, sf):
    """Deepest drawdown and its first date per entity."""
    return eda.max_drawdown(features(spark, sf))


@register("e_top_bottom_rebased", _with(TR, f"""sel AS (SELECT entity, entity IN {top_sql(3)} AS in_top, entity IN {top_sql(3, True)} AS in_bottom
  FROM tr WHERE entity IN {top_sql(3)} OR entity IN {top_sql(3, True)}),
rb AS (SELECT entity, ts, close / NULLIF(first_value(close) OVER (PARTITION BY entity ORDER BY idx ROWS UNBOUNDED PRECEDING), 0) * 100 AS rebased FROM v),
r AS (SELECT rb.*, sel.in_top, sel.in_bottom FROM rb JOIN sel USING (entity))""")
    + final("r", "entity ts rebased:9 in_top in_bottom"), overrides={"rebased": 9})
def e_top_bottom_rebased(spark, sf):
    """Top 3 and bottom 3 entities rebased to 100 at the first value."""
    return eda.top_bottom_rebased(features(spark, sf), 3)


@register("e_event_labels", _with(TR, """lab AS (SELECT entity, ts, close,
  CASE WHEN CAST(ts AS DATE) BETWEEN DATE '2020-03-01' AND DATE '2020-05-01' THEN 'COVID-19 Crash'
       WHEN CAST(ts AS DATE) BETWEEN DATE '2022-02-01' AND DATE '2022-04-01' THEN 'War in Ukraine'
       WHEN CAST(ts AS DATE) BETWEEN DATE '2022-10-01' AND DATE '2022-11-01' THEN 'Brazil Election' END AS event FROM v),
rk AS (SELECT entity, row_number() OVER (ORDER BY total_return DESC, entity DESC) AS r, count(*) OVER () AS n FROM tr),
o AS (SELECT lab.*, CASE WHEN rk.r = 1 THEN 'best' WHEN rk.r = rk.n THEN 'worst' END AS role FROM lab LEFT JOIN rk USING (entity))""")
    + final("o", "entity ts close:6 event role"))
def e_event_labels(spark, sf):
    """Series with event-window labels and best/worst roles."""
    return eda.series_with_labels(features(spark, sf))
