"""Reference SQL (DuckDB dialect) for the registered queries.

These texts are an independent formulation of the same semantics (a spine
from ``generate_series`` plus a left join, where the Spark plan uses a lead
window; ``row_number`` picks instead of ``max_by``; ...) and serve as the
correctness oracle at small scale.
"""

from __future__ import annotations

PANELS = {
    "nation": """SELECT n.n_name AS entity, CAST(o.o_orderdate AS TIMESTAMP) AS ts,
       CAST(o.o_totalprice AS DOUBLE) AS close, o.o_orderkey AS tb
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "recent": """SELECT n.n_name || CASE WHEN length(n.n_name) % 2 = 1 THEN '.SA' ELSE '' END AS entity,
       CAST(o.o_orderdate AS TIMESTAMP) + INTERVAL 25 YEAR AS ts,
       CAST(o.o_totalprice AS DOUBLE) AS close, o.o_orderkey AS tb
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "priority": """SELECT o_orderpriority AS entity, CAST(o_orderdate AS TIMESTAMP) AS ts,
       CAST(o_totalprice AS DOUBLE) AS close, o_orderkey AS tb FROM orders""",
    "event": """SELECT event_type AS entity, CAST(ts AS TIMESTAMP) AS ts, CAST(value AS DOUBLE) AS close,
       event_id AS tb FROM events""",
    "event_reflected": """SELECT event_type AS entity, CAST(ts AS TIMESTAMP) AS ts,
       1000.0 - CAST(value AS DOUBLE) AS close, event_id AS tb FROM events""",
    "event_small": """SELECT event_type AS entity, CAST(ts AS TIMESTAMP) AS ts,
       CAST(value AS DOUBLE) / 10000.0 AS close, event_id AS tb FROM events""",
}


def label_sql(ts: str, freq: str) -> str:
    if freq == "W":
        return f"(CAST(date_trunc('week', {ts}) AS DATE) + 6)"
    if freq == "D":
        return f"CAST({ts} AS DATE)"
    if freq == "h":
        return f"date_trunc('hour', {ts})"
    if freq == "ME":
        return f"last_day(CAST({ts} AS DATE))"
    if freq in ("QE", "YE"):
        unit, months = ("quarter", 3) if freq == "QE" else ("year", 12)
        return f"CAST(date_trunc('{unit}', {ts}) + INTERVAL {months} MONTH - INTERVAL 1 DAY AS DATE)"
    raise ValueError(freq)


def index_sql(label: str, freq: str) -> str:
    if freq == "W":
        return f"CAST(floor(datediff('day', DATE '1970-01-04', {label}) / 7) AS BIGINT)"
    if freq == "D":
        return f"datediff('day', DATE '1970-01-01', {label})"
    if freq == "h":
        return f"CAST(floor(epoch({label}) / 3600) AS BIGINT)"
    if freq == "ME":
        return f"(year({label}) * 12 + month({label}) - 1)"
    if freq == "QE":
        return f"(year({label}) * 4 + quarter({label}) - 1)"
    if freq == "YE":
        return f"year({label})"
    raise ValueError(freq)


def from_index_sql(idx: str, freq: str) -> str:
    if freq == "W":
        return f"(DATE '1970-01-04' + CAST({idx} * 7 AS INTEGER))"
    if freq == "D":
        return f"(DATE '1970-01-01' + CAST({idx} AS INTEGER))"
    if freq == "h":
        return f"make_timestamp(CAST({idx} AS BIGINT) * 3600000000)"
    if freq == "ME":
        return f"last_day(make_date(CAST(floor({idx} / 12) AS INTEGER), CAST({idx} % 12 + 1 AS INTEGER), 1))"
    if freq == "QE":
        return f"last_day(make_date(CAST(floor({idx} / 4) AS INTEGER), CAST(({idx} % 4) * 3 + 3 AS INTEGER), 1))"
    if freq == "YE":
        return f"make_date(CAST({idx} AS INTEGER), 12, 31)"
    raise ValueError(freq)


def weekly_ctes(panel: str = "nation", freq: str = "W", limit: int = 2) -> str:
    """CTEs raw, binned, bounds, spine, anchors, weekly (entity, idx, ts,
    raw_close, close, pos, has_gap). Ends without a trailing comma."""
    lab = label_sql("ts", freq)
    return f"""raw AS ({PANELS[panel]}),
ranked AS (
  SELECT entity, {index_sql(lab, freq)} AS idx, close,
         row_number() OVER (PARTITION BY entity, {index_sql(lab, freq)}
                            ORDER BY (close IS NULL), ts DESC, tb DESC) AS rn
  FROM raw WHERE ts IS NOT NULL),
binned AS (SELECT entity, idx, close AS raw_close FROM ranked WHERE rn = 1),
bounds AS (SELECT entity, min(idx) AS lo, max(idx) AS hi FROM binned GROUP BY entity),
spine AS (SELECT entity, lo, unnest(generate_series(lo, hi)) AS idx FROM bounds),
joined AS (
  SELECT s.entity, s.idx, b.raw_close, CAST(s.idx - s.lo AS INTEGER) AS pos
  FROM spine s LEFT JOIN binned b ON s.entity = b.entity AND s.idx = b.idx),
anchors AS (
  SELECT *,
    max(CASE WHEN raw_close IS NOT NULL THEN pos END) OVER fw AS pk,
    last_value(raw_close IGNORE NULLS) OVER fw AS pv,
    min(CASE WHEN raw_close IS NOT NULL THEN pos END) OVER bw AS nk,
    first_value(raw_close IGNORE NULLS) OVER bw AS nv
  FROM joined
  WINDOW fw AS (PARTITION BY entity ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         bw AS (PARTITION BY entity ORDER BY idx ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
filled AS (
  SELECT entity, idx, {from_index_sql('idx', freq)} AS ts, raw_close,
    CASE WHEN raw_close IS NOT NULL THEN raw_close
         WHEN pk IS NOT NULL AND pos - pk <= {limit} THEN pv
         WHEN pk IS NULL THEN nv
         WHEN nk IS NULL THEN pv
         ELSE pv + (nv - pv) * (pos - (pk + {limit})) / (nk - (pk + {limit})) END AS close,
    pos
  FROM anchors),
weekly AS (SELECT *, close IS NULL AS has_gap FROM filled)"""


def features_ctes(panel: str = "nation", freq: str = "W") -> str:
    """weekly_ctes + feats (returns, lags, rolling 4 or 3, calendar)."""
    n = 4 if freq == "W" else 3
    names = [f"_t{k}" for k in range(n - 1, 0, -1)] + ["close"]
    lagcols = ", ".join(f"lag(close, {k}) OVER w AS _t{k}" for k in range(n - 1, 0, -1))
    sumexpr = " + ".join(names)
    terms = ", ".join(names)
    cnt = "(CASE WHEN " + " AND ".join(f"{t} IS NOT NULL" for t in names) + f" THEN {n} ELSE 0 END)"
    ssexpr = " + ".join(f"({t} - r_mean) * ({t} - r_mean)" for t in names)
    n1 = n - 1
    return weekly_ctes(panel, freq) + f""",
lagged0 AS (
  SELECT *, lag(close, 1) OVER w AS lag_1, lag(close, 2) OVER w AS lag_2, lag(close, 4) OVER w AS lag_4,
         {lagcols}
  FROM weekly
  WINDOW w AS (PARTITION BY entity ORDER BY idx)),
lagged1 AS (SELECT *, ({sumexpr}) / {n} AS r_mean, least({terms}) AS r_min, greatest({terms}) AS r_max,
         {cnt} AS rn_cnt FROM lagged0),
lagged AS (SELECT *, sqrt(({ssexpr}) / {n1}) AS r_std FROM lagged1),
feats AS (
  SELECT entity, idx, ts, raw_close, close, pos, has_gap,
    CASE WHEN lag_1 <> 0 AND close / lag_1 > 0 THEN ln(close / lag_1) END AS returns,
    CASE WHEN lag_1 <> 0 THEN close / lag_1 - 1 END AS returns_simple,
    lag_1, lag_2, lag_4,
    CASE WHEN rn_cnt = {n} THEN r_mean END AS rolling_mean_{n},
    CASE WHEN rn_cnt = {n} THEN r_std END AS rolling_std_{n},
    CASE WHEN rn_cnt = {n} THEN r_min END AS rolling_min_{n},
    CASE WHEN rn_cnt = {n} THEN r_max END AS rolling_max_{n},
    month(ts) AS month, quarter(ts) AS quarter, year(ts) AS year, week(ts) AS week_of_year
  FROM lagged)"""


def rnd_sig(expr: str, digits: int = 10) -> str:
    """Significant-digit rounding (matches ``round_sig``)."""
    e = f"CAST({expr} AS DOUBLE)"
    return f"CAST(printf('%.{digits - 1}e', CASE WHEN isnan({e}) OR isinf({e}) THEN NULL ELSE {e} END) AS DOUBLE)"


def rnd(expr: str, scale: int = 6) -> str:
    """Round a double; NaN/inf become NULL (matches ``round_half_up``)."""
    e = f"CAST({expr} AS DOUBLE)"
    x = f"(CASE WHEN isnan({e}) OR isinf({e}) THEN NULL ELSE {e} END)"
    m = f"CAST({10 ** scale} AS DOUBLE)"
    lim = f"CAST({10.0 ** (15 - scale)!r} AS DOUBLE)"
    return f"(CASE WHEN abs({x}) < {lim} THEN floor({x} * {m} + 0.5) / {m} ELSE {x} END)"


def decomp_ctes(P: int) -> str:
    """From ``weekly``: s (series), comp (both variants + model). Leading comma included."""
    h = P // 2
    terms = [f"lag(x, {k}) OVER w" for k in range(h, 0, -1)] + ["x"] + [f"lead(x, {k}) OVER w" for k in range(1, h + 1)]
    frame_sum = "(" + " + ".join(terms) + ")"
    if P % 2 == 0:
        ma = (f"({frame_sum} - 0.5 * lag(x, {h}) OVER w - 0.5 * lead(x, {h}) OVER w) / {P}")
    else:
        ma = f"{frame_sum} / {P}"
    fr = "(pos >= front AND pos < least(front + {P}, back))".format(P=P)
    br = "(pos >= greatest(front, back - {P}) AND pos < back)".format(P=P)
    return f""",
s AS (SELECT entity, idx, ts, close AS x, CAST(row_number() OVER (PARTITION BY entity ORDER BY idx) - 1 AS INTEGER) AS pos,
             count(*) OVER (PARTITION BY entity) AS n FROM weekly WHERE close IS NOT NULL),
ma AS (SELECT *, CASE WHEN pos >= {h} AND pos <= n - 1 - {h} THEN {ma} END AS ma, {h} AS front, n - 1 - {h} AS back
       FROM s WHERE n >= {2 * P}
       WINDOW w AS (PARTITION BY entity ORDER BY pos),
              fr AS (PARTITION BY entity ORDER BY pos ROWS BETWEEN {h} PRECEDING AND {h} FOLLOWING)),
ols AS (SELECT *,
  regr_slope(CASE WHEN {fr} THEN ma END, CASE WHEN {fr} THEN CAST(pos AS DOUBLE) END) OVER p AS kf,
  regr_intercept(CASE WHEN {fr} THEN ma END, CASE WHEN {fr} THEN CAST(pos AS DOUBLE) END) OVER p AS bf,
  regr_slope(CASE WHEN {br} THEN ma END, CASE WHEN {br} THEN CAST(pos AS DOUBLE) END) OVER p AS kb,
  regr_intercept(CASE WHEN {br} THEN ma END, CASE WHEN {br} THEN CAST(pos AS DOUBLE) END) OVER p AS bb
  FROM ma WINDOW p AS (PARTITION BY entity)),
tr AS (SELECT entity, idx, ts, x, pos, n,
  CASE WHEN pos < front THEN kf * pos + bf WHEN pos > back THEN kb * pos + bb ELSE ma END AS trend FROM ols),
ph AS (SELECT *, avg(x - trend) OVER (PARTITION BY entity, pos % {P}) AS pa_add,
                 avg(x / NULLIF(trend, 0)) OVER (PARTITION BY entity, pos % {P}) AS pa_mul FROM tr),
cen AS (SELECT *, avg(CASE WHEN pos < {P} THEN pa_add END) OVER (PARTITION BY entity) AS m_add,
                  avg(CASE WHEN pos < {P} THEN pa_mul END) OVER (PARTITION BY entity) AS m_mul FROM ph),
comp0 AS (SELECT entity, idx, ts, x, pos, n, trend, pa_add - m_add AS seasonal_add, (x - trend) - (pa_add - m_add) AS resid_add,
                 pa_mul / NULLIF(m_mul, 0) AS seasonal_mul,
                 x / NULLIF(pa_mul / NULLIF(m_mul, 0), 0) / NULLIF(trend, 0) AS resid_mul FROM cen),
comp AS (SELECT *, var_samp(resid_add) OVER p AS var_add, var_samp(resid_mul) OVER p AS var_mul,
                CASE WHEN min(x) OVER p > 0 AND var_samp(resid_mul) OVER p < 0.8 * var_samp(resid_add) OVER p
                     THEN 'multiplicative' ELSE 'additive' END AS model
         FROM comp0 WINDOW p AS (PARTITION BY entity))"""


def decomp_final_cte(P: int) -> str:
    return f""",
dec AS (
  SELECT entity, ts, pos, x AS observed, trend,
         CASE WHEN model = 'multiplicative' THEN seasonal_mul ELSE seasonal_add END AS seasonal,
         CASE WHEN model = 'multiplicative' THEN resid_mul ELSE resid_add END AS resid, model, {P} AS period FROM comp
  UNION ALL
  SELECT entity, ts, pos, x, NULL, NULL, NULL, 'additive', {P} FROM s WHERE n < {2 * P})"""


def fence_cte(m: float = 1.5) -> str:
    return f""",
fen AS (SELECT entity, idx, ts, x, n, resid_add AS resid,
          quantile_cont(resid_add, 0.25) OVER p AS q1, quantile_cont(resid_add, 0.75) OVER p AS q3
        FROM comp WINDOW p AS (PARTITION BY entity)),
fb AS (SELECT *, q1 - {m} * (q3 - q1) AS lower_bound, q3 + {m} * (q3 - q1) AS upper_bound FROM fen)"""


SEVERITY_SQL = """CASE WHEN resid <= lower_bound * 3 THEN 'extreme_low' WHEN resid <= lower_bound THEN 'low'
     WHEN resid <= upper_bound THEN 'normal' WHEN resid <= upper_bound * 3 THEN 'high' ELSE 'extreme_high' END"""
