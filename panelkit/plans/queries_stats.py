"""Diagnostics queries: ACF/PACF, Ljung-Box, Jarque-Bera, ADF/KPSS."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelkit.config import PanelConfig
from panelkit.operators.decompose import decompose
from panelkit.operators import stattests as st
from panelkit.plans.catalog import final, register
from panelkit.plans.queries_core import H, features
from panelkit.plans.sqlref import features_ctes, rnd


def _acf_sql(panel, freq, col):
    leads = ",\n       ".join(f"d * lead(d, {k}) OVER w AS p{k}" for k in range(31))
    sums = ", ".join(f"coalesce(sum(p{k}), 0.0) AS s{k}" for k in range(31))
    unp = "\n  UNION ALL ".join(f"SELECT entity, n, {k} AS lag, s{k} / NULLIF(s0, 0) AS acf FROM a" for k in range(31))
    return "WITH " + features_ctes(panel, freq) + f""",
x AS (SELECT entity, idx, {col} - avg({col}) OVER (PARTITION BY entity) AS d, count(*) OVER (PARTITION BY entity) AS n
      FROM feats WHERE {col} IS NOT NULL),
p AS (SELECT entity, n, {leads} FROM x WINDOW w AS (PARTITION BY entity ORDER BY idx)),
a AS (SELECT entity, any_value(n) AS n, {sums} FROM p GROUP BY entity),
u AS ({unp}),
r AS (SELECT entity, CAST(lag AS INTEGER) AS lag, acf, 1.96 / sqrt(CAST(n AS DOUBLE)) AS conf, n FROM u
      WHERE n >= 3 AND least(30, n // 2 - 1) >= 1 AND lag <= least(30, n // 2 - 1))
""" + final("r", "entity lag acf:9 conf:12 n")


@register("e_acf_nation", _acf_sql("nation", "W", "close"), overrides={"acf": 9, "conf": 12})
def e_acf_nation(spark, sf):
    """ACF of weekly closes, lags 0..30 (one lead window + one aggregate)."""
    return st.acf(features(spark, sf), "close")


@register("e_acf_event_returns", _acf_sql("event", "h", "returns"), overrides={"acf": 9, "conf": 12})
def e_acf_event_returns(spark, sf):
    return st.acf(features(spark, sf, "event", H), "returns")


def _pacf_sql(panel, freq, col):
    leads = ", ".join(f"d * lead(d, {k}) OVER w AS p{k}" for k in range(31))
    sums = ", ".join(f"coalesce(sum(p{k}), 0.0) AS s{k}" for k in range(31))
    rlist = ", ".join(f"s{k} / (CASE WHEN {k} = 0 THEN n ELSE n - {k} END)" for k in range(31))
    # the Levinson-Durbin recursion as a recursive CTE over the order k
    return "WITH RECURSIVE " + features_ctes(panel, freq) + f""",
x AS (SELECT entity, idx, {col} - avg({col}) OVER (PARTITION BY entity) AS d, count(*) OVER (PARTITION BY entity) AS n
      FROM feats WHERE {col} IS NOT NULL),
p AS (SELECT entity, n, {leads} FROM x WINDOW w AS (PARTITION BY entity ORDER BY idx)),
a AS (SELECT entity, any_value(n) AS n, {sums} FROM p GROUP BY entity),
rr AS (SELECT entity, n, least(30, n // 2 - 1) AS nlags, [{rlist}] AS r FROM a WHERE n >= 3 AND least(30, n // 2 - 1) >= 1),
ld AS (
  SELECT entity, 0 AS k, CAST([] AS DOUBLE[]) AS phi, r[1] AS v, CAST([] AS DOUBLE[]) AS pac FROM rr
  UNION ALL
  SELECT entity, k + 1, list_append(list_transform(range(1, k + 1), lambda j: phi[j] - a * phi[k + 1 - j]), a),
         v * (1 - pow(a, 2)), list_append(pac, a)
  FROM (SELECT ld.entity, ld.k, ld.phi, ld.v, ld.pac,
               (rr.r[ld.k + 2] - list_reduce(list_transform(range(1, ld.k + 1), lambda j: ld.phi[j] * rr.r[ld.k + 2 - j]),
                                             lambda s, t: s + t, 0.0)) / ld.v AS a
        FROM ld JOIN rr ON ld.entity = rr.entity WHERE ld.k < rr.nlags) t),
fin AS (SELECT ld.entity, rr.n, list_prepend(1.0, ld.pac) AS pacs FROM ld JOIN rr ON ld.entity = rr.entity WHERE ld.k = rr.nlags),
u AS (SELECT entity, n, CAST(unnest(range(0, len(pacs))) AS INTEGER) AS lag, pacs FROM fin),
o AS (SELECT entity, lag, pacs[lag + 1] AS pacf, 1.96 / sqrt(CAST(n AS DOUBLE)) AS conf, n FROM u)
""" + final("o", "entity lag pacf:9 conf:12 n")


@register("e_pacf_nation", _pacf_sql("nation", "W", "close"), overrides={"pacf": 9, "conf": 12})
def e_pacf_nation(spark, sf):
    """PACF (Yule-Walker, adjusted autocovariances, Levinson-Durbin)."""
    return st.pacf(features(spark, sf), "close")


def _lb_sql(panel, freq, col, src="feats", ctes=None):
    terms = " + ".join(f"CASE WHEN {k} <= L THEN pow(s{k} / NULLIF(s0, 0), 2) / (n - {k}) ELSE 0 END" for k in range(1, 11))
    leads = ", ".join(f"d * lead(d, {k}) OVER w AS p{k}" for k in range(11))
    sums = ", ".join(f"coalesce(sum(p{k}), 0.0) AS s{k}" for k in range(11))
    chi = " + ".join(f"pow(lb_stat / 2, {i}) / {float(__import__('math').factorial(i))}" for i in range(5))
    return "WITH " + (ctes or features_ctes(panel, freq)) + f""",
x AS (SELECT entity, idx, {col} - avg({col}) OVER (PARTITION BY entity) AS d, count(*) OVER (PARTITION BY entity) AS n
      FROM {src} WHERE {col} IS NOT NULL),
p AS (SELECT entity, n, {leads} FROM x WINDOW w AS (PARTITION BY entity ORDER BY idx)),
a AS (SELECT entity, any_value(n) AS n, least(10, any_value(n) // 2 - 1) AS L, {sums} FROM p GROUP BY entity),
q AS (SELECT entity, n, CAST(L AS INTEGER) AS lags, n * (n + 2) * ({terms}) AS lb_stat FROM a WHERE L >= 1),
r AS (SELECT *, exp(-lb_stat / 2) * ({chi}) AS lb_pvalue FROM q),
o AS (SELECT *, lb_pvalue < 0.05 AS autocorrelated FROM r)
""" + final("o", "entity n lags lb_stat:6 lb_pvalue:9 autocorrelated")


@register("x_ljung_box_returns", _lb_sql("nation", "W", "returns"), overrides={"lb_pvalue": 9})
def x_ljung_box_returns(spark, sf):
    """Ljung-Box Q and p at lag min(10, n//2-1) on weekly returns."""
    return st.ljung_box(features(spark, sf), "returns", 10)


def _lb_lags_sql(panel, freq, col):
    """Q at every L from 1 to 10 by a self-join of the products; the tail as 1 minus the series
    of the incomplete gamma function."""
    leads = ", ".join(f"d * lead(d, {k}) OVER w AS p{k}" for k in range(11))
    sums = ", ".join(f"coalesce(sum(p{k}), 0.0) AS s{k}" for k in range(11))
    return "WITH " + features_ctes(panel, freq) + f""",
x AS (SELECT entity, idx, {col} - avg({col}) OVER (PARTITION BY entity) AS d, count(*) OVER (PARTITION BY entity) AS n FROM feats WHERE {col} IS NOT NULL),
p AS (SELECT entity, n, {leads} FROM x WINDOW w AS (PARTITION BY entity ORDER BY idx)),
a AS (SELECT entity, any_value(n) AS n, {sums} FROM p GROUP BY entity),
t AS (SELECT entity, n, s0, unnest(generate_series(1, 10)) AS k, unnest([{", ".join(f"s{k}" for k in range(1, 11))}]) AS s FROM a),
q AS (SELECT entity, n, CAST(k AS INTEGER) AS lags, n * (n + 2) * sum(pow(s / NULLIF(s0, 0), 2) / (n - k)) OVER (PARTITION BY entity ORDER BY k) AS lb_stat
      FROM t WHERE k <= n // 2 - 1),
o AS (SELECT *, 1 - list_sum(list_transform(range(0, 300), lambda j: exp((lags / 2.0 + j) * ln(lb_stat / 2) - lb_stat / 2 - lgamma(lags / 2.0 + j + 1)))) AS lb_pvalue FROM q)
""" + final("o", "entity n lags lb_stat:6 lb_pvalue:9")


@register("x_ljung_box_lags", _lb_lags_sql("nation", "W", "returns"), overrides={"lb_pvalue": 9})
def x_ljung_box_lags(spark, sf):
    """Ljung-Box at every lag count from 1 to 10, so with odd and even degrees of freedom."""
    return st.ljung_box_lags(features(spark, sf), "returns", 10)


def _jb_sql(panel, freq, col):
    return "WITH " + features_ctes(panel, freq) + f""",
x AS (SELECT entity, {col} AS v, avg({col}) OVER (PARTITION BY entity) AS m FROM feats WHERE {col} IS NOT NULL),
mo AS (SELECT entity, count(*) AS n, avg(pow(v - m, 2)) AS m2, avg(pow(v - m, 3)) AS m3, avg(pow(v - m, 4)) AS m4 FROM x GROUP BY entity),
j AS (SELECT entity, n, m3 / pow(m2, 1.5) AS skew, m4 / pow(m2, 2) - 3 AS excess_kurtosis FROM mo),
r AS (SELECT *, n / 6 * (pow(skew, 2) + pow(excess_kurtosis, 2) / 4) AS jb_stat FROM j),
o AS (SELECT *, exp(-jb_stat / 2) AS jb_pvalue FROM r)
""" + final("o", "entity n skew:9 excess_kurtosis:9 jb_stat:6 jb_pvalue:9")


@register("x_jarque_bera_returns", _jb_sql("nation", "W", "returns"),
          overrides={"skew": 9, "excess_kurtosis": 9, "jb_pvalue": 9})
def x_jarque_bera_returns(spark, sf):
    """Jarque-Bera statistic and p-value of weekly returns."""
    return st.jarque_bera(features(spark, sf), "returns")


def _kpss_ctes(panel, freq, col):
    """Brute-force KPSS (trend) in SQL: OLS detrend, partial sums, automatic
    lag rule and Bartlett-weighted autocovariances by a banded self-join."""
    crit = st.KPSS_CT_CRIT
    pv = st.KPSS_PVALS
    interp = " ".join(
        f"WHEN stat <= {crit[i + 1]} THEN ({pv[i + 1]} - {pv[i]}) / ({crit[i + 1]} - {crit[i]}) * (stat - {crit[i]}) + {pv[i]}"
        for i in range(len(crit) - 1))
    return features_ctes(panel, freq) + f""",
ser AS (SELECT entity, CAST(row_number() OVER (PARTITION BY entity ORDER BY idx) AS DOUBLE) AS t,
               {col} AS y, count(*) OVER (PARTITION BY entity) AS n FROM feats WHERE {col} IS NOT NULL),
ln AS (SELECT entity, regr_slope(y, t) AS k, regr_intercept(y, t) AS b FROM ser GROUP BY entity),
e AS (SELECT s.entity, s.t, s.n, s.y - (ln.b + ln.k * s.t) AS r FROM ser s JOIN ln USING (entity) WHERE s.n >= 10),
cs AS (SELECT entity, any_value(n) AS n, sum(c * c) AS css, sum(r * r) AS ss FROM
        (SELECT entity, n, r, sum(r) OVER (PARTITION BY entity ORDER BY t ROWS UNBOUNDED PRECEDING) AS c FROM e) GROUP BY entity),
cl AS (SELECT entity, n, css, ss, CAST(floor(pow(n, 2.0 / 9.0)) AS INTEGER) AS covlags FROM cs),
ac AS (SELECT a.entity, CAST(a.t - b.t AS INTEGER) AS lag, sum(a.r * b.r) AS prod
       FROM e a JOIN e b ON a.entity = b.entity AND a.t - b.t BETWEEN 1 AND a.n - 1 GROUP BY ALL),
au AS (SELECT cl.entity, cl.n, cl.css, cl.ss,
              cl.ss / cl.n + coalesce(sum(CASE WHEN ac.lag <= cl.covlags THEN ac.prod / (cl.n / 2.0) END), 0) AS s0,
              coalesce(sum(CASE WHEN ac.lag <= cl.covlags THEN ac.lag * (ac.prod / (cl.n / 2.0)) END), 0) AS s1
       FROM cl LEFT JOIN ac ON cl.entity = ac.entity GROUP BY cl.entity, cl.n, cl.css, cl.ss, cl.covlags),
lg AS (SELECT *, CAST(least(floor(1.1447 * pow(pow(s1 / s0, 2), 1.0 / 3.0) * pow(n, 1.0 / 3.0)), n - 1) AS INTEGER) AS lags FROM au),
sh AS (SELECT lg.entity, lg.n, lg.css, lg.lags,
              (lg.ss + coalesce(sum(CASE WHEN ac.lag <= lg.lags THEN 2 * ac.prod * (1.0 - ac.lag / (lg.lags + 1.0)) END), 0)) / lg.n AS s_hat
       FROM lg LEFT JOIN ac ON lg.entity = ac.entity GROUP BY lg.entity, lg.n, lg.css, lg.ss, lg.lags),
ks AS (SELECT entity, n, lags AS kpss_lags, (css / (n * n)) / s_hat AS stat FROM sh),
o AS (SELECT entity, n, stat AS kpss_stat,
             CASE WHEN stat <= {crit[0]} THEN {pv[0]} {interp} ELSE {pv[-1]} END AS kpss_pval, kpss_lags FROM ks)"""


def _kpss_sql(panel, freq, col):
    return "WITH " + _kpss_ctes(panel, freq, col) + f"""
SELECT entity, n, {rnd("kpss_stat", 9)} AS kpss_stat, {rnd("kpss_pval", 9)} AS kpss_pval, kpss_lags,
       kpss_pval >= 0.05 AS kpss_stationary FROM o"""


@register("x_kpss_returns", _kpss_sql("nation", "W", "returns"), scale=9)
def x_kpss_returns(spark, sf):
    """KPSS (trend) statistic, p-value, automatic lag count, per entity (n >= 10)."""
    return st.kpss(features(spark, sf), "returns")


def _stationarity_sql(panel, freq, col):
    """Brute-force ADF in SQL: the full moment matrix from a self-join of the design
    rows, then Gaussian elimination, one regressor per recursion."""
    def matrix(design_rows):
        # their moment matrix, rows and columns in the order of ``o``
        return f"""(SELECT entity, oi, list(s ORDER BY oj) AS r FROM
   (SELECT a.entity, a.o AS oi, b.o AS oj, sum(a.v * b.v) AS s FROM {design_rows} a JOIN {design_rows} b
    ON a.entity = b.entity AND a.t = b.t GROUP BY ALL) GROUP BY entity, oi)"""

    step = """list_transform(m[2:], lambda r: list_transform(range(2, len(r) + 1), lambda j: r[j] - r[1] / m[1][1] * m[1][j]))"""
    design = """SELECT entity, t, 0 AS o, 1.0 AS v FROM {w} UNION ALL SELECT entity, t, {level} AS o, x FROM {w}
  UNION ALL SELECT w.entity, w.t, {lags} + k.d_lag, dd.d FROM {w} w JOIN kk k ON w.entity = k.entity AND k.d_lag <= w.{p}
    JOIN df dd ON dd.entity = w.entity AND dd.t = w.t - k.d_lag
  UNION ALL SELECT entity, t, 1000 AS o, d FROM {w}"""
    small = " + ".join(f"{v} * pow(tau, {i})" for i, v in enumerate(st.ADF_SMALLP))
    large = " + ".join(f"{v} * pow(tau, {i})" for i, v in enumerate(st.ADF_LARGEP))
    return "WITH RECURSIVE " + _kpss_ctes(panel, freq, col) + f""",
df AS (SELECT entity, CAST(t AS INTEGER) - 1 AS t, n, y AS x, lead(y) OVER (PARTITION BY entity ORDER BY t) - y AS d,
              CAST(least(n // 2 - 2, ceil(12.0 * pow(n / 100.0, 0.25))) AS INTEGER) AS p FROM ser WHERE n >= 10),
kk AS (SELECT entity, CAST(unnest(range(1, p + 1)) AS INTEGER) AS d_lag FROM (SELECT DISTINCT entity, p FROM df)),
w1 AS (SELECT * FROM df WHERE t >= p AND d IS NOT NULL),
x1 AS ({design.format(w="w1", level=1, lags=1, p="p")}),
g1 AS (SELECT entity, list(r ORDER BY oi) AS m FROM {matrix("x1")} GROUP BY entity),
e1 AS (SELECT entity, 0 AS k, m FROM g1 UNION ALL SELECT entity, k + 1, {step} FROM e1 WHERE len(m) > 1),
sz AS (SELECT entity, count(*) AS rows FROM w1 GROUP BY entity),
al AS (SELECT e1.entity, k - 2 AS lag, rows * (ln(2 * pi()) + ln(m[len(m)][len(m)] / rows) + 1) + 2 * k AS aic
       FROM e1 JOIN sz USING (entity) WHERE k >= 2),
bl AS (SELECT entity, arg_min(lag, aic) AS lag FROM al GROUP BY entity),
w2 AS (SELECT df.*, bl.lag FROM df JOIN bl USING (entity) WHERE t >= bl.lag AND d IS NOT NULL),
x2 AS ({design.format(w="w2", level=999, lags=0, p="lag")}),
g2 AS (SELECT entity, list(r ORDER BY oi) AS m FROM {matrix("x2")} GROUP BY entity),
e2 AS (SELECT entity, m FROM g2 UNION ALL SELECT entity, {step} FROM e2 WHERE len(m) > 2),
ta AS (SELECT e2.entity, bl.lag, df.n, m[1][2] / m[1][1] / sqrt((m[2][2] - m[1][2] * m[1][2] / m[1][1]) / (df.n - 1 - bl.lag - (bl.lag + 2)) / m[1][1]) AS tau
       FROM e2 JOIN bl USING (entity) JOIN (SELECT DISTINCT entity, n FROM df) df USING (entity) WHERE len(m) = 2),
zz AS (SELECT *, CASE WHEN tau <= {st.ADF_TAU_STAR} THEN {small} ELSE {large} END AS z FROM ta),
pp AS (SELECT *, CASE WHEN tau > {st.ADF_TAU_MAX} THEN 1.0 WHEN tau < {st.ADF_TAU_MIN} THEN 0.0
         ELSE 0.5 + sign(z) * exp(-z * z / 2) / sqrt(2 * pi()) * list_sum(list_transform(range(0, 200), lambda k:
           exp((2 * k + 1) * ln(greatest(abs(z), 1e-300)) - lgamma(2.0 * k + 2) + k * ln(2) + lgamma(k + 1.0)))) END AS pv FROM zz),
ns AS (SELECT entity, any_value(n) AS n FROM ser GROUP BY entity),
fin AS (SELECT ns.entity, ns.n, pp.tau AS adf_stat, pp.pv AS adf_pval, CAST(pp.lag AS INTEGER) AS adf_lag,
               coalesce(pp.pv < 0.05, false) AS adf_stationary, o.kpss_stat, o.kpss_pval, o.kpss_lags,
               coalesce(o.kpss_pval >= 0.05, false) AS kpss_stationary,
               CASE WHEN pp.pv < 0.05 THEN 0 ELSE 1 END AS d_suggested, CAST(NULL AS VARCHAR) AS error
        FROM ns LEFT JOIN pp ON ns.entity = pp.entity LEFT JOIN o ON ns.entity = o.entity)
""" + final("fin", "entity n adf_stat:8 adf_pval:8 adf_lag adf_stationary kpss_stat:8 kpss_pval:8 kpss_lags "
                   "kpss_stationary d_suggested error")


@register("x_stationarity_returns", _stationarity_sql("nation", "W", "returns"), scale=8)
def x_stationarity_returns(spark, sf):
    """ADF (AIC lag) + KPSS (trend) + suggested d, per entity."""
    return st.stationarity(features(spark, sf), "returns")


@register("x_stationarity_event_close", _stationarity_sql("event", "h", "close"), scale=8)
def x_stationarity_event_close(spark, sf):
    return st.stationarity(features(spark, sf, "event", H), "close")
