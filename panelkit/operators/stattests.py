"""Diagnostics and tests.

ACF, Ljung-Box and Jarque-Bera are native aggregates inside the entity
partitioning. PACF is the Levinson-Durbin recursion over each entity's
autocovariance array, written with Spark higher-order functions (JVM-side).
KPSS is column expressions too. ADF's moment sums are; only the small linear
system of one entity (its lag count, some tens) goes through a pandas UDF.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.functions.scalar import chi2_sf

MAX_LAGS = 30


def _demeaned(series: DataFrame, col: str) -> DataFrame:
    part = Window.partitionBy("entity")
    s = series.where(F.col(col).isNotNull())
    return s.select("entity", "idx", F.col(col).alias("x"),
                    (F.col(col) - F.avg(col).over(part)).alias("d"), F.count("*").over(part).alias("n"))


def autocov_sums(series: DataFrame, col: str = "close", max_lag: int = MAX_LAGS) -> DataFrame:
    """Per entity: n and S_k = sum_t d_t d_{t+k} for k = 0..max_lag (d = x - mean)."""
    s = _demeaned(series, col)
    w = Window.partitionBy("entity").orderBy("idx")
    prods = [(F.col("d") * F.lead("d", k).over(w)).alias(f"p{k}") for k in range(max_lag + 1)]
    p = s.select("entity", "n", *prods)
    return p.groupBy("entity").agg(F.first("n").alias("n"),
                                   F.array(*[F.coalesce(F.sum(f"p{k}"), F.lit(0.0)) for k in range(max_lag + 1)]).alias("S"))


def acf(series: DataFrame, col: str = "close", max_lag: int = MAX_LAGS) -> DataFrame:
    """Biased ACF for lags 0..min(max_lag, n//2 - 1), with the +-1.96/sqrt(n) band.
    Entities with fewer than 3 points or no lag are left out."""
    a = autocov_sums(series, col, max_lag)
    nl = F.least(F.lit(max_lag), F.floor(F.col("n") / 2).cast("int") - 1)
    ex = a.select("entity", "n", "S", nl.alias("nlags"),
                  F.posexplode(F.col("S")).alias("lag", "s_k"))
    ex = ex.where((F.col("n") >= 3) & (F.col("nlags") >= 1) & (F.col("lag") <= F.col("nlags")))
    return ex.select("entity", F.col("lag").cast("int").alias("lag"),
                     F.try_divide(F.col("s_k"), F.col("S")[0]).alias("acf"),
                     (F.lit(1.96) / F.sqrt(F.col("n").cast("double"))).alias("conf"), "n")


# one Levinson-Durbin step per lag; the reflection coefficient is bound once per
# step (a one-element transform) and is NULL, with all that follow, where the
# variance left is zero (a constant series)
_PACF_EXPR = """
aggregate(sequence(1, nlags),
  named_struct('phi', cast(array() as array<double>), 'pac', cast(array() as array<double>), 'v', r[0]),
  (st, k) -> element_at(transform(
     array(try_divide(r[k] - aggregate(zip_with(st.phi, reverse(slice(r, 2, k - 1)), (a, b) -> a * b), 0D, (x, y) -> x + y), st.v)),
     c -> named_struct(
        'phi', concat(transform(st.phi, (p, i) -> p - c * element_at(st.phi, k - 1 - i)), array(c)),
        'pac', concat(st.pac, array(c)),
        'v', st.v * (1 - c * c))), 1)
).pac"""


def pacf(series: DataFrame, col: str = "close", max_lag: int = MAX_LAGS) -> DataFrame:
    """Partial autocorrelation by Yule-Walker with sample-adjusted
    autocovariances (r_0 = S_0/n, r_k = S_k/(n-k)), solved by the
    Levinson-Durbin recursion per entity (higher-order functions)."""
    a = autocov_sums(series, col, max_lag)
    nl = F.least(F.lit(max_lag), F.floor(F.col("n") / 2).cast("int") - 1)
    r = F.transform(F.col("S"), lambda s, k: F.try_divide(s, F.when(k == 0, F.col("n")).otherwise(F.col("n") - k)))
    b = a.select("entity", "n", nl.alias("nlags"), r.alias("r")).where((F.col("n") >= 3) & (F.col("nlags") >= 1))
    b = b.select("entity", "n", "nlags", F.expr(_PACF_EXPR).alias("pac"))
    ex = b.select("entity", "n", "nlags", F.posexplode(F.concat(F.array(F.lit(1.0)), F.col("pac"))).alias("lag", "pacf"))
    return ex.select("entity", F.col("lag").cast("int").alias("lag"), "pacf",
                     (F.lit(1.96) / F.sqrt(F.col("n").cast("double"))).alias("conf"), "n")


def ljung_box(series: DataFrame, col: str, max_lag: int = 10) -> DataFrame:
    """Q = n(n+2) sum_{k<=L} rho_k^2/(n-k), L = min(10, n//2 - 1); p from the
    chi-square tail with L degrees of freedom, a column expression for even and odd L.
    ``autocorrelated`` iff p < 0.05."""
    a = autocov_sums(series, col, max_lag)
    L = F.least(F.lit(max_lag), F.floor(F.col("n") / 2).cast("int") - 1)
    terms = F.aggregate(
        F.sequence(F.lit(1), F.greatest(L, F.lit(1))), F.lit(0.0),
        lambda acc, k: acc + F.when(k <= L, F.pow(F.try_divide(F.element_at("S", k + 1), F.col("S")[0]), 2)
                                    / (F.col("n") - k)).otherwise(F.lit(0.0)))
    q = a.select("entity", "n", L.alias("lags"), (F.col("n") * (F.col("n") + 2) * terms).alias("lb_stat"))
    q = q.where(F.col("lags") >= 1)
    return q.select("*", chi2_sf("lb_stat", "lags", max_lag).alias("lb_pvalue")).withColumn("autocorrelated", F.col("lb_pvalue") < 0.05)


def ljung_box_lags(series: DataFrame, col: str, max_lag: int = 10) -> DataFrame:
    """X4 at every lag count L from 1 to min(max_lag, n//2 - 1): one row per (entity, L),
    from one pass of autocovariances (Q at L is a running sum over the lags)."""
    a = autocov_sums(series, col, max_lag).where(F.floor(F.col("n") / 2) >= 2)
    x = a.select("entity", "n", F.col("S")[0].alias("s0"), F.posexplode(F.slice("S", 2, max_lag)).alias("k", "s"))
    x = x.withColumn("lags", F.col("k") + 1).where(F.col("lags") <= F.floor(F.col("n") / 2) - 1)
    term = F.pow(F.try_divide("s", "s0"), 2) / (F.col("n") - F.col("lags"))
    w = Window.partitionBy("entity").orderBy("lags").rowsBetween(Window.unboundedPreceding, 0)
    x = x.select("entity", "n", "lags", (F.col("n") * (F.col("n") + 2) * F.sum(term).over(w)).alias("lb_stat"))
    return x.select("*", chi2_sf("lb_stat", "lags", max_lag).alias("lb_pvalue"))


def jarque_bera(series: DataFrame, col: str) -> DataFrame:
    """JB = n/6 (S^2 + K^2/4) with population skewness S and excess
    kurtosis K; p = exp(-JB/2) (chi-square, 2 df)."""
    s = series.where(F.col(col).isNotNull())
    g = s.groupBy("entity").agg(F.count("*").alias("n"), F.skewness(col).alias("skew"),
                                F.kurtosis(col).alias("excess_kurtosis"))
    jb = F.col("n") / 6 * (F.pow("skew", 2) + F.pow("excess_kurtosis", 2) / 4)
    return g.select("*", jb.alias("jb_stat")).withColumn("jb_pvalue", F.exp(-F.col("jb_stat") / 2))


# --------------------------------------------------------------------- ADF / KPSS
# MacKinnon (1994) response-surface coefficients for the ADF
# test with a constant, one variable; and the KPSS trend-stationarity
# critical values (10 %, 5 %, 2.5 %, 1 %).
ADF_TAU_MAX, ADF_TAU_MIN, ADF_TAU_STAR = 2.74, -18.83, -1.61
ADF_SMALLP = (2.1659, 1.4412, 0.038269)
ADF_LARGEP = (1.7339, 0.93202, -0.12745, -0.010368)
KPSS_CT_CRIT = (0.119, 0.146, 0.176, 0.216)
KPSS_PVALS = (0.10, 0.05, 0.025, 0.01)


def _norm_cdf(z: float) -> float:
    return 0.5 * math.erfc(-z / math.sqrt(2))


def adf_pvalue(tau: float) -> float:
    if tau > ADF_TAU_MAX:
        return 1.0
    if tau < ADF_TAU_MIN:
        return 0.0
    c = ADF_SMALLP if tau <= ADF_TAU_STAR else ADF_LARGEP
    return _norm_cdf(sum(ci * tau ** i for i, ci in enumerate(c)))


def _ols(y: np.ndarray, X: np.ndarray):
    beta, *_ = np.linalg.lstsq(X, y, rcond=None)
    resid = y - X @ beta
    return beta, resid


def _lagged_design(x: np.ndarray, lags: int):
    dx = np.diff(x)
    rows = len(dx) - lags
    cols = [x[lags:lags + rows]]  # level y_{t-1}
    for i in range(1, lags + 1):
        cols.append(dx[lags - i:lags - i + rows])
    return dx[lags:], np.column_stack(cols)


def adf(x: np.ndarray) -> tuple[float, float, int]:
    """ADF with constant; lag by AIC over 0..maxlag on a common sample."""
    n = len(x)
    maxlag = int(math.ceil(12.0 * (n / 100.0) ** 0.25))
    maxlag = min(n // 2 - 2, maxlag)
    if maxlag < 0:
        raise ValueError("sample too short")
    y, Xall = _lagged_design(x, maxlag)
    full = np.column_stack([np.ones(len(y)), Xall])
    nobs = len(y)
    best = None
    for k in range(2, 2 + maxlag + 1):
        X = full[:, :k]
        _, r = _ols(y, X)
        ssr = float(r @ r)
        llf = -nobs / 2 * (math.log(2 * math.pi) + math.log(ssr / nobs) + 1)
        aic = -2 * llf + 2 * k
        if best is None or aic < best[0]:
            best = (aic, k)
    lag = best[1] - 2
    y, X = _lagged_design(x, lag)
    X = np.column_stack([X, np.ones(len(y))])
    beta, r = _ols(y, X)
    dof = len(y) - X.shape[1]
    s2 = float(r @ r) / dof
    cov = s2 * np.linalg.inv(X.T @ X)
    tau = float(beta[0] / math.sqrt(cov[0, 0]))
    return tau, adf_pvalue(tau), lag


def kpss(series: DataFrame, col: str = "returns") -> DataFrame:
    """X2 per entity: KPSS around a linear trend, lag by the Hobijn-Franses-Ooms
    rule, p interpolated between the critical values. Column expressions only;
    the residuals of one entity are one array, bounded by its calendar length.
    Fewer than 10 points, or no residual variance: NULL and not stationary."""
    part = Window.partitionBy("entity")
    w = part.orderBy("idx")
    x = series.where(F.col(col).isNotNull()).select("entity", "idx", F.col(col).alias("x"), F.row_number().over(w).alias("t"))
    x = x.select("entity", "idx", (F.col("x") - F.regr_intercept("x", "t").over(part)
                                   - F.regr_slope("x", "t").over(part) * F.col("t")).alias("e"))
    x = x.select("*", F.sum("e").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cum"))
    g = x.groupBy("entity").agg(
        F.count("*").alias("n"), F.sum(F.col("e") * F.col("e")).alias("ss"),
        F.sum(F.col("cum") * F.col("cum")).alias("css"),
        F.array_sort(F.collect_list(F.struct("idx", "e")))["e"].alias("e"))
    n = F.col("n")

    def lag_products(k):
        size = (n - k).cast("int")
        prod = F.zip_with(F.slice("e", F.lit(1), size), F.slice("e", k + 1, size), lambda a, b: a * b)
        return F.aggregate(prod, F.lit(0.0), lambda acc, v: acc + v)

    def over_lags(lags, term):
        ks = F.when(lags >= 1, F.sequence(F.lit(1), lags)).otherwise(F.array().cast("array<int>"))
        return F.aggregate(ks, F.lit(0.0), lambda acc, k: acc + term(k))

    g = g.where(n >= 10).select("*", F.pow(n.cast("double"), F.lit(2.0 / 9.0)).cast("int").alias("short"))
    g = g.select("*", (F.col("ss") / n + over_lags(F.col("short"), lambda k: 2 * lag_products(k) / n)).alias("s0"),
                 over_lags(F.col("short"), lambda k: k * 2 * lag_products(k) / n).alias("s1"))
    ratio = F.try_divide("s1", "s0")
    auto = 1.1447 * F.pow(ratio * ratio, F.lit(1.0 / 3.0)) * F.pow(n.cast("double"), F.lit(1.0 / 3.0))
    g = g.select("*", F.least(auto.cast("int"), (n - 1).cast("int")).alias("kpss_lags"))
    long_run = (F.col("ss") + over_lags(F.col("kpss_lags"), lambda k: 2 * lag_products(k)
                                        * (1 - k / (F.col("kpss_lags") + 1.0)))) / n
    g = g.select("entity", "n", F.try_divide(F.col("css") / (n * n), long_run).alias("kpss_stat"), "kpss_lags")
    stat = F.col("kpss_stat")
    pval = F.when(stat <= KPSS_CT_CRIT[0], F.lit(KPSS_PVALS[0]))
    for lo, hi, p_lo, p_hi in zip(KPSS_CT_CRIT, KPSS_CT_CRIT[1:], KPSS_PVALS, KPSS_PVALS[1:]):
        pval = pval.when(stat <= hi, p_lo + (stat - lo) * ((p_hi - p_lo) / (hi - lo)))
    pval = F.when(stat.isNotNull(), pval.otherwise(F.lit(KPSS_PVALS[-1])))
    g = g.select("entity", "n", "kpss_stat", pval.alias("kpss_pval"), "kpss_lags")
    return g.select("*", F.coalesce(F.col("kpss_pval") >= 0.05, F.lit(False)).alias("kpss_stationary"))


ADF_RESULT = T.StructType([T.StructField("adf_stat", T.DoubleType()), T.StructField("adf_pval", T.DoubleType()),
                           T.StructField("adf_lag", T.IntegerType()), T.StructField("error", T.StringType())])


def _moments(lag: int, m: dict) -> np.ndarray:
    """Moment matrix of [1, d(t-1) .. d(t-lag), x(t), d(t)] over t = lag .. n-2, from the sums
    over t = p .. n-2 and the first and last p values: a shift of both factors changes a
    sum by its two end terms only."""
    p, hx, hd, td = m["p"], m["hx"], m["hd"], m["td"]
    early = np.arange(lag, p)
    back = early[:, None] - np.arange(lag + 1)[None, :]
    lags = hd[back] if len(early) else np.zeros((0, lag + 1))
    c = m["c"][:lag + 1] + hd[early] @ lags
    e = m["e"][:lag + 1] + hx[early] @ lags
    f = m["f"][:lag + 1] + lags.sum(axis=0)
    g = np.zeros((lag + 3, lag + 3))  # order: d(t) .. d(t-lag), x(t), 1
    g[0, :lag + 1] = c
    for i in range(1, lag + 1):
        j = np.arange(i, lag + 1)
        g[i, i:lag + 1] = g[i - 1, i - 1:lag] + hd[lag - i] * hd[lag - j] - td[p - i] * td[p - j]
    g[:lag + 1, lag + 1], g[:lag + 1, lag + 2] = e, f
    g[lag + 1, lag + 1:] = m["sxx"] + hx[early] @ hx[early], m["sx"] + hx[early].sum()
    g[lag + 2, lag + 2] = m["n"] - 1 - lag
    g = np.triu(g) + np.triu(g, 1).T
    order = [lag + 2, *range(1, lag + 1), lag + 1, 0]
    return g[np.ix_(order, order)]


def _factor(g: np.ndarray) -> np.ndarray:
    """Last row of the Cholesky factor and its last regressor's pivot, on unit scale;
    collinear columns are an error."""
    scale = np.sqrt(np.diag(g))
    if not (scale > 0).all():
        raise ValueError("no variance")
    low = np.linalg.cholesky(g / np.outer(scale, scale))
    if (np.diag(low) < 1e-6).any():
        raise ValueError("collinear lags")
    return low[-1]


def _adf_solve(m: dict) -> tuple[float, float, int]:
    p, n = m["p"], m["n"]
    g = _moments(p, m)
    front = [0, p + 1, *range(1, p + 1), p + 2]  # constant and level first, then lag by lag
    z = _factor(g[np.ix_(front, front)])
    rows, k = n - 1 - p, np.arange(2, p + 3)
    ssr = g[-1, -1] * (1 - np.cumsum(z[:-1] ** 2)[1:])
    aic = rows * (np.log(2 * np.pi) + np.log(ssr / rows) + 1) + 2 * k
    lag = int(np.argmin(aic))
    z = _factor(_moments(lag, m))
    # the level is the last regressor: its t value is its own entry against what is left
    tau = z[-2] / math.sqrt(z[-1] ** 2 / (n - 1 - lag - (lag + 2)))
    return float(tau), adf_pvalue(float(tau)), lag


@F.pandas_udf(ADF_RESULT)
def _adf_udf(m: pd.DataFrame) -> pd.DataFrame:
    out = []
    for row in m.to_dict("records"):
        try:
            out.append((*_adf_solve(row), None))
        except Exception as exc:  # noqa: BLE001 - per-entity failure isolation
            out.append((None, None, None, f"{type(exc).__name__}: {exc}"))
    r = pd.DataFrame(out, columns=["adf_stat", "adf_pval", "adf_lag", "error"])
    return r.astype({"adf_stat": "float64", "adf_pval": "float64", "adf_lag": "Int32"})


def adf_test(series: DataFrame, col: str = "returns") -> DataFrame:
    """X1/X3 per entity: ADF with a constant, lag by AIC on a common sample. The
    cross-products with the level and the lags are column expressions over the entity's
    series (one array, bounded by its calendar length). Fewer than 10 points: no test,
    not stationary, d = 1; no variance or collinear lags: an error and the same verdict."""
    part = Window.partitionBy("entity")
    s = series.where(F.col(col).isNotNull()).select(
        "entity", "idx", (F.col(col) - F.avg(col).over(part)).alias("x"))
    g = s.groupBy("entity").agg(F.count("*").cast("int").alias("n"),
                                F.array_sort(F.collect_list(F.struct("idx", "x")))["x"].alias("x"))
    n = F.col("n")
    most = F.ceil(12.0 * F.pow(n / 100.0, F.lit(0.25)))
    g = g.select("entity", "n", "x", F.least(F.floor(n / 2) - 2, most).cast("int").alias("p"),
                 F.zip_with(F.slice("x", 2, n), F.slice("x", F.lit(1), F.greatest(n - 1, F.lit(0))), lambda a, b: a - b).alias("d"))
    rows = n - 1 - F.col("p")

    def window(name, j):
        return F.slice(name, F.col("p") + 1 - j, rows)

    def dot(a, b):
        return F.aggregate(F.zip_with(a, b, lambda u, v: u * v), F.lit(0.0), lambda acc, v: acc + v)

    def total(a):
        return F.aggregate(a, F.lit(0.0), lambda acc, v: acc + v)

    js = F.sequence(F.lit(0), F.col("p"))
    moments = F.struct(
        "n", "p",
        F.transform(js, lambda j: dot(window("d", F.lit(0)), window("d", j))).alias("c"),
        F.transform(js, lambda j: dot(window("x", F.lit(0)), window("d", j))).alias("e"),
        F.transform(js, lambda j: total(window("d", j))).alias("f"),
        total(window("x", F.lit(0))).alias("sx"), dot(window("x", F.lit(0)), window("x", F.lit(0))).alias("sxx"),
        F.slice("x", F.lit(1), F.col("p")).alias("hx"), F.slice("d", F.lit(1), F.col("p")).alias("hd"),
        F.slice("d", n - F.col("p"), F.col("p")).alias("td"))
    tested = g.where(n >= 10).select("entity", "n", _adf_udf(moments).alias("r")).select("entity", "n", "r.*")
    short = g.where(n < 10).select("entity", "n", *[F.lit(None).cast(t).alias(c) for c, t in (
        ("adf_stat", "double"), ("adf_pval", "double"), ("adf_lag", "int"), ("error", "string"))])
    small = F.coalesce(F.col("adf_pval") < 0.05, F.lit(False))
    return tested.unionByName(short).select(
        "entity", F.col("n").cast("long").alias("n"), "adf_stat", "adf_pval", "adf_lag", small.alias("adf_stationary"),
        F.when(small, 0).otherwise(1).cast("int").alias("d_suggested"), "error")


def stationarity(series: DataFrame, col: str = "returns") -> DataFrame:
    """X1-X3 per entity: ADF (constant, AIC lag), KPSS (trend), suggested d.
    Fewer than 10 points: both tests false, d = 1."""
    j = adf_test(series, col).join(kpss(series, col).drop("n"), "entity", "left")
    return j.select("entity", "n", "adf_stat", "adf_pval", "adf_lag", "adf_stationary", "kpss_stat", "kpss_pval",
                    "kpss_lags", F.coalesce("kpss_stationary", F.lit(False)).alias("kpss_stationary"),
                    "d_suggested", "error")
