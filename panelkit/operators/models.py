"""The seasonal ARIMA job as a grouped map (M1, M5, M6, M8).

The unit of parallelism is one (entity, fold) group: one series, bounded by
the calendar span after resampling, so a task never holds more than one
series. Inside the group, NumPy least squares does the fit. The result is the
shared PRED schema plus fit summary columns; a failure in one group becomes
an ``error`` value on that group's row (M5 isolation).

ARMA(p, q) on the series (differenced once when ADF does not reject a unit
root), optional seasonal AR term at lag P when n >= 2P; Hannan-Rissanen
two-stage least squares, order by AIC over p, q <= 5; 95 % interval from psi
weights. The other models need no grouped map: ``trend``, ``gbt`` and
``forecast``.
"""

from __future__ import annotations

import math
import time

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Z95 = 1.959963984540054

OUT_SCHEMA = ("entity string, model string, fold int, role string, step int, i int, y double, "
              "yhat double, lower double, upper double, spec string, aic double, bic double, "
              "sigma double, fit_time_s double, error string")
OUT_COLS = [c.split()[0] for c in OUT_SCHEMA.split(", ")]


# ----------------------------------------------------------------- ARIMA (HR)
def _lagcols(z: np.ndarray, lags, start: int) -> list[np.ndarray]:
    n = len(z)
    return [z[start - k:n - k] for k in lags]


def _ols(y, X):
    beta, *_ = np.linalg.lstsq(X, y, rcond=None)
    return beta, y - X @ beta


class HRArma:
    """One ARMA(p, q) [+ seasonal AR at lag s] fit on a common sample."""

    def __init__(self, p, q, s, m, start):
        self.p, self.q, self.s, self.m, self.start = p, q, s, m, start

    def fit(self, z: np.ndarray, e1: np.ndarray):
        p, q, s, start = self.p, self.q, self.s, self.start
        n = len(z)
        cols = [np.ones(n - start)]
        cols += _lagcols(z, range(1, p + 1), start)
        cols += _lagcols(e1, range(1, q + 1), start)
        if s:
            cols += _lagcols(z, [s], start)
        X = np.column_stack(cols)
        y = z[start:]
        beta, r = _ols(y, X)
        ne = len(y)
        ssr = float(r @ r)
        self.sigma2 = max(ssr / ne, 1e-300)
        llf = -ne / 2 * (math.log(2 * math.pi * self.sigma2) + 1)
        k = X.shape[1] + 1
        self.aic = -2 * llf + 2 * k
        self.bic = -2 * llf + k * math.log(ne)
        self.c = beta[0]
        self.phi = beta[1:1 + p]
        self.theta = beta[1 + p:1 + p + q]
        self.Phi = beta[1 + p + q] if s else 0.0
        self.fitted = X @ beta
        self.resid = np.concatenate([e1[:start], r])
        return self

    def stable(self) -> bool:
        """Stationary AR part and invertible MA part (all roots outside the unit circle)."""
        ar = np.zeros(max(self.p, self.s) + 1)
        ar[0] = 1.0
        ar[1:self.p + 1] -= self.phi
        if self.s:
            ar[self.s] -= self.Phi
        ma = np.concatenate([[1.0], self.theta])
        for poly in (ar, ma):
            if len(poly) > 1 and np.any(np.abs(poly[1:]) > 0):
                roots = np.roots(poly[::-1])
                if len(roots) and np.min(np.abs(roots)) <= 1.0001:
                    return False
        return True

    def forecast(self, z: np.ndarray, h: int):
        zz = list(z)
        ee = list(self.resid)
        out = []
        for _ in range(h):
            t = len(zz)
            v = self.c
            v += sum(self.phi[i - 1] * zz[t - i] for i in range(1, self.p + 1))
            v += sum(self.theta[j - 1] * ee[t - j] for j in range(1, self.q + 1))
            if self.s:
                v += self.Phi * zz[t - self.s]
            zz.append(v)
            ee.append(0.0)
            out.append(v)
        # psi weights of the ARMA part
        a = np.zeros(h + 1)
        for i in range(1, self.p + 1):
            if i <= h:
                a[i] += self.phi[i - 1]
        if self.s and self.s <= h:
            a[self.s] += self.Phi
        psi = np.zeros(h)
        psi[0] = 1.0
        for j in range(1, h):
            v = self.theta[j - 1] if j <= self.q else 0.0
            v += sum(a[i] * psi[j - i] for i in range(1, j + 1))
            psi[j] = v
        return np.array(out), psi


def arima_search(y: np.ndarray, d: int, period: int, max_p: int = 5, max_q: int = 5):
    z = np.diff(y) if d else y.astype(float)
    n = len(z)
    seasonal = n >= 2 * period and period > 1
    m = max(max_p, max_q) + 4
    m = max(1, min(m, n // 3))
    # stage 1: long autoregression -> innovation estimates
    X = np.column_stack([np.ones(n - m)] + _lagcols(z, range(1, m + 1), m))
    _, r = _ols(z[m:], X)
    e1 = np.concatenate([np.zeros(m), r])
    s = period if seasonal else 0
    start = max(max_p, m + max_q, s)
    if n - start < max_p + max_q + 3:
        raise ValueError(f"series too short for the order search ({n} points)")
    best = None
    for sa in ([0, s] if s else [0]):
        for p in range(max_p + 1):
            for q in range(max_q + 1):
                mod = HRArma(p, q, sa, m, start).fit(z, e1)
                if (p or q or sa) and not mod.stable():
                    continue
                if best is None or mod.aic < best.aic:
                    best = mod
    return best, z


def _arima_fit(train: pd.DataFrame, test: pd.DataFrame, steps: np.ndarray, period: int, d_fixed: int | None):
    from panelkit.operators.stattests import adf

    y = train["y"].to_numpy(dtype=float)
    d = (0 if adf(y)[1] < 0.05 else 1) if d_fixed is None else d_fixed
    mod, z = arima_search(y, d, period)
    path, psi = mod.forecast(z, int(steps.max()))
    if d:
        path, psi = y[-1] + np.cumsum(path), np.cumsum(psi)
    se = np.sqrt(mod.sigma2 * np.cumsum(psi ** 2))
    fitted = mod.fitted + y[mod.start:-1] if d else mod.fitted
    meta = dict(spec=f"({mod.p},{d},{mod.q})x({1 if mod.s else 0},0,0,{mod.s or 0})",
                aic=mod.aic, bic=mod.bic, sigma=math.sqrt(mod.sigma2))
    return path[steps - 1], se[steps - 1], fitted, meta


# ----------------------------------------------------------------- one (entity, fold) group
def _fit_group(pdf: pd.DataFrame, model: str, horizon: int, fit) -> pd.DataFrame:
    """PRED rows of one group. ``fit(train, test, steps)`` gives the predictions of
    the steps, their standard errors, the fitted values of the last train rows
    and the fit columns; whatever it raises becomes the group's ``error`` row."""
    t0 = time.perf_counter()
    pdf = pdf.sort_values("i")
    train, test = pdf[pdf["role"] == "train"], pdf[pdf["role"] == "test"]
    steps = test["step"].to_numpy(dtype=int) if len(test) else np.arange(1, horizon + 1)
    try:
        if len(train) < 10:
            raise ValueError(f"insufficient data ({len(train)} obs)")
        yhat, se, fitted, meta = fit(train, test, steps)
        ahead = pd.DataFrame(dict(role="test" if len(test) else "future", step=steps, yhat=yhat,
                                  lower=yhat - Z95 * se, upper=yhat + Z95 * se))
        if len(test):
            out = ahead.assign(i=test["i"].to_numpy(), y=test["y"].to_numpy(dtype=float))
        else:
            tail = train.tail(len(fitted))
            out = pd.concat([ahead.assign(i=int(train["i"].max()) + steps, y=np.nan),
                             pd.DataFrame(dict(role="insample", step=np.nan, i=tail["i"].to_numpy(),
                                               y=tail["y"].to_numpy(dtype=float), yhat=fitted,
                                               lower=np.nan, upper=np.nan))], ignore_index=True)
        out = out.assign(error=None, **meta)
    except Exception as exc:  # noqa: BLE001 - failure isolation per group
        out = pd.DataFrame([dict.fromkeys(OUT_COLS)]).assign(role="error", error=f"{type(exc).__name__}: {exc}")
    return out.assign(entity=pdf["entity"].iloc[0], model=model, fold=int(pdf["fold"].iloc[0]),
                      fit_time_s=time.perf_counter() - t0)[OUT_COLS]


# ----------------------------------------------------------------- job runners
def model_rows(series_rows: DataFrame) -> DataFrame:
    """Columns a grouped model needs: entity, fold, role, step, i, y, t (days)."""
    return series_rows.select("entity", "fold", "role", "step", "i", "y",
                              (F.unix_seconds(F.col("ts").cast("timestamp")) / 86400.0).alias("t"))


def run_arima(rows: DataFrame, horizon: int = 12, period: int = 52, d: int | None = None) -> DataFrame:
    """M1: one grouped task per (entity, fold). ``rows`` from folds.*; a fold
    with no test rows is a full fit that forecasts ``horizon`` future steps."""
    def fn(pdf):
        return _fit_group(pdf, "ARIMA", horizon, lambda *a: _arima_fit(*a, period, d))
    return model_rows(rows).groupBy("entity", "fold").applyInPandas(fn, OUT_SCHEMA)


def full_rows(series: DataFrame) -> DataFrame:
    """The whole series as training rows of the full fit (fold -2)."""
    return series.select("*", F.lit(-2).alias("fold"), F.lit("train").alias("role"),
                         F.lit(None).cast("int").alias("step"))
