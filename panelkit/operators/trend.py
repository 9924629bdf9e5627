"""Trend with changepoints and a yearly season for every entity and fold (M2, M7, M8).

The design of a fold is [1, time, a hinge per changepoint, sines and cosines of the year],
penalised least squares. Its cross-moments come from running sums over the entity, taken
once for all folds: a product of sines or cosines is a sum of sines and cosines of sums and
differences of the angles, and a hinge at c has the moments of (t - c) over the rows after c,
the difference of two running sums. So a fold's normal equations are look-ups of the sums
at its last train row and at its changepoints, packed in one row per (entity, fold).

One small solve per packed row is the only Python step. Fitted values, forecasts and
residuals are a dot product of the coefficient row with the design, as a column expression,
over the rows that ask for it; sigma comes from the moments as well.
"""

from __future__ import annotations

import math
import time

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

Z95 = 1.959963984540054
YEAR = 365.25
ORDER = 10        # pairs of yearly sine and cosine
CHANGES = 25      # changepoints, evenly over the first CHANGE_RANGE of the train rows
CHANGE_RANGE = 0.8
CHANGE_PENALTY, SEASON_PENALTY = 1.0, 0.01
LEAST_ROWS = 10   # train rows of a fit
SPEC = f"trend+yearly({ORDER})"

_K = np.arange(1, ORDER + 1)
#: Running sums by name, in the order they are packed.
SUMS = (["1", "u", "uu"] + [f"{g}{k}" for g in "cs" for k in range(1, 2 * ORDER + 1)]
        + [f"u{g}{k}" for g in "cs" for k in _K] + ["y", "uy"] + [f"y{g}{k}" for g in "cs" for k in _K] + ["yy"])
_AT = {name: k for k, name in enumerate(SUMS)}
_NUMBERS = T.ArrayType(T.DoubleType())
COEFFICIENTS = T.StructType([T.StructField(name, kind) for name, kind in (
    ("level", T.DoubleType()), ("slope", T.DoubleType()), ("places", _NUMBERS), ("steps", _NUMBERS), ("sines", _NUMBERS),
    ("cosines", _NUMBERS), ("sigma", T.DoubleType()), ("fit_time_s", T.DoubleType()), ("error", T.StringType()))])


def _angle(t: str, k: int) -> str:
    return f"({2 * math.pi * k / YEAR!r}D * {t})"


def running_sums(series: DataFrame) -> DataFrame:
    """entity, i, y0, n, t (days), u (days since the entity's first row), ``sums``: the
    packed running sums up to and with the row. ``series`` has entity, i, ts, y, n. Values
    are summed relative to the entity's first, y0, so a large level costs no digits (the
    level carries no penalty, so the fit is the same)."""
    s = series.select("entity", "i", "y", "n", (F.unix_seconds(F.col("ts").cast("timestamp")) / 86400.0).alias("t"))
    s = s.selectExpr("*", "t - first(t) OVER (PARTITION BY entity ORDER BY i) AS u", "first(y) OVER (PARTITION BY entity ORDER BY i) AS y0",
                     *[f"{f}({_angle('t', k)}) AS {f[0]}{k}" for f in ("cos", "sin") for k in range(1, 2 * ORDER + 1)])

    def value(name):
        if name == "y":
            return "(y - y0)"
        if name == "u" or name[0] in "cs":
            return name
        return "1.0D" if name == "1" else f"{value(name[0])} * {value(name[1:])}"

    sums = s.selectExpr("entity", "i", "y0", "n", "t", "u", *[
        f"sum({value(name)}) OVER (PARTITION BY entity ORDER BY i ROWS UNBOUNDED PRECEDING) AS r{k}" for k, name in enumerate(SUMS)])
    return sums.selectExpr("entity", "i", "y0", "n", "t", "u", f"array({', '.join(f'r{k}' for k in range(len(SUMS)))}) AS sums")


def packed_moments(series: DataFrame, slots: list) -> DataFrame:
    """One row per (entity, fold): n_train, y0, t0, span, the sums at the last train row
    (``total``) and, per changepoint, its place before its sums (``changes``)."""
    def mark(fold, stop, last, valid):
        hist = F.greatest(F.floor(stop * F.lit(CHANGE_RANGE)).cast("int"), F.lit(1))
        gap = (hist - 1) / F.lit(float(CHANGES))
        change = (F.col("i") > 0) & (F.col("i") < hist) & (F.rint(F.rint(F.try_divide(F.col("i"), gap)) * gap) == F.col("i"))
        return F.struct(F.lit(fold).alias("fold"), stop.alias("n_train"), (valid & (F.col("i") == stop - 1)).alias("closing"),
                        F.coalesce(valid & change, F.lit(False)).alias("change"))

    marks = F.filter(F.array(*[mark(*slot) for slot in slots]), lambda x: x["closing"] | x["change"])
    x = running_sums(series).select("*", F.explode(marks).alias("x")).select("*", "x.*").drop("x")
    closing = F.col("closing")
    return x.groupBy("entity", "fold").agg(
        F.max("n_train").alias("n_train"), F.min("y0").alias("y0"), F.min(F.col("t") - F.col("u")).alias("t0"),
        F.max(F.when(closing, F.col("u"))).alias("span"), F.first(F.when(closing, F.col("sums")), True).alias("total"),
        F.array_sort(F.collect_list(F.when(F.col("change"), F.concat(F.array("u"), "sums")))).alias("changes"))


def _pick(sums: np.ndarray, names) -> np.ndarray:
    return sums[..., [_AT[n] for n in names]]


def normal_equations(total: np.ndarray, changes: np.ndarray, span: float) -> tuple[np.ndarray, np.ndarray]:
    """X'X and X'y with time running from 0 to 1 over ``span`` days; columns: 1, time,
    hinges, sines, cosines."""
    at, after = changes[:, 0], total - changes[:, 1:]  # the sums over the rows after each changepoint
    m, k = len(at), ORDER
    sines, cosines = [f"s{j}" for j in _K], [f"c{j}" for j in _K]
    season = sines + cosines
    g = np.zeros((2 + m + 2 * k,) * 2)
    one, u, uu = (after[:, _AT[c]] for c in ("1", "u", "uu"))
    g[0, 0], g[0, 1], g[1, 1] = _pick(total, ["1", "u", "uu"])
    g[0, 2:2 + m], g[1, 2:2 + m] = u - at * one, uu - at * u
    late = np.maximum.outer(np.arange(m), np.arange(m))  # two hinges share the rows after the later one
    g[2:2 + m, 2:2 + m] = uu[late] - np.add.outer(at, at) * u[late] + np.multiply.outer(at, at) * one[late]
    g[0, 2 + m:], g[1, 2 + m:] = _pick(total, season), _pick(total, [f"u{c}" for c in season])
    g[2:2 + m, 2 + m:] = _pick(after, [f"u{c}" for c in season]) - at[:, None] * _pick(after, season)
    cos = np.r_[total[_AT["1"]], _pick(total, [f"c{j}" for j in range(1, 2 * k + 1)])]
    sin = np.r_[0.0, _pick(total, [f"s{j}" for j in range(1, 2 * k + 1)])]
    plus, minus = np.add.outer(_K, _K), np.subtract.outer(_K, _K)
    a, b = slice(2 + m, 2 + m + k), slice(2 + m + k, None)
    g[a, a], g[b, b] = (cos[abs(minus)] - cos[plus]) / 2, (cos[abs(minus)] + cos[plus]) / 2
    g[a, b] = (sin[plus] + np.sign(minus) * sin[abs(minus)]) / 2
    g = np.triu(g) + np.triu(g, 1).T
    xy = np.r_[_pick(total, ["y", "uy"]), after[:, _AT["uy"]] - at * after[:, _AT["y"]], _pick(total, [f"y{c}" for c in season])]
    scale = np.ones(len(g))
    scale[1:2 + m] = 1 / span
    return g * np.multiply.outer(scale, scale), xy * scale


def _solve(total, changes, span: float, n: int) -> dict:
    if n < LEAST_ROWS:
        raise ValueError(f"insufficient data ({n} obs)")
    total = np.asarray(total, float)
    changes = np.array([np.asarray(c, float) for c in changes]).reshape(-1, len(total) + 1)
    span, m = max(span, 1e-9), len(changes)
    g, xy = normal_equations(total, changes, span)
    penalty = np.r_[0.0, 0.0, np.full(m, CHANGE_PENALTY), np.full(2 * ORDER, SEASON_PENALTY)]
    beta = np.linalg.solve(g + np.diag(penalty), xy)
    mean = (total[_AT["y"]] - beta @ g[0]) / n
    square = (total[_AT["yy"]] - 2 * beta @ xy + beta @ g @ beta) / n
    pad = [0.0] * (CHANGES - m)
    return dict(level=beta[0], slope=beta[1], places=[*(changes[:, 0] / span), *pad], steps=[*beta[2:2 + m], *pad],
                sines=beta[2 + m:2 + m + ORDER].tolist(), cosines=beta[2 + m + ORDER:].tolist(), sigma=math.sqrt(max(square - mean * mean, 0.0)))


@F.pandas_udf(COEFFICIENTS)
def _coefficients(total: pd.Series, changes: pd.Series, span: pd.Series, n: pd.Series) -> pd.DataFrame:
    names = COEFFICIENTS.names
    out = []
    for row in zip(total, changes, span, n):
        began, got = time.perf_counter(), dict.fromkeys(names)
        try:
            got |= _solve(*row)
        except Exception as exc:  # noqa: BLE001 - a fit that fails is a row with its error
            got["error"] = f"{type(exc).__name__}: {exc}"
        out.append(got | {"fit_time_s": time.perf_counter() - began})
    return pd.DataFrame(out, columns=names)


def coefficients(series: DataFrame, slots: list) -> DataFrame:
    """The coefficient table: one row per (entity, fold), or its error."""
    p = packed_moments(series, slots).where(F.col("total").isNotNull())
    return p.select("entity", "fold", "n_train", "y0", "t0", F.greatest("span", F.lit(1e-9)).alias("span"),
                    _coefficients("total", "changes", "span", "n_train").alias("b")).select("*", "b.*").drop("b")


def fitted(t: str) -> Column:
    """The design at day ``t`` (a column) times the coefficients of the row."""
    terms = ["y0 + level", f"slope * ({t} - t0) / span"]
    terms += [f"steps[{j}] * greatest(({t} - t0) / span - places[{j}], 0D)" for j in range(CHANGES)]
    for k in range(1, ORDER + 1):
        terms += [f"sines[{k - 1}] * sin({_angle(t, k)})", f"cosines[{k - 1}] * cos({_angle(t, k)})"]
    return F.expr(" + ".join(terms))


def run_trend(series: DataFrame, slots: list, horizon: int = 12, step_days: float = 7.0) -> DataFrame:
    """PRED rows with the fit columns: in-sample and ``horizon`` future rows of the full fit
    (fold -2), test rows of the other folds, one ``error`` row per failed fit.
    ``slots`` are ``folds.fold_slots``; ``series`` has entity, i, ts, y, n."""
    last_row = F.col("i") == F.col("n") - 1

    def entry(role, fold, step):
        return F.struct(F.lit(fold).alias("fold"), F.lit(role).alias("role"), step.cast("int").alias("step"))

    asked = []
    for fold, stop, last, valid in slots:
        if fold == -2:
            ahead = F.transform(F.sequence(F.lit(1), F.lit(horizon)), lambda k: entry("future", -2, k))
            asked += [F.array(entry("insample", fold, F.lit(None))), F.when(last_row, ahead)]
        else:
            asked.append(F.when(valid & (F.col("i") >= stop) & (F.col("i") < last), F.array(entry("test", fold, F.col("i") - stop + 1))))
        asked.append(F.when(last_row & valid, F.array(entry("error", fold, F.lit(None)))))
    rows = series.select("entity", F.col("i").cast("int").alias("i"), "y", "n", (F.unix_seconds(F.col("ts").cast("timestamp")) / 86400.0).alias("t"))
    rows = rows.select("entity", "i", "y", "t", F.explode(F.flatten(F.array_compact(F.array(*asked)))).alias("x")).select("entity", "i", "y", "t", "x.*")
    # a fold's error row stands for it when the fit failed, its other rows when it did not
    x = rows.join(coefficients(series, slots), ["entity", "fold"]).where((F.col("role") == "error") == F.col("error").isNotNull())
    role, failed = F.col("role"), F.col("role") == "error"
    ahead = F.when(role == "future", F.col("step")).otherwise(F.lit(0))
    x = x.withColumn("t", F.col("t") + F.lit(step_days) * ahead)
    x = x.select("*", fitted("t").alias("yhat"), F.when(role.isin("test", "future"), F.lit(Z95) * F.col("sigma")).alias("band"))
    nothing = F.lit(None).cast("double")
    return x.select("entity", F.lit("Trend").alias("model"), "fold", "role", "step", F.when(~failed, F.col("i") + ahead).cast("int").alias("i"),
                    F.when(role.isin("insample", "test"), F.col("y")).alias("y"), "yhat", (F.col("yhat") - F.col("band")).alias("lower"),
                    (F.col("yhat") + F.col("band")).alias("upper"), F.when(~failed, F.lit(SPEC)).alias("spec"),
                    nothing.alias("aic"), nothing.alias("bic"), "sigma", "fit_time_s", "error")
