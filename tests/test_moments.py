"""Folds by running sums against a refit of every fold."""

import math
import re

import numpy as np
import pandas as pd
import pytest

from panelkit.operators import folds as fo
from panelkit.operators import forecast as fc
from panelkit.operators import trend as tr

SLOTS = dict(n_splits=4, horizon=6, test_size=0.25, hold=True)


def _series(spark, data, step=7):
    rows = [(e, i, (pd.Timestamp("2015-01-04") + pd.Timedelta(days=step * i + (i % 3))).to_pydatetime(), None if v is None else float(v))
            for e, ys in data.items() for i, v in enumerate(ys)]
    df = spark.createDataFrame(rows, "entity string, idx long, ts timestamp, returns double")
    return fo.target_series(df, "returns")


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(8)
    walk = 100 + rng.standard_normal(160).cumsum()
    return {"noise": rng.standard_normal(150), "walk": walk, "far": walk + 1e6, "gaps": [None if i % 11 == 3 else v for i, v in enumerate(walk)],
            "constant": [7.25] * 60, "two": [1.0, 4.0], "one": [3.0], "short": rng.standard_normal(7), "ten": rng.standard_normal(10)}


def folds_of(n, k=4, horizon=6, test_size=0.25):
    out = {-2: (n, n), -1: (math.floor(n * (1 - test_size)), n)}
    size = n // (k + 1)
    if size >= 1 and min(size, horizon) >= 2:
        out |= {f: (n - (k - f) * size, n - (k - f) * size + min(size, horizon)) for f in range(k)}
    return out


def test_ar1_folds_equal_a_fit_per_fold(spark, data):
    s = _series(spark, data)
    got = fc.ar1_jobs(s, fo.fold_slots(**SLOTS), horizon=3).toPandas()
    want = []
    for e, ys in data.items():
        y = np.array([v for v in ys if v is not None])
        for f, (stop, last) in folds_of(len(y)).items():
            train = y[:stop]
            x, z = train[:-1], train[1:]
            phi, c = 0.0, train.mean() if stop else np.nan
            if len(x) > 1 and np.ptp(x) > 0:
                phi = np.cov(x, z, bias=True)[0, 1] / x.var()
                c = z.mean() - phi * x.mean()
            if f == -2:
                want += [(e, f, "insample", np.nan, i, y[i], c + phi * y[i - 1]) for i in range(1, len(y))]
            at = train[-1] if stop else np.nan
            for h in range(1, (last - stop if f != -2 else 3) + 1):
                at = c + phi * at
                want.append((e, f, "future" if f == -2 else "test", h, stop + h - 1, np.nan if f == -2 else y[stop + h - 1], at))
    cols = ["entity", "fold", "role", "step", "i", "y", "yhat"]
    key = cols[:5]
    a = got[cols].sort_values(key).reset_index(drop=True)
    b = pd.DataFrame(want, columns=cols).sort_values(key).reset_index(drop=True)
    pd.testing.assert_frame_equal(a, b, check_dtype=False, rtol=1e-6, atol=1e-8)
    ok = got[(got.role != "insample") & got.yhat.notna() & ~got.entity.isin(["one", "two", "short", "constant"])]
    assert (ok.lower < ok.yhat).all() and (ok.yhat < ok.upper).all()
    # the interval's sigma, on the full fit of the noise series
    y = data["noise"]
    phi, c = np.polyfit(y[:-1], y[1:], 1)
    sigma = math.sqrt(((y[1:] - c - phi * y[:-1]) ** 2).sum() / (len(y) - 3))
    one = got[(got.entity == "noise") & (got.fold == -2) & (got.step == 1)].iloc[0]
    np.testing.assert_allclose(one.upper - one.yhat, 1.959963984540054 * sigma, rtol=1e-9)


def design(t, t0, span, places):
    x = (t - t0) / span
    cols = [np.ones_like(x), x, *[np.maximum(x - p, 0) for p in places]]
    for wave in (np.sin, np.cos):
        cols += [wave(2 * np.pi * k * t / 365.25) for k in range(1, 11)]
    return np.column_stack(cols)


def test_trend_folds_equal_a_fit_per_fold(spark, data):
    s = _series(spark, data)
    got = tr.run_trend(s, fo.fold_slots(**SLOTS), horizon=3, step_days=7.0).toPandas()
    times = s.toPandas()
    want, failed = [], []
    for e, g in times.sort_values("i").groupby("entity"):
        t, y = (g["ts"].astype("datetime64[s]").astype("int64") / 86400.0).to_numpy(), g["y"].to_numpy()
        for f, (stop, last) in folds_of(len(y)).items():
            if stop < 10:
                failed += [(e, f)] * (stop > 0)
                continue
            hist = max(math.floor(stop * 0.8), 1)
            at = sorted({round(j * (hist - 1) / 25) for j in range(1, 26)} - {0})
            span = t[stop - 1] - t[0]
            places = (t[at] - t[0]) / span
            x = design(t[:stop], t[0], span, places)
            penalty = np.diag([0.0, 0.0] + [1.0] * len(at) + [0.01] * 20)
            beta = np.linalg.solve(x.T @ x + penalty, x.T @ y[:stop])
            fit = x @ beta
            sigma = np.std(y[:stop] - fit)
            if f == -2:
                want += [(e, f, "insample", np.nan, i, y[i], fit[i], sigma) for i in range(stop)]
            ahead = t[stop:last] if f != -2 else t[-1] + 7.0 * np.arange(1, 4)
            for h, v in enumerate(design(ahead, t[0], span, places) @ beta, 1):
                want.append((e, f, "future" if f == -2 else "test", h, stop + h - 1, np.nan if f == -2 else y[stop + h - 1], v, sigma))
    cols = ["entity", "fold", "role", "step", "i", "y", "yhat", "sigma"]
    a = got[got.role != "error"][cols].sort_values(cols[:5]).reset_index(drop=True)
    b = pd.DataFrame(want, columns=cols).sort_values(cols[:5]).reset_index(drop=True)
    pd.testing.assert_frame_equal(a, b, check_dtype=False, rtol=1e-6, atol=1e-6)
    errors = got[got.role == "error"]
    assert sorted(zip(errors.entity, errors.fold)) == sorted(failed) and errors.error.str.contains("insufficient data").all()


def test_moments_equal_the_design(spark):
    """X'X and X'y from the packed running sums equal the products of the design."""
    y = np.random.default_rng(1).standard_normal(90)
    s = _series(spark, {"a": y})
    row = tr.packed_moments(s, fo.fold_slots(cv=False)).first()
    t = (s.toPandas().sort_values("i")["ts"].astype("datetime64[s]").astype("int64") / 86400.0).to_numpy()
    changes = np.array(row["changes"])
    g, xy = tr.normal_equations(np.array(row["total"]), changes, row["span"])
    x = design(t, t[0], t[-1] - t[0], changes[:, 0] / row["span"])
    np.testing.assert_allclose(g, x.T @ x, atol=1e-8)
    np.testing.assert_allclose(xy, x.T @ (y - y[0]), atol=1e-8)


def test_folds_cost_one_exchange_by_entity(spark, data):
    s = _series(spark, data)
    exchanges = lambda df: len(re.findall(r"Exchange hashpartitioning\(", df._jdf.queryExecution().executedPlan().toString()))
    one = exchanges(fc.ar1_jobs(s, fo.fold_slots(cv=False)))
    assert one == exchanges(fc.ar1_jobs(s, fo.fold_slots(hold=True))) == exchanges(s)
    trend = [exchanges(tr.packed_moments(s, fo.fold_slots(cv=k, hold=k))) for k in (False, True)]
    assert trend[0] == trend[1] == exchanges(s)


def test_empty_series(spark):
    s = _series(spark, {"a": [1.0, 2.0]}).where("entity = 'b'")
    assert fc.ar1_jobs(s, fo.fold_slots(hold=True)).count() == 0
    assert tr.run_trend(s, fo.fold_slots(hold=True)).count() == 0
