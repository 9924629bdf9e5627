import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelkit.config import PanelConfig
from panelkit.operators.decompose import decompose, model_detection
from panelkit.operators.resample import resample_fill


#: Where the outliers of ``seasonal_rows`` stand, and by how much they are off.
SPIKES = {73: 64.0, 121: -57.0}


def seasonal_rows(n=200, seed=7, spikes=True):
    """A slowly bending level, a saw-tooth year with a half-year wave, uniform noise."""
    rng, t = np.random.default_rng(seed), np.arange(n)
    v = 240 - 0.3 * t + 0.001 * t ** 2 + 0.8 * (t % 12) + 2 * np.cos(np.pi * t / 3) + rng.uniform(-0.7, 0.7, n)
    for at, jump in SPIKES.items() if spikes else ():
        v[at] += jump
    return v, pd.date_range("2011-04-01", periods=n, freq="ME")


def _weekly_from(spark, v, dates, entity="s"):
    pdf = pd.DataFrame({"entity": entity, "ts": dates, "close": v, "tb": np.arange(len(v))})
    return resample_fill(spark.createDataFrame(pdf), PanelConfig(freq="ME"))


def numpy_decompose(x, P, model="additive"):
    """Independent NumPy version of the classical recipe (centred MA,
    least-squares edge extrapolation over P points, centred phase means)."""
    n = len(x)
    if P % 2 == 0:
        filt = np.r_[0.5, np.ones(P - 1), 0.5] / P
    else:
        filt = np.ones(P) / P
    h = len(filt) // 2
    trend = np.full(n, np.nan)
    for t in range(h, n - h):
        trend[t] = np.dot(filt, x[t - h:t + h + 1])
    front, back = h, n - 1 - h
    fl = min(front + P, back)
    k, c = np.polyfit(np.arange(front, fl), trend[front:fl], 1)
    trend[:front] = np.arange(front) * k + c
    bf = max(front, back - P)
    k, c = np.polyfit(np.arange(bf, back), trend[bf:back], 1)
    trend[back + 1:] = np.arange(back + 1, n) * k + c
    det = x / trend if model == "multiplicative" else x - trend
    pa = np.array([np.mean(det[i::P]) for i in range(P)])
    pa = pa / pa.mean() if model == "multiplicative" else pa - pa.mean()
    seas = np.tile(pa, n // P + 1)[:n]
    resid = x / seas / trend if model == "multiplicative" else det - seas
    return trend, seas, resid


@pytest.mark.parametrize("n,P", [(200, 12), (40, 5), (104, 52), (105, 52)])
def test_matches_numpy(spark, n, P):
    v, dates = seasonal_rows(n, spikes=False)
    d = decompose(_weekly_from(spark, v, dates), P, model="additive").orderBy("pos").toPandas()
    tr, se, re = numpy_decompose(v, P)
    np.testing.assert_allclose(d["trend"], tr, atol=1e-9)
    np.testing.assert_allclose(d["seasonal"], se, atol=1e-9)
    np.testing.assert_allclose(d["resid"], re, atol=1e-9)


def test_multiplicative_matches_numpy(spark):
    v, dates = seasonal_rows(120, spikes=False)
    d = decompose(_weekly_from(spark, v, dates), 12, model="multiplicative").orderBy("pos").toPandas()
    tr, se, re = numpy_decompose(v, 12, "multiplicative")
    np.testing.assert_allclose(d["seasonal"], se, atol=1e-12)
    np.testing.assert_allclose(d["resid"], re, atol=1e-12)


def test_properties_and_short_path(spark):
    v, dates = seasonal_rows(200)
    d = decompose(_weekly_from(spark, v, dates), 12).orderBy("pos").toPandas()
    if d["model"].iloc[0] == "additive":
        np.testing.assert_allclose(d["observed"], d["trend"] + d["seasonal"] + d["resid"], atol=1e-9)
    short = decompose(_weekly_from(spark, v[:23], dates[:23]), 12).toPandas()
    assert short["trend"].isna().all() and (short["model"] == "additive").all() and len(short) == 23
    ok = decompose(_weekly_from(spark, v[:24], dates[:24]), 12).toPandas()
    assert ok["trend"].notna().all()


def test_model_detection_branches(spark):
    v, dates = seasonal_rows(200, spikes=False)
    md = model_detection(_weekly_from(spark, v, dates), 12).toPandas()
    assert md["model"].iloc[0] in ("additive", "multiplicative")
    neg = model_detection(_weekly_from(spark, v - 400, dates), 12).toPandas()
    assert neg["model"].iloc[0] == "additive"  # values <= 0: multiplicative is not allowed
