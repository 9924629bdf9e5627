import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from panelkit.operators import stattests as st


def chi2_sf_py(x: float, k: int) -> float:
    """Chi-square upper tail for integer k by the closed-form series."""
    if x is None or k is None or math.isnan(x):
        return float("nan")
    if x <= 0:
        return 1.0
    if k % 2 == 0:
        h = x / 2
        term, tot = 1.0, 1.0
        for i in range(1, k // 2):
            term *= h / i
            tot += term
        return math.exp(-h) * tot
    s = math.sqrt(x)
    tail = math.erfc(s / math.sqrt(2))
    pdf = math.exp(-x / 2) / math.sqrt(2 * math.pi)
    term, tot = s, 0.0
    for i in range(1, (k - 1) // 2 + 1):
        if i > 1:
            term *= x / (2 * i - 1)
        tot += term
    return tail + 2 * pdf * tot


def test_chi_square_tail_of_one_to_ten_degrees(spark):
    from panelkit.functions.scalar import chi2_sf, erfc_sql

    xs = [0.0, 1e-12, 1e-3, 0.3, 1.0, 3.84, 7.5, 12.4, 12.5, 12.6, 18.3, 30.0, 60.0, 200.0]
    df = spark.createDataFrame([(x, k) for x in xs for k in range(0, 12)], "x double, k int")
    for r in df.select("x", "k", chi2_sf("x", "k", 10).alias("p")).collect():
        if 1 <= r.k <= 10:
            np.testing.assert_allclose(r.p, chi2_sf_py(r.x, r.k), rtol=1e-9, atol=1e-15)
        else:
            assert r.p is None
    z = spark.createDataFrame([(float(v),) for v in np.linspace(0, 9, 400)], "z double")
    for r in z.select("z", F.expr(erfc_sql("z")).cast("double").alias("e")).collect():
        np.testing.assert_allclose(r.e, math.erfc(r.z), rtol=2e-11, atol=2e-15)


def _series_df(spark, xs):
    rows = []
    for e, x in xs.items():
        rows += [(e, int(i), float(v)) for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "entity string, idx long, close double")


def np_acov(x, k, adjusted=False):
    d = x - x.mean()
    n = len(x)
    return float(np.dot(d[:n - k], d[k:]) / (n - k if adjusted and k else n))


def test_acf_pacf_vs_numpy(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal(120).cumsum() * 0.1 + rng.standard_normal(120)
    df = _series_df(spark, {"a": x})
    a = st.acf(df, "close").orderBy("lag").toPandas()
    ref = np.array([np_acov(x, k) / np_acov(x, 0) for k in range(31)])
    np.testing.assert_allclose(a["acf"], ref, atol=1e-12)
    np.testing.assert_allclose(a["conf"].iloc[0], 1.96 / math.sqrt(120))
    p = st.pacf(df, "close").orderBy("lag").toPandas()
    r = np.array([np_acov(x, k, adjusted=True) for k in range(31)])
    ref_p = [1.0]
    for k in range(1, 31):
        R = np.array([[r[abs(i - j)] for j in range(k)] for i in range(k)])
        ref_p.append(np.linalg.solve(R, r[1:k + 1])[-1])
    np.testing.assert_allclose(p["pacf"], ref_p, atol=1e-9)


def test_nlags_rule(spark):
    x = np.arange(10, dtype=float) ** 1.5
    a = st.acf(_series_df(spark, {"a": x}), "close").toPandas()
    assert a["lag"].max() == 4  # min(30, n // 2 - 1)


def test_ljung_box_and_jb(spark):
    rng = np.random.default_rng(1)
    x = rng.standard_normal(300)
    df = _series_df(spark, {"a": x, "short": x[:15]})
    lb = st.ljung_box(df, "close").toPandas().set_index("entity")
    n, L = 300, 10
    rho = [np_acov(x, k) / np_acov(x, 0) for k in range(L + 1)]
    q = n * (n + 2) * sum(rho[k] ** 2 / (n - k) for k in range(1, L + 1))
    np.testing.assert_allclose(lb.loc["a", "lb_stat"], q, rtol=1e-10)
    np.testing.assert_allclose(lb.loc["a", "lb_pvalue"], chi2_sf_py(q, 10), rtol=1e-10)
    assert lb.loc["short", "lags"] == 6  # odd/even df through the general path
    jb = st.jarque_bera(df, "close").toPandas().set_index("entity")
    d = x - x.mean()
    s = np.mean(d ** 3) / np.mean(d ** 2) ** 1.5
    k = np.mean(d ** 4) / np.mean(d ** 2) ** 2 - 3
    np.testing.assert_allclose(jb.loc["a", "jb_stat"], n / 6 * (s * s + k * k / 4), rtol=1e-9)


def test_chi2_tail_closed_forms():
    # df 1: 2 * (1 - Phi(sqrt x)); df 2: exp(-x/2)
    assert abs(chi2_sf_py(3.841458820694124, 1) - 0.05) < 1e-9
    assert abs(chi2_sf_py(2.0, 2) - math.exp(-1)) < 1e-15
    assert abs(chi2_sf_py(18.307038053275146, 10) - 0.05) < 1e-9
    assert abs(chi2_sf_py(11.070497693516351, 5) - 0.05) < 1e-9


def test_adf_kpss(spark):
    rng = np.random.default_rng(0)
    walk = rng.standard_normal(300).cumsum()
    noise = rng.standard_normal(300)
    assert abs(st.adf_pvalue(-2.86) - 0.05) < 0.002
    df = _series_df(spark, {"walk": walk, "noise": noise, "tiny": noise[:8]})
    r = st.stationarity(df, "close").toPandas().set_index("entity")
    assert r.loc["walk", "adf_pval"] > 0.05 and r.loc["walk", "d_suggested"] == 1
    assert r.loc["noise", "adf_pval"] < 0.05 and r.loc["noise", "d_suggested"] == 0
    assert 0.01 <= r.loc["noise", "kpss_pval"] <= 0.1
    assert not r.loc["tiny", "adf_stationary"] and r.loc["tiny", "d_suggested"] == 1


def test_pacf_of_a_constant_entity(spark):
    import numpy as np

    from panelkit.operators import stattests as st

    rows = [("c", i, 2.0) for i in range(30)] + [("x", i, float(v)) for i, v in enumerate(np.random.default_rng(1).normal(size=30))]
    df = spark.createDataFrame(rows, "entity string, idx int, close double")
    got = st.pacf(df).toPandas()
    assert got[(got["entity"] == "c") & (got["lag"] > 0)]["pacf"].isna().all()
    assert got[got["entity"] == "x"]["pacf"].notna().all()


def test_kpss_against_numpy(spark):
    rng = np.random.default_rng(9)
    data = {"noise": rng.standard_normal(150), "walk": np.cumsum(rng.standard_normal(150)), "flat": np.full(40, 2.0)}
    df = spark.createDataFrame([(e, k, float(v)) for e, x in data.items() for k, v in enumerate(x)],
                               "entity string, idx long, close double")
    r = st.kpss(df, "close").toPandas().set_index("entity")
    for name in ("noise", "walk"):
        x, n = data[name], 150
        t = np.arange(n)
        e = x - np.polyval(np.polyfit(t, x, 1), t)
        acov = np.array([e[k:] @ e[:n - k] for k in range(n)]) / n
        c = int(n ** (2 / 9))
        s0, s1 = acov[0] + 2 * acov[1:c + 1].sum(), 2 * (np.arange(1, c + 1) * acov[1:c + 1]).sum()
        q = int(1.1447 * ((s1 / s0) ** 2 * n) ** (1 / 3))
        lrv = acov[0] + 2 * sum(acov[k] * (1 - k / (q + 1)) for k in range(1, q + 1))
        stat = (np.cumsum(e) ** 2).sum() / n ** 2 / lrv
        assert r.loc[name, "kpss_lags"] == q
        np.testing.assert_allclose(r.loc[name, "kpss_stat"], stat, rtol=1e-9)
        np.testing.assert_allclose(r.loc[name, "kpss_pval"], np.interp(stat, st.KPSS_CT_CRIT, st.KPSS_PVALS), rtol=1e-9)
    assert not r.loc["flat", "kpss_stationary"] and np.isnan(r.loc["flat", "kpss_stat"])


def test_adf_from_moment_sums(spark):
    rng = np.random.default_rng(11)
    data = {"walk": 500 + np.cumsum(rng.standard_normal(200)), "noise": rng.standard_normal(77),
            "ar": np.convolve(rng.standard_normal(140), [1, .6, .3, .2])[:140], "ten": rng.standard_normal(10),
            "nine": rng.standard_normal(9), "flat": np.full(30, 4.0), "line": np.arange(30.0)}
    rows = [(e, k, float(v)) for e, x in data.items() for k, v in enumerate(x)] + [("walk", 500, None)]
    r = st.adf_test(spark.createDataFrame(rows, "entity string, idx long, close double"), "close").toPandas().set_index("entity")
    for name in ("walk", "noise", "ar", "ten"):
        tau, p, lag = st.adf(data[name])
        assert r.loc[name, "adf_lag"] == lag and r.loc[name, "n"] == len(data[name])
        np.testing.assert_allclose([r.loc[name, "adf_stat"], r.loc[name, "adf_pval"]], [tau, p], rtol=1e-7, atol=1e-12)
        assert r.loc[name, "d_suggested"] == (0 if p < 0.05 else 1)
    for name in ("flat", "line"):  # no variance, collinear lags
        assert "Error" in r.loc[name, "error"] and r.loc[name, "d_suggested"] == 1
    assert r.loc["nine", "error"] is None and not r.loc["nine", "adf_stationary"]
