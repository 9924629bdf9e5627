import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from panelkit.operators.anomaly import score
from panelkit.operators.outliers import detect_outliers, outlier_summary, residual_stats, severity
from tests.test_decompose import SPIKES, _weekly_from, numpy_decompose, seasonal_rows


def test_outliers_find_spikes(spark):
    v, dates = seasonal_rows(200)
    w = _weekly_from(spark, v, dates)
    o = detect_outliers(w, 12, 1.5).toPandas()
    got = set(pd.to_datetime(o["date"]).dt.date)
    assert {dates[at].date() for at in SPIKES} <= got
    _, _, resid = numpy_decompose(v, 12)
    q1, q3 = np.quantile(resid, [0.25, 0.75])
    lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    assert len(o) == int(((resid < lo) | (resid > hi)).sum())
    sev = dict(zip(pd.to_datetime(o["date"]).dt.date, o["severity"]))
    assert all(sev[dates[at].date()] == ("extreme_high" if jump > 0 else "extreme_low") for at, jump in SPIKES.items())


def test_residual_stats(spark):
    v, dates = seasonal_rows(200)
    s = residual_stats(_weekly_from(spark, v, dates), 12).toPandas().iloc[0]
    _, _, resid = numpy_decompose(v, 12)
    np.testing.assert_allclose(s["std"], np.std(resid, ddof=1), rtol=1e-10)
    assert s["iqr"] > 0 and abs(s["threshold"] - 1.5 * s["iqr"]) < 1e-12
    summ = outlier_summary(_weekly_from(spark, v, dates), 12).toPandas().iloc[0]
    assert summ["count"] >= 2 and summ["pct_total"] > 0


def test_severity_all_labels(spark):
    df = spark.createDataFrame([(x,) for x in (-10.0, -2.0, 0.0, 2.0, 10.0)], "r double")
    lab = df.select(severity(F.col("r"), F.lit(-1.0), F.lit(1.0)).alias("s")).toPandas()["s"].tolist()
    assert lab == ["extreme_low", "low", "normal", "high", "extreme_high"]
    # fences of one sign do not fail (a CASE, not a bin edge list)
    df.select(severity(F.col("r"), F.lit(0.5), F.lit(1.0))).collect()


def test_point_scoring(spark):
    stats = spark.createDataFrame([("e", 10.0, 2.0, 8.0, 12.0, 4.0, 6.0)],
                                  "entity string, mean double, std double, q1 double, q3 double, iqr double, threshold double")
    obs = spark.createDataFrame([("e", None, 15.5), ("e", None, 17.0), ("e", None, 23.0), ("zz", None, 90.0)],
                                "entity_id string, timestamp timestamp, value double")
    r = score(obs, stats).orderBy("value").toPandas()
    # off by 5.5 (within 6), 7 (over it) and 13 (over twice it)
    assert list(r["is_anomaly"]) == [False, True, True, False]
    assert list(r["severity"]) == ["none", "medium", "high", "unknown"]
    assert r["error"].iloc[3] == "No stats for entity zz" and r["threshold"].iloc[3] == 0.0
