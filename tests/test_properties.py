"""Property tests: the window-only gap fill equals the pandas recipe on random
holes; decomposition invariants hold on random seasonal series."""

import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from panelkit.config import PanelConfig
from panelkit.operators.decompose import decompose
from panelkit.operators.resample import resample_fill
from tests.test_decompose import _weekly_from


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.floats(-1e4, 1e4, allow_nan=False)), min_size=2, max_size=40))
def test_fill_equals_pandas(spark, vals):
    if all(v is None for v in vals):
        vals = vals + [1.0]
    dates = pd.date_range("2022-01-02", periods=len(vals), freq="W")
    pdf = pd.DataFrame({"entity": "p", "ts": dates, "close": vals, "tb": range(len(vals))})
    got = resample_fill(spark.createDataFrame(pdf, "entity string, ts timestamp, close double, tb long"),
                        PanelConfig()).orderBy("idx").toPandas()
    s = pd.Series(vals, index=dates, dtype=float)
    # the spine spans every bin that holds a row (null closes included)
    ref = s.resample("W").last().ffill(limit=2).interpolate(method="linear", limit_direction="both")
    assert len(got) == len(ref)
    np.testing.assert_allclose(got["close"].to_numpy(dtype=float), ref.to_numpy(), rtol=1e-12, atol=1e-9)
    assert got["close"].notna().all()


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(2, 13), st.integers(0, 10 ** 6))
def test_decomposition_invariants(spark, P, seed):
    rng = np.random.default_rng(seed)
    n = 2 * P + int(rng.integers(0, 3 * P))
    t = np.arange(n)
    v = 50 + 0.1 * t + 3 * np.sin(2 * np.pi * t / P) + rng.standard_normal(n)
    d = decompose(_weekly_from(spark, v, pd.date_range("2000-01-31", periods=n, freq="ME")), P, "additive") \
        .orderBy("pos").toPandas()
    np.testing.assert_allclose(d["observed"], d["trend"] + d["seasonal"] + d["resid"], atol=1e-9)
    # the seasonal pattern is centred: one full period sums to zero
    assert abs(d["seasonal"].iloc[:P].sum()) < 1e-9
    # and repeats with the period
    np.testing.assert_allclose(d["seasonal"].iloc[P:2 * P].to_numpy(), d["seasonal"].iloc[:P].to_numpy())


def test_edge_nulls_take_nearest(spark):
    rows = pd.DataFrame({"entity": "e", "ts": pd.date_range("2022-01-02", periods=6, freq="W"),
                         "close": [None, None, 5.0, 6.0, None, None], "tb": range(6)})
    got = resample_fill(spark.createDataFrame(rows, "entity string, ts timestamp, close double, tb long"),
                        PanelConfig()).orderBy("idx").toPandas()
    assert list(got["close"]) == [5.0, 5.0, 5.0, 6.0, 6.0, 6.0]
