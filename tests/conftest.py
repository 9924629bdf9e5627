import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    ckpt = tempfile.mkdtemp(prefix="panelkit-test-ckpt-", dir="/tmp")
    s = (SparkSession.builder.master("local[*]").appName("panelkit-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", ckpt)
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s


SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


def make_panel(spark, rows, with_tb=True):
    """rows: (entity, 'YYYY-MM-DD[ HH:MM]', close) -> RAW (+ tb = row number)."""
    import datetime as dt

    out = []
    for k, (e, ts, v) in enumerate(rows):
        t = dt.datetime.fromisoformat(ts)
        out.append((e, t, None if v is None else float(v), k) if with_tb else (e, t, None if v is None else float(v)))
    schema = "entity string, ts timestamp, close double" + (", tb long" if with_tb else "")
    return spark.createDataFrame(out, schema)
