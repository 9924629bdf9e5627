import os
import tempfile

import pytest
from pyspark.sql import functions as F

from panelkit.config import PanelConfig
from panelkit.plans import export as ex
from panelkit.schema import STATS
from panelkit.sources import files, tables
from tests.conftest import SF_SMALL


def _tmp():
    return tempfile.mkdtemp(prefix="panelkit-src-", dir="/tmp")


def test_csv_coercion_and_checks(spark):
    d = _tmp()
    p = os.path.join(d, "prices.csv")
    with open(p, "w") as fh:
        fh.write("entity,Date,Close,Volume\nA,2024-01-02,10.5,1\nA,2024-01-03,bad,2\nB,not-a-date,3,3\nB,2024-01-05,NaN,4\n")
    raw = files.load_file(spark, p).orderBy("entity", "ts").toPandas()
    assert list(raw.columns) == ["entity", "ts", "close"]
    a = raw[raw.entity == "A"]
    assert a["close"].iloc[0] == 10.5 and a["close"].isna().iloc[1]  # bad text -> NULL
    b = raw[raw.entity == "B"]
    assert b["ts"].isna().sum() == 1 and b["close"].isna().sum() == 1  # bad date, NaN -> NULL
    with pytest.raises(ValueError, match="lacks"):
        files.load_file(spark, p, value_col="Price")
    bad = os.path.join(d, "prices.xlsx")
    open(bad, "w").close()
    with pytest.raises(ValueError, match="csv or .parquet"):
        files.load_file(spark, bad)
    with pytest.raises(FileNotFoundError):
        files.load_file(spark, os.path.join(d, "missing.csv"))


def test_parquet_and_filters(spark):
    raw = tables.nation_panel(spark, SF_SMALL)
    cfg = PanelConfig(start_date="1995-01-01", end_date="1995-12-31", entities=("NATION_1", "NATION_2"))
    f = files.filter_panel(raw, cfg)
    got = f.agg(F.min("ts"), F.max("ts"), F.countDistinct("entity")).collect()[0]
    assert str(got[0]) >= "1995-01-01" and str(got[1]) <= "1995-12-31 00:00:00" and got[2] <= 2
    plan = f._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan or "DataFilters" in plan


def test_dispatch_and_fallback(spark):
    with pytest.raises(ValueError, match="kind is"):
        files.load_panel(spark, "ftp")
    fresh = spark.createDataFrame([("a", None, 1.0)], "entity string, ts timestamp, close double")
    cache = spark.createDataFrame([("a", None, 9.0), ("b", None, 2.0)], "entity string, ts timestamp, close double")
    u = files.with_cache_fallback(fresh, cache).orderBy("entity").toPandas()
    assert list(u["entity"]) == ["a", "b"] and list(u["close"]) == [1.0, 2.0]
    assert files.with_cache_fallback(fresh.limit(0), cache, need_rows=True).count() == 2
    assert files.with_cache_fallback(fresh.limit(0), cache.limit(0)).count() == 0
    with pytest.raises(ValueError, match="no rows from any source"):
        files.with_cache_fallback(fresh.limit(0), cache.limit(0), need_rows=True)
    with pytest.raises(ValueError):
        files._ident("x; DROP TABLE y")


def test_stats_and_document_round_trip(spark):
    d = _tmp()
    st = spark.createDataFrame([("e", 0.0, 1.0, -1.0, 1.0, 2.0, 3.0)], STATS)
    ex.write_table(st, f"{d}/stats.csv", "csv")
    back = files.load_stats(spark, f"{d}/stats.csv")
    assert back.collect()[0]["threshold"] == 3.0
    ex.write_table(st, f"{d}/stats_pq")
    assert files.load_stats(spark, f"{d}/stats_pq").count() == 1
    doc = spark.createDataFrame([("e", [1.0, float("nan")])], "entity string, v array<double>")
    ex.write_table(doc, f"{d}/doc", "json")
    r = ex.read_document(spark, f"{d}/doc").collect()[0]
    assert r["entity"] == "e"
    nf = ex.null_non_finite(spark.createDataFrame([(float("inf"),), (float("nan"),), (1.0,)], "x double"))
    assert [r[0] for r in nf.collect()] == [None, None, 1.0]
    ex.write_table(st, f"{d}/by_entity", partition_by="entity")
    assert os.path.isdir(f"{d}/by_entity/entity=e")


def test_cluster_conf_and_checkpoint_folder(spark):
    from panelkit.session import checkpoint_dir, cluster_conf

    c = cluster_conf(8000, 100 * 1024 ** 4)
    assert int(c["spark.sql.shuffle.partitions"]) >= 24000 and c["spark.sql.adaptive.enabled"] == "true"
    assert checkpoint_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_range_on_text_dates(spark, tmp_path):
    from panelkit.sources.files import load_file

    path = str(tmp_path / "x.csv")
    with open(path, "w") as f:
        f.write("entity,Date,Close\na,2020-01-01,1\na,2020-06-01,2\na,2021-01-01,3\n")
    assert [r.close for r in load_file(spark, path, start="2020-02-01", end="2020-12-31").collect()] == [2.0]
