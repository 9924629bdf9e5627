import math
import os

from pyspark.sql import functions as F

from panelkit.config import PanelConfig
from panelkit.plans.refresh import current, panel_digests, refresh
from tests.conftest import make_panel

CFG = PanelConfig(freq="D", period=4)


def _rows(scale=1.0, names=("a", "b", "c")):
    return [(e, f"2024-01-{d:02d}", 10 + math.sin(d * k) * (scale if e == "b" else 1)) for k, e in enumerate(names, 1) for d in range(1, 15)]


def _build(f, cfg):
    return {"last": f.groupBy("entity").agg(F.max_by("close", "idx").alias("close"), F.sum("returns").alias("ret"))}


def _state(spark, out):
    return {r.entity: (r.version, r.close, r.ret) for r in current(spark, out, "last").collect()}


def _files(out):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(f"{out}/last") for f in fs}


def test_only_changed_entities_are_computed(spark, tmp_path):
    out = str(tmp_path / "s")
    assert refresh(spark, make_panel(spark, _rows()), out, _build, CFG) == 3
    first, files = _state(spark, out), _files(out)
    assert refresh(spark, make_panel(spark, _rows(2.0)), out, _build, CFG) == 1
    second = _state(spark, out)
    assert second["a"] == first["a"] and second["c"] == first["c"] and second["b"][0] == 2
    assert [r.entity for r in spark.read.parquet(f"{out}/last/version=2").collect()] == ["b"]
    assert {f: t for f, t in _files(out).items() if f in files} == files  # the former version's files stay as they were
    full = str(tmp_path / "full")
    refresh(spark, make_panel(spark, _rows(2.0)), full, _build, CFG)
    assert {e: v[1:] for e, v in _state(spark, full).items()} == {e: v[1:] for e, v in second.items()}
    # rows in another order and repeated: nothing changes; an entity leaves, another comes
    assert refresh(spark, make_panel(spark, _rows(2.0)[::-1] + _rows(2.0)), out, _build, CFG) == 0
    assert _state(spark, out) == second
    assert refresh(spark, make_panel(spark, _rows(2.0, ("a", "b", "c", "d"))).where("entity <> 'c'"), out, _build, CFG) == 1
    assert {e: v[0] for e, v in _state(spark, out).items()} == {"a": 1, "b": 2, "d": 4}


def test_an_unfinished_refresh_leaves_the_state(spark, tmp_path):
    out = str(tmp_path / "s")
    refresh(spark, make_panel(spark, _rows()), out, _build, CFG)
    before = _state(spark, out)

    def broken(f, cfg):
        _build(f, cfg)["last"].write.parquet(f"{out}/last/version=2")
        raise RuntimeError("lost")

    try:
        refresh(spark, make_panel(spark, _rows(3.0)), out, broken, CFG)
    except RuntimeError:
        pass
    assert _state(spark, out) == before
    assert refresh(spark, make_panel(spark, _rows(3.0)), out, _build, CFG) == 1
    assert _state(spark, out)["b"][0] == 2


def test_digests_see_settings_nulls_and_empty_panels(spark, tmp_path):
    p = make_panel(spark, [("a", "2024-01-01", 1.0), ("a", "2024-01-02", None), (None, "2024-01-01", 2.0)])
    one = {r.entity: r.digest for r in panel_digests(p, CFG).collect()}
    other = {r.entity: r.digest for r in panel_digests(p, PanelConfig(freq="D", period=5)).collect()}
    assert one["a"] != other["a"]
    out = str(tmp_path / "e")
    assert refresh(spark, p.limit(0), out, _build, CFG) == 0
    assert refresh(spark, p, out, _build, CFG) == 1 and set(_state(spark, out)) == {"a"}
