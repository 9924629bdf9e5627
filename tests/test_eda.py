import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from panelkit.operators import eda
from panelkit.operators.ranking import exact_quantile, global_rank


def _panel(spark, data):
    rows = []
    for e, xs in data.items():
        for i, v in enumerate(xs):
            rows.append((e, i, (pd.Timestamp("2020-01-05") + pd.Timedelta(days=7 * i)).to_pydatetime(), None if v is None else float(v)))
    df = spark.createDataFrame(rows, "entity string, idx long, ts timestamp, close double")
    return df.withColumn("ts", F.to_date("ts")).withColumn(
        "returns", F.log(F.col("close") / F.lag("close").over(__import__("pyspark.sql").sql.Window.partitionBy("entity").orderBy("idx"))))


def test_kde_histogram_vs_numpy(spark):
    rng = np.random.default_rng(5)
    x = rng.standard_normal(80) * 3 + 10
    p = _panel(spark, {"a": x})
    k = eda.kde(p, 200).orderBy("i").toPandas()
    h = np.std(x, ddof=1) * len(x) ** -0.2
    grid = np.linspace(x.min(), x.max(), 200)
    ref = np.exp(-0.5 * ((grid[:, None] - x[None, :]) / h) ** 2).sum(1) / (len(x) * h * math.sqrt(2 * math.pi))
    np.testing.assert_allclose(k["density"], ref, rtol=1e-9)
    hist = eda.histogram(p, 30).orderBy("bin").toPandas()
    ref_h, edges = np.histogram(x, bins=30, density=True)
    np.testing.assert_allclose(hist["density"], ref_h, rtol=1e-9)
    assert hist["count"].sum() == 80 and len(hist) == 30


def test_constant_series_guards(spark):
    p = _panel(spark, {"c": [5.0] * 10})
    assert eda.kde(p).count() == 0
    h = eda.histogram(p).toPandas()
    assert h["count"].sum() == 10 and len(h) == 30


def test_drawdown_and_rank(spark):
    p = _panel(spark, {"a": [10, 12, 9, 13, 6], "b": [5, 4, 3, 2, 1], "c": [1, 2, 3, 4, 5]})
    d = eda.drawdown(p).toPandas()
    assert (d["drawdown_pct"] <= 0).all()
    m = eda.max_drawdown(p).toPandas().set_index("entity")
    np.testing.assert_allclose(m.loc["a", "max_drawdown_pct"], (6 - 13) / 13 * 100)
    r = eda.return_ranking(p).toPandas().sort_values("rank")
    assert list(r["entity"]) == ["c", "a", "b"] and list(r["rank"]) == [1, 2, 3]
    bw = eda.best_worst(p).toPandas().iloc[0]
    assert bw["best_entity"] == "c" and bw["worst_entity"] == "b"
    tb = eda.top_bottom(p, 3).toPandas()
    assert tb["in_top"].all() and tb["in_bottom"].all()  # overlap below 2k entities


def test_ties_first_date(spark):
    p = _panel(spark, {"t": [1, 5, 2, 5, 3]})
    k = eda.kpis(p).toPandas().iloc[0]
    assert str(k["peak_date"]) == "2020-01-12"


def test_global_rank_and_quantile(spark):
    rng = np.random.default_rng(9)
    vals = rng.standard_normal(1000)
    df = spark.createDataFrame([(float(v), i) for i, v in enumerate(vals)], "v double, id long")
    r = global_rank(df, [F.col("v"), F.col("id")], "r").toPandas().sort_values("r")
    assert list(r["r"]) == list(range(1, 1001)) and (np.diff(r["v"]) >= 0).all()
    for q in (0.0, 0.25, 0.95, 1.0):
        got = exact_quantile(df, "v", q).collect()[0][0]
        np.testing.assert_allclose(got, np.quantile(vals, q), rtol=1e-12)


def test_correlation_matrix(spark):
    rng = np.random.default_rng(2)
    a = rng.standard_normal(50)
    b = a * 0.5 + rng.standard_normal(50)
    p = _panel(spark, {"a": a, "b": b})
    c = eda.correlation_matrix(p).toPandas().set_index(["e1", "e2"])
    np.testing.assert_allclose(c.loc[("a", "b"), "corr"], np.corrcoef(a, b)[0, 1], rtol=1e-9)
    np.testing.assert_allclose(c.loc[("a", "a"), "corr"], 1.0)


def test_probability_plot(spark):
    x = np.array([3.0, 1.0, 2.0, 5.0, 4.0])
    pp = eda.probability_plot(_panel(spark, {"a": x})).orderBy("i").toPandas()
    n = 5
    m = np.r_[1 - 0.5 ** (1 / n), (np.arange(2, n) - 0.3175) / (n + 0.365), 0.5 ** (1 / n)]
    from statistics import NormalDist
    np.testing.assert_allclose(pp["osm"], [NormalDist().inv_cdf(v) for v in m], atol=1e-8)
    assert list(pp["osr"]) == [1, 2, 3, 4, 5]


def test_quantile_with_a_hot_value(spark):
    # a third of the rows share one value: salted range partitions stay balanced
    vals = [5.0] * 3000 + list(np.linspace(0, 10, 6000))
    df = spark.createDataFrame([(float(v),) for v in vals], "v double")
    for q in (0.1, 0.5, 0.95):
        np.testing.assert_allclose(exact_quantile(df, "v", q).collect()[0][0], np.quantile(vals, q), rtol=1e-12)
    ranked = global_rank(df.select("v", F.rand(1).alias("s")), [F.col("v"), F.col("s")], "r", num_partitions=8)
    sizes = ranked.groupBy(F.spark_partition_id().alias("p")).count().toPandas()["count"]
    assert sizes.max() < 0.5 * len(vals)


def test_correlation_block_path_matches_dense(spark):
    rng = np.random.default_rng(8)
    base = rng.standard_normal(40)
    data = {f"e{k}": base * (k % 3 - 1) + rng.standard_normal(40) for k in range(6)}
    p = _panel(spark, data)
    dense = eda.correlation_matrix(p).toPandas().set_index(["e1", "e2"]).sort_index()
    block = eda.correlation_matrix(p, block=2).toPandas().set_index(["e1", "e2"]).sort_index()
    np.testing.assert_allclose(block["corr"], dense["corr"], atol=1e-12)
    assert (block["n_dates"] == dense["n_dates"]).all()


def test_global_rank_is_exact_on_large_data_with_payload(spark):
    # the sample that sets range boundaries is far smaller than the data, and the payload column is pruned from the counts
    for aqe in ("true", "false"):
        spark.conf.set("spark.sql.adaptive.enabled", aqe)
        df = spark.range(1_200_000).select(F.pmod(F.xxhash64("id"), F.lit(1000)).alias("k"), "id", F.concat(F.lit("payload"), "id").alias("p"))
        r = global_rank(df, [F.col("k").desc(), F.col("id")], "r", total="n")
        got = r.agg(F.count_distinct("r"), F.min("r"), F.max("r"), F.max("n"), F.count("p")).first()
        assert tuple(got) == (1_200_000, 1, 1_200_000, 1_200_000, 1_200_000)
        follows = r.join(r.select((F.col("r") + 1).alias("r"), F.col("k").alias("k0"), F.col("id").alias("id0")), "r")
        assert follows.where("k > k0 or (k = k0 and id < id0)").count() == 0
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_correlation_guards(spark):
    a = np.arange(20.0) ** 2
    c = eda.correlation_matrix(_panel(spark, {"a": a, "b": a[::-1].copy(), "c": np.full(20, 0.1)}), block=1).toPandas().set_index(["e1", "e2"])["corr"]
    assert len(c) == 9 and c[("a", "a")] == 1 and c[("a", "b")] < 0 and c[("a", "c")] != c[("a", "c")] and c[("c", "c")] != c[("c", "c")]
    one = eda.correlation_matrix(_panel(spark, {"a": [1.0], "b": [2.0]})).toPandas()
    assert len(one) == 4 and one["corr"].isna().all() and (one["n_dates"] == 1).all()
    p = _panel(spark, {"a": [1.0, 2.0], "b": [2.0, 3.0]})
    apart = eda.correlation_matrix(p.where("(entity = 'a') = (close < 1.5)").where("entity = 'a' or close > 2.5")).toPandas()
    assert len(apart) == 4 and apart["corr"].isna().all() and (apart["n_dates"] == 0).all()


def test_ties_have_one_rule(spark):
    p = _panel(spark, {k: [1.0, 2.0] for k in "xyz"})
    bw = eda.best_worst(p).first()
    roles = {r.entity: r.role for r in eda.series_with_labels(p).collect()}
    assert (bw.best_entity, bw.worst_entity) == ("z", "x") and roles == {"x": "worst", "y": None, "z": "best"}


def test_event_labels_inside_the_windows(spark):
    rows = spark.sql("SELECT 'a' AS entity, to_timestamp(d) AS ts, 1.0D AS close FROM VALUES ('2020-02-29'), ('2020-03-01'), ('2020-05-01'), ('2020-05-02'), ('2022-10-15') AS t(d)")
    got = [r.event for r in eda.event_labels(rows).orderBy("ts").collect()]
    assert got[0] is None and got[1] == got[2] is not None and got[3] is None and got[4] not in (None, got[1])
