import pytest
from pyspark.sql import functions as F

from panelkit.operators import eda
from panelkit.operators.sketches import RANK_ERROR, merged, quantile_sketches, sketch_quantile


def test_merged_sketches_keep_the_rank_error_under_skew_and_ties(spark):
    # half of the rows under one key, half of the values equal
    df = spark.range(200_000).select(F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 97).cast("string"))).alias("entity"),
                                     F.when(F.col("id") % 4 < 2, 5.0).otherwise(F.rand(3) * 10).alias("v"))
    sk = quantile_sketches(df, "v")
    assert merged(sk).first().n == 200_000
    for q in (0.01, 0.3, 0.5, 0.95, 0.99):
        x = sketch_quantile(sk, q).first()[0]
        r = df.agg(F.avg((F.col("v") < x).cast("int")), F.avg((F.col("v") <= x).cast("int"))).first()
        assert r[0] - RANK_ERROR <= q <= r[1] + RANK_ERROR


def test_sketches_of_nulls_non_finite_and_nothing(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("a", float("nan")), ("b", float("inf")), (None, 3.0)], "entity string, v double")
    sk = {r.entity: r.n for r in quantile_sketches(df, "v").collect()}
    assert sk == {"a": 1, None: 1}
    assert sketch_quantile(quantile_sketches(df, "v"), 1.0).first()[0] == 3.0
    assert sketch_quantile(quantile_sketches(df.limit(0), "v"), 0.5).first()[0] is None


def test_threshold_by_either_method(spark):
    vol = spark.range(1001).select(F.lit("a").alias("entity"), (F.col("id") / 1000).alias("volatility"))
    exact = eda.volatility_threshold(vol).first()[0]
    assert exact == pytest.approx(0.95)
    assert eda.volatility_threshold(vol, method="sketch").first()[0] == pytest.approx(exact, abs=RANK_ERROR)
    assert eda.volatility_threshold(vol.limit(0), method="sketch").first()[0] == 0.05
    with pytest.raises(ValueError):
        eda.volatility_threshold(vol, method="guess")
