"""Panels derived from the star-schema test tables.

Each returns RAW ``(entity, ts, close)`` plus ``tb``, a total tiebreak for
"last value in the period" when several rows share one timestamp.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def nation_panel(spark: SparkSession, sf_dir: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Order value by customer nation: orders -> customer -> nation.
    ``start``/``end`` (inclusive) filter the order date inside the scan."""
    from panelkit.sources.files import native_range

    o = native_range(read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"),
                     "o_orderdate", start, end)
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    # nation (25 rows) and customer (one row per customer) are dimension tables:
    # AQE turns these into broadcast joins when their measured size allows.
    return (o.join(c, o.o_custkey == c.c_custkey)
             .join(n, c.c_nationkey == n.n_nationkey)
             .select(F.col("n_name").alias("entity"),
                     F.col("o_orderdate").cast("timestamp").alias("ts"),
                     F.col("o_totalprice").cast("double").alias("close"),
                     F.col("o_orderkey").alias("tb")))


def recent_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nation panel 25 years later; names of odd length carry the suffix ``.SA``."""
    name = F.when(F.length("entity") % 2 == 1, F.concat("entity", F.lit(".SA"))).otherwise(F.col("entity"))
    return nation_panel(spark, sf_dir).select(name.alias("entity"), (F.col("ts") + F.expr("INTERVAL 25 YEARS")).alias("ts"),
                                              "close", "tb")


def priority_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderpriority").alias("entity"),
                    F.col("o_orderdate").cast("timestamp").alias("ts"),
                    F.col("o_totalprice").cast("double").alias("close"),
                    F.col("o_orderkey").alias("tb"))


def event_panel(spark: SparkSession, sf_dir: str, variant: str = "plain") -> DataFrame:
    """Event values by type. ``reflected`` = 1000 - value, ``small`` = value / 10000."""
    e = read_table(spark, sf_dir, "events")
    v = F.col("value").cast("double")
    if variant == "reflected":
        v = F.lit(1000.0) - v
    elif variant == "small":
        v = v / F.lit(10000.0)
    elif variant != "plain":
        raise ValueError(variant)
    return e.select(F.col("event_type").alias("entity"),
                    F.col("ts").cast("timestamp").alias("ts"),
                    v.alias("close"),
                    F.col("event_id").alias("tb"))


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations to score: every event (known entities) and every order
    keyed by its priority (entities without stored statistics)."""
    e = read_table(spark, sf_dir, "events").select(
        F.col("event_type").alias("entity_id"), F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("value").cast("double").alias("value"), F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("obs_id"))
    o = read_table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("entity_id"), F.col("o_orderdate").cast("timestamp").alias("timestamp"),
        F.col("o_totalprice").cast("double").alias("value"), F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("obs_id"))
    return e.unionByName(o)
