"""Connected components of a link table by alternating stars.

*Large star*: every node hands its larger neighbours to the least of its
neighbourhood; *small star*: every node hands its smaller neighbours, and itself,
to the least of them. Both are a grouped minimum (partially aggregated before the
shuffle) joined back to the links, so a node with a third of all links is split
like any skewed join. Links turn into stars in a few rounds; each round is
written to the shared folder, and only a count and a checksum reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import materialize


def _least(e: DataFrame) -> DataFrame:
    return e.groupBy("u").agg(F.min("v").alias("m"))


def _large(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (both.join(_least(both), "u").where("v > u")
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).where("u <> v"))


def _small(e: DataFrame) -> DataFrame:
    out = e.join(_least(e), "u")
    return out.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x")).select("x.*").where("u <> v")


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` for every node with a link; root is the least node of its
    component. Loops, repeated links and either direction are fine; nulls are dropped."""
    e = (links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
         .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct())
    e = materialize(e, "links")
    last = None
    while True:
        e = materialize(_small(_large(e).distinct()).distinct(), "links")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == last:
            break
        last = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
