"""Cross-entity ordering without funnelling rows through one task.

``global_rank`` gives exact 1-based ranks under a total order: a range
partitioned sort (sampled boundaries, as ``orderBy`` does), a local row number
per partition, and per-partition offsets computed from the partition counts
(one row per partition, broadcast: its size is the partition count). No
un-partitioned window over data rows anywhere.

The rows and the counts must see the same boundaries. Two range exchanges sample
anew and may differ, so the rows are checkpointed with their partition number
once, and both read that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit.session import checkpoint_dir


def global_rank(df: DataFrame, order: list[Column], name: str = "rank",
                num_partitions: int | None = None, total: str | None = None) -> DataFrame:
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    checkpoint_dir(spark)
    part = df.repartitionByRange(n, *order).withColumn("_pid", F.spark_partition_id()).checkpoint(eager=True)
    local = part.withColumn("_lr", F.row_number().over(Window.partitionBy("_pid").orderBy(*order)))
    counts = local.groupBy("_pid").agg(F.max("_lr").alias("_cnt"))
    by_pid = Window.orderBy("_pid")
    offsets = counts.select(
        "_pid",
        F.sum("_cnt").over(by_pid.rowsBetween(Window.unboundedPreceding, -1)).alias("_off"),
        F.sum("_cnt").over(by_pid.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_tot"))
    out = (local.join(F.broadcast(offsets), "_pid")
           .withColumn(name, (F.coalesce(F.col("_off"), F.lit(0)) + F.col("_lr")).cast("long")))
    if total:
        out = out.withColumn(total, F.col("_tot").cast("long"))
    return out.drop("_pid", "_lr", "_off", "_cnt", "_tot")


def exact_quantile(df: DataFrame, col: str, q: float, name: str = "quantile") -> DataFrame:
    """Exact linear-interpolated quantile of one column over the whole table,
    found by a distributed sort (no single-task value buffer). One row out;
    NULL when the column has no values."""
    # a seeded random secondary key salts repeated values across range
    # partitions (a value held by a third of the rows would otherwise land in
    # one task); the quantile does not depend on the order among equal values
    vals = df.where(F.col(col).isNotNull()).select(F.col(col).alias("v"), F.rand(42).alias("_salt"))
    ranked = global_rank(vals, [F.col("v"), F.col("_salt")], "r", total="n")
    h = F.lit(q) * (F.col("n") - 1)
    lo = F.floor(h).cast("long") + 1
    hi = F.ceil(h).cast("long") + 1
    sel = ranked.where((F.col("r") == lo) | (F.col("r") == hi)).agg(
        F.max(F.when(F.col("r") == lo, F.col("v"))).alias("vlo"),
        F.max(F.when(F.col("r") == hi, F.col("v"))).alias("vhi"),
        F.max(h - F.floor(h)).alias("frac"))
    return sel.select((F.col("vlo") + (F.col("vhi") - F.col("vlo")) * F.col("frac")).alias(name))
