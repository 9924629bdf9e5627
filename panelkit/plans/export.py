"""Sinks (K1-K12, S14, S15): long tables first, nesting only at the sink.

Writers use Spark's file sinks (Parquet / CSV / JSON) so the output is
produced by the executors in parallel; nothing is assembled on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.functions.scalar import finite_or_null
from panelkit.schema import DOCUMENT


def null_non_finite(df: DataFrame) -> DataFrame:
    """K8: NaN / +-inf -> NULL in every double column."""
    return df.select(*[finite_or_null(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.DoubleType)
                       else F.col(f.name) for f in df.schema.fields])


def series_arrays(panel: DataFrame, value: str = "close", name: str = "values", more: tuple[str, ...] = ()) -> DataFrame:
    """Per entity {dates[], values[]} ordered by date, ISO date text; the columns
    of ``more`` as further arrays under their own names.
    (A sink format: one array per entity, bounded by its calendar length.)"""
    g = panel.groupBy("entity").agg(F.array_sort(F.collect_list(F.struct("ts", value, *more))).alias("_s"))

    def values(c):
        return F.transform("_s", lambda x: finite_or_null(x[c]))

    return g.select("entity", F.transform("_s", lambda x: F.date_format(x["ts"], "yyyy-MM-dd")).alias("dates"),
                    values(value).alias(name), *[values(c).alias(c) for c in more])


def landing_drawdown(panel: DataFrame) -> DataFrame:
    """Drawdown of the landing page: peak starts at the first value; 0 when the peak is 0."""
    v = panel.where(F.col("close").isNotNull())
    w = Window.partitionBy("entity").orderBy("idx").rowsBetween(Window.unboundedPreceding, 0)
    peak = F.max("close").over(w)
    dd = F.when(peak == 0, F.lit(0.0)).otherwise((F.col("close") - peak) / peak * 100)
    return v.select("entity", "idx", "ts", "close", dd.alias("drawdown"))


def landing_subset(panel: DataFrame, best_worst: DataFrame) -> DataFrame:
    """The best and the worst entity's series with drawdown."""
    ids = best_worst.select(F.explode(F.array(F.struct(F.col("best_entity").alias("entity"), F.lit("best").alias("side")),
                                              F.struct(F.col("worst_entity").alias("entity"), F.lit("worst").alias("side"))))
                            .alias("x")).select("x.entity", "x.side")
    d = landing_drawdown(panel)
    # two ids at most: a proven size bound for the broadcast
    return d.join(F.broadcast(ids), "entity")


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: str | None = None) -> None:
    w = null_non_finite(df).write.mode(mode)
    if partition_by:
        # rows of one folder meet in few tasks, so it gets few files; a large folder is split by size
        w = null_non_finite(df).hint("rebalance", partition_by).write.mode(mode).partitionBy(partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    elif fmt == "json":
        w.json(path)
    else:
        w.parquet(path)


def read_document(spark: SparkSession, path: str, schema: T.StructType | str = DOCUMENT,
                  multi_line: bool = False) -> DataFrame:
    """Exported JSON documents, one per line as ``write_table`` writes them, or
    (``multi_line``) one per file over several lines. The schema is never inferred."""
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)
