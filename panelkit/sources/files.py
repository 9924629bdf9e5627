"""Sources: CSV / Parquet / JDBC scans that produce the RAW panel.

Everything stays lazy: column pruning and the date/entity predicates are plain
DataFrame operations, so Catalyst pushes them into the Parquet scan (or into
the JDBC query) on its own.
"""

from __future__ import annotations

import os
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.config import PanelConfig
from panelkit.schema import STATS

_IDENT = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*)?$")


def _ident(name: str) -> str:
    if not _IDENT.match(name):
        raise ValueError(f"invalid identifier {name!r}")
    return name


def check_columns(df: DataFrame, required) -> DataFrame:
    there = set(df.columns)
    absent = sorted({c for c in required} - there)
    if absent:
        raise ValueError(f"the source lacks {', '.join(absent)}; it has {', '.join(df.columns)}")
    return df


def to_number(c: Column) -> Column:
    """Numeric coercion: bad text -> NULL, NaN -> NULL."""
    d = c.cast(T.StringType()).try_cast(T.DoubleType())
    return F.when(F.isnan(d), F.lit(None).cast("double")).otherwise(d)


def to_ts(c: Column) -> Column:
    """Date parse; strings that do not parse become NULL."""
    return F.coalesce(c.cast(T.StringType()).try_cast(T.TimestampType()),
                      F.try_to_timestamp(c.cast(T.StringType())))


def native_range(df: DataFrame, col: str, start: str | None, end: str | None) -> DataFrame:
    """Inclusive range filter written against the column in its own type, so
    the predicate reaches the Parquet / JDBC scan (a filter on a converted
    column would stay above the scan)."""
    dt = df.schema[col].dataType
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        if start:
            df = df.where(F.col(col) >= F.lit(start).cast(dt))
        if end:
            df = df.where(F.col(col) <= F.lit(end).cast(dt))
    return df


def in_range(raw: DataFrame, start: str | None, end: str | None) -> DataFrame:
    """The inclusive range again on the parsed ``ts``: dates kept as text can't be
    compared in the source; for native types the filter above has done the work."""
    if start:
        raw = raw.where(F.col("ts") >= F.lit(start).cast("timestamp"))
    if end:
        raw = raw.where(F.col("ts") <= F.lit(end).cast("timestamp"))
    return raw


def _ts_of(df: DataFrame, col: str):
    dt = df.schema[col].dataType
    if isinstance(dt, T.TimestampType):
        return F.col(col)
    if isinstance(dt, (T.TimestampNTZType, T.DateType)):
        return F.col(col).cast("timestamp")
    return to_ts(F.col(col))


def _raw(df: DataFrame, entity_col: str, date_col: str, value_col: str, extra: dict | None = None) -> DataFrame:
    extra = extra or {}
    check_columns(df, [entity_col, date_col, value_col, *extra])
    if isinstance(df.schema[value_col].dataType, T.DoubleType):
        close = F.when(~F.isnan(F.col(value_col)), F.col(value_col))  # NaN -> NULL, no text round trip
    else:
        close = to_number(F.col(value_col))
    return df.select(
        F.col(entity_col).cast("string").alias("entity"),
        _ts_of(df, date_col).alias("ts"),
        close.alias("close"),
        *[F.col(c).cast("string").try_cast(t).alias(c) for c, t in extra.items()],
    )


def load_file(spark: SparkSession, path: str, entity_col: str = "entity",
              date_col: str = "Date", value_col: str = "Close", extra: dict | None = None,
              start: str | None = None, end: str | None = None) -> DataFrame:
    """CSV or Parquet file (or directory) -> RAW."""
    if not os.path.exists(path) and "://" not in path:
        raise FileNotFoundError(f"no panel file at {path}")
    suffix = os.path.splitext(path.rstrip("/"))[1].lower()
    if suffix == ".csv":
        # every column read as text, then coerced: no inference pass over the data
        df = spark.read.option("header", True).option("inferSchema", False).csv(path)
    elif suffix == ".parquet":
        df = spark.read.parquet(path)
    else:
        raise ValueError(f"{suffix or path!r}: a panel file is .csv or .parquet")
    return in_range(_raw(native_range(df, date_col, start, end), entity_col, date_col, value_col, extra), start, end)


def load_jdbc(spark: SparkSession, url: str, table: str, start: str, end: str,
              entity_col: str = "entity", date_col: str = "Date", value_col: str = "Close",
              properties: dict | None = None, num_partitions: int | None = None,
              lower: str | None = None, upper: str | None = None) -> DataFrame:
    """SQL table -> RAW with an inclusive date range.

    Identifiers are validated; the select list and the BETWEEN predicate are
    pushed into the database by the JDBC source. ``num_partitions`` with
    ``lower``/``upper`` splits the read on the date column across executors.
    """
    props = dict(properties or {})
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", _ident(table))
    for k, v in props.items():
        reader = reader.option(k, v)
    if num_partitions:
        reader = (reader.option("partitionColumn", _ident(date_col))
                  .option("lowerBound", lower or start).option("upperBound", upper or end)
                  .option("numPartitions", num_partitions))
    df = reader.load().select(_ident(entity_col), _ident(date_col), _ident(value_col))
    return in_range(_raw(native_range(df, date_col, start, end), entity_col, date_col, value_col), start, end)


def load_panel(spark: SparkSession, kind: str, cfg: PanelConfig | None = None, **kw) -> DataFrame:
    """Source dispatch by kind: file | jdbc | table (DataFrame passed in)."""
    cfg = cfg or PanelConfig()
    if kind == "file":
        kw.setdefault("start", cfg.start_date)
        kw.setdefault("end", cfg.end_date)
        raw = load_file(spark, **kw)
    elif kind == "jdbc":
        raw = load_jdbc(spark, **kw)
    elif kind == "table":
        raw = _raw(kw["df"], kw.get("entity_col", "entity"), kw.get("date_col", "ts"),
                   kw.get("value_col", "close"))
    else:
        raise ValueError(f"kind is file, jdbc or table, not {kind!r}")
    return filter_panel(raw, cfg)


def filter_panel(raw: DataFrame, cfg: PanelConfig) -> DataFrame:
    """Date-range (inclusive) and entity-list filters; both reach the scan."""
    raw = in_range(raw, cfg.start_date, cfg.end_date)
    if cfg.entities:
        raw = raw.where(F.col("entity").isin(list(cfg.entities)))
    return raw


def with_cache_fallback(fresh: DataFrame, cache: DataFrame, need_rows: bool = False) -> DataFrame:
    """Per entity: fresh rows if the entity has any, else its cached rows.
    ``need_rows``: neither source having a row is an error (stops at the first row found)."""
    have = fresh.select("entity").distinct()
    rows = fresh.unionByName(cache.join(have, "entity", "left_anti"))
    if need_rows and fresh.isEmpty() and cache.isEmpty():
        raise ValueError("no rows from any source: neither fresh nor cached")
    return rows


def load_stats(spark: SparkSession, path: str) -> DataFrame:
    """Saved residual statistics (CSV with header or Parquet)."""
    if path.rstrip("/").endswith(".csv"):
        return spark.read.schema(STATS).option("header", True).csv(path)
    return spark.read.schema(STATS).parquet(path)
