"""Resample to a regular calendar and fill gaps.

Plan shape: one partial+final hash aggregate for the bins (map-side combine, so
a hot entity shrinks to one row per bin before the shuffle), then ONE shuffle
by ``entity`` that every later window of the panel reuses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelkit.config import PanelConfig
from panelkit.functions.scalar import label_from_index, period_index, period_label

UNB = Window.unboundedPreceding


def by_entity(order="idx"):
    return Window.partitionBy("entity").orderBy(order)


def last_key(ts: str, tb: str | None = None):
    """Fixed-width ordering key for "last row": (ts, tb) packed in one
    DECIMAL(38,0) (epoch micros * 1e20 + tb), so ``max_by`` stays in a hash
    aggregate with map-side partials instead of a sort-based aggregate. It holds for
    every timestamp and every 64-bit tb, negative ones too; a null tb comes first."""
    micros = F.unix_micros(F.col(ts))
    if tb is None:
        return micros
    wide = "decimal(38,0)"
    return (micros.cast(wide) * F.lit(str(10 ** 20)).cast(wide)
            + F.coalesce(F.col(tb).cast("long"), F.lit(-(1 << 63))).cast(wide)).cast(wide)


def resample_last(raw: DataFrame, freq: str = "W") -> DataFrame:
    """Bin label per row, keep the last non-null close per (entity, bin).

    "Last" is the greatest ``(ts, tb)`` among rows with a close; ``tb`` is a
    total tiebreak (row id) when several rows share a timestamp.
    Output: entity, idx (bin number), raw_close.
    """
    if "ts" not in raw.columns:
        raise ValueError("Date column 'ts' not found")
    order_key = last_key("ts", "tb" if "tb" in raw.columns else None)
    close = F.when(~F.isnan("close"), F.col("close"))  # NaN is missing, like NULL
    binned = raw.where(F.col("ts").isNotNull()).select(
        "entity", close.alias("close"),
        period_index(period_label("ts", freq), freq).alias("idx"),
        F.when(close.isNotNull(), order_key).alias("ok"))
    return (binned.groupBy("entity", "idx")
            .agg(F.max_by("close", "ok").alias("raw_close")))


def regular_spine(binned: DataFrame, freq: str = "W") -> DataFrame:
    """Insert the empty bins between each entity's first and last bin.

    No join and no second shuffle: every observed bin emits itself plus the
    empty bins up to the next observed bin (``lead``), inside the entity
    partition. Output: entity, idx, ts (bin label), raw_close, pos.
    """
    w = by_entity("idx")
    nxt = F.lead("idx").over(w)
    first = F.min("idx").over(Window.partitionBy("entity"))
    marked = binned.select("entity", "raw_close", F.col("idx").alias("obs_idx"),
                           first.alias("first_idx"), nxt.alias("next_idx"))
    spread = marked.select(
        "entity", "raw_close", "obs_idx", "first_idx",
        F.explode(F.sequence(F.col("obs_idx"), F.coalesce(F.col("next_idx") - 1, F.col("obs_idx")))).alias("idx"))
    return spread.select(
        "entity", "idx",
        label_from_index(F.col("idx"), freq).alias("ts"),
        F.when(F.col("idx") == F.col("obs_idx"), F.col("raw_close")).alias("raw_close"),
        (F.col("idx") - F.col("first_idx")).cast("int").alias("pos"))


def fill_gaps(spine: DataFrame, limit: int = 2) -> DataFrame:
    """Forward-fill at most ``limit`` periods, then linear interpolation by
    position between the filled anchors, then edges take the nearest value.

    Closed form with running windows only (forward and backward), O(n) per
    entity: pk/pv = last observed position/value at or before the row,
    nk/nv = first observed position/value at or after it. An all-null entity
    stays null.
    """
    fwd = by_entity("idx").rowsBetween(UNB, 0)
    bwd = Window.partitionBy("entity").orderBy(F.col("idx").desc()).rowsBetween(UNB, 0)
    seen = F.when(F.col("raw_close").isNotNull(), F.col("pos"))
    s = spine.select(
        "*",
        F.max(seen).over(fwd).alias("pk"), F.last("raw_close", True).over(fwd).alias("pv"),
        F.min(seen).over(bwd).alias("nk"), F.last("raw_close", True).over(bwd).alias("nv"))
    a = F.col("pk") + F.lit(limit)
    interp = F.col("pv") + (F.col("nv") - F.col("pv")) * (F.col("pos") - a) / (F.col("nk") - a)
    close = (F.when(F.col("raw_close").isNotNull(), F.col("raw_close"))
             .when(F.col("pk").isNotNull() & (F.col("pos") - F.col("pk") <= limit), F.col("pv"))
             .when(F.col("pk").isNull(), F.col("nv"))
             .when(F.col("nk").isNull(), F.col("pv"))
             .otherwise(interp))
    return s.select("entity", "idx", "ts", "raw_close", close.alias("close"), "pos",
                    close.isNull().alias("has_gap"))


def resample_fill(raw: DataFrame, cfg: PanelConfig | None = None, resample: bool = True) -> DataFrame:
    """RAW -> WEEKLY (entity, idx, ts, raw_close, close, pos, has_gap).

    ``resample=False`` treats the rows as already regular (one row per bin).
    """
    cfg = cfg or PanelConfig()
    if resample:
        binned = resample_last(raw, cfg.freq)
    else:
        binned = raw.select("entity", period_index(period_label("ts", cfg.freq), cfg.freq).alias("idx"),
                            F.col("close").alias("raw_close"))
    return fill_gaps(regular_spine(binned, cfg.freq), cfg.ffill_limit)


def gap_stats(weekly: DataFrame) -> DataFrame:
    """Per entity: periods, gaps before filling, share, all-null flag, gaps left."""
    return weekly.groupBy("entity").agg(
        F.count("*").alias("n_periods"),
        F.count_if(F.col("raw_close").isNull()).alias("n_gaps"),
        (F.count_if(F.col("raw_close").isNull()) / F.count("*")).alias("gap_share"),
        (F.count("raw_close") == 0).alias("all_null"),
        F.count_if(F.col("has_gap")).alias("gaps_left"))


def train_test_split(series: DataFrame, test_size: float = 0.2, value: str = "close") -> DataFrame:
    """Positional split: first int(n*(1-test_size)) non-null rows train, rest test."""
    w = Window.partitionBy("entity").orderBy("ts")
    s = series.where(F.col(value).isNotNull())
    s = s.withColumn("i", F.row_number().over(w) - 1).withColumn("n", F.count("*").over(Window.partitionBy("entity")))
    split = F.floor(F.col("n") * F.lit(1 - test_size)).cast("int")
    return s.withColumn("split", F.when(F.col("i") < split, F.lit("train")).otherwise(F.lit("test")))
