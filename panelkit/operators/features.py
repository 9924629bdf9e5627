"""Returns, lags, rolling and calendar features.

All windows use the same ``(entity; idx)`` spec as the fill, so Spark adds no
exchange after the one in the resample stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelkit.config import PanelConfig
from panelkit.functions.scalar import safe_div, safe_ln


def add_returns(weekly: DataFrame) -> DataFrame:
    w = Window.partitionBy("entity").orderBy("idx")
    prev = F.lag("close", 1).over(w)
    ratio = safe_div(F.col("close"), prev)
    return weekly.select("*", safe_ln(ratio).alias("returns"), (ratio - 1).alias("returns_simple"))


def add_features(weekly: DataFrame, cfg: PanelConfig | None = None) -> DataFrame:
    """Returns + lags 1,2,4 + rolling mean/std/min/max (full windows only) + calendar."""
    cfg = cfg or PanelConfig()
    n = cfg.rolling_window
    w = Window.partitionBy("entity").orderBy("idx")
    prev = F.lag("close", 1).over(w)
    # the short rolling window spelled out in a fixed order (oldest first):
    # the same IEEE operations as any other engine evaluating this formula
    terms = [F.lag("close", k).over(w) for k in range(n - 1, 0, -1)] + [F.col("close")]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    mean = total / n
    ss = None
    for t in terms:
        sq = (t - mean) * (t - mean)
        ss = sq if ss is None else ss + sq
    roll_min = F.least(*terms)
    roll_max = F.greatest(*terms)
    full = F.lit(True)
    for t in terms:
        full = full & t.isNotNull()
    ratio = safe_div(F.col("close"), prev)
    ts = F.col("ts")
    return weekly.select(
        "*",
        safe_ln(ratio).alias("returns"),
        (ratio - 1).alias("returns_simple"),
        prev.alias("lag_1"),
        F.lag("close", 2).over(w).alias("lag_2"),
        F.lag("close", 4).over(w).alias("lag_4"),
        F.when(full, mean).alias(f"rolling_mean_{n}"),
        F.when(full, F.sqrt(ss / (n - 1))).alias(f"rolling_std_{n}"),
        F.when(full, roll_min).alias(f"rolling_min_{n}"),
        F.when(full, roll_max).alias(f"rolling_max_{n}"),
        F.month(ts).alias("month"), F.quarter(ts).alias("quarter"), F.year(ts).alias("year"),
        F.weekofyear(ts).alias("week_of_year"),
    )


def preprocess(raw: DataFrame, cfg: PanelConfig | None = None) -> DataFrame:
    """RAW -> FEATURES: resample, fill, returns, features."""
    from panelkit.operators.resample import resample_fill

    cfg = cfg or PanelConfig()
    return add_features(resample_fill(raw, cfg), cfg)
