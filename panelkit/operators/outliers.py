"""Residual outliers and anomaly scoring.

Outliers use the additive residual whatever model was detected (as the
single-machine pipeline does). Fences are per-entity exact quantiles computed
as window aggregates inside the panel's entity partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelkit.config import SEVERITY_LABELS
from panelkit.operators.decompose import decompose_components


def _fenced(weekly: DataFrame, period: int, multiplier: float) -> DataFrame:
    c = decompose_components(weekly, period)
    part = Window.partitionBy("entity")
    c = c.select("entity", "idx", "ts", "x", "n", F.col("resid_add").alias("resid"),
                 F.percentile("resid_add", F.lit(0.25)).over(part).alias("q1"),
                 F.percentile("resid_add", F.lit(0.75)).over(part).alias("q3"))
    iqr = F.col("q3") - F.col("q1")
    return c.select("*", (F.col("q1") - multiplier * iqr).alias("lower_bound"),
                    (F.col("q3") + multiplier * iqr).alias("upper_bound"))


def severity(resid, lower, upper):
    """Right-closed bins (-inf,3L] (3L,L] (L,U] (U,3U] (3U,inf); a CASE, so
    fences of any sign label without error."""
    ex_lo, lo, norm, hi, ex_hi = SEVERITY_LABELS
    return (F.when(resid <= lower * 3, F.lit(ex_lo)).when(resid <= lower, F.lit(lo))
            .when(resid <= upper, F.lit(norm)).when(resid <= upper * 3, F.lit(hi))
            .otherwise(F.lit(ex_hi)))


def detect_outliers(weekly: DataFrame, period: int, multiplier: float = 1.5) -> DataFrame:
    """O1/O2: OUTLIER rows (entity, date, value, residual, bounds, severity)."""
    f = _fenced(weekly, period, multiplier)
    flagged = f.where((F.col("resid") < F.col("lower_bound")) | (F.col("resid") > F.col("upper_bound")))
    return flagged.select("entity", F.col("ts").alias("date"), F.col("x").alias("value"),
                          F.col("resid").alias("residual"), "lower_bound", "upper_bound",
                          severity(F.col("resid"), F.col("lower_bound"), F.col("upper_bound")).alias("severity"))


def residual_stats(weekly: DataFrame, period: int, multiplier: float = 1.5) -> DataFrame:
    """RSTATS per entity with >= 2P points (short entities drop out)."""
    c = decompose_components(weekly, period)
    return c.groupBy("entity").agg(
        F.avg("resid_add").alias("mean"), F.stddev_samp("resid_add").alias("std"),
        F.percentile("resid_add", F.lit(0.25)).alias("q1"), F.percentile("resid_add", F.lit(0.75)).alias("q3")
    ).select("entity", "mean", "std", "q1", "q3", (F.col("q3") - F.col("q1")).alias("iqr"),
             ((F.col("q3") - F.col("q1")) * multiplier).alias("threshold"))


def residual_model(weekly: DataFrame, period: int, multiplier: float = 1.5) -> DataFrame:
    """RSTATS plus what a residual-mode check needs to place a new value:
    first bin index, the back-edge trend line (kb * pos + bb) and the P
    additive seasonal phase values (array ordered by phase, P entries)."""
    c = decompose_components(weekly, period)
    P = int(period)
    first = F.min("idx").over(Window.partitionBy("entity"))
    c = c.select("*", first.alias("first_idx"), (F.col("pos") % P).alias("phase"))
    phases = (c.groupBy("entity", "phase").agg(F.first("seasonal_add").alias("s"))
              .groupBy("entity").agg(F.array_sort(F.collect_list(F.struct("phase", "s"))).alias("_ps")))
    st = c.groupBy("entity").agg(
        F.avg("resid_add").alias("mean"), F.stddev_samp("resid_add").alias("std"),
        F.percentile("resid_add", F.lit(0.25)).alias("q1"), F.percentile("resid_add", F.lit(0.75)).alias("q3"),
        F.first("first_idx").alias("first_idx"), F.first("kb").alias("kb"), F.first("bb").alias("bb"))
    st = st.select("entity", "mean", "std", "q1", "q3", (F.col("q3") - F.col("q1")).alias("iqr"),
                   ((F.col("q3") - F.col("q1")) * multiplier).alias("threshold"), "first_idx", "kb", "bb")
    return st.join(phases, "entity").select("*", F.transform("_ps", lambda x: x["s"]).alias("seasonal")).drop("_ps")


def outlier_summary(weekly: DataFrame, period: int, multiplier: float = 1.5) -> DataFrame:
    """Outlier count and share of non-null points per entity; entities
    without outliers are kept (0, 0.0); too-short entities get (0, NULL).
    One pass: short entities ride along with NULL fences."""
    c = decompose_components(weekly, period, keep_short=True)
    part = Window.partitionBy("entity")
    c = c.select("entity", "n", F.col("resid_add").alias("resid"),
                 F.percentile("resid_add", F.lit(0.25)).over(part).alias("q1"),
                 F.percentile("resid_add", F.lit(0.75)).over(part).alias("q3"))
    iqr = F.col("q3") - F.col("q1")
    lo = F.col("q1") - multiplier * iqr
    hi = F.col("q3") + multiplier * iqr
    out = F.coalesce((F.col("resid") < lo) | (F.col("resid") > hi), F.lit(False))
    g = c.groupBy("entity", "n").agg(F.count_if(out).alias("count"))
    ok = F.col("n") >= 2 * int(period)
    return g.select("entity", "count", F.when(ok, F.col("count") / F.col("n") * 100).alias("pct_total"))


def severity_counts(outliers: DataFrame) -> DataFrame:
    """A16."""
    return outliers.groupBy("entity", "severity").agg(F.count("*").alias("count"))
