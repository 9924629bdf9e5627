"""Classical seasonal decomposition as window plans.

For each entity with at least 2P observations (nulls dropped):

* trend: centred moving average (2xP for even P; null unless the frame is
  full), with both edges extrapolated by the least-squares line through the
  P nearest defined trend points (the "freq" rule);
* seasonal: phase means of the detrended series, centred (additive: minus
  their mean; multiplicative: divided by it);
* resid: x - trend - seasonal, or x / seasonal / trend.

Both variants are computed in the same pass, so model detection (the
multiplicative model wins iff its residual variance < 0.8 x the additive
one, and every x > 0) costs no second scan. Every window is partitioned by
``entity`` (or by entity and phase, which the entity partitioning satisfies),
so the whole chain runs inside the panel's single shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelkit.functions.scalar import safe_div


def _series(weekly: DataFrame) -> DataFrame:
    w = Window.partitionBy("entity").orderBy("idx")
    s = weekly.where(F.col("close").isNotNull())
    return s.select("entity", "idx", "ts", F.col("close").alias("x"),
                    (F.row_number().over(w) - 1).cast("int").alias("pos"),
                    F.count("*").over(Window.partitionBy("entity")).alias("n"))


def decompose_components(weekly: DataFrame, period: int, keep_short: bool = False) -> DataFrame:
    """x, trend, additive and multiplicative seasonal/resid, the detected model
    and both residual variances for entities with n >= 2P. ``keep_short``
    keeps the shorter entities in the same pass (components NULL, model
    additive) instead of dropping them, so callers need no second scan."""
    P = int(period)
    h = P // 2
    part = Window.partitionBy("entity")
    w = Window.partitionBy("entity").orderBy("pos")
    s = _series(weekly)
    if not keep_short:
        s = s.where(F.col("n") >= 2 * P)
    frame = w.rowsBetween(-h, h)
    if P % 2 == 0:
        ma = (F.sum("x").over(frame) - 0.5 * F.lag("x", h).over(w) - 0.5 * F.lead("x", h).over(w)) / P
    else:
        ma = F.sum("x").over(frame) / P
    full = (F.col("pos") >= h) & (F.col("pos") <= F.col("n") - 1 - h)
    s = s.select("*", F.when(full, ma).alias("ma"), F.lit(h).alias("front"), (F.col("n") - 1 - h).alias("back"))
    fr = (F.col("pos") >= F.col("front")) & (F.col("pos") < F.least(F.col("front") + P, F.col("back")))
    br = (F.col("pos") >= F.greatest(F.col("front"), F.col("back") - P)) & (F.col("pos") < F.col("back"))
    posd = F.col("pos").cast("double")

    def line(rng):
        y, x = F.when(rng, F.col("ma")), F.when(rng, posd)
        k, b = F.regr_slope(y, x).over(part), F.regr_intercept(y, x).over(part)
        # a single point: the minimum-norm least-squares line through it
        one = F.count(y).over(part) == 1
        y0, x0 = F.max(y).over(part), F.max(x).over(part)
        return (F.when(one, y0 * x0 / (x0 * x0 + 1)).otherwise(k),
                F.when(one, y0 / (x0 * x0 + 1)).otherwise(b))

    kf, bf = line(fr)
    kb, bb = line(br)
    s = s.select("*", kf.alias("kf"), bf.alias("bf"), kb.alias("kb"), bb.alias("bb"))
    trend = (F.when(F.col("pos") < F.col("front"), F.col("kf") * F.col("pos") + F.col("bf"))
             .when(F.col("pos") > F.col("back"), F.col("kb") * F.col("pos") + F.col("bb"))
             .otherwise(F.col("ma")))
    s = s.select("entity", "idx", "ts", "x", "pos", "n", trend.alias("trend"), "kb", "bb")
    phase = Window.partitionBy("entity", F.col("pos") % P)
    s = s.select("*", F.avg(F.col("x") - F.col("trend")).over(phase).alias("pa_add"),
                 F.avg(safe_div(F.col("x"), F.col("trend"))).over(phase).alias("pa_mul"))
    s = s.select("*", F.avg(F.when(F.col("pos") < P, F.col("pa_add"))).over(part).alias("m_add"),
                 F.avg(F.when(F.col("pos") < P, F.col("pa_mul"))).over(part).alias("m_mul"))
    seas_add = F.col("pa_add") - F.col("m_add")
    seas_mul = safe_div(F.col("pa_mul"), F.col("m_mul"))
    s = s.select("entity", "idx", "ts", "x", "pos", "n", "trend", "kb", "bb",
                 seas_add.alias("seasonal_add"), ((F.col("x") - F.col("trend")) - seas_add).alias("resid_add"),
                 seas_mul.alias("seasonal_mul"),
                 safe_div(safe_div(F.col("x"), seas_mul), F.col("trend")).alias("resid_mul"))
    s = s.select("*", F.var_samp("resid_add").over(part).alias("var_add"),
                 F.var_samp("resid_mul").over(part).alias("var_mul"),
                 F.min("x").over(part).alias("min_x"))
    mul = (F.col("min_x") > 0) & (F.col("var_mul") < 0.8 * F.col("var_add"))
    s = s.withColumn("model", F.when(mul & (F.col("n") >= 2 * P), F.lit("multiplicative")).otherwise(F.lit("additive")))
    if keep_short:
        ok = F.col("n") >= 2 * P
        s = s.select("entity", "idx", "ts", "x", "pos", "n",
                     *[F.when(ok, F.col(c)).alias(c) for c in
                       ("trend", "kb", "bb", "seasonal_add", "resid_add", "seasonal_mul", "resid_mul",
                        "var_add", "var_mul")],
                     "min_x", "model")
    return s


def decompose(weekly: DataFrame, period: int, model: str = "auto") -> DataFrame:
    """DECOMP: entity, ts, pos, observed, trend, seasonal, resid, model, period.

    ``model``: auto | additive | multiplicative. Entities shorter than 2P keep
    their observed values with null components and model ``additive``.
    One pass over the panel (no union of long and short entities).
    """
    c = decompose_components(weekly, period, keep_short=True)
    if model in ("additive", "multiplicative"):
        c = c.withColumn("model", F.when(F.col("n") >= 2 * int(period), F.lit(model)).otherwise(F.lit("additive")))
    is_mul = F.col("model") == "multiplicative"
    return c.select("entity", "ts", "pos", F.col("x").alias("observed"), "trend",
                    F.when(is_mul, F.col("seasonal_mul")).otherwise(F.col("seasonal_add")).alias("seasonal"),
                    F.when(is_mul, F.col("resid_mul")).otherwise(F.col("resid_add")).alias("resid"),
                    "model", F.lit(int(period)).alias("period"))


def model_detection(weekly: DataFrame, period: int) -> DataFrame:
    """Per entity, the residual variances of both models and the choice
    (entities shorter than 2P: additive, variances null)."""
    c = decompose_components(weekly, period, keep_short=True)
    # the per-entity values are constant within the entity: grouping on them
    # keeps a hash aggregate (a string aggregate buffer would force a sort)
    return c.groupBy("entity", "n", "var_add", "var_mul", "model").agg(F.count("*").alias("_rows")).drop("_rows")
