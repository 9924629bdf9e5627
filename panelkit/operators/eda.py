"""Exploratory statistics over the filled panel.

Inputs are FEATURES-like frames: entity, idx, ts, close, returns.
Every per-entity computation is a window over ``entity`` or a groupBy on it
(the panel is already hash-partitioned by entity, so no new shuffle); the
cross-entity orderings run on one row per entity through a range-partitioned
sort (``global_rank``) or a distributed top-k (``orderBy().limit()``).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelkit.config import EVENT_WINDOWS
from panelkit.functions.scalar import norm_ppf, round_half_up, safe_div
from panelkit.operators.ranking import exact_quantile, global_rank
from panelkit.operators.sketches import quantile_sketches, sketch_quantile

UNB = Window.unboundedPreceding


def _valid(df: DataFrame, col: str = "close") -> DataFrame:
    return df.where(F.col(col).isNotNull())


# --------------------------------------------------------------- returns/KPIs
def total_returns(panel: DataFrame) -> DataFrame:
    """A1: last/first - 1 over non-null closes, entities with > 1 observation."""
    v = _valid(panel)
    return (v.groupBy("entity")
            .agg(F.min_by("close", "ts").alias("first_close"), F.max_by("close", "ts").alias("last_close"),
                 F.count("*").alias("n_obs"))
            .where(F.col("n_obs") > 1)
            .select("entity", "first_close", "last_close", "n_obs",
                    (safe_div("last_close", "first_close") - 1).alias("total_return")))


def return_ranking(panel: DataFrame) -> DataFrame:
    """Entities ranked by total return (desc, entity name breaks ties)."""
    r = total_returns(panel)
    r = global_rank(r, [F.col("total_return").desc(), F.col("entity")], "rank")
    return r.select("entity", "total_return", round_half_up(F.col("total_return") * 100, 1).alias("return_pct_1dp"), "rank")


def best_worst(panel: DataFrame) -> DataFrame:
    """A3: one row with the best and the worst entity (entity name breaks ties)."""
    r = total_returns(panel)
    key = F.struct("total_return", "entity")
    return r.agg(
        F.max_by("entity", key).alias("best_entity"), F.max("total_return").alias("best_return"),
        F.min_by("entity", key).alias("worst_entity"), F.min("total_return").alias("worst_return"),
        F.count("*").alias("n_entities"))


def kpis(panel: DataFrame) -> DataFrame:
    """A2: total_return_pct, peak_value, peak_date (first maximum), current_close."""
    v = _valid(panel)
    peak = F.max("close").over(Window.partitionBy("entity"))
    v = v.select("entity", "ts", "close", peak.alias("_peak"))
    return (v.groupBy("entity").agg(
        ((safe_div(F.max_by("close", "ts"), F.min_by("close", "ts")) - 1) * 100).alias("total_return_pct"),
        F.max("close").alias("peak_value"),
        F.min(F.when(F.col("close") == F.col("_peak"), F.col("ts"))).alias("peak_date"),
        F.max_by("close", "ts").alias("current_close")))


def kpi_report(panel: DataFrame) -> DataFrame:
    """A2 + W8 + return moments in ONE aggregate over one window pass:
    the panel is partitioned by entity once and every metric reads it there."""
    v = _valid(panel)
    part = Window.partitionBy("entity")
    run = Window.partitionBy("entity").orderBy("idx").rowsBetween(UNB, 0)
    peak_run = F.max("close").over(run)
    d = v.select("entity", "ts", "close", "returns", F.max("close").over(part).alias("_peak"),
                 (safe_div(F.col("close") - peak_run, peak_run) * 100).alias("_dd"))
    d = d.withColumn("_mdd", F.min("_dd").over(part))
    return d.groupBy("entity").agg(
        ((safe_div(F.max_by("close", "ts"), F.min_by("close", "ts")) - 1) * 100).alias("total_return_pct"),
        F.max("close").alias("peak_value"),
        F.min(F.when(F.col("close") == F.col("_peak"), F.col("ts"))).alias("peak_date"),
        F.max_by("close", "ts").alias("current_close"),
        F.count("*").alias("n_periods"),
        F.min("_dd").alias("max_drawdown_pct"),
        F.min(F.when(F.col("_dd") == F.col("_mdd"), F.col("ts"))).alias("max_drawdown_date"),
        F.stddev_samp("returns").alias("return_vol"),
        F.avg("returns").alias("mean_return"))


def top_entities(panel: DataFrame, k: int, ascending: bool = False) -> DataFrame:
    """The k best (or worst) entities by total return; distributed top-k."""
    r = total_returns(panel)
    o = F.col("total_return").asc() if ascending else F.col("total_return").desc()
    return r.orderBy(o, F.col("entity")).limit(k).select("entity", "total_return")


def top_bottom(panel: DataFrame, k: int = 3) -> DataFrame:
    """Top k and bottom k entities (may overlap below 2k entities)."""
    top = top_entities(panel, k).select("entity", F.lit(True).alias("in_top"))
    bot = top_entities(panel, k, ascending=True).select("entity", F.lit(True).alias("in_bottom"))
    return (top.join(bot, "entity", "full")
            .select("entity", F.coalesce("in_top", F.lit(False)).alias("in_top"),
                    F.coalesce("in_bottom", F.lit(False)).alias("in_bottom")))


def restrict(panel: DataFrame, chosen: DataFrame) -> DataFrame:
    """Keep the panel rows of a small chosen entity set (size bounded by k)."""
    return panel.join(F.broadcast(chosen.select("entity")), "entity", "left_semi")


# --------------------------------------------------------------- calendar tables
def calendar_means(panel: DataFrame, col: str = "close", scale: float = 1.0, name: str = "mean_close") -> DataFrame:
    """A4/A5: mean of ``col`` per entity, year, month (A5: returns x 100).

    The sum runs over an idx-ordered window frame, so the floating-point
    result does not depend on the physical row order (reproducible across
    partitionings); the (entity, year, month) windows sit inside the entity
    partitioning, so no shuffle is added."""
    v = panel.where(F.col(col).isNotNull()).select(
        "entity", "idx", F.col(col).alias("_v"), F.year("ts").alias("year"), F.month("ts").alias("month"))
    w = Window.partitionBy("entity", "year", "month").orderBy("idx")
    full = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    m = v.select("entity", "year", "month", "idx",
                 (F.sum("_v").over(full) / F.count("_v").over(full) * F.lit(scale)).alias(name),
                 F.row_number().over(w).alias("_rn"))
    return m.where(F.col("_rn") == 1).select("entity", "year", "month", name)


def seasonal_box(panel: DataFrame, by: str = "month") -> DataFrame:
    """Five-number summary of closes per entity and month (or quarter)."""
    grp = F.month("ts") if by == "month" else F.quarter("ts")
    q = F.percentile("close", F.array(*[F.lit(x) for x in (0.0, 0.25, 0.5, 0.75, 1.0)]))
    s = _valid(panel).groupBy("entity", grp.alias(by)).agg(q.alias("q"), F.count("*").alias("n"))
    return s.select("entity", by, "n", *[F.col("q")[i].alias(nm) for i, nm in
                                         enumerate(["min", "q1", "median", "q3", "max"])])


# --------------------------------------------------------------- bands/vol/drawdown
def sigma_band(panel: DataFrame, col: str = "returns", k: float = 2.0) -> DataFrame:
    """Mean +- k sample std per entity, joined back as a window; outside flag."""
    part = Window.partitionBy("entity")
    v = _valid(panel, col)
    m = F.avg(col).over(part)
    s = F.stddev_samp(col).over(part)
    out = v.select("entity", "ts", F.col(col).alias("value"), m.alias("mean"), s.alias("std"))
    out = out.select("*", (F.col("mean") + k * F.col("std")).alias("upper"),
                     (F.col("mean") - k * F.col("std")).alias("lower"))
    return out.withColumn("outside", (F.col("value") > F.col("upper")) | (F.col("value") < F.col("lower")))


def rolling_volatility(panel: DataFrame, window: int = 12) -> DataFrame:
    """Rolling sample std of the non-null returns, full windows only."""
    v = _valid(panel, "returns")
    w = Window.partitionBy("entity").orderBy("idx").rowsBetween(-(window - 1), 0)
    vol = F.when(F.count("returns").over(w) == window, F.stddev_samp("returns").over(w))
    n = F.count("*").over(Window.partitionBy("entity"))
    return (v.select("entity", "ts", vol.alias("volatility"), n.alias("_n"))
            .where(F.col("_n") >= window).drop("_n"))


def volatility_threshold(vol: DataFrame, q: float = 0.95, default: float = 0.05, method: str = "exact") -> DataFrame:
    """Pooled q-quantile of all volatilities, ``default`` when there are none.
    ``method``: "exact" (a distributed sort) or "sketch" (mergeable, rank error about 0.4 %)."""
    if method not in ("exact", "sketch"):
        raise ValueError(f"method must be 'exact' or 'sketch', got {method!r}")
    if method == "sketch":
        t = sketch_quantile(quantile_sketches(vol, "volatility"), q, "threshold")
    else:
        t = exact_quantile(vol, "volatility", q, "threshold")
    return t.select(F.coalesce("threshold", F.lit(default)).alias("threshold"))


def drawdown(panel: DataFrame, zero_peak_as_zero: bool = False) -> DataFrame:
    """Running maximum, drawdown %, severe flag (< -20 %)."""
    v = _valid(panel)
    w = Window.partitionBy("entity").orderBy("idx").rowsBetween(UNB, 0)
    peak = F.max("close").over(w)
    dd = safe_div(F.col("close") - peak, peak) * 100
    if zero_peak_as_zero:
        dd = F.when(peak == 0, F.lit(0.0)).otherwise(dd)
    out = v.select("entity", "idx", "ts", "close", peak.alias("running_max"), dd.alias("drawdown_pct"))
    return out.withColumn("severe", F.col("drawdown_pct") < -20)


def max_drawdown(panel: DataFrame) -> DataFrame:
    """Deepest drawdown and its first date."""
    d = drawdown(panel)
    d = d.withColumn("_mdd", F.min("drawdown_pct").over(Window.partitionBy("entity")))
    return d.groupBy("entity").agg(
        F.min("drawdown_pct").alias("max_drawdown_pct"),
        F.min(F.when(F.col("drawdown_pct") == F.col("_mdd"), F.col("ts"))).alias("max_drawdown_date"))


def rebased(panel: DataFrame) -> DataFrame:
    """Close / first non-null close x 100."""
    v = _valid(panel)
    first = F.first("close", True).over(Window.partitionBy("entity").orderBy("idx").rowsBetween(UNB, 0))
    return v.select("entity", "ts", (safe_div(F.col("close"), first) * 100).alias("rebased"))


def top_bottom_rebased(panel: DataFrame, k: int = 3) -> DataFrame:
    """Rebased series of the top k and bottom k entities."""
    tb = top_bottom(panel, k)
    return rebased(panel).join(F.broadcast(tb), "entity")


def event_labels(panel: DataFrame, events=EVENT_WINDOWS) -> DataFrame:
    """Label each date with the event window holding it (inclusive).

    The windows are a short fixed list, so the range join is a CASE expression
    evaluated in the scan stage (no join at all)."""
    d = F.to_date("ts")
    lab = F.lit(None).cast("string")
    for start, end, label in reversed(events):
        lab = F.when(d.between(F.lit(start).cast("date"), F.lit(end).cast("date")), F.lit(label)).otherwise(lab)
    return panel.select("entity", "ts", "close", lab.alias("event"))


def series_with_labels(panel: DataFrame) -> DataFrame:
    """The series, best/worst tags and event labels. Ties as in ``best_worst``:
    of equal returns the last name is best and the first is worst."""
    lab = event_labels(_valid(panel))
    bw = best_worst(panel)
    # at most two rows
    roles = bw.select(F.explode(F.array(F.struct(F.col("best_entity").alias("entity"), F.lit("best").alias("role")),
                                        F.struct(F.col("worst_entity").alias("entity"), F.lit("worst").alias("role")))).alias("x")).select("x.*")
    # a single entity is best and worst: best
    roles = roles.groupBy("entity").agg(F.min("role").alias("role"))
    return lab.join(F.broadcast(roles), "entity", "left")


# --------------------------------------------------------------- correlation
def correlation_matrix(panel: DataFrame, block: int = 256) -> DataFrame:
    """Pearson correlation on complete cases, long form (e1, e2, corr, n_dates).

    One path at every size: on the dates that every entity has, each series is
    centred and scaled to unit norm; the correlations are the products of those
    vectors. Entities are dealt into blocks, every two blocks meet in one task
    (a matrix product), and the E x E result stays on the executors. NULL where
    a series is constant, for one date, and without a common date.
    """
    import numpy as np
    import pandas as pd

    v = _valid(panel).select("entity", "ts", "close")
    n_ent = v.select("entity").distinct().count()
    dates = v.groupBy("ts").agg(F.count("*").alias("k")).where(F.col("k") == n_ent).select("ts")
    n_dates = dates.count()
    # a block holds a bounded number of values whatever the calendar's length
    block = max(1, min(block, (1 << 22) // max(n_dates, 1)))
    n_blocks = max(1, -(-n_ent // block))
    c = v.join(dates, "ts", "left_semi")
    part = Window.partitionBy("entity")
    constant = F.min("close").over(part) == F.max("close").over(part)
    c = c.select("entity", "ts", F.when(~constant, F.col("close") - F.avg("close").over(part)).alias("d"))
    c = c.select("entity", "ts", F.try_divide(F.col("d"), F.sqrt(F.sum(F.col("d") * F.col("d")).over(part))).alias("z"))
    z = c.groupBy("entity").agg(F.array_sort(F.collect_list(F.struct("ts", "z"))).alias("zs")).select("entity", F.transform("zs", lambda x: x["z"]).alias("z"))
    # without a common date the names alone give the NULL pairs
    z = v.select("entity").distinct().join(z, "entity", "left")
    z = z.withColumn("b", F.pmod(F.xxhash64("entity"), F.lit(n_blocks)).cast("int")).withColumn("o", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    z = z.select("entity", "z", "b", F.least("b", "o").alias("lo"), F.greatest("b", "o").alias("hi"))

    def product(g: pd.DataFrame) -> pd.DataFrame:
        def matrix(rows):
            return np.array([x if x is not None else np.full(n_dates, np.nan) for x in rows], dtype=float).reshape(len(rows), n_dates)

        def pairs(x, y):
            m = matrix(list(x["z"])) @ matrix(list(y["z"])).T if n_dates else np.full((len(x), len(y)), np.nan)
            return pd.DataFrame({"e1": np.repeat(x["entity"].to_numpy(), len(y)), "e2": np.tile(y["entity"].to_numpy(), len(x)), "corr": np.clip(m.ravel(), -1, 1)})

        lo, hi = g[g["b"] == g["lo"]], g[g["b"] == g["hi"]]
        out = pairs(lo, hi) if (g["lo"] == g["hi"]).all() else pd.concat([pairs(lo, hi), pairs(hi, lo)])
        out["corr"] = np.where((out["e1"] == out["e2"]) & out["corr"].notna(), 1.0, out["corr"])
        return out.assign(n_dates=n_dates)

    out = z.groupBy("lo", "hi").applyInPandas(product, "e1 string, e2 string, corr double, n_dates long")
    return out.select("e1", "e2", F.when(~F.isnan("corr"), F.col("corr")).alias("corr"), "n_dates")


# --------------------------------------------------------------- distributions
def histogram(panel: DataFrame, bins=30, col: str = "close") -> DataFrame:
    """Density histogram between min and max (last bin right-closed; a
    constant series widens to +-0.5). ``bins`` is a number, or ``"auto"`` for
    clip(n // 10, 8, 40) bins per entity. Empty bins are kept; no join: zero
    rows are unioned in and summed."""
    v = _valid(panel, col)
    part = Window.partitionBy("entity")
    lo0, hi0 = F.min(col).over(part), F.max(col).over(part)
    n = F.count("*").over(part)
    nb = (F.least(F.greatest(F.floor(n / 10), F.lit(8)), F.lit(40)) if bins == "auto" else F.lit(int(bins))).cast("int")
    s = v.select("entity", F.col(col).alias("x"), lo0.alias("lo0"), hi0.alias("hi0"), n.alias("n"), nb.alias("nb"))
    s = s.select("*", F.when(F.col("lo0") == F.col("hi0"), F.col("lo0") - 0.5).otherwise(F.col("lo0")).alias("lo"),
                 F.when(F.col("lo0") == F.col("hi0"), F.col("hi0") + 0.5).otherwise(F.col("hi0")).alias("hi"))
    b = F.least(F.floor((F.col("x") - F.col("lo")) * F.col("nb") / (F.col("hi") - F.col("lo"))).cast("int"),
                F.col("nb") - 1)
    hits = s.select("entity", b.alias("bin"), F.lit(1).alias("c"), "lo", "hi", "n", "nb")
    per_ent = s.groupBy("entity").agg(F.first("lo").alias("lo"), F.first("hi").alias("hi"), F.first("n").alias("n"),
                                      F.first("nb").alias("nb"))
    zeros = per_ent.select("entity", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("bin"),
                           F.lit(0).alias("c"), "lo", "hi", "n", "nb")
    agg = hits.unionByName(zeros).groupBy("entity", "bin").agg(
        F.sum("c").alias("count"), F.first("lo").alias("lo"), F.first("hi").alias("hi"), F.first("n").alias("n"),
        F.first("nb").alias("nb"))
    width = (F.col("hi") - F.col("lo")) / F.col("nb")
    left = F.col("lo") + F.col("bin") * width
    right = F.col("lo") + (F.col("bin") + 1) * width
    return agg.select("entity", "bin", F.col("nb").alias("bins"), left.alias("bin_left"), right.alias("bin_right"),
                      ((left + right) / 2).alias("bin_center"),
                      F.col("count").cast("long").alias("count"),
                      (F.col("count") / (F.col("n") * width)).alias("density"))


def normal_curve(panel: DataFrame, col: str, grid: int = 200) -> DataFrame:
    """A10: normal density with the sample mean and population std on a
    ``grid``-point grid from min to max (one generated row per grid point)."""
    g = _valid(panel, col).groupBy("entity").agg(
        F.avg(col).alias("mu"), F.stddev_pop(col).alias("sigma"), F.min(col).alias("lo"), F.max(col).alias("hi"))
    x = g.select("*", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("i"))
    gx = F.col("lo") + F.col("i") * (F.col("hi") - F.col("lo")) / F.lit(grid - 1)
    z = (gx - F.col("mu")) / F.col("sigma")
    pdf = F.lit(1.0) / (F.col("sigma") * F.lit(math.sqrt(2 * math.pi))) * F.exp(F.lit(-0.5) * z * z)
    return x.select("entity", "i", gx.alias("x"), F.when(F.col("sigma") > 0, pdf).alias("density"), "mu", "sigma")


def kde(panel: DataFrame, grid: int = 200, col: str = "close") -> DataFrame:
    """Gaussian KDE (Scott bandwidth s * n^(-1/5)) on a ``grid``-point
    grid from min to max. Each observation emits its kernel value at every
    grid point and a map-side partial sum shrinks that before the shuffle."""
    v = _valid(panel, col)
    part = Window.partitionBy("entity")
    s = v.select("entity", F.col(col).alias("x"), F.min(col).over(part).alias("lo"),
                 F.max(col).over(part).alias("hi"), F.stddev_samp(col).over(part).alias("sd"),
                 F.count("*").over(part).alias("n"))
    s = s.where((F.col("n") > 1) & (F.col("sd") > 0))
    h = F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2))
    g = F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("i")
    e = s.select("entity", "x", "lo", "hi", "n", h.alias("h"), g)
    gx = F.col("lo") + F.col("i") * (F.col("hi") - F.col("lo")) / F.lit(grid - 1)
    z = (gx - F.col("x")) / F.col("h")
    k = F.exp(-0.5 * z * z) / (F.col("h") * F.lit(math.sqrt(2 * math.pi)))
    return (e.select("entity", "i", gx.alias("x"), k.alias("k"), "n")
            .groupBy("entity", "i").agg(F.first("x").alias("x"), (F.sum("k") / F.first("n")).alias("density")))


def probability_plot(panel: DataFrame, col: str = "close") -> DataFrame:
    """Normal probability plot points (Filliben medians) and the
    least-squares line through them, per entity."""
    v = _valid(panel, col)
    w = Window.partitionBy("entity").orderBy(col, "ts")
    part = Window.partitionBy("entity")
    s = v.select("entity", "ts", F.col(col).alias("osr"), F.row_number().over(w).alias("i"),
                 F.count("*").over(part).alias("n"))
    n = F.col("n").cast("double")
    m = (F.when(F.col("i") == F.col("n"), F.pow(F.lit(0.5), 1 / n))
         .when(F.col("i") == 1, 1 - F.pow(F.lit(0.5), 1 / n))
         .otherwise((F.col("i") - 0.3175) / (n + 0.365)))
    pts = s.select("entity", "i", "n", "osr", norm_ppf(m).alias("osm"))
    fit = pts.select("*", F.regr_slope("osr", "osm").over(part).alias("slope"),
                     F.regr_intercept("osr", "osm").over(part).alias("intercept"),
                     F.corr("osm", "osr").over(part).alias("r"))
    return fit
