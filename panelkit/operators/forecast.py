"""Forecast jobs, accuracy metrics and price conversion.

The AR(1) baseline (M4) is fully native: per (entity, fold) least squares by
``regr_slope``/``regr_intercept`` over window partitions, then closed-form
multi-step forecasts and intervals. Every model job returns the same long
PRED table, so the metric, CV, comparison and price steps are shared:

    entity, model, fold, role ('insample' | 'test' | 'future'), step, i, y, yhat, lower, upper
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelkit.functions.scalar import safe_div

Z95 = 1.959963984540054  # standard normal 97.5 % quantile (fixed value)
PRED_COLS = ["entity", "model", "fold", "role", "step", "i", "y", "yhat", "lower", "upper"]


def _ar1_fit(rows: DataFrame) -> DataFrame:
    """Adds phi, c, sigma, y_last, i_last (fit on role == 'train' rows)."""
    key = ["entity", "fold"]
    w = Window.partitionBy(*key).orderBy("i")
    part = Window.partitionBy(*key)
    tr = F.col("role") == "train"
    r = rows.select("*", F.when(tr, F.lag("y").over(w)).alias("_ylag"))
    r = r.select("*",
                 F.regr_slope(F.when(tr, F.col("y")), F.col("_ylag")).over(part).alias("_phi"),
                 F.regr_intercept(F.when(tr, F.col("y")), F.col("_ylag")).over(part).alias("_c"),
                 F.avg(F.when(tr, F.col("y"))).over(part).alias("_mean"),
                 F.max(F.when(tr, F.col("i"))).over(part).alias("i_last"))
    phi = F.coalesce(F.col("_phi"), F.lit(0.0))
    c = F.when(F.col("_phi").isNull(), F.col("_mean")).otherwise(F.col("_c"))
    r = r.select("*", phi.alias("phi"), c.alias("c"))
    e = F.col("y") - F.col("c") - F.col("phi") * F.col("_ylag")
    npairs = F.count(F.when(tr & F.col("_ylag").isNotNull(), F.lit(1))).over(part)
    r = r.select("*", F.sum(F.when(tr & F.col("_ylag").isNotNull(), e * e)).over(part).alias("_ssr"),
                 npairs.alias("_np"),
                 F.max(F.when(tr & (F.col("i") == F.col("i_last")), F.col("y"))).over(part).alias("y_last"))
    sigma = F.sqrt(F.col("_ssr") / F.greatest(F.col("_np") - 2, F.lit(1)))
    return r.withColumn("sigma", sigma).withColumn("insample_hat", F.col("c") + F.col("phi") * F.col("_ylag"))


def ar1_path(h, phi, c, y_last, sigma):
    """Closed-form h-step AR(1) forecast and 95 % interval."""
    ph = F.pow(phi, h)
    unit = F.abs(phi - 1) < 1e-12
    mean = F.when(unit, y_last + c * h).otherwise(c * (1 - ph) / (1 - phi) + ph * y_last)
    unit2 = F.abs(phi * phi - 1) < 1e-12
    var_mult = F.when(unit2, h.cast("double")).otherwise((1 - F.pow(phi, 2 * h)) / (1 - phi * phi))
    se = sigma * F.sqrt(var_mult)
    return mean, mean - Z95 * se, mean + Z95 * se


def ar1_predict(rows: DataFrame) -> DataFrame:
    """PRED rows for test positions (forecast from the last train value) and
    in-sample one-step predictions of the train rows (first row has none)."""
    f = _ar1_fit(rows)
    h = F.col("i") - F.col("i_last")
    mean, lo, hi = ar1_path(h, F.col("phi"), F.col("c"), F.col("y_last"), F.col("sigma"))
    test = f.where(F.col("role") == "test").select(
        "entity", F.lit("AR1").alias("model"), "fold", F.lit("test").alias("role"), "step", "i", "y",
        mean.alias("yhat"), lo.alias("lower"), hi.alias("upper"))
    ins = f.where((F.col("role") == "train") & F.col("insample_hat").isNotNull()).select(
        "entity", F.lit("AR1").alias("model"), "fold", F.lit("insample").alias("role"),
        F.lit(None).cast("int").alias("step"), "i", "y", F.col("insample_hat").alias("yhat"),
        F.lit(None).cast("double").alias("lower"), F.lit(None).cast("double").alias("upper"))
    return test.unionByName(ins)


def ar1_forecast(series: DataFrame, horizon: int = 12) -> DataFrame:
    """Fit on the whole series, forecast ``horizon`` future steps (role 'future')."""
    rows = series.select("*", F.lit(-2).alias("fold"), F.lit("train").alias("role"))
    f = _ar1_fit(rows)
    per = f.groupBy("entity", "fold").agg(*[F.first(c).alias(c) for c in ("phi", "c", "sigma", "y_last", "i_last")])
    x = per.select("*", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step"))
    mean, lo, hi = ar1_path(F.col("step"), F.col("phi"), F.col("c"), F.col("y_last"), F.col("sigma"))
    return x.select("entity", F.lit("AR1").alias("model"), "fold", F.lit("future").alias("role"),
                    F.col("step").cast("int").alias("step"), (F.col("i_last") + F.col("step")).cast("int").alias("i"),
                    F.lit(None).cast("double").alias("y"), mean.alias("yhat"), lo.alias("lower"), hi.alias("upper"))


def ar1_jobs(series: DataFrame, slots: list, horizon: int = 12) -> DataFrame:
    """PRED rows of every fold of ``folds.fold_slots`` from one pass over ``series``
    (entity, i, y, n): in-sample and future rows of the full fit, test rows of the others.

    The cross-moments of (previous value, value) are running sums over the entity. A fold's
    moments are the sums at its last train row, so another fold costs a look-up, not a
    refit: one exchange by entity and one sort, whatever the number of folds. Values are
    taken relative to the first one, which leaves a constant series without variance."""
    w = Window.partitionBy("entity").orderBy("i")
    run, part = w.rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy("entity")
    s = series.select("entity", "i", "y", "n", F.first("y").over(w).alias("y0"), F.lag("y").over(w).alias("ylag"))
    u, v = F.col("y") - F.col("y0"), F.col("ylag") - F.col("y0")
    paired = F.col("ylag").isNotNull()
    sums = {"np": F.count("ylag"), "s1": F.sum(u), "sv": F.sum(v), "su": F.sum(F.when(paired, u)), "svv": F.sum(v * v),
            "suv": F.sum(u * v), "suu": F.sum(F.when(paired, u * u))}
    s = s.select("*", F.struct(*[e.over(run).alias(c) for c, e in sums.items()], F.col("y").alias("y_last")).alias("m"))
    at = {f: F.first(F.when(valid & (F.col("i") == stop - 1), F.col("m")), True).over(part) for f, stop, _, valid in slots}
    s = s.select("*", *[m.alias(f"m{f}") for f, m in at.items()])

    def entry(role, fold, step, m):
        return F.struct(F.lit(role).alias("role"), F.lit(fold).alias("fold"), step.cast("int").alias("step"), m.alias("m"))

    none = F.array().cast(f"array<struct<role:string,fold:int,step:int,m:{s.schema['m'].dataType.simpleString()}>>")
    entries = []
    for fold, stop, last, valid in slots:
        m = F.col(f"`m{fold}`")
        if fold == -2:
            entries.append(F.when(paired, F.array(entry("insample", fold, F.lit(None), m))).otherwise(none))
            steps = F.transform(F.sequence(F.lit(1), F.lit(horizon)), lambda k: entry("future", -2, k, F.col("`m-2`")))
            entries.append(F.when(F.col("i") == F.col("n") - 1, steps).otherwise(none))
        else:
            tested = valid & (F.col("i") >= stop) & (F.col("i") < last)
            entries.append(F.when(tested, F.array(entry("test", fold, F.col("i") - stop + 1, m))).otherwise(none))
    x = s.select("entity", "i", "y", "y0", "ylag", F.explode(F.concat(*entries)).alias("x")).select(
        "entity", "i", "y", "y0", "ylag", "x.role", "x.fold", "x.step", "x.m.*")
    n_pairs = F.col("np")
    sxx = F.col("svv") - F.col("sv") * F.try_divide("sv", n_pairs)
    sxy = F.col("suv") - F.col("sv") * F.try_divide("su", n_pairs)
    x = x.select("*", F.when(sxx > 0, sxy / sxx).alias("_phi"))
    trained = n_pairs + 1  # the first value has no pair
    c = F.when(F.col("_phi").isNull(), F.col("s1") / trained).otherwise(F.try_divide(F.col("su") - F.col("_phi") * F.col("sv"), n_pairs))
    x = x.select("*", F.coalesce("_phi", F.lit(0.0)).alias("phi"), c.alias("cu"))
    ssr = (F.col("suu") - 2 * F.col("cu") * F.col("su") - 2 * F.col("phi") * F.col("suv") + n_pairs * F.col("cu") * F.col("cu")
           + 2 * F.col("cu") * F.col("phi") * F.col("sv") + F.col("phi") * F.col("phi") * F.col("svv"))
    sigma = F.sqrt(F.greatest(ssr, F.lit(0.0)) / F.greatest(n_pairs - 2, F.lit(1)))
    x = x.select("*", F.when(n_pairs > 0, sigma).alias("sigma"), (F.col("cu") + F.col("y0") * (1 - F.col("phi"))).alias("c"))
    mean, lo, hi = ar1_path(F.col("step"), F.col("phi"), F.col("c"), F.col("y_last"), F.col("sigma"))
    ins, future = F.col("role") == "insample", F.col("role") == "future"
    return x.select("entity", F.lit("AR1").alias("model"), "fold", "role", "step",
                    F.when(future, F.col("i") + F.col("step")).otherwise(F.col("i")).cast("int").alias("i"),
                    F.when(~future, F.col("y")).alias("y"), F.when(ins, F.col("c") + F.col("phi") * F.col("ylag")).otherwise(mean).alias("yhat"),
                    F.when(~ins, lo).alias("lower"), F.when(~ins, hi).alias("upper"))


def zero_predict(rows: DataFrame) -> DataFrame:
    """Naive baseline for a returns target: a zero return (price unchanged),
    95 % band from the train std. Test rows and in-sample rows."""
    part = Window.partitionBy("entity", "fold")
    sd = F.stddev_pop(F.when(F.col("role") == "train", F.col("y"))).over(part)
    r = rows.select("*", sd.alias("_sd"))
    test = r.where(F.col("role") == "test").select(
        "entity", F.lit("Zero").alias("model"), "fold", F.lit("test").alias("role"), "step", "i", "y",
        F.lit(0.0).alias("yhat"), (-Z95 * F.col("_sd")).alias("lower"), (Z95 * F.col("_sd")).alias("upper"))
    ins = r.where(F.col("role") == "train").select(
        "entity", F.lit("Zero").alias("model"), "fold", F.lit("insample").alias("role"),
        F.lit(None).cast("int").alias("step"), "i", "y", F.lit(0.0).alias("yhat"),
        F.lit(None).cast("double").alias("lower"), F.lit(None).cast("double").alias("upper"))
    return test.unionByName(ins)


def zero_forecast(series: DataFrame, horizon: int = 12) -> DataFrame:
    """The naive baseline's ``horizon`` future steps (role 'future')."""
    g = series.groupBy("entity").agg(F.stddev_pop("y").alias("_sd"), F.max("i").alias("i_last"))
    x = g.select("*", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step"))
    return x.select("entity", F.lit("Zero").alias("model"), F.lit(-2).alias("fold"), F.lit("future").alias("role"),
                    "step", (F.col("i_last") + F.col("step")).cast("int").alias("i"),
                    F.lit(None).cast("double").alias("y"), F.lit(0.0).alias("yhat"),
                    (-Z95 * F.col("_sd")).alias("lower"), (Z95 * F.col("_sd")).alias("upper"))


# ------------------------------------------------------------------ metrics
def error_metrics(pred: DataFrame, keys=("entity", "model", "fold"), mape_variant: str = "abs") -> DataFrame:
    """G1-G5 over (y, yhat) rows: rmse, mae, mape, smape, r2, residual_std (population).

    mape_variant 'abs': |e| / (|y| + 1e-10); 'signed': |e / y| with y = 0 -> 1e-10."""
    e = F.col("y") - F.col("yhat")
    if mape_variant == "abs":
        ape = F.abs(e / (F.abs(F.col("y")) + F.lit(1e-10)))
    else:
        ape = F.abs(e / F.when(F.col("y") != 0, F.col("y")).otherwise(F.lit(1e-10)))
    sm = 2.0 * F.abs(e) / (F.abs(F.col("y")) + F.abs(F.col("yhat")) + F.lit(1e-10))
    part = Window.partitionBy(*keys)
    p = pred.where(F.col("y").isNotNull() & F.col("yhat").isNotNull()).select(
        *keys, "y", e.alias("e"), ape.alias("ape"), sm.alias("sm"), F.avg("y").over(part).alias("_ym"))
    g = p.groupBy(*keys).agg(
        F.sqrt(F.avg(F.col("e") * F.col("e"))).alias("rmse"), F.avg(F.abs("e")).alias("mae"),
        (F.avg("ape") * 100).alias("mape"), (F.avg("sm") * 100).alias("smape"),
        F.sum(F.col("e") * F.col("e")).alias("_ssr"),
        F.sum((F.col("y") - F.col("_ym")) * (F.col("y") - F.col("_ym"))).alias("_sst"),
        F.stddev_pop("e").alias("residual_std"), F.count("*").alias("n"))
    return g.select(*keys, "rmse", "mae", "mape", "smape",
                    (1 - F.col("_ssr") / (F.col("_sst") + F.lit(1e-10))).alias("r2"), "residual_std", "n")


def naive_scale(series_rows: DataFrame, keys=("entity", "fold")) -> DataFrame:
    """W11/G6 denominator: mean |first difference| of the train rows."""
    w = Window.partitionBy(*keys).orderBy("i")
    tr = series_rows.where(F.col("role") == "train")
    d = tr.select(*keys, F.abs(F.col("y") - F.lag("y").over(w)).alias("ad"))
    return d.groupBy(*keys).agg(F.avg("ad").alias("naive_mae"), F.count("*").alias("n_train"))


def cv_summary(fold_metrics: DataFrame) -> DataFrame:
    """Per (entity, model) mean and population std of fold metrics;
    cv_rmse = mean fold RMSE (NULL when no fold ran)."""
    return fold_metrics.groupBy("entity", "model").agg(
        F.avg("rmse").alias("cv_rmse"), F.stddev_pop("rmse").alias("cv_rmse_std"),
        F.avg("mae").alias("cv_mae"), F.stddev_pop("mae").alias("cv_mae_std"),
        F.avg("mape").alias("cv_mape"), F.stddev_pop("mape").alias("cv_mape_std"),
        F.count("*").alias("n_folds"))


def holdout_report(pred: DataFrame, rows: DataFrame) -> DataFrame:
    """Hold-out mae, rmse, mape (signed variant) and MASE per entity/model."""
    m = error_metrics(pred.where(F.col("role") == "test"), ("entity", "model", "fold"), "signed")
    s = naive_scale(rows, ("entity", "fold"))
    j = m.join(s, ["entity", "fold"], "left")
    mase = F.when((F.col("n_train") >= 2) & (F.col("naive_mae") != 0), F.col("mae") / F.col("naive_mae"))
    return j.select("entity", "model", "mae", "rmse", "mape", mase.alias("mase"),
                    "n_train", F.col("n").alias("n_test"))


def macro_average(report: DataFrame, metrics=("mae", "rmse", "mape", "mase")) -> DataFrame:
    """Average of per-entity metrics ignoring nulls, per model."""
    return report.groupBy("model").agg(*[F.avg(m).alias(m) for m in metrics])


def to_price(future: DataFrame, last: DataFrame, target: str = "returns") -> DataFrame:
    """Forecast -> price path. For log returns last * exp(cumsum),
    bounds likewise (per-step bounds accumulate); for ``target="close"`` the
    forecast is a price already and passes through. ci_width = upper - lower.
    ``last`` has entity, last_price."""
    j = future.join(last, "entity")
    if target == "returns":
        w = Window.partitionBy("entity", "model").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)

        def price(c):
            return F.col("last_price") * F.exp(F.sum(c).over(w))
    elif target == "close":
        price = F.col
    else:
        raise ValueError(f"target must be 'returns' or 'close', got {target!r}")
    return j.select(
        "entity", "model", "step", "yhat", "lower", "upper", "last_price",
        price("yhat").alias("price_forecast"), price("lower").alias("price_lower"),
        price("upper").alias("price_upper")
    ).withColumn("ci_width", F.col("price_upper") - F.col("price_lower"))


def dated(future: DataFrame, dates: DataFrame) -> DataFrame:
    """Future rows as the forecasts table, each step with its date."""
    return future.join(dates, ["entity", "step"]).select(
        "entity", "model", "step", F.col("ts").alias("date"), F.col("yhat").alias("forecast"),
        F.col("lower").alias("lower_bound"), F.col("upper").alias("upper_bound"))


def validation(pred: DataFrame, rows: DataFrame) -> DataFrame:
    """K3: hold-out metrics (fold -1) with the walk-forward mean and spread, per
    entity and model. A model with folds but no hold-out keeps its row, and the reverse;
    one without any forecast (error rows, train rows alone) has a row of nulls."""
    pairs = pred.select("entity", "model").distinct()
    test = pred.where(F.col("role") == "test")
    ho = holdout_report(test.where(F.col("fold") == -1), rows.where(F.col("fold") == -1))
    cv = cv_summary(error_metrics(test.where(F.col("fold") >= 0), ("entity", "model", "fold")))
    return pairs.join(ho.join(cv, ["entity", "model"], "full"), ["entity", "model"], "left")


def forecast_change(prices: DataFrame) -> DataFrame:
    """Change of the final forecast vs last price (%), CI width at the
    first and last step and its growth (> 100 % flagged)."""
    g = prices.groupBy("entity", "model").agg(
        F.max_by("price_forecast", "step").alias("final_price"), F.first("last_price").alias("last_price"),
        F.min_by("ci_width", "step").alias("ci_first"), F.max_by("ci_width", "step").alias("ci_last"))
    growth = safe_div(F.col("ci_last") - F.col("ci_first"), F.col("ci_first")) * 100
    return g.select("entity", "model", "final_price", "last_price",
                    (safe_div(F.col("final_price") - F.col("last_price"), F.col("last_price")) * 100).alias("change_pct"),
                    "ci_first", "ci_last", growth.alias("ci_growth_pct"), (growth > 100).alias("ci_widens"))
