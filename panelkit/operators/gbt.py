"""Pooled lag-window model (M3): one gradient-boosted tree model for all
entities, trained with pyspark.ml (distributed, seeded).

* W14: per (entity, fold) min-max scaling fitted on the train rows;
* W13: the 12 previous scaled values as the window;
* training pools every entity's train windows, one model per fold, the folds
  submitted together;
* the fitted trees are compiled to one SQL expression over the window (the same
  text runs in any engine with CASE). In-sample predictions of all folds are one
  projection. The multi-step forecast is one projection as well: a fold over the
  steps whose state is the window with the predictions so far, so there is no
  pass, no checkpoint and no Python per step. A fold runs to its longest test
  step; the full fit runs to ``horizon``.
* an (entity, fold) with fewer than ``lookback`` train rows, or in a fold
  where no entity has a full window, gives one ``error`` row.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit.session import checkpoint_dir

Z95 = 1.959963984540054
#: A line of a fitted ensemble's description.
_LINE = re.compile(r"\s*(?:Tree \d+ \(weight (?P<weight>\S+)\):|If \(feature (?P<at>\d+) <= (?P<cut>\S+)\)|(?P<other>Else) .*|Predict: (?P<value>\S+))$")


def scaled(rows: DataFrame) -> DataFrame:
    """``ys``, min-max scaled per (entity, fold) by the train rows; a constant gives 0."""
    part = Window.partitionBy("entity", "fold")
    tr = F.col("role") == "train"
    r = rows.select("entity", "fold", "role", "step", "i", "y",
                    F.min(F.when(tr, F.col("y"))).over(part).alias("lo"),
                    F.max(F.when(tr, F.col("y"))).over(part).alias("hi"))
    span = F.col("hi") - F.col("lo")
    return r.withColumn("ys", F.when(span > 0, (F.col("y") - F.col("lo")) / span).otherwise(F.lit(0.0)))


def lag_windows(s: DataFrame, lookback: int) -> DataFrame:
    """``win``, the ``lookback`` scaled values before each row (fewer at the start)."""
    w = Window.partitionBy("entity", "fold").orderBy("i")
    prev = F.collect_list("ys").over(w.rowsBetween(-lookback, -1))
    return s.withColumn("win", prev)


def _tree_sql(lines: Iterator[re.Match], item: Callable[[int], str]) -> str:
    m = next(lines)
    if m["value"]:
        return f"CAST('{m['value']}' AS DOUBLE)"
    left = _tree_sql(lines, item)
    assert next(lines)["other"]
    return f"CASE WHEN {item(int(m['at']))} <= CAST('{m['cut']}' AS DOUBLE) THEN {left} ELSE {_tree_sql(lines, item)} END"


def compile_trees(description: str, item: Callable[[int], str]) -> str:
    """A fitted ensemble (its ``toDebugString``) as SQL text: the weighted sum of one nested
    CASE per tree; ``item`` gives the text of a feature. Numbers are cast from their exact
    decimal text, so no engine reads them as fixed-point decimals."""
    lines = (m for m in map(_LINE.match, description.splitlines()) if m)
    terms = [f"CAST('{m['weight']}' AS DOUBLE) * {_tree_sql(lines, item)}" for m in lines]
    return " + ".join(terms)


def _by_fold(models: dict[int, str], item: Callable[[int], str]) -> str:
    return "CASE fold " + " ".join(f"WHEN {f} THEN {compile_trees(d, item)}" for f, d in models.items()) + " END"


def ensemble(models: dict[int, str], window: str = "win") -> Column:
    """Each row's prediction by its fold's model, from the ``window`` column. (Within a lambda:
    the nested cases of an ensemble are too long for one generated method.)"""
    return F.expr(f"transform(array({window}), w -> {_by_fold(models, lambda j: f'w[{j}]')})[0]")


def recursion(models: dict[int, str], lookback: int, steps: str) -> Column:
    """The predictions of 1 to ``steps`` steps ahead (a column), each fed back into the window ``win``."""
    path = f"aggregate(sequence(1, {steps}), win, (path, k) -> concat(path, array({_by_fold(models, lambda j: f'path[k + {j - 1}]')})))"
    return F.expr(f"slice({path}, {lookback + 1}, {steps})")


def run_gbt(rows: DataFrame, horizon: int = 12, lookback: int = 12, max_iter: int = 30,
            max_depth: int = 4, seed: int = 42) -> DataFrame:
    """PRED rows plus ``error`` (model 'GBT') for every fold in ``rows`` (one pooled model per fold)."""
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.regression import GBTRegressor

    spark = rows.sparkSession
    checkpoint_dir(spark)
    s = lag_windows(scaled(rows), lookback).checkpoint(eager=True)
    train = s.where((F.col("role") == "train") & (F.size("win") == lookback))
    # one row per fold reaches the driver: its longest test step, and if it can be trained
    fold_rows = s.groupBy("fold").agg(F.max(F.when(F.col("role") == "test", F.col("step"))).alias("last"),
                                      F.max((F.col("role") == "train") & (F.size("win") == lookback)).alias("full")).collect()
    last_step = {r["fold"]: r["last"] or horizon for r in fold_rows}
    folds = sorted(r["fold"] for r in fold_rows if r["full"])

    def fit(fold):
        return GBTRegressor(featuresCol="features", labelCol="ys", maxIter=max_iter, maxDepth=max_depth, seed=seed).fit(
            train.where(F.col("fold") == fold).select("ys", array_to_vector("win").alias("features"))).toDebugString

    with ThreadPoolExecutor(max_workers=8) as pool:
        models = dict(zip(folds, pool.map(inheritable_thread_target(spark)(fit), folds)))
    errors = _error_rows(s, folds, lookback)
    if not folds:
        return errors
    span = F.col("hi") - F.col("lo")
    # (each of the two projections is read more than once below: written out, they are planned and run once)
    ins = train.select("entity", "fold", "i", "y", (ensemble(models) * span + F.col("lo")).alias("yhat")).checkpoint(eager=True)
    sd = ins.groupBy("entity", "fold").agg(F.stddev_pop(F.col("y") - F.col("yhat")).alias("sigma"))
    # the window after the last train row, by (entity, fold): the last window and its value
    ends = (s.where((F.col("role") == "train") & F.col("fold").isin(folds)).groupBy("entity", "fold")
            .agg(F.max("i").alias("i_last"), F.max("lo").alias("lo"), F.max("hi").alias("hi"),
                 F.max_by(F.concat("win", F.array("ys")), "i").alias("win")).where(F.size("win") >= lookback)
            .withColumn("win", F.slice("win", -lookback, lookback)))
    steps = F.create_map(*[F.lit(x) for f in folds for x in (f, last_step[f])])[F.col("fold")]
    paths = ends.withColumn("steps", steps).select("entity", "fold", "i_last", "lo", "hi", recursion(models, lookback, "steps").alias("path")).checkpoint(eager=True)
    fut = paths.select("entity", "fold", "i_last", "lo", "hi", F.posexplode("path").alias("k", "ps")).join(sd, ["entity", "fold"], "left")
    yh = F.col("ps") * span + F.col("lo")
    fut = fut.select("entity", "fold", (F.col("k") + 1).cast("int").alias("step"),
                     (F.col("i_last") + F.col("k") + 1).cast("int").alias("i"), yh.alias("yhat"), "sigma")
    return _assemble(rows, ins, fut).unionByName(errors)


def _error_rows(s: DataFrame, folds: list[int], lookback: int) -> DataFrame:
    """One ``error`` row for every (entity, fold) that cannot be forecast."""
    g = s.groupBy("entity", "fold").agg(F.count(F.when(F.col("role") == "train", F.lit(1))).alias("n_train"))
    short = g.where((F.col("n_train") < lookback) | ~F.col("fold").isin(folds))
    none = {"step": "int", "i": "int", "y": "double", "yhat": "double", "lower": "double", "upper": "double"}
    return short.select(
        "entity", F.lit("GBT").alias("model"), "fold", F.lit("error").alias("role"),
        *[F.lit(None).cast(t).alias(c) for c, t in none.items()],
        F.format_string("insufficient data (%d obs)", F.col("n_train")).alias("error"))


def _assemble(rows: DataFrame, ins: DataFrame, fut: DataFrame) -> DataFrame:
    tests = rows.where(F.col("role") == "test").select("entity", "fold", "step", F.col("i").alias("ti"),
                                                       F.col("y").alias("ty"))
    lower = (F.col("yhat") - Z95 * F.col("sigma")).alias("lower")
    upper = (F.col("yhat") + Z95 * F.col("sigma")).alias("upper")
    t = (fut.join(tests, ["entity", "fold", "step"])
         .select("entity", F.lit("GBT").alias("model"), "fold", F.lit("test").alias("role"), "step",
                 F.col("ti").alias("i"), F.col("ty").alias("y"), "yhat", lower, upper))
    future = fut.where(F.col("fold") == -2).select(
        "entity", F.lit("GBT").alias("model"), "fold", F.lit("future").alias("role"), "step", "i",
        F.lit(None).cast("double").alias("y"), "yhat", lower, upper)
    insample = ins.where(F.col("fold") == -2).select(
        "entity", F.lit("GBT").alias("model"), "fold", F.lit("insample").alias("role"),
        F.lit(None).cast("int").alias("step"), F.col("i").cast("int").alias("i"), "y", "yhat",
        F.lit(None).cast("double").alias("lower"), F.lit(None).cast("double").alias("upper"))
    return t.unionByName(future).unionByName(insample).withColumn("error", F.lit(None).cast("string"))
