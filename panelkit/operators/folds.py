"""Train/test splits, walk-forward folds and future dates.

Rows are labelled, never copied to the driver: a row takes part in fold f
as ``train`` or ``test`` by position arithmetic, so each fold of each entity
is a (entity, fold) group inside the panel's entity partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit.functions.scalar import label_from_index


def target_series(panel: DataFrame, col: str = "returns") -> DataFrame:
    """entity, idx, ts, i (0-based position among non-null values), y, n."""
    s = panel.where(F.col(col).isNotNull())
    w = Window.partitionBy("entity").orderBy("idx")
    return s.select("entity", "idx", "ts", (F.row_number().over(w) - 1).cast("int").alias("i"),
                    F.col(col).alias("y"), F.count("*").over(Window.partitionBy("entity")).alias("n"))


def holdout(series: DataFrame, test_size: float = 0.2) -> DataFrame:
    """First int(n * (1 - test_size)) positions train, the rest test (fold -1)."""
    split = F.floor(F.col("n") * F.lit(1.0 - test_size)).cast("int")
    role = F.when(F.col("i") < split, F.lit("train")).otherwise(F.lit("test"))
    return series.select("*", F.lit(-1).alias("fold"), role.alias("role"),
                         F.when(F.col("i") >= split, F.col("i") - split + 1).alias("step"))


def walk_forward(series: DataFrame, n_splits: int = 5, horizon: int | None = 12) -> DataFrame:
    """P10: expanding-window folds. Fold test size = n // (n_splits + 1); fold f
    tests positions [s_f, s_f + size) with s_f = n - (n_splits - f) * size and
    trains on everything before; the test block is cut to ``horizon`` steps
    and folds with fewer than 2 test points are skipped."""
    size = (F.col("n") / (n_splits + 1)).cast("int")
    take = size if horizon is None else F.least(size, F.lit(horizon))
    x = series.where(F.col("n") >= n_splits + 1).select(
        "*", size.alias("fold_size"), take.alias("take"),
        F.explode(F.sequence(F.lit(0), F.lit(n_splits - 1))).alias("fold"))
    start = F.col("n") - (F.lit(n_splits) - F.col("fold")) * F.col("fold_size")
    role = (F.when(F.col("i") < start, F.lit("train"))
            .when(F.col("i") < start + F.col("take"), F.lit("test")))
    x = x.select("*", role.alias("role"), (F.col("i") - start + 1).alias("_step"))
    x = x.where(F.col("role").isNotNull() & (F.col("take") >= 2) & (F.col("fold_size") >= 1))
    return x.select("entity", "idx", "ts", "i", "y", "n", "fold", "role",
                    F.when(F.col("role") == "test", F.col("_step")).cast("int").alias("step"))


def fold_slots(n_splits: int = 5, horizon: int | None = 12, test_size: float = 0.2, full: bool = True,
               cv: bool = True, hold: bool = False) -> list[tuple[int, Column, Column, Column]]:
    """The same folds as positions instead of labelled rows: ``(fold, stop, last, valid)`` as
    expressions over ``n``. A fold trains on i < stop and tests stop <= i < last, so what it
    needs of the past is one look-up at stop - 1. The full fit (-2) tests nothing."""
    n = F.col("n").cast("int")
    slots = [(-2, n, n, F.lit(True))] if full else []
    if hold:
        slots.append((-1, F.floor(n * F.lit(1.0 - test_size)).cast("int"), n, F.lit(True)))
    if cv:
        size = (n / (n_splits + 1)).cast("int")
        take = size if horizon is None else F.least(size, F.lit(horizon))
        slots += [(f, n - (n_splits - f) * size, n - (n_splits - f) * size + take, (size >= 1) & (take >= 2)) for f in range(n_splits)]
    return slots


def future_dates(last: DataFrame, freq: str, horizon: int) -> DataFrame:
    """``horizon`` bin labels after each entity's last bin (excluded).
    ``last`` has entity and last_idx."""
    x = last.select("entity", "last_idx", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step"))
    return x.select("entity", "step", label_from_index(F.col("last_idx") + F.col("step"), freq).alias("ts"))
