"""Registry of named queries: a Spark plan and (where expressible) its SQL oracle.

Every query reads the given tables (or data Spark derives from them) whole.
Double outputs are rounded on both sides (sums are order-sensitive in the
last bits); ``:N`` in a column list of ``final`` gives the SQL rounding.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from panelkit.functions.scalar import round_doubles
from panelkit.plans.sqlref import rnd, rnd_sig

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def final(src: str, cols: str, where: str = "") -> str:
    """``SELECT`` list from a compact spec: ``"entity ts close:6"``."""
    parts = []
    for c in cols.split():
        if ":" in c:
            name, scale = c.split(":")
            if scale.startswith("s"):
                parts.append(f"{rnd_sig(name, int(scale[1:]))} AS {name}")
            else:
                parts.append(f"{rnd(name, int(scale))} AS {name}")
        else:
            parts.append(c)
    w = f" WHERE {where}" if where else ""
    return f"SELECT {', '.join(parts)} FROM {src}{w}"


def register(name: str, sql: str | None = None, scale: int = 6, overrides: dict | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # the panels' timestamps are naive (timestamp_ntz) and are read as UTC:
            # pin the session zone so calendar bins do not depend on the caller's
            if spark.conf.get("spark.sql.session.timeZone") != "UTC":
                spark.conf.set("spark.sql.session.timeZone", "UTC")
            return round_doubles(fn(spark, sf_dir), scale, overrides)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        REGISTRY[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from panelkit.plans import (  # noqa: F401
        queries_core, queries_decomp, queries_document, queries_eda, queries_export, queries_forecast, queries_models,
        queries_sources, queries_stats,
    )
