"""Plan inspection helpers (used by tests to keep the shuffle count honest)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame


def physical_plan(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffle_count(df: DataFrame) -> int:
    """Hash / range shuffles in the (initial) physical plan; broadcasts excluded."""
    plan = physical_plan(df)
    return len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|RoundRobinPartitioning|SinglePartition)", plan))


def has_operator(df: DataFrame, name: str) -> bool:
    return name in physical_plan(df)
