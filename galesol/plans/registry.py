"""Registry of queries and of their oracle SQL over the grid views."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from galesol.sources.fixtures import DIM_MASK_SQL, OBS_DAILY_SQL, OBS_HOURLY_SQL

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

VIEWS = {"obs_hourly": OBS_HOURLY_SQL, "obs_daily": OBS_DAILY_SQL, "dim_mask": DIM_MASK_SQL}


def views(sql: str, **more: str) -> str:
    """`sql` with the grid views that it names, and further common tables, in front."""
    used = {k: v for k, v in VIEWS.items() if k in sql or any(k in m for m in more.values())}
    return "WITH " + ", ".join(f"{k} AS ({v})" for k, v in (used | more).items()) + " " + sql if used or more else sql


def query(sql: str | None = None, name: str | None = None, **more: str) -> Callable[[Query], Query]:
    """Register a query under its function's name, with oracle SQL where SQL can express it."""

    def register(f: Query) -> Query:
        key = name or f.__name__
        QUERIES[key] = f
        if sql:
            ORACLES[key] = views(sql, **more)
        return f

    return register


def r(expression: str, digits: int = 6) -> str:
    """SQL that rounds as fixtures.rounded does."""
    return f"round({expression} + 1e-9, {digits}) + 0e0"
