"""Registry of comparable queries: key -> (Spark builder, DuckDB oracle SQL).

Each builder takes (spark, sf_dir) and returns a lazy DataFrame over the
whole test tables. Clock-valued columns (run and ingest stamps) are left out
of compared output; ``as_of`` dates are literals so results repeat.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLES: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn
    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from tillroll.plans import queries  # noqa: F401
