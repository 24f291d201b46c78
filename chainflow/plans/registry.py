"""Query registry: key -> (Spark job, DuckDB oracle SQL).

Each job takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
given tables.  The oracle is plain SQL over the same parquet tables, with the
fixture views inlined as CTEs (``fixtures.duck_with``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(key: str, oracle: str | None = None):
    """Register a job under ``key``; ``oracle`` is its DuckDB SQL (None: rows-only)."""
    def deco(fn):
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if oracle is not None:
            ORACLES[key] = oracle
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from chainflow.plans import (  # noqa: F401
        fanout_queries,
        metric_queries,
        relational_queries,
        source_queries,
    )
