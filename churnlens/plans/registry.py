"""Registry of named queries: a Spark builder and, where SQL can express it,
an independent DuckDB text for the oracle check."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from churnlens.plans import (  # noqa: F401
        q_evaluation, q_ingest, q_models, q_prep, q_silver, q_splits, q_streaming, q_temporal)
