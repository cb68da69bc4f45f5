"""Registry of named queries: Spark builder + DuckDB oracle SQL.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
driver tables.  The oracle is an independent SQL statement over the same
parquet tables (views named like the files), or absent for operators that SQL
cannot express (model training).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}
COVERS: dict[str, str] = {}


def register(name: str, sql: str | None = None, covers: str = ""):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        COVERS[name] = covers
        return fn
    return deco


def load_all() -> None:
    """Import the query modules (they register on import)."""
    from regiflow.plans import (  # noqa: F401
        q_checks, q_control, q_entities, q_flows, q_formats, q_integrity, q_ml, q_months, q_quality, q_records,
        q_warehouse,
    )


def queries() -> dict[str, QueryFn]:
    load_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    load_all()
    return dict(ORACLES)
