"""Registry of the queries exposed through ``__spark_entry__.queries()``.

A query is ``fn(spark, sf_dir) -> DataFrame`` over the driver tables; its
oracle is a DuckDB SQL string over the same tables (or ``None`` when the
operation is not expressible in SQL, e.g. an ordered text diff).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register ``fn`` under ``name`` with an optional DuckDB oracle."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from runvault.plans import (q_archive, q_entities, q_ledger,  # noqa: F401
                                q_diff, q_params, q_artifacts)
