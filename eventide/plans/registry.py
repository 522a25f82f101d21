"""Registry of named queries over the driver tables.

Each query is a function ``(spark, sf_dir) -> DataFrame`` plus, where the
relation is expressible in SQL, the equivalent DuckDB SQL over the same
parquet tables.  Column names and types match between the two.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    fn: QueryFn
    oracle: str | None
    doc: str


REGISTRY: dict[str, Query] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, oracle, (fn.__doc__ or "").strip())
        return fn
    return deco


def load_all() -> dict[str, Query]:
    # Importing the modules registers their queries.
    from eventide.plans import (  # noqa: F401
        q_windows, q_distinct, q_topn, q_joins, q_patterns, q_late, q_state, q_functions,
        q_streams, q_sources, q_late_streams,
    )
    return REGISTRY
