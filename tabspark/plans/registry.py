"""Query registry: name -> (Spark plan builder, oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    fn: QueryFn
    sql: str | None
    ops: tuple[str, ...]


REGISTRY: dict[str, Query] = {}


def query(name: str, ops: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` with its SURVEY ids and oracle."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql, tuple(o.strip() for o in ops.split(",")))
        return fn

    return deco


def sqlf(x: float) -> str:
    """A double literal that DuckDB parses to exactly the Python float."""
    return f"cast('{float(x)!r}' as double)"
