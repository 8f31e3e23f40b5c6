"""All named queries. Importing the query modules fills the registry."""

from __future__ import annotations

from tabspark.plans import q_batches, q_core, q_encode, q_fit, q_metrics, q_models  # noqa: F401
from tabspark.plans.registry import REGISTRY, Query, QueryFn


def queries() -> dict[str, QueryFn]:
    return {n: q.fn for n, q in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {n: q.sql for n, q in REGISTRY.items() if q.sql}


def get(name: str) -> Query:
    return REGISTRY[name]
