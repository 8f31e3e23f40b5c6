"""Registered queries of the subpackage and their SQL."""

from __future__ import annotations

from tabspark.llm import (
    q_chat, q_decontaminate, q_exact_spans, q_fill_middle, q_license, q_near_text, q_near_vectors, q_ns_bounds, q_packing,
    q_pii, q_pipeline, q_quality, q_segment_search, q_toxicity,
)

_MODULES = (q_toxicity, q_exact_spans, q_packing, q_license, q_pii, q_quality, q_decontaminate, q_chat,
            q_near_vectors, q_near_text, q_segment_search, q_fill_middle, q_ns_bounds, q_pipeline)


def queries() -> dict:
    return {n: f for m in _MODULES for n, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {n: s for m in _MODULES for n, s in m.SQL.items()}
