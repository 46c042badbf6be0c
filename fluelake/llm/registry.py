"""All queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from fluelake.llm import address_queries, canonical_queries, consensus_queries, mixing_queries, piece_queries, scan_queries, survivor_queries, token_queries, truncation_queries

MODULES = [address_queries, canonical_queries, consensus_queries, mixing_queries, scan_queries, survivor_queries, piece_queries, token_queries, truncation_queries]


def queries() -> dict[str, Callable]:
    return {k: q for m in MODULES for k, q in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: q for m in MODULES for k, q in m.SQL.items()}
