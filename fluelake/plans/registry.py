"""All queries of the core and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from fluelake.plans import classes, flows, joins, quantities, reports, scalars, windows

MODULES = [quantities, scalars, windows, joins, classes, reports, flows]


def queries() -> dict[str, Callable]:
    return {k: q for m in MODULES for k, q in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: q for m in MODULES for k, q in m.SQL.items()}
