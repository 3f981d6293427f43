"""All queries of the core, with their SQL."""

from __future__ import annotations

from quarrystone.plans import agreement, features, inputs, quality, relational, training

_MODULES = (agreement, relational, quality, inputs, features, training)


def queries() -> dict:
    return {name: query for module in _MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in _MODULES for name, sql in module.SQL.items()}
