"""Every registered query and, where SQL can say it, the same query for the oracle."""

from __future__ import annotations

from curaspark.plans import curation, intake, layouts, relational, releases, scalars, screening, submissions

_MODULES = (scalars, relational, curation, releases, screening, intake, layouts, submissions)


def queries() -> dict:
    return {name: f for module in _MODULES for name, f in module.queries().items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in _MODULES for name, sql in module.oracle_sql().items()}
