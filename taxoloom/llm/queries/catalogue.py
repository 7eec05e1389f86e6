"""All queries of this subpackage, by name."""

from __future__ import annotations

from taxoloom.llm.queries import corpus, linkage

MODULES = (linkage, corpus)


def queries() -> dict:
    return {name: q for m in MODULES for name, q in m.QUERIES.items()}


def oracle_sql() -> dict:
    return {name: sql for m in MODULES for name, sql in m.SQL.items()}
