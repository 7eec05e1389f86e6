"""All queries of the core, by name."""

from __future__ import annotations

from taxoloom.queries import curation, enrich, graphs, links, records, shapes, texts

MODULES = (records, texts, links, graphs, shapes, enrich, curation)


def queries() -> dict:
    return {name: q for m in MODULES for name, q in m.QUERIES.items()}


def oracle_sql() -> dict:
    return {name: sql for m in MODULES for name, sql in m.SQL.items()}
