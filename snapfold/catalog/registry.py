"""All queries and their SQL, by name."""

from __future__ import annotations

from . import document_queries, mart_queries, stream_queries, table_queries, warehouse_queries

MODULES = (document_queries, warehouse_queries, table_queries, mart_queries, stream_queries)


def queries() -> dict:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.ORACLE.items()}
