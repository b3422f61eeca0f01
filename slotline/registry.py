"""The registered queries of the library, each with its DuckDB equivalent."""

from __future__ import annotations

from slotline.plans import catalog_queries, document_queries, report_queries, stream_queries, table_queries  # noqa: F401  they register their queries
from slotline.plans.queries import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
