"""All queries of the engine outside ``llm``, with SQL that gives the same rows."""

from . import inventory_queries, match_queries, site_queries, table_queries
from .base import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "inventory_queries", "match_queries", "site_queries", "table_queries"]
