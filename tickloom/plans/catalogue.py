"""The registered queries of the market-data engine."""

from __future__ import annotations

from tickloom.plans import book_queries, data_queries, file_queries, grid_queries, more_queries, trade_queries, venue_queries

GROUPS = (grid_queries, trade_queries, book_queries, data_queries, more_queries, venue_queries, file_queries)
QUERIES = {name: query for group in GROUPS for name, query in group.QUERIES.items()}
ORACLE_SQL = {name: sql for group in GROUPS for name, sql in group.ORACLE_SQL.items()}
