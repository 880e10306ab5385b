"""Queries over the driver's tables, by name, and the same in SQL."""

from lotframe.plans import listing_queries, scan_queries, table_queries

_ALL = {**listing_queries.QUERIES, **table_queries.QUERIES, **scan_queries.QUERIES}
QUERIES = {name: query for name, (query, _) in _ALL.items()}
ORACLE_SQL = {name: sql for name, (_, sql) in _ALL.items() if sql}
