"""All queries of the core by name, and the SQL of those that have one."""

from __future__ import annotations

from sievemill.plans import core_queries, core_sql, data_queries, function_queries, reader_queries, sweep_queries

QUERIES = {**core_queries.QUERIES, **data_queries.QUERIES, **sweep_queries.QUERIES, **function_queries.QUERIES, **reader_queries.QUERIES}
ORACLES = {**core_sql.ORACLES, **sweep_queries.ORACLES, **function_queries.ORACLES, **reader_queries.ORACLES}
