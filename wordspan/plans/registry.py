"""Queries by name, and the SQL that must give the same rows."""

from __future__ import annotations

from wordspan.plans import generation, generation_sql, loops, loops_sql, oracle, queries, stored, stored_sql

QUERIES = {q.__name__: q for q in queries.ALL + generation.ALL + loops.ALL + stored.ALL}
ORACLE_SQL = oracle.SQL | generation_sql.SQL | loops_sql.SQL | stored_sql.SQL
FLAGSHIP = "boundary_windows"
