"""The query catalogue: name -> (spark, sf_dir) -> DataFrame, and the SQL that must return the same rows."""

from __future__ import annotations

from . import ingest, o2c, other, register, runs, sources, streams

MODULES = (register, o2c, ingest, runs, sources, other, streams)
QUERIES = {name: query for m in MODULES for name, query in m.QUERIES.items()}
ORACLE_SQL = {name: sql for m in MODULES for name, sql in m.ORACLE_SQL.items()}
