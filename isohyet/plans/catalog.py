"""Named queries over the driver's tables and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a function (spark, sf_dir) under its name, with its SQL if it has one."""

    def register(f):
        key = name or f.__name__
        if key in QUERIES:
            raise ValueError(f"{key} is registered twice")
        QUERIES[key] = f
        if sql:
            ORACLE_SQL[key] = sql
        return f

    return register


from . import availability, files, grids, indices, joins, seasons, selection, statistics, stores, streams, surfaces, workflows  # noqa: E402, F401
