"""Query registry: ``QUERIES[name](spark, sf_dir) -> DataFrame`` and
``ORACLE[name] -> DuckDB SQL``.

Computed columns carry the same alias on both sides; doubles are rounded to
6 decimals at the end of each query (summation order differs between
engines), never inside operators.
"""

from __future__ import annotations

from pyspark.sql import functions as F

QUERIES: dict = {}
ORACLE: dict = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def r6(c, name: str | None = None):
    """Round to 6 decimals; a column given by name keeps its name."""
    col = F.round(F.col(c) if isinstance(c, str) else c, 6)
    name = name or (c if isinstance(c, str) else None)
    return col.alias(name) if name else col
