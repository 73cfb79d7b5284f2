"""Intermediate tables below the shared checkpoint folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from waymark.session import scratch_path


def nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in schema.fields])


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it
    back: later stages scan a columnar table instead of recomputing the
    lineage, and a lost executor re-reads files instead of re-running the
    upstream joins."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    # The schema is the one just written: no footer-reading job on the way back.
    return df.sparkSession.read.schema(nullable(df.schema)).parquet(path)
