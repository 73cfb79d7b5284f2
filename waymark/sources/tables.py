"""Table readers and writers: driver tables, raw signs, bags, result sinks
(A2, A3, A5, A7)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.operators.filters import (drop_blank_text, drop_null_rows, exclude_values,
                                       nullify_columns, require_columns)
from waymark.sources.csvblocks import csv_rows, first_header
from waymark.sources.staging import stage_table  # noqa: F401 -- the operators import it from here

RAW_SIGN_COLUMNS = ["intersection", "text_on_sign_exact", "latitude", "longitude"]
RAW_SIGN_OPTIONAL = ["code_type"]
BAG_REQUIRED = ["text", "latitude", "longitude"]
EXCEL_SUFFIXES = (".xlsx", ".xls", ".xlsm")


_SCHEMAS: dict = {}


def table(spark: SparkSession, base_dir: str, name: str, columns=None) -> DataFrame:
    """One driver table (Parquet). Selecting ``columns`` here lets the scan
    read only those columns. The schema is read from the footers once per
    process and passed on later reads, which skips a schema job per read."""
    path = os.path.join(base_dir, f"{name}.parquet")
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    df = spark.read.schema(_SCHEMAS[path]).parquet(path)
    return df.select(*columns) if columns else df


def read_table(spark: SparkSession, path: str, order_col: str | None = None) -> DataFrame:
    """Read a table by suffix: workbook suffixes need a workbook reader, which
    this engine does not ship; everything else is header CSV (a file or a
    folder of files) with the columns of its first file as text, the reader's
    missing-value tokens as nulls, and ``order_col``, if named, in file order.
    Unnamed columns (an index) and repeated names are named as the original
    reader names them."""
    if path.lower().endswith(EXCEL_SUFFIXES):
        raise NotImplementedError(
            f"{path}: workbook files need a workbook reader; export the first sheet to CSV")
    if path.lower().endswith(".parquet"):
        return spark.read.parquet(path)
    return nullify_columns(csv_rows(spark, path, first_header(spark, path), order_col=order_col))


def to_number(df: DataFrame, columns, kind: str = "double", mode: str = "strict") -> DataFrame:
    """Text columns as numbers. A value that is no number fails the job in
    ``strict`` mode; in ``permissive`` mode it becomes null and its column is
    named in ``rejected`` (array of column names, empty for a good row)."""
    columns = [c for c in columns if c in df.columns]
    bad = {c: F.col(c).isNotNull() & F.col(c).try_cast(kind).isNull() for c in columns}
    if mode == "permissive":
        names = F.filter(F.array(*[F.when(b, F.lit(c)) for c, b in bad.items()]).cast("array<string>"),
                         lambda n: n.isNotNull())
        if "rejected" in df.columns:
            names = F.concat(F.col("rejected"), names)
        return df.withColumns({"rejected": names, **{c: F.col(c).try_cast(kind) for c in columns}})
    if mode != "strict":
        raise ValueError("mode must be 'strict' or 'permissive'")
    fail = lambda c: F.raise_error(F.concat(F.lit(f"{c} holds no number: "), F.col(c))).cast(kind)
    return df.withColumns({c: F.when(bad[c], fail(c)).otherwise(F.col(c).try_cast(kind)) for c in columns})


def rejected_rows(spark: SparkSession, path: str, columns=("latitude", "longitude")) -> DataFrame:
    """The rows of a CSV table in which some of ``columns`` holds no number,
    with ``rejected``: what a permissive read leaves out."""
    return to_number(read_table(spark, path), columns, mode="permissive").where(F.size("rejected") > 0)


def prepare_raw_signs(df: DataFrame, extra=()) -> DataFrame:
    """Raw sign table from any source: check required columns, keep the
    optional ``code_type`` when present, drop rows with a null required value,
    strip the text and drop blanks, drop excluded intersections."""
    present_extra = [c for c in extra if c in df.columns]
    out = require_columns(df, RAW_SIGN_COLUMNS, RAW_SIGN_OPTIONAL + present_extra)
    out = drop_null_rows(out, RAW_SIGN_COLUMNS)
    out = drop_blank_text(out.withColumn("text_on_sign_exact", F.col("text_on_sign_exact").cast("string")),
                          "text_on_sign_exact", rewrite=True)
    return exclude_values(out, "intersection")


def read_raw_signs(spark: SparkSession, path: str, order_col: str = "ord", mode: str = "strict") -> DataFrame:
    """Raw sign CSV -> typed raw sign table, with ``order_col`` giving file
    order (path, block, position) for the order-sensitive operators.
    Coordinates that are no numbers fail the job; with ``mode='permissive'``
    their rows are left out and :func:`rejected_rows` lists them."""
    df = read_table(spark, path, order_col)
    return prepare_raw_signs(to_number(df, ["latitude", "longitude"], mode=mode), extra=[order_col])


def prepare_bags(df: DataFrame, error_if_empty: bool = False) -> DataFrame:
    """Bag table for training/scoring: drop rows null in text or coordinates,
    text as string. ``error_if_empty`` raises when nothing is left (checked
    with a one-row probe, not a count)."""
    out = drop_null_rows(df, BAG_REQUIRED).withColumn("text", F.col("text").cast("string"))
    if error_if_empty and out.limit(1).count() == 0:
        raise ValueError("the bag table has no usable row")
    return out


def read_bags(spark: SparkSession, path: str, error_if_empty: bool = False, mode: str = "strict") -> DataFrame:
    """Bag CSV -> typed bag table; numbers as in :func:`read_raw_signs`."""
    df = to_number(read_table(spark, path), ["latitude", "longitude"], mode=mode)
    df = to_number(df, ["sample_id", "unique_sign_count", "raw_sign_count"], "int", mode)
    return prepare_bags(df.drop("rejected"), error_if_empty)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by=None) -> str:
    """Write a result table. CSV gets a header; Parquet keeps the types.
    Each task commits its own file, so a lost executor only redoes its
    tasks."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer.option("header", True).option("escape", '"').csv(path)
    else:
        writer.format(fmt).save(path)
    return path
