"""Survey sheet directory scan (A1, A2, G1).

Sheets are header CSV files whose columns differ from file to file. One
``spark.read.csv`` over all of them would take the first file's header for
every file and silently mis-assign columns. Here the tasks that read the
sheets also find each one's header (its first row that is not blank) and pick
columns by name, so one read gives the rows of all layouts, nothing is
collected, and small sheets share tasks. Large ones are cut into blocks, see
``csvblocks``. Rows carry ``ord`` = (path, block, position): the order of the
files' names, and of the rows in each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.operators.filters import nullify_columns
from waymark.session import ship_package
from waymark.sources.csvblocks import csv_headers, csv_rows
from waymark.sources.tables import EXCEL_SUFFIXES

SHEET_REQUIRED = ("intersection", "text_on_sign_exact")
SHEET_COLUMNS_OPTIONAL = ["code_type", "notes", "Unnamed: 3"]


def _no_workbooks(pattern: str) -> None:
    if pattern.lower().endswith(EXCEL_SUFFIXES):
        raise NotImplementedError("workbook files need a workbook reader; export the sheets to CSV")


def skipped_sheets(spark: SparkSession, pattern: str, required=SHEET_REQUIRED) -> DataFrame:
    """``path, missing``: the files that a scan leaves out, with the required
    columns they lack."""
    _no_workbooks(pattern)
    ship_package(spark)
    lacking = F.array_sort(F.array_except(F.array(*[F.lit(c) for c in required]), "names"))
    return csv_headers(spark, pattern).select("path", lacking.alias("missing")).where(F.size("missing") > 0)


def scan_sheets(spark: SparkSession, pattern: str, required=SHEET_REQUIRED,
                optional=SHEET_COLUMNS_OPTIONAL) -> DataFrame:
    """All rows of the sheets matching ``pattern`` that hold the ``required``
    columns: these, the ``optional`` ones (null where a sheet lacks them), with
    missing-value tokens as nulls, and ``ord``."""
    _no_workbooks(pattern)
    columns = [*required, *optional]
    return nullify_columns(csv_rows(spark, pattern, columns, required), columns)
