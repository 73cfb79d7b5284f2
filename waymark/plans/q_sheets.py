"""Queries: survey sheet directory scan and the sheet-to-raw-signs pipeline
(A1, A2, A3, A4, A7, G1).

The sheets are derived from ``signs`` by Spark writes into the shared
checkpoint folder: layout ``a`` (intersection, text, code), layout ``b``
(reordered, with ``notes`` and an unnamed fourth column), layout ``c`` (no
text column: skipped), layout ``d`` (an index column without a name, text and
intersection), a sheet in which the header row comes a second time (a row like
any other), a header-only sheet, and a nested folder under ``a`` that the non-recursive glob
must not visit. Every sign is in one layout.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from waymark.operators import join as J
from waymark.plans import fixture_sql as X
from waymark.plans import fixtures as fx
from waymark.plans import sqltext as q
from waymark.plans.pipeline import LOOKUP_SQL
from waymark.plans.registry import r6, register
from waymark.session import scratch_path
from waymark.sources.sheets import scan_sheets
from waymark.sources.tables import read_table, write_table

SHEET_COLS = ["intersection", "text_on_sign_exact", "code_type", "notes", "Unnamed: 3"]


def write_sheets(spark, d) -> str:
    s = fx.signs(spark, d)
    root = scratch_path(spark, "sheets")
    part = F.col("src_part") % 4
    layouts = {
        "a": s.where(part == 0).select("intersection", "text_on_sign_exact", "code_type"),
        "b": s.where(part == 1).select(F.concat(F.lit("n"), F.col("src_line").cast("string")).alias("notes"),
                                       "code_type", "text_on_sign_exact",
                                       F.col("src_part").cast("string").alias(""), "intersection"),
        "c": s.where(part == 2).select("intersection", "code_type"),
        "d": s.where(part == 3).select(F.col("src_line").cast("string").alias(""), "text_on_sign_exact", "intersection"),
        "again": spark.range(1).select(F.lit("intersection").alias("intersection"),
                                       F.lit("text_on_sign_exact").alias("text_on_sign_exact")),
        "header_only": s.where(F.lit(False)).select("intersection", "text_on_sign_exact"),
    }
    for name, df in layouts.items():
        write_table(df, f"{root}/{name}", fmt="csv")
    write_table(layouts["a"], f"{root}/a/nested", fmt="csv")
    return root


_SHEETS_SQL = """sheets AS (
  SELECT intersection, text_on_sign_exact, code_type, CAST(NULL AS VARCHAR) AS notes,
         CAST(NULL AS VARCHAR) AS "Unnamed: 3", src_order, src_line, src_part
  FROM signs WHERE src_part % 4 = 0
  UNION ALL
  SELECT intersection, text_on_sign_exact, code_type, 'n' || CAST(src_line AS VARCHAR),
         CAST(src_part AS VARCHAR), src_order, src_line, src_part
  FROM signs WHERE src_part % 4 = 1
  UNION ALL
  SELECT intersection, text_on_sign_exact, NULL, NULL, NULL, src_order, src_line, src_part
  FROM signs WHERE src_part % 4 = 3
  UNION ALL
  SELECT 'intersection', 'text_on_sign_exact', NULL, NULL, NULL, NULL, NULL, NULL)"""


@register("scan_sheets", X.with_ctes(X.SIGNS, _SHEETS_SQL, body="""
SELECT intersection, text_on_sign_exact, code_type, notes, "Unnamed: 3" FROM sheets"""))
def q_scan_sheets(spark, d):
    root = write_sheets(spark, d)
    return scan_sheets(spark, f"{root}/*/*.csv").select(*[F.col(f"`{c}`") for c in SHEET_COLS])


@register("sheet_raw_signs", X.with_ctes(X.SIGNS, _SHEETS_SQL, X.COORD_LOOKUP_RAW, LOOKUP_SQL, f"""keyed AS (
  SELECT {q.clean('intersection', '-')} AS intersection, {q.clean('text_on_sign_exact', '-')} AS text_on_sign,
         code_type FROM sheets),
joined AS (
  SELECT k.*, l.coordinate_string FROM keyed k LEFT JOIN lookup l ON {q.key('k.intersection')} = l.intersection_key),
parsed AS (
  SELECT j.*, {q.dms_value(q.dms_parts('coordinate_string'), 1)} AS latitude,
         {q.dms_value(q.dms_parts('coordinate_string'), 2)} AS longitude FROM joined j)""", body=f"""
SELECT intersection, text_on_sign AS text_on_sign_exact, round(latitude, 6) AS latitude,
       round(longitude, 6) AS longitude, code_type
FROM parsed
WHERE intersection IS NOT NULL AND text_on_sign IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL
  AND {q.strip('text_on_sign')} <> '' AND intersection NOT IN ('56th-pena')"""))
def q_sheet_raw_signs(spark, d):
    """Sheets and a coordinate workbook exported as CSV, scanned, cleaned,
    key-joined, parsed and filtered into the raw sign table."""
    root = write_sheets(spark, d)
    lookup_path = write_table(fx.coord_lookup_raw(spark, d), scratch_path(spark, "coord-sheet"), fmt="csv")
    lookup_raw = read_table(spark, lookup_path).withColumn("ord", F.col("ord").cast("bigint"))
    signs = J.usable_signs(scan_sheets(spark, f"{root}/*/*.csv"))
    raw = J.raw_signs_from_sheets(J.attach_coordinates(signs, J.coord_lookup(lookup_raw, ["ord"])), tested=True)
    return raw.select("intersection", "text_on_sign_exact", r6("latitude"), r6("longitude"), "code_type")
