"""Shared plans: the sign pipeline (clean -> key -> join -> parse -> filter)
as DataFrames and as DuckDB CTEs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from waymark.operators import join as J
from waymark.plans import fixture_sql as X
from waymark.plans import fixtures as fx
from waymark.plans import sqltext as q


def lookup_df(spark: SparkSession, d: str) -> DataFrame:
    return J.coord_lookup(fx.coord_lookup_raw(spark, d), ["ord"])


def attached_df(spark: SparkSession, d: str) -> DataFrame:
    return J.attach_coordinates(fx.signs(spark, d), lookup_df(spark, d))


def raw_signs_df(spark: SparkSession, d: str) -> DataFrame:
    signs = J.usable_signs(fx.signs(spark, d))
    return J.raw_signs_from_sheets(J.attach_coordinates(signs, lookup_df(spark, d)), extra=fx.SIGN_ORDER, tested=True)


LOOKUP_SQL = f"""lookup AS (
  SELECT intersection_key, coordinate_string, city, zip FROM (
    SELECT {q.key('intersection')} AS intersection_key, cd AS coordinate_string, city, zip,
           row_number() OVER (PARTITION BY {q.key('intersection')} ORDER BY ord) AS rn
    FROM coord_lookup_raw) WHERE rn = 1)"""

_DMS = q.dms_parts("coordinate_string")

ATTACHED_SQL = f"""keyed AS (
  SELECT {q.clean('intersection', '-')} AS intersection, {q.clean('text_on_sign_exact', '-')} AS text_on_sign,
         code_type, src_order, src_line, src_part
  FROM signs),
merged AS (
  SELECT k.*, {q.key('k.intersection')} AS intersection_key FROM keyed k),
joined AS (
  SELECT m.*, l.coordinate_string, l.city, l.zip
  FROM merged m LEFT JOIN lookup l ON m.intersection_key = l.intersection_key),
attached AS (
  SELECT j.*, CASE WHEN len({_DMS['deg']}) = 2 THEN {q.dms_value(_DMS, 1)} END AS latitude,
         CASE WHEN len({_DMS['deg']}) = 2 THEN {q.dms_value(_DMS, 2)} END AS longitude
  FROM joined j)"""

RAW_SIGNS_SQL = f"""raw_signs AS (
  SELECT intersection, text_on_sign AS text_on_sign_exact, latitude, longitude, code_type,
         src_order, src_line, src_part
  FROM attached
  WHERE intersection IS NOT NULL AND text_on_sign IS NOT NULL AND latitude IS NOT NULL
    AND longitude IS NOT NULL AND {q.strip('text_on_sign')} <> ''
    AND intersection NOT IN ('56th-pena'))"""

PIPE_CTES = (X.SIGNS, X.COORD_LOOKUP_RAW, LOOKUP_SQL, ATTACHED_SQL)


