"""Queries: coordinate lookup, sign join, raw signs, profile."""

from __future__ import annotations

from pyspark.sql import functions as F

from waymark.operators import bags as B
from waymark.plans import fixture_sql as X
from waymark.plans import fixtures as fx
from waymark.plans.pipeline import (LOOKUP_SQL, PIPE_CTES, RAW_SIGNS_SQL, attached_df,
                                    lookup_df, raw_signs_df)
from waymark.plans.registry import r6, register
from waymark.session import scratch_path
from waymark.sources.tables import read_raw_signs, write_table


@register("coord_lookup", X.with_ctes(X.COORD_LOOKUP_RAW, LOOKUP_SQL, body="SELECT * FROM lookup"))
def q_coord_lookup(spark, d):
    return lookup_df(spark, d)


@register("attach_coordinates", X.with_ctes(*PIPE_CTES, body="""
SELECT intersection, text_on_sign, code_type, intersection_key, coordinate_string, city, zip,
       round(latitude, 6) AS latitude, round(longitude, 6) AS longitude, src_order, src_line, src_part
FROM attached"""))
def q_attach_coordinates(spark, d):
    a = attached_df(spark, d)
    return a.select("intersection", "text_on_sign", "code_type", "intersection_key", "coordinate_string",
                    "city", "zip", r6("latitude"), r6("longitude"),
                    *fx.SIGN_ORDER)


@register("raw_signs", X.with_ctes(*PIPE_CTES, RAW_SIGNS_SQL, body="""
SELECT intersection, text_on_sign_exact, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude,
       code_type, src_order, src_line, src_part
FROM raw_signs"""))
def q_raw_signs(spark, d):
    r = raw_signs_df(spark, d)
    return r.select("intersection", "text_on_sign_exact", r6("latitude"),
                    r6("longitude"), "code_type", *fx.SIGN_ORDER)


@register("raw_signs_csv", X.with_ctes(*PIPE_CTES, RAW_SIGNS_SQL, body="""
SELECT intersection, text_on_sign_exact, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude, code_type
FROM raw_signs"""))
def q_raw_signs_csv(spark, d):
    """The raw signs written as CSV with an index column, and an excluded, a
    blank and an incomplete row beside them, read through the CSV reader."""
    signs = raw_signs_df(spark, d).select("intersection", "text_on_sign_exact", "latitude", "longitude", "code_type")
    odd = signs.limit(0).unionByName(spark.createDataFrame(
        [("56th-pena", " x ", 1.0, 2.0, "y"), ("blank", "   ", 1.0, 2.0, "y"), ("null", "t", None, 2.0, "y")], signs.schema))
    indexed = signs.unionByName(odd).select(F.monotonically_increasing_id().cast("string").alias(""), "*")
    path = write_table(indexed, scratch_path(spark, "raw-signs-csv"), fmt="csv")
    return read_raw_signs(spark, path).select("intersection", "text_on_sign_exact", r6("latitude"), r6("longitude"),
                                              "code_type")


@register("intersection_profile", X.with_ctes(*PIPE_CTES, RAW_SIGNS_SQL, body="""
SELECT intersection, round(avg(latitude), 6) AS latitude, round(avg(longitude), 6) AS longitude,
       CAST(count(DISTINCT text_on_sign_exact) AS BIGINT) AS unique_sign_count,
       count(*) AS raw_sign_count
FROM raw_signs GROUP BY intersection"""))
def q_intersection_profile(spark, d):
    p = B.intersection_profile(raw_signs_df(spark, d))
    return p.select("intersection", r6("latitude"), r6("longitude"),
                    "unique_sign_count", "raw_sign_count")
