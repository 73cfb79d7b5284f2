"""Queries: text cleaning, keys, tokens, missing tokens, DMS, row filters
(B3, B4, B5, C1, C2, C3, C5, C6, C10, F1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from waymark.functions import geo
from waymark.functions import text as T
from waymark.operators import filters as FL
from waymark.operators import join as J
from waymark.plans import fixture_sql as X
from waymark.plans import fixtures as fx
from waymark.plans import sqltext as q
from waymark.plans.pipeline import PIPE_CTES, RAW_SIGNS_SQL, attached_df, raw_signs_df
from waymark.plans.registry import r6, register
from waymark.sources.tables import table

FLAGS = dict(lowercase=False, keep_numbers=False, keep_underscore=False, extra_chars="'-.")
# Intersections removed by the exclusion query (two spellings plus the default).
EXCLUDED = ["nation_15-supplier000000000", "nation_20 supplier000000001", "56th-pena"]


def _docs(spark, d):
    return table(spark, d, "documents", ["doc_id", "text"])


@register("clean_text", f"SELECT doc_id, {q.clean('text')} AS text_clean FROM documents")
def q_clean_text(spark, d):
    return _docs(spark, d).select("doc_id", T.clean_text("text").alias("text_clean"))


@register("clean_text_flags", "SELECT doc_id, " + q.clean(
    "text", extra_chars=FLAGS["extra_chars"], lowercase=False, keep_numbers=False,
    keep_underscore=False) + " AS text_clean FROM documents")
def q_clean_text_flags(spark, d):
    return _docs(spark, d).select("doc_id", T.clean_text("text", **FLAGS).alias("text_clean"))


@register("normalize_key", f"SELECT doc_id, {q.key('text')} AS text_key FROM documents")
def q_normalize_key(spark, d):
    return _docs(spark, d).select("doc_id", T.join_key("text").alias("text_key"))


@register("split_words", "SELECT doc_id, string_split(coalesce(text, ''), ' ') AS words FROM documents")
def q_split_words(spark, d):
    return _docs(spark, d).select("doc_id", T.split_words("text").alias("words"))


_MISSING_SQL = ", ".join(q.lit(t) for t in T.MISSING_TOKENS)


@register("nullify_tokens", f"""
SELECT doc_id, CAST(len(w) AS INTEGER) AS n_tokens,
       CAST(len(list_filter(w, lambda t: t IN ({_MISSING_SQL}))) AS INTEGER) AS n_missing
FROM (SELECT doc_id, string_split(coalesce(text, ''), ' ') AS w FROM documents)""")
def q_nullify_tokens(spark, d):
    w = T.split_words("text")
    nulled = F.transform(w, lambda t: T.nullify_tokens(t))
    return _docs(spark, d).select("doc_id", F.size(w).alias("n_tokens"),
                                  F.size(F.filter(nulled, lambda t: t.isNull())).alias("n_missing"))


@register("drop_blank_text", f"""
SELECT doc_id, s AS text FROM (SELECT doc_id, {q.strip('text')} AS s FROM documents) WHERE s <> ''""")
def q_drop_blank_text(spark, d):
    return FL.drop_blank_text(_docs(spark, d), "text", rewrite=True)


_DMS_IN = """SELECT s_suppkey, s_suppkey % 90 AS deg, (s_suppkey * 7) % 60 AS mins,
       abs(s_acctbal) % 60 AS secs, substr('NSEW', CAST(s_suppkey % 4 + 1 AS INTEGER), 1) AS hemi
FROM supplier"""


@register("dms_to_decimal", f"""
SELECT s_suppkey, round(CASE WHEN upper(hemi) IN ('S', 'W') THEN -(deg + mins / 60 + secs / 3600)
                        ELSE deg + mins / 60 + secs / 3600 END, 6) AS decimal_degrees
FROM ({_DMS_IN})""")
def q_dms_to_decimal(spark, d):
    sup = table(spark, d, "supplier", ["s_suppkey", "s_acctbal"])
    k = F.col("s_suppkey")
    src = sup.select("s_suppkey", (k % 90).alias("deg"), ((k * 7) % 60).alias("mins"),
                     (F.abs(F.col("s_acctbal")) % 60).alias("secs"),
                     F.expr("substr('NSEW', cast(s_suppkey % 4 + 1 as int), 1)").alias("hemi"))
    return src.select("s_suppkey", r6(geo.dms_to_decimal("deg", "mins", "secs", "hemi"), "decimal_degrees"))


_PD = q.dms_parts("cs")


@register("parse_dms", X.with_ctes(X.COORD_LOOKUP_RAW, body=f"""
SELECT ord, cs AS coordinate_string,
       round(CASE WHEN len({_PD['deg']}) = 2 AND {q.dms_value(_PD, 1)} IS NOT NULL
                  AND {q.dms_value(_PD, 2)} IS NOT NULL THEN {q.dms_value(_PD, 1)} END, 6) AS latitude,
       round(CASE WHEN len({_PD['deg']}) = 2 AND {q.dms_value(_PD, 1)} IS NOT NULL
                  AND {q.dms_value(_PD, 2)} IS NOT NULL THEN {q.dms_value(_PD, 2)} END, 6) AS longitude
FROM (SELECT ord, CASE WHEN ord % 7 = 0 THEN split_part(cd, ' ', 1) ELSE cd END AS cs
      FROM coord_lookup_raw)"""))
def q_parse_dms(spark, d):
    """Permissive parse: every 7th string keeps only its latitude part and
    parses to nulls."""
    raw = fx.coord_lookup_raw(spark, d)
    cs = F.when(F.col("ord") % 7 == 0, F.substring_index("cd", " ", 1)).otherwise(F.col("cd"))
    parsed = geo.with_dms(raw.select("ord", cs.alias("coordinate_string")), "coordinate_string",
                          mode="permissive")
    return parsed.select("ord", "coordinate_string", r6("latitude"), r6("longitude"))


@register("drop_null_rows", X.with_ctes(*PIPE_CTES, body="""
SELECT intersection, text_on_sign, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude
FROM attached WHERE latitude IS NOT NULL AND longitude IS NOT NULL"""))
def q_drop_null_rows(spark, d):
    out = FL.drop_null_rows(attached_df(spark, d), ["latitude", "longitude"])
    return out.select("intersection", "text_on_sign", r6("latitude"), r6("longitude"))


@register("exclude_intersections", X.with_ctes(*PIPE_CTES, RAW_SIGNS_SQL, body=f"""
SELECT intersection, text_on_sign_exact, src_order, src_line, src_part FROM raw_signs
WHERE intersection NOT IN ({", ".join(q.lit(e) for e in EXCLUDED)})"""))
def q_exclude_intersections(spark, d):
    out = FL.exclude_values(raw_signs_df(spark, d), "intersection", EXCLUDED)
    return out.select("intersection", "text_on_sign_exact", *fx.SIGN_ORDER)


@register("dedup_first", X.with_ctes(X.COORD_LOOKUP_RAW, body=f"""
SELECT intersection_key, ord, cd AS coordinate_string FROM (
  SELECT {q.key('intersection')} AS intersection_key, ord, cd,
         row_number() OVER (PARTITION BY {q.key('intersection')} ORDER BY ord) AS rn
  FROM coord_lookup_raw) WHERE rn = 1"""))
def q_dedup_first(spark, d):
    raw = fx.coord_lookup_raw(spark, d)
    keyed = raw.select(T.join_key("intersection").alias("intersection_key"), "ord",
                       F.col("cd").alias("coordinate_string"), F.col("ord").alias("_o"))
    return J.first_per_key(keyed, "intersection_key", ["_o"]).drop("_o")
