"""Queries: bootstrap bags, street-sign top-k, sample ordinals, splits, round
picks (B8, F2, F3, F6, H1, H2, H3, H4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from waymark.operators import bags as B
from waymark.operators import split as S
from waymark.plans import fixture_sql as X
from waymark.plans import fixtures as fx
from waymark.plans import sqltext as q
from waymark.plans.pipeline import PIPE_CTES, RAW_SIGNS_SQL, raw_signs_df
from waymark.plans.registry import r6, register
from waymark.sources.tables import stage_table, table

# Fixture parameters (FIXTURES.md part 3): seed 1992, 5 signs per bag, 50 bags
# per intersection.
SEED, BAG, SAMPLES, SEP = 1992, 5, 50, " | "
ORDER_SQL = "src_order, src_line, src_part"


def bags_sql(with_code: bool, bag: int = BAG, samples: int = SAMPLES) -> str:
    street_n = "sum(CASE WHEN code_type = 'street_sign' THEN 1 ELSE 0 END)" if with_code else "0"
    street = f"""
  UNION ALL
  SELECT sl.intersection, sl.sample_id, sl.slot, st.t
  FROM slots sl JOIN (
    SELECT intersection, text_on_sign_exact AS t, rn - 1 AS slot FROM (
      SELECT intersection, text_on_sign_exact,
             row_number() OVER (PARTITION BY intersection ORDER BY {ORDER_SQL}) AS rn
      FROM raw_signs WHERE code_type = 'street_sign') WHERE rn <= {bag}) st
    ON sl.intersection = st.intersection AND sl.slot = st.slot
  WHERE sl.slot < least(sl.street_n, {bag})""" if with_code else ""
    return X.with_ctes(*PIPE_CTES, RAW_SIGNS_SQL, f"""prof AS (
  SELECT intersection, avg(latitude) AS lat, avg(longitude) AS lon,
         CAST(count(DISTINCT text_on_sign_exact) AS BIGINT) AS uniq, count(*) AS n,
         {street_n} AS street_n
  FROM raw_signs GROUP BY intersection)""", f"""numbered AS (
  SELECT intersection, text_on_sign_exact AS t,
         row_number() OVER (PARTITION BY intersection ORDER BY {ORDER_SQL}) - 1 AS idx
  FROM raw_signs)""", f"""slots AS (
  SELECT p.intersection, p.n, p.street_n, s.sample_id, b.slot
  FROM prof p
  CROSS JOIN (SELECT range AS sample_id FROM range(0, {samples})) s
  CROSS JOIN (SELECT range AS slot FROM range(0, {bag})) b)""", f"""members AS (
  SELECT sl.intersection, sl.sample_id, sl.slot, nb.t
  FROM slots sl JOIN numbered nb
    ON sl.intersection = nb.intersection
   AND nb.idx = {q.hash32(str(SEED), 'sl.intersection', 'sl.sample_id', 'sl.slot')} % sl.n
  WHERE sl.slot >= least(sl.street_n, {bag}){street})""", f"""bagged AS (
  SELECT intersection, sample_id,
         string_agg(t, {q.lit(SEP)} ORDER BY {q.hash32(str(SEED), "'s'", 'intersection', 'sample_id', 'slot')}, slot) AS text
  FROM members GROUP BY intersection, sample_id)""", body="""
SELECT b.intersection, CAST(b.sample_id AS INTEGER) AS sample_id, b.text,
       round(p.lat, 6) AS latitude, round(p.lon, 6) AS longitude,
       p.uniq AS unique_sign_count, p.n AS raw_sign_count
FROM bagged b JOIN prof p ON b.intersection = p.intersection""")


def _bags(spark, d, with_code=True, bag=BAG, samples=SAMPLES):
    signs = stage_table(raw_signs_df(spark, d), "raw-signs")
    if not with_code:
        signs = signs.drop("code_type")
    return B.bootstrap_bags(signs, fx.SIGN_ORDER, code_col="code_type" if with_code else None,
                            bag_size=bag, samples=samples, seed=SEED, separator=SEP)


def _rounded(bags):
    return bags.select("intersection", "sample_id", "text", r6("latitude"), r6("longitude"),
                       "unique_sign_count", "raw_sign_count")


@register("bootstrap_bags", bags_sql(True))
def q_bootstrap_bags(spark, d):
    return _rounded(_bags(spark, d, True))


@register("bootstrap_bags_no_code", bags_sql(False))
def q_bootstrap_bags_no_code(spark, d):
    return _rounded(_bags(spark, d, False))


# Bags larger than most groups' street-sign count: guaranteed street slots and
# random draws in the same bag.
MIXED_BAG, MIXED_SAMPLES = 64, 10


@register("bootstrap_bags_mixed", bags_sql(True, MIXED_BAG, MIXED_SAMPLES))
def q_bootstrap_bags_mixed(spark, d):
    return _rounded(_bags(spark, d, True, MIXED_BAG, MIXED_SAMPLES))


@register("street_signs_topk", X.with_ctes(*PIPE_CTES, RAW_SIGNS_SQL, body=f"""
SELECT intersection, CAST(rn - 1 AS INTEGER) AS slot, text_on_sign_exact FROM (
  SELECT intersection, text_on_sign_exact,
         row_number() OVER (PARTITION BY intersection ORDER BY {ORDER_SQL}) AS rn
  FROM raw_signs WHERE code_type = 'street_sign') WHERE rn <= 8"""))
def q_street_signs_topk(spark, d):
    return B.street_signs_topk(raw_signs_df(spark, d), 8, fx.SIGN_ORDER)


@register("sample_ordinal", X.with_ctes(*PIPE_CTES, RAW_SIGNS_SQL, body=f"""
SELECT intersection, CAST(s.sample_id AS INTEGER) AS sample_id,
       (g.rk - 1) * {SAMPLES} + s.sample_id AS sample_ordinal
FROM (SELECT intersection, dense_rank() OVER (ORDER BY intersection) AS rk
      FROM (SELECT DISTINCT intersection FROM raw_signs)) g
CROSS JOIN (SELECT range AS sample_id FROM range(0, {SAMPLES})) s"""))
def q_sample_ordinal(spark, d):
    out = B.sample_ordinal(raw_signs_df(spark, d), SAMPLES)
    return out.select("intersection", F.col("sample_id").cast("int").alias("sample_id"),
                      F.col("sample_ordinal").cast("bigint").alias("sample_ordinal"))


def _split_sql(items_sql: str, key: str, seed: int = SEED, test_size: float = 0.2) -> str:
    return f"""
SELECT {key}, CASE WHEN rk < ceil(CAST({test_size} AS DOUBLE) * total) THEN 'val' ELSE 'train' END AS split
FROM (SELECT {key}, row_number() OVER (ORDER BY {q.hash32(str(seed), key)}, {key}) - 1 AS rk,
             count(*) OVER () AS total
      FROM ({items_sql}))"""


@register("group_split", X.with_ctes(*PIPE_CTES, RAW_SIGNS_SQL,
                                     body=_split_sql("SELECT DISTINCT intersection FROM raw_signs",
                                                     "intersection")))
def q_group_split(spark, d):
    return S.group_split_table(raw_signs_df(spark, d), "intersection", 0.2, SEED)


@register("split_label", X.with_ctes(*PIPE_CTES, RAW_SIGNS_SQL, "splits AS (" + _split_sql(
    "SELECT DISTINCT intersection FROM raw_signs", "intersection") + ")", body="""
SELECT r.intersection, r.text_on_sign_exact, r.src_order, r.src_line, r.src_part, s.split
FROM raw_signs r JOIN splits s ON r.intersection = s.intersection"""))
def q_split_label(spark, d):
    out = S.split(raw_signs_df(spark, d), "intersection", test_size=0.2, seed=SEED)
    return out.select("intersection", "text_on_sign_exact", *fx.SIGN_ORDER, "split")


_SOME_GROUPS = """some_groups AS (
  SELECT l_orderkey, l_linenumber, CASE WHEN l_suppkey % 7 <> 0 THEN 'S' || l_suppkey END AS place FROM lineitem)"""


@register("group_split_nulls", X.with_ctes(_SOME_GROUPS, """splits AS (
  SELECT place, CASE WHEN rk < ceil(0.2::DOUBLE * total) THEN 'val' ELSE 'train' END AS split
  FROM (SELECT place, row_number() OVER (ORDER BY """ + q.hash32(str(SEED), "coalesce(place, '')") + """,
               place NULLS FIRST) - 1 AS rk, count(*) OVER () AS total
        FROM (SELECT DISTINCT place FROM some_groups)))""", body="""
SELECT g.l_orderkey, CAST(g.l_linenumber AS BIGINT) AS l_linenumber, g.place, s.split
FROM some_groups g JOIN splits s ON g.place IS NOT DISTINCT FROM s.place"""))
def q_group_split_nulls(spark, d):
    """A split by a group column with nulls: rows without a group are one
    group and keep their rows."""
    li = table(spark, d, "lineitem", ["l_orderkey", "l_linenumber", "l_suppkey"])
    place = F.when(F.col("l_suppkey") % 7 != 0, F.concat(F.lit("S"), F.col("l_suppkey").cast("string")))
    rows = li.select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), place.alias("place"))
    return S.split(rows, "place", test_size=0.2, seed=SEED)


@register("row_split", _split_sql("SELECT doc_id FROM documents", "doc_id"))
def q_row_split(spark, d):
    docs = table(spark, d, "documents", ["doc_id"])
    return S.split(docs, group_col=None, row_key="doc_id", test_size=0.2, seed=SEED)


@register("pick_rounds", X.with_ctes(X.ROUNDS, body=f"""
SELECT round_id, text FROM rounds ORDER BY {q.hash32('7', 'round_id')}, round_id LIMIT 10"""))
def q_pick_rounds(spark, d):
    return S.pick_rounds(fx.rounds(spark, d), 10, 7, "round_id").select("round_id", "text")
