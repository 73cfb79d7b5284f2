"""Fixture views over the driver tables (FIXTURES.md part 3).

The reference ships no data. These views re-shape the driver's TPC-H-like
tables into the inputs the pipeline expects -- survey signs, a coordinate
lookup, scored bags, a gazetteer, rounds and guesses. Each is arithmetic on
existing columns, so ``fixture_sql`` restates it in plain SQL for the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.sources.tables import table

# Source order of a sign: lineitem (orderkey, linenumber, partkey). Rows tied
# on all three carry the same text and code.
SIGN_ORDER = ["src_order", "src_line", "src_part"]
INVALID_GUESS_EVERY = 97     # every 97th event carries latitude 95


def _suppliers_with_nation(spark: SparkSession, d: str) -> DataFrame:
    sup = table(spark, d, "supplier", ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"])
    # nation has a fixed 25 rows, so broadcasting it is bounded.
    nat = table(spark, d, "nation", ["n_nationkey", "n_name"])
    return sup.join(F.broadcast(nat), sup.s_nationkey == nat.n_nationkey)


def signs(spark: SparkSession, d: str) -> DataFrame:
    """One sign per lineitem: ``intersection`` = nation and supplier written
    ``A & B`` for even orders and ``A - B`` for odd ones (one key, two
    spellings), text = part name, ``code_type`` = ``street_sign`` for
    ECONOMY parts, otherwise the lower-cased part type."""
    li = table(spark, d, "lineitem", ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"])
    part = table(spark, d, "part", ["p_partkey", "p_name", "p_type"])
    sn = _suppliers_with_nation(spark, d).select("s_suppkey", "s_name", "n_name")
    j = li.join(part, li.l_partkey == part.p_partkey).join(sn, li.l_suppkey == sn.s_suppkey)
    sep = F.when(F.col("l_orderkey") % 2 == 0, F.lit(" & ")).otherwise(F.lit(" - "))
    return j.select(
        F.concat(F.col("n_name"), sep, F.col("s_name")).alias("intersection"),
        F.col("p_name").alias("text_on_sign_exact"),
        F.when(F.col("p_type") == "ECONOMY", F.lit("street_sign"))
         .otherwise(F.lower(F.col("p_type"))).alias("code_type"),
        F.col("l_orderkey").alias("src_order"),
        F.col("l_linenumber").cast("bigint").alias("src_line"),
        F.col("l_partkey").alias("src_part"),
    )


def coord_lookup_raw(spark: SparkSession, d: str) -> DataFrame:
    """Coordinate sheet: one row per supplier ``NATION - Supplier#...``;
    suppliers with key % 10 = 9 are missing; key % 10 = 3 appear twice, the
    second 5 seconds of latitude further (first one wins). ``ord`` = key*10 + dup."""
    sn = _suppliers_with_nation(spark, d).where(F.col("s_suppkey") % 10 != 9)
    k = F.col("s_suppkey")
    dup = F.explode(F.when(k % 10 == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    rows = sn.select("s_suppkey", "s_name", "n_name", dup.alias("dup"))
    k, dup = F.col("s_suppkey"), F.col("dup")
    lat_sec = (((k * 13 + 50 * dup) % 600) / 10).cast("decimal(5,1)").cast("string")
    lon_sec = (((k * 17) % 600) / 10).cast("decimal(5,1)").cast("string")
    coord = F.concat((39 + k % 2).cast("string"), F.lit("°"), ((k * 7) % 60).cast("string"), F.lit("'"),
                     lat_sec, F.lit('"N '),
                     (104 + k % 2).cast("string"), F.lit("°"), ((k * 11) % 60).cast("string"), F.lit("'"),
                     lon_sec, F.lit('"W'))
    return rows.select(
        F.concat(F.col("n_name"), F.lit(" - "), F.col("s_name")).alias("intersection"),
        coord.alias("cd"),
        F.col("n_name").alias("city"),
        (80000 + k).cast("string").alias("zip"),
        (k * 10 + dup).alias("ord"),
    )


def _truth(k):
    lat = 39 + ((k * 37) % 1000) / 1000
    lon = -105 + ((k * 91) % 1000) / 1000
    return lat.cast("double"), lon.cast("double")


def scored(spark: SparkSession, d: str, with_initial: bool = False) -> DataFrame:
    """Scored bags with arithmetic predictions: one per lineitem, grouped by
    supplier (``intersection`` = ``S<suppkey>``); predictions are the truth
    plus order-dependent offsets of up to 0.05 degrees (doubled for the
    initial model)."""
    li = table(spark, d, "lineitem", ["l_orderkey", "l_suppkey", "l_linenumber", "l_partkey"])
    k, o = F.col("l_suppkey"), F.col("l_orderkey")
    lat, lon = _truth(k)
    dlat = (((o * 7) % 101) - 50) / 1000
    dlon = (((o * 13) % 101) - 50) / 1000
    cols = [
        F.concat(F.lit("S"), k.cast("string")).alias("intersection"),
        lat.alias("latitude"), lon.alias("longitude"),
        (lat + dlat).alias("predicted_latitude"), (lon + dlon).alias("predicted_longitude"),
    ]
    if with_initial:
        cols += [(lat + 2 * dlat).alias("initial_predicted_latitude"),
                 (lon + 2 * dlon).alias("initial_predicted_longitude")]
    return li.select(*cols)


def cities(spark: SparkSession, d: str) -> DataFrame:
    """Gazetteer: one city per supplier. ``name`` = ``C<k % (3n/5)>`` of n
    suppliers (shared names, growing with the table), country US for nation
    key % 3 = 0 else XX, population from the account balance (ties), aliases
    ``A<k % (2n/5)>`` and ``C<k % 7>``."""
    n = round_count(spark, d)
    sup = table(spark, d, "supplier", ["s_suppkey", "s_nationkey", "s_acctbal"])
    k = F.col("s_suppkey")
    lat, lon = _truth(k)
    return sup.select(
        F.concat(F.lit("C"), (k % max(1, n * 3 // 5)).cast("string")).alias("name"),
        F.when(F.col("s_nationkey") % 3 == 0, F.lit("US")).otherwise(F.lit("XX")).alias("countrycode"),
        lat.alias("latitude"), lon.alias("longitude"),
        F.floor(F.col("s_acctbal") / 1000).cast("bigint").alias("population"),
        F.array(F.concat(F.lit("A"), (k % max(1, n * 2 // 5)).cast("string")),
                F.concat(F.lit("C"), (k % 7).cast("string"))).alias("alternatenames"),
        k.alias("ord"),
    )


def city_points(spark: SparkSession, d: str) -> DataFrame:
    """Named points, one per supplier name, for the all-pairs distance job."""
    sup = table(spark, d, "supplier", ["s_suppkey", "s_name"])
    lat, lon = _truth(F.col("s_suppkey"))
    return sup.select(F.col("s_name").alias("name"), lat.alias("latitude"), lon.alias("longitude"))


def city_pair_list(spark: SparkSession, d: str) -> DataFrame:
    """Given pairs of city names, one per order: ``C<orderkey % (3n/5)>`` to
    ``C<custkey % (3n/5 + 2)>`` (some names are unknown, some pairs repeat or
    hold one name twice)."""
    m = max(1, round_count(spark, d) * 3 // 5)
    o = table(spark, d, "orders", ["o_orderkey", "o_custkey"])
    return o.select(F.concat(F.lit("C"), (F.col("o_orderkey") % m).cast("string")).alias("city_from"),
                    F.concat(F.lit("C"), (F.col("o_custkey") % (m + 2)).cast("string")).alias("city_to"))


def rounds(spark: SparkSession, d: str) -> DataFrame:
    """Playable rounds: one per supplier, ``round_id`` = supplier key, text =
    supplier name, truth as in :func:`scored`, model prediction = truth plus a
    supplier-dependent offset."""
    sup = table(spark, d, "supplier", ["s_suppkey", "s_name"])
    k = F.col("s_suppkey")
    lat, lon = _truth(k)
    return sup.select(
        k.alias("round_id"), F.col("s_name").alias("text"),
        lat.alias("latitude"), lon.alias("longitude"),
        (lat + (((k * 7) % 101) - 50) / 1000).alias("predicted_latitude"),
        (lon + (((k * 13) % 101) - 50) / 1000).alias("predicted_longitude"),
    )


def round_count(spark: SparkSession, d: str) -> int:
    """Number of rounds (one per supplier), from the table's footers."""
    return table(spark, d, "supplier").count()


def guesses(spark: SparkSession, d: str) -> DataFrame:
    return guesses_from_events(table(spark, d, "events", ["event_id", "ts", "user_id", "value"]), round_count(spark, d))


def guesses_from_events(ev: DataFrame, rounds: int) -> DataFrame:
    """Player guesses from ``events`` (batch or stream): round
    ``event_id % (rounds + 1)`` less 1 for every 89th event (so ids below 0 and
    ids without a round occur), latitude ``39 + value/490`` (95 -- invalid --
    for every 97th event), longitude ``-105 + (user_id % 100)/100`` (185 for
    every 83rd), and a text: blank for every 79th event, null for every 73rd,
    4001 characters for every 71st."""
    e = F.col("event_id")
    lat = F.when(F.col("event_id") % INVALID_GUESS_EVERY == 0, F.lit(95.0)) \
        .otherwise(39 + F.col("value") / 490)
    return ev.select(
        F.col("event_id").alias("guess_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.when(e % 89 == 0, F.lit(-1).cast("bigint")).otherwise(e % (rounds + 1)).alias("round_id"),
        lat.cast("double").alias("latitude"),
        F.when(e % 83 == 0, F.lit(185.0)).otherwise(-105 + (F.col("user_id") % 100) / 100).cast("double")
         .alias("longitude"),
        F.when(e % 79 == 0, F.lit(" \t ")).when(e % 73 == 0, F.lit(None).cast("string"))
         .when(e % 71 == 0, F.repeat(F.lit("x"), 4001)).otherwise(F.concat(F.lit("guess "), e.cast("string")))
         .alias("text"),
    )


def texts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents", ["doc_id", "text"])
