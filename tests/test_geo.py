"""DMS parsing, haversine, Vincenty geodesic."""

import math

import random

import pytest
from pyspark.sql import functions as F

from waymark.functions.geo import WGS84_F, _far_km, dms_to_decimal, geodesic, haversine_km, with_dms, with_geodesic


def test_dms_to_decimal(spark):
    df = spark.createDataFrame([(1, 30, 0.0, "S"), (1, 30, 0.0, "n"), (104, 51, 14.8, "w")],
                               "d int, m int, s double, h string")
    got = [r.x for r in df.select(dms_to_decimal("d", "m", "s", "h").alias("x")).collect()]
    assert got[0] == pytest.approx(-1.5) and got[1] == pytest.approx(1.5)
    assert got[2] == pytest.approx(-(104 + 51 / 60 + 14.8 / 3600))


def test_parse_dms_uses_the_arithmetic(spark):
    # 39.74019444, -104.85411111 follow from d + m/60 + s/3600; the values in
    # the original's own test contradict its formula and are not used.
    df = spark.createDataFrame([("39°44'24.7\"N 104°51'14.8\"W",)], "c string")
    r = with_dms(df, "c").first()
    assert r.latitude == pytest.approx(39.74019444444, abs=1e-9)
    assert r.longitude == pytest.approx(-104.85411111111, abs=1e-9)


def test_parse_dms_permissive_and_strict(spark):
    rows = [("39°44'24.7\"N",), ("1°2'3\"N 4°5'6\"E 7°8'9\"N",), (None,), ("1°2'3.4.5\"N 4°5'6\"E",)]
    df = spark.createDataFrame(rows, "c string")
    got = with_dms(df, "c", mode="permissive").collect()
    assert all(r.latitude is None and r.longitude is None for r in got)
    bad = spark.createDataFrame([("39°44'24.7\"N",)], "c string")
    with pytest.raises(Exception, match="no coordinate pair"):
        with_dms(bad, "c", mode="strict").collect()
    ok_null = spark.createDataFrame([(None,)], "c string")
    assert with_dms(ok_null, "c", mode="strict").first().latitude is None


def test_haversine_golden_and_properties(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 1.0), (39.7, -104.9, 39.8, -105.0), (10.0, 10.0, 10.0, 10.0)],
                               "a double, b double, c double, d double")
    out = df.select(haversine_km("a", "b", "c", "d").alias("x"), haversine_km("c", "d", "a", "b").alias("y"),
                    haversine_km("a", "b", "c", "d", 6371.0).alias("z")).collect()
    assert out[0].x == pytest.approx(111.195080, abs=1e-6)
    assert all(r.x == pytest.approx(r.y, abs=1e-9) for r in out)
    assert out[2].x == 0.0
    assert out[0].z == pytest.approx(2 * 6371.0 * math.asin(math.sin(math.radians(0.5))), abs=1e-9)


def test_haversine_clamps_antipodes(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 180.0), (90.0, 0.0, -90.0, 0.0)], "a double, b double, c double, d double")
    got = [r.x for r in df.select(haversine_km("a", "b", "c", "d").alias("x")).collect()]
    assert all(not math.isnan(x) for x in got)
    assert got[0] == pytest.approx(math.pi * 6371.0088, rel=1e-12)


def test_geodesic_golden(spark):
    rows = [(0.0, 0.0, 0.0, 1.0), (12.0, 34.0, 12.0, 34.0),
            (-(37 + 57 / 60 + 3.72030 / 3600), 144 + 25 / 60 + 29.52440 / 3600,
             -(37 + 39 / 60 + 10.15610 / 3600), 143 + 55 / 60 + 35.38390 / 3600)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    got = [r.g for r in with_geodesic(df, "g", "a", "b", "c", "d").collect()]
    assert got[0] == pytest.approx(111.319491, abs=1e-6)
    assert got[1] == 0.0
    assert got[2] == pytest.approx(54.972271, abs=1e-6)


def test_geodesic_close_to_haversine(spark):
    df = spark.range(200).select(((F.col("id") * 7) % 170 - 85).cast("double").alias("a"),
                                 ((F.col("id") * 13) % 340 - 170).cast("double").alias("b"),
                                 ((F.col("id") * 11) % 170 - 85).cast("double").alias("c"),
                                 ((F.col("id") * 3) % 340 - 170).cast("double").alias("d"))
    out = with_geodesic(df, "g", "a", "b", "c", "d").withColumn("h", haversine_km("a", "b", "c", "d"))
    bad = out.where((F.col("h") > 1) & (F.col("h") < 19000) & (F.abs(F.col("g") - F.col("h")) > 0.006 * F.col("h")))
    assert bad.count() == 0
    assert out.where(F.col("g") >= 20037.5).count() == 0


def test_filter_on_geodesic_stays_small(spark):
    # Predicate pushdown may copy the distance into the filter: it must copy
    # one expression, not an unrolled chain (whose inlined size explodes).
    df = spark.range(50).select((F.col("id") * 0.1).alias("a"), F.lit(0.0).alias("b"),
                                F.lit(1.0).alias("c"), F.lit(1.0).alias("d"))
    out = with_geodesic(df, "g", "a", "b", "c", "d").where(F.col("g") < 300)
    assert len(out._jdf.queryExecution().optimizedPlan().toString()) < 200_000
    assert 0 < out.count() < 50


def test_nearly_antipodal_pairs_meet_published_distances(spark):
    # Values in metres by other methods, published with their algorithms.
    rows = [(0.0, 0.0, 0.5, 179.7, 19944127.421), (-30.0, 0.0, 29.9, 179.8, 19989832.827610),
            (0.0, 0.0, 0.0, 180.0, 20003931.4586), (0.0, 0.0, 0.5, 179.5, 19936288.578965),
            (0.5, -179.7, 0.0, 0.0, 19944127.421), (30.0, 179.8, -29.9, 0.0, 19989832.827610),
            (90.0, 0.0, -90.0, 50.0, 20003931.4586)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, m double")
    out = df.select("m", geodesic("a", "b", "c", "d").alias("g")).collect()
    for r in out:
        assert r.g.km * 1000 == pytest.approx(r.m, abs=2e-3)
    assert [r.g.searched for r in out[:3]] == [True, True, True]


def test_the_search_equals_the_iteration_where_both_settle(spark):
    rng = random.Random(2)
    rows = [(rng.uniform(-89, 89), rng.uniform(-180, 180), rng.uniform(-89, 89), rng.uniform(-180, 180)) for _ in range(60)]
    # (Short arcs of the equator itself are never searched: their azimuth is a step, not a root.)
    rows += [(0.5, 0.0, -0.3, 90.0), (10.0, 5.0, -10.0, 5.0), (45.0, 0.0, 45.0, 1e-3), (1.0, 2.0, 1.0, 2.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    u = lambda c: F.atan((1 - WGS84_F) * F.tan(F.radians(c)))
    far = _far_km(F.sin(u("a")), F.cos(u("a")), F.sin(u("c")), F.cos(u("c")), F.radians("d") - F.radians("b"))
    for r in df.select(geodesic("a", "b", "c", "d").alias("g"), far.alias("far")).collect():
        assert r.g.searched or r.far == pytest.approx(r.g.km, abs=1e-5)
