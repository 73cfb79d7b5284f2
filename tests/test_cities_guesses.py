"""Gazetteer resolution, pairs, guesses."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from waymark.functions.geo import geodesic_km
from waymark.functions.geodesic_arrays import with_geodesic_arrays
from waymark.functions.md5_arrays import PairHash
from waymark.operators import cities as C
from waymark.operators import score as SC


def _cities(spark):
    rows = [
        ("New York City", "US", 40.71, -74.0, 8000000, ["NYC", "New York"], 1),
        ("Jamaica", "US", 40.69, -73.8, 200000, ["Jamaica Queens"], 2),
        ("Springfield", "US", 39.8, -89.6, 100, [], 3),
        ("Springfield", "US", 42.1, -72.5, 100, [], 4),
        ("Springfield", "XX", 1.0, 1.0, 10 ** 9, [], 5),
        ("Paris", "FR", 48.8, 2.35, 2000000, [], 6),
        ("Lyon", "US", 1.0, None, 5, ["Paris"], 7),
        ("Nulltown", "US", 10.0, 10.0, None, [], 8),
        ("Nulltown", "US", 11.0, 11.0, 0, [], 9),
    ]
    return spark.createDataFrame(rows, "name string, countrycode string, latitude double, longitude double, "
                                       "population long, alternatenames array<string>, ord long")


def test_resolution_rules(spark):
    cities = _cities(spark)
    q = spark.createDataFrame([(n,) for n in ["NYC", "New York City", "Springfield", "Paris", "Nulltown",
                                              "York", "Nowhere"]], "name string")
    got = {r.name: (r.latitude, r.ord) for r in C.resolve_cities(q, cities, "US").collect()}
    assert got["NYC"] == (40.71, 1)               # alias fallback
    assert got["York"] == (40.71, 1)              # alias search is a substring search
    assert got["Springfield"] == (39.8, 3)        # tie on population -> earlier row
    assert "Paris" not in got                     # exact hit abroad blocks the alias fallback
    assert got["Nulltown"] == (11.0, 9)           # null population counts as -1
    assert "Nowhere" not in got
    exact_only = {r.name for r in C.resolve_cities(q, cities, "US", contains=False).collect()}
    assert "York" not in exact_only and "NYC" in exact_only


def test_first_match_resolver(spark):
    q = spark.createDataFrame([("New York",), ("Paris",)], "name string")
    got = {r.name: r.ord for r in C.resolve_cities_first(q, _cities(spark), "US").collect()}
    assert got == {"New York": 1, "Paris": 7}


def test_pairs_and_chunks(spark):
    pts = spark.range(23).select(F.format_string("n%02d", "id").alias("name"),
                                 (F.col("id") * 1.0).alias("latitude"), (F.col("id") * 2.0).alias("longitude"))
    pairs = C.city_pairs(pts, block_size=4, carry=["latitude", "longitude"])
    rows = pairs.collect()
    assert len(rows) == 23 * 22 // 2
    assert all(r.city_from < r.city_to for r in rows)
    assert len({(r.city_from, r.city_to) for r in rows}) == len(rows)
    ch = C.pair_chunks(pairs, chunk_size=10).collect()
    assert sorted(r.pair_ordinal for r in ch) == list(range(253))
    d = C.pair_distances(pairs, "haversine")
    b = C.distance_bounds(d).first()
    assert b.min_km > 0 and b.max_km < 20037.5 and b.n_out_of_bounds == 0


def test_known_distance_pair(spark):
    cities = _cities(spark).where(F.col("ord") <= 2)
    d = {(r.city_from, r.city_to): r.distance for r in C.city_distances(cities, "US", "geodesic").collect()}
    assert d[("Jamaica", "New York City")] == pytest.approx(17.0, abs=1.0)


def test_validate_and_score_guesses(spark):
    rounds = spark.createDataFrame([(0, "t", 39.7, -105.0, 39.8, -105.1)],
                                   "round_id long, text string, latitude double, longitude double, "
                                   "predicted_latitude double, predicted_longitude double")
    g = spark.createDataFrame([(1, 0, 39.7, -105.0), (2, -1, 0.0, 0.0), (3, 0, 95.0, 0.0), (4, 0, 0.0, 200.0),
                               (5, 7, 0.0, 0.0)], "guess_id long, round_id long, latitude double, longitude double")
    reasons = {r.guess_id: r.reason for r in SC.validate_guesses(g, rounds).collect()}
    assert reasons == {1: None, 2: "round_id_negative", 3: "latitude_out_of_range",
                       4: "longitude_out_of_range", 5: "round_not_found"}
    s = SC.score_guesses(g, rounds).collect()
    assert len(s) == 1 and s[0].guess_error_km == 0.0 and s[0].model_error_km > 0
    texts = spark.createDataFrame([("ok",), ("   ",), ("",), ("x" * 4001,)], "text string")
    assert [r.r for r in texts.select(SC.text_reason("text").alias("r")).collect()] == \
        [None, "text_invalid", "text_invalid", "text_invalid"]


def test_stream_restart_is_exactly_once(spark):
    # A restarted query on the same checkpoint skips committed files and
    # processes only new ones.
    from waymark.session import scratch_path
    from waymark.streaming.guesses import guess_stream, run_to_table, score_guess_stream
    src = scratch_path(spark, "t-stream-src")
    rounds = spark.createDataFrame([(0, "t", 39.7, -105.0, 39.8, -105.1)],
                                   "round_id long, text string, latitude double, longitude double, "
                                   "predicted_latitude double, predicted_longitude double")
    schema = "guess_id long, round_id long, latitude double, longitude double"
    spark.createDataFrame([(1, 0, 39.7, -105.0), (2, 0, 39.0, -104.0)], schema).write.mode("append").parquet(src)
    out, ckpt = scratch_path(spark, "t-stream-out"), scratch_path(spark, "t-stream-ckpt")

    def run():
        stream = guess_stream(spark, src, spark.read.parquet(src).schema)
        run_to_table(score_guess_stream(stream, rounds), output_path=out, checkpoint=ckpt)
        return spark.read.parquet(out)

    assert run().count() == 2
    assert run().count() == 2          # restart: nothing reprocessed
    spark.createDataFrame([(3, 0, 40.0, -105.0)], schema).write.mode("append").parquet(src)
    assert sorted(r.guess_id for r in run().collect()) == [1, 2, 3]


def test_stream_with_rejects_survives_a_failure_in_mid_batch(spark, monkeypatch):
    # Scores plus rejects equal the batch twin after a batch that failed between its two writes.
    from waymark.session import scratch_path
    from waymark.streaming import guesses as G
    src = scratch_path(spark, "t-judge-src")
    rounds = spark.createDataFrame([(0, "t", 39.7, -105.0, 39.8, -105.1)],
                                   "round_id long, text string, latitude double, longitude double, "
                                   "predicted_latitude double, predicted_longitude double")
    schema = "guess_id long, round_id long, latitude double, longitude double"
    rows = [(k, 0 if k % 3 else 7, 39.0 + k / 10 if k % 4 else 95.0, -104.0) for k in range(12)]
    for k in range(3):
        spark.createDataFrame(rows[4 * k:4 * k + 4], schema).coalesce(1).write.mode("append").parquet(src)
    paths = [scratch_path(spark, n) for n in ("t-scores", "t-rejects", "t-judge-ckpt")]
    real, calls = G.judge_guesses, []

    def failing(batch, static):
        judged = real(batch, static)
        calls.append(1)
        if len(calls) == 2:  # the second batch's rejects cannot be written
            return judged.withColumn("reason", F.when(F.col("reason").isNull(), F.col("reason"))
                                     .otherwise(F.raise_error(F.lit("sink lost")).cast("string")))
        return judged

    def run():
        stream = G.guess_stream(spark, src, spark.read.parquet(src).schema, max_files_per_trigger=1)
        return G.run_with_rejects(stream, rounds, *paths)

    monkeypatch.setattr(G, "judge_guesses", failing)
    with pytest.raises(Exception, match="sink lost"):
        run()
    run()
    want = {r.guess_id: (r.reason, r.guess_error_km) for r in SC.judge_guesses(spark.createDataFrame(rows, schema), rounds).collect()}
    scores, rejects = (spark.read.parquet(p).collect() for p in paths[:2])
    got = [(r.guess_id, (None, r.guess_error_km)) for r in scores] + [(r.guess_id, (r.reason, None)) for r in rejects]
    assert len(got) == len(want) and dict(got) == want
    assert {r.batch for r in scores} | {r.batch for r in rejects} == {0, 1, 2}
    run()
    assert spark.read.parquet(paths[0]).count() == len(scores)


def test_contains_index_equals_a_plain_search(spark):
    import random
    rng = random.Random(6)
    word = lambda n: "".join(rng.choice("abñ ") for _ in range(n))
    texts = [(k % 40, word(rng.randint(0, 12))) for k in range(120)] + [(50, None), (51, "ab"), (51, "ab")]
    queries = [word(rng.randint(0, 6)) for _ in range(60)] + ["ab", "zzz", "", "a", "abñab"]
    got = C.contains_pairs(spark.createDataFrame([(q,) for q in queries], "q string"),
                           spark.createDataFrame(texts, "ord long, text string")).collect()
    want = {(q, o) for q in queries if q for o, t in texts if t and q in t}
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_distance_extent_equals_all_pairs(spark):
    import itertools
    import random

    from waymark.functions.geo import haversine_km
    from waymark.operators.extent import distance_extent
    rng = random.Random(3)
    sets = {"spread": [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(150)],
            "cluster": [(39 + rng.gauss(0, 1e-4), -105 + rng.gauss(0, 1e-4)) for _ in range(120)] + [(10.0, 10.0)],
            "equal": [(1.0, 2.0)] * 4 + [(1.0, 2.5)], "far": [(90.0, 0.0), (-90.0, 0.0), (0.0, 179.9), (0.0, -179.9)],
            "one": [(1.0, 1.0)], "none": []}
    for name, points in sets.items():
        df = spark.createDataFrame([*points, (None, 1.0)], "latitude double, longitude double")
        got = distance_extent(df).first()
        pairs = spark.createDataFrame([(*a, *b) for a, b in itertools.combinations(points, 2)] or [(None,) * 4],
                                      "a double, b double, c double, d double")
        want = pairs.where("a is not null").agg(F.min(haversine_km("a", "b", "c", "d")).alias("lo"), F.max(haversine_km("a", "b", "c", "d")).alias("hi"),
                                                F.count_if(haversine_km("a", "b", "c", "d") <= 0).alias("zero")).first()
        assert got.n_pairs == len(points) * (len(points) - 1) // 2 and got.n_out_of_bounds == want.zero, name
        assert got.min_km == (want.lo if want.lo is None else pytest.approx(want.lo, abs=1e-9)), name
        assert got.max_km == (want.hi if want.hi is None else pytest.approx(want.hi, abs=1e-9)), name


def _names(spark, n=23):
    return spark.range(n).select(F.format_string("n%02d", "id").alias("name"), (F.col("id") * 1.0).alias("latitude"),
                                 (F.col("id") * 2.0).alias("longitude"))


def test_pairs_are_never_broadcast_exploded_and_few_blocks_are_made(spark):
    plan = C.city_pairs(_names(spark))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastNestedLoop" not in plan
    assert -(-360_000 // C._block_size(360_000, None)) <= C.MOST_BLOCKS


def test_shuffled_pairs_move_once_as_two_numbers(spark, monkeypatch):
    monkeypatch.setattr(C, "BUCKET_PAIRS", 10)
    monkeypatch.setattr(C, "SORTED_PAIRS", 40)
    out = C.shuffle_pairs(_names(spark), 7)
    rows = out.collect()
    want = sorted((int(hashlib.md5(f"7|n{i:02d}|n{j:02d}".encode()).hexdigest()[:8], 16), f"n{i:02d}", f"n{j:02d}")
                  for i in range(23) for j in range(i + 1, 23))
    assert [(r.city_from, r.city_to) for r in sorted(rows, key=lambda r: r.shuffle_pos)] == [w[1:] for w in want]
    assert sorted(r.shuffle_pos for r in rows) == list(range(253))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in plan.splitlines() if "Exchange hashpartitioning(bucket" in line and "city_" in line]


def test_distances_of_arrays_equal_the_expression(spark):
    rng = random.Random(4)
    rows = [(rng.uniform(-90, 90), rng.uniform(-180, 180), rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(300)]
    rows += [(0.0, 0.0, 0.5, 179.7), (-30.0, 0.0, 29.9, 179.8), (0.0, 0.0, 0.0, 180.0), (90.0, 0.0, -90.0, 50.0), (1.0, 2.0, 1.0, 2.0),
             (0.0, 0.0, 0.0, 1.0), (39.5, -104.9, 39.6, -105.0), (None, 1.0, 2.0, 3.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").withColumn("e", geodesic_km("a", "b", "c", "d"))
    for r in with_geodesic_arrays(df, "g", "a", "b", "c", "d", ["a", "e"]).collect():
        assert (r.e is None and r.g is None) or r.g == pytest.approx(r.e, abs=1e-6), r


def test_hashes_of_arrays_equal_md5():
    rng = random.Random(1)
    texts = [None] + ["".join(rng.choice("abcé|") for _ in range(size)) for size in (0, 1, 5, 20, 50, 54, 55, 56, 60, 64, 119, 120, 199, 205, 400)]
    i, j = np.triu_indices(len(texts), 1)
    want = [int(hashlib.md5("|".join(["7", *(t for t in (texts[a], texts[b]) if t is not None)]).encode()).hexdigest()[:8], 16)
            for a, b in zip(i, j, strict=True)]
    assert PairHash(7, texts)(i, j).tolist() == want


def test_gaps_of_any_size_are_packed_and_found_again():
    lists = [[0, 1, 65534, 65535], [65535, 200_000, 400_001], [3], [131_070, 131_071]]
    first = np.cumsum([0, *(len(x) for x in lists)])[:-1]
    gaps, begin = C.pack_gaps(np.concatenate(lists), first)
    positions, each = C.unpack_gaps(gaps, np.diff(np.append(begin, len(gaps))))
    assert positions.tolist() == sum(lists, []) and each.tolist() == [len(x) for x in lists]


def test_the_shuffle_moves_two_bytes_a_pair(spark, monkeypatch):
    # Many blocks and buckets, names of unequal length and a null one.
    monkeypatch.setattr(C, "BUCKET_PAIRS", 400)
    monkeypatch.setattr(C, "SORTED_PAIRS", 3000)
    monkeypatch.setattr(C, "BLOCK_NAMES", 50)
    names = [None] + sorted("n" * (1 + k % 3) + str(k) for k in range(160))
    points = spark.createDataFrame([(t, 0.0, 0.0) for t in names], "name string, latitude double, longitude double")
    out = C.shuffle_pairs(points, 7)
    got = [(r.city_from, r.city_to) for r in out.orderBy("shuffle_pos").collect()]
    digest = lambda a, b: int(hashlib.md5("|".join(["7", *([a] if a else []), b]).encode()).hexdigest()[:8], 16)
    want = sorted((digest(a, b), k, m, a, b) for k, a in enumerate(names) for m, b in enumerate(names[k + 1:], k + 1))
    assert got == [w[3:] for w in want]
    plan = out._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning(bucket" in line]
    assert moved and "MapInArrow" in plan and "gaps" in plan
