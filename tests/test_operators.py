"""Joins, ordinals, bags, splits, metrics."""

import math

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from waymark.operators import bags as B
from waymark.operators import join as J
from waymark.operators import metrics as M
from waymark.operators import split as S
from waymark.operators.filters import exclude_values, require_columns
from waymark.operators.ordinal import hash32, hash_digits, with_ordinal


def test_require_columns_lists_missing_sorted(spark):
    df = spark.createDataFrame([(1,)], "text_on_sign_exact int")
    with pytest.raises(ValueError, match=r"\['intersection', 'latitude', 'longitude'\]"):
        require_columns(df, ["intersection", "text_on_sign_exact", "latitude", "longitude"])


def test_exclude_keeps_null_keys(spark):
    df = spark.createDataFrame([("56th-pena",), ("x",), (None,)], "intersection string")
    assert sorted(r.intersection or "" for r in exclude_values(df, "intersection").collect()) == ["", "x"]


def test_ordinal_equals_row_number(spark):
    # One group holds most rows; the result must equal row_number() - 1.
    df = spark.range(5000).select((F.when(F.col("id") % 10 < 7, F.lit("hot"))
                                   .otherwise((F.col("id") % 13).cast("string"))).alias("g"),
                                  ((F.col("id") * 7919) % 5003).alias("k"))
    got = with_ordinal(df, ["k"], ["g"], name="o", num_partitions=8)
    want = df.withColumn("o", F.row_number().over(Window.partitionBy("g").orderBy("k")) - 1)
    assert got.exceptAll(want.select(*got.columns)).count() == 0
    assert got.count() == 5000
    glob = with_ordinal(df, ["k", "g"], name="o", num_partitions=8)
    assert sorted(r.o for r in glob.collect()) == list(range(5000))


def test_first_per_key_is_file_order(spark):
    df = spark.createDataFrame([("a", 3, "late"), ("a", 1, "early"), ("b", 2, "only")], "k string, ord int, v string")
    got = {r.k: r.v for r in J.first_per_key(df, "k", ["ord"]).collect()}
    assert got == {"a": "early", "b": "only"}


def test_attach_coordinates_rules(spark):
    signs = spark.createDataFrame([("Colfax & Broadway", "Stop!", "street_sign"),
                                   ("56th - Peña", "Pizza", "shop"),
                                   ("Nowhere St", "x", None)],
                                  "intersection string, text_on_sign_exact string, code_type string")
    lookup_raw = spark.createDataFrame([
        ("Colfax & Broadway", "39°44'24.7\"N 104°51'14.8\"W", "Denver", "80203", 1),
        ("colfax broadway", "39°0'0\"N 104°0'0\"W", "Denver", "80203", 2),
        ("56th - Pea", "40°0'0\"N 105°0'0\"W", "Denver", "80239", 3),
        ("56th - Pea", "41°0'0\"N 105°0'0\"W", "Denver", "80239", 4)],
        "intersection string, cd string, city string, zip string, ord int")
    out = J.attach_coordinates(signs, J.coord_lookup(lookup_raw, ["ord"]))
    got = {r.intersection: (r.text_on_sign, r.latitude) for r in out.collect()}
    # Sign side is keyed from cleaned text ('&' deleted) -> matches the lookup
    # row spelled without '&'; duplicate keys keep the first in file order.
    assert got["colfax broadway"] == ("stop", 39.0)
    assert got["56th-pea"] == ("pizza", 40.0)
    assert got["nowhere st"][1] is None


def _signs(spark):
    rows = []
    for g, n in [("hot", 400), ("b", 7), ("c", 3)]:
        for i in range(n):
            code = "street_sign" if i % 5 == 0 else "shop"
            rows.append((g, f"{g}-t{i % 11}", code, 39.0 + len(g), -105.0, i))
    return spark.createDataFrame(rows, "intersection string, text_on_sign_exact string, code_type string, "
                                       "latitude double, longitude double, ord int")


def test_bootstrap_bag_invariants(spark):
    signs = _signs(spark)
    bags = B.bootstrap_bags(signs, ["ord"], bag_size=4, samples=6, seed=7)
    rows = bags.collect()
    assert len(rows) == 3 * 6
    members = {g: {r.text_on_sign_exact for r in signs.where(F.col("intersection") == g).collect()}
               for g in ("hot", "b", "c")}
    for r in rows:
        parts = r.text.split(" | ")
        assert len(parts) == 4
        assert set(parts) <= members[r.intersection]
    # Guaranteed street texts: the first min(street_n, bag_size) street signs.
    c_bags = [r.text.split(" | ") for r in rows if r.intersection == "c"]
    assert all("c-t0" in b for b in c_bags)
    hot = [r for r in rows if r.intersection == "hot"][0]
    assert hot.raw_sign_count == 400 and hot.unique_sign_count == 11
    again = B.bootstrap_bags(signs.repartition(5), ["ord"], bag_size=4, samples=6, seed=7)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, rows))


@pytest.mark.parametrize("code", [None, "code_type"])
def test_bags_of_small_and_large_groups_agree(spark, monkeypatch, code):
    # Null texts, repeated texts, a null group and a group of a few long texts.
    nulls = [("b", None, "street_sign", 40.0, -105.0, 90), (None, "x", "shop", 1.0, 1.0, 91)]
    long = [("long", "y" * 700 + str(i), "street_sign", 42.0, -105.0, i) for i in range(3)]
    signs = _signs(spark).unionByName(spark.createDataFrame(nulls + long, _signs(spark).schema))
    seen = []
    for rows, size in [(8192, 1 << 20), (10, 1000), (0, 1 << 20)]:
        monkeypatch.setattr(B, "GROUP_ROWS", rows)
        monkeypatch.setattr(B, "GROUP_BYTES", size)
        bags = B.bootstrap_bags(signs, ["ord"], code_col=code, bag_size=9, samples=5, seed=3)
        seen.append(sorted(map(tuple, bags.collect())))
    assert len(seen[0]) == 4 * 5
    assert seen[0] == seen[1] == seen[2]
    counts = {r[0]: r[5:] for r in seen[0]}
    assert counts == {"hot": (11, 400), "b": (7, 8), "c": (3, 3), "long": (3, 3)}


@pytest.mark.parametrize("code", [None, "code_type"])
def test_small_groups_are_shuffled_once(spark, code):
    """The signs move by group, and once more for the street signs; neither
    slots nor draws move, and no draw joins the signs."""
    plan = B.bootstrap_bags(_signs(spark), ["ord"], code_col=code, bag_size=4, samples=6, seed=7)
    plan.collect()
    text = plan._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    # The third is the profile, where it is not broadcast.
    assert text.count(" Exchange hashpartitioning(") <= (3 if code else 2)
    assert "_wm_idx" not in text


@pytest.mark.parametrize("code", [None, "code_type"])
def test_bags_are_drawn_before_they_are_rows(spark, code):
    """The array of a group is not repeated per bag, the street signs come from
    it, and no hash is in the plan twice."""
    bags = B.bootstrap_bags(_signs(spark), ["ord"], code_col=code, bag_size=4, samples=6, seed=7)
    plan = bags._jdf.queryExecution().optimizedPlan().toString()
    per_bag = plan.split("Generate posexplode(")[0]
    assert "Generate" not in per_bag and "_wm_signs" not in per_bag
    assert "Window" not in plan
    assert plan.count("md5(") == (3 if code else 2)  # positions of street and of drawn slots, indices


@pytest.mark.parametrize("code", [None, "code_type"])
def test_bags_of_a_group_may_fill_several_rows(spark, monkeypatch, code):
    seen = []
    for size in (8 << 20, 250, 1):
        monkeypatch.setattr(B, "CHUNK_BYTES", size)
        bags = B.bootstrap_bags(_signs(spark), ["ord"], code_col=code, bag_size=4, samples=7, seed=7)
        seen.append(sorted(map(tuple, bags.collect())))
    assert len(seen[0]) == 3 * 7
    assert seen[0] == seen[1] == seen[2]


def test_hash_digits_sort_as_their_number(spark):
    df = spark.range(300).select(hash32("id", F.lit("s")).alias("n"), hash_digits("id", F.lit("s")).alias("d"))
    rows = df.collect()
    assert all(len(r.d) == 8 and int(r.d, 16) == r.n for r in rows)
    assert sorted(rows, key=lambda r: r.d) == sorted(rows, key=lambda r: r.n)


def test_collected_ordinals_are_the_numbers(spark):
    df = _signs(spark).withColumn("minus", -F.col("ord"))
    rows = with_ordinal(df, ["minus"], ["intersection"], name="o").collect()
    lists = with_ordinal(df, ["minus"], ["intersection"], name="o", collect="ord").collect()
    assert {(r.intersection, r.o): r.ord for r in rows} == {(r.intersection, k): v for r in lists for k, v in enumerate(r.o)}


def test_bootstrap_argument_errors(spark):
    signs = _signs(spark)
    with pytest.raises(ValueError):
        B.bootstrap_bags(signs, ["ord"], bag_size=0)
    with pytest.raises(ValueError):
        B.bootstrap_bags(signs, ["ord"], samples=0)


def test_group_split_invariants(spark):
    df = spark.range(1000).select((F.col("id") % 37).cast("string").alias("intersection"), "id")
    out = S.split(df, "intersection", test_size=0.2, seed=1992)
    per_group = out.groupBy("intersection").agg(F.countDistinct("split").alias("n"))
    assert per_group.where("n > 1").count() == 0
    n_val = out.where("split = 'val'").select("intersection").distinct().count()
    assert n_val == 8  # ceil(0.2 * 37)
    again = S.split(df.repartition(7), "intersection", test_size=0.2, seed=1992)
    assert out.exceptAll(again.select(*out.columns)).count() == 0
    with pytest.raises(ValueError):
        S.split(df.where("intersection = '1'"), "intersection")


def test_row_split_and_pick(spark):
    df = spark.range(35).withColumnRenamed("id", "k")
    out = S.split(df, group_col=None, row_key="k", test_size=0.2, seed=3)
    assert out.where("split = 'val'").count() == math.ceil(0.2 * 35)  # float arithmetic, as sklearn
    picks = S.pick_rounds(df, 5, 11, "k").collect()
    assert len(picks) == 5 and len({r.k for r in picks}) == 5


def test_quantiles_match_numpy(spark):
    rng = np.random.default_rng(0)
    vals = rng.gamma(2.0, 3.0, size=3001).round(3)
    rows = [("a" if i % 3 else "b", float(v), i) for i, v in enumerate(vals)] + [("c", 1.0, 9001), ("c", 2.0, 9002),
                                                                                ("c", 5.0, 9003), ("c", 9.0, 9004)]
    df = spark.createDataFrame(rows, "g string, v double, i int")
    got = {r.g: (r.q50, r.q90) for r in M.quantiles(df, "v", ["g"], [0.5, 0.9]).collect()}
    for g in ("a", "b"):
        x = np.array([v for gg, v, _ in rows if gg == g])
        assert got[g][0] == pytest.approx(np.percentile(x, 50)) and got[g][1] == pytest.approx(np.percentile(x, 90))
    assert got["c"] == (pytest.approx(3.5), pytest.approx(7.8))


def test_coord_stats_population_std(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (5.0, 5.0), (9.0, 5.0)], "latitude double, longitude double")
    st = M.fit_coord_stats(df)
    assert st["lat_std"] == pytest.approx(3.1124749, abs=1e-7)
    assert st["lon_std"] == 1.0


def test_group_and_clean_reference_case(spark):
    a = spark.createDataFrame([("alpha", "New York!"), ("alpha", "Boston?")], "group string, value string")
    b = spark.createDataFrame([("beta", "Chicago!")], "group string, value string")
    out = M.group_and_clean([a, b], columns=["value"], group_by="group").collect()
    assert [r.group for r in out] == ["alpha", "beta"] and [r["count"] for r in out] == [2, 1]
    import tempfile
    with tempfile.TemporaryDirectory() as folder:
        with open(f"{folder}/c.csv", "w", encoding="utf-8") as f:
            f.write('group,n,value\nalpha,7,"Den\nver"\n,8,NA\n')
        numbered = spark.createDataFrame([("beta", 3)], "group string, n int")
        rows = M.group_and_clean([a, f"{folder}/c.csv", numbered], columns=["value"]).collect()
        assert sorted(((r.group, r.value, r.n) for r in rows), key=str) == sorted([
            ("alpha", "new york", None), ("alpha", "boston", None), ("alpha", "den ver", "7"), (None, None, "8"), ("beta", None, "3")], key=str)
    null_group = spark.createDataFrame([(None, "x"), ("a", "y")], "group string, value string")
    got = M.group_agg(null_group, "group").collect()
    assert [r.group for r in got] == ["a", None]


def test_huber_loss_values(spark):
    df = spark.createDataFrame([(0.5, 0.0, 3.0, 0.0)], "p1 double, t1 double, p2 double, t2 double")
    r = M.huber_loss(df, ["p1", "p2"], ["t1", "t2"]).first()
    assert r.loss == pytest.approx((0.125 + 2.5) / 2)


def test_coord_stats_fit_on_train(spark):
    df = spark.createDataFrame([(1.0, 1.0, "train"), (3.0, 1.0, "train"), (100.0, 1.0, "val")],
                               "latitude double, longitude double, split string")
    assert M.fit_coord_stats(df, fit_on="train")["lat_mean"] == 2.0
    assert M.fit_coord_stats(df)["lat_mean"] == pytest.approx(104.0 / 3)
    with pytest.raises(ValueError):
        M.fit_coord_stats(df, fit_on="val")


def test_quantiles_approx_close_to_exact(spark):
    df = spark.range(20000).select((F.col("id") % 3).cast("string").alias("g"),
                                   ((F.col("id") * 7919) % 10007).cast("double").alias("v"), "id")
    exact = {r.g: r.q50 for r in M.quantiles(df, "v", ["g"], [0.5]).collect()}
    approx = {r.g: r.q50 for r in M.quantiles(df, "v", ["g"], [0.5], method="approx").collect()}
    assert set(exact) == set(approx)
    assert all(abs(exact[g] - approx[g]) <= 10007 / 1000 for g in exact)


def test_bracketed_quantiles_on_a_large_skewed_group(spark):
    rng = np.random.default_rng(5)
    hot = np.concatenate([np.full(40_000, 3.0), rng.normal(size=50_000), rng.exponential(size=1_000)])
    rows = spark.createDataFrame([(v,) for v in hot.tolist()], "v double").withColumn("g", F.lit(None).cast("string"))
    got = M.quantiles(rows, "v", ["g"], [0.01, 0.5, 0.9, 0.999]).first()
    assert [got.q1, got.q50, got.q90, got.q100] == pytest.approx(np.quantile(hot, [0.01, 0.5, 0.9, 0.999]).tolist())


def test_first_skips_nulls_in_order_and_median_buffers_nothing(spark):
    df = spark.createDataFrame([("a", 3, None, 1.0), ("a", 1, None, 4.0), ("a", 2, "x", 2.0), (None, 1, "y", 7.0), (None, 2, "z", None)],
                               "g string, o int, t string, v double")
    got = {r.g: (r.t, r.v) for r in M.group_agg(df, "g", {"t": "first", "v": "median"}, order_by="o").collect()}
    assert got == {"a": ("x", 2.0), None: ("y", 7.0)}


def test_refined_quantiles_meet_odd_values_groups_and_totals(spark):
    rng = np.random.default_rng(5)
    groups = {"clustered": np.concatenate([1 + rng.normal(0, 1e-12, 500), [1e300, -1e300]]),
              "equal": np.full(300, 7.25), "signed": rng.normal(0, 50, 700), "one": np.array([-0.0]),
              "wide": np.array([-1.7e308, 1.7e308, 5e-324, 0.0, 1.0]), None: rng.exponential(3, 400)}
    rows = [(g, float(v)) for g, values in groups.items() for v in values] + [("signed", None), ("signed", float("nan")), ("empty", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {r.g: r for r in M.quantiles(df, "v", ["g"], probs, counts=True, total={"g": "all of them"}).collect()}
    groups["all of them"] = np.concatenate(list(groups.values()))
    assert set(got) == set(groups)
    for g, values in groups.items():
        assert got[g].n == len(values)
        ordered = np.sort(values)
        for p in probs:
            at = p * (len(values) - 1)
            low, high = ordered[int(np.floor(at))], ordered[int(np.ceil(at))]
            assert got[g][f"q{round(p * 100)}"] == low + (high - low) * (at - np.floor(at)), (g, p)


def test_quantiles_exchange_cells_only(spark):
    df = spark.range(20000).selectExpr("id % 3 AS g", "cast(sqrt(id) AS double) AS v")
    from waymark.operators import quantiles as Q
    values = Q._as_values(df, "v", ["g"])
    hist = Q._counts(values.withColumn("cell", Q.first_cell(F.col("v"))), "part", "cell")
    plan = hist._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.index("Exchange") < plan.rindex("partial_count")


def test_row_split_takes_the_least_hashes_and_keeps_keys_together(spark):
    from waymark.operators import split as S
    rows = [(k, k % 7) for k in range(500)]
    df = spark.createDataFrame(rows, "k long, x long").repartition(4)
    rank = {r.k: r.h for r in df.select("k", hash32(F.lit(3), "k").alias("h")).collect()}
    val = {r.k for r in S.split(df, None, "k", 0.2, 3).collect() if r.split == "val"}
    assert val == set(sorted(rank, key=lambda k: (rank[k], k))[:100])
    again = spark.createDataFrame([(k % 40, k) for k in range(400)] + [(None, 1)] * 5, "k long, x long")
    sides = S.split(again, None, "k", 0.25, 3).groupBy("k").agg(F.countDistinct("split").alias("n")).collect()
    assert all(r.n == 1 for r in sides)
    plan = S.split(df, None, "k", 0.2, 3)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Sort" not in plan


def test_cleaning_is_in_the_plan_once(spark):
    from conftest import SF001
    from waymark.operators import bags
    from waymark.plans.pipeline import raw_signs_df
    plan = bags.intersection_profile(raw_signs_df(spark, SF001))._jdf.queryExecution().optimizedPlan().toString()
    # Two in each cleaned column, five in the key of the signs, five in the lookup's.
    assert plan.count("regexp_replace") == 14


def test_ordinal_partitions_do_not_follow_a_join_estimate(spark):
    """The planner's estimate of a join is the product of its sides; the
    ordinal of its groups is not dealt over as many tasks."""
    from conftest import SF01
    from waymark.operators.ordinal import _num_partitions
    from waymark.plans.pipeline import raw_signs_df
    signs = raw_signs_df(spark, SF01)
    assert int(signs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) > 100 << 30
    assert _num_partitions(signs.select("intersection").distinct(), None) == 8
    plan = B.sample_ordinal(signs, 2)._jdf.queryExecution().optimizedPlan().toString()
    assert "lineitem" not in plan and "l_orderkey" not in plan
