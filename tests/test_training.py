"""Training does not depend on the partitioning, and learns from texts that
carry the place."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from waymark.operators import baseline as L
from waymark.operators import head as H
from waymark.operators import metrics as M
from waymark.plans import q_model
from waymark.plans.q_model import bag_errors, baseline_errors, fixed_params, place_bags
from waymark.session import scratch_path


def _rows(spark, n=200):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=6).tolist(), 39 + (i % 7) / 10, -105 + (i % 5) / 10) for i in range(n)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, latitude double, longitude double")


def test_logs_agree_for_one_and_four_partitions(spark):
    rows = _rows(spark)
    stats = M.fit_coord_stats(rows)
    logs = []
    for parts in (1, 4):
        df = rows.repartition(parts)
        logs.append(H.fit_head(df.where("vec_id % 5 > 0"), df.where("vec_id % 5 = 0"), "embedding", stats, "vec_id", hidden=8,
                               dropout=0.2, epochs=2, lr=1e-2, batch_size=8, replicas=3, sync_steps=2)[2])
    assert np.allclose(logs[0], logs[1], rtol=1e-9)


def test_one_replica_is_plain_mini_batch_adamw(spark):
    stats = {"lat_mean": 39.3, "lat_std": 0.2, "lon_mean": -104.8, "lon_std": 0.2}
    rows = H.prepare_training(_rows(spark, 50), "embedding", "latitude", "longitude", stats, "vec_id", 1)
    deal = H.deal_rounds(rows, batch_size=8)
    assert (deal.n, deal.rounds, deal.replicas) == (50, 1, 1)
    zero = {k: np.zeros_like(v) for k, v in fixed_params(6).items()}
    start = {"params": fixed_params(6), "m": zero, "v": zero, "t": 0}
    after, n, loss = H.run_round(deal.of_round(0), "embedding", start, 1, 8, 1e-2, 1e-3, 0.1, 5)
    got = sorted(((r._wm_key, list(r.embedding), r._wm_zlat, r._wm_zlon) for r in rows.collect()))
    keys = np.array([r[0] for r in got])
    x, y = np.array([r[1] for r in got]), np.array([r[2:] for r in got])
    params, m, v, steps, want = H.local_updates(start, x, y, keys, 1, 8, 1e-2, 1e-3, 0.1, 5)
    assert after["t"] == steps == 7 and n == 50 and loss == pytest.approx(want)
    assert all(np.allclose(after["params"][k], params[k]) for k in params)


def test_updates_grow_with_the_rows_and_rounds_read_their_own_files(spark):
    rows = H.prepare_training(_rows(spark, 200), "embedding", "latitude", "longitude",
                              {"lat_mean": 39.3, "lat_std": 0.2, "lon_mean": -104.8, "lon_std": 0.2}, "vec_id", 1)
    deal = H.deal_rounds(rows, batch_size=4, replicas=2, sync_steps=5)
    assert (deal.n, deal.rounds, deal.replicas) == (200, 5, 2)
    assert sum(deal.of_round(k).count() for k in range(5)) == 200
    files = deal.of_round(2).select(F.input_file_name()).distinct().collect()
    assert files and all("round=2" in r[0] for r in files)
    plan = deal.of_round(2)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(round" in plan


def test_no_training_row_is_an_error(spark):
    rows = _rows(spark, 4)
    with pytest.raises(ValueError, match="no training row"):
        H.fit_head(rows.limit(0), rows, "embedding", M.fit_coord_stats(rows), "vec_id")
    with pytest.raises(ValueError, match="no training row"):
        L.fit_linear(rows.limit(0), "embedding", M.fit_coord_stats(rows))


def test_artifact_with_and_without_an_initial_model(spark):
    model = H.HeadModel(fixed_params(3), [1.0, 2.0], [0.5, 0.25], 4, 0.0, "my-encoder")
    path = H.save_model(spark, model, scratch_path(spark, "t-artifact"))
    trained, initial, base = H.load_models(spark, path)
    assert initial is None and base == trained.model_name == "my-encoder"
    H.save_model(spark, model, path, H.HeadModel(fixed_params(3, 1), [1.0, 2.0], [0.5, 0.25], 4, 0.0, "first-encoder"))
    trained, initial, base = H.load_models(spark, path)
    assert base == "first-encoder" and np.allclose(initial.params["w1"], fixed_params(3, 1)["w1"])


def test_head_and_linear_baseline_beat_the_mean_on_texts_that_name_the_place(spark):
    got = {(r.split, r.model): r for r in baseline_errors(place_bags(spark, SF001), "bag_id", 32, hidden=16, epochs=12, lr=3e-2,
                                                          dropout=0.0, batch_size=16).collect()}
    assert {s for s, _ in got} == {"train", "val"}
    for model in ("predicted", "linear"):
        assert got["val", model].mean_km < 0.5 * got["val", "mean_predictor"].mean_km, model


def test_the_linear_fit_shrugs_off_outliers(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 3))
    lat = 39 + x @ [0.1, -0.2, 0.05]
    lat[:20] += 50
    rows = spark.createDataFrame([(k, v.tolist(), float(a), float(-105.0 + 0.1 * v[0])) for k, (v, a) in enumerate(zip(x, lat, strict=True))],
                                 "vec_id long, embedding array<double>, latitude double, longitude double")
    stats = {"lat_mean": 39.0, "lat_std": 1.0, "lon_mean": -105.0, "lon_std": 1.0}
    model = L.fit_linear(rows, "embedding", stats, ridge=0.0)
    assert np.allclose(model.latitude[1], [0.1, -0.2, 0.05], atol=0.02)
    out = L.with_linear(rows.where("vec_id = 200"), "embedding", model).first()
    assert out.linear_latitude == pytest.approx(lat[200], abs=0.1)


def test_gradient_sums_equal_finite_differences(spark):
    rows = H.prepare_training(_rows(spark, 40), "embedding", "latitude", "longitude",
                              {"lat_mean": 39.3, "lat_std": 0.2, "lon_mean": -104.8, "lon_std": 0.2}, "vec_id", 1)
    params = fixed_params(6)
    grads, n, loss = H.gradient_sums(rows, "embedding", params)
    assert n == 40
    for name, at in (("w1", (2, 1)), ("b2", (0,)), ("w3", (1, 1))):
        moved = {k: v.copy() for k, v in params.items()}
        moved[name][at] += 1e-6
        assert (H.gradient_sums(rows, "embedding", moved)[2] - loss) / 1e-6 == pytest.approx(grads[name][at], abs=1e-4)


def test_main_flow_beats_the_mean_on_texts_that_carry_the_place(spark):
    rng = np.random.default_rng(8)
    rows = []
    for place in range(40):
        area = place % 4
        for sample in range(6):
            words = [f"area{area}"] * 3 + [f"w{rng.integers(50)}" for _ in range(3)]
            rows.append((f"p{place}", sample, " ".join(words), 39.0 + 0.2 * area, -105.0 + 0.2 * (area % 2)))
    bags = spark.createDataFrame(rows, "intersection string, sample_id int, text string, latitude double, longitude double")
    got = {(r.scope, r.level): r for r in bag_errors(bags, 32, hidden=16, dropout=0.0, epochs=12, lr=3e-2).collect()}
    stats = M.fit_coord_stats(bags)
    base = M.with_error_km(bags.withColumns({"predicted_latitude": F.lit(stats["lat_mean"]),
                                             "predicted_longitude": F.lit(stats["lon_mean"])})).agg(F.avg("error_km")).first()[0]
    assert got["val", "bag"].mean_km < 0.5 * base
    assert got["val", "intersection"].n == 8


def test_a_chain_of_rounds_equals_the_rounds_one_by_one(spark):
    rows = H.prepare_training(_rows(spark, 200), "embedding", "latitude", "longitude",
                              {"lat_mean": 39.3, "lat_std": 0.2, "lon_mean": -104.8, "lon_std": 0.2}, "vec_id", 1)
    deal = H.deal_rounds(rows, batch_size=4, replicas=3, sync_steps=2)
    assert deal.rounds > H.CHAINED
    zero = {k: np.zeros_like(v) for k, v in fixed_params(6).items()}
    start = {"params": fixed_params(6), "m": zero, "v": zero, "t": 0}
    got, n, loss = H.run_epoch(deal, "embedding", start, 1, 4, 1e-2, 1e-3, 0.1, 5)
    # By hand: every round's replicas from one state, averaged by their rows.
    state, want_loss, kept = start, 0.0, deal.rows.collect()
    for k in range(deal.rounds):
        parts = []
        for replica in range(deal.replicas):
            mine = [r for r in kept if (r["round"], r["replica"]) == (k, replica)]
            if mine:
                x, y = np.array([r.embedding for r in mine]), np.array([[r._wm_zlat, r._wm_zlon] for r in mine])
                parts.append((len(mine), H.local_updates(state, x, y, np.array([r._wm_key for r in mine]), 1, 4, 1e-2, 1e-3, 0.1, 5)))
        total = sum(p[0] for p in parts)
        if parts:
            mean = [{name: sum(w * p[at][name] for w, p in parts) / total for name in H.PARAM_NAMES} for at in range(3)]
            state = dict(zip(("params", "m", "v"), mean), t=state["t"] + round(sum(p[3] for _, p in parts) / len(parts)))
            want_loss += sum(p[4] for _, p in parts)
    assert n == 200 and loss == pytest.approx(want_loss) and got["t"] == state["t"]
    for part in ("params", "m", "v"):
        assert all(np.allclose(got[part][k], state[part][k], rtol=1e-9, atol=1e-15) for k in H.PARAM_NAMES)


def test_a_round_without_rows_hands_on_its_state(spark):
    rows = H.prepare_training(_rows(spark, 20), "embedding", "latitude", "longitude",
                              {"lat_mean": 39.3, "lat_std": 0.2, "lon_mean": -104.8, "lon_std": 0.2}, "vec_id", 1)
    deal = H.deal_rounds(rows, batch_size=8)
    zero = {k: np.zeros_like(v) for k, v in fixed_params(6).items()}
    start = {"params": fixed_params(6), "m": zero, "v": zero, "t": 3}
    after, n, loss = H.run_round(deal.of_round(9), "embedding", start, 1, 8, 1e-2, 1e-3, 0.1, 5, 2)
    assert (after["t"], n, loss) == (3, 0, 0) and all(np.array_equal(after["params"][k], start["params"][k]) for k in start["params"])


def test_the_plan_of_the_rounds_does_not_grow_with_them(spark):
    from waymark.plans.q_model import q_training_rounds
    plan = q_training_rounds(spark, SF001)._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan


def _dealt(spark, n=200):
    rows = H.prepare_training(_rows(spark, n), "embedding", "latitude", "longitude",
                              {"lat_mean": 39.3, "lat_std": 0.2, "lon_mean": -104.8, "lon_std": 0.2}, "vec_id", 1)
    zero = {k: np.zeros_like(v) for k, v in fixed_params(6).items()}
    return H.deal_rounds(rows, batch_size=4, replicas=3, sync_steps=1), {"params": fixed_params(6), "m": zero, "v": zero, "t": 0}


def test_an_epoch_is_one_job_however_many_rounds(spark):
    deal, start = _dealt(spark)
    assert deal.rounds > 2 * H.CHAINED
    args = (deal, "embedding", start, 1, 4, 1e-2, 1e-3, 0.1, 5)
    spark.sparkContext.setJobGroup("one-epoch", "")
    try:
        got = H.run_epoch(*args)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # The exchange of the rows by replica and the epoch itself.
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("one-epoch")) <= 3
    want = H.epoch_in_chains(*args)
    assert got[1] == want[1] == 200 and got[0]["t"] == want[0]["t"] and got[2] == pytest.approx(want[2])
    for part in ("params", "m", "v"):
        assert all(np.allclose(got[0][part][k], want[0][part][k], rtol=1e-9, atol=1e-15) for k in H.PARAM_NAMES)


def test_an_epoch_does_not_depend_on_its_tasks_nor_on_the_way_of_exchange(spark):
    deal, start = _dealt(spark, 40)
    args = (deal, "embedding", start, 1, 4, 1e-2, 1e-3, 0.1, 5)
    logs = [H.epoch_in_one_job(*args, tasks, folder) for tasks, folder in
            ((3, H._seen_by_python(scratch_path(spark, "t-exchange"))), (1, H._seen_by_python(scratch_path(spark, "t-exchange"))), (2, None))]
    for state, rows, loss in logs:
        assert rows == 40 and loss == logs[0][2]
        assert all(np.array_equal(state["params"][k], logs[0][0]["params"][k]) for k in H.PARAM_NAMES)
    assert H._seen_by_python("file:///a/b%20c") == "/a/b c" and H._seen_by_python("viewfs://store/a") is None


def test_the_texts_of_the_baselines_are_embedded_once(spark, monkeypatch):
    seen = []

    def split(df, **_):
        seen.append(df._jdf.queryExecution().executedPlan().toString())
        raise InterruptedError

    monkeypatch.setattr(q_model.S, "split", split)
    with pytest.raises(InterruptedError):
        baseline_errors(place_bags(spark, SF001), "bag_id", 8)
    assert "MapInArrow" not in seen[0] and "Scan parquet" in seen[0]
