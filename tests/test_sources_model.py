"""Sheet scan, table sinks, model fitting and artifacts, streaming."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from waymark.operators import embed as E
from waymark.operators import head as H
from waymark.operators import metrics as M
from waymark.session import scratch_path
from waymark.sources.csvblocks import column_names
from waymark.sources.sheets import scan_sheets
from waymark.sources.tables import (prepare_bags, prepare_raw_signs, read_bags, read_raw_signs, read_table,
                                    write_table)


def test_header_names_blanks_like_the_original():
    assert column_names(["a", "", "b", "a"]) == ["a", "Unnamed: 1", "b", "a.1"]
    assert column_names(["a", "a.1", "a", "a"]) == ["a", "a.1", "a.2", "a.3"]


def test_scan_sheets_layouts(spark):
    root = scratch_path(spark, "t-sheets")
    base = spark.createDataFrame([("X & Y", "Stop", "street_sign", "n1", "u")],
                                 "intersection string, text_on_sign_exact string, code_type string, notes string, u string")
    write_table(base.select("intersection", "text_on_sign_exact"), f"{root}/one", fmt="csv")
    write_table(base.select("notes", "code_type", "text_on_sign_exact", F.col("u").alias(""), "intersection"),
                f"{root}/two", fmt="csv")
    write_table(base.select("intersection", "code_type"), f"{root}/skip", fmt="csv")
    write_table(base.where("false").select("intersection", "text_on_sign_exact"), f"{root}/empty", fmt="csv")
    write_table(base.select("intersection", "text_on_sign_exact"), f"{root}/one/nested", fmt="csv")
    write_table(spark.createDataFrame([("NA", "None")], "intersection string, text_on_sign_exact string"),
                f"{root}/tokens", fmt="csv")
    out = scan_sheets(spark, f"{root}/*/*.csv")
    rows = out.select("intersection", "text_on_sign_exact", "code_type", "notes", "`Unnamed: 3`").collect()
    assert sorted(map(tuple, rows), key=str) == sorted([
        ("X & Y", "Stop", None, None, None),
        ("X & Y", "Stop", "street_sign", "n1", "u"),
        (None, None, None, None, None)], key=str)


def test_raw_sign_and_bag_readers(spark):
    root = scratch_path(spark, "t-raw")
    df = spark.createDataFrame([("a", "  Stop ", 1.5, 2.5, "street_sign"), ("56th-pena", "x", 1.0, 1.0, None),
                                ("b", "   ", 1.0, 1.0, None), ("c", "ok", None, 1.0, None)],
                               "intersection string, text_on_sign_exact string, latitude double, longitude double, "
                               "code_type string")
    write_table(df, f"{root}/raw", fmt="csv")
    got = read_raw_signs(spark, f"{root}/raw").collect()
    assert [(r.intersection, r.text_on_sign_exact, r.latitude) for r in got] == [("a", "Stop", 1.5)]
    with pytest.raises(ValueError, match="lacks the columns"):
        prepare_raw_signs(df.drop("latitude"))
    bags = spark.createDataFrame([("a", 0, "t", 1.0, 2.0, 1, 1), ("a", 1, None, 1.0, 2.0, 1, 1)],
                                 "intersection string, sample_id int, text string, latitude double, longitude double, "
                                 "unique_sign_count int, raw_sign_count int")
    write_table(bags, f"{root}/bags", fmt="csv")
    assert read_bags(spark, f"{root}/bags").count() == 1
    with pytest.raises(ValueError, match="no usable row"):
        prepare_bags(bags.where("false"), error_if_empty=True)
    with pytest.raises(NotImplementedError):
        read_table(spark, "/x/sheet.xlsx")


def test_hashed_embedding_unit_length(spark):
    docs = spark.createDataFrame([(1, "Red ring, red bolt!"), (2, "   "), (3, "gear")], "doc_id long, text string")
    vecs = {r.doc_id: np.array(r.embedding) for r in E.embed_hashed(docs, "text", ["doc_id"], 16).collect()}
    assert set(vecs) == {1, 3}
    assert all(v.shape == (16,) and np.linalg.norm(v) == pytest.approx(1.0) for v in vecs.values())


def test_head_learns_signal_and_roundtrips(spark):
    # Vectors that do carry the location: a one-hot cluster code plus noise.
    rng = np.random.default_rng(4)
    rows = []
    for i in range(600):
        c = i % 6
        v = np.zeros(12)
        v[c] = 1.0
        v += rng.normal(0, 0.05, 12)
        rows.append((i, v.tolist(), 39.0 + 0.1 * c, -105.0 + 0.05 * (c % 3), "val" if i % 5 == 0 else "train"))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, latitude double, longitude double, "
                                     "split string").repartition(3)
    stats = M.fit_coord_stats(df)
    path = scratch_path(spark, "t-head")
    best, initial, log = H.fit_head(df.where("split = 'train'"), df.where("split = 'val'"), "embedding", stats,
                                    "vec_id", hidden=32, dropout=0.0, epochs=8, lr=1e-2, save_path=path)
    assert len(log) == 8 and log[-1][2] < log[0][2] * 1.5
    model = H.load_model(spark, path)
    assert all(np.allclose(model.params[k], best.params[k]) for k in H.PARAM_NAMES)
    val = df.where("split = 'val'")
    scored = M.with_error_km(H.predict(val, "embedding", model))
    err = scored.agg(F.avg("error_km")).first()[0]
    base = M.with_error_km(val.withColumns({"predicted_latitude": F.lit(stats["lat_mean"]),
                                            "predicted_longitude": F.lit(stats["lon_mean"])})).agg(
        F.avg("error_km")).first()[0]
    assert err < 0.5 * base
    assert model.n_params == 12 * 32 + 32 + 32 * 16 + 16 + 16 * 2 + 2


def test_reference_head_size():
    p = H.init_params(384, 256, 0)
    assert sum(v.size for v in p.values()) == 131714


def test_embed_with_user_encoder(spark):
    def _length_encoder():
        # A stand-in encoder: built once per worker, maps texts to 3-d vectors.
        def encode(texts):
            return [[len(t), t.count(" "), 1.0] for t in texts]
        return encode

    docs = spark.createDataFrame([(1, "a b c"), (2, None), (3, "xyz")], "doc_id long, text string")
    got = {r.doc_id: r.embedding for r in E.embed_with(docs, "text", _length_encoder, 3).collect()}
    assert got == {1: [5.0, 2.0, 1.0], 2: [0.0, 0.0, 1.0], 3: [3.0, 0.0, 1.0]}


def test_csv_raw_signs_into_bootstrap(spark):
    # File order travels as a struct (path, block, position) and drives the
    # ordinal, the street top-k and the draws.
    from waymark.operators.bags import bootstrap_bags
    root = scratch_path(spark, "t-raw-bags")
    rows = [("a", f"t{i}", 1.0, 2.0, "street_sign" if i < 2 else "shop") for i in range(6)] + \
           [("b", f"u{i}", 3.0, 4.0, "shop") for i in range(4)]
    df = spark.createDataFrame(rows, "intersection string, text_on_sign_exact string, latitude double, "
                                     "longitude double, code_type string").coalesce(1)
    write_table(df, f"{root}/raw", fmt="csv")
    signs = read_raw_signs(spark, f"{root}/raw")
    bags = bootstrap_bags(signs, ["ord"], bag_size=3, samples=4, seed=5).collect()
    assert len(bags) == 8
    for r in bags:
        parts = r.text.split(" | ")
        assert len(parts) == 3
        if r.intersection == "a":
            assert {"t0", "t1"} <= set(parts)  # the two street signs, first in file order
