"""Queries: hashed embeddings, head fitting, scoring, model comparison
(A8, I1, I2, I3, I4, I5, I6, and the linear baseline)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from waymark.functions.geo import haversine_km
from waymark.operators import bags as B
from waymark.operators import baseline as L
from waymark.operators import embed as E
from waymark.operators import head as H
from waymark.operators import metrics as M
from waymark.operators import split as S
from waymark.plans import fixtures as fx
from waymark.plans import sqltext as q
from waymark.plans.pipeline import raw_signs_df
from waymark.plans.registry import r6, register
from waymark.session import scratch_path
from waymark.sources.tables import stage_table, table

DIM = 64
EMBEDDING_DIM = 64  # width of the embeddings table
SEED = 1992
# The original's settings (dropout follows from the row's key, so runs agree).
FIT = dict(hidden=256, dropout=0.1, epochs=10, lr=5e-2, weight_decay=1e-3, batch_size=64, save_every=5, seed=SEED)

_WEIGHTS_SQL = f"""tok AS (SELECT doc_id, unnest(string_split({q.clean('text')}, ' ')) AS t FROM documents),
cnt AS (SELECT doc_id, {q.hash32('t')} % {DIM} AS bucket, count(*) AS n FROM tok WHERE t <> '' GROUP BY ALL),
weights AS (SELECT doc_id, bucket, n / sqrt(sum(n * n) OVER (PARTITION BY doc_id)) AS weight FROM cnt)"""


@register("embed_hashed", f"WITH {_WEIGHTS_SQL}\nSELECT doc_id, bucket, round(weight, 6) AS weight FROM weights")
def q_embed_hashed(spark, d):
    w = E.hashed_weights(table(spark, d, "documents", ["doc_id", "text"]), "text", ["doc_id"], DIM)
    return w.select("doc_id", "bucket", r6("weight"))


@register("embed_vectors", f"""WITH {_WEIGHTS_SQL}
SELECT d.doc_id, list(round(coalesce(w.weight, 0.0), 6) ORDER BY b.bucket) AS embedding
FROM (SELECT DISTINCT doc_id FROM weights) d
CROSS JOIN (SELECT range AS bucket FROM range(0, {DIM})) b
LEFT JOIN weights w ON w.doc_id = d.doc_id AND w.bucket = b.bucket
GROUP BY d.doc_id""")
def q_embed_vectors(spark, d):
    v = E.embed_hashed(table(spark, d, "documents", ["doc_id", "text"]), "text", ["doc_id"], DIM)
    return v.select("doc_id", F.transform("embedding", lambda x: F.round(x, 6)).alias("embedding"))


_ENCODER_SQL = ("length(t) / 1000.0", "(length(t) - length(replace(t, ' ', ''))) / 100.0",
                "(length(t) - length(replace(t, 'e', ''))) / 100.0")


@register("embed_encoder", f"""SELECT doc_id, [{', '.join(f'round({e}, 6)' for e in _ENCODER_SQL)}] AS embedding
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)""")
def q_embed_encoder(spark, d):
    """The encoder hook with an encoder that SQL can state: three counts."""
    def factory():
        return lambda texts: [[len(t) / 1000.0, t.count(" ") / 100.0, t.count("e") / 100.0] for t in texts]

    v = E.embed_with(table(spark, d, "documents", ["doc_id", "text"]), "text", factory, 3)
    return v.select("doc_id", F.transform("embedding", lambda x: F.round(x, 6)).alias("embedding"))


def embedding_bags(spark, d):
    """The embeddings table as bags: vector, and a location per label."""
    e = table(spark, d, "embeddings", ["vec_id", "embedding", "label"])
    return e.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"),
                    (39.5 + 0.03 * F.col("label")).cast("double").alias("latitude"),
                    (-105.2 + 0.05 * F.col("label")).cast("double").alias("longitude"))


def trained(spark, d):
    """Fit; the model is saved as a table and read back, so scoring goes
    through the artifact path."""
    bags = E.cache_embeddings(S.split(embedding_bags(spark, d), group_col=None, row_key="vec_id",
                                      test_size=0.2, seed=SEED), "embedding-bags")
    stats = M.fit_coord_stats(bags)
    path = scratch_path(spark, "head-model")
    _, _, log = H.fit_head(bags.where("split = 'train'"), bags.where("split = 'val'"),
                           "embedding", stats, "vec_id", save_path=path, **FIT)
    return bags, stats, path, log


@register("training_log")
def q_training_log(spark, d):
    _, _, _, log = trained(spark, d)
    return spark.createDataFrame(log, "epoch int, train_loss double, val_loss double, val_error_km double, lr double")


def _scored(spark, d):
    bags, stats, path, _ = trained(spark, d)
    return H.score_bags(bags, "embedding", H.load_model(spark, path)), stats, path


@register("score_bags")
def q_score_bags(spark, d):
    scored, _, _ = _scored(spark, d)
    return scored.select("vec_id", r6("predicted_latitude"), r6("predicted_longitude"), r6("error_km"), "split")


@register("fit_head_metrics")
def q_fit_head_metrics(spark, d):
    """Validation error of the fitted head next to the mean predictor's."""
    scored, stats, path, = _scored(spark, d)
    model = H.load_model(spark, path)
    base = haversine_km(F.lit(stats["lat_mean"]), F.lit(stats["lon_mean"]), "latitude", "longitude")
    return (scored.groupBy("split")
                  .agg(F.count(F.lit(1)).alias("n"), F.avg("error_km").alias("mean_km"),
                       F.avg(base).alias("mean_predictor_km"))
                  .withColumn("n_params", F.lit(model.n_params))
                  .select("split", "n", r6("mean_km"), r6("mean_predictor_km"), "n_params"))


@register("compare_models")
def q_compare_models(spark, d):
    """Initial (untrained) and trained heads scored side by side."""
    bags, _, path, _ = trained(spark, d)
    best, initial, _ = H.load_models(spark, path)
    both = H.score_bags(bags, "embedding", best, initial)
    return both.select("vec_id", "split", r6("predicted_latitude"), r6("predicted_longitude"),
                       r6("initial_predicted_latitude"), r6("initial_predicted_longitude"),
                       r6("error_km"), r6("initial_error_km"))


# A head with arithmetic weights, so that SQL can say what it predicts.
FIXED_HIDDEN = 4
FIXED_STATS = {"lat_mean": 39.5, "lon_mean": -105.0, "lat_std": 0.1, "lon_std": 0.2}


def _fixed(rows: int, cols: int, shift: int) -> list[list[float]]:
    return [[((i * 7 + j * 3 + shift) % 11 - 5) / 50 for j in range(cols)] for i in range(rows)]


def fixed_params(dim: int, shift: int = 0) -> dict:
    sizes = [(dim, FIXED_HIDDEN), (FIXED_HIDDEN, FIXED_HIDDEN // 2), (FIXED_HIDDEN // 2, 2)]
    params = {}
    for k, (n_in, n_out) in enumerate(sizes, 1):
        params[f"w{k}"] = np.array(_fixed(n_in, n_out, shift + k))
        params[f"b{k}"] = np.array(_fixed(1, n_out, shift + 5 * k)[0])
    return params


def fixed_model(dim: int, shift: int = 0) -> H.HeadModel:
    stats = FIXED_STATS
    return H.HeadModel(fixed_params(dim, shift), [stats["lat_mean"], stats["lon_mean"]],
                       [stats["lat_std"], stats["lon_std"]], FIXED_HIDDEN, 0.0)


def _layer_sql(name: str, source: str, x: str, params: dict, k: int, relu: bool) -> str:
    units = []
    for j, bias in enumerate(params[f"b{k}"].tolist()):
        dot = f"list_dot_product({x}, {params[f'w{k}'][:, j].tolist()}::DOUBLE[]) + {bias!r}"
        units.append(f"greatest({dot}, 0.0)" if relu else dot)
    return f"{name} AS (SELECT * EXCLUDE ({x}), [{', '.join(units)}] AS {x} FROM {source})"


def _forward_sql(source: str, dim: int, shift: int, tag: str) -> str:
    p = fixed_params(dim, shift)
    return ", ".join([_layer_sql(f"{tag}1", source, "x", p, 1, True), _layer_sql(f"{tag}2", f"{tag}1", "x", p, 2, True),
                      _layer_sql(f"{tag}3", f"{tag}2", "x", p, 3, False)])


_BAGS_SQL = """bags AS (SELECT vec_id, 39.5 + 0.03 * label AS latitude, -105.2 + 0.05 * label AS longitude,
                 CAST(embedding AS DOUBLE[]) AS x FROM embeddings)"""
_AT = {c: f"CAST({m} + {s} * x[{k}] AS DOUBLE)" for k, (c, m, s) in enumerate(
    (("latitude", 39.5, 0.1), ("longitude", -105.0, 0.2)), 1)}


def _side_by_side_sql(dim: int) -> str:
    """Predictions and errors of the fixed heads 0 and 1 beside each other."""
    sides = [f"{tag} AS (SELECT vec_id, latitude, longitude, {_AT['latitude']} AS plat, {_AT['longitude']} AS plon FROM {tag}3)"
             for tag in ("m", "n")]
    return f"""WITH {_BAGS_SQL}, {_forward_sql('bags', dim, 0, 'm')}, {_forward_sql('bags', dim, 1, 'n')}, {', '.join(sides)}
SELECT m.vec_id, round(m.plat, 6) AS predicted_latitude, round(m.plon, 6) AS predicted_longitude,
       round({q.haversine('m.plat', 'm.plon', 'm.latitude', 'm.longitude')}, 6) AS error_km,
       round(n.plat, 6) AS initial_predicted_latitude, round(n.plon, 6) AS initial_predicted_longitude,
       round({q.haversine('n.plat', 'n.plon', 'n.latitude', 'n.longitude')}, 6) AS initial_error_km
FROM m JOIN n USING (vec_id)"""


@register("score_fixed_models", _side_by_side_sql(EMBEDDING_DIM))
def q_score_fixed_models(spark, d):
    """Two heads with arithmetic weights scored side by side in one pass."""
    both = H.score_bags(embedding_bags(spark, d), "embedding", fixed_model(EMBEDDING_DIM), fixed_model(EMBEDDING_DIM, 1))
    return both.select("vec_id", *[r6(f"{p}{c}") for p in ("", "initial_") for c in
                                   ("predicted_latitude", "predicted_longitude", "error_km")])


def _gradient_sql(dim: int) -> str:
    """Gradient of the output biases: clipped residuals, halved and summed."""
    return f"""WITH {_BAGS_SQL}, z AS (SELECT vec_id, (latitude - 39.5) / 0.1 AS zlat, (longitude + 105.0) / 0.2 AS zlon, x FROM bags),
{_forward_sql('z', dim, 0, 'm')}, r AS (SELECT x[1] - zlat AS a, x[2] - zlon AS b FROM m3)
SELECT 'latitude' AS axis, round(sum(greatest(-1.0, least(1.0, a))) / 2, 6) AS gradient, count(*) AS n FROM r
UNION ALL
SELECT 'longitude', round(sum(greatest(-1.0, least(1.0, b))) / 2, 6), count(*) FROM r"""


@register("gradient_step", _gradient_sql(EMBEDDING_DIM))
def q_gradient_step(spark, d):
    """One gradient sum over all bags: the output layer's biases."""
    rows = H.prepare_training(embedding_bags(spark, d), "embedding", "latitude", "longitude", FIXED_STATS, "vec_id", SEED)
    grads, n, _ = H.gradient_sums(rows, "embedding", fixed_params(EMBEDDING_DIM))
    values = [(axis, round(float(g), 6), int(n)) for axis, g in zip(("latitude", "longitude"), grads["b3"], strict=True)]
    return spark.createDataFrame(values, "axis string, gradient double, n long")


ROUNDS = dict(batch_size=16, replicas=2, sync_steps=4)


def _rounds_sql(dim: int) -> str:
    share = ROUNDS["batch_size"] * ROUNDS["sync_steps"]
    huber = lambda e: f"CASE WHEN abs({e}) < 1 THEN 0.5 * ({e}) * ({e}) ELSE abs({e}) - 0.5 END"
    return f"""WITH {_BAGS_SQL},
z AS (SELECT {q.hash32(str(SEED), 'vec_id')} AS key, (latitude - 39.5) / 0.1 AS zlat, (longitude + 105.0) / 0.2 AS zlon, x FROM bags),
{_forward_sql('z', dim, 0, 'm')},
sizes AS (SELECT greatest(1, least({ROUNDS['replicas']}, CAST(ceil(count(*) / {share}.0) AS BIGINT))) AS replicas, count(*) AS n FROM z),
deal AS (SELECT replicas, greatest(1, CAST(ceil(n / ({share}.0 * replicas)) AS BIGINT)) AS rounds FROM sizes),
r AS (SELECT {q.hash32("'deal'", 'key')} % (rounds * replicas) AS place, replicas,
             ({huber('x[1] - zlat')} + {huber('x[2] - zlon')}) / 2 AS loss FROM m3, deal)
SELECT CAST(place // replicas AS INT) AS round, CAST(place % replicas AS INT) AS replica, count(*) AS n,
       round(sum(loss), 6) AS loss FROM r GROUP BY 1, 2"""


@register("training_rounds", _rounds_sql(EMBEDDING_DIM))
def q_training_rounds(spark, d):
    """One epoch over the dealt rounds with a fixed head: rows and summed loss
    of every round and replica, each round read from its own files."""
    rows = H.prepare_training(embedding_bags(spark, d), "embedding", "latitude", "longitude", FIXED_STATS, "vec_id", SEED)
    deal = H.deal_rounds(rows, **ROUNDS)
    # All rounds in one scan: a task reads files of one round each time, and the
    # plan does not grow with the rounds.
    losses = H.row_losses(deal.rows, "embedding", fixed_model(EMBEDDING_DIM), ["round", "replica"])
    return losses.groupBy("round", "replica").agg(F.count(F.lit(1)).alias("n"), r6(F.sum("loss"), "loss"))


def place_bags(spark, d):
    """Customers as bags whose texts name the place: nation, region and market
    segment; a location per nation."""
    n, r = table(spark, d, "nation"), table(spark, d, "region", ["r_regionkey", "r_name"])
    c = table(spark, d, "customer", ["c_custkey", "c_nationkey", "c_mktsegment"])
    key = F.col("n_nationkey")
    return (c.join(F.broadcast(n), c["c_nationkey"] == n["n_nationkey"])  # 25 rows
             .join(F.broadcast(r), n["n_regionkey"] == r["r_regionkey"])  # 5 rows
             .select(F.col("c_custkey").alias("bag_id"), F.col("n_name").alias("intersection"),
                     F.concat_ws(" ", "n_name", "r_name", "c_mktsegment").alias("text"),
                     (39.5 + 0.03 * key).cast("double").alias("latitude"),
                     (-105.2 + 0.05 * (key % 7)).cast("double").alias("longitude")))


@register("compare_baselines")
def q_compare_baselines(spark, d):
    """Mean error of the head, of the linear Huber baseline and of the mean
    predictor per split, on texts that name the place."""
    return baseline_errors(place_bags(spark, d), "bag_id", **FIT)


def baseline_errors(bags, key: str, dim: int = DIM, **fit):
    # Written before the split, whose scans would each embed the texts again.
    vectors = E.cache_embeddings(E.embed_hashed(bags, "text", bags.columns, dim), "baseline-embeddings")
    rows = E.cache_embeddings(S.split(vectors, group_col=None, row_key=key, test_size=0.2, seed=SEED), "baseline-vectors")
    stats = M.fit_coord_stats(rows)
    train = rows.where("split = 'train'")
    best, _, _ = H.fit_head(train, rows.where("split = 'val'"), "embedding", stats, key, **fit)
    linear = L.fit_linear(train, "embedding", stats)
    scored = L.with_linear(H.predict(rows, "embedding", best), "embedding", linear)
    return L.compare_errors(scored, stats).select("split", "model", "n", r6("mean_km"))


@register("sign_bags_to_errors")
def q_sign_bags_to_errors(spark, d):
    """The main flow at the original's settings: raw signs -> 100 bags of 8 a
    place -> hashed vectors -> split by place -> fit (hidden 256, 10 epochs,
    batches of 64) -> score -> error summary. The sign texts of the driver's
    tables say nothing about the place, so the errors are those of a model
    without a signal; tests/test_training.py holds it against texts that do."""
    signs = stage_table(raw_signs_df(spark, d), "raw-signs")
    return bag_errors(B.bootstrap_bags(signs, fx.SIGN_ORDER, bag_size=8, samples=100, seed=SEED), **FIT)


def bag_errors(bags, dim: int = DIM, **fit):
    """Error summary of a head fitted on bags (``intersection, sample_id,
    text, latitude, longitude``) with places held out."""
    keyed = bags.withColumn("bag_id", F.concat_ws("#", "intersection", "sample_id"))
    vectors = E.cache_embeddings(E.embed_hashed(keyed, "text", keyed.columns, dim), "bag-embeddings")
    rows = E.cache_embeddings(S.split(vectors, "intersection", test_size=0.2, seed=SEED), "bag-vectors")
    stats = M.fit_coord_stats(rows)
    best, _, _ = H.fit_head(rows.where("split = 'train'"), rows.where("split = 'val'"), "embedding", stats, "bag_id", **fit)
    scored = E.cache_embeddings(H.score_bags(rows, "embedding", best).drop("embedding"), "scored-bags")
    return M.error_summary(scored)
