"""Coordinate regression head: data-parallel fitting, scoring, artifacts
(I3, I4, I5, I6, A8).

The head is a d -> h -> h/2 -> 2 ReLU network on z-scored targets with Huber
loss and AdamW (decoupled weight decay), trained on mini-batches whose number
grows with the rows:

* the rows are dealt by a hash of their key to rounds and, within a round, to
  replicas, and written once, partitioned by round. A round reads its own
  files only (partition pruning);
* in a round every replica starts from the same weights and moments and makes
  one update per ``batch_size`` of its rows, in an order that a hash draws anew
  every epoch. A replica has about ``sync_steps`` batches a round, so a task
  holds that many rows of each of its replicas and one model;
* the mean of the replicas' weights and moments, weighted by their rows, opens
  the next round. An epoch is one job of barrier tasks, one per replica if the
  cluster has the cores: each streams the rows of its replicas in the order of
  the rounds, and after a round the tasks exchange their replicas' vectors by
  files in the shared checkpoint folder, so a round costs some milliseconds and
  not a job. Where Python does not see that folder they use ``allGather`` (a
  second a round), and without barrier tasks (dynamic allocation) the rounds are
  chained jobs over a state table. The driver receives one model an epoch.

Up to ``batch_size * sync_steps`` rows there is one replica, which is plain
mini-batch AdamW; beyond, replicas are added up to ``replicas``, and then
rounds. The deal depends on the keys alone, so results agree for any
partitioning up to the rounding of the sums.

Validation loss and mean km per epoch come from a distributed forward pass.
The best-validation weights are kept and persisted every ``save_every`` epochs
and at the end. Apart from that, the learning rate halves after ``patience``
epochs whose loss is not below the best one by the relative ``threshold``
(floor ``min_lr``).
"""

from __future__ import annotations

import base64
import json
import math
import os
import time
import uuid
from dataclasses import dataclass, field
from urllib.parse import unquote, urlsplit

import numpy as np
import pyarrow as pa
from pyspark import BarrierTaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymark.functions.batches import runs_of
from waymark.functions.geo import EARTH_RADIUS_KM
from waymark.operators.ordinal import hash32
from waymark.session import drop_path, scratch_path, ship_package
from waymark.sources.staging import nullable, stage_table

PARAM_NAMES = ["w1", "b1", "w2", "b2", "w3", "b3"]
BASE_ENCODER = "hashed-tokens"


# ---------------------------------------------------------------- network maths (NumPy, inside tasks)

def init_params(dim: int, hidden: int, seed: int) -> dict:
    """Uniform(-1/sqrt(fan_in), 1/sqrt(fan_in)) for weights and biases."""
    rng = np.random.default_rng(seed)
    sizes = [(dim, hidden), (hidden, hidden // 2), (hidden // 2, 2)]
    params = {}
    for k, (fan_in, fan_out) in enumerate(sizes, start=1):
        bound = 1.0 / math.sqrt(fan_in)
        params[f"w{k}"] = rng.uniform(-bound, bound, size=(fan_in, fan_out))
        params[f"b{k}"] = rng.uniform(-bound, bound, size=(fan_out,))
    return params


def dropout_mask(keys: np.ndarray, width: int, rate: float, seed: int) -> np.ndarray:
    """Scaled mask of shape (rows, width): a unit's fate is a hash of the row
    key, the unit and the seed."""
    mixed = (keys.astype(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15)
             + np.arange(1, width + 1, dtype=np.uint64) * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(seed))
    mixed = (mixed ^ (mixed >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    mixed = (mixed ^ (mixed >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((mixed >> np.uint64(11)) * 2.0 ** -53 >= rate) / (1 - rate)


def forward(params: dict, x: np.ndarray, dropout: float = 0.0, keys=None, seed: int = 0):
    def mask(h, layer):
        return dropout_mask(keys, h.shape[1], dropout, 2 * seed + layer) if dropout and keys is not None else None

    h1 = np.maximum(x @ params["w1"] + params["b1"], 0.0)
    m1 = mask(h1, 0)
    a1 = h1 * m1 if m1 is not None else h1
    h2 = np.maximum(a1 @ params["w2"] + params["b2"], 0.0)
    m2 = mask(h2, 1)
    a2 = h2 * m2 if m2 is not None else h2
    out = a2 @ params["w3"] + params["b3"]
    return out, (x, h1, m1, a1, h2, m2, a2)


def huber_elements(r: np.ndarray, delta: float = 1.0) -> np.ndarray:
    a = np.abs(r)
    return np.where(a < delta, 0.5 * r * r, delta * (a - 0.5 * delta))


def backward(params: dict, cache, out: np.ndarray, y: np.ndarray, delta: float = 1.0) -> dict:
    """Gradients of the rows' losses (each the mean over outputs), summed."""
    x, h1, m1, a1, h2, m2, a2 = cache
    g_out = np.clip(out - y, -delta, delta) / out.shape[1]
    grads = {"w3": a2.T @ g_out, "b3": g_out.sum(0)}
    g_a2 = g_out @ params["w3"].T
    g_h2 = (g_a2 * m2 if m2 is not None else g_a2) * (h2 > 0)
    grads["w2"], grads["b2"] = a1.T @ g_h2, g_h2.sum(0)
    g_a1 = g_h2 @ params["w2"].T
    g_h1 = (g_a1 * m1 if m1 is not None else g_a1) * (h1 > 0)
    grads["w1"], grads["b1"] = x.T @ g_h1, g_h1.sum(0)
    return grads


def adamw_step(params, grad, m, v, t, lr, weight_decay, b1=0.9, b2=0.999, eps=1e-8):
    """One update of flat arrays, in place."""
    params *= 1 - lr * weight_decay
    m *= b1
    m += (1 - b1) * grad
    v *= b2
    v += (1 - b2) * grad ** 2
    step = lr * (m / (1 - b1 ** t))
    scale = np.sqrt(v / (1 - b2 ** t))
    scale += eps
    step /= scale
    params -= step


def haversine_np(p_lat, p_lon, t_lat, t_lon, radius=EARTH_RADIUS_KM):
    p1, p2 = np.radians(p_lat), np.radians(t_lat)
    a = np.sin((p2 - p1) / 2) ** 2 + np.cos(p1) * np.cos(p2) * np.sin(np.radians(t_lon - p_lon) / 2) ** 2
    return 2 * radius * np.arcsin(np.sqrt(np.minimum(1.0, a)))


def _flatten(d: dict) -> np.ndarray:
    return np.concatenate([d[k].ravel() for k in PARAM_NAMES])


def _unflatten(vec: np.ndarray, like: dict) -> dict:
    out, pos = {}, 0
    for k in PARAM_NAMES:
        n = like[k].size
        out[k] = vec[pos:pos + n].reshape(like[k].shape)
        pos += n
    return out


def vectors_of(column) -> np.ndarray:
    """Rows x dimensions of an Arrow list column, as one array."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if not n:
        return np.zeros((0, 0))
    if column.null_count:
        raise ValueError("a row has no vector")
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(n, -1)


def _numbers(batch, *names: str) -> np.ndarray:
    return np.stack([batch.column(n).to_numpy(zero_copy_only=False) for n in names], 1).astype(np.float64, copy=False)


# ---------------------------------------------------------------- model object and artifacts

@dataclass
class HeadModel:
    params: dict
    coord_mean: list
    coord_std: list
    hidden_dim: int
    dropout: float
    model_name: str = BASE_ENCODER
    extra: dict = field(default_factory=dict)

    @property
    def n_params(self) -> int:
        return int(sum(self.params[k].size for k in PARAM_NAMES))

    def metadata(self) -> dict:
        return {"coord_mean": list(map(float, self.coord_mean)), "coord_std": list(map(float, self.coord_std)),
                "hidden_dim": self.hidden_dim, "dropout": self.dropout, "model_name": self.model_name}


def _write_model(spark: SparkSession, model: HeadModel, path: str) -> None:
    rows = [(k, list(model.params[k].shape), model.params[k].ravel().astype(float).tolist()) for k in PARAM_NAMES]
    schema = "name string, shape array<int>, values array<double>"
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/weights")
    spark.createDataFrame([(json.dumps(model.metadata()),)], "config string") \
        .coalesce(1).write.mode("overwrite").parquet(f"{path}/config")


def save_model(spark: SparkSession, model: HeadModel, path: str, initial: HeadModel | None = None) -> str:
    """Weights as a Parquet table ``(name, shape, values)`` plus a one-row
    metadata table, and the initial model beside them if there is one --
    model-sized, written by Spark like any table. Without ``initial`` an
    initial model that the artifact holds stays."""
    _write_model(spark, model, path)
    if initial is not None:
        _write_model(spark, initial, f"{path}/initial")
    return path


def load_model(spark: SparkSession, path: str) -> HeadModel:
    meta = json.loads(spark.read.parquet(f"{path}/config").first()["config"])
    params = {r["name"]: np.asarray(r["values"], dtype=np.float64).reshape(r["shape"])
              for r in spark.read.parquet(f"{path}/weights").collect()}
    return HeadModel(params, meta["coord_mean"], meta["coord_std"], meta["hidden_dim"], meta["dropout"],
                     meta.get("model_name", BASE_ENCODER))


def load_models(spark: SparkSession, path: str) -> tuple[HeadModel, HeadModel | None, str]:
    """``(trained, initial, base encoder)``. An artifact without an initial
    model gives None for it, and the encoder that the initial predictions are
    to use is then the base one that the trained model names."""
    trained = load_model(spark, path)
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/initial/config")
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return trained, None, trained.model_name
    initial = load_model(spark, f"{path}/initial")
    return trained, initial, initial.model_name


# ---------------------------------------------------------------- distributed pieces

def _tree_sum(df: DataFrame, col: str, weight_cols, widths=(1024, 32, 4)) -> tuple:
    """Element-wise sum of the array column over all rows (plus plain sums of
    ``weight_cols``). Rows are summed in ``widths`` groups, level by level, so
    the driver receives at most as many arrays as the last width says."""
    names = [col, *weight_cols]
    schema = ", ".join(["_wm_b bigint", f"{col} array<double>", *[f"{c} double" for c in weight_cols]])

    def add(part: pa.Table) -> pa.Table:
        vec = vectors_of(part.column(col)).sum(0)
        sums = [float(np.sum(part.column(c).to_numpy())) for c in weight_cols]
        return pa.table({"_wm_b": [part.column("_wm_b")[0].as_py()], col: pa.array([vec]),
                         **{c: [s] for c, s in zip(weight_cols, sums, strict=True)}})

    level = df.select(F.monotonically_increasing_id().alias("_wm_b"), *names)
    for width in widths:
        # The id of a partition's only row is its number, shifted.
        level = (level.withColumn("_wm_b", F.pmod(F.xxhash64("_wm_b"), F.lit(width)).cast("bigint"))
                      .groupBy("_wm_b").applyInArrow(add, schema))
    rows = level.select(*names).toArrow()
    if not rows.num_rows:
        return None, [0.0] * len(weight_cols)
    return vectors_of(rows.column(col)).sum(0), [float(np.sum(rows.column(c).to_numpy())) for c in weight_cols]


TARGETS = ("_wm_zlat", "_wm_zlon")


def gradient_sums(df: DataFrame, feat: str, params: dict, dropout: float = 0.0, seed: int = 0) -> tuple:
    """``(gradients summed over all rows, rows, loss sum)`` of prepared rows."""
    spark = df.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(params)

    def run(batches):
        total, rows, loss = None, 0.0, 0.0
        for batch in batches:
            if not batch.num_rows:
                continue
            y = _numbers(batch, *TARGETS)
            out, cache = forward(shared.value, vectors_of(batch.column(feat)), dropout, batch.column("_wm_key").to_numpy(), seed)
            grads = _flatten(backward(shared.value, cache, out, y))
            total = grads if total is None else total + grads
            rows += batch.num_rows
            loss += float(huber_elements(out - y).mean(axis=1).sum())
        if total is not None:
            yield pa.record_batch([pa.array([total]), pa.array([rows]), pa.array([loss])], ["vec", "rows", "loss"])

    total, (rows, loss) = _tree_sum(df.mapInArrow(run, "vec array<double>, rows double, loss double"), "vec",
                                    ["rows", "loss"])
    shared.destroy()
    return (None if total is None else _unflatten(total, params)), rows, loss


def row_losses(df: DataFrame, feat: str, model: HeadModel, carry=()) -> DataFrame:
    """``carry`` columns, ``loss`` (mean Huber loss over the outputs) and ``km``
    of prepared rows."""
    spark, carry = df.sparkSession, list(carry)
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            m, y = shared.value, _numbers(batch, *TARGETS)
            out, _ = forward(m.params, vectors_of(batch.column(feat)))
            mean, sd = np.asarray(m.coord_mean), np.asarray(m.coord_std)
            pred, true = out * sd + mean, y * sd + mean
            km = haversine_np(pred[:, 0], pred[:, 1], true[:, 0], true[:, 1])
            yield pa.record_batch([*[batch.column(c) for c in carry], pa.array(huber_elements(out - y).mean(axis=1)),
                                   pa.array(km)], [*carry, "loss", "km"])

    kinds = [f"{c} {df.schema[c].dataType.simpleString()}" for c in carry]
    return df.select(feat, *TARGETS, *carry).mapInArrow(run, ", ".join([*kinds, "loss double", "km double"]))


def _evaluate(df: DataFrame, feat: str, model: HeadModel) -> tuple:
    """Distributed forward pass: (mean Huber loss, mean km, rows)."""
    r = row_losses(df, feat, model).agg(F.sum("loss").alias("loss"), F.sum("km").alias("km"),
                                        F.count(F.lit(1)).alias("n")).first()
    return (r["loss"] / r["n"], r["km"] / r["n"], r["n"]) if r["n"] else (float("nan"), float("nan"), 0)


def prepare_training(df: DataFrame, feat: str, lat: str, lon: str, stats: dict, key_col: str,
                     seed: int) -> DataFrame:
    """Features, z-scored targets and a seeded key per row."""
    return df.select(
        F.col(feat),
        ((F.col(lat) - stats["lat_mean"]) / stats["lat_std"]).alias("_wm_zlat"),
        ((F.col(lon) - stats["lon_mean"]) / stats["lon_std"]).alias("_wm_zlon"),
        hash32(F.lit(seed), key_col).alias("_wm_key"))


@dataclass
class Deal:
    """Prepared rows written by ``round``, each with its ``replica``."""
    rows: DataFrame
    n: int
    rounds: int
    replicas: int

    def of_round(self, k: int) -> DataFrame:
        return self.rows.where(F.col("round") == k)


def deal_rounds(prepared: DataFrame, batch_size: int = 64, replicas: int = 8, sync_steps: int = 16) -> Deal:
    """Deal prepared rows to rounds and replicas (by the hash of their key) and
    write them, partitioned by round."""
    n, share = prepared.count(), batch_size * sync_steps
    replicas = max(1, min(replicas, -(-n // share)))
    rounds = max(1, -(-n // (share * replicas)))
    place = hash32(F.lit("deal"), "_wm_key") % (rounds * replicas)
    dealt = prepared.withColumns({"replica": (place % replicas).cast("int"), "round": F.floor(place / replicas).cast("int")})
    path = scratch_path(prepared.sparkSession, "training-rounds")
    dealt.repartition("round", "replica").write.partitionBy("round").parquet(path)
    # One listing for all rounds.
    return Deal(prepared.sparkSession.read.schema(nullable(dealt.schema)).parquet(path), n, rounds, replicas)


def _draw(keys: np.ndarray, epoch: int) -> np.ndarray:
    """The order of a replica's rows in an epoch."""
    mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(epoch) * np.uint64(0xBF58476D1CE4E5B9)
    mixed = (mixed ^ (mixed >> np.uint64(30))) * np.uint64(0x94D049BB133111EB)
    return np.lexsort((keys, mixed ^ (mixed >> np.uint64(31))))


def local_updates(state: dict, x, y, keys, epoch: int, batch_size: int, lr: float, weight_decay: float,
                  dropout: float, seed: int) -> tuple:
    """Mini-batch updates of one replica: ``(params, m, v, updates, loss sum)``."""
    flat, m, v = (_flatten(state[part]) for part in ("params", "m", "v"))
    params = _unflatten(flat, state["params"])  # views of the flat array
    order, loss, t = _draw(keys, epoch), 0.0, state["t"]
    for begin in range(0, len(order), batch_size):
        rows = order[begin:begin + batch_size]
        out, cache = forward(params, x[rows], dropout, keys[rows], seed + epoch)
        loss += float(huber_elements(out - y[rows]).mean(axis=1).sum())
        grad = _flatten(backward(params, cache, out, y[rows]))
        grad /= len(rows)
        t += 1
        adamw_step(flat, grad, m, v, t, lr, weight_decay)
    return params, _unflatten(m, params), _unflatten(v, params), t - state["t"], loss


#: Rounds that one job chains; the state is then written below the checkpoint folder.
CHAINED = 8

_STATE = "vec array<double>, t bigint, rows double, loss double"


def state_table(spark: SparkSession, state: dict) -> DataFrame:
    """The training state (params, m, v, t) as a table of one row, with the
    rows and the loss sum of the epoch so far (none)."""
    vec = np.concatenate([_flatten(state[part]) for part in ("params", "m", "v")])
    row = pa.table({"vec": pa.array([vec], pa.list_(pa.float64())), "t": pa.array([state["t"]], pa.int64()),
                    "rows": [0.0], "loss": [0.0]})
    return spark.createDataFrame(row, _STATE)


def read_state(states: DataFrame, like: dict) -> tuple:
    """``(state, rows, loss sum)`` of a state table; ``like`` has the shapes."""
    row = states.select("vec", "t", "rows", "loss").toArrow()
    vec, size = vectors_of(row.column("vec"))[0], sum(a.size for a in like.values())
    parts = {p: _unflatten(vec[k * size:(k + 1) * size], like) for k, p in enumerate(("params", "m", "v"))}
    return {**parts, "t": row.column("t")[0].as_py()}, row.column("rows")[0].as_py(), row.column("loss")[0].as_py()


def next_state(rows: DataFrame, states: DataFrame, feat: str, shapes: dict, replicas: int, epoch: int, batch_size: int,
               lr: float, weight_decay: float, dropout: float, seed: int) -> DataFrame:
    """The state table after one round. The replicas meet copies of the state
    in a cogroup and their mean is taken in one task (``replicas`` vectors, one
    at a time), so no vector passes the driver."""
    size = sum(math.prod(shape) for shape in shapes.values())

    def replica(part: pa.Table, copy: pa.Table) -> pa.Table:
        vec = vectors_of(copy.column("vec"))[0]
        t, n, loss, steps = copy.column("t")[0].as_py(), part.num_rows, 0.0, 0
        if n:
            like = {k: np.empty(shape) for k, shape in shapes.items()}
            state = {p: _unflatten(vec[k * size:(k + 1) * size], like) for k, p in enumerate(("params", "m", "v"))}
            params, m, v, steps, loss = local_updates(
                {**state, "t": t}, vectors_of(part.column(feat)), _numbers(part, *TARGETS), part.column("_wm_key").to_numpy(),
                epoch, batch_size, lr, weight_decay, dropout, seed)
            vec = np.concatenate([_flatten(params), _flatten(m), _flatten(v)])
        return pa.table({"replica": copy.column("replica"), "vec": pa.array([vec], pa.list_(pa.float64())), "t": pa.array([t], pa.int64()),
                         "n": [float(n)], "loss": [float(loss)], "steps": [float(steps)],
                         "rows_before": copy.column("rows"), "loss_before": copy.column("loss")})

    def mean(batches):
        total, n, loss, steps, used, first = None, 0.0, 0.0, 0.0, 0, None
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                value = {c: row.column(c)[0].as_py() for c in ("t", "n", "loss", "steps", "rows_before", "loss_before")}
                vec = vectors_of(row.column("vec"))[0]
                first = first or (vec, value)
                if value["n"]:
                    total = vec * value["n"] if total is None else total + vec * value["n"]
                    n, loss, steps, used = n + value["n"], loss + value["loss"], steps + value["steps"], used + 1
        if first:
            vec, value = first
            # A round without rows hands on the state it was given.
            yield pa.record_batch([pa.array([total / n if n else vec], pa.list_(pa.float64())),
                                   pa.array([value["t"] + (round(steps / used) if used else 0)], pa.int64()),
                                   pa.array([value["rows_before"] + n]), pa.array([value["loss_before"] + loss])],
                                  ["vec", "t", "rows", "loss"])

    copies = states.withColumn("replica", F.explode(F.sequence(F.lit(0), F.lit(replicas - 1)))).repartition(replicas, "replica")
    dealt = rows.select("replica", feat, *TARGETS, "_wm_key").repartition(replicas, "replica")
    done = dealt.groupBy("replica").cogroup(copies.groupBy("replica")).applyInArrow(
        replica, "replica int, vec array<double>, t bigint, n double, loss double, steps double, rows_before double, loss_before double")
    return done.repartition(1).sortWithinPartitions("replica").mapInArrow(mean, _STATE)


def run_round(rows: DataFrame, feat: str, state: dict, epoch: int, batch_size: int, lr: float, weight_decay: float,
              dropout: float, seed: int, at_most: int | None = None) -> tuple:
    """One round of ``at_most`` replicas (counted if not given) from ``state``
    (params, m, v, t): ``(next state, rows, loss sum)``."""
    ship_package(rows.sparkSession)
    replicas = at_most or (rows.agg(F.max("replica")).first()[0] or 0) + 1
    shapes = {k: a.shape for k, a in state["params"].items()}
    after = next_state(rows, state_table(rows.sparkSession, state), feat, shapes, replicas, epoch, batch_size, lr, weight_decay,
                       dropout, seed)
    return read_state(after, state["params"])


#: Seconds that a task waits for the others' vectors, beyond which one is lost.
WAIT_S = 900


def tasks_side_by_side(spark: SparkSession, most: int) -> int:
    """Barrier tasks that can run at once, at most ``most``; 0 if there can be none."""
    if (spark.sparkContext.getConf().get("spark.dynamicAllocation.enabled") or "").lower() == "true":
        return 0
    sc = spark.sparkContext._jsc.sc()
    return min(most, sc.maxNumConcurrentTasks(sc.resourceProfileManager().defaultResourceProfile()))


class _Exchange:
    """What the barrier tasks of an epoch tell each other after every round: a
    flat array for each replica, empty if it had no row."""

    def __init__(self, context, folder: str | None, replicas: int):
        self.context, self.replicas = context, replicas
        # The first task's name for this attempt: a repeated stage reads nothing old.
        self.folder = folder and f"{folder}/{context.allGather(uuid.uuid4().hex)[0]}"
        if self.folder:
            os.makedirs(self.folder, exist_ok=True)

    def _path(self, k: int, replica: int) -> str:
        return f"{self.folder}/{k}-{replica}"

    def __call__(self, k: int, mine: dict) -> list:
        return self._by_files(k, mine) if self.folder else self._by_messages(mine)

    def _by_messages(self, mine: dict) -> list:
        text = "|".join(f"{r},{base64.b64encode(a.tobytes()).decode()}" for r, a in mine.items())
        entries = [e.partition(",") for m in self.context.allGather(text) if m for e in m.split("|")]
        found = {int(r): np.frombuffer(base64.b64decode(packed)) for r, _, packed in entries}
        return [found[r] for r in range(self.replicas)]

    def _by_files(self, k: int, mine: dict) -> list:
        for replica, a in mine.items():
            # A file appears whole, or not yet.
            a.tofile(f"{self._path(k, replica)}.part")
            os.rename(f"{self._path(k, replica)}.part", self._path(k, replica))
        out = [mine[r] if r in mine else self._await(self._path(k, r)) for r in range(self.replicas)]
        # Whoever has told of this round has read all of the one before.
        for replica in mine if k else ():
            os.remove(self._path(k - 1, replica))
        return out

    def _await(self, path: str) -> np.ndarray:
        until = time.monotonic() + WAIT_S
        while not os.path.exists(path):
            if time.monotonic() > until:
                raise TimeoutError(f"no task wrote {path}")
            time.sleep(0.002)
        return np.fromfile(path)


def _seen_by_python(path: str) -> str | None:
    """The path without its scheme, if it names a mounted folder."""
    parts = urlsplit(path)
    return unquote(parts.path) if parts.scheme in ("", "file") else None


def epoch_in_one_job(deal: Deal, feat: str, state: dict, epoch: int, batch_size: int, lr: float, weight_decay: float,
                     dropout: float, seed: int, tasks: int, folder: str | None) -> tuple:
    """All rounds of an epoch in ``tasks`` barrier tasks that exchange vectors
    in ``folder`` (None: by messages). Means are taken in the order of the
    replicas, so the result does not depend on the tasks."""
    spark = deal.rows.sparkSession
    ship_package(spark)
    like, rounds, replicas = state["params"], deal.rounds, deal.replicas
    size, columns = sum(a.size for a in like.values()), ["replica", feat, *TARGETS, "_wm_key"]
    shared = spark.sparkContext.broadcast(state)

    def trained(now, part):
        params, m, v, steps, lost = local_updates(
            now, vectors_of(part.column(feat)), _numbers(part, *TARGETS), part.column("_wm_key").to_numpy(),
            epoch, batch_size, lr, weight_decay, dropout, seed)
        return np.concatenate([*map(_flatten, (params, m, v)), [part.num_rows, lost, steps]])

    def run(batches):
        context = BarrierTaskContext.get()
        task, exchange = context.partitionId(), _Exchange(context, folder, replicas)
        now, seen, loss, mine = shared.value, 0.0, 0.0, runs_of(batches, "round")
        here = next(mine, None)
        for k in range(rounds):
            told = {replica: np.zeros(0) for replica in range(task, replicas, tasks)}
            if here and here[0] == k:
                of = here[1].column("replica").to_numpy()
                for replica in np.unique(of).tolist():
                    told[replica] = trained(now, here[1].filter(pa.array(of == replica)).combine_chunks())
                here = next(mine, None)
            found = [vec for vec in exchange(k, told) if len(vec)]
            if not found:
                continue  # a round without rows hands on its state
            total, sums = found[0][:3 * size] * found[0][-3], found[0][-3:].copy()
            for vec in found[1:]:
                total += vec[:3 * size] * vec[-3]
                sums += vec[-3:]
            total /= sums[0]
            now = {**{p: _unflatten(total[i * size:(i + 1) * size], like) for i, p in enumerate(("params", "m", "v"))},
                   "t": now["t"] + round(sums[2] / len(found))}
            seen, loss = seen + sums[0], loss + sums[1]
        if task == 0:
            vec = np.concatenate([_flatten(now[p]) for p in ("params", "m", "v")])
            yield pa.record_batch([pa.array([vec], pa.list_(pa.float64())), pa.array([now["t"]], pa.int64()), pa.array([seen]),
                                   pa.array([loss])], ["vec", "t", "rows", "loss"])

    # The partition is the task's number: no two tasks' replicas meet by a hash.
    rows = (deal.rows.select("round", *columns).repartitionById(tasks, F.col("replica") % tasks)
                     .sortWithinPartitions("round", "replica"))
    found = read_state(rows.mapInArrow(run, _STATE, barrier=True), like)
    shared.destroy()
    return found


def run_epoch(deal: Deal, feat: str, state: dict, epoch: int, batch_size: int, lr: float, weight_decay: float, dropout: float,
              seed: int) -> tuple:
    """All rounds of an epoch: ``(state, rows, loss sum)``. They are one job, or
    else ``CHAINED`` rounds are; the driver receives the state once, at the end."""
    spark, args = deal.rows.sparkSession, (deal, feat, state, epoch, batch_size, lr, weight_decay, dropout, seed)
    tasks = tasks_side_by_side(spark, deal.replicas)
    if not tasks:
        return epoch_in_chains(*args)
    path = scratch_path(spark, "training-exchange")
    try:
        return epoch_in_one_job(*args, tasks, _seen_by_python(path))
    finally:
        drop_path(spark, path)


def epoch_in_chains(deal: Deal, feat: str, state: dict, epoch: int, batch_size: int, lr: float, weight_decay: float,
                    dropout: float, seed: int) -> tuple:
    shapes = {k: a.shape for k, a in state["params"].items()}
    states = state_table(deal.rows.sparkSession, state)
    for k in range(deal.rounds):
        states = next_state(deal.of_round(k), states, feat, shapes, deal.replicas, epoch, batch_size, lr, weight_decay, dropout, seed)
        if (k + 1) % CHAINED == 0 and k + 1 < deal.rounds:
            states = stage_table(states, "training-state")
    return read_state(states, state["params"])


def fit_head(train: DataFrame, val: DataFrame, feat: str, stats: dict, key_col: str,
             hidden: int = 256, dropout: float = 0.1, epochs: int = 10, lr: float = 5e-2,
             weight_decay: float = 1e-3, batch_size: int = 64, replicas: int = 8, sync_steps: int = 16,
             patience: int = 5, factor: float = 0.5, min_lr: float = 1e-7, threshold: float = 1e-4, seed: int = 1992,
             save_every: int = 5, save_path: str | None = None, lat: str = "latitude", lon: str = "longitude"):
    """Fit the head; returns ``(best model, initial model, epoch log rows)``.
    A table without training rows is an error."""
    spark = train.sparkSession
    ship_package(spark)
    deal = deal_rounds(prepare_training(train, feat, lat, lon, stats, key_col, seed), batch_size, replicas, sync_steps)
    first = deal.rows.select(F.size(feat).alias("dim")).take(1)
    if not first:
        raise ValueError("there is no training row")
    va = stage_table(prepare_training(val, feat, lat, lon, stats, key_col, seed), "validation-rows")
    mean = [stats["lat_mean"], stats["lon_mean"]]
    sd = [stats["lat_std"], stats["lon_std"]]
    params = init_params(first[0]["dim"], hidden, seed)
    initial = HeadModel({k: v.copy() for k, v in params.items()}, mean, sd, hidden, dropout)
    m, v = ({k: np.zeros_like(p) for k, p in params.items()} for _ in range(2))
    state = {"params": params, "m": m, "v": v, "t": 0}
    best_loss, best, pending, log = float("inf"), None, False, []
    plateau_loss, bad_epochs = float("inf"), 0
    for epoch in range(1, epochs + 1):
        state, rows, loss = run_epoch(deal, feat, state, epoch, batch_size, lr, weight_decay, dropout, seed)
        current = HeadModel({k: p.copy() for k, p in state["params"].items()}, mean, sd, hidden, dropout)
        val_loss, val_km, _ = _evaluate(va, feat, current)
        if best is None or val_loss < best_loss:
            best_loss, best, pending = val_loss, current, True
        if val_loss < plateau_loss * (1 - threshold):
            plateau_loss, bad_epochs = val_loss, 0
        else:
            bad_epochs += 1
            if bad_epochs > patience:
                lr, bad_epochs = max(lr * factor, min_lr), 0
        log.append((epoch, loss / rows, val_loss, val_km, lr))
        if save_path and pending and (epoch == epochs or epoch % save_every == 0):
            save_model(spark, best, save_path, initial)
            pending = False
    return best, initial, log


def predict(df: DataFrame, feat: str, model: HeadModel, prefix: str = "predicted_") -> DataFrame:
    """Add ``<prefix>latitude`` / ``<prefix>longitude``."""
    return predict_each(df, feat, {prefix: model})


def predict_each(df: DataFrame, feat: str, models: dict) -> DataFrame:
    """Predictions of several models ({column prefix: model}) in one pass:
    forward passes with broadcast weights on Arrow batches, de-normalised."""
    spark = df.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast({
        prefix: (m.params, np.asarray(m.coord_mean), np.asarray(m.coord_std)) for prefix, m in models.items()})
    added = [T.StructField(f"{prefix}{axis}", T.DoubleType()) for prefix in models for axis in ("latitude", "longitude")]

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x, columns = vectors_of(batch.column(feat)), list(batch.columns)
            for params, mean, sd in shared.value.values():
                coords = forward(params, x)[0] * sd + mean
                columns += [pa.array(coords[:, 0]), pa.array(coords[:, 1])]
            yield pa.record_batch(columns, [*batch.schema.names, *[f.name for f in added]])

    return df.mapInArrow(run, T.StructType(df.schema.fields + added))


def score_bags(df: DataFrame, feat: str, model: HeadModel, initial: HeadModel | None = None,
               lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Scored bags: trained predictions, ``error_km`` against the bag's
    coordinates and, with ``initial``, the untrained model's predictions and
    error beside them."""
    from waymark.functions.geo import haversine_km
    out = predict_each(df, feat, {"predicted_": model, **({"initial_predicted_": initial} if initial else {})})
    out = out.withColumn("error_km", haversine_km("predicted_latitude", "predicted_longitude", lat, lon))
    if initial is not None:
        out = out.withColumn("initial_error_km", haversine_km("initial_predicted_latitude",
                                                              "initial_predicted_longitude", lat, lon))
    return out
