"""Embedding whitening from a bit-sliced scatter matrix.

Entries become integers ``x = floor(scale * c)``. The fit list holds every
distinct integer vector once. Its cross-products are counted exactly:

1. a block of vectors is shifted by its own least entries, so every entry is a
   small natural number, and each bit of each dimension becomes one plane of
   bits across the rows of the block, packed into 64-bit words;
2. the popcount of the AND of two planes counts the rows that have both bits;
   weighted by the two bits' values these counts add up to the cross-products
   of the shifted entries, and the shift is undone in integers;
3. Spark adds the blocks up as limbs of 40 bits, so no sum can overflow; what
   reaches the driver is one matrix of dimensions x dimensions;
4. the covariance times n squared is ``n * X - S S'`` in integers. Only then is
   it divided (correctly rounded) and decomposed by ``eigh``.

The covariance of the whitened fit list is measured by Spark, not assumed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.sources.tables import stage_table, table

SCALE = 256
COMPONENTS = 4
LIMB = 40
#: Entries of one block of rows: bounds the planes held at once.
BLOCK_ENTRIES = 1 << 20
LONG = 2 ** 63 - 1
#: A component whose variance is below this share of the trace has no direction of its own.
LEAST_SHARE = 1e-13


def usable(vector: Column) -> Column:
    """A vector that is not null and holds finite numbers only."""
    return F.coalesce(vector.isNotNull() & F.forall(
        vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double"))
        & (F.abs(c.cast("double")) < float("inf"))), F.lit(False))


def integers(vector: Column, scale: int = SCALE) -> Column:
    """Entries as longs; what lies beyond the longs is held at the nearest."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * F.lit(float(scale))).cast("bigint"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Arrow lists as one integer matrix; shorter vectors end in zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    if len(flat) == len(column) * width and (lengths == width).all():
        return flat.reshape(len(column), width)
    out = np.zeros((len(column), width), np.int64)
    row = np.repeat(np.arange(len(column)), lengths)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def bit_planes(shifted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``planes, dimension, bit``: the set bits of natural numbers (rows x
    dimensions, as uint64), one plane of packed rows per dimension and bit."""
    columns = np.ascontiguousarray(shifted.T)
    rows = -(-columns.shape[1] // 64) * 64
    planes, dimension, bit = [], [], []
    for d, column in enumerate(columns):
        for b in range(int(column.max()).bit_length() if len(column) else 0):
            packed = np.zeros(rows // 8, np.uint8)
            bits = np.packbits(((column >> np.uint64(b)) & np.uint64(1)).astype(np.uint8))
            packed[:len(bits)] = bits
            planes.append(packed.view(np.uint64))
            dimension.append(d)
            bit.append(b)
    return (np.array(planes, np.uint64).reshape(len(planes), rows // 64),
            np.array(dimension, np.int64), np.array(bit, np.int64))


def block_scatter(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact ``x' x`` and column sums of one block of longs, as Python integers
    (object arrays)."""
    n, d = x.shape
    least = x.min(0)
    planes, dimension, bit = bit_planes(x.view(np.uint64) - least.view(np.uint64))
    cross = np.zeros((d, d), object)
    sums = np.zeros(d, object)
    if len(planes):
        # The planes of a dimension stand together; weights below 2^62 stay in longs.
        narrow = 2 * int(bit.max()) + 2 + n.bit_length() < 62
        kind = np.int64 if narrow else object
        weight = np.array([1 << int(b) for b in bit], kind)
        dims, first = np.unique(dimension, return_index=True)
        total = np.zeros((len(dims), len(dims)), kind)
        for k, p in enumerate(planes):
            at = int(np.searchsorted(dims, dimension[k]))
            counts = np.bitwise_count(planes[first[at]:] & p).sum(1, dtype=np.int64)
            part = np.add.reduceat(counts.astype(kind) * weight[first[at]:], first[at:] - first[at])
            total[at, at:] += part * weight[k]
        own = np.bitwise_count(planes).sum(1, dtype=np.int64)
        sums[dims] = np.add.reduceat(own.astype(kind) * weight, first).astype(object)
        upper = total.astype(object)
        cross[np.ix_(dims, dims)] = upper + np.triu(upper, 1).T
    # Undo the shift: sum (y_i + m_i)(y_j + m_j).
    m = least.astype(object)
    cross = cross + np.outer(m, sums) + np.outer(sums, m) + n * np.outer(m, m)
    return cross, sums + n * m


def _limbs(value: int) -> Iterator[tuple[int, int]]:
    """``(limb, part)`` with ``value = sum part * 2^(40 limb)``; only the last
    part may be negative."""
    k = 0
    while not -(1 << LIMB) < value < (1 << LIMB):
        yield k, value & ((1 << LIMB) - 1)
        value, k = value >> LIMB, k + 1
    yield k, value


def scatter(fit: DataFrame, width: int) -> tuple[int, np.ndarray, np.ndarray]:
    """``n, S, X`` of the fit list (``x`` array of longs): rows, sums, and
    cross-products, exact. Tasks add their blocks, Spark adds the tasks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, cross, sums = 0, np.zeros((width, width), object), np.zeros(width, object)
        step = max(64, BLOCK_ENTRIES // max(width, 1))
        for batch in batches:
            for begin in range(0, batch.num_rows, step):
                x = _matrix(batch.column("x").slice(begin, step), width)
                more, total = block_scatter(x)
                n, cross, sums = n + len(x), cross + more, sums + total
        if not n:
            return
        rows = [(-1, -1, 0, n)]
        rows += [(i, -1, k, part) for i in range(width) for k, part in _limbs(int(sums[i]))]
        for i in range(width):
            rows += [(i, j, k, part) for j in range(i, width) for k, part in _limbs(int(cross[i, j]))]
            if len(rows) > 1 << 16 or i == width - 1:
                yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], ["i", "j", "k", "part"])
                rows = []

    found = (fit.select("x").mapInArrow(run, "i bigint, j bigint, k bigint, part bigint")
                .groupBy("i", "j", "k").agg(F.sum("part").alias("part")).collect())
    n, sums, cross = 0, np.zeros(width, object), np.zeros((width, width), object)
    for r in found:
        value = int(r["part"]) << (LIMB * r["k"])
        if r["i"] < 0:
            n += value
        elif r["j"] < 0:
            sums[r["i"]] += value
        else:
            cross[r["i"], r["j"]] += value
    return n, sums, cross + np.triu(cross, 1).T


class Whitener:
    """Fitted components: ``n`` and ``S`` of the fit list, unit eigenvectors
    (columns, by falling eigenvalue), eigenvalues, and shares of the trace.

    Directions without variance (fewer distinct vectors than components,
    constant dimensions) cannot be scaled: ``scale`` is NaN there, and their
    whitened values are null."""

    def __init__(self, n: int, sums: np.ndarray, cross: np.ndarray, components: int):
        self.n, self.sums, self.width = n, sums, len(sums)
        centred = n * cross - np.outer(sums, sums)
        trace = sum(int(centred[i, i]) for i in range(self.width))
        covariance = np.array([[int(v) / (n * n) for v in row] for row in centred]).reshape(self.width, self.width)
        values, vectors = np.linalg.eigh(covariance)
        keep = np.argsort(-values, kind="stable")[:components]
        self.values, self.vectors = values[keep], vectors[:, keep]
        # One sign for all rows: the entry of greatest size is positive.
        top = self.vectors[np.abs(self.vectors).argmax(0), np.arange(len(keep))]
        self.vectors = self.vectors * np.where(top < 0, -1.0, 1.0)
        total = trace / (n * n)
        flat = self.values <= LEAST_SHARE * total if total else np.ones(len(keep), bool)
        self.scale = np.where(flat, np.nan, np.sqrt(np.maximum(self.values, 0.0)))
        self.explained = np.where(flat, 0.0, self.values / total if total else 0.0)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``n * x - S``, exact: longs where they hold it, else Python integers."""
        most = self.n * max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))
        if most + max(map(abs, map(int, self.sums)), default=0) <= LONG:
            return self.n * x - self.sums.astype(np.int64)
        return self.n * x.astype(object) - self.sums

    def project(self, centred: np.ndarray) -> np.ndarray:
        """Whitened values, rows x components."""
        if centred.dtype == object:
            away = np.array([[int(v) / self.n for v in row] for row in centred]).reshape(centred.shape)
        else:
            away = centred / self.n
        return away @ self.vectors / self.scale

    def deviation(self, centred: np.ndarray) -> list[int]:
        """Sum of the squares of every row, exact."""
        most = max(abs(int(centred.max(initial=0))), abs(int(centred.min(initial=0))))
        if centred.dtype != object and most * most * self.width <= LONG:
            return (centred * centred).sum(1).tolist()
        return [int(v) for v in (centred.astype(object) ** 2).sum(1)]


def fit(vectors: DataFrame, components: int = COMPONENTS) -> tuple[Whitener | None, DataFrame]:
    """The whitener of the distinct vectors of ``x`` and the written fit list;
    None when there is no vector or none has an entry."""
    # Equal vectors meet once per task before the shuffle.
    distinct = stage_table(vectors.select("x").distinct(), "whitening-fit")
    width = distinct.agg(F.max(F.size("x"))).first()[0]
    if not width:
        return None, distinct
    return Whitener(*scatter(distinct, width), components), distinct


def identity_error(distinct: DataFrame, whitener: Whitener) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the
    identity, over the components that have a variance."""
    live = np.flatnonzero(~np.isnan(whitener.scale)).tolist()
    if not live:
        return 0.0
    shared = distinct.sparkSession.sparkContext.broadcast(whitener)
    names = [f"w{k}" for k in live]

    def run(batches):
        for batch in batches:
            w = shared.value
            values = w.project(w.centred(_matrix(batch.column("x"), w.width)))
            yield pa.record_batch([pa.array(values[:, k]) for k in live], names)

    rows = distinct.select("x").mapInArrow(run, ", ".join(f"{n} double" for n in names))
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    # Spark's covariance merges centred partial sums.
    found = rows.agg(*[F.covar_pop(a, b) for a, b in pairs]).first()
    return max(abs(found[k] - (a == b)) for k, (a, b) in enumerate(pairs))


def whiten(rows: DataFrame, id_col: str, vector_col: str, scale: int = SCALE,
           components: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error,
    deviation_digits`` for every usable row and component.

    * Null vectors and vectors with a null or non-finite entry are dropped.
      An entry beyond the longs after scaling is held at the nearest long.
    * A vector shorter than the longest one is read as if it ended in zeros.
      There are as many components as dimensions, at most ``components``;
      without any entry in the table there is no result.
    * Rows that repeat, also under one id or a null id, all get results;
      their vector counts once in the fit list.
    * ``deviation`` is null where it does not fit a long;
      ``deviation_digits`` holds it always.
    * A component without variance has ``explained`` 0 and null ``whitened``.
    * Other columns are ignored, whatever their names.
    """
    kind = rows.schema[id_col].dataType.simpleString()
    vectors = rows.where(usable(F.col(vector_col))).select(F.col(id_col).alias("vec_id"),
                                                           integers(F.col(vector_col), scale).alias("x"))
    schema = (f"vec_id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, "
              "identity_error double, deviation_digits string")
    spark = rows.sparkSession
    whitener, distinct = fit(vectors, components)
    if whitener is None:
        return spark.createDataFrame([], schema)
    error = identity_error(distinct, whitener)
    shared = spark.sparkContext.broadcast(whitener)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w = shared.value
            k = len(w.values)
            step = max(64, BLOCK_ENTRIES // w.width)
            for begin in range(0, batch.num_rows, step):
                part = batch.slice(begin, step)
                centred = w.centred(_matrix(part.column("x"), w.width))
                values = w.project(centred).reshape(-1)
                far = w.deviation(centred)
                at = np.repeat(np.arange(part.num_rows), k)
                yield pa.record_batch([
                    part.column("vec_id").take(pa.array(at)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), part.num_rows)),
                    pa.array(np.full(len(at), w.n, np.int64)),
                    pa.array([v if v <= LONG else None for v in far], pa.int64()).take(pa.array(at)),
                    pa.array(values, pa.float64(), mask=np.isnan(values)),
                    pa.array(np.tile(w.explained, part.num_rows)),
                    pa.array(np.full(len(at), error)),
                    pa.array([str(v) for v in far], pa.string()).take(pa.array(at)),
                ], ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error",
                    "deviation_digits"])

    return vectors.mapInArrow(run, schema)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first four whitened components of all embeddings."""
    return whiten(table(spark, sf_dir, "embeddings", ["vec_id", "embedding"]), "vec_id", "embedding")
