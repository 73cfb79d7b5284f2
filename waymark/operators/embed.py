"""Text embedding.

Two interchangeable embedders produce a fixed-width ``array<double>`` per
row, without leaving the row (no shuffle):

* :func:`embed_hashed` -- clean and split on spaces natively; the distinct
  tokens of an Arrow batch are hashed into ``dim`` buckets, counted at once,
  and each row is scaled to unit length (mean pooling followed by
  normalisation gives the same vector).
* :func:`embed_with` -- a user-supplied encoder, built once per Python worker
  and fed batches of texts through ``predict_batch_udf``.

:func:`cache_embeddings` writes the vectors once (the encoder is frozen) so
training epochs re-read them instead of re-embedding.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waymark.functions.text import clean_text
from waymark.session import ship_package

#: Entries of the count matrix made at once.
MATRIX_ENTRIES = 1 << 20


def _unit_counts(tokens: pa.Array, dim: int) -> np.ndarray:
    """Bucket counts per row, scaled to unit length. A token's bucket is
    ``hash32`` of it by ``dim``; every distinct token is hashed once."""
    lengths = tokens.value_lengths().to_numpy(zero_copy_only=False)
    coded = tokens.flatten().dictionary_encode()
    buckets = np.array([int(hashlib.md5(t.encode()).hexdigest()[:8], 16) % dim for t in coded.dictionary.to_pylist()], np.int64)
    flat = buckets[coded.indices.to_numpy(zero_copy_only=False)]
    row = np.repeat(np.arange(len(lengths)), lengths)
    counts = np.bincount(row * dim + flat, minlength=len(lengths) * dim).reshape(-1, dim).astype(np.float64)
    return counts / np.sqrt((counts * counts).sum(1, keepdims=True))


def embed_hashed(df: DataFrame, text_col: str, id_cols, dim: int = 64,
                 out_col: str = "embedding") -> DataFrame:
    """``(ids..., embedding array<double>[dim])`` for every row whose text has
    at least one token."""
    ship_package(df.sparkSession)
    id_cols = list(id_cols)
    tokens = F.filter(F.split(clean_text(text_col), " ", -1), lambda t: t != "")
    rows = df.select(*[F.col(c).alias(f"id{k}") for k, c in enumerate(id_cols)], tokens.alias("tokens"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, MATRIX_ENTRIES // dim)
        for whole in batches:
            for begin in range(0, whole.num_rows, step):
                batch = whole.slice(begin, step)
                values = _unit_counts(batch.column("tokens"), dim)
                offsets = pa.array(np.arange(len(values) + 1, dtype=np.int32) * dim)
                yield pa.record_batch([*batch.columns[:-1], pa.ListArray.from_arrays(offsets, pa.array(values.reshape(-1)))],
                                      [*batch.schema.names[:-1], "vector"])

    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("vector", T.ArrayType(T.DoubleType()))])
    out = rows.where(F.size("tokens") > 0).mapInArrow(run, schema)
    return out.select(*[F.col(f"id{k}").alias(c) for k, c in enumerate(id_cols)], F.col("vector").alias(out_col))


def hashed_weights(df: DataFrame, text_col: str, id_cols, dim: int = 64) -> DataFrame:
    """Long form ``(ids..., bucket, weight)`` of :func:`embed_hashed`, without
    the zeros."""
    vectors = embed_hashed(df, text_col, id_cols, dim, "_wm_vector")
    return (vectors.select(*id_cols, F.posexplode("_wm_vector").alias("bucket", "weight")).where("weight > 0")
                   .withColumn("bucket", F.col("bucket").cast("bigint")))


def embed_with(df: DataFrame, text_col: str, encoder_factory: Callable[[], Callable],
               dim: int, out_col: str = "embedding", batch_size: int = 64) -> DataFrame:
    """Embed with a user encoder: ``encoder_factory()`` returns a function from
    a list of texts to a 2-D array of shape (n, dim). It is called once per
    Python worker and fed ``batch_size`` texts at a time; a null text is an
    empty one."""
    ship_package(df.sparkSession)

    def make():
        encoder = encoder_factory()

        def predict(texts: np.ndarray) -> np.ndarray:
            vectors = np.asarray(encoder([str(t) for t in texts]), dtype=np.float64)
            if vectors.shape != (len(texts), dim):
                raise ValueError(f"the encoder gave shape {vectors.shape} for {len(texts)} texts of {dim} dimensions")
            return vectors
        return predict

    encode = predict_batch_udf(make, return_type=T.ArrayType(T.DoubleType()), batch_size=batch_size)
    return df.withColumn(out_col, encode(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))


def cache_embeddings(df: DataFrame, name: str = "embeddings") -> DataFrame:
    """Write the vectors once and read them back (frozen encoder)."""
    from waymark.sources.tables import stage_table
    return stage_table(df, name)
