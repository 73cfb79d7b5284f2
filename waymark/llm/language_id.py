"""Language identification: multinomial naive Bayes over hashed character
n-grams.

Features: every run of 1, 2 and 3 characters of the lower-cased text, with
whatever is not a letter read as a space; runs of spaces alone count nothing.
A feature is hashed to one of ``BUCKETS`` columns. Training sums the columns
per language in Spark; the smoothed log probabilities form a matrix of
languages x ``BUCKETS``, which is broadcast, and a text's score is the sum of
its features' rows.

The posterior only compares the learned languages and is close to 1 for any
text of some length. Whether a text is of its best language at all is told by
its mean log probability per feature, against mean and standard deviation of
that value under the language's own distribution (see ``Model.judge``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.llm.columns import bound_batches
from waymark.llm.textbytes import batch_bytes, small_batches
from waymark.sources.tables import stage_table, table

BUCKETS = 1 << 16
ORDERS = 3
SMOOTHING = 0.5
#: The matrix is languages x BUCKETS x 4 bytes; beyond this the fit is refused.
MAX_MODEL_BYTES = 256 << 20
#: Languages whose counts a task holds before it hands them on.
HELD_LANGUAGES = 64
UNDETERMINED = "und"
#: Documents whose best language is less probable than this are rejected.
MIN_SCORE = 0.35
#: A text is foreign to its best language if its mean log probability per
#: feature is lower than the language's mean by more than ``FAR`` (a factor of
#: 11 per feature) and ``FAR_SHORT`` standard deviations of a mean of as many.
FAR, FAR_SHORT = 2.4, 2.0


def letter_table() -> np.ndarray:
    """Bit per code point: whether it is a letter."""
    return np.packbits(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))


def _features(column: pa.Array, letters: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """``(letters, feature columns)`` of every text."""
    data, offsets = batch_bytes(pc.utf8_lower(column.fill_null("")))
    codes = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    lead = np.append(0, np.cumsum((data & 0xC0) != 0x80))
    bounds = lead[offsets]
    is_letter = letters[codes]
    codes = np.where(is_letter, codes, 32).astype(np.uint32)
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]
    grams, valid = [], []
    run, any_letter = np.zeros(len(codes), np.uint32), np.zeros(len(codes), bool)
    for n in range(ORDERS):
        # Hash of the n + 1 characters that start here.
        ahead = np.zeros(len(codes), np.uint32)
        ahead[:max(len(codes) - n, 0)] = codes[n:]
        seen = np.zeros(len(codes), bool)
        seen[:max(len(codes) - n, 0)] = is_letter[n:]
        run = run * np.uint32(0x01000193) + ahead * np.uint32(0x9E3779B1) + np.uint32(n + 1)
        any_letter = any_letter | seen
        mixed = (run ^ (run >> np.uint32(15))) * np.uint32(0x85EBCA6B)
        grams.append((mixed >> np.uint32(32 - BUCKETS.bit_length() + 1)).astype(np.int32))
        valid.append(any_letter)
    total = np.append(0, np.cumsum(is_letter))
    for begin, end in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        cols = [g[begin:end - n][v[begin:end - n]] for n, (g, v) in enumerate(zip(grams, valid, strict=True))
                if end - n > begin]
        yield int(total[end] - total[begin]), np.concatenate(cols) if cols else np.zeros(0, np.int32)


def held_out(doc_id) -> F.Column:
    """The fixed fold: crc32 of the id as text leaves remainder 1 by 3. A null
    id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


class Model:
    """Languages in ascending order and the matrix, one row per bucket."""

    def __init__(self, languages: list[str], weights: np.ndarray, prior: np.ndarray, letters: np.ndarray):
        self.languages, self.weights, self.prior = languages, weights, prior
        self.letters = letters
        # Mean and deviation of a feature's log probability, per language. The
        # smoothing counts, so a hardly trained language expects unseen features.
        logs = weights.astype(np.float64)
        self.mean = (np.exp(logs) * logs).sum(0)
        self.spread = np.sqrt((np.exp(logs) * (logs - self.mean) ** 2).sum(0))

    def predict(self, column: pa.Array) -> tuple[list[str], list[float]]:
        return self.judge(column)[:2]

    def judge(self, column: pa.Array) -> tuple[list[str], list[float], list[bool]]:
        """Language and score, and whether the text's mean log probability per
        feature is one that texts of the language have."""
        names, scores, own = [], [], []
        for n_letters, cols in _features(column, np.unpackbits(self.letters).view(bool)):
            if not n_letters or not self.languages:
                names.append(UNDETERMINED)
                scores.append(0.0)
                own.append(False)
                continue
            if len(cols) < BUCKETS // 4:
                total = self.weights[cols].sum(0, dtype=np.float64)
            else:
                total = np.bincount(cols, minlength=BUCKETS) @ self.weights.astype(np.float64)
            logs, total = total, total + self.prior
            best = int(np.argmax(total))
            names.append(self.languages[best])
            scores.append(float(1.0 / np.exp(total - total[best]).sum()))
            far = FAR + FAR_SHORT * self.spread[best] / np.sqrt(len(cols))
            own.append(bool(logs[best] / len(cols) >= self.mean[best] - far))
        return names, scores, own


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Model of all rows with a language. Tasks count in numpy, Spark sums the
    counts per language and bucket; what reaches the driver is the matrix."""
    spark = labelled.sparkSession
    bound_batches(spark)
    letters = letter_table()
    shared = spark.sparkContext.broadcast(letters)
    rows = labelled.where(F.col(lang_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table_ = np.unpackbits(shared.value).view(bool)
        held: dict[str, np.ndarray] = {}

        def flush():
            for lang, counts in held.items():
                at = np.flatnonzero(counts)
                yield pa.record_batch([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)),
                                       pa.array(counts[at])], ["lang", "bucket", "n"])
            held.clear()

        for batch in small_batches(batches, "text"):
            for lang, (_, cols) in zip(batch.column("lang").to_pylist(),
                                       _features(batch.column("text"), table_), strict=True):
                if lang not in held:
                    if len(held) == HELD_LANGUAGES:
                        yield from flush()
                    held[lang] = np.zeros(BUCKETS + 1, np.int64)
                counts = held[lang]
                if len(cols) < BUCKETS // 4:
                    np.add.at(counts, cols, 1)
                else:
                    counts[:BUCKETS] += np.bincount(cols, minlength=BUCKETS)
                counts[BUCKETS] += 1  # documents
        yield from flush()

    sums = (rows.mapInArrow(count, "lang string, bucket int, n bigint")
                .groupBy("lang", "bucket").agg(F.sum("n").alias("n")))
    # The size of the matrix is known before anything of it is gathered.
    sums = stage_table(sums, "language-counts")
    n = sums.select("lang").distinct().count()
    if n * BUCKETS * 4 > MAX_MODEL_BYTES:
        raise ValueError(f"{n} languages x {BUCKETS} buckets exceed {MAX_MODEL_BYTES} bytes")
    found = sums.toPandas()
    languages = sorted(found["lang"].unique())
    counts = np.zeros((len(languages), BUCKETS + 1))
    counts[np.searchsorted(languages, found["lang"]), found["bucket"]] = found["n"]
    docs, counts = counts[:, BUCKETS], counts[:, :BUCKETS]
    weights = np.log((counts + SMOOTHING) / (counts.sum(1, keepdims=True) + SMOOTHING * BUCKETS))
    prior = np.log(docs / docs.sum()) if len(languages) else docs
    return Model(languages, np.ascontiguousarray(weights.T.astype(np.float32)), prior, letters)


def predict(docs: DataFrame, model: Model, carry: list[str], text_col: str = "text",
            names: tuple[str, ...] = ("lang_pred", "score")) -> DataFrame:
    """``carry`` columns and the prediction, under ``names``; a third name adds
    whether the text is of that language by ``Model.judge``. Only the text is
    read for it. Null texts and texts without a letter are ``und`` with
    score 0; equally probable languages give the first in order."""
    spark = docs.sparkSession
    bound_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    slots = [f"c{k}" for k in range(len(carry))]
    found = ["_lang", "_score", "_own"]
    rows = docs.select(*[F.col(c).alias(n) for n, c in zip(slots, carry, strict=True)],
                       *([] if text_col in carry else [F.col(text_col).alias("_text")]))
    # A carried text is sent once.
    text = slots[carry.index(text_col)] if text_col in carry else "_text"

    def run(batches):
        for batch in small_batches(batches, text):
            langs, scores, own = shared.value.judge(batch.column(text))
            yield pa.record_batch([*[batch.column(n) for n in slots], pa.array(langs, pa.string()),
                                   pa.array(scores, pa.float64()), pa.array(own, pa.bool_())], [*slots, *found])

    kinds = [f"c{k} {rows.schema[f'c{k}'].dataType.simpleString()}" for k in range(len(carry))]
    out = rows.mapInArrow(run, ", ".join([*kinds, "_lang string", "_score double", "_own boolean"]))
    return out.select(*[F.col(n).alias(c) for n, c in zip(slots, carry, strict=True)],
                      *[F.col(n).alias(c) for n, c in zip(found, names)])


def fit_documents(docs: DataFrame) -> Model:
    """The model of the rows that are not held out (a null id trains nothing)."""
    return fit(docs.where(F.col("doc_id").isNotNull() & ~held_out("doc_id")))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned outside the held-out fold."""
    docs = table(spark, sf_dir, "documents", ["doc_id", "text", "lang"])
    rows = docs.select("doc_id", "text", held_out("doc_id").alias("held_out"))
    return predict(rows, fit_documents(docs), ["doc_id", "held_out"])
