"""Quality rules with an n-gram language model.

Base rules count words, symbols, repeated lines and repeated word windows.
The method is a 4-gram model of characters (code points, lower-cased, white
space runs as one space) per language with modified Kneser-Ney smoothing. The
model grows with the corpus: every 4-gram that occurs is in it.

Tasks count 4-grams, Spark sums them, and all further orders, discounts,
context weights and probabilities are aggregations and joins. Three characters
fill 63 bits of a long, so orders up to 3 are one number and the first
character of a 4-gram stands beside it; nothing is folded.

For scoring, n-grams become 64-bit hashes. Up to ``MODEL_KEYS`` of them are
stored in sorted hash arrays with their log probabilities and context weights,
and broadcast (16 bytes each): the distinct n-grams of a batch are found by
binary search. A larger model stays where it is, and the n-grams of the
documents are joined with it.

Perplexity is per word, since characters that the model has learned to expect
(rows of marks, bars between words) would dilute a mean over characters.
Documents whose log perplexity lies outside their language's band for their
length are rejected.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waymark.llm.columns import bound_batches, text_key
from waymark.llm.textbytes import (batch_bytes, document_of, is_space, mix64, ranges, small_batches,
                                   span_hashes)
from waymark.sources.tables import stage_table, table

ORDER = 4
#: Bits of a code point in a packed n-gram.
BITS = 21
CODE_POINTS = 0x110000
BAND = 8.0
#: Added to the half band, in units of log perplexity per word: long documents differ by more than chance.
LEAST_BAND = 0.12
#: n-grams of all orders that may be broadcast, 16 bytes each.
MODEL_KEYS = 8_000_000
NO_LANGUAGE = "und"
#: 4-grams that a counting task holds.
HELD_KEYS = 1_000_000
#: Bytes of text looked at at once.
BATCH_TEXT = 1 << 18

_FACTOR = np.uint64(0xD6E8FEB86659FD93)


def grams(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``first, rest, bounds``: the 4-gram that ends with every character (its
    first character, and the other three packed), and the bounds of each
    document among them. A text begins after spaces."""
    data, offsets = batch_bytes(pc.utf8_lower(column.fill_null("")))
    codes = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    bounds = np.append(0, np.cumsum((data & 0xC0) != 0x80))[offsets]
    white = (codes == 32) | ((codes >= 9) & (codes <= 13))
    codes = np.where(white, np.uint32(32), codes)
    keep = np.ones(len(codes), bool)
    keep[1:] = ~white[1:] | ~white[:-1]
    keep[bounds[:-1][bounds[:-1] < len(codes)]] = True
    if not keep.all():
        bounds = np.append(0, np.cumsum(keep))[bounds]
        codes = codes[keep]
    codes = codes.astype(np.int64)
    starts, sizes = bounds[:-1], np.diff(bounds)
    rest, before = codes.copy(), codes
    for k in range(1, ORDER):
        before = np.full(len(codes), 32, np.int64)
        before[k:] = codes[:-k] if k < len(codes) else 32
        for at in range(k):
            # What precedes the first characters of a text is space.
            before[starts[sizes > at] + at] = 32
        if k < ORDER - 1:
            rest |= before << (BITS * k)
    return before, rest, bounds


def _language(lang_col: str) -> F.Column:
    return F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANGUAGE))


def _salts(langs: list[str]) -> np.ndarray:
    """A number for every language name that all processes agree on."""
    known = {x: int.from_bytes(hashlib.blake2b(x.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
             for x in set(langs)}
    return np.array([known[x] for x in langs], np.uint64)


def gram_hash(salt: np.ndarray, order: int, first: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """64-bit hash of n-grams of languages."""
    return mix64(rest.view(np.uint64) + salt + (first.view(np.uint64) * np.uint64(8) + np.uint64(order)) * _FACTOR)


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of one occurrence of every distinct key, and the number of the
    distinct key at every place."""
    import pandas as pd
    codes, found = pd.factorize(keys)
    one = np.empty(len(found), np.int64)
    one[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
    return one, codes


def count_grams(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``lang, first, rest, n``: 4-gram counts over all texts."""
    bound_batches(docs.sparkSession)
    rows = docs.select(_language(lang_col).alias("lang"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: dict[str, int] = {}
        parts: list[list[np.ndarray]] = []  # hash, language, first, rest, n
        merged = waiting = 0

        def merge() -> None:
            nonlocal parts, merged, waiting
            both = [np.concatenate(c) for c in zip(*parts, strict=True)]
            one, codes = _distinct(both[0])
            parts = [[*[b[one] for b in both[:4]], np.bincount(codes, weights=both[4], minlength=len(one)).astype(np.int64)]]
            merged, waiting = len(one), 0

        def out() -> pa.RecordBatch:
            _, lang, first, rest, n = parts[0]
            langs = pa.array(list(names), pa.string())
            return pa.record_batch([langs.take(pa.array(lang)), pa.array(first.astype(np.int32)), pa.array(rest), pa.array(n)],
                                   ["lang", "first", "rest", "n"])

        for batch in small_batches(batches, "text", BATCH_TEXT):
            texts = batch.column("lang").to_pylist()
            lang = np.array([names.setdefault(x, len(names)) for x in texts], np.int64)
            first, rest, bounds = grams(batch.column("text"))
            sizes = np.diff(bounds)
            hashes = gram_hash(np.repeat(_salts(texts), sizes), ORDER, first, rest)
            one, codes = _distinct(hashes)
            parts.append([hashes[one], np.repeat(lang, sizes)[one], first[one], rest[one], np.bincount(codes, minlength=len(one))])
            waiting += len(one)
            # As many rows wait as a merge would go through again.
            if waiting > max(merged, HELD_KEYS // 4):
                merge()
                if merged > HELD_KEYS:
                    yield out()
                    parts, merged = [], 0
        if parts:
            merge()
            yield out()

    return (rows.mapInArrow(run, "lang string, first int, rest bigint, n bigint")
                .groupBy("lang", "first", "rest").agg(F.sum("n").alias("n")))


def kneser_ney(counts: DataFrame) -> list[DataFrame]:
    """Per order 0 to 4: ``lang, first, rest, p, back``. ``p`` is the
    interpolated probability and ``back`` the weight that the n-gram as a
    context leaves to lower orders (null if it is no context). Lower orders
    use continuation counts. Order 0 is one row a language: ``p`` is the even
    share of its characters and of one that stands for all unseen ones."""
    mask = lambda order: (1 << (BITS * order)) - 1
    levels = [counts]
    for order in range(ORDER - 1, 0, -1):
        shorter = F.col("rest").bitwiseAND(F.lit(mask(order))).alias("rest")
        levels.insert(0, levels[0].groupBy("lang", F.lit(0).alias("first"), shorter).agg(F.count(F.lit(1)).alias("n")))
    sizes = levels[0].groupBy("lang").agg((1.0 / (F.count(F.lit(1)) + 1)).alias("p"))
    out = [sizes.select("lang", F.lit(0).alias("first"), F.lit(0).cast("bigint").alias("rest"), "p",
                        F.lit(None).cast("double").alias("back"))]
    for order, level in enumerate(levels, 1):
        sizes = level.groupBy("lang").agg(*[F.sum(F.when(F.col("n") == k, 1).otherwise(0)).cast("double").alias(f"n{k}")
                                            for k in (1, 2, 3, 4)])
        y = F.try_divide(F.col("n1"), F.col("n1") + 2 * F.col("n2"))
        # Estimates of the modified discounts; a class that is empty takes the half
        # (greatest and least would skip its null).
        raw = [k - (k + 1) * y * F.try_divide(F.col(f"n{k + 1}"), F.col(f"n{k}")) for k in (1, 2, 3)]
        discount = [F.when(d.isNull(), 0.5).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(float(k)), d))).alias(f"d{k}")
                    for k, d in enumerate(raw, 1)]
        level = level.join(F.broadcast(sizes.select("lang", *discount)), "lang")  # one row per language
        cut = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
        context = F.shiftright("rest", BITS) if order < ORDER else \
            F.shiftleft(F.col("first").cast("bigint"), BITS * 2).bitwiseOR(F.shiftright("rest", BITS))
        shorter = F.col("rest").bitwiseAND(F.lit(mask(order - 1)))
        level = level.withColumns({"context": context, "cut": cut, "shorter": shorter})
        contexts = level.groupBy("lang", "context").agg(F.sum("n").alias("total"), F.sum("cut").alias("left"))
        below = out[-1].select("lang", F.col("rest").alias("shorter"), F.col("p").alias("lower"))
        level = level.join(contexts, ["lang", "context"]).join(below, ["lang", "shorter"])
        backs = contexts.select("lang", F.lit(0).alias("first"), F.col("context").alias("rest"),
                                (F.col("left") / F.col("total")).alias("back"))
        out[-1] = out[-1].drop("back").join(backs, ["lang", "first", "rest"], "full")
        p = ((F.col("n") - F.col("cut")) + F.col("left") * F.col("lower")) / F.col("total")
        level = level.select("lang", "first", "rest", p.alias("p"), F.lit(None).cast("double").alias("back"))
        # Each order feeds the next and the result; written once.
        out.append(stage_table(level, f"order-{order}"))
    return out


class Model:
    """Per order the sorted hashes of its n-grams, with log probability and
    log context weight (NaN where there is none)."""

    def __init__(self, orders: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        self.orders = orders

    def _find(self, order: int, keys: np.ndarray, part: int) -> np.ndarray:
        hashes, values = self.orders[order][0], self.orders[order][part]
        if not len(hashes):
            return np.full(len(keys), np.nan, np.float32)
        at = np.minimum(np.searchsorted(hashes, keys), len(hashes) - 1)
        return np.where(hashes[at] == keys, values[at], np.float32(np.nan))

    def log_probabilities(self, salt: np.ndarray, first: np.ndarray, rest: np.ndarray) -> np.ndarray:
        """Log probability of the last character of every 4-gram; n-grams that
        were never seen back off. An unknown language is uniform over the code
        points."""
        out = np.zeros(len(rest))
        todo = np.arange(len(rest))
        for order in range(ORDER, 0, -1):
            head = first[todo] if order == ORDER else np.zeros(len(todo), np.int64)
            gram = rest[todo] & ((1 << (BITS * min(order, ORDER - 1))) - 1)
            logs = self._find(order, gram_hash(salt[todo], order, head, gram), 1)
            hit = ~np.isnan(logs)
            out[todo[hit]] += logs[hit]
            todo, head, gram = todo[~hit], head[~hit], gram[~hit]
            if not len(todo):
                return out
            context = (gram >> BITS) | (head << (BITS * 2))
            backs = self._find(order - 1, gram_hash(salt[todo], order - 1, np.zeros(len(todo), np.int64), context), 2)
            out[todo] += np.nan_to_num(backs)
        empty = np.zeros(len(todo), np.int64)
        share = self._find(0, gram_hash(salt[todo], 0, empty, empty), 1)
        out[todo] += np.where(np.isnan(share), -np.log(CODE_POINTS), share)
        return out


def _hashed(level: DataFrame, order: int) -> DataFrame:
    """``key, p, back``: hash, log probability and log context weight."""
    def run(batches):
        for batch in batches:
            first, rest = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("first", "rest"))
            keys = gram_hash(_salts(batch.column("lang").to_pylist()), order, first, rest)
            yield pa.record_batch([pa.array(keys.view(np.int64)), batch.column("p"), batch.column("back")], ["key", "p", "back"])

    # A weight of 0 leaves nothing; its logarithm is kept finite.
    logs = level.select("lang", "first", "rest", F.ln("p").cast("float").alias("p"),
                        F.when(F.col("back").isNotNull(), F.ln(F.greatest("back", F.lit(1e-30)))).cast("float").alias("back"))
    return logs.mapInArrow(run, "key bigint, p float, back float")


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> list[DataFrame]:
    """The orders of :func:`kneser_ney`, hashed and written: ``key, p, back``."""
    counts = stage_table(count_grams(docs, text_col, lang_col), "grams")
    return [stage_table(_hashed(level, order), f"model-{order}") for order, level in enumerate(kneser_ney(counts))]


def gather(levels: list[DataFrame]) -> Model:
    """The written model as sorted hash arrays (at most ``MODEL_KEYS`` rows)."""
    orders = []
    for level in levels:
        found = level.toArrow()
        keys = found.column("key").to_numpy().view(np.uint64)
        order = np.argsort(keys)
        values = [found.column(c).to_numpy().astype(np.float32)[order] for c in ("p", "back")]
        orders.append((keys[order], *values))
    return Model(orders)


def _per_document(hashes: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Hashes that differ between documents."""
    return mix64(hashes + docs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def base_counts(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """Counts of the base rules, one per document."""
    import pandas as pd
    n = len(offsets) - 1
    space = is_space(data)
    in_docs = lambda flags: np.diff(np.append(0, np.cumsum(flags))[offsets])
    starts, ends = ranges(~space, offsets)
    docs = document_of(starts, offsets)
    words = span_hashes(data, starts, ends)
    out = {"n_words": np.bincount(docs, minlength=n), "word_chars": in_docs(~space & ((data & 0xC0) != 0x80)),
           "n_symbols": in_docs(np.isin(data, np.frombuffer(b"#*$%&|<>", np.uint8)))}
    # Lines with a word, less the distinct ones.
    begin, end = ranges(data != 10, offsets)
    filled = np.append(0, np.cumsum(~space))
    with_word = filled[end] > filled[begin]
    begin, end = begin[with_word], end[with_word]
    line_docs = document_of(begin, offsets)
    again = pd.Series(_per_document(span_hashes(data, begin, end), line_docs)).duplicated().to_numpy()
    out["n_dup_lines"] = np.bincount(line_docs[again], minlength=n)
    # Words inside any 3-word window that occurs twice or more in the text.
    covered = np.zeros(len(words), bool)
    if len(words) >= 3:
        inside = docs[2:] == docs[:-2]
        windows = words[:-2] * np.uint64(3) + mix64(words[1:-1] + np.uint64(1)) + mix64(words[2:] ^ np.uint64(0x5851F42D))
        codes, _ = pd.factorize(_per_document(mix64(windows), docs[:-2])[inside])
        at = np.flatnonzero(inside)[np.bincount(codes)[codes] >= 2] if len(codes) else np.zeros(0, np.int64)
        for k in range(3):
            covered[at + k] = True
    out["n_repeat_words"] = np.bincount(docs[covered], minlength=n)
    return out


COUNTED = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def measure(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text",
            lang_col: str = "lang") -> DataFrame:
    """``doc_id, key, lang``, the base counts, and ``log_sum``, the negative log
    probability of the text under the model (null without text or model)."""
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text_key(text).alias("key"), _language(lang_col).alias("lang"),
                       text.alias("text"))

    def run(batches):
        for batch in small_batches(batches, "text", BATCH_TEXT):
            found = base_counts(*batch_bytes(batch.column("text")))
            logs = [None] * batch.num_rows
            if shared.value is not None:
                first, rest, bounds = grams(batch.column("text"))
                salt = np.repeat(_salts(batch.column("lang").to_pylist()), np.diff(bounds))
                one, codes = _distinct(gram_hash(salt, ORDER, first, rest))
                each = -shared.value.log_probabilities(salt[one], first[one], rest[one])
                logs, filled = np.full(batch.num_rows, np.nan), np.diff(bounds) > 0
                if filled.any():
                    logs[filled] = np.add.reduceat(each[codes], bounds[:-1][filled])
            yield pa.record_batch([batch.column("doc_id"), batch.column("key"), batch.column("lang"),
                                   *[pa.array(found[c].astype(np.int64)) for c in COUNTED],
                                   pa.array(logs, pa.float64(), from_pandas=True)],
                                  ["doc_id", "key", "lang", *COUNTED, "log_sum"])

    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("doc_id", "key", "lang")}
    return rows.mapInArrow(run, ", ".join([*[f"{c} {k}" for c, k in kinds.items()], *[f"{c} bigint" for c in COUNTED],
                                           "log_sum double"]))


def joined_scores(docs: DataFrame, levels: list[DataFrame], id_col: str = "doc_id", text_col: str = "text",
                  lang_col: str = "lang") -> DataFrame:
    """``doc_id, key, lang, log_sum`` of every distinct text by joins with a
    model of any size: order by order, the n-grams that are not found go on to
    the next one with the weight of their context."""
    bound_batches(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text_key(text).alias("key"), _language(lang_col).alias("lang"),
                       text.alias("text"))
    names = [f"g{k}" for k in range(ORDER + 1)]

    def run(batches):
        for batch in small_batches(batches, "text", BATCH_TEXT):
            first, rest, bounds = grams(batch.column("text"))
            docs_at = np.repeat(np.arange(batch.num_rows), np.diff(bounds))
            salt = _salts(batch.column("lang").to_pylist())[docs_at]
            one, codes = _distinct(mix64(gram_hash(salt, ORDER, first, rest) + mix64(docs_at.astype(np.uint64))))
            zero = np.zeros(len(one), np.int64)
            keys = [gram_hash(salt[one], k, first[one] if k == ORDER else zero,
                              rest[one] & ((1 << (BITS * min(k, ORDER - 1))) - 1)) for k in range(ORDER + 1)]
            contexts = [gram_hash(salt[one], k, zero, (rest[one] & ((1 << (BITS * min(k + 1, ORDER - 1))) - 1)) >> BITS
                                  | (first[one] << (BITS * 2) if k + 1 == ORDER else 0)) for k in range(ORDER)]
            at = pa.array(docs_at[one])
            yield pa.record_batch(
                [batch.column(c).take(at) for c in ("doc_id", "key", "lang")] + [pa.array(np.bincount(codes, minlength=len(one)))]
                + [pa.array(k.view(np.int64)) for k in [*keys, *contexts]],
                ["doc_id", "key", "lang", "n", *names, *[f"h{k}" for k in range(ORDER)]])

    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("doc_id", "key", "lang")}
    open_ = rows.distinct().mapInArrow(run, ", ".join(
        [*[f"{c} {k}" for c, k in kinds.items()], "n bigint", *[f"{n} bigint" for n in names],
         *[f"h{k} bigint" for k in range(ORDER)]])).withColumn("log", F.lit(0.0))
    done = []
    for order in range(ORDER, -1, -1):
        level = levels[order].select(F.col("key").alias(f"g{order}"), "p").where("p is not null")
        found = open_.join(level, f"g{order}", "left")
        if order:
            found = stage_table(found, f"scores-{order}")
            done.append(found.where("p is not null").withColumn("log", F.col("log") + F.col("p")))
            weights = levels[order - 1].select(F.col("key").alias(f"h{order - 1}"), "back").where("back is not null")
            open_ = (found.where("p is null").drop("p").join(weights, f"h{order - 1}", "left")
                          .withColumn("log", F.col("log") + F.coalesce("back", F.lit(0.0))).drop("back"))
        else:
            unknown = F.coalesce("p", F.lit(-float(np.log(CODE_POINTS))))
            done.append(found.withColumn("log", F.col("log") + unknown))
    parts = [d.select("doc_id", "key", "lang", "n", "log") for d in done]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every.groupBy("doc_id", "key", "lang").agg((-F.sum(F.col("n") * F.col("log"))).alias("log_sum"))


def scored(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Base counts and ``log_ppl``, the negative log probability per word."""
    levels = fit(docs, text_col, lang_col)
    size = sum(level.count() for level in levels)
    if size <= MODEL_KEYS:
        found = measure(docs, gather(levels), id_col, text_col, lang_col)
    else:
        logs = joined_scores(docs, levels, id_col, text_col, lang_col).select(
            F.col("doc_id").alias("_id"), F.col("key").alias("_key"), F.col("lang").alias("_lang"), F.col("log_sum").alias("_log"))
        base = measure(docs, None, id_col, text_col, lang_col).drop("log_sum")
        found = base.join(logs, base["doc_id"].eqNullSafe(logs["_id"]) & (base["key"] == logs["_key"])
                          & (base["lang"] == logs["_lang"]), "left").drop("_id", "_key", "_lang").withColumnRenamed("_log", "log_sum")
    return found.select("doc_id", "lang", *COUNTED, F.when(F.col("n_words") > 0, F.col("log_sum") / F.col("n_words")).alias("log_ppl"))


def _median(bins: DataFrame, value: str) -> DataFrame:
    """``lang, median`` of integer values with multiplicities ``n``."""
    by = Window.partitionBy("lang")
    run = bins.withColumns({"upto": F.sum("n").over(by.orderBy(value)), "all": F.sum("n").over(by)})
    return run.where(2 * F.col("upto") >= F.col("all")).groupBy("lang").agg(F.min(value).alias("median"))


def bands(measured: DataFrame) -> DataFrame:
    """``lang, middle, scale`` from all measured documents: the median of the
    log perplexity, and the median of its distance times the root of the
    number of words (a mean over few words strays farther). Medians are exact
    on grids of 1/1000 (of the logarithm, for the scale), so they do not depend
    on task order and a language has some ten thousand cells at most."""
    grid = F.floor(F.col("log_ppl") * 1000).cast("bigint").alias("v")
    rows = measured.where("log_ppl is not null").select("lang", "n_words", grid)
    bins = rows.groupBy("lang", "v").agg(F.count(F.lit(1)).alias("n"))
    middle = F.broadcast(_median(bins, "v"))  # one row per language
    off = F.floor(F.log1p(F.abs(F.col("v") - F.col("median")) * F.sqrt("n_words")) * 1000).cast("bigint").alias("off")
    away = rows.join(middle, "lang").groupBy("lang", off).agg(F.count(F.lit(1)).alias("n"))
    spread = _median(away, "off").withColumnRenamed("median", "scale")
    return middle.join(spread, "lang").select("lang", (F.col("median") / 1000).alias("middle"),
                                              (F.expm1(F.col("scale") / 1000) / 1000).alias("scale"))


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``doc_id``, base counts, ``base_failed, perplexity, kept`` per row.

    A document is kept if it passes the base rules and the distance of its log
    perplexity (per word) from its language's median is at most ``LEAST_BAND``
    plus ``BAND`` times the language's scale over the root of its words: an
    upper and a lower limit for every length.

    Null and empty texts have no words, fail the base rules and have a null
    perplexity. A null language is a language of its own. Null and repeated
    ids are carried; repeated rows count as often as they occur. No rows, no
    result; other columns are dropped.
    """
    found = stage_table(scored(docs, id_col, text_col, lang_col), "quality")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    # On the grid of the median, one step of it included.
    away = F.abs(F.floor(F.col("log_ppl") * 1000) / 1000 - F.col("middle")) - 0.001
    inside = F.coalesce(away <= LEAST_BAND + BAND * F.col("scale") / F.sqrt("n_words"), F.lit(False))
    return (found.join(F.broadcast(bands(found)), "lang", "left")  # one row per language
                 .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         failed.alias("base_failed"), F.exp("log_ppl").alias("perplexity"), (~failed & inside).alias("kept")))


def op6_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality verdict of every document."""
    return quality(table(spark, sf_dir, "documents", ["doc_id", "text", "lang"]))
