"""Near-duplicate documents: SuperMinHash signatures, banding, verification on
full shingle sets, and connected components.

Signature: element ``e`` visits the positions of a signature in an order of
its own (a random permutation, drawn level by level); at level ``j`` it offers
the value ``j + u_j(e)`` to the position it visits, and a position keeps the
least offer. Two sets agree in a position with probability equal to their
Jaccard similarity, with less variance than independent minima. Once every
position of a document holds a value below ``j + 1``, no later level can
change it, so its elements stop there: long texts take one or two levels.

Links are exact on what banding proposes:

1. documents with the same shingle set are one class; only classes are banded;
2. in every bucket each class is compared with one leader (a star, not all
   pairs), on full sets, and components are formed;
3. in a bucket whose classes are not yet one component, every class outside
   its largest component is held against the members of other components. A
   pair cannot be linked, and is skipped, if its distances to the leader
   differ by more than 1/4 (Jaccard distance obeys the triangle inequality),
   or if too many shingles of one side occur in no other class of these
   buckets. Of the others, those whose signatures agree in ``LEAST_AGREE``
   positions, and whose longer signatures (made for these classes only) agree
   in ``LEAST_LONG``, are compared on full sets.

With 32 bands of 4 rows, a pair at the similarity of 0.75 shares no bucket
with probability 5e-6. Its signatures agree in 96 of 128 positions, give or
take 4.9, and in 378 of 504, give or take 9.7 (less, as the variance is below
the binomial one), so it falls below the bounds of step 3 with a probability
of about 1e-6.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.llm.columns import bound_batches, broadcast_if_small
from waymark.llm.textbytes import (batch_bytes, document_of, is_space, lower_ascii, mix64, ranges,
                                   small_batches, span_hashes)
from waymark.sources.tables import stage_table, table

WORDS = 5
BANDS, ROWS = 32, 4
POSITIONS = BANDS * ROWS
#: A pair is linked when PERCENT * union <= 100 * intersection.
PERCENT = 75
LEAST_AGREE = 72
LONG_POSITIONS, LONG_SALTS, LEAST_LONG = 252, (1, 2), 332
#: Positions per word of a packed signature, 7 bits each in a byte.
PACKED = 7
#: Ids of at most this many classes are broadcast (8 bytes each); more are joined by a shuffle.
BROADCAST_ROWS = 2_000_000
#: Pairs of one hot class per task.
SALT_ROWS = 64
#: Labels of at most this many nodes are broadcast (16 bytes each).
LABEL_ROWS = 1_000_000
#: Pairs of a bucket that one task looks at.
SALT_PAIRS = 200_000

_STEP = np.uint64(0x9E3779B97F4A7C15)
_WORD_FACTORS = mix64(np.arange(11, 11 + WORDS, dtype=np.uint64)) | np.uint64(1)
_ROW_FACTORS = mix64(np.arange(41, 41 + ROWS, dtype=np.uint64)) | np.uint64(1)


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct hashes of the 5-word shingles of every document. Fewer
    words are one shingle; no words give an empty set."""
    data = lower_ascii(data)
    starts, ends = ranges(~is_space(data), offsets)
    n_docs = len(offsets) - 1
    words = span_hashes(data, starts, ends)
    first = np.searchsorted(starts, offsets)
    n_words = np.diff(first)
    out = np.zeros(0, np.uint64)
    if len(words) >= WORDS:
        out = words[:len(words) - WORDS + 1] * _WORD_FACTORS[0]
        for k in range(1, WORDS):
            out += words[k:len(words) - WORDS + 1 + k] * _WORD_FACTORS[k]
        out = mix64(out)
    sets = []
    for doc in range(n_docs):
        n, at = int(n_words[doc]), int(first[doc])
        if n >= WORDS:
            sets.append(np.unique(out[at:at + n - WORDS + 1]))
        elif n:
            whole = (words[at:at + n] * _WORD_FACTORS[:n]).sum(dtype=np.uint64)
            sets.append(mix64(np.array([whole + np.uint64(n)])))
        else:
            sets.append(out[:0])
    return sets


def signatures(sets: list[np.ndarray], m: int = POSITIONS, block: int = 1 << 16) -> np.ndarray:
    """SuperMinHash signatures, ``len(sets) x m``; a value is the level in the
    high byte and 56 random bits. Empty sets keep the greatest value."""
    if m > 255:
        raise ValueError("at most 255 positions")
    sizes = np.array([len(s) for s in sets], np.int64)
    values = np.full((len(sets), m), np.uint64(2**64 - 1))
    flat = values.reshape(-1)
    # Blocks bound the memory of the permutations; a set cut by a block is
    # exact still, as each part keeps its own least offers.
    elements = np.concatenate(sets) if len(sets) else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    for begin in range(0, len(elements), block):
        _offer(elements[begin:begin + block], owner[begin:begin + block], values, flat, m)
    return values


def _offer(elements, owner, values, flat, m):
    order = None
    for level in range(m):
        bits = mix64(elements + np.uint64(int(_STEP) * (level + 1) % (1 << 64)))
        pick = mix64(bits ^ _STEP) >> np.uint64(32)
        place = level + ((pick * np.uint64(m - level)) >> np.uint64(32)).astype(np.int64)
        if level == 0:
            position = place
        else:
            if order is None:
                # Permutations of the elements that go on, with the swap of level 0 made.
                order = np.tile(np.arange(m, dtype=np.uint8), (len(elements), 1))
                row = np.arange(len(elements))
                order[row, 0], order[row, first] = first, 0
            row = np.arange(len(elements))
            position = order[row, place].astype(np.int64)
            order[row, place] = order[row, level]
        np.minimum.at(flat, owner * m + position, (np.uint64(level) << np.uint64(56)) | (bits >> np.uint64(8)))
        docs = np.unique(owner) if level else owner[np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))]
        open_ = np.zeros(len(values), bool)
        open_[docs] = values[docs].max(1) >= (np.uint64(level + 1) << np.uint64(56))
        go = open_[owner]
        if not go.any():
            return
        if level == 0:
            first = place[go]
        if not go.all():
            elements, owner = elements[go], owner[go]
            if order is not None:
                order = order[go]


def band_keys(values: np.ndarray) -> np.ndarray:
    """One 64-bit key per band; the band number is part of it."""
    rows = values.reshape(len(values), BANDS, ROWS)
    return mix64((mix64(rows) * _ROW_FACTORS).sum(2, dtype=np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64))


def packed(values: np.ndarray) -> np.ndarray:
    """Seven bits of every position, seven positions in a word."""
    short = np.zeros((len(values), -(-values.shape[1] // PACKED) * PACKED), np.uint64)
    short[:, :values.shape[1]] = mix64(values) & np.uint64(0x7F)
    shifts = np.arange(PACKED, dtype=np.uint64) * np.uint64(8)
    return (short.reshape(len(values), -1, PACKED) << shifts).sum(2, dtype=np.uint64)


def agreeing(a: str, b: str, positions: int) -> F.Column:
    """Positions in which two packed signatures agree (others agree by chance
    in one of 128). Short signatures are written out word by word, which Spark
    compiles; it interprets lambdas."""
    ones, high = F.lit(0x007F7F7F7F7F7F7F), F.lit(0x0080808080808080)
    words = -(-positions // PACKED)

    def differ(x, y):
        return F.bit_count((x.bitwiseXOR(y) + ones).bitwiseAND(high))

    if words <= 24:
        return positions - reduce(operator.add, [differ(F.get(a, F.lit(k)), F.get(b, F.lit(k))) for k in range(words)])
    return positions - F.aggregate(F.zip_with(F.col(a), F.col(b), differ), F.lit(0), lambda s, x: s + x)


def set_key(hashes: np.ndarray) -> tuple[int, int]:
    """128 bits that identify a set."""
    return (int(mix64(hashes).sum(dtype=np.uint64).view(np.int64)),
            int(mix64(hashes ^ _STEP).sum(dtype=np.uint64).view(np.int64)))


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text_hash, n, h1, h2, bands, sig`` per row: hash of the text
    as it is, set size, set key, band keys and packed signature (null for an
    empty set)."""
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), text_hash(text_col).alias("text_hash"),
                       F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            sets = shingle_sets(*batch_bytes(batch.column("text")))
            values = signatures(sets)
            bands, short = band_keys(values).view(np.int64), packed(values).view(np.int64)
            keys = [set_key(s) for s in sets]
            yield pa.record_batch([
                batch.column("doc_id"), batch.column("text_hash"), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()),
                *[pa.array([x if len(s) else None for s, x in zip(sets, xs, strict=True)], pa.list_(pa.int64()))
                  for xs in (bands, short)]], ["doc_id", "text_hash", "n", "h1", "h2", "bands", "sig"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, text_hash bigint, n bigint, h1 bigint, h2 bigint, "
                                "bands array<bigint>, sig array<bigint>")


def text_hash(text_col: str) -> F.Column:
    """Tells apart the texts of rows that share an id."""
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def class_sets(docs: DataFrame, needed: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``cid, shingles`` of the needed classes (``cid, doc_id, h1, h2``),
    from the text of each class's first document."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.join(broadcast_if_small(needed, BROADCAST_ROWS), rows["doc_id"].eqNullSafe(needed["doc_id"])).select("cid", "h1", "h2", "text")

    def run(batches):
        for batch in small_batches(batches, "text"):
            sets = shingle_sets(*batch_bytes(batch.column("text")))
            # Another text under the same id is not the class's.
            mine = [set_key(s) == k for s, k in zip(
                sets, zip(batch.column("h1").to_pylist(), batch.column("h2").to_pylist(), strict=True), strict=True)]
            yield pa.record_batch([
                batch.column("cid").filter(pa.array(mine, pa.bool_())),
                pa.array([s.view(np.int64) for s, m in zip(sets, mine, strict=True) if m], pa.list_(pa.int64()))],
                ["cid", "shingles"])

    found = rows.mapInArrow(run, "cid bigint, shingles array<bigint>")
    return stage_table(found, "shingle-sets").dropDuplicates(["cid"])


def common(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` (``a, b``) with ``shared``, the size of the intersection of
    their sets. ``b`` may be hot (a leader): its pairs are dealt over as many
    tasks as they need and its set is repeated for each."""
    hot = pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / SALT_ROWS).cast("int").alias("salts"))
    left = (pairs.join(sets.select(F.col("cid").alias("a"), F.col("shingles").alias("set_a")), "a")
                 .join(hot, "b")
                 .withColumn("salt", F.pmod(F.xxhash64("a"), F.col("salts")).cast("int")).drop("salts"))
    right = (sets.select(F.col("cid").alias("b"), F.col("shingles").alias("set_b")).join(hot, "b")
                 .withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts"))
    return (left.join(right, ["b", "salt"])
                .withColumn("shared", F.size(F.array_intersect("set_a", "set_b")).cast("bigint"))
                .drop("set_a", "set_b", "salt"))


def long_signatures(sets: DataFrame) -> DataFrame:
    """``cid, long``: packed longer signatures from the shingle sets."""
    def run(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                found = [s.values.to_numpy().view(np.uint64) for s in part.column("shingles")]
                both = np.concatenate([signatures([mix64(s + np.uint64(salt)) for s in found], LONG_POSITIONS)
                                       for salt in LONG_SALTS], 1)
                yield pa.record_batch([part.column("cid"), pa.array(list(packed(both).view(np.int64)), pa.list_(pa.int64()))],
                                      ["cid", "long"])

    return sets.select("cid", "shingles").mapInArrow(run, "cid bigint, long array<bigint>")


def linked(shared: str, n_a: str, n_b: str) -> F.Column:
    return 100 * F.col(shared) >= PERCENT * (F.col(n_a) + F.col(n_b) - F.col(shared))


def may_link(n_a, n_b) -> F.Column:
    """Sizes alone allow a link."""
    return 100 * F.least(n_a, n_b) >= PERCENT * F.greatest(n_a, n_b)


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of the edges (``a, b``): the least node
    reachable. Least labels travel over the edges and along themselves; each
    round is written below the checkpoint folder."""
    both = stage_table(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
                            .distinct(), "links")
    labels = stage_table(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("root")),
                         "labels")
    # The nodes stay the same: counted once. Few labels are sent to the edges.
    beside = F.broadcast if labels.count() <= LABEL_ROWS else (lambda df: df)
    while True:
        near = (both.join(beside(labels.select(F.col("node").alias("b"), "root")), "b")
                    .groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near")))
        least = near.join(beside(labels), "node").select("node", F.least("root", "near").alias("root"),
                                                         F.col("root").alias("old"))
        jump = beside(labels.select(F.col("node").alias("root"), F.col("root").alias("jump")))
        after = stage_table(least.join(jump, "root", "left")
                                 .select("node", F.least("root", "jump").alias("root"), "old"), "labels")
        changed = after.where("root <> old").limit(1).count()
        labels = after.select("node", "root")
        if not changed:
            return labels


def _classes(feats: DataFrame) -> DataFrame:
    """One row per distinct non-empty set: ``cid`` (a number given when the
    table is written), ``doc_id`` (the least), ``n, h1, h2, bands``."""
    return stage_table(
        feats.where("n > 0").groupBy("n", "h1", "h2")
             .agg(F.min("doc_id").alias("doc_id"), F.any_value(F.struct("bands", "sig")).alias("any"))
             .select(F.monotonically_increasing_id().alias("cid"), "doc_id", "n", "h1", "h2", "any.bands", "any.sig"),
        "classes")


def _links(docs: DataFrame, classes: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """All verified links between classes that the star and cross steps need."""
    members = classes.select("cid", "n", F.explode("bands").alias("bucket"))
    sizes = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    shared = stage_table(members.join(sizes, "bucket"), "shared-buckets")
    # The class that meets most others leads: the original of a group of
    # edited copies is nearer to all of them than they are to each other.
    weight = shared.groupBy("cid").agg(F.sum("size").alias("weight"))
    heads = (shared.join(weight, "cid").groupBy("bucket")
                   .agg(F.max_by(F.struct("cid", "n"), F.struct("weight", -F.col("cid"))).alias("head")))
    placed = stage_table(
        shared.join(heads, "bucket").select("bucket", "cid", "n", F.col("head.cid").alias("leader"),
                                            F.col("head.n").alias("leader_n")), "buckets")
    star = placed.where("cid <> leader").select(F.col("cid").alias("a"), F.col("n").alias("n_a"),
                                                F.col("leader").alias("b"), F.col("leader_n").alias("n_b"))
    star = stage_table(star.where(may_link("n_a", "n_b")).distinct(), "star-pairs")
    in_buckets = classes.join(placed.select("cid").distinct(), "cid", "left_semi").select("cid", "doc_id", "h1", "h2")
    sets = class_sets(docs, in_buckets, id_col, text_col)
    starred = stage_table(common(star, sets), "star")
    links = starred.where(linked("shared", "n_a", "n_b")).select("a", "b")
    labels = components(links)

    # Buckets that still hold several components. Their leaders are done.
    root = labels.select(F.col("node").alias("cid"), "root")
    rooted = (placed.where("cid <> leader").join(root, "cid", "left")
                    .withColumn("root", F.coalesce("root", "cid")))
    main = (rooted.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("rows"))
                  .groupBy("bucket").agg(F.max_by("root", F.struct("rows", "root")).alias("main"),
                                         F.count(F.lit(1)).alias("roots")).where("roots > 1").drop("roots"))
    distance = starred.select(F.col("a").alias("cid"), F.col("b").alias("leader"),
                              (1 - F.col("shared") / (F.col("n_a") + F.col("n_b") - F.col("shared"))).alias("far"))
    open_ = stage_table(rooted.join(main, "bucket").join(distance, ["cid", "leader"], "left")
                              .withColumn("stranger", F.col("root") != F.col("main"))
                              .select("bucket", "cid", "n", "root", "far", "stranger"), "open-buckets")
    inside = open_.select("cid").distinct()
    # Shingles that no other class of these buckets has are shared with none.
    owners = (sets.join(inside, "cid", "left_semi").select("cid", F.explode("shingles").alias("shingle"))
                  .groupBy("shingle").agg(F.count(F.lit(1)).alias("owners"), F.min("cid").alias("cid")))
    alone = owners.where("owners = 1").groupBy("cid").agg(F.count(F.lit(1)).alias("alone"))
    longer = long_signatures(sets.join(inside, "cid", "left_semi"))
    facts = (classes.join(inside, "cid", "left_semi").select("cid", "sig", "bands").join(longer, "cid")
                    .join(alone, "cid", "left").withColumn("alone", F.coalesce("alone", F.lit(0))))
    open_ = open_.join(facts, "cid").withColumn("common", F.col("n") - F.col("alone"))
    carried = ("cid", "n", "root", "far", "common", "sig", "long", "bands", "stranger")
    one, other = (open_.select("bucket", *[F.col(c).alias(f"{c}_{side}") for c in carried]) for side in "ab")
    most = F.least("common_a", "common_b")
    # Every pair is looked at in the first bucket that it shares.
    here = F.get("bands_a", F.array_position(F.zip_with("bands_a", "bands_b", lambda a, b: a == b), True).cast("int") - 1)
    # A bucket's strangers are dealt over as many tasks as its pairs need.
    load = (open_.groupBy("bucket").agg(F.count(F.lit(1)).alias("rows"), F.count_if("stranger").alias("strangers"))
                 .select("bucket", F.ceil(F.col("rows") * F.col("strangers") / SALT_PAIRS).cast("int").alias("salts"))
                 .where("salts > 0"))
    load = broadcast_if_small(stage_table(load, "bucket-loads"))
    one = (one.where("stranger_a").join(load, "bucket")
              .withColumn("salt", F.pmod(F.xxhash64("cid_a"), F.col("salts")).cast("int")).drop("salts"))
    other = other.join(load, "bucket").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")
    cross = (one.join(other, ["bucket", "salt"])
                .where((F.col("root_a") != F.col("root_b")) & may_link(F.col("n_a"), F.col("n_b"))
                       & (~F.col("stranger_b") | (F.col("cid_a") < F.col("cid_b")))
                       & (F.coalesce(F.abs(F.col("far_a") - F.col("far_b")), F.lit(0)) <= 0.25 + 1e-9)
                       & (100 * most >= PERCENT * (F.col("n_a") + F.col("n_b") - most))
                       & (agreeing("sig_a", "sig_b", POSITIONS) >= LEAST_AGREE)
                       & (here == F.col("bucket"))
                       & (agreeing("long_a", "long_b", LONG_POSITIONS * len(LONG_SALTS)) >= LEAST_LONG))
                .select(F.col("cid_a").alias("a"), F.col("cid_b").alias("b"), "n_a", "n_b"))
    crossed = stage_table(common(stage_table(cross, "cross-pairs"), sets)
                          .where(linked("shared", "n_a", "n_b")).select("a", "b"), "cross-links")
    # The stars' components stand for their links.
    return labels.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(crossed)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept, text_hash`` for every row.

    ``component_id`` is the least id of the documents reachable over links,
    ``kept`` tells whether it is the row's own. Texts without words (null,
    empty, white space) are linked with nothing. Rows with the same text are
    linked, also under the same id (all carry the same component). A null id
    is never the least; a component of null ids only has a null component, and
    its rows are kept. No rows, no result; other columns are dropped.
    """
    feats = stage_table(features(docs, id_col, text_col), "minhash")
    classes = _classes(feats)
    labels = components(_links(docs, classes, id_col, text_col))
    rooted = (classes.join(labels.select(F.col("node").alias("cid"), "root"), "cid", "left")
                     .select("n", "h1", "h2", "doc_id", F.coalesce("root", "cid").alias("root")))
    least = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"), F.count(F.lit(1)).alias("classes"))
    # Only components of several classes need the join.
    several = least.where("classes > 1").select("root", F.col("component_id").alias("least"))
    by_class = (rooted.join(several, "root", "left")
                      .select("n", "h1", "h2", F.coalesce("least", "doc_id").alias("component_id")))
    found = feats.where("n > 0").select("doc_id", "text_hash", "n", "h1", "h2").join(by_class, ["n", "h1", "h2"])
    out = found.select("doc_id", "text_hash", "n", "component_id").unionByName(
        feats.where("n = 0").select("doc_id", "text_hash", "n", F.col("doc_id").alias("component_id")))
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id",
                      F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "text_hash")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each near-duplicate group: the one with
    the least id. Texts without words stay. Of rows with the same id and text
    one stays; rows of the least id with different texts all stay."""
    found = stage_table(near_duplicates(docs, id_col, text_col), "near-duplicates")
    same = lambda rows: docs[id_col].eqNullSafe(rows["_wm_id"]) & (text_hash(text_col) == rows["_wm_hash"])
    keyed = found.select(F.col("doc_id").alias("_wm_id"), F.col("text_hash").alias("_wm_hash"), "kept")
    gone = broadcast_if_small(keyed.where("not kept").select("_wm_id", "_wm_hash").distinct())
    repeats = keyed.groupBy("_wm_id", "_wm_hash").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    repeats = stage_table(repeats.select("_wm_id", "_wm_hash"), "repeated-rows")
    left = docs.join(gone, same(gone), "left_anti")
    if not repeats.limit(1).count():
        return left
    again = broadcast_if_small(repeats)
    return left.join(again, same(again), "left_anti").unionByName(
        left.join(again, same(again), "left_semi").dropDuplicates([id_col, text_col]))


def op3_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents."""
    return near_duplicates(table(spark, sf_dir, "documents", ["doc_id", "text"]))
