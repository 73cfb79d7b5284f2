"""Benchmark decontamination by spaced-seed hashing (native).

A seed is the hash of the words under a fixed mask; positions under a 0 are
ignored, so a substituted word spoils only the masks that look at it. Seeds of
all benchmark items are joined with the seeds at every word of every
document. A hit gives a diagonal (document position less item position);
along it the words of document and item are compared, and the pair counts as
an overlap if some window of ``WINDOW`` words of the item (or the whole item,
if shorter) agrees in ``AGREE`` percent of its words.

Words are runs of letters and digits, lower-cased.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.llm.columns import broadcast_if_small, text_key
from waymark.sources.tables import stage_table, table

WINDOW, AGREE = 13, 80
#: Mask, and the least and greatest number of words of the items it is for. Every
#: pattern of substitutions that ``AGREE`` accepts leaves at least one place of
#: one of an item's masks untouched (a test goes through all patterns). Items
#: of fewer than 5 words must agree in all of them.
LONG = 1 << 30
MASKS = (("1101011", 12, LONG), ("11100111", 12, LONG),
         ("1111", 5, 11), ("11011", 5, 11), ("10111", 5, 5), ("11101", 5, 5),
         ("1", 1, 1), ("11", 2, 2), ("111", 3, 3), ("1111", 4, 4))
#: Seeds broadcast at once (about 40 bytes each); a larger benchmark is taken in blocks.
BLOCK_SEEDS = 1_000_000


def word_hashes(text: Column) -> Column:
    words = F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+", -1), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _seeds(masks: list[tuple[str, int, int]], items: bool) -> Column:
    """Seeds that begin at ``pos`` of the array ``hs``, one per mask; a mask
    that does not fit gives a null, as does, in ``items``, one for items of
    other lengths. The mask's number is part of the seed."""
    def seed(number, mask, least, most):
        picked = [F.get("hs", F.col("pos") + k) for k, bit in enumerate(mask) if bit == "1"]
        fits = F.col("pos") + len(mask) <= F.size("hs")
        if items:
            fits = fits & F.size("hs").between(least, most)
        return F.when(fits, F.xxhash64(F.lit(number), *picked))
    return F.array(*[seed(number, *mask) for number, mask in enumerate(masks)])


def _at_words(rows: DataFrame, masks: list[tuple[str, int, int]], items: bool = False) -> DataFrame:
    """One row per word and mask: ``pos, seed`` beside the columns of ``rows``."""
    placed = rows.select("*", F.posexplode("hs").alias("pos", "_h")).drop("_h")
    return placed.select("*", F.explode(_seeds(masks, items)).alias("seed")).where("seed is not null")


def overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``doc_id, key, item_id, matched, window, doc_word``: the best window of
    every overlapping (document, item); ``doc_word`` is the document word
    where the item would begin. ``key`` tells apart rows of one id.

    Short items have masks of their own. Null or wordless texts and items overlap with nothing; rows with null ids are
    carried; repeated rows give one result; ties between windows go to the
    first place. Items with the same words are compared once. Other columns
    are dropped.
    """
    items = benchmark.select(F.col(item_col).alias("item_id"), word_hashes(F.col(item_text_col)).alias("hs"))
    items = stage_table(items.where(F.size("hs") > 0), "benchmark")
    size = F.size("hs")
    # Lengths of short items: one number for all others.
    lengths = [r[0] for r in items.select(F.least(size, F.lit(WINDOW)).alias("n")).distinct().collect()]
    masks = [m for m in MASKS if any(m[1] <= n <= m[2] for n in lengths)] or [MASKS[0]]
    classes = stage_table(items.select("hs").distinct().withColumn("class", F.xxhash64("hs")), "benchmark-classes")
    n_seeds = (classes.agg(F.sum(size)).first()[0] or 0) * len(masks)
    blocks = max(1, -(-n_seeds // BLOCK_SEEDS))

    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text_key(text).alias("key"), word_hashes(text).alias("hs"))
    found = []
    for block in range(blocks):
        mine = classes.where(F.pmod(F.col("class"), F.lit(blocks)) == block)
        seeds = (_at_words(mine, masks, items=True)
                 .select("seed", F.col("pos").alias("item_pos"), size.alias("n"), "class").distinct())
        hits = _at_words(rows, masks).join(F.broadcast(seeds), "seed")  # a block holds at most BLOCK_SEEDS
        diagonal = F.col("pos") - F.col("item_pos")
        begin = F.greatest(diagonal, F.lit(0))
        part = F.slice(F.col("hs"), begin + 1, F.greatest(F.col("n") + diagonal - begin, F.lit(0)))
        found.append(hits.select("doc_id", "key", "class", diagonal.alias("doc_word"), part.alias("part"))
                         .groupBy("doc_id", "key", "class", "doc_word").agg(F.first("part").alias("part")))
    hits = reduce(DataFrame.unionByName, found)

    # Agreement of every item word with the word on the diagonal.
    lead = F.greatest(-F.col("doc_word"), F.lit(0))
    padded = F.concat(F.array_repeat(F.lit(None).cast("bigint"), lead), F.col("part"))
    agree = F.zip_with(F.col("hs"), padded, lambda a, b: F.when(a == b, 1).otherwise(0))
    compared = (hits.join(broadcast_if_small(classes), "class")
                    .withColumn("agree", F.slice(agree, 1, size)).withColumn("window", F.least(size, F.lit(WINDOW))))
    # Sums of all windows from the running sum of the agreements.
    sums = F.transform(F.sequence(F.lit(1), size - F.col("window") + 1),
                       lambda i: F.aggregate(F.slice("agree", i, F.col("window")), F.lit(0), lambda a, x: a + x))
    best = compared.select("doc_id", "key", "class", "doc_word", "window", F.array_max(sums).alias("matched"))
    best = (best.where(100 * F.col("matched") >= AGREE * F.col("window"))
                .groupBy("doc_id", "key", "class")
                .agg(F.max_by(F.struct("matched", "window", "doc_word"),
                              F.struct(F.col("matched"), -F.col("doc_word"))).alias("b")))
    members = items.select("item_id", F.xxhash64("hs").alias("class")).distinct()
    return best.join(broadcast_if_small(members), "class").select(
        "doc_id", "key", "item_id", "b.matched", "b.window", "b.doc_word")


def op7_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, benchmark item) overlap."""
    found = overlaps(table(spark, sf_dir, "documents", ["doc_id", "text"]),
                     table(spark, sf_dir, "benchmark", ["item_id", "text"]))
    return found.select("doc_id", "item_id", F.col("matched").cast("bigint").alias("matched"),
                        F.col("window").cast("bigint").alias("window"), F.col("doc_word").cast("bigint").alias("doc_word"))
