"""Mixing sources to target weights by capped water-filling.

Targets: the words of the mix are shared out by weight. A source whose share
exceeds its words times the greatest number of epochs is clamped there, and the
excess is shared by weight among the others, until no source is above. Each
round is one aggregation over the table of sources.

Sampling: a source whose target is ``e`` times its words gives every document
``floor(e)`` times, and once more to documents that make up the fraction. These
are drawn class by class, a class being the documents of a source with sizes of
the same binary magnitude, from the longest down: in the class's seeded order,
documents are taken up to the total nearest to its part of the fraction, and
what is missing or too much is carried to the next class. The drawn words
therefore differ from the target by about half a short document, and whole
documents are never cut.

The running totals of the seeded order come from a range partitioning, so a
source with a third of all documents spreads over many tasks. Only numbers
travel: texts are read once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waymark.llm.columns import BROADCAST_ROWS, broadcast_if_small
from waymark.operators.ordinal import _num_partitions, hash32, with_ordinal
from waymark.session import scratch_path
from waymark.sources.tables import stage_table, table

WORD = r"[^\x20\x09-\x0D]+"
SHARE, MAX_EPOCHS, SEED = 1.5, 2, 13
CYCLE = (5, 2, 1)


def words(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def cycled_weights(sources: DataFrame, cycle=CYCLE) -> DataFrame:
    """``source, weight``: the cycle dealt to the distinct sources by code
    point, a null source last."""
    ranked = with_ordinal(sources.select("source").distinct(), [F.col("source").isNull(), "source"])
    return ranked.select("source", F.element_at(F.array(*[F.lit(float(w)) for w in cycle]),
                                                (F.col("ordinal") % len(cycle) + 1).cast("int")).alias("weight"))


def water_fill(sources: DataFrame, share: float = SHARE, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """``sources`` (``size, weight`` and others) with ``target``. Sources
    without weight get nothing; if all others are clamped, the mix is smaller
    than asked for."""
    weight = F.coalesce(F.col("weight"), F.lit(0.0))
    cap = F.col("size") * F.lit(float(max_epochs))
    total, weights = sources.agg(F.sum("size"), F.sum(weight)).first()
    goal = share * (total or 0)
    left, weights, clamped = goal, weights or 0.0, 0
    while True:
        above = cap * F.lit(weights) < weight * F.lit(left)
        held, rest, count = sources.agg(F.sum(F.when(above, cap)), F.sum(F.when(~above, weight)), F.count_if(above)).first()
        if count == clamped:
            break
        left, weights, clamped = goal - (held or 0.0), rest or 0.0, count
        if not weights:
            break
    level = weight * F.lit(left) / F.lit(weights) if weights else F.when(weight > 0, cap).otherwise(0.0)
    return sources.withColumn("target", F.least(cap, level))


def seeded_totals(docs: DataFrame, seed: int) -> DataFrame:
    """``docs`` (``source_no, doc_id, tie, size``) with ``class`` (binary
    magnitude of the size) and ``upto``, the words of the class up to and with
    the document, in seeded order."""
    keys = ["class", "source_no", "draw", "doc_id", "tie"]
    rows = docs.where("size > 0").select(
        "source_no", "doc_id", "tie", "size", (F.length(F.bin("size")) - 1).cast("int").alias("class"),
        hash32(F.lit(seed), "doc_id").alias("draw"))
    ranged = (rows.repartitionByRange(_num_partitions(rows, None), *keys).sortWithinPartitions(*keys)
                  .drop("draw").withColumn("task", F.spark_partition_id()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, carried = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            group = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("class", "source_no")], 1)
            size = batch.column("size").to_numpy().astype(np.int64)
            new = np.append(True, (group[1:] != group[:-1]).any(1))
            upto = np.cumsum(size)
            first = np.flatnonzero(new)
            before = upto[first] - size[first]
            if last == tuple(group[0]):
                before[0] -= carried
            upto = upto - np.repeat(before, np.diff(np.append(first, len(size))))
            last, carried = tuple(group[-1]), int(upto[-1])
            yield pa.record_batch([*batch.columns, pa.array(upto)], [*batch.schema.names, "upto"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranged.schema.fields)
    # Rows and totals must come from one evaluation of the range shuffle.
    ranged = stage_table(ranged.mapInArrow(run, f"{kinds}, upto bigint"), "mix-order")
    sums = ranged.groupBy("task", "class", "source_no").agg(F.sum("size").alias("words"))
    # One row per task and group.
    before = Window.partitionBy("class", "source_no").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("task", "class", "source_no", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("start"))
    return (ranged.join(broadcast_if_small(starts), ["task", "class", "source_no"])
                  .withColumn("upto", F.col("upto") + F.col("start")).drop("task", "start"))


def _within(budget: Column) -> Column:
    """The document belongs to the prefix whose total is nearest to the budget."""
    return 2 * F.col("upto") - F.col("size") <= 2 * budget


def class_budgets(ordered: DataFrame, sources: DataFrame) -> DataFrame:
    """``class, source_no, budget``: the words to draw from every class of a
    source, with what longer classes left over or took too much. One round per
    class reads that class only; a round's state is one number per source."""
    spark = ordered.sparkSession
    fraction = sources.select("source_no", (F.col("extra") / F.col("size")).alias("fraction"), F.lit(0.0).alias("carry"))
    sizes = stage_table(ordered.groupBy("class", "source_no").agg(F.sum("size").alias("words")), "mix-classes")
    classes = sorted((r[0] for r in sizes.select("class").distinct().collect()), reverse=True)
    state, rounds = stage_table(fraction, "mix-carry"), []
    # One row per source meets the documents: a hot source stays where its rows are.
    beside = F.broadcast if state.count() <= BROADCAST_ROWS else (lambda df: df)
    for k in classes:
        here = state.join(sizes.where(F.col("class") == k), "source_no").select(
            "source_no", (F.col("fraction") * F.col("words") + F.col("carry")).alias("budget"))
        drawn = (ordered.where(F.col("class") == k).join(beside(here), "source_no")
                        .groupBy("source_no", "budget").agg(F.max(F.when(_within(F.col("budget")), F.col("upto"))).alias("drawn")))
        after = (state.join(drawn, "source_no", "left")
                      .select("source_no", "fraction",
                              F.when(F.col("budget").isNull(), F.col("carry"))
                               .otherwise(F.col("budget") - F.coalesce("drawn", F.lit(0))).alias("carry"), "budget"))
        after = stage_table(after, "mix-carry")
        rounds.append(after.where("budget is not null").select(F.lit(k).alias("class"), "source_no", "budget"))
        state = after.drop("budget")
    out = spark.createDataFrame([], "class int, source_no bigint, budget double")
    for r in rounds:
        out = out.unionByName(r)
    return out


def mix(docs: DataFrame, weights: DataFrame | None = None, share: float = SHARE, max_epochs: float = MAX_EPOCHS,
        seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``doc_id, tie, source, size, source_size, target, copies, taken`` for
    every row.

    ``weights`` has ``source, weight`` (a source that is missing there gets
    nothing); by default :data:`CYCLE` is dealt to the sources. ``copies`` is
    how often the document is repeated (at most ``max_epochs``, rounded up),
    ``taken`` its words times that. The same seed gives the same rows however
    they are partitioned.

    Null sources are one source, an empty name another. Null and empty texts
    have no words: such documents are drawn as often as the whole repetitions
    of their source, and take nothing. Rows that repeat are documents of their
    own; rows with one id and different texts are ordered by a hash (``tie``).
    No rows, no result; other columns are ignored, whatever their names.
    """
    rows = stage_table(docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("tie"),
                                   F.col(source_col).alias("source"), words(F.col(text_col)).alias("size")), "mix-sizes")
    sized = rows.groupBy("source").agg(F.sum("size").alias("size"))
    given = (weights if weights is not None else cycled_weights(sized)).select(F.col("source").alias("given"), "weight")
    sources = stage_table(
        sized.join(given, sized["source"].eqNullSafe(given["given"]), "left")
             .select(F.monotonically_increasing_id().alias("source_no"), "source", "size", "weight"), "mix-sources")
    filled = water_fill(sources, share, max_epochs)
    whole = F.when(F.col("size") > 0, F.floor(F.col("target") / F.col("size"))).otherwise(0).cast("bigint")
    filled = stage_table(filled.withColumn("whole", whole)
                               .withColumn("extra", F.col("target") - F.col("whole") * F.col("size")), "mix-targets")
    facts = broadcast_if_small(filled.select(
        "source_no", F.col("source").alias("of"), F.col("size").alias("source_size"), "target", "whole"))
    numbered = rows.join(facts, rows["source"].eqNullSafe(facts["of"])).drop("of")
    ordered = stage_table_by_class(seeded_totals(numbered, seed))
    budgets = broadcast_if_small(class_budgets(ordered, filled.where("size > 0")))
    drawn = (ordered.join(budgets, ["class", "source_no"]).withColumn("again", _within(F.col("budget")).cast("bigint"))
                    .select("source_no", "doc_id", "tie", "size", "again"))
    # The rows without words were not ordered.
    drawn = drawn.unionByName(numbered.where("size = 0").select("source_no", "doc_id", "tie", "size",
                                                                F.lit(0).cast("bigint").alias("again")))
    return (drawn.join(facts, "source_no")
                 .withColumn("copies", F.col("whole") + F.col("again"))
                 .select("doc_id", "tie", F.col("of").alias("source"), "size", "source_size", "target", "copies",
                         (F.col("copies") * F.col("size")).alias("taken")))


def stage_table_by_class(ordered: DataFrame) -> DataFrame:
    """The ordered documents written by class, so a round reads its class only."""
    path = scratch_path(ordered.sparkSession, "mix-ordered")
    ordered.write.partitionBy("class").parquet(path)
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ordered.schema.fields if f.name != "class")
    return ordered.sparkSession.read.schema(f"{kinds}, class int").parquet(path)


def mixture(docs: DataFrame, mixed: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The mix itself: every row of ``docs`` as often as :func:`mix` says,
    numbered in ``_wm_repetition`` from 0. Rows with the same id and text share
    their copies evenly."""
    key = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit(""))
    plan = mixed.groupBy(key("doc_id").alias("_wm_key"), F.col("tie").alias("_wm_tie")).agg(
        F.sum("copies").alias("_wm_copies"), F.count(F.lit(1)).alias("_wm_rows"))
    keyed = docs.withColumns({"_wm_key": key(id_col), "_wm_tie": F.xxhash64(F.col(text_col))}).join(
        stage_table(plan, "mix-plan"), ["_wm_key", "_wm_tie"])
    once = keyed.where("_wm_rows = 1").withColumn("_wm_nth", F.lit(0).cast("bigint"))
    # A repeated row may be a third of the table: its rows are numbered by range.
    again = with_ordinal(keyed.where("_wm_rows > 1").withColumn("_wm_row", F.monotonically_increasing_id()),
                         ["_wm_row"], ["_wm_key", "_wm_tie"], "_wm_nth").drop("_wm_row")
    share = F.expr("_wm_copies div _wm_rows + if(_wm_nth < _wm_copies % _wm_rows, 1, 0)").cast("int")
    return (once.unionByName(again).withColumn("_wm_share", share).where("_wm_share > 0")
                .withColumn("_wm_repetition", F.explode(F.sequence(F.lit(0), F.col("_wm_share") - 1)))
                .select(*docs.columns, "_wm_repetition"))


def op13_water_filling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, mixed."""
    docs = table(spark, sf_dir, "documents", ["doc_id", "text", "source"])
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


#: The same values by another way: sources in the order in which they clamp, and
#: running sums over that order; then one step per class and source.
OP13_SQL = rf"""
WITH RECURSIVE
d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size FROM documents),
sized AS (SELECT source, CAST(sum(size) AS BIGINT) AS size FROM d GROUP BY source),
weighed AS (
  SELECT source, size, CAST([{', '.join(map(str, CYCLE))}][CAST((row_number() OVER (ORDER BY source IS NULL, source) - 1)
           % {len(CYCLE)} AS INT) + 1] AS DOUBLE) AS w, CAST({MAX_EPOCHS} * size AS DOUBLE) AS cap FROM sized),
ranked AS (SELECT *, row_number() OVER (ORDER BY cap / w, source NULLS LAST) AS place FROM weighed),
levels AS (
  SELECT *, {SHARE}::DOUBLE * CAST(sum(size) OVER () AS DOUBLE)
              - coalesce(sum(cap) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS remaining,
         sum(w) OVER (ORDER BY place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights FROM ranked),
free AS (SELECT arg_min(remaining, place) AS remaining, arg_min(weights, place) AS weights FROM levels
         WHERE cap * weights >= w * remaining),
targets AS (
  SELECT l.source, l.place, l.size, least(l.cap, l.w * free.remaining / free.weights) AS target,
         CASE WHEN size > 0 THEN floor(least(l.cap, l.w * free.remaining / free.weights) / size) ELSE 0 END AS whole
  FROM levels l, free),
ordered AS (
  SELECT d.*, t.place, t.size AS source_size, t.target, CAST(t.whole AS BIGINT) AS whole,
         CASE WHEN d.size > 0 THEN length(bin(d.size)) - 1 END AS class,
         CAST(sum(d.size) OVER (PARTITION BY t.place, CASE WHEN d.size > 0 THEN length(bin(d.size)) - 1 END
           ORDER BY CAST('0x' || substr(md5('{SEED}|' || d.doc_id), 1, 8) AS BIGINT), d.doc_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS upto
  FROM d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
classes AS (SELECT place, class, CAST(sum(size) AS BIGINT) AS words, list({{'upto': upto, 'size': size}}) AS docs
            FROM ordered WHERE size > 0 GROUP BY place, class),
steps AS (
  SELECT place, 64 AS k, (target - whole * size) / size AS fraction, 0::DOUBLE AS budget, 0::DOUBLE AS carry
  FROM targets WHERE size > 0
  UNION ALL
  SELECT place, k - 1, fraction, budget,
         budget - coalesce(list_max(list_transform(list_filter(docs, lambda x: 2 * x.upto - x.size <= 2 * budget),
                                                   lambda x: x.upto)), 0)
  FROM (SELECT s.place, s.k, s.fraction, c.docs, s.fraction * coalesce(c.words, 0) + s.carry AS budget
        FROM steps s LEFT JOIN classes c ON s.place = c.place AND c.class = s.k - 1 WHERE s.k > 0))
SELECT o.doc_id, o.size, o.source_size, o.target,
       o.size * (o.whole + CASE WHEN 2 * o.upto - o.size <= 2 * s.budget THEN 1 ELSE 0 END) AS taken
FROM ordered o LEFT JOIN steps s ON o.place = s.place AND o.class = s.k
"""
