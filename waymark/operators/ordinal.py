"""Row ordinals without a single-task window.

``row_number() over (partition by g order by k)`` sends every row of a group to
one task, and without ``partition by`` it sends the whole table to one task.
With one group holding a third of all rows that task is the job. The operator
here gives the same numbers while every task stays balanced:

1. range-partition on (group, order keys): Spark samples the keys, so a hot
   group is cut across many tasks, and sorts each task's rows;
2. tag each row with its task id and in-task position, and write that as a
   table in the shared checkpoint folder -- the ids are fixed from then on,
   whatever is recomputed, and a lost executor re-reads files;
3. count rows per (task, group) -- a table of at most tasks + groups rows --
   and turn the counts into each (task, group)'s starting offset;
4. ordinal = start offset + position within the task.

The order keys should be unique within a group (add a tiebreak column);
otherwise tied rows receive distinct ordinals in an arbitrary order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waymark.sources.tables import stage_table


TARGET_BYTES = 128 << 20
UNPACKED = 4


def _num_partitions(df: DataFrame, num_partitions: int | None) -> int:
    """The given number, or enough for about ``TARGET_BYTES`` a task by the
    plan's size estimate, at least the session's shuffle partitions. The
    estimate of a join is the product of its sides, so what the plan reads
    (``UNPACKED`` times, since files are compressed) bounds it."""
    if num_partitions:
        return num_partitions
    plan = df._jdf.queryExecution().optimizedPlan()
    leaves, read = plan.collectLeaves().iterator(), 0
    while leaves.hasNext():
        read += int(leaves.next().stats().sizeInBytes())
    size = min(int(plan.stats().sizeInBytes()), UNPACKED * read)
    floor = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(floor, min(-(-size // TARGET_BYTES), 100_000))


def with_ordinal(df: DataFrame, order_by: list, partition_by: list | tuple = (),
                 name: str = "ordinal", num_partitions: int | None = None,
                 collect: str | None = None) -> DataFrame:
    """Add ``name`` (bigint, 0-based): the row's position in ``order_by``
    order within ``partition_by`` -- ``row_number() - 1`` computed with
    balanced tasks. ``order_by`` items are column names or sort Columns. Rows
    with a null partition key are left out.

    With ``collect`` (a column; ``order_by`` are ascending column names) every
    partition becomes one row, and ``name`` the array of that column with each
    value at its position. For partitions known to be small: it takes one
    shuffle and writes nothing, but holds a partition in one row."""
    partition_by = list(partition_by)
    if collect:
        row = F.struct(*[F.col(c).alias(f"o{k}") for k, c in enumerate(order_by)], F.col(collect).alias("value"))
        # The rows go to their partition first: its rows are spread over all
        # tasks, where a partial list per task would hold but a few of them. The
        # number of tasks is not left to the bytes moved, since the work on a
        # partition may be far more than that of reading it.
        n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        return (df.na.drop(subset=partition_by).repartition(n, *partition_by).groupBy(*partition_by)
                  .agg(F.sort_array(F.collect_list(row))["value"].alias(name)))
    keys = partition_by + list(order_by)
    n = _num_partitions(df, num_partitions)
    ranged = (df.repartitionByRange(n, *keys)
                .sortWithinPartitions(*keys)
                .withColumn("_wm_task", F.spark_partition_id())
                .withColumn("_wm_pos", F.monotonically_increasing_id()))
    # Counts and rows must come from one evaluation of the range shuffle.
    ranged = stage_table(ranged, "ordinal")
    counts = (ranged.groupBy("_wm_task", *partition_by)
                    .agg(F.min("_wm_pos").alias("_wm_first"),
                         F.count(F.lit(1)).alias("_wm_n")))
    before = (Window.partitionBy(*partition_by).orderBy("_wm_task")
                    .rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.withColumn("_wm_start", F.coalesce(F.sum("_wm_n").over(before), F.lit(0)))
    out = ranged.join(starts.select("_wm_task", *partition_by, "_wm_first", "_wm_start"),
                      on=["_wm_task", *partition_by], how="inner")
    out = out.withColumn(name, (F.col("_wm_start") + F.col("_wm_pos") - F.col("_wm_first")).cast("bigint"))
    return out.drop("_wm_task", "_wm_pos", "_wm_first", "_wm_start")


def hash32(*parts) -> F.Column:
    """Unsigned 32-bit value of the first 8 hex digits of ``md5(p1|p2|...)``.

    Every part is cast to string and joined with ``|``. The same value is
    ``('0x' || substr(md5(...), 1, 8))::BIGINT`` in DuckDB, so draws, ranks
    and splits built on it can be checked against plain SQL.
    """
    return F.conv(hash_digits(*parts), 16, 10).cast("bigint")


def hash_digits(*parts) -> F.Column:
    """The hex digits of :func:`hash32`, which sort as it does."""
    cols = [(F.col(p) if isinstance(p, str) else p).cast("string") for p in parts]
    key = F.concat_ws("|", *cols)
    return F.substring(F.md5(key), 1, 8)
