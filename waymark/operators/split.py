"""Train/validation splits and round picks.

Splits are decided by ranking a hash of the group (or row key) with the seed,
so they depend on data and seed only -- not on partitioning, task order or a
driver-side generator -- and one SQL statement reproduces them.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.operators.ordinal import hash32, with_ordinal
from waymark.operators.quantiles import kth_smallest
from waymark.sources.tables import stage_table

DEFAULT_TEST_SIZE = 0.2
DEFAULT_SEED = 1992


def split_label(is_val) -> F.Column:
    return F.when(is_val, F.lit("val")).otherwise(F.lit("train"))


def _n_val(total: int, test_size: float) -> int:
    n_val = int(math.ceil(float(test_size) * total))
    if n_val < 1 or total - n_val < 1:
        raise ValueError(f"test_size={test_size} leaves an empty side with {total} items")
    return n_val


def group_split_table(df: DataFrame, group_col: str = "intersection",
                      test_size: float = DEFAULT_TEST_SIZE, seed: int = DEFAULT_SEED) -> DataFrame:
    """One row per group with its ``split``: the ``ceil(test_size * groups)``
    groups with the smallest ``hash32(seed || group)`` are ``val``."""
    # The distinct groups are dimension-sized; written once, the count and the
    # ranking below read that small table instead of recomputing ``df``.
    groups = stage_table(df.select(group_col).distinct()
                           .withColumn("_wm_h", hash32(F.lit(seed), F.coalesce(F.col(group_col), F.lit("")))),
                         "split-groups")
    total = groups.count()
    n_val = _n_val(total, test_size)
    ranked = with_ordinal(groups, ["_wm_h", group_col], name="_wm_rank")
    return ranked.select(group_col, split_label(F.col("_wm_rank") < n_val).alias("split"))


def split(df: DataFrame, group_col: str | None = "intersection", row_key=None,
          test_size: float = DEFAULT_TEST_SIZE, seed: int = DEFAULT_SEED) -> DataFrame:
    """Add ``split``. With a group column every row of a group lands on the
    same side; otherwise the ``ceil(test_size * rows)`` rows with the least
    ``hash32(seed || row_key)`` (then the least key) are ``val``: the border is
    found from histograms, and the rows get their label where they are. Rows
    that share a key stay together."""
    if group_col and group_col in df.columns:
        # Null-safe: rows without a group are a group and stay.
        sides = group_split_table(df, group_col, test_size, seed).withColumnRenamed(group_col, "_wm_group")
        return df.join(sides, df[group_col].eqNullSafe(sides["_wm_group"])).drop("_wm_group")
    if row_key is None:
        raise ValueError("a row split needs a stable row_key column")
    rank = hash32(F.lit(seed), row_key)
    sized = []

    def last(total: int) -> int:
        sized.append(_n_val(total, test_size))
        return sized[0] - 1

    border, before, _ = kth_smallest(df, rank, last)
    # Keys with the border's hash: as many of the least as the side still takes.
    key = F.col(row_key)
    ties = df.where(rank == int(border)).select(key.alias("k")).orderBy("k").limit(before + 1)
    top = ties.agg(F.max("k").alias("k"), F.count("k").alias("n")).first()
    below = key.isNull() | (key <= F.lit(top["k"])) if top["n"] else key.isNull()
    return df.withColumn("split", split_label((rank < int(border)) | ((rank == int(border)) & below)))


def pick_rounds(df: DataFrame, k: int, seed: int, row_key: str) -> DataFrame:
    """``k`` rounds drawn uniformly without replacement for ``seed``: the rows
    with the smallest ``hash32(seed || row_key)``. Planned as a top-k: each
    task keeps k rows, so only tasks x k rows meet at the end."""
    return (df.withColumn("_wm_h", hash32(F.lit(seed), row_key))
              .orderBy("_wm_h", row_key).limit(k).drop("_wm_h"))
