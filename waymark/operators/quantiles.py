"""Exact quantiles by refining histograms.

A histogram of a group is one row per cell: how many values, and the least and
greatest of them. Cells are cut by a function that never falls, so cells are in
the order of the values, and histograms of parts of the data add up cell by
cell. The cell that holds a wanted rank is cut again, between its own least and
greatest value, until that cell holds one value only. A scan per round counts
what lies in the wanted cells; tasks aggregate before the shuffle, so what is
exchanged are cells, never values, and nothing is sorted but cells.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.sources.staging import stage_table

#: Cells per doubling of the size of a value in the first round, and per wanted cell later.
CELLS = 4096
#: Wanted cells that are broadcast (some 100 bytes each); more join by a shuffle on the group.
BROADCAST_CELLS = 200_000


def _counts(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))


def merge_histograms(hist: DataFrame, *keys: str) -> DataFrame:
    """Histograms added up over everything but ``keys``."""
    return hist.groupBy(*keys).agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def first_cell(v: Column) -> Column:
    """A cell number that never falls with the value: finer near zero."""
    return F.floor(F.signum(v) * F.log1p(F.abs(v)) * (CELLS / 0.6931471805599453)).cast("bigint")


def inner_cell(v: Column, lo: Column, hi: Column) -> Column:
    """One of ``CELLS + 1`` cells between two values (halved where their
    distance is beyond the doubles)."""
    wide = (v / 2 - lo / 2) / (hi / 2 - lo / 2)
    return F.floor(F.when(hi - lo < float("inf"), (v - lo) / (hi - lo)).otherwise(wide) * CELLS).cast("bigint")


def _find(hist: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """The cell of every wanted rank (0-based within its histogram): columns of
    ``wanted`` with ``rank`` counted from the cell's first value, ``lo, hi``."""
    upto = F.sum("n").over(Window.partitionBy(*keys).orderBy("cell"))  # one row per cell
    placed = hist.select(*keys, "lo", "hi", upto.alias("upto"), "n")
    found = wanted.join(placed, keys).where((F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("n")))
    return found.withColumn("rank", F.col("rank") - (F.col("upto") - F.col("n"))).drop("upto", "n")


def select_ranks(values: DataFrame, hist: DataFrame, wanted: DataFrame) -> DataFrame:
    """``id, value, rank``: the value at every wanted rank, and the rank among
    the values equal to it.

    ``values`` has ``part, v`` (no nulls), ``hist`` the first histograms by
    ``whole, cell``, ``wanted`` rows ``id, whole, rank, parts``: the rank
    counts over the values of all ``parts`` (an array) of the histogram
    ``whole``."""
    found = stage_table(_find(hist, wanted, ["whole"]).select("id", "parts", "rank", "lo", "hi"), "quantile-cells")
    done = [found.where("lo = hi")]
    open_ = found.where("lo < hi")
    while open_.take(1):
        cells = (open_.groupBy("parts", "lo", "hi").agg(F.min("id").alias("cell_of")))
        cells = stage_table(cells, "quantile-open")
        # A value counts once for every wanted cell of its part.
        each = cells.select("cell_of", "lo", "hi", F.explode("parts").alias("part"))
        each = F.broadcast(each) if each.count() <= BROADCAST_CELLS else each
        inside = (values.join(each, "part").where((F.col("v") >= F.col("lo")) & (F.col("v") <= F.col("hi")))
                        .select("cell_of", "v", inner_cell(F.col("v"), F.col("lo"), F.col("hi")).alias("cell")))
        hist = _counts(inside, "cell_of", "cell")
        again = open_.join(cells, ["parts", "lo", "hi"]).select("id", "parts", "rank", "cell_of")
        found = stage_table(_find(hist, again, ["cell_of"]).select("id", "parts", "rank", "lo", "hi"), "quantile-cells")
        done.append(found.where("lo = hi"))
        open_ = found.where("lo < hi")
    return reduce(DataFrame.unionByName, done).select("id", F.col("lo").alias("value"), "rank")


def _as_values(df: DataFrame, value: str, by: list[str]) -> DataFrame:
    """``part`` (the group, comparable with nulls in it) and ``v``; nulls and
    NaN are no values."""
    part = F.struct(*[F.col(c).alias(f"k{k}") for k, c in enumerate(by)]) if by else F.struct(F.lit(0).alias("k0"))
    v = F.col(value).cast("double")
    return df.where(v.isNotNull() & ~F.isnan(v)).select(part.alias("part"), (v + 0.0).alias("v"))


def quantiles(df: DataFrame, value: str, by: list[str], probs, method: str = "exact",
              accuracy: int = 100000, total: dict | None = None, counts: bool = False) -> DataFrame:
    """Quantiles with linear interpolation (the NumPy default) per ``by``
    group, one column ``q<100p>`` per probability (``q50``, ``q90``), and with
    ``counts`` also ``n``, the number of values. With ``total`` = {``by`` column: label} the
    groups that differ in these columns only make a further group, which carries
    the labels; their histograms are added up.

    ``exact`` refines histograms. ``approx`` uses ``percentile_approx`` with
    bounded memory per group. Nulls and NaN are no values; a group without
    values has no row."""
    names = [f"q{round(p * 100)}" for p in probs]
    if method == "approx":
        each = [F.percentile_approx(value, p, accuracy).cast("double").alias(n) for p, n in zip(probs, names, strict=True)]
        vals = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
        out = vals.groupBy(*by).agg(F.count(value).alias("n"), *each)
        if total is not None:
            whole = vals.groupBy(*[c for c in by if c not in total]).agg(F.count(value).alias("n"), *each).where("n > 0")
            out = out.unionByName(whole.select(*[F.lit(total[c]).cast(df.schema[c].dataType).alias(c) if c in total else F.col(c)
                                                 for c in by], "n", *names))
        return out if counts else out.drop("n")
    values = _as_values(df, value, by)
    parts = stage_table(_counts(values.withColumn("cell", first_cell(F.col("v"))), "part", "cell"), "quantile-histograms")
    hist = parts.select(F.struct(F.lit(False).alias("all"), "part").alias("whole"), "cell", "n", "lo", "hi")
    groups = parts.groupBy("part").agg(F.sum("n").alias("n"))
    sizes = groups.select(F.struct(F.lit(False).alias("all"), "part").alias("whole"), "n", F.array("part").alias("parts"))
    if total is not None:
        # The parts that differ in these columns only, with their histograms merged.
        label = F.struct(*[(F.lit(total[c]).cast(df.schema[c].dataType) if c in total else F.col("part")[f"k{k}"]).alias(f"k{k}")
                           for k, c in enumerate(by)])
        both = F.struct(F.lit(True).alias("all"), label.alias("part")).alias("whole")
        hist = hist.unionByName(merge_histograms(parts.select(both, "cell", "n", "lo", "hi"), "whole", "cell"))
        sizes = sizes.unionByName(groups.select(both, "part", "n").groupBy("whole").agg(
            F.sum("n").alias("n"), F.collect_list("part").alias("parts")))
    at = [F.lit(float(p)) * (F.col("n") - 1) for p in probs]
    ends = F.explode(F.array(*[F.struct(F.lit(name).alias("q"), F.lit(high).alias("high"), (a - F.floor(a)).alias("share"),
                                        (F.ceil(a) if high else F.floor(a)).cast("bigint").alias("rank"))
                               for name, a in zip(names, at, strict=True) for high in (False, True)]))
    wanted = sizes.select("whole", "n", "parts", ends.alias("e")).select("whole", "n", "parts", "e.*")
    wanted = stage_table(wanted.select(F.monotonically_increasing_id().alias("id"), "*"), "quantile-ranks")
    found = select_ranks(values, hist, wanted.select("id", "whole", "rank", "parts")).drop("rank").join(wanted, "id")
    low, high = (F.max(F.when(F.col("high") == h, F.col("value"))) for h in (False, True))
    each = found.groupBy("whole", "n", "q").agg((low + (high - low) * F.max("share")).alias("value"))
    out = each.groupBy("whole", "n").agg(*[F.max(F.when(F.col("q") == n, F.col("value"))).alias(n) for n in names])
    return out.select(*[F.col("whole")["part"][f"k{k}"].alias(c) for k, c in enumerate(by)], *(["n"] if counts else []), *names)


def kth_smallest(df: DataFrame, column: Column, pick) -> tuple[float, int, int]:
    """``(value, equals, total)``: the value at the 0-based rank
    ``pick(total)`` of all rows, and how many values equal to it come before.
    Two or three narrow scans; rows are neither sorted nor written."""
    values = _as_values(df.select(column.alias("x")), "x", [])
    parts = stage_table(_counts(values.withColumn("cell", first_cell(F.col("v"))), "part", "cell"), "rank-histogram")
    total = parts.agg(F.sum("n")).first()[0] or 0
    wanted = df.sparkSession.range(1).select("id", F.lit(0).alias("whole"), F.lit(pick(total)).cast("bigint").alias("rank"),
                                             F.array(F.struct(F.lit(0).alias("k0"))).alias("parts"))
    found = select_ranks(values, parts.select(F.lit(0).alias("whole"), "cell", "n", "lo", "hi"), wanted).first()
    return found["value"], found["rank"], total
