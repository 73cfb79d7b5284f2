"""Deterministic bootstrap bags of sign texts per intersection.

Contract (``seed`` default 1992, ``||`` = join with ``|``):

* the ``n`` signs of a group are numbered 0..n-1 in source order;
* slot ``s`` of sample ``i`` of group ``g`` takes street sign number ``s`` when
  ``s < min(street_count, bag_size)``, otherwise sign number
  ``hash32(seed || g || i || s) % n`` (drawn with replacement from all signs);
* the members of a bag are ordered by ``hash32(seed || 's' || g || i || s)``
  and joined with the separator.

Groups are told apart by size. The signs of a group of at most ``GROUP_ROWS``
signs and ``GROUP_BYTES`` of text are put into one array at their numbers, and
its bags are drawn from that array without a further shuffle; the array serves
all samples of a row of at most ``CHUNK_BYTES`` of bags. A larger group never
meets in one task: its signs are numbered by the balanced ordinal operator, and
draws join on ``(group, index)``, so its rows spread by index across tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waymark.operators.ordinal import hash32, hash_digits, with_ordinal
from waymark.sources.tables import stage_table

STREET_SIGN = "street_sign"
# Bounds of a group that is held in one row.
GROUP_ROWS, GROUP_BYTES = 8192, 1 << 20
# Bags drawn side by side in one row.
CHUNK_BYTES = 8 << 20


def intersection_profile(df: DataFrame, group_col: str = "intersection",
                         text_col: str = "text_on_sign_exact",
                         lat_col: str = "latitude", lon_col: str = "longitude") -> DataFrame:
    """Per group: mean latitude/longitude, distinct texts, rows. All four
    aggregate partially before the shuffle (the distinct count through an
    intermediate (group, text) aggregation), so a hot group is reduced in
    every task first."""
    return (df.where(F.col(group_col).isNotNull())
              .groupBy(group_col)
              .agg(F.avg(lat_col).alias("latitude"), F.avg(lon_col).alias("longitude"),
                   F.countDistinct(text_col).cast("bigint").alias("unique_sign_count"),
                   F.count(F.lit(1)).alias("raw_sign_count")))


def street_signs_topk(df: DataFrame, k: int, order_by: list[str], group_col: str = "intersection",
                      text_col: str = "text_on_sign_exact", code_col: str = "code_type") -> DataFrame:
    """First ``k`` street signs of each group in source order, numbered
    ``slot`` 0..k-1. ``row_number() <= k`` is planned as a group limit that
    each task applies before the shuffle, so at most k rows per group and task
    move."""
    w = Window.partitionBy(group_col).orderBy(*order_by)
    return (df.where(F.col(code_col) == STREET_SIGN)
              .select(group_col, text_col, *order_by)
              .withColumn("_wm_rn", F.row_number().over(w))
              .where(F.col("_wm_rn") <= k)
              .select(group_col, (F.col("_wm_rn") - 1).cast("int").alias("slot"), text_col))


def street_texts(signs: Column, k: int) -> Column:
    """:func:`street_signs_topk` of a group whose signs (``t``, ``street``) are
    one array in source order: its first ``k`` street texts."""
    return F.slice(F.filter(signs, lambda sign: sign["street"])["t"], 1, k)


def sample_ordinal(df: DataFrame, samples: int, group_col: str = "intersection",
                   seed: int | None = None) -> DataFrame:
    """Global sample number: groups in sorted order times ``samples`` plus
    ``sample_id`` (the original seeded each sample with seed + this number)."""
    # Written once: the ordinal reads its rows twice (sample, sort), and the
    # files tell their number.
    groups = stage_table(df.where(F.col(group_col).isNotNull()).select(group_col).distinct(), "sample-groups")
    ranked = with_ordinal(groups, [group_col], name="_wm_group_rank")
    out = (ranked.withColumn("sample_id", F.explode(F.sequence(F.lit(0), F.lit(samples - 1))))
                 .withColumn("sample_ordinal", F.col("_wm_group_rank") * samples + F.col("sample_id"))
                 .drop("_wm_group_rank"))
    if seed is not None:
        out = out.withColumn("sample_seed", F.col("sample_ordinal") + seed)
    return out


def bootstrap_bags(df: DataFrame, order_by: list[str], group_col: str = "intersection",
                   text_col: str = "text_on_sign_exact", code_col: str | None = "code_type",
                   bag_size: int = 8, samples: int = 100, seed: int = 1992,
                   separator: str = " | ", lat_col: str = "latitude",
                   lon_col: str = "longitude") -> DataFrame:
    """Bags of ``bag_size`` sign texts, ``samples`` per group.

    Output columns: ``intersection, sample_id, text, latitude, longitude,
    unique_sign_count, raw_sign_count`` (group means and counts).
    """
    if bag_size < 1:
        raise ValueError("bag_size must be at least 1")
    if samples < 1:
        raise ValueError("samples must be at least 1")
    has_code = code_col is not None and code_col in df.columns
    g = group_col
    signs = df.where(F.col(g).isNotNull())
    street_n = (F.sum(F.when(F.col(code_col) == STREET_SIGN, 1).otherwise(0)) if has_code
                else F.lit(0)).cast("bigint").alias("street_n")
    size = F.octet_length(F.col(text_col).cast("string"))
    small = (F.count(F.lit(1)) <= GROUP_ROWS) & (F.coalesce(F.sum(size), F.lit(0)) <= GROUP_BYTES)
    # One row per group, used several times: written once rather than
    # aggregated over all signs again.
    profile = stage_table(signs.groupBy(g)
                               .agg(F.avg(lat_col).alias("latitude"), F.avg(lon_col).alias("longitude"),
                                    F.count(F.lit(1)).alias("raw_sign_count"), street_n,
                                    small.alias("_wm_small"),
                                    F.coalesce(F.max(size), F.lit(0)).alias("_wm_longest")), "bag-profile")
    draw = _Draw(order_by, g, text_col, code_col if has_code else None, bag_size, samples, seed, separator)
    large = profile.where(~F.col("_wm_small"))
    if not large.take(1):
        return draw.small(signs, profile)
    # At most one name per GROUP_ROWS signs or GROUP_BYTES of text.
    names = F.broadcast(large.select(g))
    return (draw.small(signs.join(names, g, "left_anti"), profile.where("_wm_small"))
                .unionByName(draw.large(signs.join(names, g, "left_semi"), large)))


@dataclass(frozen=True)
class _Draw:
    """The bags of small and of large groups (see the module's contract)."""

    order_by: list[str]
    g: str
    text_col: str
    code_col: str | None
    bag_size: int
    samples: int
    seed: int
    separator: str

    def _in_order(self, members):
        # Sorting the (position, slot, text) structs orders the members; taking
        # the ``t`` field of the sorted array is a native extraction, no lambda.
        return F.array_join(F.sort_array(members)["t"], self.separator).alias("text")

    def _bag(self, sample_id, *salt):
        # What the hashes of a bag's slots have in common.
        return F.concat_ws("|", F.lit(self.seed).cast("string"), *map(F.lit, salt), F.col(self.g).cast("string"),
                           sample_id.cast("string"))

    def _position(self, slot, bag=None):
        # Digits of one length order as their number does.
        return hash_digits(self._bag(F.col("sample_id"), "s") if bag is None else bag, slot)

    def _index(self, slot, bag=None):
        return hash32(self._bag(F.col("sample_id")) if bag is None else bag, slot) % F.col("raw_sign_count")

    def _guaranteed(self, slot):
        return slot < F.least(F.col("street_n"), F.lit(self.bag_size))

    def _street(self, signs):
        return street_signs_topk(signs, self.bag_size, self.order_by, self.g, self.text_col, self.code_col)

    def _output(self, bags):
        return bags.select(F.col(self.g).alias("intersection"), F.col("sample_id").cast("int").alias("sample_id"),
                           "text", "latitude", "longitude", "unique_sign_count", "raw_sign_count")

    def small(self, signs: DataFrame, profile: DataFrame) -> DataFrame:
        """Bags of groups whose signs fit one array: one shuffle of the signs
        by group serves the numbering, the street signs, the arrays and the
        draws. The bags of a row are drawn before they are rows of their own,
        so the array is not repeated per bag."""
        street = F.lit(False) if self.code_col is None else F.coalesce(F.col(self.code_col) == STREET_SIGN, F.lit(False))
        sign = F.struct(F.col(self.text_col).alias("t"), street.alias("street"))
        groups = with_ordinal(signs.select(self.g, *self.order_by, sign.alias("_wm_sign")), self.order_by, [self.g],
                              name="_wm_numbered", collect="_wm_sign")
        groups = groups.select(self.g, F.col("_wm_numbered")["t"].alias("_wm_signs"),
                               street_texts(F.col("_wm_numbered"), self.bag_size).alias("_wm_street"))
        unique = F.size(F.array_distinct(F.array_compact("_wm_signs"))).cast("bigint")
        bag_bytes = self.bag_size * (F.col("_wm_longest") + len(self.separator.encode()) + 1)
        chunk = F.greatest(F.lit(1), F.least(F.lit(self.samples), F.floor(CHUNK_BYTES / bag_bytes))).cast("int")
        groups = (groups.withColumn("unique_sign_count", unique).join(profile, self.g)
                        .withColumn("_wm_chunk", chunk)
                        .withColumn("_wm_from", F.explode(F.sequence(F.lit(0), F.lit(self.samples - 1), F.col("_wm_chunk")))))

        def draw(bag):
            def member(slot, text):
                return F.struct(self._position(slot, bag["position"]).alias("_wm_pos"), slot.alias("slot"), text.alias("t"))

            def drawn(slot):
                return member(slot, F.get("_wm_signs", self._index(slot, bag["index"]).cast("int")))
            if self.code_col is None:
                return self._in_order(F.transform(slots, drawn))
            return self._in_order(F.concat(F.transform("_wm_street", lambda text, slot: member(slot, text)),
                                           F.transform(F.slice(slots, F.size("_wm_street") + 1, self.bag_size), drawn)))

        slots = F.sequence(F.lit(0), F.lit(self.bag_size - 1))
        last = F.least(F.col("_wm_from") + F.col("_wm_chunk"), F.lit(self.samples)) - 1
        bags = F.transform(F.sequence(F.col("_wm_from"), last), lambda i: F.struct(
            self._bag(i, "s").alias("position"), self._bag(i).alias("index")))
        # For the other explode the planner tests that there is a bag, which
        # draws all of them twice.
        return self._output(groups.withColumn("_wm_texts", F.transform(bags, draw))
                                  .select("*", F.posexplode_outer("_wm_texts").alias("_wm_at", "text"))
                                  .withColumn("sample_id", F.col("_wm_from") + F.col("_wm_at")))

    def large(self, signs: DataFrame, profile: DataFrame) -> DataFrame:
        """Bags of groups that are never brought together: draws are rows
        that join the numbered signs on (group, index)."""
        g, text_col, tasks = self.g, self.text_col, int(signs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        samples = F.explode(F.sequence(F.lit(0), F.lit(self.samples - 1)))
        # One row per group and sample is dealt out before the slots are made, so
        # their rows and draws are spread over all tasks.
        slots = (profile.select(g, "raw_sign_count", "street_n", samples.alias("sample_id"))
                        .repartition(tasks, g, "sample_id")
                        .withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(self.bag_size - 1)))))
        numbered = with_ordinal(signs.select(g, text_col, *self.order_by), self.order_by, [g], name="_wm_idx")
        members = (slots.where(~self._guaranteed(F.col("slot")))
                        .withColumn("_wm_idx", self._index(F.col("slot")))
                        # The slot table grows with groups x samples x bag, which the
                        # planner's estimate does not see: never broadcast it.
                        .join(numbered.select(g, "_wm_idx", text_col).hint("merge"), [g, "_wm_idx"])
                        .select(g, "sample_id", "slot", text_col))
        if self.code_col is not None:
            # Guaranteed members are the group's first street signs, the same for
            # every sample: repeat the top-k rows per sample instead of joining.
            fixed = (self._street(signs).repartition(tasks, g, "slot")
                         .select(g, samples.alias("sample_id"), "slot", text_col))
            members = fixed.unionByName(members)
        members = members.withColumn("_wm_pos", self._position(F.col("slot")))
        bags = (members.groupBy(g, "sample_id")
                       .agg(self._in_order(F.collect_list(F.struct("_wm_pos", "slot", F.col(text_col).alias("t"))))))
        unique = signs.groupBy(g).agg(F.countDistinct(text_col).cast("bigint").alias("unique_sign_count"))
        return self._output(bags.join(profile.join(unique, g), g))
