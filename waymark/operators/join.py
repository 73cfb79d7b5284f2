"""Coordinate lookup and the sign-to-coordinate join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.functions.geo import with_dms
from waymark.functions.text import clean_text, join_key


def first_per_key(df: DataFrame, key: str, order_by: list[str]) -> DataFrame:
    """Keep the first row per ``key`` in ``order_by`` order (file order).

    Written as ``min_by`` over a struct, i.e. an aggregation: each task
    reduces its rows per key before the shuffle, so a key with millions of
    duplicates never lands in one task whole (a ``row_number`` window would).
    """
    payload = [c for c in df.columns if c != key]
    order = F.struct(*[F.col(c) for c in order_by])
    return (df.groupBy(key)
              .agg(F.min_by(F.struct(*[F.col(c) for c in payload]), order).alias("_wm_first"))
              .select(key, *[F.col("_wm_first")[c].alias(c) for c in payload]))


def coord_lookup(df: DataFrame, order_by: list[str], intersection_col: str = "intersection") -> DataFrame:
    """Coordinate lookup table: ``cd`` is renamed ``coordinate_string``; one
    row per normalised key (first in file order), columns
    ``intersection_key, coordinate_string, city, zip``."""
    if "cd" in df.columns:
        df = df.withColumnRenamed("cd", "coordinate_string")
    keyed = df.select(join_key(intersection_col).alias("intersection_key"),
                      "coordinate_string", "city", "zip", *order_by)
    return first_per_key(keyed, "intersection_key", order_by).drop(*order_by)


def usable_signs(df: DataFrame, intersection_col: str = "intersection",
                 text_col: str = "text_on_sign_exact") -> DataFrame:
    """The rows that have an intersection and whose cleaned text will not be
    blank, told from the raw columns: cleaning leaves something exactly if the
    lower-cased text has a letter, digit, ``_`` or ``-``. The test is cheap and
    keeps later filters from repeating the cleaning."""
    return df.where(F.col(intersection_col).isNotNull() & F.lower(F.col(text_col).cast("string")).rlike(r"[a-z0-9_\-]"))


def clean_signs(df: DataFrame, intersection_col: str = "intersection",
                text_col: str = "text_on_sign_exact", key_from: str = "clean") -> DataFrame:
    """Sheet-side cleaning: rename the text column ``text_on_sign``, clean the
    intersection and text (``-`` kept) and derive the join key from the
    cleaned intersection (or from the raw one with ``key_from='raw'``).
    Native projections over the signs; the key refers to the cleaned column,
    so the cleaning is there once. A null intersection stays null and gets the
    empty key."""
    if key_from == "raw":
        df = df.withColumn("intersection_key", join_key(intersection_col))
    out = (df.withColumnRenamed(text_col, "text_on_sign")
             .withColumns({"text_on_sign": clean_text("text_on_sign", extra_chars="-"),
                           intersection_col: clean_text(intersection_col, extra_chars="-")}))
    return out if key_from == "raw" else out.withColumn("intersection_key", join_key(intersection_col))


def attach_coordinates(signs: DataFrame, lookup: DataFrame, mode: str = "strict",
                       key_from: str = "clean", intersection_col: str = "intersection",
                       text_col: str = "text_on_sign_exact") -> DataFrame:
    """Clean the signs, left-join the lookup on the normalised key and attach
    ``latitude``/``longitude`` parsed from the DMS coordinate string.

    The DMS string is parsed on the lookup side -- once per key instead of
    once per sign. ``lookup`` (output of :func:`coord_lookup`) has one row per
    key; the planner broadcasts it when its size is under the broadcast
    threshold and shuffles both sides, once, otherwise. Building the plan runs
    no job, so later filters and column pruning reach the scans. Unmatched signs
    keep null coordinates. In ``strict`` mode a sign that matches an
    unparsable coordinate string fails the job; unreferenced bad entries do
    not. ``key_from='raw'`` keys the signs from the raw intersection text.
    """
    cleaned = clean_signs(signs, intersection_col, text_col, key_from)
    parsed = with_dms(lookup, "coordinate_string", "latitude", "longitude", mode="permissive")
    if mode == "strict":
        parsed = parsed.withColumn("_wm_bad", F.col("coordinate_string").isNotNull()
                                   & F.col("latitude").isNull())
    merged = cleaned.join(parsed, "intersection_key", "left")
    if mode == "strict":
        fail = F.raise_error(F.concat(F.lit("no coordinate pair in: "),
                                      F.col("coordinate_string"))).cast("double")
        merged = merged.withColumns({
            "latitude": F.when(F.col("_wm_bad"), fail).otherwise(F.col("latitude")),
            "longitude": F.when(F.col("_wm_bad"), fail).otherwise(F.col("longitude")),
        }).drop("_wm_bad")
    return merged


def raw_signs_from_sheets(merged: DataFrame, extra=(), tested: bool = False) -> DataFrame:
    """Sheet path of the raw sign table: rename the cleaned text back to
    ``text_on_sign_exact``, keep the four required columns (plus
    ``code_type`` when present), drop nulls, drop texts that are blank after
    stripping (tested, not rewritten) and excluded intersections.

    ``tested`` says that the signs went through :func:`usable_signs` before
    they were cleaned; names and texts are then not tested again."""
    from waymark.operators.filters import EXCLUDED_INTERSECTIONS, drop_null_rows, exclude_values
    out = merged.withColumnRenamed("text_on_sign", "text_on_sign_exact")
    base = ["intersection", "text_on_sign_exact", "latitude", "longitude"]
    columns = [*base, *[c for c in ["code_type"] if c in out.columns], *extra]
    if tested:
        # No name is null; the planner learns it here, so that no null test of
        # the cleaned name is pushed below the join. The exclusion stands beside
        # a column of the lookup, so it too stays above and cleans nothing again.
        out = out.withColumn("intersection", F.coalesce("intersection", F.lit("")))
        matched = F.col("coordinate_string").isNotNull()
        out = out.where(~(matched & F.col("intersection").isin(list(EXCLUDED_INTERSECTIONS))))
        return drop_null_rows(out.select(*columns), ["latitude", "longitude"])
    out = drop_null_rows(out.select(*columns), base)
    # The cleaned text is already stripped, so "blank after stripping" is
    # just the empty string.
    out = out.where(F.col("text_on_sign_exact") != "")
    return exclude_values(out, "intersection")
