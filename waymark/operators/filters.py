"""Column checks, null and blank drops, exclusions, missing tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.functions.text import MISSING_TOKENS, nullify_tokens, strip_ws

# The intersection keys excluded from training data.
EXCLUDED_INTERSECTIONS = ("56th-pena",)


def require_columns(df: DataFrame, required, optional=()) -> DataFrame:
    """Raise (before any job runs) when required columns are missing, listing
    them sorted; keep the required columns and whichever optional ones exist."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"the table lacks the columns {missing}")
    return df.select(*required, *[c for c in optional if c in df.columns])


def drop_null_rows(df: DataFrame, subset) -> DataFrame:
    return df.na.drop(how="any", subset=list(subset))


def drop_blank_text(df: DataFrame, column: str, rewrite: bool = True) -> DataFrame:
    """Drop rows whose text is empty after stripping whitespace. With
    ``rewrite`` the stripped text replaces the original, otherwise the
    original is kept as it is."""
    stripped = strip_ws(F.col(column).cast("string"))
    if rewrite:
        return df.withColumn(column, stripped).where(F.col(column) != "")
    return df.where(stripped != "")


def exclude_values(df: DataFrame, column: str, values=EXCLUDED_INTERSECTIONS) -> DataFrame:
    """Drop rows whose ``column`` equals one of ``values`` (exact match).

    A literal list becomes an ``IN`` predicate that Parquet can use; pass a
    DataFrame for a large list and it becomes a left-anti join instead.
    """
    if isinstance(values, DataFrame):
        other = values.select(F.col(values.columns[0]).alias("_wm_excluded")).distinct()
        return df.join(other, df[column] == other["_wm_excluded"], "left_anti")
    # NOT IN would drop null keys too; the original keeps them.
    return df.where(~F.coalesce(F.col(column).isin(list(values)), F.lit(False)))


def nullify_columns(df: DataFrame, columns=None, tokens=MISSING_TOKENS) -> DataFrame:
    """Turn missing-value tokens into nulls in string columns (all string
    columns when ``columns`` is None), as a CSV reader of the original does."""
    if columns is None:
        columns = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    # Quoted: a header may hold dots and back-ticks.
    named = lambda c: F.col("`" + c.replace("`", "``") + "`")
    return df.select(*[nullify_tokens(named(c), tokens).alias(c) if c in columns else named(c) for c in df.columns])
