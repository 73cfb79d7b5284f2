"""Text column functions: cleaning, join keys, tokens, missing-value tokens.

All of these are native Spark expressions (``lower``, ``regexp_replace``,
``split``), so they stay inside whole-stage code generation and never cross
into Python.
"""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's ``str`` regex class ``\s`` treats as
# whitespace (``str.isspace``), written as a bracket expression that Java and
# RE2 (DuckDB) read the same way, so the cleaning rules match Python exactly in
# both engines.
WHITESPACE_CHARS = (
    r"\t\n\x0B\f\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
WS = f"[{WHITESPACE_CHARS}]"
ASCII_WHITESPACE = "\t\n\x0b\f\r\x1c\x1d\x1e\x1f "

# Field contents the CSV reader of the original pipeline turns
# into missing values (the pandas defaults).
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _class_escape(chars: str) -> str:
    """Escape characters for use inside a regex bracket expression."""
    return "".join(ch if ch.isalnum() else "\\" + ch for ch in chars)


def strip_ws(c: str | Column) -> Column:
    """Python ``str.strip()``: remove leading and trailing whitespace. The
    first and the last character tell whether there is any; the search over the
    whole text is for those that have some."""
    out = _col(c)
    ends = F.concat(F.left(out, F.lit(1)), F.right(out, F.lit(1)))
    return F.when(ends.rlike(WS), F.regexp_replace(out, f"^{WS}+|{WS}+$", "")).otherwise(out)


def keep_only(c: str | Column, allowed: str) -> Column:
    """Delete every character outside the bracket-expression body
    ``allowed``. Written as the concatenation of the maximal allowed runs --
    the same string as deleting the others, but the JVM regex engine finds
    positive runs about ten times faster than it replaces a negated class
    with several ranges."""
    return F.array_join(F.regexp_extract_all(_col(c), F.lit(f"[{allowed}]+"), F.lit(0)), "")


def _is_ascii(c: Column) -> Column:
    return F.octet_length(c) == F.char_length(c)


def _clean_ascii(c: Column, allowed: str) -> Column:
    """What ``clean_text`` makes of an ASCII text, before the strip, without
    regular expressions. Characters are mapped one by one; a whitespace run
    becomes one space as ``<space><mark>`` per space, less every ``<mark><space>``
    and the last mark (the mark is no allowed character, so there is no other);
    then single spaces beside hyphens go."""
    dropped = "".join(ch for ch in map(chr, range(128)) if ch not in allowed and ch not in ASCII_WHITESPACE)
    out = F.translate(c, ASCII_WHITESPACE + dropped, " " * len(ASCII_WHITESPACE))
    for old, new in ((" ", " \x01"), ("\x01 ", ""), ("\x01", ""), (" -", "-"), ("- ", "-")):
        out = F.replace(out, F.lit(old), F.lit(new))
    return out


def clean_text(c: str | Column, *, lowercase: bool = True, remove_punctuation: bool = True,
               collapse_whitespace: bool = True, strip: bool = True, keep_numbers: bool = True,
               keep_underscore: bool = True, extra_chars: str = "") -> Column:
    """Clean one text column.

    Order: lower-case, delete characters outside the allowed set, turn
    whitespace runs into one space and tidy spaces around hyphens, strip.
    The allowed set is ``a-z`` (so capitals vanish when lower-casing is off),
    digits if ``keep_numbers``, ``_`` if ``keep_underscore``, ``extra_chars``
    and whitespace. Nulls stay null. ASCII texts take a way without regular
    expressions, which costs a fraction of theirs; a text in which nothing is
    to be cleaned is only looked through.
    """
    raw = out = _col(c).cast("string")
    if lowercase:
        out = F.lower(out)
    plain = None
    if remove_punctuation and collapse_whitespace and "\x01" not in extra_chars:
        plain = _clean_ascii(out, "abcdefghijklmnopqrstuvwxyz" + ("0123456789" if keep_numbers else "")
                             + ("_" if keep_underscore else "") + extra_chars)
    if remove_punctuation:
        allowed = "a-z0-9" if keep_numbers else "a-z"
        allowed += "_" if keep_underscore else ""
        allowed += _class_escape(extra_chars)
        out = keep_only(out, allowed + WHITESPACE_CHARS)
    if collapse_whitespace:
        # After the collapse every whitespace run is one space, so the hyphen
        # rule and the strip reduce to single-space forms.
        out = F.regexp_replace(out, f"{WS}+", " ")
        out = F.regexp_replace(out, " ?- ?", "-")
        if plain is not None:
            out = F.when(_is_ascii(raw), plain).otherwise(out)
        if strip:
            out = F.trim(out)
        if plain is not None and set(extra_chars) <= set(string.punctuation):
            # Allowed characters and single spaces, none at an end or beside a hyphen.
            done = rf"\A[{allowed}]++(?:(?<!-) (?!-)[{allowed}]++)*+\z"
            out = F.when(raw.rlike(done), raw).otherwise(out)
    elif strip:
        out = strip_ws(out)
    return out


def clean_columns(df, columns, **flags):
    """Apply :func:`clean_text` to several columns in one projection."""
    return df.withColumns({c: clean_text(c, **flags) for c in columns})


def join_key(c: str | Column) -> Column:
    """Normalised join key: null becomes ``''``; strip, lower-case, ``&`` to
    `` and ``, ``/`` to ``-``, collapse whitespace, tidy hyphens, keep only
    ``[a-z0-9-_]`` and whitespace, whitespace to ``-``, strip ``-``.

    A cleaned text (allowed characters and single spaces, none beside a
    hyphen) only has its spaces turned and its ends stripped."""
    raw = _col(c).cast("string")
    # A run of allowed characters: a search for others takes ten times as long.
    clean = raw.rlike(r"\A[a-z0-9_\- ]*+\z") & ~(raw.contains("  ") | raw.contains(" -") | raw.contains("- "))
    cleaned = F.btrim(F.replace(raw, F.lit(" "), F.lit("-")), F.lit("-"))
    out = F.lower(strip_ws(raw))
    out = F.replace(out, F.lit("&"), F.lit(" and "))
    out = F.replace(out, F.lit("/"), F.lit("-"))
    out = F.regexp_replace(out, f"{WS}+", " ")
    out = F.regexp_replace(out, " ?- ?", "-")
    out = keep_only(out, f"a-z0-9\\-_{WHITESPACE_CHARS}")
    out = F.regexp_replace(out, f"{WS}+", "-")
    out = F.regexp_replace(out, "^-+|-+$", "")
    return F.coalesce(F.when(clean, cleaned).otherwise(out), F.lit(""))


def split_words(c: str | Column) -> Column:
    """Tokens split on a single space; null gives ``['']`` and repeated
    spaces give empty tokens, as ``str.split(' ')`` does."""
    return F.split(F.coalesce(_col(c).cast("string"), F.lit("")), " ", -1)


def nullify_tokens(c: str | Column, tokens=MISSING_TOKENS) -> Column:
    """Missing-value tokens (exact match) become null."""
    col = _col(c)
    return F.when(col.isin(list(tokens)), F.lit(None).cast("string")).otherwise(col)

