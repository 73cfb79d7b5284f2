"""Secret scan: fixed patterns and a randomness test battery (native).

The battery looks at long tokens whose encoding can be inferred from their
characters. Symbols are numbered by the encoding's alphabet and tested for
uniformity (chi-squared), for the number of runs above and below the middle,
and for serial correlation; the three two-sided p-values are combined by
Fisher's rule. A small p-value says that the token is no random string.
Benjamini and Hochberg's procedure, run in each length class over the tokens
of the whole corpus, decides which tokens are cleared in this way: of the
tokens cleared in a class, at most ``FDR`` are expected to be random after all. The
tokens that stay are reported. Short tokens have little power, so a class
begins at the least length at which ordinary identifiers can be told apart.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waymark.llm.columns import broadcast_if_small, text_key
from waymark.sources.tables import stage_table, table

# The base patterns. Hex and access runs are maximal, so their
# least length can stand in the pattern.
ASSIGN = r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|""" \
         r"""[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
#: Kinds in the order that breaks ties between spans of one start.
KINDS = ("assign", "access", "hex", "random")
LEAST_ASSIGNED = 8
LEAST_TOKEN = 20
# An equals sign parts tokens unless nothing but more of them follows (padding).
TOKEN = rf"[A-Za-z0-9+/_-]{{{LEAST_TOKEN},}}(?:=+(?![A-Za-z0-9+/_=-]))?"
PATTERNS = dict(zip(KINDS, (ASSIGN, ACCESS, HEX, TOKEN), strict=True))
# Alphabets by encoding, in order of preference.
_DIGITS, _LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
ALPHABETS = {
    "hex": (r"^(?=.*[0-9])(?=.*[a-f])[0-9a-f]+$", _DIGITS + "abcdef"),
    "hex_upper": (r"^(?=.*[0-9])(?=.*[A-F])[0-9A-F]+$", _DIGITS + "ABCDEF"),
    "base32": (r"^(?=.*[2-7])(?=.*[A-Z])[A-Z2-7]+=*$", _LOWER.upper() + "234567"),
    "base36": (r"^(?=.*[0-9])(?=.*[a-z])[0-9a-z]+$", _DIGITS + _LOWER),
    "base64": (r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9+/]+=*$", _LOWER.upper() + _LOWER + _DIGITS + "+/"),
    "base64url": (r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9_-]+=*$", _LOWER.upper() + _LOWER + _DIGITS + "-_"),
}
#: Maximal runs of every alphabet, in tokens that no alphabet fits as a whole.
RUNS = {name: rf"[{chars}]{{{LEAST_TOKEN},}}" + ("=*" if name.startswith("base") and name != "base36" else "")
        for name, chars in (("hex", "0-9a-f"), ("hex_upper", "0-9A-F"), ("base32", "A-Z2-7"), ("base36", "0-9a-z"),
                            ("base64", "A-Za-z0-9+/"), ("base64url", "A-Za-z0-9_-"))}
#: Upper bounds of the length classes; the last class is open.
LENGTH_CLASSES = (24, 32, 48, 64, 128)
FDR = 0.05
#: Steps of the p-value grid per factor of ten, and its end.
GRID, GRID_END = 50, 800
MASK = "[SECRET]"


def _two_sided(z: Column) -> Column:
    """Probability of a normal value at least as far from 0 (error below 2e-7)."""
    x = F.abs(z) / math.sqrt(2)
    t = 1 / (1 + 0.3275911 * x)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    return F.greatest(poly * F.exp(-x * x), F.lit(1e-300))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def _with(rows: DataFrame, **columns: Column) -> DataFrame:
    """``withColumns`` that is evaluated once: a generator stands between, so
    later steps refer to values and not to copies of their expressions."""
    made = F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))
    return rows.select("*", F.inline(made))


def _alphabet(token: Column) -> Column:
    """The symbols of the token's inferred encoding, or null."""
    abc = F.lit(None).cast("string")
    for pattern, letters in reversed(ALPHABETS.values()):
        abc = F.when(token.rlike(pattern), F.lit(letters)).otherwise(abc)
    return abc


def randomness(tokens: DataFrame, token_col: str = "token") -> DataFrame:
    """The rows whose token has an inferred encoding and enough symbols, with
    ``length`` and ``p``, the combined p-value under randomness."""
    token = F.col(token_col)
    rows = _with(tokens, _abc=_alphabet(token), _body=F.regexp_replace(token, "=+$", ""))
    rows = rows.where(F.col("_abc").isNotNull() & (F.char_length("_body") >= LEAST_TOKEN))
    rows = _with(rows, length=F.char_length("_body"), _k=F.char_length("_abc").cast("double"),
                 _chars=F.filter(F.split("_body", "(?!^)", -1), lambda c: c != ""))
    rows = _with(rows, _x=F.transform("_chars", lambda c: F.call_function("instr", F.col("_abc"), c).cast("double")),
                 _o2=_sum(F.transform(F.array_distinct("_chars"), lambda c: F.pow(
                     F.col("length") - F.char_length(F.replace(F.col("_body"), c, F.lit(""))), F.lit(2.0)))))
    n, k, x = F.col("length").cast("double"), F.col("_k"), F.col("_x")
    rows = _with(rows, _mean=_sum(x) / n, _high=F.transform(x, lambda v: (v > k / 2).cast("double")))
    rows = _with(rows, _dev=F.transform(x, lambda v: v - F.col("_mean")))
    ahead = lambda c: F.slice(c, 2, F.col("length") - 1)
    behind = lambda c: F.slice(c, 1, F.col("length") - 1)
    rows = _with(
        rows, _n1=_sum(F.col("_high")), _var=_sum(F.transform("_dev", lambda v: v * v)),
        _turns=_sum(F.zip_with(behind(F.col("_high")), ahead(F.col("_high")), lambda a, b: F.abs(a - b))),
        _lag=_sum(F.zip_with(behind(F.col("_dev")), ahead(F.col("_dev")), lambda a, b: a * b)))
    rows = _with(rows, _pairs=2 * F.col("_n1") * (n - F.col("_n1")))
    pairs = F.col("_pairs")
    rows = _with(rows, _spread=pairs * (pairs - n) / (n * n * (n - 1)))
    # All symbols in one half, or all equal: as far from random as can be.
    far = F.lit(40.0)
    rows = _with(
        rows, _chi=_two_sided((k / n * F.col("_o2") - n - (k - 1)) / F.sqrt(2 * (k - 1) * (1 - 1 / n))),
        _runs=_two_sided(F.when(F.col("_spread") > 0, (F.col("_turns") - pairs / n) / F.sqrt("_spread")).otherwise(far)),
        _serial=_two_sided(F.when(F.col("_var") > 0, (F.col("_lag") / F.col("_var") + 1 / n) * F.sqrt(n)).otherwise(far)))
    # Fisher: the sum of -2 ln p follows chi-squared with 6 degrees of freedom.
    rows = _with(rows, _half=-(F.ln("_chi") + F.ln("_runs") + F.ln("_serial")))
    half = F.col("_half")
    return rows.select(*tokens.columns, "length", (F.exp(-half) * (1 + half + half * half / 2)).alias("p"))


def length_class(length: Column) -> Column:
    out = F.lit(len(LENGTH_CLASSES))
    for number, bound in reversed(list(enumerate(LENGTH_CLASSES))):
        out = F.when(length < bound, F.lit(number)).otherwise(out)
    return out


def cleared(tested: DataFrame, rate: float = FDR) -> DataFrame:
    """``size, step``: per length class, tokens at or beyond this grid step of
    ``-log10 p`` are cleared. The counts per class and step are the only thing
    gathered: at most 6 x 801 rows."""
    steps = tested.groupBy(length_class(F.col("length")).alias("size"), _step().alias("step"))
    counts = steps.agg(F.count(F.lit(1)).alias("n"))
    by = Window.partitionBy("size")
    counts = counts.withColumns({"upto": F.sum("n").over(by.orderBy(F.desc("step"))), "all": F.sum("n").over(by)})
    # The largest p-value of a step against its rank.
    holds = F.pow(F.lit(10.0), -F.col("step") / GRID) <= rate * F.col("upto") / F.col("all")
    return counts.where(holds).groupBy("size").agg(F.min("step").alias("least"))


def _step() -> Column:
    return F.least(F.floor(-F.log10(F.greatest(F.col("p"), F.lit(1e-30))) * GRID).cast("int"), F.lit(GRID_END))


def _matches(rows: DataFrame, patterns: dict[str, str]) -> DataFrame:
    """The columns of ``rows`` but ``text``, with ``row, kind, start, end,
    match``: all matches of all patterns in ``text``, as code point ranges. A
    match's start is the length of what stands before it: the pieces between
    matches and the earlier matches."""
    carry = [c for c in rows.columns if c != "text"]
    found = F.array(*[F.struct(F.lit(k).alias("kind"), F.regexp_extract_all("text", F.lit(p), F.lit(0)).alias("m"))
                      for k, p in patterns.items()])
    rows = rows.withColumn("found", F.explode(F.filter(found, lambda f: F.size(f["m"]) > 0)))
    parts = F.lit(None).cast("array<string>")
    for kind, pattern in patterns.items():
        parts = F.when(F.col("found.kind") == kind, F.split("text", pattern, -1)).otherwise(parts)
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    rows = rows.select(*carry, "row", "found.kind",
                       F.posexplode(F.arrays_zip(F.col("found.m").alias("m"), parts.alias("between"))))
    rows = rows.where(F.col("col.m").isNotNull()).select(
        *carry, "row", "kind", "pos", F.col("col.m").alias("match"), F.char_length("col.m").alias("size"),
        F.char_length("col.between").alias("gap"))
    before = Window.partitionBy("row", "kind").orderBy("pos")
    end = F.sum(F.col("gap") + F.col("size")).over(before)
    return rows.select(*carry, "row", "kind", (end - F.col("size")).alias("start"), end.alias("end"), "match")


def find_matches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, key, kind, start, end, match`` of all patterns, with ``row``,
    which tells apart the rows and kinds."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return _matches(docs.select(F.col(id_col).alias("doc_id"), text_key(text).alias("key"), text.alias("text")), PATTERNS)


def tokens(matches: DataFrame) -> DataFrame:
    """The tokens to test: those with an inferred encoding, and of the others
    the runs of every alphabet, each run once."""
    found = matches.where("kind = 'random'").drop("row")
    whole = _alphabet(F.col("match")).isNotNull()
    mixed = found.where(~whole).select("doc_id", "key", F.monotonically_increasing_id().alias("token"),
                                       F.col("start").alias("at"), F.col("match").alias("text"))
    # The token's number is fixed by the written matches; equal runs of two alphabets are one.
    runs = _matches(mixed, RUNS).dropDuplicates(["token", "start", "end"])
    return found.where(whole).unionByName(runs.select(
        "doc_id", "key", F.lit("random").alias("kind"), (F.col("at") + F.col("start")).alias("start"),
        (F.col("at") + F.col("end")).alias("end"), "match"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, key, kind, start, end`` of every secret; ``key`` tells apart
    the texts of one id. Rows with the same id and text give the same spans
    once. Null and empty texts have none; null ids are carried; other columns
    are dropped. The spans are written once below the checkpoint folder."""
    matches = stage_table(find_matches(docs, id_col, text_col), "secret-matches")
    base = matches.where(
        ((F.col("kind") == "assign") & (F.char_length(F.regexp_extract("match", ASSIGN, 1)) >= LEAST_ASSIGNED))
        | F.col("kind").isin("access", "hex"))
    tested = stage_table(randomness(tokens(matches), "match"), "secret-tests")
    limits = cleared(tested).withColumnRenamed("size", "class")
    # At most one row per length class.
    random_ = (tested.withColumn("class", length_class(F.col("length"))).join(F.broadcast(limits), "class", "left")
                     .where(F.col("least").isNull() | (_step() < F.col("least"))))
    columns = ["doc_id", "key", "kind", "start", "end"]
    return stage_table(base.select(columns).unionByName(random_.select(columns)).distinct(), "secrets")


def redact(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", mask: str = MASK) -> DataFrame:
    """``docs`` with every secret replaced by ``mask`` (overlapping spans are
    one); all columns stay."""
    spans = scan(docs, id_col, text_col)
    by = Window.partitionBy("doc_id", "key").orderBy("start", "end")
    reach = F.max("end").over(by.rowsBetween(Window.unboundedPreceding, -1))
    islands = (spans.withColumn("new", F.when(reach.isNull() | (F.col("start") > reach), 1).otherwise(0))
                    .withColumn("island", F.sum("new").over(by))
                    .groupBy("doc_id", "key", "island").agg(F.min("start").alias("start"), F.max("end").alias("end"))
                    .groupBy("doc_id", "key").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("_wm_cut"))
                    .select(F.col("doc_id").alias("_wm_id"), F.col("key").alias("_wm_key"), "_wm_cut"))
    text = F.col(text_col)
    joined = docs.join(broadcast_if_small(islands), docs[id_col].eqNullSafe(F.col("_wm_id"))
                       & (text_key(F.coalesce(text, F.lit(""))) == F.col("_wm_key")), "left")
    cut = F.col("_wm_cut")
    # The text between the spans: from each end to the next start.
    begins = F.concat(F.array(F.lit(0).cast("bigint")), cut["end"])
    ends = F.concat(cut["start"], F.array(F.char_length(text).cast("bigint")))
    between = F.zip_with(begins, ends, lambda b, e: F.substr(text, (b + 1).cast("int"), (e - b).cast("int")))
    clean = F.when(cut.isNull(), text).otherwise(F.array_join(between, mask))
    return joined.withColumn(text_col, clean).select(*docs.columns)


def op10_randomness_battery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, as counts and span lists. What the method
    bounds is the share of random strings among the tokens that it clears, not
    among those that it reports."""
    docs = table(spark, sf_dir, "documents", ["doc_id", "text"])
    order = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    listed = scan(docs).groupBy("doc_id", "key").agg(
        F.sort_array(F.collect_list(F.struct("start", order.alias("order"), "end", "kind"))).alias("s"))
    joined = (docs.select("doc_id", text_key(F.coalesce("text", F.lit(""))).alias("key"))
                  .join(listed.withColumnsRenamed({"doc_id": "_id", "key": "_key"}),
                        F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key")), "left"))
    spans = F.coalesce("s", F.array().cast("array<struct<start:bigint,order:bigint,end:bigint,kind:string>>"))
    rows = joined.select("doc_id", spans.alias("s"))

    def shown(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                     s["end"].cast("string"))), ",")

    base = F.filter("s", lambda s: s["kind"] != "random")
    number = lambda kind: F.size(F.filter("s", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return rows.select("doc_id", number("assign"), number("access"), number("hex"),
                       F.sha2(shown(base), 256).alias("base_sha256"), shown(F.col("s")).alias("spans"))
