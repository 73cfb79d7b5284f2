"""Text cleaning, join keys, tokens, missing tokens."""

from pyspark.sql import functions as F

from waymark.functions.text import MISSING_TOKENS, clean_text, join_key, nullify_tokens, split_words

NBSP = " "
# FIXTURES.md golden vectors: raw -> clean (extra '-'), key(clean), key(raw).
GOLDEN = [
    ("Colfax & Broadway", "colfax broadway", "colfax-broadway", "colfax-and-broadway"),
    ("56th/Pena", "56thpena", "56thpena", "56th-pena"),
    ("56th - Peña", "56th-pea", "56th-pea", "56th-pea"),
    (" E. Colfax Ave ", "e colfax ave", "e-colfax-ave", "e-colfax-ave"),
    ("a--b", "a--b", "a--b", "a--b"),
    ("- x -", "-x-", "x", "x"),
    ("!!!", "", "", ""),
    (None, None, "", ""),
    ("A_B  c", "a_b c", "a_b-c", "a_b-c"),
    ("É Ü ß", "", "", ""),
    (f"10{NBSP}th", "10 th", "10-th", "10-th"),
]


def test_clean_and_keys_golden(spark):
    df = spark.createDataFrame([(g[0],) for g in GOLDEN], "raw string")
    c = clean_text("raw", extra_chars="-")
    rows = df.select("raw", c.alias("clean"), join_key(c).alias("k_clean"),
                     join_key("raw").alias("k_raw")).collect()
    got = {r.raw: (r.clean, r.k_clean, r.k_raw) for r in rows}
    for raw, clean, k_clean, k_raw in GOLDEN:
        assert got[raw] == (clean, k_clean, k_raw), raw


def test_clean_basic_reference_case(spark):
    df = spark.createDataFrame([(" New York! ", "A_B"), ("Los Angeles?", "C D")], "city string, name string")
    out = df.select(clean_text("city").alias("city"), clean_text("name").alias("name")).collect()
    assert [r.city for r in out] == ["new york", "los angeles"]
    assert [r.name for r in out] == ["a_b", "c d"]


def test_clean_flags(spark):
    df = spark.createDataFrame([("Main St. 5_a-b",)], "t string")
    no_lower = df.select(clean_text("t", lowercase=False).alias("x")).first().x
    assert no_lower == "ain t 5_ab"  # capitals vanish as punctuation
    no_num = df.select(clean_text("t", keep_numbers=False, keep_underscore=False).alias("x")).first().x
    assert no_num == "main st ab"
    keep = df.select(clean_text("t", extra_chars=".-").alias("x")).first().x
    assert keep == "main st. 5_a-b"
    raw = df.select(clean_text("t", collapse_whitespace=False, strip=False, remove_punctuation=False).alias("x"))
    assert raw.first().x == "main st. 5_a-b"


def test_split_words(spark):
    df = spark.createDataFrame([("alpha beta",), ("gamma",), ("a b  c",), ("",), (None,)], "text string")
    got = [r.w for r in df.select(split_words("text").alias("w")).collect()]
    assert got == [["alpha", "beta"], ["gamma"], ["a", "b", "", "c"], [""], [""]]


def test_nullify_tokens(spark):
    vals = list(MISSING_TOKENS) + ["Main", "NAN ", "n/a."]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = [r.x for r in df.select(nullify_tokens("v").alias("x")).collect()]
    assert got[:len(MISSING_TOKENS)] == [None] * len(MISSING_TOKENS)
    assert got[len(MISSING_TOKENS):] == ["Main", "NAN ", "n/a."]


def test_no_python_in_text_plans(spark):
    df = spark.range(3).select(F.col("id").cast("string").alias("t"))
    plan = df.select(clean_text("t"), join_key("t"), split_words("t"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan


def test_short_ways_equal_the_regular_expressions(spark):
    """Cleaning, keys and stripping of ASCII and of cleaned texts skip most
    regular expressions; the results are those of the expressions."""
    import random
    from waymark.functions.text import WHITESPACE_CHARS, WS, keep_only, strip_ws
    draw = random.Random(3)
    signs = [list("aAzZ09_--- \t\n\r\x0b\x1c\x00\x01\x7f&/#!.  ") + ["é", NBSP, "\u212a", "İ", "\u0085"],
             list("aZ09_-- \t\n\x1f\x01&#  "), list("ab0_-  -")]
    texts = ["", " ", "-", " - "] + ["".join(draw.choice(s) for _ in range(draw.randrange(14))) for s in signs for _ in range(1500)]
    df = spark.createDataFrame([(t,) for t in [None, *texts]], "t string")
    kept = keep_only(F.lower("t"), rf"a-z0-9_\-{WHITESPACE_CHARS}")
    clean = F.trim(F.regexp_replace(F.regexp_replace(kept, f"{WS}+", " "), " ?- ?", "-"))
    strip = F.regexp_replace("t", f"^{WS}+|{WS}+$", "")

    def key(c):
        out = F.lower(F.regexp_replace(c, f"^{WS}+|{WS}+$", ""))
        out = F.replace(F.replace(out, F.lit("&"), F.lit(" and ")), F.lit("/"), F.lit("-"))
        out = F.regexp_replace(F.regexp_replace(out, f"{WS}+", " "), " ?- ?", "-")
        out = F.regexp_replace(keep_only(out, rf"a-z0-9\-_{WHITESPACE_CHARS}"), f"{WS}+", "-")
        return F.coalesce(F.regexp_replace(out, "^-+|-+$", ""), F.lit(""))

    short = clean_text("t", extra_chars="-")
    for got, want in ((short, clean), (strip_ws("t"), strip), (join_key("t"), key(F.col("t"))), (join_key(short), key(clean))):
        assert df.where(~got.eqNullSafe(want)).collect() == []
    plan = df.select(short)._jdf.queryExecution().optimizedPlan().toString()
    assert "translate(" in plan and "octet_length" in plan


def test_texts_with_nothing_to_clean_are_kept(spark):
    """A text that the whole cleaning would not change skips it, whatever the
    flags."""
    import itertools
    import random
    import string
    from waymark.functions.text import _clean_ascii
    draw = random.Random(5)
    texts = ["", " ", "-", "a", "a-b", "a - b", "a -b", "a--b c", "a b ", " a", "a  b", "A b", "5_a", "a.b", "x\n", "a b\n"]
    texts += ["".join(draw.choice("ab5_- .A") for _ in range(draw.randrange(9))) for _ in range(2000)]
    df = spark.createDataFrame([(t,) for t in [None, *texts]], "t string")
    for numbers, underscore, extra in itertools.product((True, False), (True, False), ("", "-", ".-", ".")):
        chars = string.ascii_lowercase + (string.digits if numbers else "") + ("_" if underscore else "") + extra
        want = F.trim(_clean_ascii(F.lower("t"), chars))
        got = clean_text("t", keep_numbers=numbers, keep_underscore=underscore, extra_chars=extra)
        assert df.where(~got.eqNullSafe(want)).collect() == [], (numbers, underscore, extra)
    plan = df.select(got)._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN RLIKE(" in plan  # the whole text is tested once, first
