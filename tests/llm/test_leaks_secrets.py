"""Decontamination and secret scan."""

import hashlib
import itertools
import math
import random
import re
import string

import duckdb
import pytest
from conftest import SF01, SF001

from waymark.llm import catalog, decontaminate, secret_scan

BENCH = "item_id bigint, text string"
DOCS = "doc_id bigint, text string"


def words(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def brute_overlaps(docs, items):
    """All (document, item) with a window that agrees on some diagonal."""
    out = set()
    for doc, text in docs:
        d = words(text)
        for item, t in items:
            w = words(t)
            if not w:
                continue
            size = min(len(w), decontaminate.WINDOW)
            for shift in range(-len(w) + 1, len(d)):
                m = [0 <= k + shift < len(d) and d[k + shift] == w[k] for k in range(len(w))]
                if any(100 * sum(m[k:k + size]) >= decontaminate.AGREE * size for k in range(len(w) - size + 1)):
                    out.add((doc, item))
                    break
    return out


def found(spark, docs, items):
    rows = decontaminate.overlaps(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, BENCH)).collect()
    return {(r.doc_id, r.item_id) for r in rows}


@pytest.mark.parametrize("n", range(1, 14))
def test_masks_meet_every_accepted_pattern(n):
    wrong = n - -(-decontaminate.AGREE * n // 100)
    masks = [m for m, least, most in decontaminate.MASKS if least <= n <= most]
    spots = [{at + k for k, bit in enumerate(m) if bit == "1"} for m in masks for at in range(n - len(m) + 1)]
    for pattern in itertools.combinations(range(n), wrong):
        assert any(not spot & set(pattern) for spot in spots), pattern


def test_one_substitution_in_every_place_of_short_items(spark):
    docs, items = [], []
    for n in range(1, 13):
        item = [f"i{n}x{k}" for k in range(n)]
        items.append((n, " ".join(item)))
        for k in range(n):
            docs.append((100 * n + k, " ".join(["before", *item[:k], "other", *item[k + 1:], "after"])))
    got = found(spark, docs, items)
    assert got == {(100 * n + k, n) for n in range(5, 13) for k in range(n)} == brute_overlaps(docs, items)


def test_substitutions_cuts_and_clean_documents(spark):
    rng = random.Random(1)
    word = lambda: f"w{rng.randrange(400)}"
    items = [(k, " ".join(word() for _ in range(rng.randint(5, 40)))) for k in range(12)]
    items += [(20, "Only three words"), (21, None), (22, "!!!"), (23, items[0][1].upper()), (None, "an item without an id here now")]
    docs = [(1, None), (2, ""), (3, "!!"), (4, "so only THREE, words here"), (5, "only three other words")]
    for k in range(150):
        item = words(items[k % 12][1])
        text = [word() for _ in range(30)] + item + [word() for _ in range(30)]
        for _ in range(k // 12):
            text[rng.randrange(len(text))] = "zz"
        if k % 5 == 0:
            text = text[35:]
        docs.append((100 + k, "  ".join(text)))
    docs.append((None, "x an item without an id here now y"))
    docs.append((7, items[3][1]))
    docs.append((7, "clean text under the same id"))
    assert found(spark, docs, items) == brute_overlaps(docs, items)


def test_blocks_give_the_same_pairs(spark, monkeypatch):
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF001}/benchmark.parquet'").fetchall()
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{SF001}/documents.parquet'").fetchall()
    whole = found(spark, docs, items)
    monkeypatch.setattr(decontaminate, "BLOCK_SEEDS", 500)
    assert found(spark, docs, items) == whole and whole


def test_leaks_of_the_documents(spark):
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF01}/benchmark.parquet'").fetchall()
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{SF01}/documents.parquet'").fetchall()
    query = catalog.QUERIES["op7_spaced_seeds"](spark, SF01)
    got = {(r.doc_id, r.item_id) for r in query.collect()}
    whole = {(d, i) for d, t in docs for i, u in items if " ".join(words(u)) in " ".join(words(t))}
    shared = {i: {tuple(words(u)[k:k + 5]) for k in range(len(words(u)) - 4)} for i, u in items}
    for d, i in got:
        text = words(dict(docs)[d])
        assert len(shared[i] & {tuple(text[k:k + 5]) for k in range(len(text) - 4)}) >= 3
    assert whole <= got
    plan = query._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan


@pytest.mark.parametrize("docs, items", [([], [(1, "a b c d e f g h")]), ([(1, "a b c d e f g h")], []), ([], [])])
def test_empty_tables(spark, docs, items):
    assert found(spark, docs, items) == set()


PATTERNS = {"assign": re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I),
            "access": re.compile("AKIA[A-Z0-9]+"), "hex": re.compile("[0-9a-f]+")}


def brute_base(text):
    spans = []
    for order, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in pattern.finditer(text or ""):
            if len(m[2]) >= 8 if kind == "assign" else len(m[0]) >= {"access": 16, "hex": 32}[kind]:
                spans.append((m.start(), order, m.end(), kind))
    return [f"{k}:{s}:{e}" for s, _, e, k in sorted(spans)]


def test_base_spans(spark, tmp_path):
    rng = random.Random(3)
    pieces = ["token=", "Token = '", "api_key:", "APIKEY=\"", "secret", "password", " = ", "abcdef0123456789" * 2, "é😀", " ", "AKIA",
              "ABCDEFGH1234", "x", "=", "'", "deadbeef", "\n", "passwd: ", "a1b2", "AKIAAKIA", "token=secret: abcdefgh1"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 25))) for _ in range(400)]
    texts += [None, "", "token=abc", "😀" * 50_000 + " token=abcdefgh" * 3]
    rows = [(k, t) for k, t in enumerate(texts)] + [(0, texts[0]), (None, "token = abcdefgh")]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    got = catalog.QUERIES["op10_randomness_battery"](spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    by_id = dict(rows)
    for r in got:
        want = brute_base(by_id[r.doc_id])
        spans = r.spans.split(",") if r.spans else []
        assert [s for s in spans if not s.startswith("random")] == want
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s.startswith(k) for s in want) for k in PATTERNS)


def test_battery_tells_random_strings_from_identifiers(spark):
    rng = random.Random(7)
    random_ = ["".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(64)) for _ in range(60)]
    random_ = [t for t in random_ if re.search("[0-9]", t)]
    plain = ["Aa1" * 22, "AbstractFactoryBean00000000000000000000", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaB1", "0123456789abcdef" * 3]
    plain += [f"Chapter{'a' * 30}{k:03d}XyzSection" for k in range(40)]
    docs = [(k, f"see {t} there") for k, t in enumerate(random_ + plain)]
    spans = secret_scan.scan(spark.createDataFrame(docs, DOCS)).where("kind = 'random'").collect()
    hit = {r.doc_id for r in spans}
    n = len(random_)
    assert sum(k in hit for k in range(n)) >= 0.9 * n
    assert not any(k in hit for k in range(n, len(docs)))
    assert all((r.start, r.end) == (4, 4 + len((random_ + plain)[r.doc_id])) for r in spans)


def test_p_values_are_uniform_on_random_strings(spark):
    rng = random.Random(11)
    rows = [("".join(rng.choice("0123456789abcdef") for _ in range(200)),) for _ in range(400)]
    p = sorted(r.p for r in secret_scan.randomness(spark.createDataFrame(rows, "token string")).collect())
    assert len(p) == 400 and max(abs(x - (k + 0.5) / 400) for k, x in enumerate(p)) < 0.1


def test_redaction(spark):
    secret = "0123456789abcdef" * 2
    docs = [(1, f"é a token = \"{secret}\" b {secret} c"), (2, "clean"), (3, None), (4, ""), (2, f"{secret}"), (None, f"x {secret}"),
            (1, "other")]
    df = spark.createDataFrame([(i, t, "k") for i, t in docs], DOCS + ", key string")
    got = sorted((r.doc_id or 0, r.text or "", r.key) for r in secret_scan.redact(df).collect())
    assert got == sorted([(1, 'é a [SECRET]" b [SECRET] c', "k"), (1, "other", "k"), (2, "clean", "k"), (2, "[SECRET]", "k"), (3, "", "k"),
                          (4, "", "k"), (0, "x [SECRET]", "k")])
    assert secret_scan.redact(df.limit(0)).count() == 0


def test_secrets_of_the_documents(spark):
    docs = dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF01}/documents.parquet'").fetchall())
    query = catalog.QUERIES["op10_randomness_battery"](spark, SF01)
    for r in query.collect():
        assert [s for s in r.spans.split(",") if s and not s.startswith("random")] == brute_base(docs[r.doc_id])
    plan = query._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan


def test_random_values_behind_names_in_queries_and_in_paths(spark):
    rng = random.Random(13)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    forms = ["é😀 AUTH_KEY={} x", "see https://a.example/get?sig={}&x=1", "/etc/app_conf/{} y", "a = b, key_1={}== z",
             "my-app+other/some_name/{}"]
    secrets, docs = {}, []
    for k in range(100):
        secret = "A1b" + "".join(rng.choice(letters) for _ in range(45))
        before, after = forms[k % 5].split("{}")
        padding = "==" if after.startswith("==") else ""
        secrets[k] = (len(before), len(before) + len(secret + padding))
        docs.append((k, before + secret + after))
    df = spark.createDataFrame(docs, DOCS)
    got = {(r.doc_id, r.start, r.end) for r in secret_scan.scan(df).collect()}
    for form in range(5):
        assert sum((k, *secrets[k]) in got for k in range(form, 100, 5)) >= 18, forms[form]
    clean = {r.doc_id: r.text for r in secret_scan.redact(df).collect()}
    assert sum(docs[k][1][slice(*secrets[k])] not in clean[k] for k in range(100)) >= 90


ALPHABETS = [("[0-9]", "[a-f]", "[0-9a-f]", "0123456789abcdef", ""), ("[0-9]", "[A-F]", "[0-9A-F]", "0123456789ABCDEF", ""),
             ("[2-7]", "[A-Z]", "[A-Z2-7]", string.ascii_uppercase + "234567", "=*"),
             ("[0-9]", "[a-z]", "[0-9a-z]", string.digits + string.ascii_lowercase, ""),
             ("[0-9]", "(?=.*[a-z]).*[A-Z]", "[A-Za-z0-9+/]", string.ascii_uppercase + string.ascii_lowercase + string.digits + "+/", "=*"),
             ("[0-9]", "(?=.*[a-z]).*[A-Z]", "[A-Za-z0-9_-]", string.ascii_uppercase + string.ascii_lowercase + string.digits + "-_", "=*")]


def inferred(token):
    return next((abc for digit, letter, chars, abc, tail in ALPHABETS
                 if re.fullmatch(f"(?=.*{digit})(?=.*{letter}){chars}+{tail}", token)), None)


def combined_p(token):
    """Fisher's combination of the three tests, or None if the token is not tested."""
    abc, body = inferred(token), token.rstrip("=")
    if abc is None or len(body) < 20:
        return None
    n, k, x = len(body), len(abc), [abc.index(c) + 1 for c in body]
    two_sided = lambda z: max(math.erfc(abs(z) / math.sqrt(2)), 1e-300)
    chi = sum(body.count(c) ** 2 for c in set(body)) * k / n - n
    p = [two_sided((chi - (k - 1)) / math.sqrt(2 * (k - 1) * (1 - 1 / n)))]
    high = [v > k / 2 for v in x]
    pairs = 2 * sum(high) * (n - sum(high))
    spread = pairs * (pairs - n) / (n * n * (n - 1))
    turns = sum(a != b for a, b in itertools.pairwise(high))
    p.append(two_sided((turns - pairs / n) / math.sqrt(spread) if spread > 0 else 40))
    dev = [v - sum(x) / n for v in x]
    var = sum(d * d for d in dev)
    p.append(two_sided((sum(a * b for a, b in itertools.pairwise(dev)) / var + 1 / n) * math.sqrt(n) if var > 0 else 40))
    half = -sum(map(math.log, p))
    return math.exp(-half) * (1 + half + half * half / 2)


def test_random_spans_equal_brute_force(spark):
    rng = random.Random(19)
    pools = [abc for *_, abc, _ in ALPHABETS]
    docs = []
    for k in range(160):
        pool = rng.choice(pools)
        token = "".join(rng.choice(pool) for _ in range(rng.choice([12, 20, 30, 45, 60, 90, 200])))
        if k % 3 == 0:
            token = rng.choice(["Abc1" * 9, "item_001_" * 5, "0a" * 20, "HELLO2WORLD" * 3, token[:8] * 6])
        docs.append((k, rng.choice(["x {} y", "é😀 k={}", "/a/b_{}/c-d", "{}== z", "q=\"{}\"", "a.{}.b"]).format(token)))
    tested = []
    for doc, text in docs:
        for m in re.finditer(r"[A-Za-z0-9+/_-]{20,}(?:=+(?![A-Za-z0-9+/_=-]))?", text):
            if inferred(m[0]):
                tested.append((doc, m.start(), m.end(), m[0]))
                continue
            runs = {(doc, m.start() + r.start(), m.start() + r.end(), r[0])
                    for _, _, chars, _, tail in ALPHABETS for r in re.finditer(f"{chars}{{20,}}{tail}", m[0])}
            tested += sorted(runs)
    rows = [(*t, combined_p(t[3])) for t in tested]
    rows = [(d, s, e, t, p) for d, s, e, t, p in rows if p is not None]
    size = lambda t: sum(len(t.rstrip("=")) >= b for b in secret_scan.LENGTH_CLASSES)
    step = lambda p: min(math.floor(-math.log10(max(p, 1e-30)) * secret_scan.GRID), secret_scan.GRID_END)
    want = set()
    for c in {size(r[3]) for r in rows}:
        mine = [(step(r[4]), r) for r in rows if size(r[3]) == c]
        # Benjamini and Hochberg on the grid: the least step whose p-value is within the rate at its rank.
        limit = min((s for s, _ in mine if 10 ** (-s / secret_scan.GRID) <= secret_scan.FDR * sum(o >= s for o, _ in mine) / len(mine)),
                    default=math.inf)
        want |= {r[:3] for s, r in mine if s < limit}
    df = spark.createDataFrame(docs, DOCS)
    got = {(r.doc_id, r.start, r.end) for r in secret_scan.scan(df).where("kind = 'random'").collect()}
    assert got == want and 20 < len(want) < len(rows)
