"""Perplexity rules and language ID."""

import functools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from conftest import SF01, SF001

from waymark.llm import catalog, language_id, perplexity


def brute_base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(words[k:k + 3]) for k in range(len(words) - 2))
    repeated = {k + j for k in range(len(words) - 2) if windows[tuple(words[k:k + 3])] > 1 for j in range(3)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(repeated))


def brute_grams(text):
    out = [" "] * 3
    for c in text.lower():
        c = " " if c in " \t\n\r\v\f" else c
        if c != " " or out[-1] != " " or len(out) == 3:
            out.append(c)
    return [tuple(out[k:k + 4]) for k in range(len(out) - 3)]


def brute_kneser_ney(texts):
    levels = {4: Counter(g for t in texts for g in brute_grams(t))}
    for n in (3, 2, 1):
        levels[n] = Counter(g[1:] for g in levels[n + 1])
    discount = {}
    for n, counts in levels.items():
        c = Counter(counts.values())
        y = c[1] / (c[1] + 2 * c[2]) if c[1] + 2 * c[2] else None
        discount[n] = [0.5 if y is None or not c[k] else max(0, min(k, k - (k + 1) * y * c[k + 1] / c[k])) for k in (1, 2, 3)]
    total, left = defaultdict(float), defaultdict(float)
    for n, counts in levels.items():
        for g, c in counts.items():
            total[n, g[:-1]] += c
            left[n, g[:-1]] += discount[n][min(c, 3) - 1]

    def p(g):
        n = len(g)
        if n == 0:
            return 1 / (len(levels[1]) + 1)
        if (n, g[:-1]) not in total:
            return p(g[1:])
        c = levels[n][g]
        return (c - (discount[n][min(c, 3) - 1] if c else 0) + left[n, g[:-1]] * p(g[1:])) / total[n, g[:-1]]
    return p


def log_probabilities(model, lang, text):
    first, rest, bounds = perplexity.grams(pa.array([text]))
    assert list(bounds) == [0, len(rest)]
    return model.log_probabilities(np.repeat(perplexity._salts([lang]), len(rest)), first, rest)


TEXTS = ["The cat sat.  On the mat\nthe cat, sat 12 times", "Éa ça the ñu the sat", "", "abc abc abcd", "#$% cat!",
         "Привет мир, мир", "漢字と仮名 漢字 😀"]


def test_model_equals_brute_force_modified_kneser_ney(spark):
    df = spark.createDataFrame([(k, t, "en") for k, t in enumerate(TEXTS)] + [(9, None, "en"), (8, "autre texte", None)],
                               "doc_id bigint, text string, lang string")
    model = perplexity.gather(perplexity.fit(df))
    p = brute_kneser_ney(TEXTS)
    for text in [*TEXTS, "unseen zebra quiz 99", "the dog", "мир ☃ 漢"]:
        want = [math.log(p(g)) for g in brute_grams(text)]
        assert np.allclose(log_probabilities(model, "en", text), want, atol=1e-4), text
    assert np.allclose(log_probabilities(model, "none such", "the"), -math.log(0x110000))
    # A context's probabilities sum to 1, with one unseen character for all others.
    seen = {c for t in TEXTS for g in brute_grams(t) for c in g[3:]}
    ends = [log_probabilities(model, "en", "the" + c)[-1] for c in sorted(seen - {" "})] + [log_probabilities(model, "en", "the ")[-1],
                                                                                           log_probabilities(model, "en", "the☃")[-1]]
    assert abs(np.exp(ends).sum() - 1) < 1e-4


def test_joins_score_like_the_arrays(spark, monkeypatch):
    rows = [(k, t, "en") for k, t in enumerate(TEXTS)] + [(9, None, "en"), (8, "autre texte", None), (8, "autre texte", None), (None, "x y", "en")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    levels = perplexity.fit(df)
    other = spark.createDataFrame([*rows, (50, "unseen ☃ zebra", "en"), (51, "the cat", "xx")], df.schema)
    arrays = {(r.doc_id, r.key, r.lang): r.log_sum for r in perplexity.measure(other, perplexity.gather(levels)).collect()}
    joined = {(r.doc_id, r.key, r.lang): r.log_sum for r in perplexity.joined_scores(other, levels).collect()}
    assert set(joined) == {k for k, v in arrays.items() if v is not None}
    assert all(joined[k] == pytest.approx(arrays[k], abs=1e-3) for k in joined)
    show = lambda: sorted(((r.doc_id or -1, r.n_words, round(r.perplexity or 0, 3), r.kept) for r in perplexity.quality(df).collect()))
    first = show()
    monkeypatch.setattr(perplexity, "MODEL_KEYS", 0)
    second = show()
    assert [r[:2] for r in second] == [r[:2] for r in first]
    assert np.allclose([r[2] for r in second], [r[2] for r in first], rtol=1e-3)


def test_verdict_equals_brute_force(spark):
    docs = duckdb.sql(f"SELECT doc_id, text, lang FROM '{SF001}/documents.parquet'").fetchall()
    got = {r.doc_id: r for r in catalog.QUERIES["op6_perplexity"](spark, SF001).collect()}
    for lang in {d[2] for d in docs}:
        mine = [(i, t) for i, t, x in docs if x == lang and t and t.split()]
        p = functools.cache(brute_kneser_ney([t for _, t in mine]))
        logs = {i: (-sum(math.log(p(g)) for g in brute_grams(t)) / brute_base(t)[0], brute_base(t)[0]) for i, t in mine}
        grid = {i: math.floor(v * 1000) for i, (v, _) in logs.items()}
        middle = sorted(grid.values())[(len(grid) - 1) // 2]
        scale = sorted(abs(grid[i] - middle) * math.sqrt(n) for i, (_, n) in logs.items())[(len(grid) - 1) // 2]
        for i, (value, n) in logs.items():
            assert got[i].perplexity == pytest.approx(math.exp(value), rel=1e-3)
            limit = perplexity.LEAST_BAND + perplexity.BAND * scale / 1000 / math.sqrt(n)
            away = abs(value - middle / 1000)
            if abs(away - limit) > 0.02:
                assert got[i].kept == (not got[i].base_failed and away <= limit), i


def test_junk_in_two_scripts_is_rejected_on_either_side(spark):
    rng = random.Random(4)
    rows = []
    for lang, letters in (("en", "abcdefghijklmnoprstuw"), ("ru", "абвгдежзийклмнопрстуфх")):
        vocabulary = ["".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(300)]
        for k in range(150):
            rows.append((f"{lang}-good-{k}", " ".join(rng.choice(vocabulary[:30] if rng.random() < 0.2 else vocabulary)
                                                       for _ in range(rng.randint(60, 400))), lang))
        for k in range(4):
            words = [rng.choice(vocabulary) for _ in range(200)]
            rows.append((f"{lang}-marks-{k}", " ".join(w + rng.choice(["***", "%%%", "&&&"]) for w in words), lang))
            rows.append((f"{lang}-foreign-{k}", " ".join("".join(rng.choice("αβγδεζηθικλ") for _ in range(6)) for _ in range(200)), lang))
            few = sorted(vocabulary[:30], key=len)[:16]
            rows.append((f"{lang}-few-{k}", " ".join(rng.choice(few) for _ in range(450)), lang))
    got = perplexity.quality(spark.createDataFrame(rows, "doc_id string, text string, lang string")).collect()
    assert not [r.doc_id for r in got if "good" in r.doc_id and not r.kept]
    assert not [r.doc_id for r in got if "good" not in r.doc_id and (r.kept or r.base_failed)]
    typical = np.median([r.perplexity for r in got if "good" in r.doc_id])
    assert {r.perplexity < typical for r in got if "few" in r.doc_id} == {True}
    assert {r.perplexity > typical for r in got if "marks" in r.doc_id or "foreign" in r.doc_id} == {True}


def test_base_counts_on_documents_and_odd_texts(spark):
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{SF001}/documents.parquet'").fetchall()
    docs += [(-1, None), (-2, ""), (-3, " \n \n"), (-4, "a b c a b c\na b c a b c\n\na b c a b c"), (-5, "x"), (-6, "wörd " * 30_000),
             (-7, "a\x0bb\x1cc d\n a\x0bb\x1cc d"), (None, "null id")]
    df = spark.createDataFrame([(i, t, None, 1, "k") for i, t in docs],
                               "doc_id bigint, text string, lang string, n_words int, kept string")
    got = {r.doc_id: r for r in perplexity.quality(df).collect()}
    assert len(got) == len(docs)
    for doc, text in docs:
        r, want = got[doc], brute_base(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, doc
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.base_failed and r.kept)
    assert perplexity.quality(df.limit(0)).count() == 0


def test_labelled_documents(spark):
    got = {r.doc_id: r for r in catalog.QUERIES["op6_perplexity"](spark, SF01).collect()}
    labels = [(i, q) for i, q in duckdb.sql(f"SELECT doc_id, quality FROM '{SF01}/labels.parquet'").fetchall() if not got[i].base_failed]
    assert all(got[i].kept for i, q in labels if q)
    junk = [got[i].kept for i, q in labels if not q]
    assert sum(not k for k in junk) >= 0.55 * len(junk) > 10


def test_band_medians_are_exact(spark):
    rows = [("a", 100, v) for v in (1.0005, 1.2005, 1.3005, 1.4005, 9.0005)] + [("b", 25, 2.0005), ("b", 9, None), ("c", 400, 1.0), ("c", 100, 1.5)]
    got = {r.lang: r for r in perplexity.bands(spark.createDataFrame(rows, "lang string, n_words long, log_ppl double")).collect()}
    assert got["a"].middle == 1.3 and got["a"].scale == pytest.approx(1.0, rel=2e-3)
    assert (got["b"].middle, got["b"].scale) == (2.0, 0.0)
    assert (got["c"].middle, got["c"].scale) == (1.0, 0.0)


def test_language_on_the_held_out_fold(spark):
    docs = duckdb.sql(f"SELECT doc_id, text, lang FROM '{SF01}/documents.parquet'").fetchall()
    got = {r.doc_id: r for r in catalog.QUERIES["op9_language_id"](spark, SF01).collect()}
    assert len(got) == len(docs)
    for doc, _, _ in docs:
        assert got[doc].held_out == (zlib.crc32(str(doc).encode()) % 3 == 1)
    held = [got[d].lang_pred == lang for d, _, lang in docs if got[d].held_out and lang]
    assert np.mean(held) > 0.98
    assert all(0 <= r.score <= 1 for r in got.values())


def test_language_rows_without_letters_nulls_and_ties(spark):
    train = spark.createDataFrame([(0, "the house and the tree", "en"), (2, "das Haus und der Baum", "de"), (3, "nothing", None)],
                                  "doc_id bigint, text string, lang string")
    model = language_id.fit(train)
    assert model.languages == ["de", "en"]
    rows = [(1, None), (2, ""), (3, "123 !!"), (4, "der Baum und das Haus"), (None, "the tree"), (5, "x" * 300_000), (6, "é")]
    df = spark.createDataFrame([(i, t, "z") for i, t in rows], "doc_id bigint, text string, lang_pred string")
    got = {r.doc_id: r for r in language_id.predict(df, model, ["doc_id"]).collect()}
    assert [got[k].lang_pred for k in (1, 2, 3)] == ["und"] * 3 and got[1].score == 0
    assert got[4].lang_pred == "de" and got[None].lang_pred == "en"
    assert language_id.predict(df.limit(0), model, ["doc_id"]).count() == 0
    nothing = language_id.fit(train.limit(0))
    assert {r.lang_pred for r in language_id.predict(df, nothing, ["doc_id"]).collect()} == {"und"}


def test_score_equals_brute_force(spark):
    train = spark.createDataFrame([("ab ba ab", "x"), ("bc cb", "y"), ("Cb", "y")], "text string, lang string")
    model = language_id.fit(train)

    def grams(text):
        # Every run of 1 to 3 characters with a letter in it, hashed with plain integers.
        chars, out = [c if c.isalpha() else " " for c in text.lower()], []
        for n in range(1, 4):
            for at in range(len(chars) - n + 1):
                run = chars[at:at + n]
                if set(run) != {" "}:
                    value = 0
                    for k, c in enumerate(run):
                        value = (value * 0x01000193 + ord(c) * 0x9E3779B1 + k + 1) % 2 ** 32
                    out.append((value ^ (value >> 15)) * 0x85EBCA6B % 2 ** 32 >> 16)
        return out

    counts = {"x": np.zeros(language_id.BUCKETS), "y": np.zeros(language_id.BUCKETS)}
    for text, lang in (("ab ba ab", "x"), ("bc cb", "y"), ("Cb", "y")):
        np.add.at(counts[lang], grams(text), 1)
    total = [sum(math.log((c[g] + .5) / (c.sum() + .5 * language_id.BUCKETS)) for g in grams("ab c"))
             + math.log({"x": 1, "y": 2}[lang] / 3) for lang, c in counts.items()]
    want = 1 / sum(math.exp(t - max(total)) for t in total)
    names, scores = model.predict(pa.array(["ab c"]))
    assert names == [["x", "y"][int(np.argmax(total))]] and scores[0] == pytest.approx(want, rel=1e-4)


FOREIGN = {
    "ru": "Съешь же ещё этих мягких французских булок да выпей чаю, а потом расскажи", "short": "чаю", "zh": "人人生而自由在尊严和权利上一律平等",
    "fi": "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto, "
          "ja heidän on toimittava toisiaan kohtaan veljeyden hengessä.",
    "pl": "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem "
          "i powinni postępować wobec innych w duchu braterstwa."}
CLEAN = ["the", "the cat", "in the house", "and the other", "das ist der", "le chat et la", "que los", "All human beings are born free and "
         "equal in dignity and rights.", "Alle Menschen sind frei und gleich an Würde und Rechten geboren."]


def test_pipeline_drops_foreign_and_random_texts_and_keeps_clean_ones(spark):
    import random

    import corpus_pipeline
    docs = duckdb.sql(f"SELECT doc_id, text, lang FROM '{SF01}/documents.parquet'").fetchall()
    rng = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyz"
    junk = [*FOREIGN.values(), *["".join(rng.choice(letters) for _ in range(n)) for n in (30, 300)],
            " ".join("".join(rng.choice(letters) for _ in range(5)) for _ in range(40))]
    slices = [t[:n] for n in (15, 40, 120) for _, t, _ in docs[:60] if any(c.isalpha() for c in t[:n])]
    rows = docs + [(10**6 + k, t, None) for k, t in enumerate(junk)] + [(2 * 10**6 + k, t, None) for k, t in enumerate(CLEAN + slices)]
    left = {r.doc_id for r in corpus_pipeline.identify_language(
        spark, spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), SF01).collect()}
    assert [junk[i - 10**6] for i in left if 10**6 <= i < 2 * 10**6] == []
    assert left >= {i for i, _, _ in rows if i < 10**6 or i >= 2 * 10**6}


def test_band_rejects_junk_on_either_side_that_passes_the_base_rules(spark):
    import random
    docs = duckdb.sql(f"SELECT doc_id, text, lang FROM '{SF01}/documents.parquet' WHERE lang = 'en'").fetchall()
    rng = random.Random(9)
    common = [w for w, _ in Counter(w for _, t, _ in docs for w in t.split()).most_common(12)]
    too_plain = [" ".join(rng.choice(common) for _ in range(120)) for _ in range(5)]
    noise = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6))
    long_ = [t for _, t, _ in docs if len(set(t.split())) > 150][:5]
    too_odd = [" ".join(noise() if rng.random() < 0.5 else w for w in t.split()) for t in long_]
    rows = docs + [(10**6 + k, t, "en") for k, t in enumerate(too_plain + too_odd)]
    got = {r.doc_id: r for r in perplexity.quality(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).collect()}
    middle = np.median([got[i].perplexity for i, _, _ in docs])
    for k in range(10):
        r = got[10**6 + k]
        assert not r.base_failed and not r.kept, (k, math.log(r.perplexity), math.log(middle))
        assert (r.perplexity < middle) == (k < 5)
    assert sum(not got[i].kept and not got[i].base_failed for i, _, _ in docs) > 0
