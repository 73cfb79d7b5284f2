"""SuperMinHash near-duplicates against brute force."""

import random
import re
from itertools import combinations

import duckdb
import numpy as np
from conftest import SF001

from waymark.llm import catalog, superminhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_sets(docs):
    out = []
    for _, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        out.append({tuple(words[k:k + 5]) for k in range(len(words) - 4)} if len(words) >= 5
                   else ({tuple(words)} if words else set()))
    return out


def brute_components(docs):
    sets = brute_sets(docs)
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(range(len(docs)), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
            parent[find(a)] = find(b)
    least = {}
    for k, (doc, _) in enumerate(docs):
        if doc is not None:
            least[find(k)] = min(least.get(find(k), doc), doc)
    return [(doc, len(sets[k]), least.get(find(k))) for k, (doc, _) in enumerate(docs)]


def check(spark, docs):
    got = superminhash.near_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
    key = lambda r: tuple((x is not None, x or 0) for x in r)
    assert (sorted([(r.doc_id, r.n_shingles, r.component_id) for r in got], key=key)
            == sorted(brute_components(docs), key=key))
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def edited(words, n, seed):
    rng = random.Random(seed)
    words = list(words)
    for at in rng.sample(range(len(words)), n):
        words[at] = f"x{seed}_{at}"
    return " ".join(words)


def test_chains_hot_groups_nulls_and_short_texts(spark):
    rng = random.Random(2)
    base = [f"w{rng.randrange(5000)}" for _ in range(300)]
    docs = [(1000 + k, edited(base, k % 12, k)) for k in range(60)]  # links of every strength
    docs += [(k, "  ".join(base).upper()) for k in (7, 8, 9)] + [(9, " ".join(base))]
    # A chain: each is near the next, the ends are not.
    chain = [f"c{k}" for k in range(400)]
    docs += [(2000 + k, " ".join(chain[20 * k:20 * k + 220])) for k in range(9)]
    docs += [(1, None), (2, ""), (3, " \n\t"), (4, "a b c"), (5, "A  b\nc"), (6, "a b"), (None, " ".join(base)), (None, "lone null id here")]
    check(spark, docs)


def test_strangers_in_a_bucket_are_linked(spark):
    """Members that miss their bucket's leader but not each other."""
    rng = random.Random(4)
    base = [f"v{rng.randrange(9000)}" for _ in range(400)]
    docs = [(k, edited(base, 9 + k % 9, 50 + k)) for k in range(120)]
    check(spark, docs)


def test_estimates_are_unbiased_with_less_variance():
    rng = np.random.default_rng(0)
    for n, limit in ((3, 1.0), (200, 1.0)):
        agree = []
        for _ in range(300):
            u = rng.integers(0, 2**63, 4 * n).astype(np.uint64)
            a, b = superminhash.signatures([u[:3 * n], u[n:]])
            agree.append((a == b).mean())
        assert abs(np.mean(agree) - 0.5) < 0.01
        assert np.var(agree) < limit * 0.25 / superminhash.POSITIONS


def test_signature_of_a_set_does_not_depend_on_blocks():
    u = np.random.default_rng(3).integers(0, 2**63, 900).astype(np.uint64)
    whole = superminhash.signatures([u, u[:5], u[:0]])
    assert np.array_equal(whole, superminhash.signatures([u, u[:5], u[:0]], block=64))


def test_keep_one(spark):
    docs = [(1, "a b c d e f g"), (2, "A b c d e f g"), (2, "another text that stays as it is"), (3, "x y"), (3, "x y"), (4, None),
            (4, None), (5, "")]
    df = spark.createDataFrame([(i, t, "k") for i, t in docs], "doc_id bigint, text string, kept string")
    got = sorted((r.doc_id, r.text or "", r.kept) for r in superminhash.keep_one(df).collect())
    assert got == [(1, "a b c d e f g", "k"), (2, "another text that stays as it is", "k"), (3, "x y", "k"), (4, "", "k"), (5, "", "k")]


def test_empty_table(spark):
    assert superminhash.near_duplicates(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_query(spark):
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{SF001}/documents.parquet'").fetchall()
    got = catalog.QUERIES["op3_superminhash"](spark, SF001).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted(brute_components(docs))
