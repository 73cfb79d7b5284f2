"""The pipeline against its stages done by brute force."""

import re

import duckdb
import pytest
from conftest import SF001
from test_leaks_secrets import brute_overlaps, words
from test_near_duplicates import brute_components

import corpus_pipeline
from waymark.llm import secret_scan


def test_run_equals_brute_force(spark):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    import sentencepiece
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{SF001}/documents.parquet'").fetchall()
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF001}/benchmark.parquet'").fetchall()
    docs = [d for d in docs if any(c.isalpha() for c in d[1] or "")]
    kept = {doc for doc, _, least in brute_components(docs) if doc == least}
    docs = [d for d in docs if d[0] in kept]
    seeds = {tuple(words(t)[k:k + 3]) for _, t in items for k in range(len(words(t)) - 2)}
    near = [d for d in docs if sum(tuple(words(d[1])[k:k + 3]) in seeds for k in range(len(words(d[1])) - 2)) > 2]
    leaks = {d for d, _ in brute_overlaps(near, items)}
    docs = [d for d in docs if d[0] not in leaks]
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF001).collect()}
    assert set(got) == {d for d, _ in docs}
    for doc, text in docs:
        clean = re.sub(secret_scan.ASSIGN.replace("+)", "{8,})"), secret_scan.MASK, text)
        clean = re.sub(secret_scan.HEX, secret_scan.MASK, clean)
        ids = library.encode(clean) + [2]
        assert list(got[doc].ids) == ids and got[doc].n_tokens == len(ids), doc
        assert got[doc].text == library.decode(ids)


def test_stages_return_documents_and_pass_odd_rows(spark):
    rows = [(1, "the quick brown fox and the dog are in the house", "en", "s", 3), (1, "the quick brown fox and the dog are in the house", "en", "s", 3),
            (None, "le chat et la souris sont dans la maison", "fr", None, None), (2, None, None, "s", 0), (3, "123", "en", "s", 3),
            (4, "the dog and the house token = abcdefgh1234 are here", None, "s", 1)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    docs = spark.createDataFrame(rows, schema)
    for name, stage in corpus_pipeline.STAGES:
        empty = stage(spark, docs.limit(0), SF001)
        assert empty.count() == 0, name
        out = stage(spark, docs, SF001)
        if name != "sentencepiece":
            assert out.columns == docs.columns
            assert sorted(out.dtypes) == sorted(docs.dtypes)
    odd = docs.selectExpr("*", "1.0D AS score", "'x' AS lang_pred", "true AS kept", "array(1) AS ids", "'k' AS key", "2L AS n",
                          "5 AS start", "'t' AS hs", "'s' AS kind", "0 AS bucket")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, odd, SF001).columns == odd.columns, name
    assert corpus_pipeline.encode(spark, odd, SF001).count() == len(rows)
    left = corpus_pipeline.identify_language(spark, docs, SF001).collect()
    assert sorted((r.doc_id or 0) for r in left) == [0, 1, 1, 4]
    one = corpus_pipeline.remove_near_duplicates(spark, docs, SF001).collect()
    assert sorted((r.doc_id or 0) for r in one) == [0, 1, 2, 3, 4]
    masked = {r.doc_id: r for r in corpus_pipeline.redact_secrets(spark, docs, SF001).collect()}
    assert masked[4].text == "the dog and the house [SECRET] are here" and masked[4].n_chars == len(masked[4].text)
