"""Token store and SentencePiece: equality with the libraries."""

import hashlib
import random
import zlib

import duckdb
import numpy as np
import pytest
from conftest import SF001

from waymark.llm import catalog, sentencepiece_bpe, token_store
from waymark.session import scratch_path

public_tokenizers = pytest.importorskip("public_tokenizers")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
ODD = [None, "", " ", "\n", "a▁ b", "  x   y ", "▁▁ hello", "日本語 テキスト😀 \x00", "the the thethethe" * 50, "abab" * 300,
       "<s> </s> <0x41>", "\t\ttab", "é" * 100, "a" * 5000, " " * 999, "x ▁ ▁y", "ﬁ ½  z", "<|endoftext|> a<|endoftext|>b",
       "a\nb\n c ’ d e", "x,y. z's 'll it’s, don't.'", "1a2b, 3.5%　f   g\u0085h"]


def _odd_texts():
    random.seed(5)
    letters = "ab1.'s, \n\t é☃’▁ thern"
    return ODD + ["".join(random.choice(letters) for _ in range(random.randint(0, 60))) for _ in range(700)]


@pytest.fixture(scope="module")
def documents():
    return duckdb.sql(f"SELECT doc_id, text FROM '{SF001}/documents.parquet' ORDER BY doc_id").fetchall()


def test_codes_round_trip_and_random_access():
    rng = np.random.default_rng(1)
    for ids in (np.zeros(0), rng.integers(0, 256, 700), rng.integers(0, 2**32, 3000) >> rng.integers(0, 32, 3000)):
        ids = ids.astype(np.uint32)
        reader = token_store.DacReader(token_store.dac_encode(ids))
        assert np.array_equal(reader.all(), ids)
        at = rng.permutation(len(ids))
        assert np.array_equal(reader.at(at), ids[at])
    with pytest.raises(IndexError):
        reader.at(np.array([3000]))


def test_store_equals_the_library(spark):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(BYTE_BPE)
    rows = [(k, t) for k, t in enumerate(_odd_texts())] + [(5, "again"), (5, "again"), (None, "no id")]
    random.shuffle(rows)
    df = spark.createDataFrame([(i, t, 7, "x") for i, t in rows], "doc_id bigint, text string, start bigint, codes string")
    path = token_store.write_token_store(df, scratch_path(spark, "store"), BYTE_BPE, num_partitions=4)
    got = sorted(((r.start, r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in token_store.read_documents(spark, path).collect()))
    flat = []
    for (start, doc, ids), (want_doc, text) in zip(got, sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")),
                                                   strict=True):
        want = library.encode(text or "", add_special_tokens=False).ids + [2]
        assert (start, doc, ids) == (len(flat), want_doc, want), text
        flat += want
    asked = [random.randrange(len(flat)) for _ in range(200)] + [0, 0, len(flat) - 1, len(flat), -1, None] + [7] * 500
    found = token_store.tokens_at(spark.createDataFrame([(p,) for p in asked], "position bigint"), path).collect()
    assert len(found) == 703 and sum(r.position == 7 for r in found) >= 500 and all(flat[r.position] == r.id for r in found)


def test_empty_store(spark):
    path = token_store.write_token_store(spark.createDataFrame([], "doc_id bigint, text string"),
                                         scratch_path(spark, "store"), BYTE_BPE)
    assert token_store.read_documents(spark, path).count() == 0


def test_op2_on_the_documents(spark, documents):
    from tokenizers import Tokenizer
    library, start = Tokenizer.from_file(BYTE_BPE), 0
    got = {r.doc_id: r for r in catalog.QUERIES["op2_token_store"](spark, SF001).collect()}
    assert len(got) == len(documents)
    for doc, text in documents:
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        assert (got[doc].start, got[doc].n_tokens, got[doc].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_sentencepiece_equals_the_library(spark):
    import sentencepiece
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = _odd_texts()
    df = spark.createDataFrame([(k, t, "c") for k, t in enumerate(texts)] + [(None, "null", "c")],
                               "doc_id bigint, text string, ids string")
    encoded = sentencepiece_bpe.encode_documents(df, PIECES)
    got = {r.doc_id: r for r in sentencepiece_bpe.decode_documents(encoded, PIECES).collect()}
    assert len(got) == len(texts) + 1
    for k, text in enumerate(texts):
        want = library.encode(text or "") + [2]
        assert list(got[k].ids) == want, text
        assert got[k].text == library.decode(want)
    both = lambda rows: sorted(((r.doc_id or -1, list(r.ids), r.text) for r in rows))
    assert both(sentencepiece_bpe.round_trip(df, PIECES).collect()) == both(got.values())


def test_op8_on_the_documents(spark, documents):
    import sentencepiece
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = {r.doc_id: r for r in catalog.QUERIES["op8_sentencepiece"](spark, SF001).collect()}
    for doc, text in documents:
        ids = library.encode(text or "") + [2]
        assert got[doc].n_tokens == len(ids)
        assert got[doc].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[doc].decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_sentencepiece_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert sentencepiece_bpe.encode_documents(empty, PIECES).count() == 0
    assert sentencepiece_bpe.round_trip(empty, PIECES).count() == 0
