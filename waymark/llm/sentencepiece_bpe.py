"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

The model file gives the vocabulary; the merges run in numpy. All words of a
batch lie in one flat symbol array. Every round finds, per word, the best rank
of a neighbouring pair (a segmented minimum), merges the leftmost
non-overlapping pairs of that rank in all words at once, and compacts the
array; words without a mergeable pair leave it. Only distinct words are
merged, and a task remembers the words it has seen.

Equality with the library's one-merge-at-a-time order:

* symbols never merge across a cut, because no piece holds the white space
  mark after another character, or a line break (checked on the vocabulary);
* a round may merge all pairs of a rank only if no pair made by these merges
  ranks as good or better. Ranks for which the vocabulary has such a pair are
  marked, and of these only the leftmost pair of a word is merged per round.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.llm.columns import bound_batches
from waymark.llm.textbytes import (PieceCache, batch_bytes, document_begins, gather,
                                   small_batches)
from waymark.sources.tables import table

MARK = "▁"
NONE = np.int32(2**31 - 1)
CODE_POINTS = 0x110000


class BpeModel:
    """Vocabulary arrays of a SentencePiece BPE model; size in the order of
    the vocabulary, so it is broadcast."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb
        proto = pb.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        norm, train = proto.normalizer_spec, proto.trainer_spec
        if (train.model_type != 2 or norm.name != "identity" or norm.remove_extra_whitespaces
                or not norm.escape_whitespaces or not train.byte_fallback or train.treat_whitespace_as_suffix):
            raise ValueError(f"{path}: needs a BPE model with byte fallback and identity normalisation")
        kinds = {1: "normal", 2: "unknown", 3: "control", 6: "byte"}
        if unsupported := {p.type for p in proto.pieces} - set(kinds):
            raise ValueError(f"{path}: unsupported piece types {sorted(unsupported)}")
        self.size = len(proto.pieces)
        self.prefix = norm.add_dummy_prefix
        self.end_id = next(i for i, p in enumerate(proto.pieces) if p.type == 3 and p.piece == "</s>")
        normal = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == 1}
        score = [p.score for p in proto.pieces]
        self.cuttable = not any(MARK in p.lstrip(MARK) or "\n" in p for p in normal)

        self.byte_ids = np.zeros(256, np.int32)
        surface = []
        for i, p in enumerate(proto.pieces):
            kind = kinds[p.type]
            if kind == "byte":
                value = int(p.piece[3:5], 16)
                self.byte_ids[value] = i
                surface.append(bytes([value]))
            else:
                surface.append({"normal": p.piece.replace(MARK, " "), "control": "",
                                "unknown": train.unk_surface}[kind].encode())
        self.surface = np.frombuffer(b"".join(surface), np.uint8)
        self.surface_length = np.array([len(s) for s in surface], np.int64)
        self.surface_start = np.cumsum(self.surface_length) - self.surface_length
        self.marked = np.array([p.type == 1 and p.piece.startswith(MARK) for p in proto.pieces])

        singles = [(ord(p), i) for p, i in normal.items() if len(p) == 1]
        self.char_code, self.char_id = (np.array(x, np.int64) for x in zip(*singles, strict=True))

        # Dense ranks by falling score; equal scores share a rank.
        order = sorted({score[i] for p, i in normal.items() if len(p) > 1}, reverse=True)
        rank_of = {s: r for r, s in enumerate(order)}
        symbol = lambda s: normal.get(s, self.size + ord(s) if len(s) == 1 else None)
        keys, merged, ranks, eager = [], [], [], np.zeros(len(order) + 1, bool)
        for p, i in normal.items():
            for k in range(1, len(p)):
                x, y = symbol(p[:k]), symbol(p[k:])
                if x is None or y is None:
                    continue
                rank = rank_of[score[i]]
                keys.append(x * (self.size + CODE_POINTS) + y)
                merged.append(i)
                ranks.append(rank)
                for side in (p[:k], p[k:]):
                    if len(side) > 1 and rank <= rank_of[score[normal[side]]]:
                        eager[rank_of[score[normal[side]]]] = True
        place = np.argsort(np.array(keys, np.int64), kind="stable")
        self.pair_key = np.array(keys, np.int64)[place]
        self.pair_piece = np.array(merged, np.int64)[place]
        self.pair_rank = np.array(ranks, np.int32)[place]
        self.eager = eager

    def symbols(self, codes: np.ndarray) -> np.ndarray:
        """Piece id of every character; unknown characters get their code
        point beyond the vocabulary."""
        if not hasattr(self, "_char_table"):
            self._char_table = np.arange(CODE_POINTS, dtype=np.int64) + self.size
            self._char_table[self.char_code] = self.char_id
        return self._char_table[codes]

    def pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged piece of each symbol pair (``NONE`` if unmergeable)."""
        query = left * (self.size + CODE_POINTS) + right
        at = np.minimum(np.searchsorted(self.pair_key, query), len(self.pair_key) - 1)
        found = self.pair_key[at] == query
        return np.where(found, self.pair_rank[at], NONE), self.pair_piece[at]

    def merge_words(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols after all merges, and symbols per word. Words are not empty."""
        word = np.repeat(np.arange(len(lengths)), lengths)
        rank = np.full(len(symbols), NONE, np.int32)
        piece = np.zeros(len(symbols), np.int64)
        inner = np.flatnonzero(word[:-1] == word[1:])
        rank[inner], piece[inner] = self.pairs(symbols[inner], symbols[inner + 1])
        done_symbols, done_words = [], []
        while len(symbols):
            starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            sizes = np.diff(np.append(starts, len(word)))
            best = np.minimum.reduceat(rank, starts)
            live = np.repeat(best != NONE, sizes)
            if not live.all():
                done_symbols.append(symbols[~live])
                done_words.append(word[~live])
                symbols, word, rank, piece = symbols[live], word[live], rank[live], piece[live]
                sizes, best = sizes[best != NONE], best[best != NONE]
                if not len(symbols):
                    break
            wanted = np.repeat(best, sizes)
            hits = np.flatnonzero(rank == wanted)
            # Overlapping pairs of a run: every second one, from the left.
            begin = np.append(True, hits[1:] != hits[:-1] + 1)
            k = np.arange(len(hits))
            take = (k - np.maximum.accumulate(np.where(begin, k, 0))) % 2 == 0
            leftmost = np.append(True, word[hits[1:]] != word[hits[:-1]])
            hits = hits[np.where(self.eager[wanted[hits]], leftmost, take)]
            symbols[hits] = piece[hits]
            keep = np.ones(len(symbols), bool)
            keep[hits + 1] = False
            at = (np.cumsum(keep) - 1)[hits]
            symbols, word, rank, piece = symbols[keep], word[keep], rank[keep], piece[keep]
            changed = np.unique(np.concatenate([at, at[at > 0] - 1]))
            rank[changed] = NONE
            changed = changed[changed + 1 < len(word)]
            changed = changed[word[changed] == word[changed + 1]]
            rank[changed], piece[changed] = self.pairs(symbols[changed], symbols[changed + 1])
        if not done_symbols:
            return symbols, np.zeros(len(lengths), np.int64)
        symbols, word = np.concatenate(done_symbols), np.concatenate(done_words)
        order = np.argsort(word, kind="stable")
        return symbols[order], np.bincount(word, minlength=len(lengths))

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and ids per word of distinct non-empty UTF-8 words."""
        raw = b"".join(words)
        sizes = np.array([len(w) for w in words])
        codes = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), np.uint32)
        lead = (np.frombuffer(raw, np.uint8) & 0xC0) != 0x80
        lengths = np.add.reduceat(lead, np.cumsum(sizes) - sizes, dtype=np.int64)
        symbols = self.symbols(np.where(codes == 32, ord(MARK), codes))
        ids, counts = self.merge_words(symbols, lengths)
        unknown = ids >= self.size
        if unknown.any():
            # Byte fallback: a character without a piece becomes its bytes.
            word = np.repeat(np.arange(len(words)), counts)
            chars, which = np.unique(ids[unknown] - self.size, return_inverse=True)
            spelled = [np.frombuffer(chr(c).encode(), np.uint8) for c in chars]
            width = np.ones(len(ids), np.int64)
            width[unknown] = np.array([len(s) for s in spelled])[which]
            out = np.repeat(ids, width)
            out[np.repeat(unknown, width)] = self.byte_ids[np.concatenate([spelled[c] for c in which])]
            ids, counts = out, np.bincount(np.repeat(word, width), minlength=len(words))
        return ids, counts

    def prepared(self, texts: pa.Array) -> pa.Array:
        """Texts as the merges see them: with the leading space that the model
        adds to every text that is not empty."""
        texts = texts.fill_null("")
        if not self.prefix:
            return texts
        return pc.if_else(pc.equal(pc.binary_length(texts), 0), texts, pc.binary_join_element_wise(" ", texts, ""))

    def cuts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Positions where no merge can cross: before a space that follows a
        character which is not white space mark, and around line breaks."""
        cuts = document_begins(len(data), offsets)
        if self.cuttable and len(data) > 1:
            prev, here = data[:-1], data[1:]
            # 0x81 may be the last byte of a literal white space mark.
            cuts[1:] |= ((here == 32) & (prev != 32) & (prev != 0x81)) | (here == 10) | (prev == 10)
        return cuts

    def decode(self, ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all documents, and bytes per document."""
        size = self.surface_length[ids]
        data = gather(self.surface, self.surface_start[ids], size)
        docs = np.repeat(np.arange(len(lengths)), lengths)
        sizes = np.bincount(docs, weights=size, minlength=len(lengths)).astype(np.int64)
        if self.prefix and len(ids):
            # The added space: the mark of a document's first visible piece.
            shown = np.flatnonzero(size > 0)
            first = shown[np.append(True, docs[shown][1:] != docs[shown][:-1])] if len(shown) else shown
            first = docs[first[self.marked[ids[first]]]]
            keep = np.ones(len(data), bool)
            keep[(np.cumsum(sizes) - sizes)[first]] = False
            data = data[keep]
            sizes[first] -= 1
        return data, sizes


def _list_array(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    offsets = np.append(0, np.cumsum(lengths)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32)))


def _texts(data: np.ndarray, lengths: np.ndarray) -> list[bytes]:
    """Valid UTF-8 per document; bytes that are not become U+FFFD."""
    raw, out, at = data.tobytes(), [], 0
    for n in lengths.tolist():
        piece = raw[at:at + n]
        out.append(piece.decode("utf-8", "replace").encode())
        at += n
    return out


def encode_documents(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                     ids_col: str = "ids") -> DataFrame:
    """``id_col, ids``: the ids of every whole text, with the end id.

    A null or empty text gives the end id alone. Ids are carried as they are
    (null or repeated too), other columns are dropped, no rows give no rows.
    A text of any length is one value; batches are cut to about half a MB of text,
    so only a longer text alone exceeds that.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    shared = spark.sparkContext.broadcast(BpeModel(model_path))
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        cache = PieceCache(model.encode_words)
        for batch in small_batches(batches, "_text"):
            data, offsets = batch_bytes(model.prepared(batch.column("_text")))
            ids, counts = cache.tokens(data, model.cuts(data, offsets), offsets)
            ids = np.insert(ids, np.cumsum(counts), model.end_id)
            yield pa.record_batch([batch.column("_id"), _list_array(ids, counts + 1)], ["_id", "_ids"])

    out = rows.mapInArrow(run, f"_id {rows.schema['_id'].dataType.simpleString()}, _ids array<int>")
    return out.select(F.col("_id").alias(id_col), F.col("_ids").alias(ids_col))


def _ids_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = column.cast(pa.list_(pa.int32()))
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    return column.flatten().to_numpy(zero_copy_only=False), lengths


def _slices(batches: Iterator[pa.RecordBatch], ids: str, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ends = np.cumsum(_ids_of(batch.column(ids))[1])
        begin = 0
        while begin < batch.num_rows:
            base = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(begin, end - begin)
            begin = end


def decode_documents(encoded: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids",
                     text_col: str = "text") -> DataFrame:
    """``id_col, ids_col, text``: the text of every id list. Null ids are an
    empty list and give the empty text."""
    shared = encoded.sparkSession.sparkContext.broadcast(BpeModel(model_path))
    rows = encoded.select(F.col(id_col).alias("_id"), F.col(ids_col).alias("_ids"))

    def run(batches):
        for batch in _slices(batches, "_ids"):
            texts = _texts(*shared.value.decode(*_ids_of(batch.column("_ids"))))
            yield pa.record_batch([batch.column("_id"), batch.column("_ids"),
                                   pa.array(texts, pa.binary()).cast(pa.string())], ["_id", "_ids", "_text"])

    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"_id {kind}, _ids array<int>, _text string").select(
        F.col("_id").alias(id_col), F.col("_ids").alias(ids_col), F.col("_text").alias(text_col))


def round_trip(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, ids, text``: the ids of every whole text with the end id, and
    the text that these ids decode to, as :func:`encode_documents` and
    :func:`decode_documents` give them. One Python worker does both, so a task
    holds one model and its ids do not cross to the JVM and back."""
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(BpeModel(model_path))
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        cache = PieceCache(model.encode_words)
        for batch in small_batches(batches, "_text"):
            data, offsets = batch_bytes(model.prepared(batch.column("_text")))
            ids, counts = cache.tokens(data, model.cuts(data, offsets), offsets)
            ids = np.insert(ids, np.cumsum(counts), model.end_id)
            texts = _texts(*model.decode(ids, counts + 1))
            yield pa.record_batch([batch.column("_id"), _list_array(ids, counts + 1),
                                   pa.array(texts, pa.binary()).cast(pa.string())], ["_id", "_ids", "_decoded"])

    out = rows.mapInArrow(run, f"_id {rows.schema['_id'].dataType.simpleString()}, _ids array<int>, _decoded string")
    return out.select(F.col("_id").alias(id_col), F.col("_ids").alias("ids"), F.col("_decoded").alias("text"))


def _decimal(ids: np.ndarray, lengths: np.ndarray, size: int) -> list[bytes]:
    """Decimal ids joined by one space, per document."""
    words = [b"%d " % i for i in range(size)]
    width = np.array([len(w) for w in words])
    table_ = np.frombuffer(b"".join(words), np.uint8)
    data = gather(table_, (np.cumsum(width) - width)[ids], width[ids]).tobytes()
    ends = np.append(0, np.cumsum(width[ids]))[np.append(0, np.cumsum(lengths))]
    return [data[s:max(s, e - 1)] for s, e in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    import public_tokenizers
    path = public_tokenizers.path("piece_bpe_32k.model")
    shared = spark.sparkContext.broadcast(BpeModel(path))
    encoded = encode_documents(table(spark, sf_dir, "documents", ["doc_id", "text"]), path)

    def digests(batches):
        model, sha = shared.value, lambda b: hashlib.sha256(b).hexdigest()
        for batch in _slices(batches, "ids"):
            ids, lengths = _ids_of(batch.column("ids"))
            yield pa.record_batch([
                batch.column("doc_id"), pa.array(lengths),
                pa.array([sha(b) for b in _decimal(ids, lengths, model.size)]),
                pa.array([sha(b) for b in _texts(*model.decode(ids, lengths))])],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return encoded.mapInArrow(digests, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
