"""Token ids in directly addressable codes.

A store is a folder with two Parquet tables written by Spark:

* ``segments``: ``part, seq, local_start, n_tokens, doc_ids, doc_counts,
  codes`` -- a run of whole documents in ascending id order (about ``SEGMENT``
  ids, or one longer document) and its codes;
* ``parts``: ``part, base, n_tokens`` -- where each part begins in the corpus,
  so ``base + local_start`` is a segment's first token number.

``codes`` is one byte string, little endian: ``DAC1``, u32 ids, u32 levels,
then per level u32 chunks, the chunks (one byte each), and, but for the last
level, the continuation bitmap and its rank directory (u32 ones before each
block of 512 bits). Chunk ``i`` of level 0 is the low byte of id ``i``; a set
bit says that the id goes on in the next level, at the place given by the
rank of that bit. Any id is read in as many steps as it has bytes.
"""

from __future__ import annotations

import json
import os
import struct
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from waymark.llm.textbytes import PieceCache, batch_bytes, document_begins, gather, small_batches
from waymark.session import scratch_path
from waymark.sources.tables import table

SEGMENT = 1 << 19
BLOCK = 512
MAGIC = b"DAC1"


def dac_encode(ids: np.ndarray) -> bytes:
    """Codes of unsigned 32-bit ids."""
    rest, levels = ids.astype(np.uint32), []
    while True:
        more = rest > 0xFF
        levels.append(((rest & 0xFF).astype(np.uint8), more))
        if not more.any():
            break
        rest = rest[more] >> np.uint32(8)
    out = [MAGIC, struct.pack("<II", len(ids), len(levels))]
    for k, (chunks, more) in enumerate(levels):
        out += [struct.pack("<I", len(chunks)), chunks.tobytes()]
        if k + 1 < len(levels):
            out.append(np.packbits(more, bitorder="little").tobytes())
            ones = np.add.reduceat(more, np.arange(0, len(more), BLOCK), dtype=np.uint32)
            out.append((np.cumsum(ones, dtype=np.uint32) - ones).astype("<u4").tobytes())
    return b"".join(out)


class DacReader:
    """Reads ids of one byte string of codes."""

    def __init__(self, codes: bytes):
        if codes[:4] != MAGIC:
            raise ValueError("not a DAC1 byte string")
        self.n, n_levels = struct.unpack_from("<II", codes, 4)
        at, self.levels = 12, []
        for k in range(n_levels):
            n, = struct.unpack_from("<I", codes, at)
            chunks = np.frombuffer(codes, np.uint8, n, at + 4)
            at += 4 + n
            bits = ranks = None
            if k + 1 < n_levels:
                bits = np.frombuffer(codes, np.uint8, -(-n // 8), at)
                at += len(bits)
                ranks = np.frombuffer(codes, "<u4", -(-n // BLOCK), at)
                at += 4 * len(ranks)
            self.levels.append((chunks, bits, ranks))

    def at(self, positions: np.ndarray) -> np.ndarray:
        """The ids at any positions, without decoding others."""
        place = np.asarray(positions, np.int64)
        if len(place) and (place.min() < 0 or place.max() >= self.n):
            raise IndexError("position outside the codes")
        out = np.zeros(len(place), np.uint32)
        live = np.arange(len(place))
        for k, (chunks, bits, ranks) in enumerate(self.levels):
            out[live] |= chunks[place].astype(np.uint32) << np.uint32(8 * k)
            if bits is None or not len(live):
                break
            on = (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
            live, place = live[on], place[on]
            # Rank: ones before the block, whole bytes of the block, bits of the byte.
            block, byte = place // BLOCK, place >> 3
            inside = byte[:, None] - np.arange(1, BLOCK // 8 + 1)
            seen = np.where(inside >= (block * (BLOCK // 8))[:, None], bits[np.maximum(inside, 0)], 0)
            last = bits[byte] & ((1 << (place & 7)) - 1).astype(np.uint8)
            place = ranks[block] + np.bitwise_count(seen).sum(1, dtype=np.int64) + np.bitwise_count(last)
        return out

    def all(self) -> np.ndarray:
        """Every id, level by level."""
        values = None
        for chunks, bits, _ in reversed(self.levels):
            level = chunks.astype(np.uint32)
            if bits is not None:
                on = np.unpackbits(bits, count=len(chunks), bitorder="little").view(bool)
                level[on] |= values << np.uint32(8)
            values = level
        return values


def _safe_cuts(data: np.ndarray, offsets: np.ndarray, uncut: bytes) -> np.ndarray:
    """Places where a byte-level pre-tokeniser always ends a piece: a single
    space or line break between two characters that are not white space (the
    space opens its piece, the line break is one), and a punctuation mark
    after a letter, unless it is one of ``uncut``. Characters that may be
    Unicode white space by their first bytes are left alone."""
    cuts = document_begins(len(data), offsets)
    n = len(data)
    if n < 3:
        return cuts
    plain_next = (data > 32) & (data != 127) & (data != 0xC2) & ~((data >= 0xE1) & (data <= 0xE3))
    high = data >= 0x80
    plain_prev = (data > 32) & (data != 127)
    plain_prev[1:] &= ~(high[1:] & (data[:-1] == 0xC2))
    plain_prev[2:] &= ~(high[2:] & (data[:-2] >= 0xE1) & (data[:-2] <= 0xE3))
    lone = np.zeros(n, bool)
    lone[1:-1] = plain_prev[:-2] & plain_next[2:]
    # A neighbour in another document is none.
    begins = np.flatnonzero(cuts)
    lone[begins] = False
    lone[begins[begins > 0] - 1] = False
    cuts |= lone & (data == 32)
    line = np.flatnonzero(lone & (data == 10))
    cuts[line] = True
    cuts[line + 1] = True
    # Letters and punctuation are separate pieces; an apostrophe may belong to
    # a contraction. Only letters known by their bytes count (ASCII, and the
    # accented ones of Latin-1).
    letter = ((data | 32) >= 97) & ((data | 32) <= 122) & (data < 128)
    letter[1:] |= (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
    mark = (data > 32) & (data < 127) & ~letter & (data != 39) & ~((data >= 48) & (data <= 57))
    mark &= ~np.isin(data, np.frombuffer(uncut, np.uint8))
    cuts[1:] |= letter[:-1] & mark[1:]
    return cuts


def _cuttable(spec: dict) -> bool:
    """Whether the white space cuts hold for this tokenizer file."""
    pre = spec.get("pre_tokenizer") or {}
    return (pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
            and spec.get("normalizer") is None
            and not any(set(t["content"]) & set(" \n") or t.get("lstrip") or t.get("rstrip")
                        for t in spec.get("added_tokens", ())))


def _inner_marks(spec: dict) -> bytes:
    """ASCII marks that follow another character inside an added token."""
    inner = "".join(t["content"][1:] for t in spec.get("added_tokens", ()))
    return "".join(sorted({c for c in inner if c.isascii() and not c.isalnum()})).encode()


def _piece_encoder(text: str, cuttable: bool, together: int = 50):
    """Encoder of lists of distinct pieces. Pieces without inner white space
    are encoded ``together``, one per line, and taken apart at the line break's
    id: the library's cost per call is that of several words."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_str(text)
    line = tokenizer.encode("\n", add_special_tokens=False).ids

    def each(texts: list[bytes]) -> list[list[int]]:
        return [e.ids for e in tokenizer.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)]

    def flat(lists: list[list[int]]) -> np.ndarray:
        return np.fromiter(chain.from_iterable(lists), np.int64)

    def encode(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.array([len(p) for p in pieces], np.int64)
        data = np.frombuffer(b"".join(pieces), np.uint8)
        begins = np.cumsum(sizes) - sizes
        # Bytes that are, or may begin, white space.
        blank = (data <= 32) | (data == 127) | (data == 0xC2) | ((data >= 0xE1) & (data <= 0xE3))
        inner = np.add.reduceat(blank, begins, dtype=np.int64) - (data[begins] == 32)
        alone = np.flatnonzero((inner > 0) | (sizes < 2)) if cuttable and len(line) == 1 else np.arange(len(pieces))
        grouped = np.setdiff1d(np.arange(len(pieces)), alone, assume_unique=True)
        plain = [pieces[k] for k in grouped.tolist()]
        lines = flat([ids + line for ids in each([b"\n".join(plain[k:k + together])
                                                  for k in range(0, len(plain), together)])])
        breaks = np.flatnonzero(lines == line[0]) if len(lines) else np.zeros(0, np.int64)
        odd = each([pieces[k] for k in alone.tolist()])
        counts = np.zeros(len(pieces), np.int64)
        counts[grouped] = np.diff(breaks, prepend=-1) - 1
        counts[alone] = [len(x) for x in odd]
        ids = np.concatenate([lines, flat(odd)])
        starts = np.zeros(len(pieces), np.int64)
        starts[grouped] = breaks - counts[grouped]
        starts[alone] = len(lines) + np.cumsum(counts[alone]) - counts[alone]
        return gather(ids, starts, counts), counts
    return encode


def parts_for(df: DataFrame, target: int = 8 << 20) -> int:
    """Partitions of about ``target`` bytes by the plan's size estimate (for a
    file scan, compressed bytes), at least two per core."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return max(2 * df.sparkSession.sparkContext.defaultParallelism, min(-(-size // target), 100_000))


def write_token_store(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 2, id_col: str = "doc_id",
                      text_col: str = "text", num_partitions: int | None = None) -> str:
    """Encode every whole text, append ``end_id`` and write the store.

    Documents are dealt out by ranges of their id, so each task writes one run
    of the corpus. A null or empty text is the end id alone; rows with a null
    id come first; rows of one id are ordered by text and all kept; no rows
    give an empty store; other columns are dropped. Texts are encoded as
    distinct pieces between safe cuts, which gives the ids of the whole
    text (see ``_safe_cuts``).
    """
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = f.read()
    shared, cuttable = spark.sparkContext.broadcast(spec), _cuttable(json.loads(spec))
    uncut = _inner_marks(json.loads(spec))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ranged = (rows.repartitionByRange(num_partitions or parts_for(rows), "doc_id")
                  .sortWithinPartitions("doc_id", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, begun = TaskContext.get().partitionId(), 0, 0
        cache = PieceCache(_piece_encoder(shared.value, cuttable))
        names, counts, ids, size = [], [], [], 0

        def segment():
            flat, each = np.concatenate(ids), np.concatenate(counts)
            doc_ids = pa.concat_arrays(names)
            one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
            return pa.record_batch([pa.array([part], pa.int32()), pa.array([seq], pa.int32()),
                                    pa.array([begun], pa.int64()), pa.array([len(flat)], pa.int64()),
                                    one(doc_ids), one(pa.array(each)), pa.array([dac_encode(flat)], pa.binary())],
                                   ["part", "seq", "local_start", "n_tokens", "doc_ids", "doc_counts", "codes"])

        for batch in small_batches(batches, "text", 2 << 20):
            data, offsets = batch_bytes(batch.column("text"))
            cuts = _safe_cuts(data, offsets, uncut) if cuttable else document_begins(len(data), offsets)
            got, each = cache.tokens(data, cuts, offsets)
            names.append(batch.column("doc_id"))
            counts.append(each + 1)
            ids.append(np.insert(got, np.cumsum(each), end_id))
            size += len(ids[-1])
            if size >= SEGMENT:
                yield segment()
                seq, begun = seq + 1, begun + size
                names, counts, ids, size = [], [], [], 0
        if names:
            yield segment()

    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = (f"part int, seq int, local_start bigint, n_tokens bigint, doc_ids array<{kind}>, "
              "doc_counts array<bigint>, codes binary")
    # The codes are dense already.
    ranged.mapInArrow(run, schema).write.option("compression", "none").parquet(f"{path}/segments")
    segments = spark.read.parquet(f"{path}/segments")
    totals = segments.groupBy("part").agg(F.sum("n_tokens").alias("n_tokens"))
    # One row per part meets in one task: as many rows as the write had tasks.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    (totals.select("part", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"), "n_tokens")
           .write.parquet(f"{path}/parts"))
    return path


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """Segments with ``start``, the number of their first token."""
    parts = spark.read.parquet(f"{path}/parts").select("part", "base")
    return (spark.read.parquet(f"{path}/segments").join(parts, "part")
                 .withColumn("start", F.col("base") + F.col("local_start")))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, ids`` of every document of a store; ``ids`` is a binary
    of little-endian unsigned 32-bit integers."""
    segments = read_segments(spark, path).select("start", "doc_ids", "doc_counts", "codes")

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                counts = batch.column("doc_counts")[row].values.to_numpy()
                ends = np.cumsum(counts)
                ids = DacReader(batch.column("codes")[row].as_py()).all().astype("<u4")
                first = batch.column("start")[row].as_py()
                offsets = (4 * np.append(0, ends)).astype(np.int32)
                yield pa.record_batch([
                    batch.column("doc_ids")[row].values, pa.array(first + ends - counts),
                    pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(offsets), pa.py_buffer(ids)])],
                    ["doc_id", "start", "ids"])

    kind = segments.schema["doc_ids"].dataType.elementType.simpleString()
    return segments.mapInArrow(run, f"doc_id {kind}, start bigint, ids binary")


def tokens_at(positions: DataFrame, path: str, position_col: str = "position") -> DataFrame:
    """``position, id`` for token numbers of the corpus, read by random access.

    Positions meet their segment by an equi-join on cells of ``SEGMENT``
    tokens. Null positions and positions outside the corpus give no row;
    repeated positions give one row each.
    """
    spark = positions.sparkSession
    segments = read_segments(spark, path).select("start", "n_tokens", "codes")
    cell = lambda c: F.floor(c / SEGMENT)
    end = F.col("start") + F.col("n_tokens") - 1
    celled = segments.select("start", "n_tokens", F.explode(F.sequence(cell(F.col("start")), cell(end))).alias("cell"))
    # A position is looked up once, however often it is asked for.
    wanted = (positions.groupBy(F.col(position_col).cast("bigint").alias("position")).agg(F.count(F.lit(1)).alias("times"))
                       .withColumn("cell", cell(F.col("position"))))
    placed = wanted.join(celled, "cell").where(
        (F.col("position") >= F.col("start")) & (F.col("position") < F.col("start") + F.col("n_tokens")))
    # A segment's distinct positions in 64 parts, so a hot segment is read by many tasks.
    grouped = placed.groupBy("start", F.pmod(F.xxhash64("position"), F.lit(64)).alias("salt")).agg(
        F.collect_list("position").alias("positions"), F.collect_list("times").alias("times"))
    rows = grouped.join(segments.select("start", "codes"), "start").select("start", "positions", "times", "codes")

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                found = batch.column("positions")[row].values.to_numpy()
                reader = DacReader(batch.column("codes")[row].as_py())
                got = reader.at(found - batch.column("start")[row].as_py())
                yield pa.record_batch([pa.array(found), pa.array(got.astype(np.int64)), batch.column("times")[row].values],
                                      ["position", "id", "times"])

    found = rows.mapInArrow(run, "position bigint, id bigint, times bigint")
    return found.select("position", "id", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("times"))).alias("_")).drop("_")


def op2_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place, length and checksum, from the written store."""
    import public_tokenizers
    docs = table(spark, sf_dir, "documents", ["doc_id", "text"])
    path = write_token_store(docs, scratch_path(spark, "token-store"), public_tokenizers.path("byte_bpe_50k.json"))
    return read_documents(spark, path).select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
