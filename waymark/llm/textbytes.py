"""Numpy helpers on the UTF-8 bytes of an Arrow string column.

A batch of texts is one byte array with document offsets. Words, lines and
n-grams are ranges in it; a range is identified by a 64-bit polynomial hash
taken from prefix sums, so hashing all ranges of a batch costs a few passes
over its bytes and no Python loop over words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _inverse(a: int) -> int:
    x = a
    for _ in range(6):
        x = x * (2 - a * x) % (1 << 64)
    return x


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection that spreads every input bit."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


_BYTE_VALUE = mix64(np.arange(1, 257, dtype=np.uint64) * _BASE)


def batch_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, offsets)`` of a string array; nulls are empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def small_batches(batches: Iterator[pa.RecordBatch], text: str, limit: int = 1 << 19) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds about ``limit`` bytes of text, or
    one longer text. Bounds the memory of the passes over a batch."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        _, offsets = batch_bytes(batch.column(text))
        begin = 0
        while begin < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[begin] + limit, side="right")) - 1
            end = min(max(end, begin + 1), batch.num_rows)
            yield batch.slice(begin, end - begin)
            begin = end


def is_space(data: np.ndarray) -> np.ndarray:
    """ASCII white space: space and 0x09 to 0x0D."""
    return (data == 32) | ((data >= 9) & (data <= 13))


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return data + ((data >= 65) & (data <= 90)).astype(np.uint8) * np.uint8(32)


def ranges(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every maximal run of true bytes that stays inside one
    document."""
    n = len(inside)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    doc_begin = np.zeros(n + 1, bool)
    doc_begin[offsets[offsets < n]] = True
    prev = np.empty(n, bool)
    prev[0] = False
    prev[1:] = inside[:-1]
    start = inside & (~prev | doc_begin[:n])
    nxt = np.empty(n, bool)
    nxt[-1] = False
    nxt[:-1] = inside[1:]
    end = inside & (~nxt | doc_begin[1:])
    return np.flatnonzero(start), np.flatnonzero(end) + 1


def document_of(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Index of the document that holds each start."""
    return np.searchsorted(offsets, starts, side="right") - 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, salt: int = 0) -> np.ndarray:
    """64-bit hash of ``data[start:end]`` for every span."""
    n = len(data)
    base = int(_BASE) if not salt else (int(_M1) ^ (salt << 1)) | 1
    powers = np.empty(n + 1, np.uint64)
    powers[0] = 1
    powers[1:] = np.uint64(base)
    np.cumprod(powers, out=powers)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_BYTE_VALUE[data] * powers[:n], out=sums[1:])
    value = sums[ends] - sums[starts]
    # Divide by base ** start: align every span to exponent 0.
    powers[1:] = np.uint64(_inverse(base))
    powers[0] = 1
    np.cumprod(powers, out=powers)
    value *= powers[starts]
    return mix64(value + (ends - starts).astype(np.uint64) * _M2)


def distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(first, inverse)``: the index of one occurrence of every distinct
    hash, and for every element the number of its distinct value."""
    import pandas as pd
    codes, _ = pd.factorize(hashes)
    first = np.empty(int(codes.max()) + 1 if len(codes) else 0, np.int64)
    first[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
    return first, codes


def gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenate ``values[start:start + length]`` of every span."""
    total = int(lengths.sum())
    if total == 0:
        return values[:0]
    begin = np.cumsum(lengths) - lengths
    return values[np.repeat(starts - begin, lengths) + np.arange(total)]


def sums_by_document(values: np.ndarray, docs: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(docs, weights=values, minlength=n)


def distinct_tiles(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct pieces of ``data`` cut at ``starts`` (the pieces cover it):
    ``(ends, hashes, first, inverse)``. Pieces of equal hash are compared byte by
    byte; should two differ, every piece counts as distinct."""
    ends = np.append(starts[1:], len(data))
    hashes = span_hashes(data, starts, ends)
    first, inverse = distinct(hashes)
    lengths = ends - starts
    shift = starts[first][inverse] - starts
    same = np.array_equal(lengths[first][inverse], lengths) and np.array_equal(
        data[np.arange(len(data)) + np.repeat(shift, lengths)], data)
    if not same:
        first = inverse = np.arange(len(starts))
    return ends, hashes, first, inverse


class PieceCache:
    """Ids of pieces seen so far. ``encode`` turns a list of new pieces into
    flat ids and counts. Pieces are found by their hash and compared byte by
    byte. Emptied at ``limit`` pieces (about 100 bytes each), so a task of any
    length keeps bounded memory."""

    def __init__(self, encode, limit: int = 400_000):
        self.encode, self.limit = encode, limit
        self._clear()

    def _clear(self):
        self.keys = np.zeros(0, np.uint64)
        self.bytes = np.zeros(0, np.uint8)
        self.ids = np.zeros(0, np.int32)
        # Begin and length of a piece's bytes and of its ids.
        self.places = np.zeros((4, 0), np.int64)

    def _add(self, raw: bytes, starts: np.ndarray, ends: np.ndarray, keys: np.ndarray) -> None:
        pieces = [raw[s:e] for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
        ids, counts = self.encode(pieces)
        sizes = ends - starts
        new = np.stack([len(self.bytes) + np.cumsum(sizes) - sizes, sizes,
                        len(self.ids) + np.cumsum(counts) - counts, counts])
        self.keys = np.append(self.keys, keys)
        self.bytes = np.append(self.bytes, np.frombuffer(b"".join(pieces), np.uint8))
        self.ids = np.append(self.ids, ids.astype(np.int32))
        self.places = np.append(self.places, new, 1)

    def tokens(self, data: np.ndarray, cuts: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all documents, and ids per document, from the true
        positions of ``cuts`` (every document begin must be one)."""
        import pandas as pd
        n_docs = len(offsets) - 1
        if len(data) == 0:
            return np.zeros(0, np.int32), np.zeros(n_docs, np.int64)
        starts = np.flatnonzero(cuts)
        ends, keys, first, inverse = distinct_tiles(data, starts)
        if len(self.keys) + len(first) > self.limit:
            self._clear()
        begin, end, keys = starts[first], ends[first], keys[first]
        table = pd.Index(self.keys)
        known = table.get_indexer(keys) if table.is_unique else np.full(len(keys), -1)
        old = np.flatnonzero(known >= 0)
        if len(old):
            # Another piece may have the same hash.
            at, size = self.places[0][known[old]], self.places[1][known[old]]
            equal = size == (end - begin)[old]
            if equal.all():
                differ = gather(self.bytes, at, size) != gather(data, begin[old], size)
                equal = ~np.logical_or.reduceat(differ, np.cumsum(size) - size)
            known[old[~equal]] = -1
        fresh = np.flatnonzero(known < 0)
        if len(fresh):
            known[fresh] = len(self.keys) + np.arange(len(fresh))
            self._add(data.tobytes(), begin[fresh], end[fresh], keys[fresh])
        at, counts = self.places[2][known][inverse], self.places[3][known][inverse]
        per_doc = np.bincount(document_of(starts, offsets), weights=counts, minlength=n_docs).astype(np.int64)
        return gather(self.ids, at, counts), per_doc


def document_begins(n: int, offsets: np.ndarray) -> np.ndarray:
    begins = np.zeros(n, bool)
    begins[offsets[offsets < n]] = True
    return begins
