"""Flat numpy views of the texts of an Arrow batch.

The Python tasks of this subpackage work on a few megabytes of text at a time:
the UTF-8 bytes of many documents in one flat array with offsets. Words, lines
and shingles become arrays of positions and of 64-bit hashes, so no Python loop
runs per word. Memory is bounded by `max_bytes` (or by one longer document).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes that separate words: [\x20\x09-\x0D].
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: Byte -> byte, A-Z lower-cased.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_U = np.uint64
_BYTE_CODE = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 2**64)
_tables = [np.ones(1, _U), np.ones(1, _U)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n (kept for the next call)."""
    if len(_tables[0]) < n:
        size = max(n, 1 << 16)
        for k, b in enumerate((_BASE, _BASE_INVERSE)):
            t = np.full(size, b, _U)
            t[0] = 1
            _tables[k] = np.cumprod(t, dtype=_U)
    return _tables[0], _tables[1]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(27)
    h *= _U(0x94D049BB133111EB)
    h ^= h >> _U(31)
    return h


def byte_codes(data: np.ndarray) -> np.ndarray:
    return _BYTE_CODE[data]


def prefix_sums(codes: np.ndarray) -> np.ndarray:
    """Sums from which `range_hashes` gives the hash of any range."""
    n = len(codes)
    power, _ = _powers(n + 1)
    sums = np.zeros(n + 1, _U)
    np.cumsum(codes * power[:n], out=sums[1:])
    return sums


def range_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the ranges [start, end): equal content, equal hash."""
    _, inverse = _powers(len(sums))
    h = (sums[ends] - sums[starts]) * inverse[starts]
    return mix(h + (ends - starts).astype(_U) * _U(0xD6E8FEB86659FD93))


def with_segment(h: np.ndarray, segment: np.ndarray) -> np.ndarray:
    """Hashes that differ between segments (documents of the batch)."""
    return mix(h + (segment.astype(_U) + _U(1)) * _U(0xA24BAED4963EE407))


def segment_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of the values in each [offsets[i], offsets[i + 1])."""
    c = np.zeros(len(values) + 1, np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=c[1:])
    return c[offsets[1:]] - c[offsets[:-1]]


def segments_of(bounds: np.ndarray) -> np.ndarray:
    """The segment of each element, given the elements' bounds by segment."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words `[^\\x20\\x09-\\x0D]+`, and their bounds by document."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    word = ~SPACE[data]
    begin, finish = word.copy(), word.copy()
    begin[1:] &= ~word[:-1]
    finish[:-1] &= ~word[1:]
    first = offsets[:-1][offsets[:-1] < len(data)]
    last = offsets[1:][offsets[1:] > 0] - 1
    begin[first], finish[last] = word[first], word[last]
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(finish) + 1, np.searchsorted(starts, offsets)


def shingles(word_hashes: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the `size`-word shingles and their bounds by document.

    A document with fewer words than `size` has its whole sequence as one
    shingle; one without words has none.
    """
    n = np.diff(bounds)
    count = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    new = np.zeros(len(bounds), np.int64)
    np.cumsum(count, out=new[1:])
    doc = segments_of(new)
    start = bounds[:-1][doc] + (np.arange(new[-1]) - new[:-1][doc])
    end = start + np.minimum(size, n)[doc]
    return range_hashes(prefix_sums(word_hashes), start, end), new


def text_batches(batches: Iterable[pa.RecordBatch], column: str = "text",
                 max_bytes: int = 1 << 21) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, bytes, offsets) of at most `max_bytes` of text, or of one row. Null: empty."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        col = pc.fill_null(batch.column(column), "")
        kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
        buffers = col.buffers()
        offsets = np.frombuffer(buffers[1], kind)[col.offset:col.offset + n + 1].astype(np.int64)
        data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
        i = 0
        while i < n:
            j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + max_bytes, "right")) - 1)
            j = min(j, n)
            yield batch.slice(i, j - i), data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
            i = j


def batch_of(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()],
                                      names=list(columns))


def list_array(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values))


def crc_remainder(ids: pa.Array, divisor: int) -> np.ndarray:
    """crc32 of the id as decimal text modulo `divisor`; of a null id, of the empty text."""
    import zlib

    return np.array([zlib.crc32(b"" if i is None else str(i).encode()) % divisor for i in ids.to_pylist()], np.int64)
