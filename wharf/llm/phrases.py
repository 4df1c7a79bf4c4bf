"""Operator 12: phrase collocation mining with an FM-index per shard.

Texts are cut into shards of a few megabytes. A shard's words become ids, and a
bidirectional FM-index over the ids (the Burrows-Wheeler transforms of the
sequence and of its reverse, suffixes sorted by as many words as a phrase may
have) enumerates phrases: intervals are extended to the right through the
reverse transform, the forward interval follows, and both transforms tell
whether all occurrences have the same word to the left or to the right. Counts
and extensions are summed by each task over its shards, shuffled as sorted and
compressed blocks of phrases, and summed across tasks block by block.

Most phrases are rare, and a phrase is frequent only if its parts are. So words
and pairs are counted twice: first by a hash into cells, as compressed blocks of
cells, then by themselves where their cell is full. Phrases of three words are
looked for where both pairs may be frequent, longer ones where all frequent
phrases of three words allow it. What the cells let through is counted exactly,
so they change the work and never the result. There are at most 2^29 cells: the
set of full ones, which each task gets, has at most 64 MiB. A corpus of more than
some 10^10 words fills them, and then all phrases are summed.

The score of a phrase of words is the least, over its cuts into two parts, of
floor(1000 a n / (l r)), with the counts a, l, r of phrase and parts and all n
words of the language; the arithmetic is decimal with 38 digits. A phrase is
dropped if one with a word more has the same count: then every occurrence of the
phrase has that word beside it, in every shard, which is what the extensions say
(by a hash; the counts confirm it).

Defined cases: a null or empty text has no words; a null language is `und`;
repeated rows count each; ties of the score are ordered by count and phrase; an
empty table gives an empty result; texts are read whole, a longer text than a
shard is a shard of its own; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from . import arrays as A

#: Between pieces: [.,;:!?\x0A-\x0D]; between the words of a piece: [\x20\x09].
_BREAK = np.zeros(256, bool)
_BREAK[list(b".,;:!?\n\x0b\x0c\r")] = True
_GAP = _BREAK.copy()
_GAP[[0x20, 0x09]] = True
#: Rows of one output batch, and entries of cells that a task holds.
_ROWS, _ENTRIES = 1 << 14, 1 << 20
#: The cells are shuffled as this many blocks.
_BLOCK_BITS = 10


@dataclass(frozen=True)
class Settings:
    """Phrases of 2 to `max_words` words with a count of `min_count` or more; the first `top` of each language.
    `shard_bytes`: text of one shard. `cell_bits`: at most 2^cell_bits cells, from 2^10 on."""

    max_words: int = 5
    min_count: int = 100
    top: int = 2000
    shard_bytes: int = 1 << 20
    cell_bits: int = 29


class FmIndex:
    """One direction: the transform of a sequence whose suffixes are sorted by their first `depth` words.

    Word 0 separates; sequences begin and end with it. Intervals are right for patterns of up to `depth` words."""

    def __init__(self, seq: np.ndarray, depth: int):
        n, rank, length = len(seq), seq.astype(np.int64), 1
        order = np.argsort(rank, kind="stable") if depth < 2 else None
        while length < depth:
            key = rank * (int(rank.max()) + 1) + np.roll(rank, -length)
            order = np.argsort(key)
            key = key[order]
            rank[order] = np.cumsum(np.concatenate([[False], key[1:] != key[:-1]]))
            length *= 2
        del rank
        self.n = n
        self.bwt = seq[order - 1].astype(np.int32)
        # Sorted (word, position) pairs: their places answer both C[word] and the rank of a word at a position.
        self.places = self.bwt.astype(np.int64) * n + np.arange(n)
        self.places.sort()
        self.runs = np.concatenate([[False], self.bwt[1:] != self.bwt[:-1]]).cumsum(dtype=np.int32)

    def before(self, words: np.ndarray, at: np.ndarray) -> np.ndarray:
        """C[word] + rank(word, at): where the interval of word + pattern begins, `at` being that of the pattern."""
        return np.searchsorted(self.places, words.astype(np.int64) * self.n + at)

    def only(self, low: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The word before all occurrences of each interval, or 0 if they differ or a break stands there."""
        return np.where(self.runs[low] == self.runs[low + size - 1], self.bwt[low], 0)


@dataclass
class Phrases:
    """Enumerated phrases of one length: words [phrase, place], interval sizes, and the single extensions (0: none)."""

    words: np.ndarray
    count: np.ndarray
    left: np.ndarray
    right: np.ndarray


def enumerate_phrases(seq: np.ndarray, first: int, last: int, extensions: bool = True) -> Iterator[Phrases]:
    """All phrases of `first` to `last` words of a sequence of ids (0: break), by bidirectional interval extension."""
    seq = np.concatenate([[0], seq, [0]]).astype(np.int32)
    reverse = FmIndex(seq[::-1], last)
    forward = FmIndex(seq, last) if extensions else None
    words, size = np.unique(seq[seq > 0], return_counts=True)
    low = np.searchsorted(np.sort(seq), words)
    back = low.copy()
    words = words[:, None]
    for length in range(2, last + 1):
        if not len(words):
            return
        begin = np.cumsum(size) - size
        at = np.repeat(back - begin, size) + np.arange(size.sum())
        owner, symbol = np.repeat(np.arange(len(size)), size), reverse.bwt[at]
        breaks = np.bincount(owner[symbol == 0], minlength=len(size))
        held = symbol > 0
        span = int(seq.max()) + 1
        key, count = np.unique(owner[held] * span + symbol[held], return_counts=True)
        del at, held
        owner, symbol = key // span, key % span
        # Within the pattern's interval suffixes are in order of their next word, breaks first.
        done = np.cumsum(count) - count
        inside = done - done[np.searchsorted(owner, owner)]
        low = low[owner] + breaks[owner] + inside
        words, size = np.concatenate([words[owner], symbol[:, None]], 1), count
        if extensions or length < last:
            back = reverse.before(symbol, back[owner])
        if length >= first:
            none = np.zeros(0, np.int32)
            yield Phrases(words, size, *((forward.only(low, size), reverse.only(back, size)) if extensions else (none, none)))


def _by_language(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Batches of about `size` bytes, of one language each as far as possible: they have fewer different phrases.

    At most four batches are held, however many languages there are."""
    held: dict[str, list[pa.RecordBatch]] = {}
    bytes_of: dict[str, int] = {}

    def joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        return pa.Table.from_batches(parts).combine_chunks().to_batches()[0]

    for b in batches:
        lang = b.column("lang").dictionary_encode()
        for code, name in enumerate(lang.dictionary.to_pylist()):
            part = b.filter(pc.equal(lang.indices, code))
            held.setdefault(name, []).append(part)
            bytes_of[name] = bytes_of.get(name, 0) + part.nbytes
            if bytes_of[name] >= size or sum(bytes_of.values()) >= 4 * size:
                name = max(bytes_of, key=bytes_of.get)
                bytes_of.pop(name)
                yield joined(held.pop(name))
    rest, n = [], 0
    for name, parts in held.items():
        rest, n = rest + parts, n + bytes_of[name]
        if n >= size:
            yield joined(rest)
            rest, n = [], 0
    if n:
        yield joined(rest)


_SHARD = ("seq binary, spelt binary, ends binary, lang_of binary, langs array<string>, "
          "totals array<struct<lang: string, n: bigint>>")


def _shards(settings: Settings):
    """One row per shard: its sequence of local word ids from 1 (0: break), the words' bytes and languages, and
    its words by language."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in A.text_batches(_by_language(batches, settings.shard_bytes), max_bytes=settings.shard_bytes):
            data = A.LOWER[data]
            starts, ends, bounds = words_of(data, offsets)
            if not len(starts):
                continue
            lang = rows.column("lang").dictionary_encode()
            code, doc = lang.indices.to_numpy(), A.segments_of(bounds)
            local, index = distinct_words(data, starts, ends, code[doc])
            broken = np.concatenate([[0], np.cumsum(_BREAK[data], dtype=np.int32)])
            cut = (broken[starts[1:]] > broken[ends[:-1]]) | (doc[1:] != doc[:-1])
            seq = np.insert(local + 1, np.flatnonzero(cut) + 1, 0).astype(np.int32)
            spelt, size = gathered(data, starts[index], ends[index] - starts[index])
            total = np.bincount(code[doc], minlength=len(lang.dictionary)).astype(np.int64)
            totals = pa.StructArray.from_arrays([lang.dictionary, pa.array(total)], names=["lang", "n"])
            yield A.batch_of(seq=pa.array([seq.tobytes()], pa.binary()), spelt=pa.array([spelt.tobytes()], pa.binary()),
                             ends=pa.array([np.cumsum(size).astype(np.int32).tobytes()], pa.binary()),
                             lang_of=pa.array([code[doc[index]].astype(np.int32).tobytes()], pa.binary()),
                             langs=pa.array([lang.dictionary.to_pylist()], pa.list_(pa.string())),
                             totals=pa.ListArray.from_arrays(pa.array([0, len(totals)], pa.int32()), totals))

    return run


def gathered(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the ranges one after the other, and the sizes."""
    at = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
    return data[at], sizes


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of all pieces, and their bounds by document."""
    none = np.zeros(0, np.int64)
    if not len(data):
        return none, none, np.zeros(len(offsets), np.int64)
    held = ~_GAP[data]
    begin, finish = held.copy(), held.copy()
    begin[1:] &= ~held[:-1]
    finish[:-1] &= ~held[1:]
    first, last = offsets[:-1][offsets[:-1] < len(data)], offsets[1:][offsets[1:] > 0] - 1
    begin[first], finish[last] = held[first], held[last]
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(finish) + 1, np.searchsorted(starts, offsets)


def distinct_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of each occurrence's (word, code) and the place of one occurrence of each; told apart by two hashes."""
    h = A.with_segment(A.range_hashes(A.prefix_sums(A.byte_codes(data)), starts, ends), code)
    other = A.range_hashes(A.prefix_sums(A.byte_codes(data ^ np.uint8(0xA5))), starts, ends)
    _, index, local = np.unique(h, return_index=True, return_inverse=True)
    if (other != other[index][local]).any():
        _, index, local = np.unique(np.stack([h, other], 1), axis=0, return_index=True, return_inverse=True)
    return local.reshape(-1), index


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, langs: list[str], lang_of: np.ndarray) -> np.ndarray:
    """A hash of each word and its language."""
    h = A.range_hashes(A.prefix_sums(A.byte_codes(data)), starts, ends)
    of_lang = []
    for lang in langs:
        b = np.frombuffer(lang.encode(), np.uint8)
        of_lang.append(A.range_hashes(A.prefix_sums(A.byte_codes(b)), np.array([0]), np.array([len(b)]))[0])
    return A.mix(h ^ np.array(of_lang, np.uint64)[lang_of] * np.uint64(0x9E3779B97F4A7C15)) if len(h) else h


@dataclass
class Shard:
    """A shard read again: the sequence, and by local word id (0: break) bytes, hashes and languages."""

    seq: np.ndarray
    spelt: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray
    hashes: np.ndarray
    langs: list[str]
    lang_of: np.ndarray

    @staticmethod
    def of(row: pa.RecordBatch) -> Shard:
        get = lambda c, kind: np.frombuffer(row.column(c)[0].as_py(), kind)
        spelt, ends, lang_of, langs = get("spelt", np.uint8), get("ends", np.int32).astype(np.int64), get("lang_of", np.int32), row.column("langs")[0].as_py()
        starts = np.concatenate([[0], ends[:-1]])
        h = np.concatenate([np.zeros(1, np.uint64), word_hashes(spelt, starts, ends, langs, lang_of)])
        front = lambda x: np.concatenate([[0], x])
        # The last byte is a blank, to spell phrases with.
        return Shard(get("seq", np.int32), np.concatenate([spelt, [np.uint8(32)]]), front(starts), front(ends - starts), h, langs, front(lang_of))

    def cells_at(self, length: int, bits: int) -> np.ndarray:
        """The cell of the `length` words from each position on (of no meaning across breaks)."""
        n = max(0, len(self.seq) - length + 1)
        at = np.arange(n)
        return _cell(A.range_hashes(A.prefix_sums(self.hashes[self.seq]), at, at + length), bits)

    def cells_of(self, words: np.ndarray, bits: int) -> np.ndarray:
        at = np.arange(len(words)) * words.shape[1]
        return _cell(A.range_hashes(A.prefix_sums(self.hashes[words.reshape(-1)]), at, at + words.shape[1]), bits)

    def whole(self, length: int) -> np.ndarray:
        """Whether `length` words without a break start at each position."""
        n = max(0, len(self.seq) - length + 1)
        broken = np.concatenate([[0], np.cumsum(self.seq == 0)])
        return broken[length:length + n] == broken[:n]

    def spell(self, words: np.ndarray) -> pa.Array:
        """The phrases [phrase, place] as text."""
        n, length = words.shape
        starts, sizes = np.full((n, 2 * length - 1), len(self.spelt) - 1), np.ones((n, 2 * length - 1), np.int64)
        starts[:, ::2], sizes[:, ::2] = self.starts[words], self.sizes[words]
        data, _ = gathered(self.spelt, starts.reshape(-1), sizes.reshape(-1))
        ends = np.concatenate([[0], np.cumsum(sizes.sum(1))]).astype(np.int32)
        return pa.StringArray.from_buffers(n, pa.py_buffer(ends.tobytes()), pa.py_buffer(data.tobytes()))


def _cell(h: np.ndarray, bits: int) -> np.ndarray:
    return (h >> np.uint64(64 - bits)).astype(np.uint32)


# --- cells ------------------------------------------------------------------------------

_BLOCK = "block int, cells binary, counts binary"


def _planes(x: np.ndarray) -> bytes:
    """32-bit numbers byte plane by byte plane; small numbers leave planes of zeros, which compress away."""
    return x.astype(np.uint32).view(np.uint8).reshape(-1, 4).T.tobytes()


def _numbers(b: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(4, -1).T).view(np.uint32).reshape(-1)


class _Counter:
    """Counts of cells of a task, given out as blocks when there are too many."""

    def __init__(self, bits: int, least: int):
        self.bits, self.least, self.held, self.n = bits, least, [], 0

    def add(self, cell: np.ndarray, count: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.held.append((cell, np.minimum(count, self.least).astype(np.uint32)))
        self.n += len(cell)
        if self.n > _ENTRIES:
            cell, count = self._merged()
            self.held, self.n = [(cell, count)], len(cell)
            if self.n > _ENTRIES // 2:
                yield from self.blocks()

    def _merged(self) -> tuple[np.ndarray, np.ndarray]:
        cell, count = (np.concatenate([h[k] for h in self.held]) for k in (0, 1))
        order = np.argsort(cell)
        cell, count = cell[order], count[order]
        first = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]])) if len(cell) else np.zeros(0, np.int64)
        # Beyond `least` a count says no more.
        return cell[first], np.minimum(np.add.reduceat(count, first), self.least).astype(np.uint32) if len(first) else count

    def blocks(self) -> Iterator[pa.RecordBatch]:
        if not self.held:
            return
        cell, count = self._merged()
        self.held, self.n = [], 0
        size, packer = self.bits - _BLOCK_BITS, zstandard.ZstdCompressor(level=3)
        edge = np.searchsorted(cell, np.arange((1 << _BLOCK_BITS) + 1, dtype=np.uint64) << np.uint64(size))
        found = np.flatnonzero(edge[1:] > edge[:-1])
        parts = [(cell[edge[b]:edge[b + 1]] - np.uint32(b << size), count[edge[b]:edge[b + 1]]) for b in found.tolist()]
        yield A.batch_of(block=found.astype(np.int32), cells=pa.array([packer.compress(_planes(np.diff(c, prepend=np.uint32(0)))) for c, _ in parts], pa.binary()),
                         counts=pa.array([packer.compress(_planes(n)) for _, n in parts], pa.binary()))


def _full_cells(bits: int, least: int):
    """Of blocks in order: the cells whose counts reach `least`, as numbers or (from 1 in 32 on) as bits."""
    size = 1 << bits - _BLOCK_BITS

    def result(block: int, total: np.ndarray) -> pa.RecordBatch:
        full = np.flatnonzero(total >= least).astype(np.uint32)
        dense = 32 * len(full) > size
        data = np.packbits(total >= least).tobytes() if dense else full.tobytes()
        return A.batch_of(block=np.array([block], np.int32), dense=pa.array([bool(dense)]), data=pa.array([data], pa.binary()))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, total, unpack = -1, None, zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for b, cells, counts in zip(*(batch.column(c).to_pylist() for c in ("block", "cells", "counts"))):
                if b != block:
                    if total is not None:
                        yield result(block, total)
                    block, total = b, np.zeros(size, np.int64)
                total[np.cumsum(_numbers(unpack(cells)))] += _numbers(unpack(counts))
        if total is not None:
            yield result(block, total)

    return run


class FullCells:
    """The full cells: sorted numbers, or bits where that is smaller (2^bits / 8 bytes at most)."""

    def __init__(self, bits: int, rows: Iterable[tuple[int, bool, bytes]]):
        size = 1 << bits - _BLOCK_BITS
        self.bits, self.bitmap, parts, n = bits, None, [], 0
        for block, dense, data in sorted(rows):
            full = np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8), count=size)) if dense else np.frombuffer(data, np.uint32)
            n += len(full)
            if self.bitmap is None and 32 * n > 1 << bits:
                self.bitmap = np.zeros(1 << bits - 3, np.uint8)
                for p in parts:
                    self._set(p)
            part = full.astype(np.uint32) + np.uint32(block * size)
            parts = [*parts, part] if self.bitmap is None else self._set(part)
        self.cells = np.concatenate(parts) if self.bitmap is None and parts else np.zeros(0, np.uint32)

    def _set(self, cells: np.ndarray) -> list:
        np.bitwise_or.at(self.bitmap, cells >> 3, (1 << (cells & 7)).astype(np.uint8))
        return []

    def has(self, cell: np.ndarray) -> np.ndarray:
        if self.bitmap is not None:
            return (self.bitmap[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 > 0
        if not len(self.cells):
            return np.zeros(len(cell), bool)
        return self.cells[np.minimum(np.searchsorted(self.cells, cell), len(self.cells) - 1)] == cell


def full_cells(blocks: DataFrame, bits: int, least: int) -> FullCells:
    """Sum the blocks of all tasks; at most 2^bits / 8 bytes and a little come to the driver."""
    rows = (blocks.repartition("block").sortWithinPartitions("block")
            .mapInArrow(_full_cells(bits, least), "block int, dense boolean, data binary").collect())
    return FullCells(bits, [(r["block"], r["dense"], bytes(r["data"])) for r in rows])


def _one_by_one(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(b.num_rows):
            yield b.slice(i, 1)


def _hashed_counts(bits: int, least: int):
    """The counts of words and pairs by cell."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _Counter(bits, least)
        for row in _one_by_one(batches):
            shard = Shard.of(row)
            found = np.unique(shard.seq[shard.seq > 0], return_counts=True)
            yield from counter.add(shard.cells_of(found[0][:, None], bits), found[1])
            for pairs in enumerate_phrases(shard.seq, 2, 2, extensions=False):
                yield from counter.add(shard.cells_of(pairs.words, bits), pairs.count)
        yield from counter.blocks()

    return run


def _hashed_phrases(bits: int, least: int):
    """The cells of phrases (as text), each full."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _Counter(bits, least)
        for rows, data, offsets in A.text_batches(batches, "phrase"):
            lang = rows.column("lang").dictionary_encode()
            starts, ends, bounds = words_of(data, offsets)
            h = word_hashes(data, starts, ends, lang.dictionary.to_pylist(), lang.indices.to_numpy()[A.segments_of(bounds)])
            cell = _cell(A.range_hashes(A.prefix_sums(h), bounds[:-1], bounds[1:]), bits)
            yield from counter.add(cell, np.full(len(cell), least))
        yield from counter.blocks()

    return run


# --- phrases ------------------------------------------------------------------------------


def segments(seq: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """The stretches of the sequence whose phrases of `length` words begin at `starts`, with breaks between."""
    first = np.flatnonzero(starts & ~np.concatenate([[False], starts[:-1]]))
    last = np.flatnonzero(starts & ~np.concatenate([starts[1:], [False]]))
    size = last - first + length + 1  # with the break
    at = np.repeat(first, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    out = seq[np.minimum(at, len(seq) - 1)]
    out[np.cumsum(size) - 1] = 0
    return out


#: Counted phrases of a task: block, languages and the packed columns of `n` phrases.
_PACKED = "block int, n int, langs array<string>, data binary"
_SUMMED = "lang string, phrase string, words int, f long, extended boolean"
#: Phrases are shuffled as this many blocks, by a hash of their first two words.
_PHRASE_BLOCK_BITS = 9


class _Sums:
    """Counts and single extensions (-1: none) of phrases, summed whenever they are many."""

    def __init__(self):
        self.held, self.rows, self.least_rows = [], 0, _ENTRIES // 2

    def add(self, table: pa.Table) -> None:
        self.held.append(table)
        self.rows += table.num_rows
        if self.rows > self.least_rows:
            self.held = [self.summed()]
            self.rows = self.held[0].num_rows
            self.least_rows = max(_ENTRIES // 2, 2 * self.rows)

    def summed(self) -> pa.Table:
        if len(self.held) == 1:
            return self.held[0]
        table = pa.concat_tables(self.held)
        self.held = []
        keys = ["block", "lang", "phrase"]
        sums = table.group_by(keys, use_threads=False).aggregate(
            [("count", "sum"), *((side, kind) for side in ("left", "right") for kind in ("min", "max"))])
        one = lambda side: pc.if_else(pc.equal(sums[f"{side}_min"], sums[f"{side}_max"]), sums[f"{side}_min"], pa.scalar(-1, pa.int8()))
        return pa.table({**{k: sums[k] for k in keys}, "count": sums["count_sum"], "left": one("left"), "right": one("right")})


def _pack(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """Sorted blocks of phrases; neighbours are alike, so that they compress well."""
    table = table.sort_by([("block", "ascending"), ("lang", "ascending"), ("phrase", "ascending")]).combine_chunks()
    if not table.num_rows:
        return
    packer = zstandard.ZstdCompressor(level=3)
    block = table["block"].to_numpy()
    edges = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1], [True]]))
    for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist()):
        part = table.slice(lo, hi - lo)
        phrase, lang = part["phrase"].combine_chunks(), part["lang"].combine_chunks().dictionary_encode()
        text = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, hi - lo], pa.int32()), phrase), "")[0].as_buffer()
        data = b"".join([_planes(lang.indices.to_numpy()), _planes(pc.binary_length(phrase).to_numpy()),
                         *(_planes(part["count"].to_numpy() >> k & 0xFFFFFFFF) for k in (0, 32)),
                         part["left"].to_numpy().tobytes(), part["right"].to_numpy().tobytes(), text])
        yield A.batch_of(block=np.array([block[lo]], np.int32), n=np.array([hi - lo], np.int32),
                         langs=pa.array([lang.dictionary.to_pylist()], pa.list_(pa.string())),
                         data=pa.array([packer.compress(data)], pa.binary()))


def _unpack(block: int, n: int, langs: list[str], data: bytes) -> pa.Table:
    data = zstandard.ZstdDecompressor().decompress(data)
    code, size, low, high = (_numbers(data[k * 4 * n:(k + 1) * 4 * n]) for k in range(4))
    left, right = (np.frombuffer(data, np.int8, n, (16 + k) * n) for k in range(2))
    ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    return pa.table({"block": np.full(n, block, np.int32), "lang": pa.array(langs, pa.string()).take(pa.array(code)),
                     "phrase": pa.StringArray.from_buffers(n, pa.py_buffer(ends.tobytes()), pa.py_buffer(data[18 * n:])),
                     "count": low.astype(np.int64) | high.astype(np.int64) << 32, "left": left, "right": right})


def _phrases(lengths: range, part: int, shared):
    """Blocks of the phrases of these lengths whose parts of `part` words (of one, for words) have full cells."""
    def rows(shard: Shard, found: Phrases) -> pa.Table:
        side = lambda w: np.where(w > 0, (shard.hashes[w] >> np.uint64(57)).astype(np.int8), -1).astype(np.int8)
        lang = pa.DictionaryArray.from_arrays(pa.array(shard.lang_of[found.words[:, 0]].astype(np.int32)), pa.array(shard.langs, pa.string()))
        return pa.table({"block": shard.cells_of(found.words[:, :2], _PHRASE_BLOCK_BITS).astype(np.int32), "lang": lang.cast(pa.string()),
                         "phrase": shard.spell(found.words), "count": found.count.astype(np.int64),
                         "left": side(found.left), "right": side(found.right)})

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        full, sums = shared.value, _Sums()
        for row in _one_by_one(batches):
            shard = Shard.of(row)
            if 1 in lengths:
                word, count = np.unique(shard.seq[shard.seq > 0], return_counts=True)
                held = full.has(shard.cells_of(word[:, None], full.bits))
                none = np.zeros(held.sum(), np.int32)
                sums.add(rows(shard, Phrases(word[held][:, None], count[held], none, none)))
            for length in lengths:
                if length == 1:
                    continue
                # Every part has a full cell, and no break stands between.
                starts, p = shard.whole(length), min(part, length)
                held = full.has(shard.cells_at(p, full.bits))
                for k in range(length - p + 1):
                    starts &= held[k:k + len(starts)]
                starts = np.concatenate([starts, np.zeros(len(shard.seq) - len(starts), bool)])
                for found in enumerate_phrases(segments(shard.seq, starts, length), length, length):
                    sums.add(rows(shard, found))
            if sums.rows > _ENTRIES // 2:
                yield from _pack(sums.summed())
                sums = _Sums()
        if sums.held:
            yield from _pack(sums.summed())

    return run


def _summed_phrases(least: int):
    """Of blocks in order: the phrases with a count of `least` or more."""
    def result(sums: _Sums) -> Iterator[pa.RecordBatch]:
        table = sums.summed()
        table = table.filter(pc.greater_equal(table["count"], least)).combine_chunks()
        for b in table.to_batches(max_chunksize=_ROWS):
            left, right = (pc.greater_equal(b.column(side), 0) for side in ("left", "right"))
            yield A.batch_of(lang=b.column("lang"), phrase=b.column("phrase"), f=b.column("count"), extended=pc.or_(left, right),
                             words=pc.add(pc.count_substring(b.column("phrase"), " "), pa.scalar(1, pa.int32()))).select(["lang", "phrase", "words", "f", "extended"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, sums = -1, None
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("block", "n", "langs", "data"))):
                if row[0] != block:
                    if sums is not None:
                        yield from result(sums)
                    block, sums = row[0], _Sums()
                sums.add(_unpack(*row))
        if sums is not None:
            yield from result(sums)

    return run


def collocations(spark: SparkSession, docs: DataFrame, settings: Settings = Settings(), text_col: str = "text",
                 lang_col: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of the first `top` phrases of every language."""
    def written(frame: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, name)
        frame.write.option("compression", "zstd").parquet(path)
        return spark.read.parquet(path)

    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                       F.col(text_col).cast("string").alias("text"))
    shards = written(rows.mapInArrow(_shards(settings), _SHARD), "phrase-shards")
    totals = written(shards.select(F.inline("totals")).groupBy("lang").agg(F.sum("n").alias("n")), "phrase-totals")
    n = int(totals.agg(F.sum("n").alias("n")).first()["n"] or 0)
    bits, least = max(_BLOCK_BITS, min(settings.cell_bits, (4 * n).bit_length())), settings.min_count

    def counted(lengths: range, part: int, full: FullCells) -> DataFrame:
        """The frequent phrases of these lengths; extended: maybe all occurrences have one word on one side."""
        shared = spark.sparkContext.broadcast(full)
        found = shards.drop("totals").mapInArrow(_phrases(lengths, part, shared), _PACKED)
        summed = found.repartition("block").sortWithinPartitions("block").mapInArrow(_summed_phrases(least), _SUMMED)
        with _few_at_once(spark):
            return written(summed, "frequent-phrases")

    with _few_at_once(spark):
        pairs = full_cells(shards.drop("totals").mapInArrow(_hashed_counts(bits, least), _BLOCK), bits, least)
    grams = counted(range(1, min(3, settings.max_words) + 1), 2, pairs)
    if settings.max_words > 3:
        threes = grams.filter("words = 3").select("lang", "phrase").mapInArrow(_hashed_phrases(bits, least), _BLOCK)
        grams = grams.unionByName(counted(range(4, settings.max_words + 1), 3, full_cells(threes, bits, least)))
    return _ranked(grams, totals, settings, written)


def _ranked(grams: DataFrame, totals: DataFrame, settings: Settings, written) -> DataFrame:
    # A phrase with a longer one of the same count; only those that the extensions allow are asked for.
    longer = grams.filter("words > 2").select("lang", "f", F.split("phrase", " ").alias("w"))
    inner = longer.select("lang", "f", F.explode(F.array(*[F.array_join(F.slice("w", k, F.size("w") - 1), " ") for k in (1, 2)])).alias("phrase"))
    kept = grams.filter("words > 1")
    dropped = kept.filter("extended").select("lang", "phrase", "f").join(inner, ["lang", "phrase", "f"], "left_semi")
    kept = kept.join(written(dropped.select("lang", "phrase"), "dropped-phrases"), ["lang", "phrase"], "left_anti")
    counts = grams.select("lang", "phrase", "f")
    cuts = kept.select("lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("w"),
                       F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("cut"))
    cuts = written(cuts.select("lang", "phrase", "a", "cut", F.array_join(F.slice("w", F.lit(1), F.col("cut")), " ").alias("first"),
                               F.array_join(F.slice("w", F.col("cut") + 1, F.size("w")), " ").alias("rest")), "phrase-cuts")
    for side, name in (("first", "l"), ("rest", "r")):
        cuts = cuts.join(counts.select("lang", F.col("phrase").alias(side), F.col("f").alias(name)), ["lang", side])
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    scored = cuts.join(totals, "lang").withColumn(
        "score", _quotient(F.lit(1000).cast("decimal(4,0)") * F.col("n").cast("decimal(15,0)") * wide("a"), wide("l") * wide("r")))
    least = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("m"))
    out = least.select("lang", "phrase", "a", "n", "m.score", "m.l", "m.r")
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    # In two steps, so that the phrases of a language are not sorted by one task.
    out = out.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    for parts in (["lang", "salt"], ["lang"]):
        out = out.withColumn("rank", F.row_number().over(Window.partitionBy(*parts).orderBy(*order))).filter(F.col("rank") <= settings.top)
    return out.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


@contextmanager
def _few_at_once(spark: SparkSession, rows: int = 2) -> Iterator[None]:
    """Shards go to Python some at a time, as they are megabytes each; holds for jobs run inside."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def _quotient(a: Column, b: Column) -> Column:
    """Whole quotient of two whole decimals of up to 38 digits."""
    return F.call_function("div", a, b)


#: The same result in SQL (DuckDB).
SQL = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
t AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang),
f AS (SELECT lang, k, phrase, count(*) AS f FROM (
        SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase
        FROM w, (SELECT unnest([1, 2, 3, 4, 5]) AS k) ks WHERE len(ws) >= k) g
      GROUP BY lang, k, phrase HAVING count(*) >= 100),
c AS (SELECT * FROM f WHERE k >= 2),
e AS (SELECT DISTINCT c.lang, c.phrase FROM c JOIN c AS b ON b.lang = c.lang AND b.k > c.k AND b.f >= c.f
        AND contains(' ' || b.phrase || ' ', ' ' || c.phrase || ' ')),
kept AS (SELECT c.* FROM c ANTI JOIN e ON e.lang = c.lang AND e.phrase = c.phrase),
cut AS (SELECT lang, k, phrase, f AS a, unnest(range(1, k)) AS j, string_split(phrase, ' ') AS ws FROM kept),
s AS (SELECT cut.lang, cut.phrase, a, j, l.f AS l, r.f AS r, t.n,
             CAST((1000::HUGEINT * a * t.n) // (l.f::HUGEINT * r.f) AS BIGINT) AS score
      FROM cut JOIN f AS l ON l.lang = cut.lang AND l.phrase = array_to_string(ws[1:j], ' ')
      JOIN f AS r ON r.lang = cut.lang AND r.phrase = array_to_string(ws[j + 1:cut.k], ' ') JOIN t ON t.lang = cut.lang),
m AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM m)
SELECT lang, rank, phrase, a, l, r, n, score FROM o WHERE rank <= 2000
"""
