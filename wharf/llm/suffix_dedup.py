"""Operator 3: removal of repeated strings by content-chosen samples and hashes.

Every byte that lies in a `length`-byte string which also starts elsewhere is
removed. Nothing is sorted by suffix: the sort, the recursion and the merge of
difference-cover suffix sorting are replaced by grouping on hashes.

1. Sample. For the suffix at p, a mod-minimizer picks a sampled suffix a(p) in
   [p, p + span). It goes by content instead of by position modulo 3, so that
   equal strings have their samples at equal offsets wherever they start, and far
   fewer suffixes are sampled (about one byte in a hundred).
2. Group the sampled triples. The first `length - span + 1` bytes of a sampled
   suffix are a triple. A sample whose triple occurs once cannot take part in a
   repeat and is left out.
3. Extend and group (in place of the recursion). A triple's name covers the bytes
   on both sides too, as far as the suffixes that the sample stands for need
   them. Equal names settle all of these suffixes at once.
4. Group the rest (in place of merge and comparison of neighbours). What is not
   settled is hashed on its own `length` bytes, once for each distinct name of a
   triple; a hash that occurs twice or more is a repeat.

Names are 64-bit hashes of the bytes, equal where the bytes are.

Defined cases: a null text is an empty one; texts shorter than `length` keep
everything; repeated rows are repeats of each other; positions are bytes and
strings never cross documents; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import arrays as A


@dataclass(frozen=True)
class Settings:
    length: int = 400
    #: A suffix's sample starts less than `span` bytes after it. The choice reads
    #: `3 * span + 7` bytes, which must not exceed `length`.
    span: int = 128

    def __post_init__(self):
        if 3 * self.span + 7 > self.length:
            raise ValueError("the cover reads 3 * span + 7 bytes, more than length")


_GRAM, _PLACE = 8, np.uint64((1 << 24) - 1)


def samples(data: np.ndarray, offsets: np.ndarray, s: Settings) -> tuple[np.ndarray, ...]:
    """(document, first, last, sample): runs of suffixes [first, last] that share a sample, in a flat batch."""
    n, reach = len(data) - s.length + 1, 3 * s.span
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none, none, none, none
    grams = np.ndarray((len(data) - _GRAM + 1,), "<u8", data.tobytes(), strides=(1,))
    first = np.arange(max(0, min(n, len(grams) - reach + 1)))
    x = np.empty(len(first), np.int64)
    # Hash above, position in the piece below: the least value of a window is its leftmost least
    # hash. Both parts have fixed widths, so equal strings are treated alike in every batch.
    for i in range(0, len(first), 1 << 23):
        j = min(i + (1 << 23), len(first))
        piece = grams[i:j + reach - 1]
        least = (A.mix(piece) & ~_PLACE) | np.arange(len(piece), dtype=np.uint64)
        size = 1
        while 2 * size <= reach:
            least, size = np.minimum(least[:-size], least[size:]), 2 * size
        if size < reach:
            least = np.minimum(least[:size - reach], least[reach - size:])
        x[i:j] = i + (least & _PLACE).astype(np.int64)
    sample = first + (x - first) % s.span
    doc = np.searchsorted(offsets, first, "right") - 1
    inside = first + s.length <= offsets[doc + 1]
    first, sample, doc = first[inside], sample[inside], doc[inside]
    if not len(first):
        return none, none, none, none
    new = np.concatenate([[True], (sample[1:] != sample[:-1]) | (first[1:] != first[:-1] + 1) | (doc[1:] != doc[:-1])])
    at = np.flatnonzero(new)
    return doc[at], first[at], first[np.append(at[1:], len(first)) - 1], sample[at]


def _names(batches: Iterable[pa.RecordBatch], s: Settings, full: bool) -> Iterator[pa.RecordBatch]:
    """The triple's name of each sample; with `full`, also the extended name and place."""
    for batch, data, offsets in A.text_batches(batches):
        doc, lo, hi, a = samples(data, offsets, s)
        sums = A.prefix_sums(A.byte_codes(data))
        triple = A.range_hashes(sums, a, a + s.length - s.span + 1)
        if not full:
            yield A.batch_of(triple=triple.view(np.int64))
            continue
        before, more = (a - lo).astype(np.uint64), (hi - lo).astype(np.uint64)
        name = A.mix(A.range_hashes(sums, lo, hi + s.length) + before * np.uint64(2 * s.span))
        # Place in the text: the sample's position, bytes before it and number of suffixes less one.
        place = ((a - offsets[doc]).astype(np.uint64) << np.uint64(16)) | (before << np.uint64(8)) | more
        yield A.batch_of(triple=triple.view(np.int64), name=name.view(np.int64), place=place.view(np.int64),
                         text_key=batch.column("text_key").take(pa.array(doc)))


def _pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed for the shuffle."""
    packer = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        yield A.batch_of(id=batch.column("id"), text_key=batch.column("text_key"),
                         packed=pa.array([packer.compress((t or "").encode()) for t in batch.column("text").to_pylist()], pa.binary()))


def _unpack(packed: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(packed)


def _suffixes(batches: Iterable[pa.RecordBatch], s: Settings) -> Iterator[pa.RecordBatch]:
    """The `length`-byte prefix (as a hash) of every suffix of the given samples; number: rep << 8 | suffix."""
    for batch in batches:
        for packed, reps in zip(batch.column("packed").to_pylist(), batch.column("reps").to_pylist()):
            data = np.frombuffer(_unpack(packed), np.uint8)
            rep, place = (np.array([r[k] for r in reps], np.int64) for k in ("rep", "place"))
            a, before, more = place >> 16, (place >> 8) & 255, place & 255
            n = more + 1
            which = np.repeat(np.arange(len(rep)), n)
            k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            first = (a - before)[which] + k
            h = A.range_hashes(A.prefix_sums(A.byte_codes(data)), first, first + s.length)
            yield A.batch_of(prefix=h.view(np.int64), number=(rep[which] << 8) | k)


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [(lo, hi) for lo, hi in out]


def _cut(batches: Iterable[pa.RecordBatch], with_text: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        size, removed, runs, digest, texts = [], [], [], [], []
        for packed, spans in zip(batch.column("packed").to_pylist(), batch.column("spans").to_pylist()):
            data, cut = _unpack(packed), _merged([(x["lo"], x["hi"]) for x in spans or ()])
            edges = [0, *[e for span in cut for e in span], len(data)]
            left = b"".join(data[edges[i]:edges[i + 1]] for i in range(0, len(edges), 2))
            size.append(len(data))
            removed.append(len(data) - len(left))
            runs.append(len(cut))
            digest.append(hashlib.sha256(left).hexdigest())
            # Cuts may split a character; the text form shows such bytes as replacement characters.
            texts.append(left.decode("utf-8", "replace"))
        out = {"id": batch.column("id"), "n_bytes": pa.array(size, pa.int64()), "n_removed": pa.array(removed, pa.int64()),
               "n_spans": pa.array(runs, pa.int64()), "kept_sha256": pa.array(digest, pa.string())}
        yield A.batch_of(**out, **({"kept_text": pa.array(texts, pa.string())} if with_text else {}))


def repeated_spans(spark: SparkSession, rows: DataFrame, s: Settings) -> DataFrame:
    """(text_key, lo, hi): byte ranges of the texts that repeats cover; they may overlap.

    A triple or name that very many texts share is counted before it is shuffled.
    The counts are written, so that a join with them has a shuffle of its own,
    which adaptive execution may split."""
    def written(frame: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, f"suffix-{name}")
        frame.write.parquet(path)
        return spark.read.parquet(path)

    texts = rows.select("text_key", "text")
    triples = written(texts.mapInArrow(lambda b: _names(b, s, False), "triple long").groupBy("triple").count()
                      .filter("count > 1").select("triple"), "triples")
    sampled = texts.mapInArrow(lambda b: _names(b, s, True), "triple long, name long, place long, text_key long")
    sampled = written(sampled.join(triples, "triple", "left_semi"), "samples")
    names = written(sampled.groupBy("triple", "name").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("text_key", "place")).alias("at")), "names")
    settled = sampled.join(names.filter("n > 1").select("triple", "name"), ["triple", "name"], "left_semi")
    first = F.shiftright("place", 16) - F.shiftright("place", 8).bitwiseAND(255)
    settled = settled.select("text_key", first.alias("lo"),
                             (first + F.col("place").bitwiseAND(255) + s.length).alias("hi"))

    several = written(names.groupBy("triple").count().filter("count > 1").select("triple"), "several")
    reps = written(names.join(several, "triple", "left_semi")
                   .select(F.monotonically_increasing_id().alias("rep"), "at.text_key", "at.place", "n"), "reps")
    # Copies of a text hold the same suffixes, and their own samples are settled: one row stands for all.
    first_row = rows.groupBy("text_key").agg(F.min("id").alias("row_id"))
    holders = written(reps.groupBy("text_key").agg(F.collect_list(F.struct("rep", "place")).alias("reps"))
                      .join(first_row, "text_key").withColumnRenamed("text_key", "holder"), "holders")
    packed = rows.mapInArrow(_pack, f"id {rows.schema['id'].dataType.simpleString()}, text_key long, packed binary")
    held = packed.join(holders, (F.col("text_key") == F.col("holder")) & F.col("id").eqNullSafe(F.col("row_id")))
    prefixes = written(held.select("packed", "reps").mapInArrow(lambda b: _suffixes(b, s), "prefix long, number long"), "prefixes")
    # A prefix may stand in very many texts: it is counted before it is shuffled, and its rows may be split.
    shared = written(prefixes.groupBy("prefix").count().filter("count > 1").select("prefix"), "shared")
    repeated = (prefixes.join(shared, "prefix", "left_semi")
                .select(F.shiftright("number", 8).alias("rep"), F.col("number").bitwiseAND(255).alias("k")))
    # Only samples that stand alone under their name are still open.
    open_ = reps.filter("n = 1").select("rep", "text_key", first.alias("first"))
    found = repeated.join(open_, "rep").select("text_key", (F.col("first") + F.col("k")).alias("lo"),
                                               (F.col("first") + F.col("k") + s.length).alias("hi"))
    return settled.unionByName(found)


def remove_repeats(spark: SparkSession, docs: DataFrame, s: Settings = Settings(), id_col: str = "doc_id",
                   text_col: str = "text", with_text: bool = True) -> DataFrame:
    """Per row: id, n_bytes, n_removed, n_spans, kept_sha256 and, with `with_text`, kept_text."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(text).alias("text_key"))
    kind = rows.schema["id"].dataType.simpleString()
    path = scratch_path(spark, "suffix-spans")
    (repeated_spans(spark, rows, s).groupBy("text_key").agg(F.collect_set(F.struct("lo", "hi")).alias("spans"))
     .write.parquet(path))
    spans = spark.read.parquet(path)
    packed = rows.mapInArrow(_pack, f"id {kind}, text_key long, packed binary")
    schema = f"id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    out = (packed.join(spans, "text_key", "left").select("id", "packed", "spans")
           .mapInArrow(lambda b: _cut(b, with_text), schema + (", kept_text string" if with_text else "")))
    return out.withColumnRenamed("id", id_col)
