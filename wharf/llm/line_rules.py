"""Operator 4: quality rules by cross-document line frequency.

Normalised lines of every length are hashed, the distinct documents that hold a
line are counted per host, lines above the limits are taken out, and documents
that lose most of their words to that are rejected.

A long line that many texts hold is a notice or copied prose. Near copies (by
operator 1, five-word shingles) therefore count as one document of a long line:
prose that only near copies share is left to near-duplicate removal, and a
notice in unrelated documents is taken out whatever its length.

Defined cases: a null text is an empty one (no words: the base rule rejects it);
a null host is a host of its own; repeated rows give repeated result rows, and
rows with one text count as one document of a line; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, tasks_of
from . import arrays as A
from . import near_dup


@dataclass(frozen=True)
class LineLimits:
    """A line is boilerplate of a host if at least `min_documents` different texts
    of the host hold it. For lines of more than `short_line_words` words, texts
    that are near copies (`NEAR`) count as one.
    A document is depleted if fewer than `min_left` of its words remain."""

    short_line_words: int = 20
    min_documents: int = 10
    min_left: float = 0.5


#: Texts are near copies from this similarity on, as in the pipeline.
NEAR = near_dup.Settings(shingle=5, percent=80)

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
#: For normalised lines: lower case, every digit alike, no ASCII punctuation.
_PLAIN = A.LOWER.copy()
_PLAIN[48:58] = 48
_KEEP = np.ones(256, bool)
_KEEP[[b for b in range(33, 127) if not chr(b).isalnum()]] = False

_STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
_LINES = "lines array<struct<hash: bigint, words: int>>"


def _repeated(h: np.ndarray) -> np.ndarray:
    """Whether each value occurs twice or more."""
    _, inverse, counts = np.unique(h, return_inverse=True, return_counts=True)
    return counts[inverse] > 1


def _later(h: np.ndarray) -> np.ndarray:
    """Whether an equal value stands before."""
    out = np.ones(len(h), bool)
    out[np.unique(h, return_index=True)[1]] = False
    return out


def text_stats(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The base counts of each document of a flat batch."""
    starts, ends, bounds = A.words(data, offsets)
    n_words, doc = np.diff(bounds), A.segments_of(bounds)
    sums = A.prefix_sums(A.byte_codes(data))
    h = A.range_hashes(sums, starts, ends)

    windows, wb = A.shingles(h, bounds, 3)
    whole = n_words[A.segments_of(wb)] >= 3
    at = bounds[:-1][A.segments_of(wb)] + (np.arange(len(windows)) - wb[:-1][A.segments_of(wb)])
    twice = at[_repeated(A.with_segment(windows, A.segments_of(wb))) & whole]
    hit = np.zeros(len(starts) + 3, bool)
    for k in range(3):
        hit[twice + k] = True

    lines, lb = line_ranges(data, offsets)
    held = np.searchsorted(starts, lines[:, 1]) > np.searchsorted(starts, lines[:, 0])
    line_doc = A.segments_of(lb)[held]
    again = _later(A.with_segment(A.range_hashes(sums, lines[held, 0], lines[held, 1]), line_doc))

    letter = ~A.SPACE[data] & ((data & 0xC0) != 0x80)
    return {"n_words": n_words.astype(np.int64), "word_chars": A.segment_sums(letter, offsets),
            "n_symbols": A.segment_sums(_SYMBOL[data], offsets),
            "n_dup_lines": np.bincount(line_doc[again], minlength=len(n_words)),
            "n_repeat_words": np.bincount(doc[hit[:len(starts)]], minlength=len(n_words))}


def line_ranges(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """[start, end) of every `\\n`-split line, and the lines' bounds by document."""
    newline = np.flatnonzero(data == 10)
    starts = np.sort(np.concatenate([offsets[:-1], newline + 1]), kind="stable")
    ends = np.sort(np.concatenate([offsets[1:], newline]), kind="stable")
    n = np.searchsorted(newline, offsets[1:]) - np.searchsorted(newline, offsets[:-1]) + 1
    return np.stack([starts, ends], 1), np.concatenate([[0], np.cumsum(n)])


def normalised_lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and words of each line with a word, and their bounds by document."""
    keep = _KEEP[data]
    kept = np.concatenate([[0], np.cumsum(keep)])
    data, offsets = _PLAIN[data[keep]], kept[offsets]
    starts, ends, bounds = A.words(data, offsets)
    lines, lb = line_ranges(data, offsets)
    first, last = np.searchsorted(starts, lines[:, 0]), np.searchsorted(starts, lines[:, 1])
    held = last > first
    words = A.range_hashes(A.prefix_sums(A.byte_codes(data)), starts, ends)
    h = A.range_hashes(A.prefix_sums(words), first[held], last[held])
    doc = A.segments_of(lb)[held]
    return h, (last - first)[held], np.searchsorted(doc, np.arange(len(offsets)))


def _scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, offsets in A.text_batches(batches):
        stats = text_stats(data, offsets)
        h, n, bounds = normalised_lines(data, offsets)
        doc = A.segments_of(bounds)
        # One entry for each distinct line of a document, with the words of all its occurrences.
        _, index, inverse = np.unique(A.with_segment(h, doc), return_index=True, return_inverse=True)
        words = np.bincount(inverse, weights=n, minlength=len(index)).astype(np.int32)
        single = n[index].astype(np.int32)
        order = np.argsort(doc[index], kind="stable")
        item = pa.StructArray.from_arrays(
            [pa.array(h[index][order].view(np.int64)), pa.array(words[order]), pa.array(single[order])],
            names=["hash", "words", "length"])
        split = np.searchsorted(doc[index][order], np.arange(len(offsets))).astype(np.int32)
        yield A.batch_of(id=rows.column("id"), host=rows.column("host"), text_hash=rows.column("text_hash"), **stats,
                         lines=pa.ListArray.from_arrays(pa.array(split), item))


def scan_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """One row per document: base counts and its distinct normalised lines."""
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.col(host_col).cast("string").alias("host"),
                       F.xxhash64(text).alias("text_hash"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(_scan, f"id {kind}, host string, text_hash long, {_STATS}, "
                                  "lines array<struct<hash: bigint, words: int, length: int>>")


def _of_unrelated(docs: DataFrame, lines: DataFrame, long: DataFrame, least: int, text_col: str,
                  written: Callable[[DataFrame, str, int], DataFrame], tasks: int, spark: SparkSession) -> DataFrame:
    """(host, hash) of the long lines that at least `least` texts hold of which no two are near copies."""
    wanted = long.select(F.col("host").alias("w_host"), F.col("hash").alias("w_hash"))
    holders = written(lines.select("host", "hash", "text_hash").distinct().join(
        wanted, F.col("host").eqNullSafe(F.col("w_host")) & (F.col("hash") == F.col("w_hash")), "left_semi"), "long-lines", tasks)
    held = written(holders.select("text_hash").distinct(), "long-line-texts", tasks)
    text = F.col(text_col).cast("string")
    texts = written(docs.select(text.alias("text"), F.xxhash64(text).alias("text_hash")).join(held, "text_hash", "left_semi")
                    .dropDuplicates(["text_hash"]), "held-texts", tasks)
    groups = near_dup.near_duplicates(spark, texts.withColumnRenamed("text_hash", "id"), NEAR, id_col="id")
    groups = written(groups.select(F.col("id").alias("text_hash"), "component_id"), "near-texts", tasks)
    return (holders.join(groups, "text_hash").select("host", "hash", "component_id").distinct().groupBy("host", "hash")
            .count().filter(F.col("count") >= least).select("host", "hash"))


def quality_rules(spark: SparkSession, docs: DataFrame, limits: LineLimits = LineLimits(), id_col: str = "doc_id",
                  text_col: str = "text", host_col: str = "source") -> DataFrame:
    """Per row of `docs`: id, base counts, words left, base_failed and kept.

    The scan is written once to the shared scratch folder. Line counts are
    summed before they are shuffled, so a line that a third of all documents
    hold is one row per task. Near copies are looked for only among the texts
    that hold a long line above the limit.
    """
    def written(frame: DataFrame, name: str, tasks: int = 0) -> DataFrame:
        path = scratch_path(spark, name)
        (frame.coalesce(tasks) if tasks else frame).write.parquet(path)
        return spark.read.parquet(path)

    scanned = written(scan_lines(docs, id_col, text_col, host_col), "line-rules")
    tasks = tasks_of(scanned)
    lines = (scanned.select("host", "text_hash", F.explode("lines").alias("l"))
             .select("host", "text_hash", "l.hash", "l.words", "l.length"))
    repeated = written(lines.select("host", "hash", "length", "text_hash").distinct().groupBy("host", "hash", "length")
                       .count().filter(F.col("count") >= limits.min_documents), "repeated-lines", tasks)
    frequent = repeated.filter(F.col("length") <= limits.short_line_words).select("host", "hash")
    long = repeated.filter(F.col("length") > limits.short_line_words).select("host", "hash")
    if not long.isEmpty():
        frequent = frequent.unionByName(_of_unrelated(docs, lines, long, limits.min_documents, text_col, written, tasks, spark))
    # Rows of one text and host lose the same lines, so the sums are per (host, text).
    f = frequent.select(F.col("host").alias("f_host"), F.col("hash").alias("f_hash"))
    lost = (lines.select("host", "text_hash", "hash", "words").distinct()
            .join(f, F.col("host").eqNullSafe(F.col("f_host")) & (F.col("hash") == F.col("f_hash")), "left_semi")
            .groupBy(F.col("host").alias("x_host"), F.col("text_hash").alias("x_hash"))
            .agg(F.sum("words").alias("words_lost")))
    out = scanned.drop("lines").join(
        lost, F.col("host").eqNullSafe(F.col("x_host")) & (F.col("text_hash") == F.col("x_hash")), "left")
    n, base = F.col("n_words"), (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    left = n - F.coalesce("words_lost", F.lit(0))
    return out.select(F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      base.alias("base_failed"), (~base & (left >= limits.min_left * n)).alias("kept"),
                      left.alias("n_words_left"), "host", "text_hash")
