"""Operator 13: line deduplication, DataFrame functions only.

Lines are normalised (blanks stripped at both ends, A-Z lower-cased), exploded
and hashed; the distinct documents that hold a hash are counted, and a line that
more documents hold than the limit allows is dropped everywhere but in the
smallest document. What is left is put together again in order of position.

A document never leaves its row: only hashes and positions are shuffled, and the
positions to drop come back to the texts as one array per row. Copies of a line
within a task and within a document are summed before the shuffle, so a line
that a third of all documents hold is one row for each task. Lines are told
apart by 128 bits of hash.

Defined cases: a null or empty text is one empty line; rows with the same id are
one document (a line that only they hold stays in all of them) and each gives a
result row; a null id is a document of its own that comes after all others; an
empty table gives an empty result; texts are read whole at any length; other
columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: Fixed value: the characters [\x20\x09-\x0D], stripped at both ends of a line.
BLANKS = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Limits:
    """A line of at least `min_chars` code points may stand in `max_documents` documents;
    beyond that only the document with the smallest id keeps it."""

    min_chars: int = 10
    max_documents: int = 1


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """The normalised line."""
    return F.translate(F.btrim(line, F.lit(BLANKS)), _UPPER, _LOWER)


def _hashes(value: Column) -> Column:
    return F.struct(F.xxhash64(value).alias("a"), F.xxhash64(F.lit(13), value).alias("b"))


def line_hashes(docs: DataFrame, id_col: str, text_col: str, limits: Limits) -> DataFrame:
    """(id, text_hash, position, line_hash) of every line that is long enough."""
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("id"), _hashes(F.coalesce(text, F.lit(""))).alias("text_hash"),
                       F.posexplode(_lines(text)).alias("position", "line"))
    keyed = rows.select("id", "text_hash", "position", line_key(F.col("line")).alias("key"))
    return keyed.filter(F.length("key") >= limits.min_chars).select(
        "id", "text_hash", "position", _hashes(F.col("key")).alias("line_hash"))


def frequent_lines(lines: DataFrame, limits: Limits) -> DataFrame:
    """(line_hash, documents, first_id) of the lines that more documents hold than allowed; first_id may be null."""
    return (lines.select("line_hash", "id").distinct().groupBy("line_hash")
            .agg(F.count(F.lit(1)).alias("documents"), F.min("id").alias("first_id"))
            .filter(F.col("documents") > limits.max_documents))


def dedup_lines(spark: SparkSession, docs: DataFrame, limits: Limits = Limits(), id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """Per row of `docs`: id, n_lines, n_dropped and kept_text.

    The line hashes, the frequent ones and the positions to drop are written to
    the shared scratch folder, so each later join has shuffles of its own, which
    adaptive execution may split, and lost executors repeat one step only."""
    def written(frame: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, name)
        frame.write.parquet(path)
        return spark.read.parquet(path)

    lines = written(line_hashes(docs, id_col, text_col, limits), "line-hashes")
    frequent = written(frequent_lines(lines, limits), "frequent-lines")
    # With a null id the document comes last, so any document with an id keeps the line instead.
    elsewhere = F.when(F.col("id").isNull(), F.col("first_id").isNotNull()).otherwise(F.col("first_id") < F.col("id"))
    drops = (lines.join(frequent.select("line_hash", "first_id"), "line_hash").filter(elsewhere)
             .select("id", "text_hash", "position").distinct())
    # Equal rows have equal positions; one array serves them all.
    drops = written(drops.groupBy("id", "text_hash").agg(F.collect_list("position").alias("drop")), "dropped-positions")
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("id"), _hashes(F.coalesce(text, F.lit(""))).alias("text_hash"),
                       _lines(text).alias("lines"))
    d = drops.select(F.col("id").alias("d_id"), F.col("text_hash").alias("d_hash"), "drop")
    joined = rows.join(d, F.col("id").eqNullSafe(F.col("d_id")) & (F.col("text_hash") == F.col("d_hash")), "left")
    # A difference of sets of positions: linear in the lines, and in order.
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("drop"))
    kept = F.array_join(F.transform(left, lambda i: F.get("lines", i)), "\n")
    untouched = F.col("drop").isNull()
    return joined.select(
        F.col("id").alias(id_col), F.size("lines").cast("long").alias("n_lines"),
        F.when(untouched, F.lit(0)).otherwise(F.size("drop")).cast("long").alias("n_dropped"),
        F.when(untouched, F.array_join("lines", "\n")).otherwise(kept).alias("kept_text"))


def digest(result: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The result with the text's SHA-256 in its place."""
    return result.select(id_col, "n_lines", "n_dropped", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))


#: The same result in SQL (DuckDB).
SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT r, doc_id, unnest(range(len(ls))) AS pos, unnest(ls) AS line FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key, min(doc_id) AS first_id FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
m AS (SELECT k.*, f.first_id IS NOT NULL AND f.first_id < k.doc_id AS dropped FROM k LEFT JOIN f ON k.key = f.key)
SELECT min(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM m GROUP BY r
"""
