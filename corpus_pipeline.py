"""A training-data pipeline over the `documents` table.

Quality rules, near-duplicate removal, benchmark decontamination, masking of
secrets, BPE encoding: each stage works on all rows that the one before kept.
All but the last return the columns of their input. Rows are told apart by their
content, so null and repeated ids, and extra columns of any name, are allowed.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wharf.llm import bpe, credentials, decontaminate, line_rules, near_dup
from wharf.session import scratch_path, ship_package
from wharf.sources.tables import load

#: Documents are near-duplicates from this similarity on, by shingles of five words.
NEAR = near_dup.Settings(shingle=5, percent=80)
VOCABULARY = "word_bpe_49k.json"


def _rows(docs: DataFrame, key: Column) -> DataFrame:
    """Each row as one struct beside its key, so that no column name can clash."""
    columns = [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]
    return docs.select(F.struct(*columns).alias("row"), key.alias("key"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    ship_package(spark)
    verdict = line_rules.quality_rules(spark, docs)
    # Rows of one text and host have one verdict.
    path = scratch_path(spark, "kept-texts")
    verdict.filter("kept").select(F.struct("host", "text_hash").alias("key")).distinct().write.parquet(path)
    # Written, so that the rows of a much copied text meet it in a join that adaptive execution may split.
    kept = spark.read.parquet(path)
    key = F.struct(F.col("source").cast("string").alias("host"), F.xxhash64(F.col("text").cast("string")).alias("text_hash"))
    return _rows(docs, key).join(kept, "key", "left_semi").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that with the smallest id.

    Rows without an id come after all others; fully equal rows are one document."""
    ship_package(spark)
    columns = [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), F.coalesce(F.col("doc_id"), F.lit(0)).alias("id"),
                   F.xxhash64(*columns).alias("row_hash"))
    found = near_dup.near_duplicates(spark, docs.select(key.alias("id"), "text"), NEAR, id_col="id")
    kept = found.filter("kept").select(F.col("id").alias("key")).distinct()
    return _rows(docs, key).join(kept, "key", "left_semi").dropDuplicates(["key"]).select("row.*")


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    ship_package(spark)
    key = F.xxhash64(F.col("text").cast("string"))
    found = decontaminate.contaminated(spark, docs.select(key.alias("id"), "text"), load(spark, sf_dir, "benchmark"), id_col="id")
    return _rows(docs, key).join(found.select(F.col("id").alias("key")).distinct(), "key", "left_anti").select("row.*")


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked in their texts (and n_chars of the new text)."""
    spans = credentials.span_lists(docs).select("key", "span_list")
    joined = _rows(docs, credentials.text_key()).join(spans, "key", "left")
    text = credentials.masked(F.col("row.text").cast("string"), F.col("span_list"))
    n_chars = F.when(F.col("span_list").isNull(), F.col("row.n_chars")).otherwise(F.length(text)).cast("long")
    return joined.select(F.col("row").withField("text", text).withField("n_chars", n_chars).alias("row")).select("row.*")


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the digests of ids and decoded text."""
    ship_package(spark)
    return bpe.encode(spark, docs, public_tokenizers.path(VOCABULARY)).drop("decoded")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality),
    ("near-duplicates", near_duplicates),
    ("decontamination", decontaminated),
    ("secret scans", without_secrets),
    ("BPE", encoded),
]

#: Stages use hashing, a search index and a tokenizer; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to `documents`; each result is written and read again by the next stage."""
    docs = load(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"pipeline-{k}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
