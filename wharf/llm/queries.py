"""The registered queries of the training-data operators.

Each applies its operator with production parameters to whole tables.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from ..session import ship_package
from ..sources.tables import load as _read
from . import (bag_search, bpe, credentials, decontaminate, langid, line_dedup, line_rules, lm_score, near_dup, phrases, pii,
               quality_nbsvm, suffix_dedup)


def op1_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of 2-word shingles have a similarity of 0.8 or more."""
    return near_dup.near_duplicates(spark, _read(spark, sf_dir, "documents")).drop("text_hash")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, with the item."""
    return decontaminate.contaminated(spark, _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What remains of every text without its repeated 400-byte strings."""
    return suffix_dedup.remove_repeats(spark, _read(spark, sf_dir, "documents"), with_text=False)


def op4_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base statistics and the verdict of the cross-document line rules."""
    return line_rules.quality_rules(spark, _read(spark, sf_dir, "documents")).drop("host", "text_hash")


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probability of every text under the log-bilinear model."""
    return lm_score.score(spark, _read(spark, sf_dir, "documents"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every text's token ids and decoded text."""
    import public_tokenizers

    return bpe.encode(spark, _read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), with_ids=False)


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every text: base spans, and those that the trained classifier adds."""
    docs = _read(spark, sf_dir, "documents")
    return pii.find(spark, docs, pii.train(docs))


def op8_credentials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every text: base spans, and weak parts of linked credentials."""
    return credentials.scan(_read(spark, sf_dir, "documents")).drop("span_list")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every text, learnt from `labels.quality`."""
    docs = _read(spark, sf_dir, "documents")
    model = quality_nbsvm.train(spark, docs, _read(spark, sf_dir, "labels"), "quality")
    return quality_nbsvm.score(spark, docs, model)


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every text, learnt from `lang`."""
    docs = _read(spark, sf_dir, "documents")
    return langid.identify(spark, docs, langid.train(spark, docs))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of every benchmark item."""
    return bag_search.search(spark, _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 strongest phrases of every language."""
    return phrases.collocations(spark, _read(spark, sf_dir, "documents"))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What remains of every text without the lines that earlier documents hold."""
    return line_dedup.digest(line_dedup.dedup_lines(spark, _read(spark, sf_dir, "documents")))


def _shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)

    return run


QUERIES = {f.__name__: _shipped(f) for f in (
    op1_near_dup, op2_decontaminate, op3_suffix_dedup, op4_line_rules, op5_lm_score, op6_bpe, op7_pii, op8_credentials,
    op9_quality, op10_language, op11_ranked_search, op12_phrases, op13_line_dedup)}
ORACLE: dict[str, str] = {"op11_ranked_search": bag_search.SQL, "op12_phrases": phrases.SQL, "op13_line_dedup": line_dedup.SQL}
