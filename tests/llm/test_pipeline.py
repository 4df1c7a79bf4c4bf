"""The registered queries on the smallest tables, and the pipeline's stages against plain forms."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from tests.conftest import SF_CHECK, SF_SMALL
from tests.llm import brute
from wharf.llm import decontaminate
from wharf.llm.queries import QUERIES
from wharf.session import ship_package


def test_every_query_is_registered():
    assert set(QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())
    assert [n.split("_")[0] for n in QUERIES] == [f"op{k}" for k in range(1, 14)]


#: Queries whose rows are no documents: benchmark hits, ranks of an item, phrases of a language.
OTHER_ROWS = {"op2_decontaminate", "op11_ranked_search", "op12_phrases"}


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in OTHER_ROWS])
def test_query_returns_every_document_once(spark, name):
    out = QUERIES[name](spark, SF_SMALL)
    ids = Counter(r["doc_id"] for r in out.select("doc_id").collect())
    assert ids == Counter(r["doc_id"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id").collect())


@pytest.mark.parametrize("name, key, top", [("op11_ranked_search", "item_id", 50), ("op12_phrases", "lang", 2000)])
def test_query_returns_ranks_without_gaps(spark, name, key, top):
    ranks = {}
    for r in QUERIES[name](spark, SF_CHECK).select(key, "rank").collect():
        ranks.setdefault(r[key], []).append(r["rank"])
    assert ranks and all(sorted(v) == list(range(1, len(v) + 1)) and len(v) <= top for v in ranks.values())


def test_pipeline_stages(spark):
    ship_package(spark)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    odd = [(None, "a null id with " + "many good words " * 3 + " ".join(map(str, range(60))), None, None, None),
           (9001, None, "en", "s", None), (9002, "", "en", "s", 0)]
    docs = docs.unionByName(spark.createDataFrame(odd * 2, docs.schema)).withColumn("key", F.lit("k")).withColumn("row", F.lit(1))
    columns = docs.columns
    before = [r.asDict() for r in docs.collect()]
    after = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_SMALL)
        rows = [r.asDict() for r in out.collect()]
        if name == "quality rules":
            stats = [brute.line_stats(r["text"]) for r in before]
            good = [r for r, s in zip(before, stats) if s[0] >= 50 and 100 * s[4] <= 50 * s[0]]
            assert Counter(r["doc_id"] for r in rows) <= Counter(r["doc_id"] for r in good) and len(rows) > 0.9 * len(good)
        elif name == "near-duplicates":
            # Rows without an id come last; equal rows are one document.
            distinct = {(r["doc_id"] if r["doc_id"] is not None else 10**9, r["text"]) for r in before}
            groups = brute.components(sorted(distinct), 5)
            assert sorted(r["doc_id"] if r["doc_id"] is not None else 10**9 for r in rows) == sorted(set(groups))
        elif name == "decontamination":
            bench = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
            found = {r["doc_id"] for r in decontaminate.contaminated(spark, docs.select("doc_id", "text"), bench).collect()}
            assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in before} - found and found
        elif name == "secret scans":
            assert len(rows) == len(before) and not any(brute.secrets(r["text"].replace("[SECRET]", " ")) for r in rows)
            same = {r["doc_id"]: r["text"] for r in before}
            assert all(r["text"] == same[r["doc_id"]] for r in rows if not brute.secrets(same[r["doc_id"]]))
        else:
            assert all(len(r["ids"]) == r["n_tokens"] for r in rows) and len(rows) == len(before)
            after = rows
            break
        assert out.columns == columns
        docs = spark.createDataFrame(out.collect(), out.schema)
        before = rows
    assert after
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, SF_SMALL).collect()} == {r["doc_id"] for r in after} - {None}


def test_stages_accept_empty_tables(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").filter("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF_SMALL).count() == 0


def test_large_groups_leave_one_document(spark):
    ship_package(spark)
    rng = random.Random(2)
    base = [f"w{rng.randint(0, 5000)}" for _ in range(120)]
    rows = [(i, " ".join(base), "en", "s", 0) for i in range(200)]
    rows += [(200 + i, " ".join(base[:50 + i % 60] + [f"e{i}"] + base[51 + i % 60:]), "en", "s", 0) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(6)
    kept = corpus_pipeline.near_duplicates(spark, corpus_pipeline.quality(spark, docs, SF_SMALL), SF_SMALL)
    assert [r["doc_id"] for r in kept.collect()] == [0]
