"""Operator 11: ranked lexical search with bag deduplication.

Every query item is ranked against all documents. Documents are restricted to
the vocabulary of the items; documents with the same term frequencies over that
vocabulary and the same length factor m score alike for every item, so they form
a class: classes are hashed and grouped by their full vectors (the verification),
scored once, and the best classes expanded to their members by ascending id.

Items are taken in blocks of bounded text, each a pass over the documents, so
that vocabulary, weights and postings of a block fit into a task. Statistics
(documents, terms, document frequencies) cover all rows, whatever the block.

Terms are the maximal runs of ASCII letters and digits and of all other code
points from U+0080 on; only A-Z are lower-cased. With N documents that hold a
term, L terms in all, n terms of a document, df documents of a term and tf
occurrences in a document: w = floor(1000 ln((2N+2)/(2df+1))),
m = 50 + (50 n N) div L, and the score sums w ((10^9 tf) div (1000 tf + 20 m)).

Defined cases: a null or empty text has no terms and is never found; repeated
rows are documents of their own, each with a rank; null ids come after all
others among equal scores; items without terms, or with terms that no document
holds, have no results, and repeated item rows have equal results each under
its own row (null item ids too); an empty table gives an empty result; texts are
read whole; other columns are not read. Document ids are integers.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from . import arrays as A

_TERM = np.zeros(256, bool)
_TERM[48:58] = _TERM[65:91] = _TERM[97:123] = _TERM[128:] = True
#: Stands for a null id: after all others.
_LAST = 2**63 - 1


@dataclass(frozen=True)
class Settings:
    """`top`: results for an item. `block_bytes`, `block_items`: bounds of one block of items (a larger item is a
    block of its own); each block is a pass over the documents. `work_bytes`: bound of a task's score matrices."""

    top: int = 50
    block_bytes: int = 1 << 21
    block_items: int = 5000
    work_bytes: int = 1 << 24


def terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the terms, and their bounds by document."""
    none = np.zeros(0, np.int64)
    if not len(data):
        return none, none, np.zeros(len(offsets), np.int64)
    held = _TERM[data]
    begin, finish = held.copy(), held.copy()
    begin[1:] &= ~held[:-1]
    finish[:-1] &= ~held[1:]
    first, last = offsets[:-1][offsets[:-1] < len(data)], offsets[1:][offsets[1:] > 0] - 1
    begin[first], finish[last] = held[first], held[last]
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(finish) + 1, np.searchsorted(starts, offsets)


@dataclass
class Vocabulary:
    """The distinct terms of a block of items: their bytes, sorted by hash, and each item's terms."""

    hashes: np.ndarray
    data: np.ndarray
    bounds: np.ndarray
    item_terms: np.ndarray
    item_bounds: np.ndarray

    @staticmethod
    def of(texts: list[str | None]) -> Vocabulary:
        raw = [(t or "").encode() for t in texts]
        offsets = np.cumsum([0, *map(len, raw)]).astype(np.int64)
        data = A.LOWER[np.frombuffer(b"".join(raw), np.uint8)]
        starts, ends, bounds = terms(data, offsets)
        words = [data[s:e].tobytes() for s, e in zip(starts.tolist(), ends.tolist())]
        distinct = sorted(set(words))
        flat, vb = np.frombuffer(b"".join(distinct), np.uint8), np.cumsum([0, *map(len, distinct)]).astype(np.int64)
        h = A.range_hashes(A.prefix_sums(A.byte_codes(flat)), vb[:-1], vb[1:])
        if len(np.unique(h)) < len(h):
            raise ValueError("two terms of a block have one hash; take smaller blocks")
        order = np.argsort(h)
        number = {distinct[k]: i for i, k in enumerate(order.tolist())}
        item_of = A.segments_of(bounds)
        pairs = np.unique(np.array([item_of, [number[w] for w in words]], np.int64).reshape(2, -1).T, axis=0)
        length = np.diff(vb)[order]
        new = np.concatenate([[0], np.cumsum(length)]).astype(np.int64)
        at = np.repeat(vb[:-1][order], length) + np.arange(new[-1]) - np.repeat(new[:-1], length)
        return Vocabulary(h[order], flat[at], new, pairs[:, 1], np.searchsorted(pairs[:, 0], np.arange(len(texts) + 1)))

    def find(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The number of each range's term, or -1. Equal hashes are confirmed byte by byte."""
        if not len(self.hashes) or not len(starts):
            return np.full(len(starts), -1, np.int64)
        h = A.range_hashes(A.prefix_sums(A.byte_codes(data)), starts, ends)
        k = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        n = ends - starts
        found = (self.hashes[k] == h) & (np.diff(self.bounds)[k] == n)
        hit = np.flatnonzero(found)
        step = np.arange(n[hit].sum()) - np.repeat(np.cumsum(n[hit]) - n[hit], n[hit])
        same = data[np.repeat(starts[hit], n[hit]) + step] == self.data[np.repeat(self.bounds[k[hit]], n[hit]) + step]
        wrong = np.add.reduceat(~same, np.cumsum(n[hit]) - n[hit]) > 0 if len(hit) else np.zeros(0, bool)
        found[hit[wrong]] = False
        return np.where(found, k, -1)


def _vectors(vocabulary: Vocabulary):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = max(1, len(vocabulary.hashes))
        for rows, data, offsets in A.text_batches(batches):
            data = A.LOWER[data]
            starts, ends, bounds = terms(data, offsets)
            number = vocabulary.find(data, starts, ends)
            hit = number >= 0
            key, tf = np.unique(A.segments_of(bounds)[hit] * size + number[hit], return_counts=True)
            split = np.searchsorted(key, np.arange(len(offsets)) * size)
            yield A.batch_of(id=rows.column("id"), n=np.diff(bounds).astype(np.int64),
                             terms=A.list_array((key % size).astype(np.int32), split),
                             counts=A.list_array(tf.astype(np.int32), split))

    return run


def _best(vocabulary: Vocabulary, weights: np.ndarray, settings: Settings):
    """Scores classes and keeps each item's best ones of the task, by score and then by the smallest id."""
    n_items, top = len(vocabulary.item_bounds) - 1, settings.top
    item_of = np.repeat(np.arange(n_items), np.diff(vocabulary.item_bounds))

    def scores(m: np.ndarray, bounds: np.ndarray, term: np.ndarray, tf: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(first item, scores [item, class]) of runs of items, in 64-bit integers."""
        present, column = np.unique(term, return_inverse=True)
        value = np.zeros((len(present), len(m)), np.int64)
        row = A.segments_of(bounds)
        tf = tf.astype(np.int64)
        value[column, row] = weights[term] * ((10**9 * tf) // (1000 * tf + 20 * m[row]))
        at = np.searchsorted(present, vocabulary.item_terms)
        held = np.flatnonzero(present[np.minimum(at, len(present) - 1)] == vocabulary.item_terms)
        items = item_of[held]
        step = max(1, settings.work_bytes // (8 * len(m)))
        first = 0
        while first < len(held):
            # Whole items: up to `step` terms, or one item.
            last = first + step
            end = len(held) if last >= len(held) else int(np.searchsorted(items, items[last]))
            if end <= first:
                end = int(np.searchsorted(items, items[first], "right"))
            found, begin = np.unique(items[first:end], return_index=True)
            yield found, np.add.reduceat(value[at[held[first:end]]], begin, axis=0)
            first = end

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = {k: np.zeros(0, np.int64) for k in ("item", "score", "first", "a", "b")}
        least = np.zeros(n_items, np.int64)  # a class must score this much to matter

        def prune() -> None:
            order = np.lexsort((kept["first"], -kept["score"], kept["item"]))
            item = kept["item"][order]
            place = np.arange(len(item)) - np.searchsorted(item, item)
            order = order[place < top]
            for k in kept:
                kept[k] = kept[k][order]
            full = np.bincount(kept["item"], minlength=n_items) >= top
            ends = np.searchsorted(kept["item"], np.arange(n_items), "right") - 1
            least[full] = kept["score"][ends[full]]

        for batch in batches:
            lists, tfs = batch.column("terms"), batch.column("counts")
            bounds = lists.offsets.to_numpy().astype(np.int64)
            term, tf = lists.values.to_numpy(), tfs.values.to_numpy()
            m, first = batch.column("m").to_numpy(), batch.column("first").to_numpy()
            a, b = batch.column("a").to_numpy(), batch.column("b").to_numpy()
            i, n = 0, batch.num_rows
            while i < n:
                # As many classes as fit into the work space with the terms that they hold.
                entries = np.minimum(bounds[i + 1:n + 1] - bounds[i], len(weights)) * np.arange(1, n - i + 1)
                j = i + max(1, int(np.searchsorted(entries, settings.work_bytes // 8, "right")))
                if bounds[j] > bounds[i]:
                    for items, s in scores(m[i:j], bounds[i:j + 1] - bounds[i], term[bounds[i]:bounds[j]], tf[bounds[i]:bounds[j]]):
                        row, col = np.nonzero((s >= np.maximum(least[items], 1)[:, None]))
                        new = {"item": items[row], "score": s[row, col], "first": first[i + col], "a": a[i + col], "b": b[i + col]}
                        for k in kept:
                            kept[k] = np.concatenate([kept[k], new[k]])
                        if len(kept["item"]) > 4 * top * n_items:
                            prune()
                i = j
        prune()
        if len(kept["item"]):
            yield A.batch_of(**kept)

    return run


def _blocks(items: DataFrame, item_col: str, text_col: str, settings: Settings) -> Iterator[tuple[list, list[str | None]]]:
    """The items in blocks, one in memory at a time; the order is that of the written table's partitions."""
    ids, texts, size = [], [], 0
    for row in items.select(F.col(item_col).alias("i"), F.col(text_col).cast("string").alias("t")).toLocalIterator():
        n = len((row["t"] or "").encode())
        if ids and (size + n > settings.block_bytes or len(ids) >= settings.block_items):
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(row["i"])
        texts.append(row["t"])
        size += n
    if ids:
        yield ids, texts


def search(spark: SparkSession, docs: DataFrame, items: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id",
           text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(item, rank, id, score): the best documents of every item, rank from 1 by score and then by ascending id."""
    kind = items.schema[item_col].dataType
    found = [_search_block(spark, docs, ids, texts, kind, settings, id_col, text_col, item_col)
             for ids, texts in _blocks(items, item_col, item_text_col, settings)]
    if not found:
        return spark.createDataFrame([], f"{item_col} {kind.simpleString()}, rank int, {id_col} bigint, score bigint")
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def _search_block(spark: SparkSession, docs: DataFrame, ids: list, texts: list[str | None], kind, settings: Settings,
                  id_col: str, text_col: str, item_col: str) -> DataFrame:
    """One block of items against all documents; the result is written."""
    def written(frame: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, name)
        frame.write.parquet(path)
        return spark.read.parquet(path)

    vocabulary = Vocabulary.of(texts)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    scanned = written(rows.mapInArrow(_vectors(vocabulary), "id long, n long, terms array<int>, counts array<int>"), "bags")
    total = scanned.filter("n > 0").agg(F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    n_docs, n_terms = int(total["docs"]), int(total["terms"])

    # Classes: rows without a term of the items score 0 for all of them. The hash names a class in the
    # later steps; the grouping itself compares the whole vectors.
    key = ["a", "b", "m", "terms", "counts"]
    bags = scanned.filter(F.size("terms") > 0).withColumn("m", F.expr(f"50L + (50L * n * {n_docs}L) div {max(1, n_terms)}L"))
    bags = bags.select("id", F.xxhash64("m", "terms", "counts").alias("a"),
                       F.xxhash64(F.lit(11), "counts", "terms", "m").alias("b"), "m", "terms", "counts")
    classes = written(bags.groupBy(*key).agg(F.coalesce(F.min("id"), F.lit(_LAST)).alias("first"),
                                             F.count(F.lit(1)).alias("members")), "bag-classes")
    df = np.zeros(max(1, len(vocabulary.hashes)), np.int64)
    for row in classes.select(F.explode("terms").alias("t"), "members").groupBy("t").agg(F.sum("members").alias("df")).collect():
        df[row["t"]] = row["df"]  # as many rows as the block has terms
    weights = np.floor(1000 * np.log((2.0 * n_docs + 2) / (2.0 * df + 1))).astype(np.int64)

    best = classes.select("a", "b", "m", "terms", "counts", "first").mapInArrow(
        _best(vocabulary, weights, settings), "item long, score long, first long, a long, b long")
    by_item = Window.partitionBy("item").orderBy(F.desc("score"), "first", "a", "b")
    best = written(best.withColumn("place", F.row_number().over(by_item)).filter(F.col("place") <= settings.top)
                   .select("item", "score", "first", "a", "b"), "best-classes")
    # Members of the best classes: at most `top` classes an item, so their names are bounded by the block.
    names = best.select("a", "b").distinct()
    wanted = classes.join(F.broadcast(best.select("a", "b", "first").distinct()), ["a", "b", "first"], "left_semi").select(*key, "first")
    members = bags.join(F.broadcast(names), ["a", "b"], "left_semi")
    # No item needs more than `top` members of a class; salted, so that a class with a third of all rows is split.
    order = [F.col("id").isNull(), F.col("id")]
    salted = members.withColumn("salt", F.pmod(F.xxhash64("id", F.spark_partition_id()), F.lit(64)))
    for parts in ([*key, "salt"], key):
        place = F.row_number().over(Window.partitionBy(*parts).orderBy(*order))
        salted = salted.withColumn("place", place).filter(F.col("place") <= settings.top).drop("place")
    members = written(salted.join(wanted, key).select("a", "b", "first", "id"), "class-members")
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), *order))
    ranked = (best.join(members, ["a", "b", "first"]).withColumn("rank", rank).filter(F.col("rank") <= settings.top)
              .select("item", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score"))
    # The block's item ids, by number: bounded by the block.
    names = spark.createDataFrame([(k, i) for k, i in enumerate(ids)], f"item long, name {kind.simpleString()}")
    return written(ranked.join(F.broadcast(names), "item").select(F.col("name").alias(item_col), "rank", id_col, "score"),
                   "ranked-documents")


#: The same result in SQL (DuckDB).
SQL = r"""
WITH t AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
n AS (SELECT doc_id, count(*) AS n FROM t GROUP BY doc_id),
g AS (SELECT count(*) AS nd, CAST(sum(n) AS BIGINT) AS nt FROM n),
f AS (SELECT doc_id, term, count(*) AS tf FROM t WHERE term IN (SELECT term FROM q) GROUP BY doc_id, term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * df + 1))) AS BIGINT) AS w
      FROM (SELECT term, count(*) AS df FROM f GROUP BY term) x, g),
s AS (SELECT q.item_id, f.doc_id,
             CAST(sum(w.w * ((1000000000 * f.tf) // (1000 * f.tf + 20 * (100 - 50 + ((50 * n.n * g.nd) // g.nt))))) AS BIGINT) AS score
      FROM f JOIN w ON f.term = w.term JOIN n ON f.doc_id = n.doc_id JOIN q ON q.term = f.term, g GROUP BY q.item_id, f.doc_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 50
"""
