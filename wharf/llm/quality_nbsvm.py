"""Operator 9: quality classifier with naive Bayes support vectors.

Indicators of word and character n-grams (hashed) are scaled by the log-count
ratio of the two classes; a linear hinge-loss model is fitted on them by dual
coordinate descent, and a logistic curve turns margins into scores.

Class counts are taken over all labelled training rows. The linear model is
fitted on a class-balanced sample of about `sample_rows` of them, chosen by a
hash of the id, which bounds the driver's work.

Defined cases: a null or empty text has no indicators and gets the score of the
intercept; without labels of both classes every score is the share of label 1 (0.5
without any label); null labels are not learned from; of several labels of one
id the smaller one counts; repeated rows give repeated result rows; texts are
read whole; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import arrays as A


@dataclass(frozen=True)
class Settings:
    buckets: int = 1 << 18
    characters: int = 3
    words: int = 2
    smoothing: float = 1.0
    cost: float = 0.1
    epochs: int = 20
    blend: float = 0.5
    sample_rows: int = 6_000


@dataclass
class Model:
    """weight: of each n-gram bucket; score = 1 / (1 + exp(-(slope * margin + shift)))."""
    weight: np.ndarray
    bias: float
    slope: float
    shift: float


#: Shares of words that repeat the word before: one indicator for each share that is exceeded.
REPEATS = (0.01, 0.03, 0.1, 0.2, 0.4, 0.7)


def indicators(data: np.ndarray, offsets: np.ndarray, s: Settings) -> Iterator[np.ndarray]:
    """The distinct n-gram buckets of each document of a flat batch.

    Beside the n-grams themselves, the pattern "a word twice" is an n-gram whatever the word."""
    mask = np.uint64(s.buckets - 1)
    starts, ends, bounds = A.words(data, offsets)
    sums = A.prefix_sums(A.byte_codes(data))
    h = A.range_hashes(sums, starts, ends)
    grams = [(h & mask, bounds)]
    for n in range(2, s.words + 1):
        g, b = A.shingles(h, bounds, n)
        grams.append((A.mix(g + np.uint64(n)) & mask, b))
    last = np.maximum(len(data) - s.characters + 1, 0)
    c = A.mix(A.range_hashes(sums, np.arange(last), np.arange(last) + s.characters) + np.uint64(99)) & mask
    doc = A.segments_of(bounds)
    again = np.bincount(doc[1:][(h[1:] == h[:-1]) & (doc[1:] == doc[:-1])], minlength=len(offsets) - 1)
    share = again / np.maximum(np.diff(bounds), 1)
    pattern = (A.mix(np.arange(len(REPEATS), dtype=np.uint64) + np.uint64(7777)) & mask).astype(np.int64)
    seen = np.zeros(s.buckets, bool)
    for i in range(len(offsets) - 1):
        for g, b in grams:
            seen[g[b[i]:b[i + 1]]] = True
        seen[c[offsets[i]:max(offsets[i], min(offsets[i + 1] - s.characters + 1, last))]] = True
        seen[pattern[share[i] > np.array(REPEATS)]] = True
        at = np.flatnonzero(seen)
        seen[at] = False
        yield at


def log_ratio(positive: np.ndarray, negative: np.ndarray, smoothing: float) -> np.ndarray:
    p, q = positive + smoothing, negative + smoothing
    return np.log(p / p.sum()) - np.log(q / q.sum())


def fit_hinge(rows: list[np.ndarray], sign: np.ndarray, ratio: np.ndarray, cost: float, epochs: int) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the L2-regularised hinge loss on ratio-scaled indicators."""
    w, bias, dual = np.zeros(len(ratio)), 0.0, np.zeros(len(rows))
    scale = [ratio[at] for at in rows]
    square = np.array([(x * x).sum() + 1 for x in scale])
    order = np.random.default_rng(1)
    for _ in range(epochs):
        moved = 0.0
        for i in order.permutation(len(rows)):
            at, x, y = rows[i], scale[i], sign[i]
            step = min(max(dual[i] - (y * (w[at] @ x + bias) - 1) / square[i], 0.0), cost) - dual[i]
            if step:
                dual[i] += step
                w[at] += step * y * x
                bias += step * y
                moved = max(moved, abs(step))
        if moved < 1e-4 * cost:
            break
    return w, bias


def fit_curve(margin: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Weighted logistic regression of the label on the margin, by Newton steps with a small ridge."""
    scale = margin.std() or 1.0
    x = np.stack([margin / scale, np.ones(len(margin))], 1)
    v = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ v, -30, 30)))
        g = x.T @ (weight * (p - label)) + 1e-3 * v
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), g)
        v -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return max(v[0], 0.0) / scale, v[1]


def _held(col: F.Column) -> F.Column:
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame, label_col: str, id_col: str = "doc_id",
          text_col: str = "text", s: Settings = Settings()) -> Model:
    """Learn from labelled rows whose id has another crc32 remainder than 0 modulo 5."""
    target = (labels.select(F.col(id_col).alias("l_id"), F.col(label_col).cast("int").alias("y"))
              .filter(F.col("y").isin(0, 1) & F.col("l_id").isNotNull() & ~_held(F.col("l_id")))
              .groupBy("l_id").agg(F.min("y").alias("y")))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).filter(~_held(F.col("id")))
    size = {r["y"]: r["count"] for r in target.groupBy("y").count().collect()}
    if len(size) < 2:
        share = next(iter(size), 0.5)
        return Model(np.zeros(s.buckets), 0.0, 0.0, {0: -30.0, 1: 30.0}.get(share, 0.0))

    def counts(batches):
        total = np.zeros((2, s.buckets), np.int64)
        for batch, data, offsets in A.text_batches(batches):
            for y, at in zip(batch.column("y").to_pylist(), indicators(data, offsets, s)):
                total[y, at] += 1
        at = np.flatnonzero(total.any(0))
        yield A.batch_of(bucket=at, n0=total[0, at], n1=total[1, at])

    # Labels grow with the documents, so both sides are shuffled at every size.
    joined = rows.join(target.hint("merge"), F.col("id") == F.col("l_id"))
    got = (joined.select("text", "y").mapInArrow(counts, "bucket long, n0 long, n1 long")
           .groupBy("bucket").agg(F.sum("n0"), F.sum("n1")).toArrow())
    total = np.zeros((2, s.buckets))
    for y in (0, 1):
        total[y, got.column(0).to_numpy()] = got.column(1 + y).to_numpy()
    ratio = log_ratio(total[1], total[0], s.smoothing)

    part = {y: min(1.0, s.sample_rows / 2 / n) for y, n in size.items()}
    pick = F.pmod(F.xxhash64("l_id"), F.lit(1_000_000))
    chosen = target.filter(pick < F.when(F.col("y") == 1, int(1e6 * part[1])).otherwise(int(1e6 * part[0])))

    def features(batches):
        for batch, data, offsets in A.text_batches(batches):
            found = [at.astype(np.int32) for at in indicators(data, offsets, s)]
            yield A.batch_of(id=batch.column("id"), y=batch.column("y"), at=pa.array(found, pa.list_(pa.int32())))

    # The sample has a fixed bound (ids and labels of about `sample_rows` rows), so it is broadcast.
    table = (rows.join(F.broadcast(chosen), F.col("id") == F.col("l_id")).select(F.xxhash64("id").alias("id"), "y", "text")
             .mapInArrow(features, "id long, y int, at array<int>").toArrow())
    order = np.argsort(table.column("id").to_numpy(), kind="stable")
    y = table.column("y").to_numpy()[order]
    lists = table.column("at").combine_chunks()
    grams = [lists[i].values.to_numpy() for i in order.tolist()]
    cut = max(1, len(grams) * 4 // 5)
    w, bias = fit_hinge(grams[:cut], np.where(y[:cut] == 1, 1.0, -1.0), ratio, s.cost, s.epochs)
    w = s.blend * w + (1 - s.blend) * np.abs(w).mean()
    weight = (w * ratio).astype(np.float32)
    margin = np.array([weight[at].sum() + bias for at in grams[cut:]], np.float64)
    # The sample is balanced; each row counts for as many as its class has in all labels.
    slope, shift = fit_curve(margin, y[cut:], np.where(y[cut:] == 1, 1 / part[1], 1 / part[0])) if len(margin) else (1.0, 0.0)
    return Model(weight, float(bias), float(slope), float(shift))


def _score(batches: Iterable[pa.RecordBatch], model: Model, s: Settings) -> Iterator[pa.RecordBatch]:
    for batch, data, offsets in A.text_batches(batches):
        margin = np.array([model.weight[at].sum() for at in indicators(data, offsets, s)], np.float64) + model.bias
        score = 1 / (1 + np.exp(-np.clip(model.slope * margin + model.shift, -60, 60)))
        yield A.batch_of(id=batch.column("id"), held_out=batch.column("held_out"), score=score)


def score(spark: SparkSession, docs: DataFrame, model: Model, threshold: float = 0.3, id_col: str = "doc_id",
          text_col: str = "text", s: Settings = Settings()) -> DataFrame:
    """Per row: id, held_out, score, predicted (1 from `threshold` on). The model has a fixed size and is broadcast."""
    shared = spark.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).alias("id"), _held(F.col(id_col)).alias("held_out"),
                       F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(lambda b: _score(b, shared.value, s), f"id {kind}, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int")).withColumnRenamed("id", id_col)
