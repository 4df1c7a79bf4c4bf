"""Operator 5: scores of a log-bilinear language model.

The model predicts the next symbol from the two before it: their vectors go
through one matrix per position, and the sum's products with the target vectors
are the logits. Symbols are the text end, the most frequent words, and classes
of the other words by their last bytes; a word's probability within its class
comes from its count. The vectors are trained in numpy with noise-contrastive
estimation, each task on the rows of its partition from a common start, and the
tasks' models are averaged by their tokens. Scores use the exact sum over all
symbols, by batched matrix products, once for each context in a task.

Counts are taken over all training tokens. Only the `known_words` most frequent
words with their counts are broadcast (a fixed bound); the counts of the others
are joined to the documents that hold them.

Defined cases: a null text is an empty one (its only token is the end); without
training rows every count is 0 and the symbols are equally likely; repeated rows
give repeated result rows; texts are read whole; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import arrays as A


@dataclass(frozen=True)
class Settings:
    words: int = 640
    classes: int = 64
    known_words: int = 1 << 18
    size: int = 16
    noise: int = 32
    batch: int = 2048
    rate: float = 0.1
    start_rows: int = 2_000


#: The hash of the text end, and bytes of a word that give its class.
END, SUFFIX = np.uint64(1), 3


@dataclass
class Vocabulary:
    """known: sorted hashes with counts and symbols (-1: by class); class_total: count + types + 1 of each class."""
    known: np.ndarray
    counts: np.ndarray
    symbols: np.ndarray
    class_total: np.ndarray
    n_words: int
    tokens: int
    types: int
    unigram: np.ndarray


def tokens(data: np.ndarray, offsets: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token hashes with an end after each document, their classes (-1: end) and bounds by document."""
    data = A.LOWER[data]
    starts, ends, bounds = A.words(data, offsets)
    sums = A.prefix_sums(A.byte_codes(data))
    h = A.range_hashes(sums, starts, ends)
    tail = A.range_hashes(sums, np.maximum(starts, ends - SUFFIX), ends)
    n = len(bounds) - 1
    place = np.arange(len(h)) + A.segments_of(bounds)
    new = bounds + np.arange(n + 1)
    out, kind = np.full(len(h) + n, END, np.uint64), np.full(len(h) + n, -1, np.int64)
    out[place], kind[place] = h, (tail % np.uint64(classes)).astype(np.int64)
    return out, kind, new


def _lookup(h: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Index into the known words, and whether the word is among them."""
    if not len(v.known):
        return np.zeros(len(h), np.int64), np.zeros(len(h), bool)
    at = np.minimum(np.searchsorted(v.known, h), len(v.known) - 1)
    return at, v.known[at] == h


def symbols(h: np.ndarray, kind: np.ndarray, at: np.ndarray, is_known: np.ndarray, v: Vocabulary) -> np.ndarray:
    """0: end; 1 to n_words: frequent words; then the classes."""
    s = np.where(is_known, v.symbols[at] if len(v.known) else 0, -1)
    s = np.where((s < 0) & (kind >= 0), v.n_words + 1 + kind, s)
    return np.where(kind < 0, 0, s)


def contexts(s: np.ndarray, bounds: np.ndarray, none: int) -> tuple[np.ndarray, np.ndarray]:
    """The two symbols before each token; `none` before a document's first."""
    one, two = np.full(len(s), none), np.full(len(s), none)
    one[1:], two[2:] = s[:-1], s[:-2]
    first = bounds[:-1][bounds[:-1] < len(s)]
    one[first], two[first] = none, none
    second = first + 1
    second = second[second < len(s)]
    two[second] = none
    return one, two


class LogBilinear:
    """Context vectors r, target vectors q, biases b and a matrix per context position."""

    NAMES = ("r", "q", "b", "c1", "c2")

    def __init__(self, n: int, size: int, unigram: np.ndarray):
        rng = np.random.default_rng(5)
        self.r = rng.normal(0, 0.1, (n + 1, size)).astype(np.float32)
        self.q = rng.normal(0, 0.1, (n, size)).astype(np.float32)
        self.b = np.log(unigram).astype(np.float32)
        self.c1, self.c2 = np.eye(size, dtype=np.float32), 0.5 * np.eye(size, dtype=np.float32)

    def vector(self) -> np.ndarray:
        return np.concatenate([getattr(self, k).ravel() for k in self.NAMES]).astype(np.float64)

    def with_vector(self, v: np.ndarray) -> LogBilinear:
        i = 0
        for k in self.NAMES:
            old = getattr(self, k)
            setattr(self, k, v[i:i + old.size].reshape(old.shape).astype(np.float32))
            i += old.size
        return self

    def context(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        return self.r[one] @ self.c1 + self.r[two] @ self.c2

    def log_sums(self, one: np.ndarray, two: np.ndarray, block: int = 2048) -> np.ndarray:
        """log of the sum over all symbols of exp(logit), for each context."""
        out = np.zeros(len(one), np.float32)
        for i in range(0, len(one), block):
            logits = self.context(one[i:i + block], two[i:i + block]) @ self.q.T + self.b
            top = logits.max(1, keepdims=True)
            out[i:i + block] = np.log(np.exp(logits - top).sum(1)) + top[:, 0]
        return out

    def log_probabilities(self, target: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        return (self.context(one, two) * self.q[target]).sum(1) + self.b[target] - self.log_sums(one, two)


class Trainer:
    """Noise-contrastive estimation by AdaGrad; noise symbols are shared by a mini-batch."""

    def __init__(self, model: LogBilinear, unigram: np.ndarray, s: Settings, seed: int):
        self.m, self.s = model, s
        self.log_noise = np.log(unigram * s.noise).astype(np.float32)
        self.cumulative = np.cumsum(unigram)
        self.rng = np.random.default_rng(seed)
        self.squares = {k: np.full_like(getattr(model, k), 1e-2) for k in model.NAMES}

    def _update(self, name: str, gradient: np.ndarray) -> None:
        self.squares[name] += gradient * gradient
        array = getattr(self.m, name)
        array -= self.s.rate * gradient / np.sqrt(self.squares[name])

    def step(self, target: np.ndarray, one: np.ndarray, two: np.ndarray) -> None:
        m, n = self.m, len(target)
        noise = np.minimum(np.searchsorted(self.cumulative, self.rng.random(self.s.noise)), len(m.b) - 1)
        r1, r2 = m.r[one], m.r[two]
        q = r1 @ m.c1 + r2 @ m.c2
        up = (q * m.q[target]).sum(1) + m.b[target] - self.log_noise[target]
        down = q @ m.q[noise].T + m.b[noise] - self.log_noise[noise]
        g_up = (1 / (1 + np.exp(-up)) - 1) / np.float32(n)
        g_down = 1 / (1 + np.exp(-down)) / np.float32(n)
        # Sums by symbol as products with one column per symbol stay in matrix form.
        g_q, g_b, g_r = np.zeros_like(m.q), np.zeros_like(m.b), np.zeros_like(m.r)
        np.add.at(g_q, target, g_up[:, None] * q)
        np.add.at(g_q, noise, g_down.T @ q)
        g_b += np.bincount(target, weights=g_up, minlength=len(m.b)).astype(np.float32)
        np.add.at(g_b, noise, g_down.sum(0))
        g_v = g_up[:, None] * m.q[target] + g_down @ m.q[noise]
        np.add.at(g_r, one, g_v @ m.c1.T)
        np.add.at(g_r, two, g_v @ m.c2.T)
        g1, g2 = r1.T @ g_v, r2.T @ g_v
        for name, g in (("q", g_q), ("b", g_b), ("r", g_r), ("c1", g1), ("c2", g2)):
            self._update(name, g)

    def run(self, target: np.ndarray, one: np.ndarray, two: np.ndarray) -> None:
        for i in range(0, len(target), self.s.batch):
            self.step(target[i:i + self.s.batch], one[i:i + self.s.batch], two[i:i + self.s.batch])


def _symbol_stream(batches: Iterable[pa.RecordBatch], v: Vocabulary, s: Settings):
    for _, data, offsets in A.text_batches(batches):
        h, kind, bounds = tokens(data, offsets, s.classes)
        sym = symbols(h, kind, *_lookup(h, v), v)
        yield (sym, *contexts(sym, bounds, len(v.unigram)))


def _held(id_col: str) -> F.Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 7 == 2


def count_words(spark: SparkSession, texts: DataFrame, s: Settings) -> DataFrame:
    """(hash, class, n) of every distinct training token, written to the shared scratch folder."""
    def count(batches):
        for _, data, offsets in A.text_batches(batches):
            h, kind, _ = tokens(data, offsets, s.classes)
            distinct, index, n = np.unique(h, return_index=True, return_counts=True)
            yield A.batch_of(hash=distinct.view(np.int64), cls=kind[index].astype(np.int32), n=n)

    path = scratch_path(spark, "lm-counts")
    (texts.mapInArrow(count, "hash long, cls int, n long").groupBy("hash").agg(F.min("cls").alias("cls"), F.sum("n").alias("n"))
     .write.parquet(path))
    return spark.read.parquet(path)


def vocabulary(counts: DataFrame, s: Settings) -> Vocabulary:
    """The bounded part of the counts: the most frequent words, and sums by class."""
    total = counts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).first()
    known = (counts.orderBy(F.desc("n"), "hash").limit(s.known_words).toArrow() if total["v"] else None)
    h = known.column("hash").to_numpy().view(np.uint64) if known else np.zeros(0, np.uint64)
    n = known.column("n").to_numpy() if known else np.zeros(0, np.int64)
    cls = known.column("cls").to_numpy() if known else np.zeros(0, np.int32)
    order = np.lexsort([h, -n])
    h, n, cls = h[order], n[order], cls[order]
    sym = np.full(len(h), -1)
    words = np.flatnonzero(cls >= 0)[:s.words]
    sym[words], sym[cls < 0] = np.arange(1, len(words) + 1), 0
    classes = np.ones(s.classes)
    for r in counts.filter("cls >= 0").groupBy("cls").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect():
        classes[r["cls"]] += r["n"] + r["v"]
    np.subtract.at(classes, cls[words], n[words] + 1)
    unigram = np.concatenate([[n[sym == 0].sum() + 1.0], n[words] + 1.0, classes])
    order = np.argsort(h, kind="stable")
    return Vocabulary(h[order], n[order], sym[order], classes, len(words), int(total["n"] or 0), int(total["v"]),
                      unigram / unigram.sum())


def train(spark: SparkSession, texts: DataFrame, v: Vocabulary, s: Settings) -> LogBilinear:
    """A common start from about `start_rows` rows, then one pass over all rows and the average of the tasks' models."""
    model = LogBilinear(len(v.unigram), s.size, v.unigram)
    n_rows = texts.count()
    if not n_rows:
        return model
    share = min(1_000_000, 1_000_000 * s.start_rows // n_rows)

    def start(batches):
        for sym, one, two in _symbol_stream(batches, shared_v.value, s):
            yield A.batch_of(h=A.mix(sym[:1].astype(np.uint64)).view(np.int64),
                             sym=pa.array([sym.astype(np.int16)], pa.list_(pa.int16())),
                             one=pa.array([one.astype(np.int16)], pa.list_(pa.int16())),
                             two=pa.array([two.astype(np.int16)], pa.list_(pa.int16())))

    shared_v = spark.sparkContext.broadcast(v)
    sample = texts.filter(F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < share)
    got = sample.mapInArrow(start, "h long, sym array<short>, one array<short>, two array<short>").toArrow().to_pydict()
    trainer = Trainer(model, v.unigram, s, 1)
    for _, sym, one, two in sorted(zip(got["h"], got["sym"], got["one"], got["two"])):
        trainer.run(*(np.array(x, np.int64) for x in (sym, one, two)))

    def fit(batches):
        mine, n = LogBilinear(len(shared_v.value.unigram), s.size, shared_v.value.unigram).with_vector(common.value), 0
        own = Trainer(mine, shared_v.value.unigram, s, 2)
        for sym, one, two in _symbol_stream(batches, shared_v.value, s):
            own.run(sym, one, two)
            n += len(sym)
        if n:
            yield A.batch_of(model=pa.array([(mine.vector() * n).tobytes()], pa.binary()), n=[n])

    def add(batches):
        total, n = 0.0, 0
        for batch in batches:
            for model_bytes, k in zip(batch.column("model").to_pylist(), batch.column("n").to_pylist()):
                total, n = total + np.frombuffer(model_bytes), n + k
        if n:
            yield A.batch_of(model=pa.array([total.tobytes()], pa.binary()), n=[n])

    common = spark.sparkContext.broadcast(model.vector())
    parts = (texts.mapInArrow(fit, "model binary, n long").repartition(16).mapInArrow(add, "model binary, n long").collect())
    n = sum(p["n"] for p in parts)
    return model.with_vector(sum(np.frombuffer(p["model"]) for p in parts) / n)


def _score(batches: Iterable[pa.RecordBatch], model: LogBilinear, v: Vocabulary, s: Settings) -> Iterator[pa.RecordBatch]:
    n_sym = len(v.unigram)
    # One sum per context, filled as contexts occur; its size is fixed by the symbols.
    sums = np.full((n_sym + 1, n_sym + 1), np.nan, np.float32)
    log_class = np.log10(v.class_total)
    for batch, data, offsets in A.text_batches(batches):
        h, kind, bounds = tokens(data, offsets, s.classes)
        at, is_known = _lookup(h, v)
        sym = symbols(h, kind, at, is_known, v)
        one, two = contexts(sym, bounds, n_sym)
        new = np.unique((one * (n_sym + 1) + two)[np.isnan(sums[one, two])])
        sums[new // (n_sym + 1), new % (n_sym + 1)] = model.log_sums(new // (n_sym + 1), new % (n_sym + 1))
        logit = np.empty(len(sym))
        for i in range(0, len(sym), 1 << 15):
            j = slice(i, i + (1 << 15))
            logit[j] = (model.context(one[j], two[j]) * model.q[sym[j]]).sum(1) + model.b[sym[j]]
        score = (logit - sums[one, two]) / np.log(10)
        count = np.where(is_known, v.counts[at] if len(v.known) else 0, 0)
        log_count = np.log10(count + 1.0)
        by_class = sym > v.n_words
        score[by_class] += log_count[by_class] - log_class[sym[by_class] - v.n_words - 1]
        # Words beyond the known ones: their counts are joined later.
        doc = A.segments_of(bounds)
        rare = np.flatnonzero(~is_known)
        _, index, tf = np.unique(A.with_segment(h[rare], doc[rare]), return_index=True, return_counts=True)
        order = np.argsort(rare[index], kind="stable")
        which = rare[index][order]
        split = np.searchsorted(which, bounds).astype(np.int32)
        item = pa.StructArray.from_arrays([pa.array(h[which].view(np.int64)), pa.array(tf[order].astype(np.int32))], names=["hash", "tf"])
        yield A.batch_of(id=batch.column("id"), held_out=batch.column("held_out"), n_tokens=np.diff(bounds).astype(np.int64),
                         n_known=A.segment_sums(is_known, bounds), log_counts=A.segment_sums(log_count, bounds),
                         score=A.segment_sums(score, bounds), rare=pa.ListArray.from_arrays(pa.array(split), item))


def score(spark: SparkSession, docs: DataFrame, s: Settings = Settings(), id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """Per row: id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    rows = docs.select(F.col(id_col).alias("id"), _held(id_col).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    texts = rows.filter(~F.col("held_out")).select("text")
    counts = count_words(spark, texts, s)
    v = vocabulary(counts, s)
    model, shared_v = train(spark, texts, v, s), spark.sparkContext.broadcast(v)
    shared = spark.sparkContext.broadcast(model)
    kind, path = rows.schema["id"].dataType.simpleString(), scratch_path(spark, "lm-scores")
    rows.mapInArrow(lambda b: _score(b, shared.value, shared_v.value, s),
                    f"id {kind}, held_out boolean, n_tokens long, n_known long, log_counts double, score double, "
                    "rare array<struct<hash: bigint, tf: int>>").withColumn("row", F.monotonically_increasing_id()).write.parquet(path)
    scored = spark.read.parquet(path)
    rare = scored.select("row", F.explode("rare").alias("w")).select("row", "w.hash", "w.tf")
    more = (rare.join(counts.select("hash", "n"), "hash").groupBy("row")
            .agg(F.sum("tf").alias("more_known"), F.sum(F.col("tf") * F.log10(F.col("n") + 1.0)).alias("more_counts")))
    known, log_counts = (F.coalesce(c, F.lit(0)) for c in ("more_known", "more_counts"))
    all_types = float(np.log10(v.tokens + 1 * (v.types + 1)))
    return scored.drop("rare").join(more, "row", "left").select(
        F.col("id").alias(id_col), "held_out", "n_tokens", (F.col("n_known") + known).cast("long").alias("n_known"),
        F.lit(v.tokens).cast("long").alias("train_tokens"),
        (F.col("log_counts") + log_counts - F.col("n_tokens") * F.lit(all_types)).alias("base_score"),
        (F.col("score") + log_counts).alias("score"))
