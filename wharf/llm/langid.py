"""Operator 10: language identification.

Sparse multinomial logistic regression on TF-IDF character n-grams, trained with
follow-the-regularised-leader (elastic net), then calibrated by a temperature.

Document frequencies are counted over all training rows. The weights are fitted
on a sample of about `sample_rows` of them, balanced over the languages and
chosen by a hash of id and text, so the driver's work has a fixed bound.

Defined cases: a null text and a text without a letter give `und` with score 0;
without any learned language every row is `und`; null languages are not learned
from; repeated rows give repeated result rows; texts of any length are read
whole; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import arrays as A

UNKNOWN = "und"


@dataclass(frozen=True)
class Settings:
    buckets: int = 1 << 16
    longest: int = 3
    sample_rows: int = 6_000
    epochs: int = 3
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.02
    min_documents: int = 2


@dataclass
class Model:
    """weights: buckets x languages; a text's probabilities are softmax(logits / temperature)."""
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    longest: int


_letters = np.zeros(0, bool)


def _letter_table() -> np.ndarray:
    global _letters
    if not len(_letters):
        _letters = np.array([chr(c).isalpha() for c in range(0x30000)])
    return _letters


def ngrams(text: str | None, longest: int, buckets: int) -> np.ndarray:
    """Buckets of the character n-grams (1 to `longest`) of the lower-cased text.

    Runs of other characters than letters count as one blank. Empty without a letter."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), np.uint32)
    table = _letter_table()
    letter = table[np.minimum(points, len(table) - 1)]
    if not letter.any():
        return np.zeros(0, np.int64)
    points = np.where(letter, points, 32)
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    points = np.concatenate([[32], points[keep], [32]]).astype(np.uint64)
    out, h = [], np.zeros(len(points), np.uint64)
    for n in range(1, longest + 1):
        if n > len(points):
            break
        h = h[:len(points) - n + 1] * np.uint64(0x100000001B3) + points[n - 1:]
        out.append(A.mix(h + np.uint64(n << 56)))
    return (np.concatenate(out) & np.uint64(buckets - 1)).astype(np.int64)


def tf_idf(text: str | None, idf: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """The text's buckets and their unit-length TF-IDF values (term frequency 1 + log count)."""
    counts = np.bincount(ngrams(text, longest, len(idf)), minlength=len(idf))
    at = np.flatnonzero(counts)
    values = (1 + np.log(counts[at])) * idf[at]
    length = np.sqrt((values * values).sum())
    return at, values / length if length else values


def _soft(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def fit_ftrl(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, n_labels: int, buckets: int,
             s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal with per-coordinate rates; returns (weights, bias)."""
    z, n = np.zeros((buckets + 1, n_labels)), np.zeros((buckets + 1, n_labels))

    def weights(at):
        zi = z[at]
        return np.where(np.abs(zi) <= s.l1, 0, -(zi - np.sign(zi) * s.l1) / ((s.beta + np.sqrt(n[at])) / s.alpha + s.l2))

    order = np.random.default_rng(1)
    for _ in range(s.epochs):
        for i in order.permutation(len(rows)):
            at, x = np.append(rows[i][0], buckets), np.append(rows[i][1], 1.0)
            w = weights(at)
            p = _soft(x @ w)
            p[labels[i]] -= 1
            g = x[:, None] * p
            old = n[at]
            new = old + g * g
            z[at] += g - (np.sqrt(new) - np.sqrt(old)) / s.alpha * w
            n[at] = new
    w = weights(np.arange(buckets + 1))
    return w[:-1], w[-1]


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least log loss, by a search over its logarithm."""
    if not len(labels):
        return 1.0
    grid = np.exp(np.linspace(np.log(0.02), np.log(5), 120))
    loss = [-np.log(np.maximum(_soft(logits / t)[np.arange(len(labels)), labels], 1e-300)).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def _held(id_col: str) -> F.Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def train(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang", s: Settings = Settings()) -> Model | None:
    """Learn from the rows whose id has another crc32 remainder than 0 modulo 5."""
    known = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"),
                        F.col(lang_col).cast("string").alias("lang")).filter(F.col("lang").isNotNull() & ~_held("id"))
    sizes = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}  # one row per language
    if not sizes:
        return None
    languages = sorted(sizes)

    def frequencies(batches):
        total, rows = np.zeros(s.buckets, np.int64), 0
        for batch in batches:
            for t in batch.column("text").to_pylist():
                g = ngrams(t, s.longest, s.buckets)
                if len(g):
                    total += np.bincount(g, minlength=s.buckets) > 0
                    rows += 1
        at = np.flatnonzero(total)
        yield A.batch_of(bucket=np.append(at, -1), n=np.append(total[at], rows))

    got = known.select("text").mapInArrow(frequencies, "bucket long, n long").groupBy("bucket").agg(F.sum("n")).toArrow()
    bucket, n = got.column(0).to_numpy(), got.column(1).to_numpy()
    idf, total = np.zeros(s.buckets), int(n[bucket == -1].sum())
    used = (bucket >= 0) & (n >= min(s.min_documents, total))
    idf[bucket[used]] = np.log((1 + total) / (1 + n[used])) + 1

    share = F.lit(0)
    for lang, size in sizes.items():
        share = F.when(F.col("lang") == lang, int(1_000_000 * min(1, s.sample_rows / len(sizes) / size))).otherwise(share)
    sample = known.filter(F.pmod(F.xxhash64("id", "text"), F.lit(1_000_000)) < share)
    shared = spark.sparkContext.broadcast(idf)

    def features(batches):
        for batch in batches:
            found = [tf_idf(t, shared.value, s.longest) for t in batch.column("text").to_pylist()]
            yield A.batch_of(lang=batch.column("lang"),
                             at=pa.array([f[0].astype(np.int32) for f in found], pa.list_(pa.int32())),
                             x=pa.array([f[1].astype(np.float32) for f in found], pa.list_(pa.float32())),
                             order=batch.column("order"))

    table = (sample.select("lang", "text", F.xxhash64("text", "id").alias("order"))
             .mapInArrow(features, "lang string, at array<int>, x array<float>, order long").toArrow())
    order = np.lexsort([np.array(table.column("lang").to_pylist()), table.column("order").to_numpy()])
    at, x = table.column("at").combine_chunks(), table.column("x").combine_chunks()
    names = {lang: k for k, lang in enumerate(languages)}
    labels = np.array([names[v] for v in table.column("lang").to_pylist()], np.int64)[order]
    rows = [(at[i].values.to_numpy(), x[i].values.to_numpy().astype(np.float64)) for i in order.tolist()]
    del table, at, x
    cut = max(1, len(rows) * 4 // 5)
    weights, bias = fit_ftrl(rows[:cut], labels[:cut], len(languages), s.buckets, s)
    logits = np.array([v @ weights[i] + bias for i, v in rows[cut:]]).reshape(-1, len(languages))
    return Model(languages, idf, weights, bias, fit_temperature(logits, labels[cut:]), s.longest)


def _predict(batches: Iterable[pa.RecordBatch], model: Model | None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs, scores = [], []
        for text in batch.column("text").to_pylist():
            at, x = tf_idf(text, model.idf, model.longest) if model else ((), ())
            lang, score = UNKNOWN, 0.0
            # A text with a letter is given a language even if none of its n-grams is known.
            if model and (len(at) or any(c.isalpha() for c in text or "")):
                p = _soft((x @ model.weights[at] + model.bias) / model.temperature)
                k = int(np.argmax(p))
                lang, score = model.languages[k], float(p[k])
            langs.append(lang)
            scores.append(score)
        yield A.batch_of(id=batch.column("id"), held_out=batch.column("held_out"),
                         lang_pred=pa.array(langs, pa.string()), score=pa.array(scores, pa.float64()))


def identify(spark: SparkSession, docs: DataFrame, model: Model | None, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """Per row: id, held_out, lang_pred, score. The model has a fixed size and is broadcast."""
    shared = spark.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).alias("id"), _held(id_col).alias("held_out"),
                       F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(lambda b: _predict(b, shared.value),
                          f"id {kind}, held_out boolean, lang_pred string, score double")
    return out.withColumnRenamed("id", id_col)
