"""Operator 2: benchmark decontamination with a BM25 index and block-max WAND.

The test items are indexed; every training document is a series of passages
(windows that overlap by half), and each passage is a query. An item is
retrieved if its BM25 score reaches a share of the score that the item's own
text would get. Upper bounds skip the rest: first a passage's rare terms with
their greatest contribution to any item, then each block of items with the
greatest contribution in the block, and only then the items themselves. The
bounds are never below the score, so nothing above the threshold is lost.

Retrieved items are verified on word 5-grams: the passage must hold at least
80 % of the item's, and half of those of its question and of its answer (the
last sentence, where there are several). One changed word destroys five 5-grams,
too many of a short item; so an item is also verified if a stretch of the passage
becomes it by changing (replacing, leaving out or putting in) at most two words,
or one in items of five to nine words, and half of the words of its question and
of its answer stand. No such item is below the retrieval threshold.

The index is a stated query set: it is broadcast in blocks of at most
`block_bytes` of item text; more items take more passes over the documents.
Document frequencies, mean length and passage size are those of all items, so
the results do not depend on the blocks. The driver holds them (16 bytes a term).

Defined cases: null and empty texts have no passages, null and empty items are
no test items; items of fewer than five words are one gram; repeated document
rows give repeated result rows, equal items one row each; an empty table on
either side gives an empty result; very long texts are read whole; other
columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import arrays as A


@dataclass(frozen=True)
class Settings:
    k1: float = 1.2
    b: float = 0.75
    #: Share of an item's own score that a passage must reach to retrieve it.
    share: float = 0.5
    gram: int = 5
    overlap: float = 0.8
    part_overlap: float = 0.5
    #: Words of an item that may be changed, as far as `overlap` of its words are left.
    changed: int = 2
    #: Passages have twice as many words as the longest item, and this many at least.
    least_half: int = 64
    block_items: int = 16
    block_bytes: int = 8 << 20


_KEEP = np.ones(256, bool)
_KEEP[[b for b in range(33, 127) if not chr(b).isalnum()]] = False


def plain(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower case (ASCII and Latin-1 letters) without ASCII punctuation."""
    keep = _KEEP[data]
    offsets = np.concatenate([[0], np.cumsum(keep)])[offsets]
    data = A.LOWER[data[keep]]
    upper = np.flatnonzero((data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97) & (data[:-1] == 0xC3)) + 1
    data[upper] += 32
    return data, offsets


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = plain(data, offsets)
    starts, ends, bounds = A.words(data, offsets)
    return A.range_hashes(A.prefix_sums(A.byte_codes(data)), starts, ends), bounds


def _flat(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)


def _runs(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each run, one after another."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts - starts, counts)


@dataclass
class Totals:
    """What the scores and passages need of all items."""
    n: int = 0
    n_words: int = 0
    longest: int = 0
    terms: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    df: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    def with_items(self, texts: list[str]) -> Totals:
        h, bounds = word_hashes(*_flat(texts))
        length = np.diff(bounds)
        terms, term = np.unique(h, return_inverse=True)
        pair = np.unique(term * len(texts) + A.segments_of(bounds))
        all_terms, at = np.unique(np.concatenate([self.terms, terms]), return_inverse=True)
        df = np.zeros(len(all_terms), np.int64)
        np.add.at(df, at, np.concatenate([self.df, np.bincount(pair // len(texts), minlength=len(terms))]))
        return Totals(self.n + len(texts), self.n_words + int(length.sum()), max(self.longest, int(length.max())), all_terms, df)


class Index:
    """BM25 contributions relative to each item's threshold, by term and by (term, block of items)."""

    def __init__(self, ids: list, texts: list[str], s: Settings, totals: Totals | None = None):
        self.ids, self.s = ids, s
        totals = totals or Totals().with_items(texts)
        h, bounds = word_hashes(*_flat(texts))
        n, item, length = len(texts), A.segments_of(bounds), np.diff(bounds)
        self.terms, term = np.unique(h, return_inverse=True)
        pair, tf = np.unique(term * n + item, return_counts=True)
        t, i = pair // n, pair % n
        df = totals.df[np.searchsorted(totals.terms, self.terms)]
        idf = np.log(1 + (totals.n - df + 0.5) / (df + 0.5))
        weight = idf[t] * tf * (s.k1 + 1) / (tf + s.k1 * (1 - s.b + s.b * length[i] / max(totals.n_words / totals.n, 1)))
        # The changed words may be those with the greatest weights; one term is left at least.
        self.changed = np.minimum(s.changed, ((1 - s.overlap) * length + 1e-9).astype(np.int64))
        heavy = np.lexsort((-weight, i))
        rank = np.arange(len(i)) - np.searchsorted(i[heavy], i[heavy])
        gone = rank < self.changed[i[heavy]]
        whole, least = np.bincount(i, weights=weight, minlength=n), np.full(n, np.inf)
        np.minimum.at(least, i, weight)
        left = whole - np.bincount(i[heavy][gone], weights=weight[heavy][gone], minlength=n)
        self.threshold = np.minimum(s.share * whole, np.maximum(left, least))
        part = weight / self.threshold[i]
        # Postings by term, and the greatest part in each block of items.
        self.item, self.part, self.first = i, part, np.searchsorted(t, np.arange(len(self.terms) + 1))
        block = t * (n // s.block_items + 1) + i // s.block_items
        at = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]])) if len(block) else np.zeros(0, np.int64)
        self.block, self.block_part = i[at] // s.block_items, np.maximum.reduceat(part, at) if len(at) else part
        self.block_first = np.searchsorted(t[at], np.arange(len(self.terms) + 1))
        self.n_blocks = n // s.block_items + 1
        # Frequent terms are bounded together by the most that any item can get from them.
        self.rare = df * 8 <= totals.n
        common = np.bincount(i[~self.rare[t]], weights=part[~self.rare[t]], minlength=n)
        self.common = float(common.max()) if n else 0.0
        self.best = np.maximum.reduceat(part, self.first[:-1]) if len(part) else np.zeros(0)
        self.half = max(s.least_half, totals.longest + s.changed)
        self.filter = np.zeros(1 << 16, bool)
        self.filter[(self.terms & np.uint64(0xFFFF)).astype(np.int64)] = True
        grams, gb = A.shingles(h, bounds, s.gram)
        # Grams that end in the answer belong to the answer; it is the last of several sentences.
        self.grams = [grams[gb[k]:gb[k + 1]] for k in range(n)]
        self.words = [h[bounds[k]:bounds[k + 1]] for k in range(n)]
        self.question, self.n_asked = [], []
        for text, words, g in zip(texts, length, self.grams):
            answer = re.split(r"(?<=[.?!])\s+", text.strip())
            tail = np.diff(word_hashes(*_flat([answer[-1]]))[1])[0] if len(answer) > 1 else 0
            self.n_asked.append(words - tail)
            self.question.append(np.arange(len(g)) + min(s.gram, words) <= words - tail)

    def passages(self, term: np.ndarray, position: np.ndarray, doc: np.ndarray, n_words: np.ndarray):
        """(passage, term) once for each distinct indexed term, and the passages' bounds by document.

        Passage k of a document covers its halves k and k + 1."""
        halves = np.maximum(1, -(-n_words // self.half))
        first = np.concatenate([[0], np.cumsum(np.maximum(1, halves - 1))])
        order = np.argsort(doc * len(self.terms) + term, kind="stable")
        before = np.full(len(term), -1)
        same = (doc[order][1:] == doc[order][:-1]) & (term[order][1:] == term[order][:-1])
        before[order[1:][same]] = position[order[:-1][same]]
        half = position // self.half
        own = (half <= halves[doc] - 2) | (halves[doc] == 1)
        own &= before < half * self.half
        prior = (half >= 1) & (before < (half - 1) * self.half)
        passage = np.concatenate([first[doc[own]] + half[own], first[doc[prior]] + half[prior] - 1])
        return passage, np.concatenate([term[own], term[prior]]), first

    def retrieve(self, passage: np.ndarray, term: np.ndarray, n_passages: int):
        """(passage, item, score) of all pairs whose BM25 score reaches the item's threshold."""
        rare = self.rare[term]
        bound = np.bincount(passage[rare], weights=self.best[term[rare]], minlength=n_passages) + self.common
        open_ = bound >= 1 - 1e-9
        keep = open_[passage]
        number = np.cumsum(open_) - 1
        passage, term, real = number[passage[keep]], term[keep], np.flatnonzero(open_)
        if not len(passage):
            return (np.zeros(0, np.int64),) * 2 + (np.zeros(0),)
        n = self.block_first[term + 1] - self.block_first[term]
        at = _runs(self.block_first[term], n)
        key = np.repeat(passage, n) * self.n_blocks + self.block[at]
        alive = np.bincount(key, weights=self.block_part[at], minlength=len(real) * self.n_blocks) >= 1 - 1e-9
        n = self.first[term + 1] - self.first[term]
        at, who = _runs(self.first[term], n), np.repeat(passage, n)
        in_block = alive[who * self.n_blocks + self.item[at] // self.s.block_items]
        at, who = at[in_block], who[in_block]
        pair, inverse = np.unique(who * len(self.ids) + self.item[at], return_inverse=True)
        score = np.bincount(inverse, weights=self.part[at], minlength=len(pair))
        hit = score >= 1 - 1e-9
        item = pair[hit] % len(self.ids)
        return real[pair[hit] // len(self.ids)], item, score[hit] * self.threshold[item]


def _search(batches: Iterable[pa.RecordBatch], index: Index) -> Iterator[pa.RecordBatch]:
    s = index.s
    for batch, data, offsets in A.text_batches(batches, max_bytes=1 << 20):
        h, bounds = word_hashes(data, offsets)
        maybe = np.flatnonzero(index.filter[(h & np.uint64(0xFFFF)).astype(np.int64)])
        term = np.minimum(np.searchsorted(index.terms, h[maybe]), len(index.terms) - 1)
        known = index.terms[term] == h[maybe]
        at, term = maybe[known], term[known]
        doc = np.searchsorted(bounds, at, "right") - 1
        passage, terms, first = index.passages(term, at - bounds[doc], doc, np.diff(bounds))
        found: dict[tuple[int, int], list] = {}
        for p, item, score in zip(*index.retrieve(passage, terms, int(first[-1]))):
            d = int(np.searchsorted(first, p, "right")) - 1
            lo = bounds[d] + (p - first[d]) * index.half
            window = h[lo:min(lo + 2 * index.half, bounds[d + 1])]
            grams = index.grams[item]
            size = min(s.gram, len(grams) + s.gram - 1) if len(grams) > 1 else None
            have = A.shingles(window, np.array([0, len(window)]), size or s.gram)[0]
            hit, ask = np.isin(grams, have), index.question[item]
            if not size:
                hit = hit | _holds(window, index, item)
            parts = [float(hit[x].mean()) if x.any() else 1.0 for x in (ask, ~ask)]
            if (hit.mean() >= s.overlap and min(parts) >= s.part_overlap) or _nearly_holds(window, index, item):
                best = found.setdefault((d, int(item)), [0.0, 0.0, 0.0, 0])
                found[d, int(item)] = [max(best[0], float(score)), max(best[1], parts[0]), max(best[2], parts[1]), best[3] + 1]
        rows = sorted(found)
        yield A.batch_of(id=batch.column("id").take(pa.array([d for d, _ in rows], pa.int64())),
                         item=pa.array([index.ids[i] for _, i in rows], pa.int64()),
                         score=pa.array([found[r][0] for r in rows], pa.float64()),
                         question_overlap=pa.array([found[r][1] for r in rows], pa.float64()),
                         answer_overlap=pa.array([found[r][2] for r in rows], pa.float64()),
                         n_passages=pa.array([found[r][3] for r in rows], pa.int64()))


def _holds(window: np.ndarray, index: Index, item: int) -> np.ndarray:
    """Whether the window holds the single gram of an item of at most `gram` words."""
    return np.array([any(np.isin(index.grams[item], A.shingles(window, np.array([0, len(window)]), n)[0]).any()
                         for n in range(1, index.s.gram + 1))])


def _nearly_holds(window: np.ndarray, index: Index, item: int) -> bool:
    """Whether a stretch of the window is the item but for its changed words, with enough of question and answer."""
    words, n_asked, most = index.words[item], index.n_asked[item], int(index.changed[item])
    n, column = len(words), np.arange(len(window) + 1)
    if not most or np.isin(words, window).sum() < n - most:
        return False
    # Edits of the item's first i words against stretches of the window that end at each word.
    edits = np.zeros((n + 1, len(window) + 1), np.int64)
    for i in range(1, n + 1):
        row = edits[i - 1] + 1
        row[1:] = np.minimum(row[1:], edits[i - 1, :-1] + (window != words[i - 1]))
        edits[i] = np.minimum.accumulate(row - column) + column
    for j in np.flatnonzero(edits[n] <= most):
        i, stands = n, np.zeros(n, bool)
        while i and j:
            if edits[i, j] == edits[i - 1, j - 1] + (window[j - 1] != words[i - 1]):
                i, j = i - 1, j - 1
                stands[i] = window[j] == words[i]
            elif edits[i, j] == edits[i - 1, j] + 1:
                i -= 1
            else:
                j -= 1
        if all(x.mean() >= index.s.part_overlap for x in (stands[:n_asked], stands[n_asked:]) if len(x)):
            return True
    return False


def contaminated(spark: SparkSession, docs: DataFrame, items: DataFrame, s: Settings = Settings(),
                 id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                 item_text_col: str = "text") -> DataFrame:
    """Per verified (document, item): score, overlaps of question and answer, and passages that hold it."""
    test = items.select(F.col(item_col).cast("long").alias("item"), F.col(item_text_col).cast("string").alias("text"))
    size = test.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = max(1, -(-size // s.block_bytes))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, item long, score double, question_overlap double, answer_overlap double, n_passages long"

    def block(k: int) -> tuple[list, list[str]]:
        part = test.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n_blocks)) == k) if n_blocks > 1 else test
        pairs = sorted((r["item"] is not None, r["item"] or 0, r["text"]) for r in part.collect() if r["text"])
        full = np.flatnonzero(np.diff(word_hashes(*_flat([p[2] for p in pairs]))[1])) if pairs else []
        return [pairs[i][1] if pairs[i][0] else None for i in full], [pairs[i][2] for i in full]

    totals, out = Totals(), None
    for k in range(n_blocks):
        if texts := block(k)[1]:
            totals = totals.with_items(texts)
    for k in range(n_blocks):
        ids, texts = block(k)
        if not texts:
            continue
        shared = spark.sparkContext.broadcast(Index(ids, texts, s, totals))
        found = rows.mapInArrow(lambda b, shared=shared: _search(b, shared.value), schema)
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = spark.createDataFrame([], schema)
    return out.withColumnsRenamed({"id": id_col, "item": item_col})
