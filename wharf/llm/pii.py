"""Operator 7: personal data by weak supervision.

Strict patterns give the base spans. Looser candidates get votes from labelers
(regex, gazetteer, context); expectation-maximisation over all candidates'
votes estimates how reliable each labeler is, and the posteriors train a
logistic span classifier, which decides on the loose candidates.

What the estimation needs is the number of candidates of each vote pattern: a
table of fixed size (kinds x votes x shapes), counted over all texts by Spark.
Candidates may have any length; the context labelers read 40 characters on each
side of one, which bounds what they look at, not what is found.

Defined cases: a null text is an empty one (no spans); repeated rows give
repeated result rows; texts are read whole and matching is linear in their
length; without candidates nothing is added; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import arrays as A

KINDS = ("email", "ip", "card", "phone")

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# A run of digits either matches from its first digit or not at all.
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_HINT = re.compile(r"[0-9@]|[\[(](?:at|AT)[\])]")

_LOOSE = {
    # Runs are taken whole, whatever their length.
    "email": re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?(?:@|[\[(](?:at|AT)[\])]) ?[A-Za-z0-9-]++"
                        r"(?:(?: ?(?:\.|[\[(](?:dot|DOT)[\])]) ?| (?:dot|DOT) )[A-Za-z0-9-]{2,}+)++"),
    "phone": re.compile(r"(?<![0-9A-Za-z+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z])"),
    "card": re.compile(r"(?<![0-9A-Za-z.-])[0-9]{4}(?:[ -][0-9]{4}){3}(?![0-9A-Za-z-])"),
}
_NEAR = {
    "email": re.compile(r"\b(?:e-?mail|mail|contact|write|reach)\b", re.I),
    "ip": re.compile(r"\b(?:ip|address|host|server|client)\b", re.I),
    "card": re.compile(r"\b(?:card|visa|mastercard|amex|credit|debit|payment)\b", re.I),
    "phone": re.compile(r"\b(?:phone|tel|telephone|call|mobile|cell|fax)\b", re.I),
}
_AGAINST = re.compile(r"\b(?:version|isbn|order|invoice|serial|part|section|chapter|ref|no)\.?\s*$", re.I)
#: Gazetteers: frequent top-level domains and first digits of card issuers.
_DOMAINS = frozenset("com org net edu gov io de fr es uk it nl eu info".split())
_ISSUERS = ("34", "37", "4", "51", "52", "53", "54", "55", "6011", "65")
#: Characters before a candidate that the context labelers read, and after it.
_REACH = 40


def _luhn(digits: str) -> bool:
    twice = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (sum(map(int, digits[-1::-2])) + twice) % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of the email pattern, found from their @ so that long runs stay linear."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at)):
            yield start, m.end()
            end = m.end()
        elif start == at:
            pass
        # A local part cannot hold an @: the next one may begin right after this one.
        end = max(end, at + 1)
        at = text.find("@", end)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the strict matches, in order."""
    if not _HINT.search(text):
        return []
    out = [(s, 0, e) for s, e in emails(text)]
    out += [(m.start(), 1, m.end()) for m in _IP.finditer(text)
            if all(len(v := p.lstrip("0")) <= 3 and int(v or "0") <= 255 for p in m.group().split("."))]
    for m in _CARD.finditer(text):
        if 14 <= m.end() - m.start() and 14 <= len(d := _digits(m.group())) <= 19 and _luhn(d):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 10 <= len(_digits(m.group())) <= 15]
    return sorted(out)


def labeler_votes(kind: str, text: str, start: int, end: int, strict: bool) -> str:
    """One character per labeler: + for, - against, 0 no vote."""
    found, near = text[start:end], text[max(0, start - _REACH):start]
    digits = _digits(found)
    if kind == "email":
        known = "+" if re.split(r"[.\])\s]", found.lower())[-1] in _DOMAINS else "-"
    elif kind == "card":
        known = "+" if digits.startswith(_ISSUERS) else "-"
    elif kind == "phone":
        known = "-" if digits[:1] in "01" and not strict else "0"
    else:
        known = "-" if found.startswith(("0.", "255.")) else "0"
    regex = "+" if strict else ("-" if kind == "card" and not _luhn(digits) else "0")
    context = "+" if _NEAR[kind].search(near) or _NEAR[kind].search(text[end:end + _REACH]) else "0"
    against = "-" if _AGAINST.search(near) else "0"
    plain = "-" if len(set(digits)) <= 1 and kind != "email" else "0"
    return regex + known + context + against + plain


def candidates(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int, str]]]:
    """The base spans, and (start, kind, end, votes) of all candidates, base ones included."""
    base = base_spans(text)
    out = [(s, k, e, labeler_votes(KINDS[k], text, s, e, True)) for s, k, e in base]
    if _HINT.search(text):
        taken = sorted((s, e) for s, _, e in base)
        starts = np.array([s for s, _ in taken])
        for kind, pattern in _LOOSE.items():
            for m in pattern.finditer(text):
                i = int(np.searchsorted(starts, m.end()))
                if not any(e > m.start() for _, e in taken[max(0, i - len(KINDS)):i]):
                    out.append((m.start(), KINDS.index(kind), m.end(), labeler_votes(kind, text, m.start(), m.end(), False)))
    return base, sorted(out)


@dataclass
class Model:
    """Weights of the span classifier, by kind and vote pattern."""
    weights: np.ndarray


def features(kind: int, votes: str) -> np.ndarray:
    v = np.array([{"+": 1.0, "-": -1.0}.get(c, 0.0) for c in votes])
    return np.concatenate([np.eye(len(KINDS))[kind], v, [v[0] * v[2]]])


def reliabilities(votes: np.ndarray, counts: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation: posterior of each vote pattern, and the labelers' accuracies.

    A labeler that votes is right with its accuracy, whatever the truth; it starts at 0.8."""
    accuracy, prior = np.full(votes.shape[1], 0.8), 0.5
    for _ in range(rounds):
        odds = np.log(prior / (1 - prior)) + votes @ np.log(accuracy / (1 - accuracy))
        post = 1 / (1 + np.exp(-odds))
        right = np.where(votes > 0, post[:, None], 1 - post[:, None]) * (votes != 0)
        # One pseudo-count on each side keeps estimates inside (0, 1).
        new = ((right * counts[:, None]).sum(0) + 4) / (((votes != 0) * counts[:, None]).sum(0) + 5)
        new = np.clip(new, 0.55, 0.99)
        prior = float(np.clip((post * counts).sum() / counts.sum(), 0.05, 0.95))
        done = np.abs(new - accuracy).max() < 1e-6
        accuracy = new
        if done:
            break
    return post, accuracy


def fit(patterns: list[tuple[int, str, int]]) -> Model:
    """From (kind, votes, count): posteriors by kind, then one weighted logistic regression."""
    n = len(features(0, "00000"))
    if not patterns:
        return Model(np.zeros(n))
    x = np.array([features(k, v) for k, v, _ in patterns])
    votes = x[:, len(KINDS):-1]
    count, kind, target = np.array([float(c) for *_, c in patterns]), np.array([p[0] for p in patterns]), np.zeros(len(patterns))
    for k in set(kind.tolist()):
        target[kind == k] = reliabilities(votes[kind == k], count[kind == k])[0]
    weight, w = np.log1p(count), np.zeros(n)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(n),
                               x.T @ (weight * (p - target)) + 0.1 * w)
        w -= np.clip(step, -2, 2)
    return Model(w)


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: dict[tuple[int, str], int] = {}
    for batch in batches:
        for text in batch.column("text").to_pylist():
            for _, k, _, votes in candidates(text or "")[1]:
                seen[k, votes] = seen.get((k, votes), 0) + 1
    yield A.batch_of(kind=pa.array([k for k, _ in seen], pa.int32()), votes=pa.array([v for _, v in seen], pa.string()),
                     n=pa.array(list(seen.values()), pa.int64()))


def train(docs: DataFrame, text_col: str = "text") -> Model:
    """Estimate the labelers and fit the classifier on the candidates of all rows."""
    counted = (docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(_count, "kind int, votes string, n long")
               .groupBy("kind", "votes").agg(F.sum("n").alias("n")))
    return fit(sorted((r["kind"], r["votes"], r["n"]) for r in counted.collect()))


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def _find(batches: Iterable[pa.RecordBatch], model: Model, least: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, digests, spans = [], [], []
        for text in batch.column("text").to_pylist():
            base, every = candidates(text or "")
            kept, have = list(base), set(base)
            for s, k, e, votes in every:
                if (s, k, e) not in have and 1 / (1 + np.exp(-(features(k, votes) @ model.weights))) >= least:
                    kept.append((s, k, e))
            counts.append([sum(b[1] == k for b in base) for k in range(len(KINDS))])
            digests.append(hashlib.sha256(_joined(base).encode()).hexdigest())
            spans.append(_joined(sorted(kept)))
        by_kind = np.array(counts, np.int64).reshape(-1, len(KINDS))
        yield A.batch_of(id=batch.column("id"), **{f"n_{k}": by_kind[:, i] for i, k in enumerate(KINDS)},
                         base_sha256=pa.array(digests, pa.string()), spans=pa.array(spans, pa.string()))


def find(spark: SparkSession, docs: DataFrame, model: Model, least: float = 0.7, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """Per row: id, base counts by kind, base_sha256 and all spans. `least`: probability of an added span."""
    shared = spark.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string"
    return rows.mapInArrow(lambda b: _find(b, shared.value, least), schema).withColumnRenamed("id", id_col)
