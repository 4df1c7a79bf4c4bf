"""Operator 6: BPE encoding and decoding by batched numpy merge rounds.

The symbols of many distinct words stand in one flat array. In each round the
ranks of all neighbouring pairs are found by binary search over the sorted pair
keys, and each word merges its lowest-ranked pair. Words are encoded once per
task while they stay in a bounded table; the merged words are the same with any
table size.

The vocabulary file (a parameter, never copied) is the JSON of a BPE tokenizer
with NFC, white-space and lower-case normalisation, a word pattern, byte-level
symbols and a word-end suffix. It travels to the tasks by a broadcast; its size
is checked against `MAX_FILE_BYTES`.

Defined cases: a null text is an empty one (no tokens, empty decoded text);
repeated rows give repeated result rows; very long texts and words are encoded
whole; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import os
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import arrays as A

#: The vocabulary is broadcast; larger files are refused.
MAX_FILE_BYTES = 64 << 20
#: Distinct words kept with their ids in a task, and words merged in one flat array.
TABLE_WORDS, BATCH_WORDS = 200_000, 50_000


def byte_symbols() -> list[str]:
    """The printable stand-in character of each byte in byte-level vocabularies.

    Printable Latin-1 bytes stand for themselves, the others for code points from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b if b in own else next(rest)) for b in range(256)]


class WordBPE:
    """The merges of one vocabulary as sorted pair keys with ranks and results."""

    def __init__(self, spec: dict):
        model, vocab = spec["model"], spec["model"]["vocab"]
        suffix = model["end_of_word_suffix"]
        self.size = max(vocab.values()) + 1
        self.tokens = [""] * self.size
        for token, i in vocab.items():
            self.tokens[i] = token
        symbols = byte_symbols()
        self.inner = np.array([vocab[s] for s in symbols], np.int64)
        self.final = np.array([vocab[s + suffix] for s in symbols], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left, right = (np.array([vocab[p[k]] for p in pairs], np.int64) for k in (0, 1))
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        key = left * self.size + right
        order = np.argsort(key, kind="stable")
        self.keys, self.ranks, self.made = key[order], order, made[order]
        # A merge may only use symbols of earlier merges: then all occurrences of
        # a word's lowest pair can be merged in one round.
        born = np.full(self.size, -1)
        np.maximum.at(born, made, np.arange(len(made)))
        if (np.maximum(born[left], born[right]) >= np.arange(len(made))).any():
            raise ValueError("a merge stands before the merges that make its parts")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for text, i in self.special.items():
            self.tokens += [""] * (i + 1 - len(self.tokens))
            self.tokens[i] = text
        self.split = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.words = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])

    def pieces(self, text: str) -> list[str]:
        """The words of a text, and the strings of special tokens as they are."""
        if self.split is None or not any(s in text for s in self.special):
            return self._words(text)
        out: list[str] = []
        for k, part in enumerate(self.split.split(text)):
            out += [part] if k % 2 else self._words(part)
        return out

    def _words(self, text: str) -> list[str]:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            # Lower case character by character: a final capital sigma has no form of its own.
            text = text.replace("Σ", "σ")
        return self.words.findall(text.lower())

    def encode_words(self, words: list[str]) -> list[np.ndarray]:
        """Token ids of each (non-empty) word."""
        raw = [w.encode() for w in words]
        lengths = np.array([len(w) for w in raw], np.int64)
        data = np.frombuffer(b"".join(raw), np.uint8)
        symbols, word = self.inner[data], np.repeat(np.arange(len(raw)), lengths)
        last = np.cumsum(lengths) - 1
        symbols[last] = self.final[data[last]]
        done_symbols, done_word = [], []
        while len(symbols):
            key = symbols[:-1] * self.size + symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = (self.keys[at] == key) & (word[:-1] == word[1:])
            rank = np.where(hit, self.ranks[at], len(self.keys))
            best = np.full(len(raw), len(self.keys))
            np.minimum.at(best, word[:-1][hit], rank[hit])
            open_word = best[word] < len(self.keys)
            if not open_word.all():
                done_symbols.append(symbols[~open_word])
                done_word.append(word[~open_word])
                keep = np.flatnonzero(open_word)
                if not len(keep):
                    break
                inside = open_word[:-1]
                symbols, word, at, rank = symbols[keep], word[keep], at[inside], rank[inside]
                # Words are whole here, so the pairs that remain inside a word are still neighbours.
                at, rank = at[:len(keep) - 1], rank[:len(keep) - 1]
            merge = np.flatnonzero((rank == best[word[:-1]]) & (word[:-1] == word[1:]))
            # Occurrences of a pair like (a, a) may overlap: the left one of two goes first.
            if len(merge) > 1:
                run = np.cumsum(np.concatenate([[True], np.diff(merge) != 1]))
                start = np.concatenate([[0], np.flatnonzero(np.diff(run)) + 1])
                merge = merge[(np.arange(len(merge)) - start[run - 1]) % 2 == 0]
            symbols[merge] = self.made[at[merge]]
            left = np.ones(len(symbols), bool)
            left[merge + 1] = False
            symbols, word = symbols[left], word[left]
        symbols, word = np.concatenate(done_symbols), np.concatenate(done_word)
        order = np.argsort(word, kind="stable")
        bounds = np.searchsorted(word[order], np.arange(len(raw) + 1))
        symbols = symbols[order]
        return [symbols[bounds[i]:bounds[i + 1]] for i in range(len(raw))]

    def decode(self, ids: Iterable[int]) -> str:
        """Without a decoder in the vocabulary file, tokens are joined by spaces."""
        return " ".join(self.tokens[i] for i in ids)


def load(path: str) -> WordBPE:
    with open(path, encoding="utf-8") as f:
        return WordBPE(json.load(f))


class Encoder:
    """Encodes texts with a bounded table of words already merged."""

    def __init__(self, bpe: WordBPE):
        self.bpe, self.table = bpe, {}
        self._start()

    def _start(self) -> None:
        self.table = {s: ([i], str(i), self.bpe.tokens[i]) for s, i in self.bpe.special.items()}

    def add(self, words: Iterable[str]) -> None:
        new = [w for w in words if w not in self.table]
        if len(self.table) + len(new) > TABLE_WORDS:
            self._start()
            new = [w for w in words if w not in self.table]
        i = 0
        while i < len(new):
            for w, ids in zip(new[i:i + BATCH_WORDS], self.bpe.encode_words(new[i:i + BATCH_WORDS])):
                ids = ids.tolist()
                self.table[w] = (ids, " ".join(map(str, ids)), self.bpe.decode(ids))
            i += BATCH_WORDS

    def entries(self, texts: list[str]) -> Iterator[list[tuple[list[int], str, str]]]:
        """For each text, the (ids, ids as text, decoded text) of its words."""
        split = [self.bpe.pieces(t) for t in texts]
        self.add(set().union(*split) if split else ())
        for words in split:
            yield [self.table[w] for w in words]


def _encode(batches: Iterable[pa.RecordBatch], bpe: WordBPE, with_ids: bool) -> Iterator[pa.RecordBatch]:
    encoder = Encoder(bpe)
    for rows, _, _ in A.text_batches(batches):
        n, ids_sha, text_sha, ids, texts = [], [], [], [], []
        for found in encoder.entries([t or "" for t in rows.column("text").to_pylist()]):
            n.append(sum(len(e[0]) for e in found))
            decoded = " ".join(e[2] for e in found)
            ids_sha.append(hashlib.sha256(" ".join(e[1] for e in found).encode()).hexdigest())
            text_sha.append(hashlib.sha256(decoded.encode()).hexdigest())
            if with_ids:
                ids.append([i for e in found for i in e[0]])
                texts.append(decoded)
        out = {"id": rows.column("id"), "n_tokens": pa.array(n, pa.int64()), "ids_sha256": pa.array(ids_sha, pa.string()),
               "decoded_sha256": pa.array(text_sha, pa.string())}
        if with_ids:
            out |= {"ids": pa.array(ids, pa.list_(pa.int32())), "decoded": pa.array(texts, pa.string())}
        yield A.batch_of(**out)


def encode(spark: SparkSession, docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
           with_ids: bool = True) -> DataFrame:
    """Per row: id, n_tokens, digests of the ids and of the decoded text and, with
    `with_ids`, the ids and the decoded text. No shuffle; rows are independent."""
    if os.path.getsize(vocabulary) > MAX_FILE_BYTES:
        raise ValueError(f"the vocabulary file has more than {MAX_FILE_BYTES} bytes")
    shared = spark.sparkContext.broadcast(load(vocabulary))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if with_ids:
        schema += ", ids array<int>, decoded string"
    out = rows.mapInArrow(lambda batches: _encode(batches, shared.value, with_ids), schema)
    return out.withColumnRenamed("id", id_col)
