"""Operators 11 to 13 against their plain forms."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from wharf.llm import bag_search, line_dedup, phrases
from wharf.session import ship_package

LOWER = {i: i + 32 for i in range(65, 91)}
WORDS = "the of and a river stone Stone naïve été 7 x1 über house tree cloud".split()


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture(scope="module")
def texts():
    """(id, text, lang): nulls, empty and long texts, a null id, repeated rows and ids, copies, ties."""
    rng = random.Random(11)

    def line():
        return " ".join(rng.choice(WORDS) for _ in range(rng.randint(1, 12))) + rng.choice(["", ".", ",", "\t", " "])

    shared = [line() + " shared by some" for _ in range(6)]
    out = [(i, "\n".join(rng.choice(shared) if rng.random() < 0.3 else line() for _ in range(rng.randint(1, 8))),
            rng.choice(["en", "de", None])) for i in range(80)]
    out += [(90, None, "en"), (91, "", None), (92, "\n\n \n", "en"), (93, "...!?", "de"), (None, out[3][1], "en"), (None, "only the null one", "xx"),
            out[5], out[5], (5, out[6][1], "en"), (94, out[4][1].upper(), "en"), (95, out[4][1], "en"), (96, out[4][1], "en"),
            (97, "\n".join(shared * 700), "en"), (98, "the " * 30_000, "de"), (99, " été\x0bthe\x1f of", "de")]
    return out


def frame(spark, rows):
    """With more columns, of clashing names."""
    df = spark.createDataFrame([(*r, "x", 1, 1) for r in rows], "doc_id long, text string, lang string, key string, id int, rank int")
    return df.repartition(5)


# --- 11 -------------------------------------------------------------------------------


def plain_search(docs, items, top):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    bags = [(d, Counter(split(t))) for d, t, _ in docs]
    n_docs, total = sum(1 for _, b in bags if b), sum(sum(b.values()) for _, b in bags)
    df = Counter(w for _, b in bags for w in b)
    out = []
    for item, text in items:
        scored = []
        for d, b in bags:
            n = sum(b.values())
            m = 100 - 50 + (50 * n * n_docs) // total if total else 0
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((10**9 * b[w]) // (1000 * b[w] + 20 * m))
                        for w in set(split(text)) if b[w])
            if score > 0:
                scored.append((-score, d is None, d or 0))
        out += [(item, k, None if null else d, -s) for k, (s, null, d) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=str)


ITEMS = [(1, "The river, the STONE"), (2, "nothing here matches zzz"), (3, None), (4, ""), (5, "été über"), (6, "the"), (None, "cloud"), (6, "the"),
         (7, "shared by some tree")]


@pytest.mark.parametrize("settings", [bag_search.Settings(), bag_search.Settings(top=3), bag_search.Settings(top=7, block_items=2, work_bytes=64)])
def test_search_equals_scoring_every_pair(spark, texts, settings):
    items = spark.createDataFrame([(*i, "x") for i in ITEMS], "item_id long, text string, doc_id string")
    got = sorted(map(tuple, bag_search.search(spark, frame(spark, texts), items, settings).collect()), key=str)
    assert got == plain_search(texts, ITEMS, settings.top)


def test_search_of_empty_tables(spark, texts):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert bag_search.search(spark, frame(spark, []), items).count() == 0
    assert bag_search.search(spark, frame(spark, texts), items.limit(0)).count() == 0
    assert bag_search.search(spark, frame(spark, [(1, None, "en")]), items).count() == 0


def test_documents_of_one_bag_are_one_class(spark, texts):
    """Copies and reordered words are scored once; equal scores are in order of the id."""
    rows = [(k, "stone river " + "filler " * 3, "en") for k in range(200, 0, -1)] + [(500, "river stone filler x y", "en"), (0, "stone", "en")]
    items = spark.createDataFrame([(1, "river")], "item_id long, text string")
    got = bag_search.search(spark, frame(spark, rows), items, bag_search.Settings(top=50)).orderBy("rank").collect()
    assert [r["doc_id"] for r in got] == list(range(1, 51)) and len({r["score"] for r in got}) == 1


def test_terms_with_one_hash_are_told_apart():
    """A range whose bytes differ from the term of its hash is no occurrence."""
    v = bag_search.Vocabulary.of(["alpha beta"])
    data = np.frombuffer(b"alpha gamma", np.uint8)
    starts, ends, _ = bag_search.terms(data, np.array([0, len(data)]))
    assert (v.find(data, starts, ends) >= 0).tolist() == [True, False]
    v.data = v.data.copy()
    v.data[:] = 0
    assert (v.find(data, starts, ends) >= 0).tolist() == [False, False]


# --- 12 -------------------------------------------------------------------------------


def plain_phrases(docs, max_words, least, top):
    counts, totals = defaultdict(Counter), Counter()
    for _, text, lang in docs:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            ws = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(ws)
            for k in range(1, max_words + 1):
                counts[lang].update(tuple(ws[i:i + k]) for i in range(len(ws) - k + 1))
    out = []
    for lang, c in counts.items():
        kept = {p: f for p, f in c.items() if len(p) > 1 and f >= least}
        dropped = {q[i:i + k] for q, f in kept.items() for k in range(2, len(q)) for i in range(len(q) - k + 1) if f >= kept[q[i:i + k]]}
        scored = []
        for p, a in kept.items():
            if p in dropped:
                continue
            score, k = min((1000 * a * totals[lang] // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(lang, i, p.decode(), -a, left, right, totals[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out)


@pytest.mark.parametrize("settings", [phrases.Settings(min_count=3), phrases.Settings(min_count=2, shard_bytes=300, max_words=4, top=20),
                                      phrases.Settings(min_count=5, shard_bytes=1, max_words=2), phrases.Settings(),
                                      # Cells that let everything through, and longer phrases.
                                      phrases.Settings(min_count=2, cell_bits=10, max_words=7, shard_bytes=2000)])
def test_phrases_equal_counting(spark, texts, settings):
    got = sorted(map(tuple, phrases.collocations(spark, frame(spark, texts), settings).collect()))
    assert got == plain_phrases(texts, settings.max_words, settings.min_count, settings.top) and got


def test_phrases_of_an_empty_table_and_without_words(spark):
    assert phrases.collocations(spark, frame(spark, []), phrases.Settings(min_count=1)).count() == 0
    assert phrases.collocations(spark, frame(spark, [(1, None, None), (2, " , ", "en")]), phrases.Settings(min_count=1)).count() == 0


def test_scores_beyond_64_bits(spark):
    """1000 a n and l r pass 64 bits."""
    big = spark.createDataFrame([(9_000_000_000, 90_000_000_000_000, 4_000_000_000_000, 5_000_000_000_000)], "a long, n long, l long, r long")
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    q = phrases._quotient(F.lit(1000).cast("decimal(4,0)") * F.col("n").cast("decimal(15,0)") * wide("a"), wide("l") * wide("r"))
    assert big.select(q).first()[0] == 1000 * 9_000_000_000 * 90_000_000_000_000 // (4_000_000_000_000 * 5_000_000_000_000)


@pytest.mark.parametrize("seed", range(4))
def test_index_enumerates_every_phrase_with_its_extensions(seed):
    rng = np.random.default_rng(seed)
    seq = rng.integers(0, 4, 400)
    seq[100:160] = np.tile([1, 2, 3, 1, 1], 12)
    whole = np.concatenate([[0], seq, [0]])
    found = {len(p.words[0]): p for p in phrases.enumerate_phrases(seq, 2, 5)}
    for k in range(2, 6):
        beside = defaultdict(list)
        for i in range(1, len(whole) - k):
            if whole[i:i + k].all():
                beside[tuple(whole[i:i + k].tolist())].append((int(whole[i - 1]), int(whole[i + k])))
        only = lambda xs: xs[0] if len(set(xs)) == 1 else 0
        expected = {p: (len(b), only([x for x, _ in b]), only([x for _, x in b])) for p, b in beside.items()}
        p = found[k]
        assert {tuple(w): v for w, *v in zip(p.words.tolist(), p.count.tolist(), p.left.tolist(), p.right.tolist())} == {
            w: list(v) for w, v in expected.items()}


@pytest.mark.parametrize("bits,n", [(10, 5), (10, 600), (14, 100), (14, 12_000), (20, 3)])
def test_cells_are_summed_over_tasks(spark, monkeypatch, bits, n):
    """Blocks of several tasks and flushes give the cells that reach the least count, as numbers or as bits."""
    monkeypatch.setattr(phrases, "_ENTRIES", 200)
    rng = np.random.default_rng(n)
    total, batches = Counter(), []
    for _ in range(3):  # three tasks
        counter = phrases._Counter(bits, 6)
        for _ in range(4):
            cells = np.unique(rng.integers(0, 1 << bits, n)).astype(np.uint32)
            counts = rng.integers(1, 9, len(cells))
            for c, k in zip(cells.tolist(), counts.tolist()):
                total[c] += k
            batches += counter.add(cells, counts)
        batches += counter.blocks()
    rows = sorted((r for b in batches for r in b.to_pylist()), key=lambda r: r["block"])
    import pyarrow as pa
    merged = phrases._full_cells(bits, 6)([pa.RecordBatch.from_pylist(rows)])
    full = phrases.FullCells(bits, [(r["block"], r["dense"], r["data"]) for b in merged for r in b.to_pylist()])
    every = np.arange(1 << bits, dtype=np.uint32)
    assert full.has(every).tolist() == [total[c] >= 6 for c in every.tolist()]
    assert (full.bitmap is not None) == (32 * sum(k >= 6 for k in total.values()) > 1 << bits)
    assert not phrases.FullCells(bits, []).has(every).any()


@pytest.mark.parametrize("entries", [1 << 20, 60])
def test_phrases_are_shuffled_as_summed_blocks(monkeypatch, entries):
    """A task sums its shards into blocks, which give the plain counts and extensions."""
    import pyarrow as pa
    monkeypatch.setattr(phrases, "_ENTRIES", entries)
    rng = random.Random(entries)
    docs = [(i, " ".join(rng.choice(WORDS[:9]) for _ in range(400)), rng.choice(["en", "dé\n"])) for i in range(12)]
    everything = SimpleNamespace(value=SimpleNamespace(bits=10, has=lambda cells: np.ones(len(cells), bool)))
    tasks = [[pa.RecordBatch.from_pydict({"lang": [d[2]], "text": [d[1]]}) for d in docs[k::2]] for k in range(2)]
    blocks = [list(phrases._phrases(range(1, 4), 2, everything)(phrases._shards(phrases.Settings(shard_bytes=1))(t))) for t in tasks]
    rows = sorted((r for out in blocks for b in out for r in b.to_pylist()), key=lambda r: r["block"])
    schema = pa.schema([("block", pa.int32()), ("n", pa.int32()), ("langs", pa.list_(pa.string())), ("data", pa.binary())])
    got = {(r["lang"], r["phrase"]): (r["f"], r["words"], r["extended"]) for b in phrases._summed_phrases(3)([pa.RecordBatch.from_pylist(rows, schema)]) for r in b.to_pylist()}
    counts, beside = Counter(), defaultdict(lambda: (set(), set()))
    for _, text, lang in docs:
        ws = [None, *text.translate(LOWER).split(" "), None]
        for k in range(1, 4):
            for i in range(1, len(ws) - k):
                key = (lang, " ".join(ws[i:i + k]))
                counts[key] += 1
                for seen, w in zip(beside[key], (ws[i - 1], ws[i + k])):
                    seen.add(w)
    assert got.keys() == {p for p, f in counts.items() if f >= 3}
    for key, (f, words, extended) in got.items():
        assert (f, words) == (counts[key], key[1].count(" ") + 1)
        if words > 1 and any(len(s) == 1 and None not in s for s in beside[key]):
            assert extended
    if entries > 60:
        for out, k in zip(blocks, range(2)):
            found = {(lang, " ".join(ws[i:i + n])) for _, text, lang in docs[k::2] for ws in [text.translate(LOWER).split(" ")]
                     for n in range(1, 4) for i in range(len(ws) - n + 1)}
            assert sum(r["n"] for b in out for r in b.to_pylist()) == len(found)


# --- 13 -------------------------------------------------------------------------------


def plain_lines(docs, limits):
    """Per row, in order: (id, n_lines, n_dropped, kept text)."""
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    holders = defaultdict(set)
    for d, text, _ in docs:
        for line in (text or "").split("\n"):
            holders[key(line)].add((d is None, d or 0))
    out = []
    for d, text, _ in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < limits.min_chars or len(holders[key(x)]) <= limits.max_documents
                or min(holders[key(x)]) == (d is None, d or 0)]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


@pytest.mark.parametrize("limits", [line_dedup.Limits(), line_dedup.Limits(min_chars=1, max_documents=3), line_dedup.Limits(min_chars=0)])
def test_lines_equal_counting(spark, texts, limits):
    result = line_dedup.dedup_lines(spark, frame(spark, texts), limits)
    expected = plain_lines(texts, limits)
    assert sorted(map(tuple, result.collect()), key=str) == expected
    digests = {(r["doc_id"], r["kept_sha256"]) for r in line_dedup.digest(result).collect()}
    assert digests == {(d, hashlib.sha256(t.encode()).hexdigest()) for d, _, _, t in expected}
    assert any(n for _, _, n, _ in expected)


def test_lines_of_an_empty_table(spark):
    assert line_dedup.dedup_lines(spark, frame(spark, [])).count() == 0


def test_lines_beyond_ascii_count_code_points(spark):
    rows = [(2, "éééééééééé\nzz", "en"), (1, " éééééééé ", "en"), (3, "ÉÉÉÉÉÉÉÉÉÉ", "en"), (4, " éééééééééé\t\r", "en"), (5, "ééééééééé", "en"),
            (6, "ééééééééé", "en")]
    got = {r["doc_id"]: r["n_dropped"] for r in line_dedup.dedup_lines(spark, frame(spark, rows)).collect()}
    # Only A-Z are lower-cased; other blanks are part of the line; nine code points are too few.
    assert got == {1: 0, 2: 0, 3: 0, 4: 1, 5: 0, 6: 0}


def test_lines_have_no_python_on_their_path(spark, texts):
    plan = line_dedup.dedup_lines(spark, frame(spark, texts))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
