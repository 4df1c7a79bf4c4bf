"""Operator 1: near-duplicates by MinHash banding and connected components.

Each document's set of word shingles gets `bands * rows` universal hash minima.
Sets that share all minima of a band are candidates; their signatures and then
their full sets confirm a link (Jaccard similarity of at least `percent` %).
Linked documents get the smallest id of their component.

Equal sets are one node, so copies never meet in a bucket. In each bucket all
members are compared with one centre, which joins groups of near copies without
pairs among them. Links that this leaves out can only lie between members of one
bucket that are in different components then. They are found by an exact prefix
join of those members' sets: shingles are ordered from rare to frequent, and two
sets can only be linked if the first shingle they share stands early enough in
both for the rest to make up the similarity. No bucket is capped, and no bucket's
pairs are emitted as such.

With 40 bands of 5 rows a pair at the threshold of 80 % is missed with a
probability of (1 - 0.8**5)**40 = 1.3e-7, a closer pair more rarely.

Defined cases: without words (or text) the set is empty, links with nothing and
the document is its own component; a null id is never the smallest one, and a
row without any id in its component gets a null component and kept = false;
rows that repeat an id are linked like other rows and share kept; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, tasks_of
from . import arrays as A
from .components import components


@dataclass(frozen=True)
class Settings:
    shingle: int = 2
    percent: int = 80
    bands: int = 40
    rows: int = 5
    #: Signatures that agree in fewer minima are no link: the expected share at
    #: the threshold is 0.8 (standard deviation 0.028 for 200 minima).
    least_agreement: float = 0.6


def _hash_family(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers (odd) and offsets of the multiply-shift family."""
    r = np.random.default_rng(11)
    return r.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1), r.integers(0, 2**63, n, dtype=np.uint64)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each document (A-Z lower-cased)."""
    data = A.LOWER[data]
    starts, ends, bounds = A.words(data, offsets)
    words = A.range_hashes(A.prefix_sums(A.byte_codes(data)), starts, ends)
    h, b = A.shingles(words, bounds, size)
    for i in range(len(offsets) - 1):
        yield np.unique(h[b[i]:b[i + 1]])


def minima(values: np.ndarray, family: tuple[np.ndarray, np.ndarray], block: int = 512) -> np.ndarray:
    """The minimum of each hash function over the set, block by block."""
    a, c = family
    low = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(values), block):
        np.minimum(low, (values[i:i + block, None] * a + c).min(0), out=low)
    return low >> np.uint64(32)


def _sign(batches: Iterable[pa.RecordBatch], s: Settings) -> Iterator[pa.RecordBatch]:
    family = _hash_family(s.bands * s.rows)
    for batch, data, offsets in A.text_batches(batches):
        size, key, check, signature, bands = [], [], [], [], []
        for values in shingle_sets(data, offsets, s.shingle):
            size.append(len(values))
            key.append(int(A.mix(values).sum(dtype=np.uint64) ^ np.uint64(len(values))) if len(values) else 0)
            check.append(int(np.bitwise_xor.reduce(A.mix(values + np.uint64(1)))) if len(values) else 0)
            low = minima(values, family)
            signature.append(low.astype(np.uint8).tobytes() if len(values) else None)
            h = np.zeros(s.bands, np.uint64)
            for r in range(s.rows):
                h = A.mix(h + low[r::s.rows] + np.uint64(1))
            bands.append((h + np.arange(s.bands, dtype=np.uint64)).view(np.int64) if len(values) else None)
        yield A.batch_of(id=batch.column("id"), text_hash=batch.column("text_hash"),
                         n_shingles=pa.array(size, pa.int64()),
                         set_key=pa.array(np.array(key, np.uint64).view(np.int64)),
                         set_check=pa.array(np.array(check, np.uint64).view(np.int64)),
                         signature=pa.array(signature, pa.binary()), bands=pa.array(bands, pa.list_(pa.int64())))


def _sets(batches: Iterable[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch, data, offsets in A.text_batches(batches):
        yield A.batch_of(node=batch.column("node"),
                         values=pa.array([v.tobytes() for v in shingle_sets(data, offsets, shingle)], pa.binary()))


def _confirm(batches: Iterable[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """The pairs of which 100 * |intersection| >= percent * |union|."""
    for batch in batches:
        good = np.zeros(batch.num_rows, bool)
        for i, (x, y) in enumerate(zip(batch.column("x"), batch.column("y"), strict=True)):
            x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
            common = len(np.intersect1d(x, y, assume_unique=True))
            good[i] = 100 * common >= percent * (len(x) + len(y) - common)
        yield A.batch_of(a=batch.column("a"), b=batch.column("b")).filter(pa.array(good))


def _agree(batches: Iterable[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """The pairs whose signatures agree often enough to be confirmed."""
    for batch in batches:
        x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in "xy")
        good = (x == y).mean(1) >= least if batch.num_rows else np.zeros(0, bool)
        yield A.batch_of(a=batch.column("a"), b=batch.column("b")).filter(pa.array(good))


def _with_values(pairs: DataFrame, nodes: DataFrame, value: str) -> DataFrame:
    """Pairs (a, b) with the value of both nodes as x and y."""
    side = lambda k, v: nodes.select(F.col("node").alias(k), F.col(value).alias(v))
    return pairs.join(side("a", "x"), "a").join(side("b", "y"), "b").select("a", "b", "x", "y")


def _first_pairs(buckets: DataFrame, low: DataFrame) -> DataFrame:
    """Each bucket's smallest node (in low) with every other member."""
    return buckets.join(low, "bucket").filter("node != a").select("a", F.col("node").alias("b")).distinct()


def _open_nodes(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """(node, root, outside) of the members of buckets with several components.

    outside: the node is not in the largest component of one of its buckets, so
    that every pair that may still be a link has a node outside."""
    named = buckets.join(labels, "node", "left").select("bucket", "node", F.coalesce("root", "node").alias("root"))
    main = (named.groupBy("bucket", "root").count().groupBy("bucket")
            .agg(F.max_by("root", F.struct("count", "root")).alias("main"), F.count(F.lit(1)).alias("parts"))
            .filter("parts > 1").drop("parts"))
    return named.join(main, "bucket").groupBy("node", "root").agg(F.bool_or(F.expr("root != main")).alias("outside"))


#: Cells of the frequency sketch that orders shingles, the ratio between size classes, and
#: words of 64 bits in the parity sketch of a set.
_CELLS, _RATIO, _PARITY = 1 << 20, 1.06, 8


def _cells(values: np.ndarray) -> np.ndarray:
    return (values >> np.uint64(44)).astype(np.int64)


def _count_cells(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(_CELLS, np.int64)
    for batch in batches:
        for v in batch.column("values"):
            np.add.at(total, _cells(np.frombuffer(v.as_buffer(), np.uint64)), 1)
    at = np.flatnonzero(total)
    yield A.batch_of(cell=at, n=total[at])


def _size_class(n: np.ndarray) -> np.ndarray:
    return np.floor(np.log(n) / np.log(_RATIO)).astype(np.int32)


def _parity(values: np.ndarray) -> np.ndarray:
    """Parities of the shingles in each of 64 * _PARITY cells, as words of bits.

    Two sets' parities differ in at most as many bits as the sets in shingles."""
    cells = ((values >> np.uint64(20)) & np.uint64(64 * _PARITY - 1)).astype(np.int64)
    return np.packbits((np.bincount(cells, minlength=64 * _PARITY) & 1).astype(bool)).view(np.int64)


def _prefix(batches: Iterable[pa.RecordBatch], frequency: np.ndarray, percent: int, probe: bool) -> Iterator[pa.RecordBatch]:
    """The shingles of each set at which a linked set may first meet it, rare ones first.

    most: the greatest size of such a set, by what remains from the shingle on.
    The index has one row per shingle, with the set's size class; a probe has one
    for each size class that a linked set may have."""
    for batch in batches:
        out: list[list[np.ndarray]] = [[], [], [], [], []]
        parity = np.zeros((batch.num_rows, _PARITY), np.int64)
        for i, v in enumerate(batch.column("values")):
            values = np.frombuffer(v.as_buffer(), np.uint64)
            n, parity[i] = len(values), _parity(values)
            values = values[np.lexsort([values, frequency[_cells(values)]])]
            most = (n - np.arange(n)) * (100 + percent) // percent - n
            least = -(-n * percent // 100)
            use = np.flatnonzero(most >= least)
            if probe:
                low, high = _size_class(np.array([least]))[0], _size_class(most[use])
                count = high - low + 1
                use = np.repeat(use, count)
                kind = low + np.arange(len(use)) - np.repeat(np.cumsum(count) - count, count)
            else:
                kind = np.full(len(use), _size_class(np.array([n]))[0])
            for column, x in zip(out, (np.full(len(use), i), values[use].view(np.int64), kind, np.full(len(use), n), most[use])):
                column.append(x)
        which, shingle, kind, n, most = (np.concatenate([*c, np.zeros(0, np.int64)]).astype(np.int64) for c in out)
        at = pa.array(which)
        yield A.batch_of(shingle=shingle, kind=kind.astype(np.int32), node=batch.column("node").take(at),
                         root=batch.column("root").take(at), n=n.astype(np.int32), most=most.astype(np.int32),
                         **{f"p{k}": parity[which, k] for k in range(_PARITY)})


def _prefix_pairs(spark: SparkSession, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of nodes of different components, one of them outside, that may be links, once for each
    shingle at which they meet. sets: node, root, outside, values."""
    got = sets.select("values").mapInArrow(_count_cells, "cell long, n long").groupBy("cell").agg(F.sum("n")).toArrow()
    frequency = np.zeros(_CELLS, np.int64)
    frequency[got.column(0).to_numpy()] = got.column(1).to_numpy()
    shared = spark.sparkContext.broadcast(frequency)
    schema = "shingle long, kind int, node long, root long, n int, most int"
    schema += "".join(f", p{k} long" for k in range(_PARITY))
    columns = ["node", "root", "values"]
    index = sets.select(columns).mapInArrow(lambda b: _prefix(b, shared.value, percent, False), schema).alias("y")
    probe = (sets.filter("outside").select(columns)
             .mapInArrow(lambda b: _prefix(b, shared.value, percent, True), schema).alias("x"))
    meet = (F.expr("x.shingle = y.shingle and x.kind = y.kind and x.root != y.root and y.n <= x.most and x.n <= y.most")
            & F.expr(f"100 * y.n >= {percent} * x.n and 100 * x.n >= {percent} * y.n")
            # A link's sets differ in this share of their sizes at most, and their parities in no more bits.
            & F.expr(f"({100 + percent}) * (" + " + ".join(f"bit_count(x.p{k} ^ y.p{k})" for k in range(_PARITY))
                     + f") <= {100 - percent} * (x.n + y.n)"))
    return probe.join(index, meet).select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))


def near_duplicates(spark: SparkSession, docs: DataFrame, s: Settings = Settings(), id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Per row: id, n_shingles, component_id, kept and text_hash."""
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
    kind = rows.schema["id"].dataType.simpleString()

    def written(frame: DataFrame, name: str, tasks: int = 0) -> DataFrame:
        path = scratch_path(spark, f"near-dup-{name}")
        (frame.coalesce(tasks) if tasks else frame).write.parquet(path)
        return spark.read.parquet(path)

    signed = written(rows.mapInArrow(lambda b: _sign(b, s), f"id {kind}, text_hash long, n_shingles long, set_key long, "
                                     "set_check long, signature binary, bands array<long>"), "signed")
    tasks = tasks_of(signed)
    # A node is a distinct set, known by two hashes and its size.
    node = F.xxhash64("set_key", "set_check", "n_shingles").alias("node")
    nodes = written(signed.filter("n_shingles > 0").groupBy(node).agg(
        F.min("id").alias("first"), F.min(F.struct("text_hash", "id")).alias("at"),
        F.first("signature").alias("signature"), F.first("bands").alias("bands")), "nodes", tasks)
    exploded = nodes.select("node", F.explode("bands").alias("bucket"))
    # Written, so that the joins on a bucket have shuffles of their own, which adaptive execution may split.
    crowded = written(exploded.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("a"))
                      .filter("n > 1").select("bucket", "a"), "crowded", tasks)
    buckets = written(exploded.join(crowded.select("bucket"), "bucket").select("bucket", "node"), "buckets", tasks)

    def read_sets(wanted: DataFrame) -> DataFrame:
        """(node, values) of the wanted nodes, from one text of each; repeated rows may repeat it."""
        wanted = wanted.join(nodes.select("node", "at.text_hash", F.col("at.id").alias("at_id")), "node")
        found = rows.join(wanted, (rows["text_hash"] == wanted["text_hash"]) & rows["id"].eqNullSafe(wanted["at_id"]))
        return written(found.select("node", "text").mapInArrow(lambda b: _sets(b, s.shingle), "node long, values binary")
                       .dropDuplicates(["node"]), "sets", tasks)

    def likely(pairs: DataFrame) -> DataFrame:
        return written(_with_values(pairs, nodes, "signature").mapInArrow(
            lambda b: _agree(b, s.least_agreement), "a long, b long"), "likely", tasks)

    def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
        return written(_with_values(pairs, sets, "values").mapInArrow(
            lambda b: _confirm(b, s.percent), "a long, b long"), "links", tasks)

    pairs = likely(_first_pairs(buckets, crowded))
    sets = read_sets(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct())
    links = confirmed(pairs, sets)
    labels = written(components(spark, links, tasks), "labels", tasks)
    open_ = written(_open_nodes(buckets, labels), "open", tasks)
    if not open_.isEmpty():
        sets = sets.unionByName(read_sets(open_.select("node").join(sets, "node", "left_anti")))
        found = likely(_prefix_pairs(spark, sets.join(open_, "node"), s.percent).distinct())
        # The labels of the first links stand for those links.
        more = labels.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(confirmed(found, sets))
        labels = written(components(spark, more, tasks), "labels", tasks)

    root = nodes.join(labels, "node", "left").select("node", "first", F.coalesce("root", "node").alias("root"))
    component = written(root.groupBy("root").agg(F.min("first").alias("component_id")), "components", tasks)
    answer = root.join(component, "root").select("node", "component_id")
    ids = signed.select("id", "n_shingles", "text_hash", F.when(F.col("n_shingles") > 0, node).alias("node"))
    out = ids.join(answer, "node", "left")
    component_id = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_col), "n_shingles", component_id.alias("component_id"),
                      F.coalesce(F.col("id") == component_id, F.lit(False)).alias("kept"), "text_hash")
