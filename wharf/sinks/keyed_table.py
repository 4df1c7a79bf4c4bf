"""A stored table with a primary key, written by increment (SNK-6, PL-9 … PL-11).

The reference's keyed store overwrites a row in place. Files cannot be changed
in place, but most of them need not be touched either: a batch only rewrites the
files that may hold one of its keys. For that each file has an index entry, the
range of its keys and a Bloom filter over them, and a manifest names the files
that are live.

Layout below ``path``::

    data/_g=<generation>/_slot=<slot>/part-*.parquet   rows; never changed
    index/_g=<generation>/                             key range and Bloom bitmaps of each file
    manifest/<generation>/                             the live files of the version that wrote it
    commits/<version>                                  a small JSON file; makes the version the current one
    names/<digest>                                     the version that a tagged batch became

A row's slot says where to look for its key, so that batch and index meet in an
equi-join. By default it is a range of the key's 64-bit hash: slots are even
whatever the keys are, also if one leading key has a third of all rows. With a
``width`` it is a range of the first key column instead (a whole number), so that
a batch of neighbouring keys, as of the latest orders, touches few slots. A version is committed by creating
``commits/<version>``, which must not exist: readers see the old files or the
new ones, a job that dies before leaves only files that nobody reads, and of two
writers one fails. A batch with a ``tag`` that was committed before is not
applied again, so a repeated load changes nothing.

Keys may have NULL parts; NULL equals NULL.
"""

from __future__ import annotations

import json
import uuid
from collections import Counter
from collections.abc import Sequence
from dataclasses import asdict, dataclass
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wharf.operators.upsert import last_write_wins
from wharf.session import scratch_path
from wharf.sinks.commits import CommitLog

#: Bits of one bitmap of Spark's bitmap functions.
_BITS = 32768
_MANIFEST = "file string, slot long, rows long, generation string"


class _File(NamedTuple):
    name: str
    slot: int
    rows: int
    generation: str


@dataclass(frozen=True)
class Layout:
    """Fixed when the table is created: slots (a power of 2), Bloom bits of a file (in bitmaps of 32,768) and hashes.

    With ``width`` > 0 a slot holds the rows of that many values of the first key, and ``slots`` says into how many
    the rows of such a range are spread by the hash of their keys. A slot with more than ``max_files`` files is rewritten whole by the next
    batch that has a row for it, so a lookup meets a bounded number of files."""

    slots: int = 16
    bitmaps: int = 16
    hashes: int = 4
    max_files: int = 8
    width: int = 0


@dataclass(frozen=True)
class Commit:
    """What one batch did. ``files_read`` of ``files_before`` live files were read."""

    version: int
    tag: str | None
    rows_in: int
    rows_new: int
    files_before: int
    files_read: int
    files_replaced: int
    files_written: int


class KeyedTable:
    """One row per key at ``path``; single writer at a time (a second one gets :class:`~wharf.sinks.commits.CommitConflict`)."""

    def __init__(self, spark: SparkSession, path: str, key_cols: Sequence[str], schema: T.StructType,
                 layout: Layout = Layout(), check: bool = True):
        self.spark, self.path, self.keys, self.schema = spark, path.rstrip("/"), list(key_cols), schema
        self.log = CommitLog(spark, path)
        if not self.keys:
            raise ValueError("a key has one column at least")
        if layout.slots & (layout.slots - 1):
            raise ValueError("slots must be a power of 2")
        first = self.log.entry(0)
        # The layout of an existing table stays; it decides where its rows are.
        self.layout = Layout(**first["layout"]) if first else layout
        if check and first and first["keys"] != self.keys:
            raise ValueError(f"the table's key is {first['keys']}")

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> KeyedTable:
        """An existing table with its own key, schema and layout."""
        probe = cls(spark, path, ["?"], T.StructType(), check=False)
        known = probe.versions()
        if not known:
            raise ValueError(f"no table at {path}")
        entry = probe.log.entry(known[-1])
        return cls(spark, path, entry["keys"], T.StructType.fromJson(json.loads(entry["schema"])))

    # --- commits ----------------------------------------------------------------------

    def versions(self) -> list[int]:
        return self.log.numbers()

    # --- reading ----------------------------------------------------------------------

    def _manifest(self, generation: str) -> DataFrame:
        return self.spark.read.schema(_MANIFEST).parquet(f"{self.path}/manifest/{generation}")

    def files(self, version: int | None = None) -> DataFrame:
        """(file, slot, rows, generation) of the live files of a version (the current one)."""
        known = self.versions()
        if not known:
            return self.spark.createDataFrame([], _MANIFEST)
        entry = self.log.entry(known[-1] if version is None else version)
        if entry is None:
            raise ValueError(f"no version {version}")
        return self._manifest(entry["generation"])

    def row_count(self) -> int:
        """Rows of the current version, from the manifest."""
        return sum(f.rows for f in self._live())

    def _live(self) -> list[_File]:
        """The live files. The driver holds their names, as any reader's listing does, and what an operation reads
        of the manifest it reads once."""
        return [_File(r["file"], r["slot"], r["rows"], r["generation"]) for r in self.files().collect()]

    def _rows_of(self, paths: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
        columns = list(columns or self.schema.fieldNames())
        if not paths:
            return self.spark.createDataFrame([], self.schema).select(*columns)
        return (self.spark.read.schema(self.schema).option("basePath", f"{self.path}/data")
                .parquet(*[unquote(p) for p in paths]).select(*columns))

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version."""
        return self._rows_of([r["file"] for r in self.files(version).select("file").collect()])

    def lookup(self, **key) -> DataFrame:
        """The row of one key: the files of its slot whose range and Bloom filter allow it."""
        wanted = self.spark.createDataFrame([tuple(key[k] for k in self.keys)],
                                            T.StructType([self.schema[k] for k in self.keys]))
        found = self._rows_of(self._candidates(wanted, self._live()))
        for k in self.keys:
            found = found.filter(F.col(k).eqNullSafe(F.lit(key[k])))
        return found

    # --- index ------------------------------------------------------------------------

    def _key(self) -> Column:
        return F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(self.keys)])

    def _slot(self) -> Column:
        bits, width = self.layout.slots.bit_length() - 1, self.layout.width
        spread = F.shiftrightunsigned(F.xxhash64(*self.keys), 64 - bits) if bits else F.lit(0).cast("long")
        if not width:
            return spread
        first = F.floor(F.coalesce(F.col(self.keys[0]), F.lit(0)) / F.lit(width)).cast("long")
        return first * self.layout.slots + spread

    def _places(self) -> Column:
        """The Bloom bits of a key, counted from 1 (as the bitmap functions do)."""
        size = self.layout.bitmaps * _BITS
        return F.array(*[F.pmod(F.xxhash64(F.lit(i), *self.keys), F.lit(size).cast("long")) + 1
                         for i in range(self.layout.hashes)])

    def _write_index(self, generation: str) -> None:
        data = (self.spark.read.schema(self.schema).option("basePath", f"{self.path}/data")
                .parquet(f"{self.path}/data/_g={generation}"))
        self._index_of(data).write.parquet(f"{self.path}/index/_g={generation}")

    def _index_of(self, data: DataFrame) -> DataFrame:
        """(file, bitmap, bits, lo, hi, rows, slot): a row for each Bloom bitmap of a file that has a bit set."""
        at = F.col("_metadata.file_path").alias("file")
        # Sort-based aggregates would hold the rows of a whole split; those below are hashed and have a row per file, or
        # a row per 64 Bloom bits of a file. A file is sorted by key: its first and last rows are its range.
        row = F.col("_metadata.row_index").alias("row")
        sizes = data.select(at, row, "_slot").groupBy("file").agg(F.count(F.lit(1)).alias("rows"), F.max("row").alias("last"),
                                                                   F.first("_slot").cast("long").alias("slot"))
        ends = (data.select(at, row, self._key().alias("key")).join(F.broadcast(sizes), "file")
                .filter((F.col("row") == 0) | (F.col("row") == F.col("last"))))
        ranges = ends.groupBy("file", "rows", "slot").agg(F.min("key").alias("lo"), F.max("key").alias("hi"))
        place = F.col("place")
        # Bytes of a word are in the order of hex digits; within a byte, the lowest bit is the first.
        bit = F.expr("shiftleft(1L, cast((7 - (place - 1) div 8 % 8) * 8 + (place - 1) % 8 as int))")
        words = (data.select(at, F.explode(self._places()).alias("place"))
                 .select("file", F.bitmap_bucket_number(place).alias("bitmap"),
                         F.expr("cast(bitmap_bit_position(place) div 64 as int)").alias("word"), bit.alias("bits"))
                 .groupBy("file", "bitmap", "word").agg(F.bit_or("bits").alias("bits")))
        found = words.groupBy("file", "bitmap").agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("words"))

        def digits(entry: Column, i: Column) -> Column:
            before = F.coalesce(F.get("words", i - 1)["word"], F.lit(-1))
            return F.concat(F.repeat(F.lit("0" * 16), entry["word"] - before - 1), F.lpad(F.hex(entry["bits"]), 16, "0"))

        bits = F.unhex(F.rpad(F.array_join(F.transform("words", digits), ""), _BITS // 4, "0"))
        bitmaps = found.select("file", "bitmap", bits.alias("bits"))
        return bitmaps.join(ranges, "file")

    def _candidates(self, rows: DataFrame, live: list[_File]) -> list[str]:
        """The live files that may hold a key of ``rows`` (a semi join through the index; file names only come back).

        A key meets the files of its slot, of which there are ``max_files`` and a few at most."""
        if not live:
            return []
        names = {f.name for f in live}
        index = (self.spark.read.option("basePath", f"{self.path}/index")
                 .parquet(*[f"{self.path}/index/_g={g}" for g in sorted({f.generation for f in live})]))
        # One row per file, with its Bloom bits as 64-bit words: a key is tested in its own row, no row per bit is made.
        files = index.groupBy("file", "slot", "lo", "hi").agg(F.map_from_entries(F.collect_list(F.struct("bitmap", "bits"))).alias("bits"))
        words = F.expr(f"""flatten(transform(sequence(1L, {self.layout.bitmaps}L), b -> transform(sequence(0, {_BITS // 64 - 1}),
            i -> coalesce(cast(conv(hex(substring(bits[b], 8 * i + 1, 8)), 16, -10) as bigint), 0L))))""")
        files = files.select("file", "slot", "lo", "hi", words.alias("words"))
        places = [f"place{i}" for i in range(self.layout.hashes)]
        probes = rows.select(self._key().alias("key"), self._slot().alias("slot"), self._places().alias("places"))
        probes = probes.select("key", "slot", *[(F.col("places")[i] - 1).alias(p) for i, p in enumerate(places)])
        hits = probes.join(files, "slot").filter((F.col("key") >= F.col("lo")) & (F.col("key") <= F.col("hi")))
        for p in places:
            hits = hits.filter(f"getbit(words[cast({p} div 64 as int)], cast((7 - {p} div 8 % 8) * 8 + {p} % 8 as int)) = 1")
        # The index of a generation also has files that were replaced since.
        return [r["file"] for r in hits.select("file").distinct().collect() if r["file"] in names]

    def _full_slots(self, rows: DataFrame, live: list[_File]) -> list[str]:
        """The files of slots that have too many, as far as ``rows`` has something for the slot."""
        full = {s for s, n in Counter(f.slot for f in live).items() if n > self.layout.max_files}
        if not full:
            return []
        meant = {r["slot"] for r in rows.select(self._slot().alias("slot")).distinct().collect()} & full
        return [f.name for f in live if f.slot in meant]

    # --- writing ----------------------------------------------------------------------

    def _tagged(self, tag: str | None) -> Commit | None:
        """The commit of the batch with this tag, if there is one."""
        entry = self.log.named(tag) if tag is not None else None
        return Commit(**entry["commit"]) if entry else None

    def _publish(self, rows: DataFrame, rows_in: int, live: list[_File], replaced: Sequence[str], read: int,
                 tag: str | None) -> Commit:
        """Write ``rows`` as a new generation in place of the files ``replaced``, and commit."""
        known = self.versions()
        version, generation = (known[-1] + 1 if known else 0), uuid.uuid4().hex
        (rows.select(*self.schema.fieldNames()).withColumn("_slot", self._slot()).hint("rebalance", "_slot")
         .sortWithinPartitions("_slot", *self.keys).write.partitionBy("_slot").parquet(f"{self.path}/data/_g={generation}"))
        fs, p = self.log._fs(f"data/_g={generation}")
        new: list[_File] = []
        if any(s.isDirectory() for s in fs.listStatus(p)):
            self._write_index(generation)
            index = self.spark.read.parquet(f"{self.path}/index/_g={generation}").select("file", "slot", "rows").distinct()
            new = [_File(r["file"], r["slot"], r["rows"], generation) for r in index.collect()]
        gone = set(replaced)
        after = [f for f in live if f.name not in gone] + new
        self.spark.createDataFrame([(f.name, f.slot, f.rows, f.generation) for f in after],
                                   _MANIFEST).coalesce(1).write.parquet(f"{self.path}/manifest/{generation}")
        commit = Commit(version, tag, rows_in, sum(f.rows for f in after) - sum(f.rows for f in live), len(live), read,
                        len(gone), len(new))
        self.log.add(version, {"commit": asdict(commit), "generation": generation, "keys": self.keys,
                               "schema": self.schema.json(), "layout": asdict(self.layout)}, name=tag)
        return commit

    def _staged(self, batch: DataFrame) -> DataFrame:
        """The batch, written once: it is used to find files and again to merge."""
        path = scratch_path(self.spark, "keyed-batch")
        batch.write.parquet(path)
        return self.spark.read.schema(batch.schema).parquet(path)

    def upsert(self, batch: DataFrame, order_cols: Sequence[str], tag: str | None = None) -> Commit:
        """SNK-6: the last write on a key (greatest ``order_cols``) wins, over the batch and the stored rows.

        Only files that may hold a key of the batch are read and replaced."""
        done = self._tagged(tag)
        if done:
            return done
        staged = self._staged(last_write_wins(batch.select(*self.schema.fieldNames()), self.keys, order_cols))
        live = self._live()
        replaced = sorted({*self._candidates(staged, live), *self._full_slots(staged, live)})
        merged = staged
        if replaced:
            merged = last_write_wins(self._rows_of(replaced).unionByName(staged), self.keys, order_cols)
        return self._publish(merged, staged.count(), live, replaced, len(replaced), tag)

    def insert_new(self, batch: DataFrame, tag: str | None = None) -> Commit:
        """Rows whose key is not stored yet; of rows of one key the smallest. Stored rows stay as they are.

        Only the key columns of the files that may hold a key of the batch are read; no file is
        replaced but those of a slot that has too many."""
        done = self._tagged(tag)
        if done:
            return done
        cols = self.schema.fieldNames()
        others = [c for c in cols if c not in self.keys]
        rows = batch.select(*cols)
        if others:
            rows = rows.groupBy(*self.keys).agg(F.min(F.struct(*others)).alias("_r")).select(*self.keys, "_r.*").select(*cols)
        else:
            rows = rows.distinct()
        staged = self._staged(rows)
        live = self._live()
        maybe, full = self._candidates(staged, live), self._full_slots(staged, live)
        fresh = staged
        if maybe:
            held = self._rows_of(maybe, self.keys).select(*[F.col(k).alias(f"_h{i}") for i, k in enumerate(self.keys)])
            same = [F.col(k).eqNullSafe(F.col(f"_h{i}")) for i, k in enumerate(self.keys)]
            condition = same[0]
            for s in same[1:]:
                condition = condition & s
            # Stored keys grow with the table: they meet the batch in a shuffle and are not sent through the driver.
            fresh = staged.join(held.hint("merge"), condition, "left_anti")
        if full:
            fresh = fresh.unionByName(self._rows_of(full))
        return self._publish(fresh, staged.count(), live, full, len({*maybe, *full}), tag)
