"""File listings as a ledger (SRC-13, STR-1): what is new, changed or gone since the last run.

:func:`wharf.sources.files.list_files` lists what is there. Here a listing is
stored with the length, time and a digest of each file's rows, and the next one
is compared with it by a full outer join. A file whose length and time are those
of the stored entry keeps its digest; only the others are read, with as many
tasks as they have splits. A file that was written again with the same rows is
not a change. The driver holds the names of the files to read, nothing else.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wharf.sinks.commits import CommitLog

def _plain(path: str) -> Column:
    """A file's name in one form; readers give it with one slash after the scheme or three."""
    return F.regexp_replace(path, "^file:/+", "file:/")


_ENTRY = "path string, length long, modified timestamp, rows long, digest string"


class FileLedger:
    """The listings of a folder, stored below ``path``."""

    def __init__(self, spark: SparkSession, path: str, folder: str, fmt: str = "parquet", glob: str = "*"):
        self.spark, self.path, self.folder, self.fmt, self.glob = spark, path.rstrip("/"), folder, fmt, glob
        self.log = CommitLog(spark, path)

    def _found(self) -> DataFrame:
        try:
            return (self.spark.read.format("binaryFile").option("pathGlobFilter", self.glob)
                    .option("recursiveFileLookup", True).load(self.folder)
                    .select(_plain("path").alias("path"), "length", F.col("modificationTime").alias("modified")))
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return self.spark.createDataFrame([], "path string, length long, modified timestamp")

    def _digests(self, paths: DataFrame) -> DataFrame:
        """(path, rows, digest) of files; the digest does not depend on the order of the rows."""
        names = [r["path"] for r in paths.collect()]  # file names to read, as any reader's listing holds them
        if not names:
            return self.spark.createDataFrame([], "path string, rows long, digest string")
        rows = self.spark.read.format(self.fmt).load(names)
        values = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
        hashes = rows.select(F.col("_metadata.file_path").alias("path"), F.xxhash64(values).alias("a"),
                             F.xxhash64(F.lit(1), values).alias("b"))
        wide = lambda c: F.sum(F.col(c).cast("decimal(20,0)"))
        sums = hashes.groupBy("path").agg(F.count(F.lit(1)).alias("rows"),
                                          F.concat_ws(":", wide("a").cast("string"), wide("b").cast("string")).alias("digest"))
        # The reader's names are URL-encoded (where a plus is a plus).
        path = F.url_decode(F.regexp_replace(_plain("path"), r"\+", "%2B"))
        return paths.select("path").join(sums.withColumn("path", path), "path", "left").select(
            "path", F.coalesce("rows", F.lit(0).cast("long")).alias("rows"), F.coalesce("digest", F.lit("")).alias("digest"))

    def stored(self) -> DataFrame:
        """The last stored listing."""
        last = self.log.last()
        if last is None:
            return self.spark.createDataFrame([], _ENTRY)
        return self.spark.read.schema(_ENTRY).parquet(f"{self.path}/listings/{last[1]['listing']}")

    def take(self, tag: str | None = None) -> DataFrame:
        """Store the present listing; (path, length, rows, digest, status) of every file, now or before.

        ``status`` is new, changed, removed or same. With a ``tag`` that was taken
        before, the difference of that time is given again."""
        done = self.log.named(tag) if tag is not None else None
        if done:
            return self.spark.read.parquet(f"{self.path}/differences/{done['listing']}")
        name, last = uuid.uuid4().hex, self.log.last()
        before, now = self.stored(), self._found()
        old = before.select("path", F.col("length").alias("old_length"), F.col("modified").alias("old_modified"),
                            F.col("rows").alias("old_rows"), F.col("digest").alias("old_digest"))
        kept = (F.col("length") == F.col("old_length")) & (F.col("modified") == F.col("old_modified"))
        # The listing is stored once: later steps must not see another state of the folder.
        now.join(old, "path", "full").withColumn("kept", F.coalesce(kept, F.lit(False))).write.parquet(f"{self.path}/seen/{name}")
        seen = self.spark.read.parquet(f"{self.path}/seen/{name}")
        read = self._digests(seen.filter(F.col("length").isNotNull() & ~F.col("kept")).select("path"))
        both = seen.join(read, "path", "left").select(
            "path", "length", "modified", F.when(F.col("kept"), F.col("old_rows")).otherwise(F.col("rows")).alias("rows"),
            F.when(F.col("kept"), F.col("old_digest")).otherwise(F.col("digest")).alias("digest"), "old_length", "old_rows", "old_digest")
        status = (F.when(F.col("length").isNull(), "removed").when(F.col("old_length").isNull(), "new")
                  .when(F.col("digest") == F.col("old_digest"), "same").otherwise("changed"))
        (both.select("path", F.coalesce("length", "old_length").alias("length"), F.coalesce("rows", "old_rows").alias("rows"),
                     F.coalesce("digest", "old_digest").alias("digest"), "modified", status.alias("status"))
         .write.parquet(f"{self.path}/differences/{name}"))
        difference = self.spark.read.parquet(f"{self.path}/differences/{name}")
        (difference.filter("status <> 'removed'").select("path", "length", "modified", "rows", "digest")
         .write.parquet(f"{self.path}/listings/{name}"))
        self.log.add(last[0] + 1 if last else 0, {"listing": name}, name=tag)
        return difference
