"""Session helpers.

`get_session` builds a session tuned for the warehouse jobs in this package:
UTC session zone (the reference stores zone-less timestamps), adaptive query
execution with partition coalescing and skew-join splitting, and no web UI.

Cluster settings always win: a key that the cluster already set is never
overwritten, so the same code runs under `local[8]` in tests and on a large
cluster where `spark.sql.shuffle.partitions`, `spark.checkpoint.dir` and
memory are sized by the deployment.
"""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark import SparkConf, SparkContext
from pyspark.sql import DataFrame, SparkSession

# Defaults applied only where the cluster left a key unset.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Splitting a skewed partition also for rebalance / aggregation reads.
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Runtime bloom filters shrink the probe side of selective star joins.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.bucketing.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(
    master: str | None = None,
    app_name: str = "wharf",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Return a session with the package defaults.

    ``master`` and ``shuffle_partitions`` are for local runs; on a cluster
    leave them ``None`` so the deployment's values are used.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(extra or {})
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if SparkSession.getActiveSession() is None:
        # Settings given at submit are known once the JVM runs; they are kept.
        SparkContext._ensure_initialized()
        given = SparkConf()
        conf = {k: v for k, v in SESSION_DEFAULTS.items() if not given.contains(k)} | conf
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    apply_runtime_defaults(spark)
    return spark


def apply_runtime_defaults(spark: SparkSession) -> None:
    """Set the SQL defaults on an existing session where they are unset.

    Among them is the zone: timestamps without a zone are read as UTC."""
    for key, value in SESSION_DEFAULTS.items():
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key) and spark.conf.get(key, None) is None:
            spark.conf.set(key, value)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster it must be configured: executors and the driver do not share
    local disks, so there is no fallback and an unset folder raises. Only under
    a ``local`` master (tests, a bare session) a fresh local folder is created.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="wharf-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/wharf-scratch/{name}-{uuid.uuid4().hex[:12]}"


def tasks_of(table: DataFrame) -> int:
    """The tasks that wrote a table (its files), and one for each core at least.

    What is derived from the scan of an input is written by as many tasks as the scan
    (``coalesce``): small tables are not cut into a file for each shuffle partition of the
    session, and the number still follows the input."""
    return max(len(table.inputFiles()), table.sparkSession.sparkContext.defaultParallelism)


# Bytes of (compressed) input for each initial shuffle partition.
BYTES_PER_PARTITION = 128 * 1024 * 1024


def input_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Total size of the files under ``paths`` (a listing; contents are not read)."""
    from pyspark.sql import functions as F

    total = 0
    for p in paths:
        row = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(p)
               .agg(F.sum("length").alias("n")).first())
        total += int(row["n"] or 0)
    return total


def size_for_input(spark: SparkSession, total_bytes: int) -> dict[str, str]:
    """Size shuffles for an input of ``total_bytes``, where the cluster left it unset.

    The number of shuffle partitions that adaptive execution starts from is one
    for each :data:`BYTES_PER_PARTITION` of input, and two for each core at
    least; the same rule holds at every size. Returns what it set.
    """
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    wanted = str(max(2 * spark.sparkContext.defaultParallelism, -(-total_bytes // BYTES_PER_PARTITION)))
    if spark.conf.get(key, None) is not None:
        return {}
    spark.conf.set(key, wanted)
    return {key: wanted}


def analyze_tables(spark: SparkSession, tables: list[str], columns: bool = True) -> None:
    """Collect catalog statistics and turn on cost-based join reordering.

    ``ANALYZE TABLE … COMPUTE STATISTICS [FOR ALL COLUMNS]`` gives Catalyst row
    counts and column statistics, so with ``spark.sql.cbo.enabled`` and
    ``spark.sql.cbo.joinReorder.enabled`` it orders a multi-way star join by
    estimated size instead of by how the query lists the tables.
    """
    for t in tables:
        spark.sql(f"ANALYZE TABLE {t} COMPUTE STATISTICS" + (" FOR ALL COLUMNS" if columns else ""))
    for key in ("spark.sql.cbo.enabled", "spark.sql.cbo.joinReorder.enabled"):
        spark.conf.set(key, "true")


_SHIPPED = "wharf-package.zip"


def ship_package(spark: SparkSession) -> None:
    """Send this package's code to the executors, once per Spark context.

    Needed where Python tasks run and the package is not installed on the
    executors. Spark's own file server distributes the archive. Arrow batches
    of whole texts are kept to 1,000 rows where the session has no setting.
    """
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", None) in (None, "10000"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    sc = spark.sparkContext
    if any(f.rsplit("/", 1)[-1] == _SHIPPED for f in sc.listFiles):
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="wharf-code-")) / _SHIPPED
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, Path(root.name) / f.relative_to(root))
    sc.addPyFile(str(target))
