"""Session and lineage helpers."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int = 8, shuffle_partitions: int = 8, app: str = "pathcredit") -> SparkSession:
    """Session for tests, the bench and local runs (UI off, UTC, AQE on)."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Joins keyed by (chunk, user, ...) may reuse the (chunk, user) layout.
        .config("spark.sql.requireAllClusterKeysForCoPartition", "false")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.driver.memory", "16g")
        # Plans here are built from many column expressions; capturing the Python
        # call site of each one costs several JVM round trips per function call.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


def ensure_utc(spark: SparkSession) -> None:
    """Session settings the job's plans rely on, applied before they are built.

    Visit times are read and chains dated in UTC. Joins keyed by (chunk, user,
    session, ...) may reuse the (chunk, user) bucketed layout of one side
    instead of shuffling both sides onto all of their keys.
    """
    if spark.conf.get("spark.sql.session.timeZone") not in ("UTC", "Etc/UTC", "+00:00", "Z"):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    if spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition", "true") != "false":
        spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")


#: Rows of input for each shuffle partition and chunk.
ROWS_A_PARTITION = 1 << 15
#: Bytes that adaptive execution merges partitions up to, and that a task scans.
MERGED_BYTES, SCANNED_BYTES = 8 << 20, 16 << 20
_OWN = "spark.pathcredit.ownPartitions"  # the session's own number of partitions and the number set instead


def ensure_partitions(spark: SparkSession, rows: int) -> int:
    """Session settings under which a task's share stays the same however large the input is.

    Shuffle partitions, and with them chunks, grow with the ``rows`` of the input: the session's own number or one
    for every ROWS_A_PARTITION, whichever is more. Adaptive execution merges them to MERGED_BYTES only: shuffled
    rows here are narrow and compress well, so its usual 64 MB are millions of rows, whose sorts a task holds at once.
    """
    now = spark.conf.get("spark.sql.shuffle.partitions")
    own, given = spark.conf.get(_OWN, f"{now} {now}").split()
    if now != given:  # set by the session's user since
        own = now
    n = max(int(own), math.ceil(rows / ROWS_A_PARTITION))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set(_OWN, f"{own} {n}")
    for key, most in (("spark.sql.adaptive.advisoryPartitionSizeInBytes", MERGED_BYTES),
                      ("spark.sql.files.maxPartitionBytes", SCANNED_BYTES)):
        if _bytes(spark, spark.conf.get(key)) > most:
            spark.conf.set(key, str(most))
    return n


def _bytes(spark: SparkSession, size: str) -> int:
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(size)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's shared ``spark.checkpoint.dir``; only a local session may get its own."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running on a cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="pathcredit-ckpt-"))
    return sc.getCheckpointDir()


def materialize(df: DataFrame, bucket_by: Sequence[str] = (), n_buckets: int | None = None,
                arranged: bool = False) -> DataFrame:
    """Cut lineage: write ``df`` once under the shared checkpoint folder and continue
    from the files.

    Unlike ``Dataset.checkpoint()``, which evaluates its input twice (once to
    count, once to write), this computes the input a single time; executor loss
    after the write costs nothing, since the files are on shared storage. The write's
    shuffle files go when it ends.

    With ``bucket_by`` the files are written as a bucketed table (hash of those
    columns into ``n_buckets``, default the shuffle partitions) registered under
    a unique name in the session catalog. Reading it back keeps the hash
    layout, so later windows, aggregates and joins keyed by those columns do
    not shuffle the table again. If ``df`` is already hash-partitioned that way,
    the write adds no shuffle either (Spark drops the redundant repartition);
    ``arranged=True`` states that every partition of ``df`` already holds a
    single bucket's rows, so no repartition is asked for at all.
    """
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark).rstrip("/")
    name = f"pathcredit_{uuid.uuid4().hex}"
    path = f"{root}/pathcredit-tables/{name}"
    with _shuffles_freed(spark):
        if not bucket_by:
            df.write.mode("overwrite").parquet(path)
            return spark.read.parquet(path)
        n = int(n_buckets or spark.conf.get("spark.sql.shuffle.partitions"))
        laid_out = df if arranged else df.repartition(n, *bucket_by)
        laid_out.write.format("parquet").bucketBy(n, *bucket_by).option("path", path).saveAsTable(name)
        return spark.table(name)


_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What is written within frees its shuffle files when it ends, not when the driver happens to collect its garbage."""
    own = spark.conf.get(_FREE, "false")
    spark.conf.set(_FREE, "true")
    try:
        yield
    finally:
        spark.conf.set(_FREE, own)
