"""Session settings the library counts on, and the shared folder for scratch tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from tablesync.errors import SyncError

_PARTITIONS = "spark.sql.shuffle.partitions"

# Everything here can be overridden by the cluster; queries stay right without it, but text bounds of
# TIMESTAMP cursors are read in the session zone, and skewed merges lean on the adaptive join.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.storeAssignmentPolicy": "ANSI",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
}


def build_session(
    app: str = "tablesync", master: str | None = None, input_bytes: int | None = None, **conf: str
) -> SparkSession:
    """A session with :data:`SETTINGS`; ``input_bytes`` sizes its shuffles, which default to 200 partitions."""
    if input_bytes is not None:
        conf = {_PARTITIONS: str(max(200, shuffle_partitions(input_bytes))), **conf}
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shuffle_partitions(total_bytes: int, partition_bytes: int = 128 << 20) -> int:
    """Shuffle partitions of about 128 MiB for an input of that size."""
    return max(1, -(-total_bytes // partition_bytes))


@contextmanager
def wide_shuffles(spark: SparkSession, stored_bytes: int) -> Iterator[None]:
    """Raise the shuffle partitions for a job over that many stored bytes, if the session has fewer.

    Stored Parquet is taken to grow threefold in a shuffle. Never lowered: adaptive execution
    merges partitions that turn out small.
    """
    before = spark.conf.get(_PARTITIONS)
    needed = shuffle_partitions(3 * stored_bytes)
    if needed <= int(before):
        yield
        return
    spark.conf.set(_PARTITIONS, str(needed))
    try:
        yield
    finally:
        spark.conf.set(_PARTITIONS, before)


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it in spark.checkpoint.dir.

    Only a local session may go without; it gets a temporary folder, set for the whole session.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise SyncError("spark.checkpoint.dir is not set: name a folder that every executor can reach")
    root = tempfile.mkdtemp(prefix="tablesync-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_dir(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/tablesync/{label}-{uuid.uuid4().hex[:16]}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """``checkpoint()`` fails without a folder; give the context the one the session names."""
    root = scratch_root(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
