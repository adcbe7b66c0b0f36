"""Session settings the results and the scale behaviour rely on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Days, weeks and months are cut in UTC whatever the cluster's own zone is.
# AQE sizes the shuffle partitions, splits hot ones, and turns a join into a
# broadcast only once it has measured the small side.  Sums that overflow are errors.
SETTINGS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # what a task reads is some ten times as large in its sorts and windows, of which it holds several
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    # a third smaller than snappy, for the lake and for what is staged
    "spark.sql.parquet.compression.codec": "zstd",
    # keyed stream state outgrows the heap: keep it in RocksDB, ship only changes
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # one bound for all pieces of state of an executor, however many they are
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    # a piece that is done keeps its last buffer: were it large, the others would soon share a full bound,
    # flush with every row and stall
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "4",
}


def configure(spark: SparkSession) -> SparkSession:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def build(app_name: str = "cowrie", **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    for name, value in settings.items():
        builder = builder.config(name, value)
    return configure(builder.getOrCreate())


def expect_shuffle(spark: SparkSession, size: int, piece: int = 256 << 20) -> int:
    """Cut shuffles into pieces of about 256 MB for the ``size`` bytes expected.

    AQE merges pieces that turn out small but cannot cut finer than it began, so a
    large job has to begin with enough of them.  Returns their number.
    """
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pieces = max(least, -(-size // piece))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(pieces))
    return pieces


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder that every executor can reach.

    It lies under the checkpoint folder the cluster names.  Only where none is
    named and all runs in one process a temporary folder of this machine is used.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return f"{base.rstrip('/')}/cowrie/{label}-{uuid.uuid4().hex}"
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix=f"cowrie-{label}-")
