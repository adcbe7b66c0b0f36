"""Folder operations on whatever file system a path names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cowrie.session import shared_folder


# Written by Spark when all of a write is in place; the lake's tables go by it, so it
# is asked for even where a cluster turns it off.
DONE = "_SUCCESS"
MARK_DONE = {"mapreduce.fileoutputcommitter.marksuccessfuljobs": "true"}


def is_complete(spark: SparkSession, folder: str) -> bool:
    return exists(spark, f"{folder}/{DONE}")


def _handle(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _handle(spark, path)
    return fs.exists(target)


def children(spark: SparkSession, path: str) -> list[str]:
    fs, target = _handle(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []


def size(spark: SparkSession, folder: str) -> int:
    """Bytes of all files below a folder; 0 where there is none."""
    fs, target = _handle(spark, folder)
    return fs.getContentSummary(target).getLength() if fs.exists(target) else 0


def listed(spark: SparkSession, folder: str) -> DataFrame:
    """``path, length, modificationTime`` of all files below a folder, written down once.

    Spark would take a task for every 128 MB that the files hold, though it only lists
    them; a session of its own limits the tasks.
    """
    lister = spark.newSession()
    lister.conf.set("spark.sql.files.maxPartitionNum", spark.conf.get("spark.sql.shuffle.partitions"))
    found = lister.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    listing = shared_folder(spark, "listing")
    found.select("path", "length", "modificationTime").write.parquet(listing)
    return spark.read.schema("path string, length long, modificationTime timestamp").parquet(listing)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, target = _handle(spark, path)
    fs.mkdirs(target)


def remove(spark: SparkSession, path: str) -> None:
    fs, target = _handle(spark, path)
    fs.delete(target, True)


def exchange(spark: SparkSession, folder: str, target: str) -> None:
    """Put ``folder`` in the place of ``target``."""
    fs, source = _handle(spark, folder)
    destination = _handle(spark, target)[1]
    fs.mkdirs(destination.getParent())
    fs.delete(destination, True)
    if not fs.rename(source, destination):
        raise OSError(f"{folder} can't be moved to {target}")


def same(spark: SparkSession, path: str, other: str) -> bool:
    """Whether two spellings name one place, as with and without ``file:``."""
    fs, a = _handle(spark, path)
    return fs.makeQualified(a).equals(fs.makeQualified(_handle(spark, other)[1]))


def publish_single(spark: SparkSession, folder: str, target: str) -> None:
    """Turn the one part file Spark wrote into a folder into the file ``target``."""
    part = next(name for name in children(spark, folder) if name.startswith("part-"))
    fs, destination = _handle(spark, target)
    fs.mkdirs(destination.getParent())
    fs.delete(destination, False)
    fs.rename(_handle(spark, f"{folder}/{part}")[1], destination)
    remove(spark, folder)
