"""Message topics: Kafka, or folders of files with the same record shape.

A topic name is all a job needs.  ``Channel("kafka", {"kafka.bootstrap.servers": …})``
speaks to a cluster that has the connector; ``Channel("parquet", {"root": …})`` and
``"text"`` keep each topic in a folder, one sub-folder per micro-batch.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cowrie.sources import files

_NUMBERED = "batch_id="


@dataclass(frozen=True)
class Channel:
    format: str = "kafka"
    options: Mapping[str, str] = field(default_factory=dict)

    @property
    def is_kafka(self) -> bool:
        return self.format == "kafka"

    def folder(self, topic: str) -> str:
        return f"{self.options['root'].rstrip('/')}/{topic}"

    @property
    def _columns(self) -> str:
        return "value string" if self.format == "text" else "key string, value string"

    def read_stream(self, spark: SparkSession, topic: str) -> DataFrame:
        """All messages from the earliest on, then new ones as they come."""
        if self.is_kafka:
            source = spark.readStream.format("kafka").options(**self.options)
            return source.option("subscribe", topic).option("startingOffsets", "earliest").load()
        files.make_folder(spark, self.folder(topic))
        limits = {k: v for k, v in self.options.items() if k != "root"}
        return (
            spark.readStream.format(self.format)
            .schema(self._columns)
            .option("recursiveFileLookup", True)
            .options(**limits)
            .load(self.folder(topic))
        )

    def read(self, spark: SparkSession, topic: str, since: str | None = None, until: str | None = None) -> DataFrame:
        """The messages of a range of a topic, as a bounded table.

        ``since`` and ``until`` are ends that ``end`` gave; from the earliest and to the
        present if left out.  A range that has ended stays the same whatever comes later.
        """
        if self.is_kafka:
            source = spark.read.format("kafka").options(**self.options).option("subscribe", topic)
            return source.option("startingOffsets", since or "earliest").option("endingOffsets", until or "latest").load()
        first, last = json.loads(since or "{}"), json.loads(until or self.end(spark, topic))
        pieces = [
            piece
            for writer, numbered in self._pieces(spark, topic).items()
            for number, piece in numbered
            if first.get(writer, -1) < number <= last.get(writer, -1)
        ]
        if not pieces:
            return spark.createDataFrame([], self._columns)
        return spark.read.format(self.format).schema(self._columns).load(pieces)

    def _pieces(self, spark: SparkSession, topic: str) -> dict[str, list[tuple[int, str]]]:
        """The complete pieces of each writer with their numbers; one without numbers has piece 0."""
        root, found = self.folder(topic), {}
        for writer in files.children(spark, root):
            folder = f"{root}/{writer}"
            parts = [n for n in files.children(spark, folder) if n.startswith(_NUMBERED)]
            numbered = [(int(n.removeprefix(_NUMBERED)), f"{folder}/{n}") for n in parts]
            found[writer] = [(n, p) for n, p in numbered or [(0, folder)] if files.is_complete(spark, p)]
        return found

    def end(self, spark: SparkSession, topic: str) -> str:
        """Where a topic ends now, to be given to ``read``: the next offset of each partition, as
        JSON in Kafka's own form; in a folder the number of each writer's last piece."""
        if self.is_kafka:
            every = self.read(spark, topic).groupBy("partition").agg(F.max("offset").alias("last"))
            return json.dumps({topic: {str(r["partition"]): r["last"] + 1 for r in every.collect()}})
        return json.dumps({w: max(n for n, _ in pieces) for w, pieces in self._pieces(spark, topic).items() if pieces})

    def write(self, messages: DataFrame, topic: str, part: str) -> None:
        """Publish a column ``value``, beside a column ``key`` where there is one.

        ``part`` names the piece, a writer and its ``batch_id=`` number: in a folder a
        replayed piece replaces itself, in Kafka it is published again.  Text folders keep
        no keys.
        """
        if self.is_kafka:
            messages.write.format("kafka").options(**self.options).option("topic", topic).save()
            return
        if self.format == "text":
            messages = messages.select("value")
        elif "key" not in messages.columns:
            messages = messages.select(F.lit(None).cast("string").alias("key"), "value")
        target = f"{self.folder(topic)}/{part}"
        messages.write.format(self.format).mode("overwrite").options(**files.MARK_DONE).save(target)
