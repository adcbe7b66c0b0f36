"""Raw messages to stream silver: validate, dedup, convert, two sinks, dead letters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cowrie.functions.messages import event_time, parsed, rejected, to_messages
from cowrie.functions.money import with_eur
from cowrie.functions.periods import period_of
from cowrie.model import DATASETS, DEDUP_WATERMARK, REJECTED_TOPIC, Dataset
from cowrie.operators.quality import with_country
from cowrie.sources.topics import Channel
from cowrie.streaming.sinks import StreamTable, run


#: The name under which a stream counts its messages and the unusable ones of each batch.
MESSAGES = "messages"
#: Places over which the copies of one event are dealt before they meet.
SALTS = 16
_SALT = "_salt"


def salted(events: DataFrame, salts: int = SALTS) -> DataFrame:
    """Deals rows over ``salts`` by chance, whatever they hold, so that copies part."""
    return events.withColumn(_SALT, F.floor(F.rand(0) * salts).cast("int"))


def distinct_events(
    events: DataFrame,
    key: str,
    moment: str = "timestamp",
    watermark: str = DEDUP_WATERMARK,
    by_key_alone: bool = False,
    salts: int = SALTS,
) -> DataFrame:
    """First arrival of each key and event time; later ones are dropped.

    Rows older than the watermark are dropped too.  ``by_key_alone`` treats a key
    with another event time as the same event, for as long as the watermark
    remembers it.  On a bounded table it is a plain dedup.

    A stream is deduplicated twice: by salt, key and time, so that the copies of an event
    that floods the topic spread over the partitions of the state, and then by key and
    time, which sees at most ``salts`` of them for as long as they are remembered.  A salt
    dealt otherwise on replay lets no copy through.  ``salts=0`` saves the first state.
    """
    columns = [key] if by_key_alone else [key, moment]
    if not events.isStreaming:
        return events.dropDuplicates(columns)
    marked = events.withWatermark(moment, watermark)
    if salts:
        dealt = salted(marked, salts)
        marked = (
            dealt.dropDuplicatesWithinWatermark([_SALT, key]) if by_key_alone
            else dealt.dropDuplicates([_SALT, *columns])
        ).drop(_SALT)
    return marked.dropDuplicatesWithinWatermark([key]) if by_key_alone else marked.dropDuplicates(columns)


def _timed(messages: DataFrame, dataset: Dataset) -> DataFrame:
    rows = parsed(messages, dataset.message_columns)
    return rows.withColumn("at", event_time("data.timestamp"))


def stream_silver(messages: DataFrame, dataset: Dataset, **dedup) -> DataFrame:
    """Messages with a column ``value`` to stream silver rows; batch or stream alike.

    In a stream, rows without a time are left out before the state, which would keep
    them for ever; ``dead_letters`` has them.  A bounded table keeps them.
    """
    timed = _timed(messages, dataset)
    if messages.isStreaming:
        counts = [F.count(F.lit(1)).alias("rows"), F.count_if(_unusable(dataset)).alias("rejected")]
        timed = timed.observe(MESSAGES, *counts).filter(F.col("at").isNotNull())
    events = timed.filter(F.col(f"data.{dataset.key}").isNotNull()).select("data.*", "at")
    events = events.withColumn("timestamp", F.col("at")).drop("at")
    rows = with_eur(distinct_events(events, dataset.key, **dedup), dataset.amounts)
    return with_country(rows, dataset.country_from)


def _unusable(dataset: Dataset) -> Column:
    return F.col("data").isNull() | F.col(f"data.{dataset.key}").isNull() | F.col("at").isNull()


def dead_letters(messages: DataFrame, dataset: Dataset) -> DataFrame:
    """Messages without a key, unchanged; of a stream also those without a time."""
    if messages.isStreaming:
        return _timed(messages, dataset).filter(_unusable(dataset)).select(F.col("text").alias("value"))
    return rejected(parsed(messages, dataset.message_columns), dataset.key)


def stream_table(root: str, name: str, folders: Sequence[str] = ("country_code", "event_date")) -> StreamTable:
    """A dataset's stream silver; a thin one may be cut by day alone."""
    return StreamTable(f"{root.rstrip('/')}/silver/{name}_stream", list(folders))


def start(
    spark: SparkSession,
    name: str,
    channel: Channel,
    lake_root: str,
    checkpoints: str,
    trigger: dict | None = None,
    state_partitions: int | None = None,
    salts: int = SALTS,
    folders: Sequence[str] = ("country_code", "event_date"),
) -> list[StreamingQuery]:
    """Start the two queries of a dataset: silver rows and dead letters.

    ``salts`` belongs to the checkpoint's first run, as ``state_partitions`` does.
    """
    dataset = DATASETS[name]
    table = stream_table(lake_root, name, folders)

    def to_table_and_topic(rows: DataFrame, batch_id: int) -> None:
        table.write_batch(rows.withColumn("event_date", period_of("timestamp", "day")), batch_id)
        channel.write(to_messages(rows, dataset.key), dataset.silver_topic, f"{name}/batch_id={batch_id}")

    def to_dead_letters(rows: DataFrame, batch_id: int) -> None:
        channel.write(rows, REJECTED_TOPIC, f"{name}/batch_id={batch_id}")

    silver = stream_silver(channel.read_stream(spark, dataset.raw_topic), dataset, salts=salts)
    dead = dead_letters(channel.read_stream(spark, dataset.raw_topic), dataset)
    return [
        run(silver, to_table_and_topic, f"{checkpoints}/{name}_silver", "append", trigger, state_partitions),
        run(dead, to_dead_letters, f"{checkpoints}/{name}_dlq", "append", trigger),
    ]


def start_publisher(
    events: DataFrame, dataset: Dataset, channel: Channel, checkpoints: str, trigger: dict | None = None
) -> StreamingQuery:
    """Publish streamed CSV rows (``raw_files.event_stream``) to the raw topic."""

    def publish(rows: DataFrame, batch_id: int) -> None:
        channel.write(rows, dataset.raw_topic, f"files/batch_id={batch_id}")

    return run(to_messages(events, dataset.key), publish, f"{checkpoints}/{dataset.name}_publish", "append", trigger)
