"""JSON messages: one object per record, in a column called ``value``, beside an optional ``key``."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def to_messages(df: DataFrame, key: str | None = None) -> DataFrame:
    """One JSON object per row; NULL fields are left out.  ``key`` names the column of the message's key."""
    value = F.to_json(F.struct("*")).alias("value")
    return df.select(value) if key is None else df.select(F.col(key).cast("string").alias("key"), value)


def text_of(value: Column | str = "value") -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return value.cast("string")


def parsed(messages: DataFrame, columns: str) -> DataFrame:
    """The original text beside the parsed object.

    Text that is no JSON object gives an object of NULLs; a field of the wrong
    type gives NULL in that field only.
    """
    text = text_of()
    return messages.select(text.alias("text"), F.from_json(text, columns).alias("data"))


def accepted(parsed_messages: DataFrame, key: str) -> DataFrame:
    return parsed_messages.filter(F.col(f"data.{key}").isNotNull()).select("data.*")


def rejected(parsed_messages: DataFrame, key: str) -> DataFrame:
    """Messages without a key, unchanged."""
    no_key = F.col("data").isNull() | F.col(f"data.{key}").isNull()
    return parsed_messages.filter(no_key).select(F.col("text").alias("value"))


def event_time(text: Column | str) -> Column:
    """Timestamp from text, NULL where the text is none."""
    return F.try_to_timestamp(F.col(text) if isinstance(text, str) else text)


def _objects(messages: DataFrame) -> DataFrame:
    """Fields and values of all messages that are JSON objects."""
    value = F.try_parse_json(text_of())
    fields = F.try_variant_get(value, "$", "map<string, variant>")  # NULL for text that is no object
    return messages.select(F.explode(fields).alias("field", "value"))


def fields_found(messages: DataFrame) -> DataFrame:
    """``field, found, messages``: the type all values of a field share, and how many have it."""
    known = _objects(messages).filter(~F.is_variant_null("value"))
    return known.groupBy("field").agg(
        F.schema_of_variant_agg("value").alias("found"), F.count(F.lit(1)).alias("messages")
    )


def sample_schema(messages: DataFrame) -> str:
    """DDL of the fields of some messages, for exploring a topic; pipelines state their columns.

    Fields of any message count, types that differ are widened, text that is no JSON object
    is passed by.  All messages given are read: bound them, for instance by a range of a topic.
    """
    found = sorted((r["field"], r["found"].replace("OBJECT<", "STRUCT<")) for r in fields_found(messages).collect())
    if not found:
        raise RuntimeError("there is no JSON object to take a schema from")
    return f"STRUCT<{', '.join(f'{name}: {kind}' for name, kind in found)}>"


def _family(kind: Column) -> Column:
    """Types that JSON doesn't tell apart."""
    kind = F.lower(kind)
    number = kind.rlike("^(tinyint|smallint|int|bigint|long|float|double|decimal.*)$")
    return F.when(number, "number").when(kind.rlike("^(string|timestamp.*|date)$"), "string").otherwise(kind)


def schema_drift(messages: DataFrame, columns: str) -> DataFrame:
    """Stated columns against the fields that messages have: ``field, stated, found, messages, state``.

    ``SAME``, ``RETYPED`` (another kind of value than stated), ``MISSING`` (stated, in no
    message) or ``NEW`` (in a message, not stated).  Times are text in JSON.
    """
    stated = messages.sparkSession.createDataFrame(
        [tuple(c.split(" ", 1)) for c in columns.split(", ")], "field string, stated string"
    )
    both = stated.join(fields_found(messages), "field", "full")
    state = (
        F.when(F.col("stated").isNull(), "NEW").when(F.col("found").isNull(), "MISSING")
        .when(_family(F.col("stated")) == _family(F.col("found")), "SAME").otherwise("RETYPED")
    )
    return both.select(
        "field", "stated", _family(F.col("found")).alias("found"),
        F.coalesce("messages", F.lit(0)).alias("messages"), state.alias("state"),
    )


def as_table(messages: DataFrame, columns: Mapping[str, tuple[str, str]]) -> DataFrame:
    """A topic as typed columns: ``{column: (JSON field, type)}``, after the message's key as ``_key``."""
    fields = ", ".join(f"`{field}` {kind}" for field, kind in columns.values())
    key = F.col("key").cast("string") if "key" in messages.columns else F.lit(None).cast("string")
    data = messages.select(key.alias("_key"), F.from_json(text_of(), fields).alias("data"))
    return data.select("_key", *(F.col(f"data.`{field}`").alias(name) for name, (field, _) in columns.items()))


# Serving view of the silver bank topic, column -> (JSON field, type).
SILVER_BANK_TABLE = {
    "transaction_id": ("transaction_id", "string"),
    "event_time": ("timestamp", "string"),
    "account_id": ("account_id", "string"),
    "customer_id": ("customer_id", "string"),
    "country_code": ("country_code", "string"),
    "transaction_type": ("transaction_type", "string"),
    "amount": ("amount", "double"),
    "streaming_amount_eur": ("amount_eur", "double"),
    "currency": ("currency", "string"),
    "entity_type": ("entity_type", "string"),
}
