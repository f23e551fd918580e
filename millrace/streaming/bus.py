"""Message topics: publishing, subscribing, start positions, ordering and decoding.

A topic is a folder of message files. A streaming query is a subscription: its
checkpoint says what it has acknowledged, which happens when a batch is complete.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

MESSAGE = "payload binary, attributes map<string,string>, ordering_key string, message_id string, publish_time timestamp"


def message(payload: Column, attributes: Column | None = None, ordering_key: Column | None = None, identity: Column | None = None, publish_time: Column | None = None) -> list[Column]:
    """The columns of messages; a null attribute key or value is an error, no ordering key is null."""
    given = attributes if attributes is not None else F.create_map().cast("map<string,string>")
    refuse = F.raise_error(F.lit("attributes need keys and values")).cast("map<string,string>")
    checked = F.when(F.exists(F.map_values(given), lambda v: v.isNull()), refuse).otherwise(F.coalesce(given, F.create_map().cast("map<string,string>")))
    key = F.when(ordering_key != "", ordering_key) if ordering_key is not None else F.lit(None).cast("string")
    binary = payload.cast("binary")
    return [
        binary.alias("payload"),
        checked.alias("attributes"),
        key.alias("ordering_key"),
        (identity.cast("string") if identity is not None else F.sha2(F.concat(binary, F.coalesce(key, F.lit("")).cast("binary")), 256)).alias("message_id"),
        (publish_time.cast("timestamp") if publish_time is not None else F.current_timestamp()).alias("publish_time"),
    ]


def publish(messages: DataFrame, topic: str) -> None:
    """Appends messages that have the columns of ``MESSAGE``."""
    messages.select("payload", "attributes", "ordering_key", "message_id", "publish_time").write.mode("append").parquet(topic)


def publish_routed(messages: DataFrame, topics: str, topic: str = "topic") -> None:
    """Appends messages to the topics they name, all in one pass."""
    messages.select(topic, "payload", "attributes", "ordering_key", "message_id", "publish_time").write.mode("append").partitionBy(topic).parquet(topics)


def subscribe(spark: SparkSession, topic: str, attribute_filter: str | None = None, start: datetime | None = None, max_files: int | None = None, subscription: str = "default") -> DataFrame:
    """A stream of a topic's messages from ``start`` on.

    The start position holds when a query begins; a restarted query goes on from its
    checkpoint. ``max_files`` bounds what one micro-batch admits.
    """
    reader = spark.readStream.schema(MESSAGE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    df = reader.parquet(topic)
    if start is not None:
        df = df.filter(F.col("publish_time") >= F.lit(start))
    if attribute_filter:
        df = df.where(attribute_filter)
    return df.withColumn("subscription", F.lit(subscription))


def per_key_order(batch: DataFrame) -> DataFrame:
    """A micro-batch with each ordering key's messages together, in order of publishing.

    Keyless messages need no order and are spread.
    """
    spread = F.when(F.col("ordering_key").isNull(), F.xxhash64("message_id")).otherwise(F.xxhash64("ordering_key"))
    return batch.withColumn("_spread", spread).repartition("_spread").sortWithinPartitions("ordering_key", "publish_time", "message_id").drop("_spread")


def split_owners(subscriptions: DataFrame, parallelism: int, ordering: str = "per_key", name: str = "subscription") -> DataFrame:
    """Which reader owns which part of which subscription: split, subscription, owner.

    With ordering ``per_key`` a subscription is one split, so that its keys stay
    together; with ``none`` there are at least as many splits as readers. Splits go
    round the readers in turn. Subscriptions are what a user lists, one row each.
    """
    if ordering not in ("per_key", "none"):
        raise ValueError(f"no ordering mode {ordering}")
    numbered = subscriptions.select(name).distinct().withColumn("_n", F.row_number().over(Window.orderBy(name)) - 1).withColumn("_of", F.count("*").over(Window.partitionBy()))
    splits = F.col("_of") if ordering == "per_key" else F.greatest("_of", F.lit(parallelism))
    own = F.sequence(F.col("_n").cast("long"), splits.cast("long") - 1, F.col("_of").cast("long"))
    return numbered.select(F.explode(own).alias("split"), F.col(name).alias("subscription")).withColumn("owner", F.col("split") % parallelism)


def expand(messages: DataFrame, records: Callable[[Column], Column], name: str = "record") -> DataFrame:
    """Each message as the records that its payload holds, none to many; ``records`` makes an array of them.

    A message whose array is empty or null gives no row.
    """
    return messages.select("*", F.explode(records(F.col("payload"))).alias(name))


def decode_json(messages: DataFrame, schema: str, policy: str = "fail") -> DataFrame:
    """Payload fields beside the message's own columns.

    Under ``fail`` a payload that is no such JSON fails the query, under ``drop`` it is
    left out, under ``nack`` it stays with ``_failed`` for a dead-letter topic. No JSON
    are also a null or empty payload, one of blanks, one that is no UTF-8, and ``null``.
    """
    if policy not in ("fail", "drop", "nack"):
        raise ValueError(f"no decoding policy {policy}")
    text = F.try_validate_utf8(F.col("payload").cast("string"))
    parsed = F.from_json(text, schema + ", _corrupt string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    # blanks and the literal null give no row at all, or one that no field tells from an empty object
    failed = text.isNull() | F.trim(text, F.lit(" \t\r\n")).isin("", "null") | F.col("_v").isNull() | F.col("_v._corrupt").isNotNull()
    tried = messages.withColumn("_v", parsed).withColumn("_failed", F.coalesce(failed, F.lit(True)))
    if policy == "fail":
        tried = tried.filter(F.when(~F.col("_failed"), F.lit(True)).otherwise(F.raise_error(F.lit("a payload that is no JSON of the schema")).cast("boolean")))
    if policy == "drop":
        tried = tried.filter(~F.col("_failed"))
    out = tried.select("*", "_v.*").drop("_v", "_corrupt")
    return out if policy == "nack" else out.drop("_failed")
