"""Payment messages: reading them, and turning text into Bronze columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from payguard import settings as S
from payguard.functions.keys import iso_utc
from payguard.schemas import MESSAGE


def kafka_stream(
    spark: SparkSession,
    servers: str,
    topic: str = S.TOPIC_RAW,
    max_per_trigger: int | None = S.MAX_MESSAGES_PER_TRIGGER,
    min_partitions: int | None = None,
) -> DataFrame:
    """The topic from its earliest offset. Needs the Kafka connector on the class path.

    ``max_per_trigger`` bounds a batch; ``min_partitions`` splits a topic of few
    partitions over more tasks, as parsing is the costly part.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    if max_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    if min_partitions:
        reader = reader.option("minPartitions", min_partitions)
    return reader.load().select(
        F.col("value").cast("string").alias("value"),
        F.col("timestamp").alias("ingested_at"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
    )


def file_stream(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    files_per_trigger: int | None = S.MAX_FILES_PER_TRIGGER,
    schema=None,
) -> DataFrame:
    """A folder of message files as a stream; ``text`` gives one message per line.
    ``files_per_trigger`` bounds a batch."""
    reader = spark.readStream.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def spread(batch: DataFrame) -> DataFrame:
    """The rows of a batch dealt evenly over tasks, more of them the larger it is. A file of few row groups, or a topic of
    few partitions, is read by as few tasks, and parsing and deciding cost far more than reading."""
    return batch.hint("rebalance")


def encode(events: DataFrame, embed_payload: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """Events as keyed messages: ``key`` is the customer, ``value`` the JSON record.

    Times are written ISO-8601 with offset, amounts as JSON numbers, nulls kept.
    With ``embed_payload`` the record carries itself once more as ``raw_payload``.
    """
    fields = [
        F.col("amount").cast("double").alias(c) if c == "amount"
        else iso_micros(c).alias(c) if c == "event_timestamp"
        else F.col(c) if c in events.columns else F.lit(None).cast("string").alias(c)
        for c in MESSAGE.fieldNames() if c != "_corrupt_record"
    ]
    body = F.struct(*fields)
    if embed_payload:
        body = F.struct(*fields, F.struct(*fields).alias("raw_payload"))
    carried = ("ingested_at", "kafka_partition", "kafka_offset", *keep)
    return events.select(
        F.col("customer_id").alias("key"),
        F.to_json(body, {"ignoreNullFields": "false"}).alias("value"),
        *[c for c in carried if c in events.columns],
    )


def encode_decisions(silver: DataFrame) -> DataFrame:
    """Decision records as messages keyed by customer, for the decisions topic."""
    fields = [
        F.col(f.name).cast("double").alias(f.name) if f.name == "amount"
        else iso_micros(f.name).alias(f.name) if f.dataType.typeName() == "timestamp"
        else F.col(f.name)
        for f in silver.schema.fields
    ]
    return silver.select(
        F.col("customer_id").alias("key"),
        F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("value"),
    )


def encode_dead_letters(refused: DataFrame) -> DataFrame:
    """Refused messages for the dead-letter topic: the text as received, the reason beside it."""
    return refused.select(
        F.col("payment_id").alias("key"),
        F.to_json(F.struct("invalid_reason", "raw_payload")).alias("value"),
    )


def publish(messages: DataFrame, servers: str, topic: str, checkpoint: str | None = None):
    """Write keyed messages to a topic: a batch, or a stream when the frame is one.

    Needs the Kafka connector on the class path.
    """
    keyed = messages.select("key", "value")
    options = {"kafka.bootstrap.servers": servers, "topic": topic}
    if not keyed.isStreaming:
        return keyed.write.format("kafka").options(**options).save()
    return keyed.writeStream.format("kafka").options(**options, checkpointLocation=checkpoint).start()


def topic_writer(servers: str):
    """For the ``publish`` of a stream: a batch of keyed messages to a topic, at least once."""
    return lambda batch, topic: publish(batch, servers, topic)


def folder_writer(path: str):
    """The same into a folder for each topic, one JSON line a message; stands in for a broker."""

    def write(batch: DataFrame, topic: str) -> None:
        batch.select("key", "value").write.mode("append").json(f"{path}/{topic}")

    return write


def iso_micros(ts: str) -> Column:
    return iso_utc(ts, micros=True)


def decode(messages: DataFrame, value: str = "value") -> DataFrame:
    """Parse JSON text: one string column per field, plus ``raw_payload``.

    ``_corrupt_record`` is set when the text is not JSON. Types come later, in
    ``typed``, after validity has looked at the text.

    The record passes through a one-element ``explode``: filters on fields are not
    pushed below it, where each field would parse the text again.
    """
    parsed = F.from_json(
        F.col(value), MESSAGE, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    )
    rest = [c for c in messages.columns if c not in (value, "key")]
    return messages.select(F.explode(F.array(parsed)).alias("_m"), F.col(value).alias("raw_payload"), *rest).select(
        "_m.*", "raw_payload", *rest
    )


def typed(decoded: DataFrame) -> DataFrame:
    """Bronze columns: casts, and defaults for the two optional retry fields."""

    def cast(name: str, to: str, default=None) -> Column:
        out = F.col(name).try_cast(to)
        return (F.coalesce(out, F.lit(default).cast(to)) if default is not None else out).alias(name)

    fixed = {
        "amount": cast("amount", "decimal(18,4)"),
        "retry_count": cast("retry_count", "smallint", 0),
        "is_retry_flag": cast("is_retry_flag", "boolean", False),
        "event_timestamp": cast("event_timestamp", "timestamp"),
    }
    return decoded.select(
        *[fixed.get(c, F.col(c)) for c in decoded.columns if c != "_corrupt_record"]
    )
