"""Payment events derived from the ``events`` table of the test data.

Every event is a payment; some are retried, a few of them often. A retry keeps
customer, merchant, amount, currency and original time but has its own id,
method and arrival. The rules are fixed so that an independent SQL text can
state the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payguard.functions.keys import idempotency_key
from payguard.sources import messages

# The domains of the generated fields, in order.
CURRENCIES = ("NGN", "USD", "GBP", "EUR", "KES", "GHS")
METHODS = ("card", "bank_transfer", "wallet", "ussd")
STATUSES = ("initiated", "pending")


def _pick(values: tuple[str, ...], index):
    return F.element_at(F.array(*map(F.lit, values)), (index % len(values) + 1).cast("int"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def payments_from(source: DataFrame, edge: bool = False) -> DataFrame:
    """Payment events from event rows. Works on a stream as well: no shuffle.

    ``edge``: some retries are stamped one bucket later (the engine must accept
    them) and some repeats are genuine purchases (the engine rejects them).
    """
    eid = F.col("event_id")
    last = F.when(eid % 100 == 0, 5).when(eid % 20 < 3, 1).otherwise(0)
    # NTZ input is taken as UTC, the session time zone of all jobs.
    rows = source.select(
        "event_id", "user_id", F.col("value").cast("decimal(18,4)").alias("amount"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.explode(F.sequence(F.lit(0), last)).alias("n"),
    )
    n = F.col("n")
    ts, retry = F.col("ts"), n > 0
    if edge:
        ts = F.when((n == 1) & (eid % 40 == 1), ts + F.expr("interval 5 minutes")).otherwise(ts)
        retry = retry & (eid % 40 != 2)
    first_id = F.concat(F.lit("pay_"), eid.cast("string"))
    retry_id = F.concat(F.lit("ret_"), eid.cast("string"), F.lit("_"), n.cast("string"))
    out = rows.select(
        F.when(n == 0, first_id).otherwise(retry_id).alias("payment_id"),
        F.concat(F.lit("cust_"), F.col("user_id").cast("string")).alias("customer_id"),
        F.concat(F.lit("merchant_"), (eid % 10).cast("string")).alias("merchant_id"),
        "amount",
        _pick(CURRENCIES, eid).alias("currency"),
        _pick(METHODS, eid + n).alias("payment_method"),
        _pick(STATUSES, eid + n).alias("status"),
        n.cast("smallint").alias("retry_count"),
        retry.alias("is_retry_flag"),
        F.when(n > 0, first_id).alias("original_payment_id"),
        ts.alias("event_timestamp"),
        (ts + n * F.expr("interval 7 seconds")).alias("ingested_at"),
        (F.col("user_id") % 6).cast("int").alias("kafka_partition"),
        ((eid * 7919 + n * 31) % 61).cast("int").alias("processing_latency_ms"),
    )
    decision_us = F.unix_micros("ingested_at") + F.col("processing_latency_ms") * 1000
    return out.select(
        "payment_id", idempotency_key().alias("idempotency_key"), *out.columns[1:],
        F.timestamp_micros(decision_us).alias("decision_at"),
    )


def payments(spark: SparkSession, sf_dir: str, edge: bool = False) -> DataFrame:
    return payments_from(events(spark, sf_dir), edge)


def coarse_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events under a coarse key (user and type), so that keys outlive their time to live."""
    return events(spark, sf_dir).select(
        F.concat(F.lit("pay_"), F.col("event_id").cast("string")).alias("payment_id"),
        F.concat_ws("|", F.col("user_id").cast("string"), "event_type").alias("idempotency_key"),
        F.col("ts").cast("timestamp").alias("ingested_at"),
    )


def message_stream(payments_df: DataFrame) -> DataFrame:
    """The payments as JSON messages."""
    return messages.encode(payments_df)


def faulty_messages(payments_df: DataFrame) -> DataFrame:
    """The same messages, one in ten spoiled in one of five ways by payment number."""
    number = F.regexp_extract("payment_id", r"_(\d+)", 1).cast("bigint")
    coded = messages.encode(payments_df.withColumn("_kind", number % 50), keep=("_kind",))
    value = F.col("value")
    spoiled = (
        F.when(F.col("_kind") == 0, F.expr("left(value, length(value) - 20)"))
        .when(F.col("_kind") == 1, F.regexp_replace(value, r'"payment_id":"[^"]*",', ""))
        .when(F.col("_kind") == 2, F.regexp_replace(value, r'"currency":"([A-Z]{3})"', '"currency":"$1X"'))
        .when(F.col("_kind") == 3, F.regexp_replace(value, r'"amount":[0-9.E-]+', '"amount":"n/a"'))
        .when(F.col("_kind") == 4, F.regexp_replace(value, r'"customer_id":"[^"]*"', '"customer_id":null'))
        .otherwise(value)
    )
    return coded.withColumn("value", spoiled).drop("_kind")
