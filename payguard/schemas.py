"""Column layouts of the message, Bronze, Silver, Gold and control tables."""

from __future__ import annotations

import re

from pyspark.sql import types as T


def struct_of(columns: str) -> T.StructType:
    """``name type, ...`` as a struct. Unlike ``fromDDL`` it needs no session."""
    out = T.StructType()
    for column in re.split(r",\s*(?![0-9])", columns):
        name, kind = column.split()
        out.add(name, kind)
    return out


# Table and message columns, in order, with their types.

# The message as text: every field is read as a string and cast afterwards, so
# that one bad field is named in the dead letter instead of blanking the record.
MESSAGE = struct_of(
    "payment_id string, idempotency_key string, customer_id string, merchant_id string,"
    " amount string, currency string, payment_method string, status string,"
    " source_ip string, user_agent string, retry_count string, is_retry_flag string,"
    " original_payment_id string, event_timestamp string, _corrupt_record string"
)

BRONZE = struct_of(
    "payment_id string, idempotency_key string, customer_id string, merchant_id string,"
    " amount decimal(18,4), currency string, payment_method string, status string,"
    " source_ip string, user_agent string, retry_count short, is_retry_flag boolean,"
    " original_payment_id string, event_timestamp timestamp, ingested_at timestamp,"
    " raw_payload string, kafka_partition integer, kafka_offset long"
)

SILVER = struct_of(
    "payment_id string, idempotency_key string, idempotency_key_hash string,"
    " customer_id string, merchant_id string, amount decimal(18,4), currency string,"
    " payment_method string, dedup_status string, rejection_reason string,"
    " original_payment_id string, processing_latency_ms long, redis_lookup_ms short,"
    " kafka_lag_ms long, event_timestamp timestamp, decision_at timestamp,"
    " flink_job_id string, kafka_partition short, kafka_offset long"
)

# The tables as stored, with their partition columns.
BRONZE_TABLE = T.StructType([*BRONZE.fields]).add("ingested_date", "date").add("batch_id", "long")
SILVER_TABLE = T.StructType([*SILVER.fields]).add("decision_date", "date").add("batch_id", "long")

# Counters and latencies are 64 bits wide: a day of a large system has more events than
# fit 32, and a replay of old events, decided now, has latencies of days.
GOLD_MERCHANT = struct_of(
    "merchant_id string, hour_bucket timestamp, total_payments long, accepted_payments long,"
    " rejected_duplicates long, duplicate_rate_pct decimal(5,2), avg_latency_ms decimal(20,2),"
    " p95_latency_ms decimal(20,2), p99_latency_ms decimal(20,2), aggregated_at timestamp"
)

GOLD_SLA = struct_of(
    "hour_bucket timestamp, total_decisions long, within_sla_count long,"
    " breached_sla_count long, sla_compliance_pct decimal(5,2), avg_latency_ms decimal(20,2),"
    " max_latency_ms long, p50_latency_ms decimal(20,2), p95_latency_ms decimal(20,2),"
    " p99_latency_ms decimal(20,2), aggregated_at timestamp"
)

GOLD_CUSTOMER = struct_of(
    "customer_id string, day_bucket date, total_payments long, unique_payments long,"
    " duplicate_attempts long, max_retries_single_txn short,"
    " avg_retry_interval_sec decimal(20,2), flagged_for_review boolean,"
    " aggregated_at timestamp"
)

GOLD_SYSTEM = struct_of(
    "day_bucket date, total_events_received long, total_accepted long, total_rejected long,"
    " overall_duplicate_rate decimal(5,2), overall_sla_compliance decimal(5,2),"
    " avg_latency_ms decimal(20,2), p99_latency_ms decimal(20,2), unique_customers long,"
    " unique_merchants long, aggregated_at timestamp"
)

GOLD_UNIQUES = struct_of(
    "day_bucket date, unique_customers_estimate long, unique_merchants_estimate long, aggregated_at timestamp"
)

WATERMARKS = struct_of(
    "pipeline_name string, last_processed_at timestamp, last_run_at timestamp,"
    " rows_processed long"
)


def conform(df, schema: T.StructType):
    """Select the schema's columns in order, cast to its types; absent ones are null."""
    from pyspark.sql import functions as F

    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )
