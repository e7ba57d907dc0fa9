"""The registry as a table: which keys are held, by whom, until when."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payguard import settings as S
from payguard.schemas import struct_of


def acceptances(decided: DataFrame, key: str = "idempotency_key", at: str = "ingested_at") -> DataFrame:
    """One registry entry per acceptance: key, payment, time taken."""
    return (
        decided.filter(F.col("dedup_status") == S.ACCEPTED)
        .groupBy(F.col(key).alias("idempotency_key"), "payment_id")
        .agg(F.min(at).alias("accepted_at"))
    )


def latest_entries(registry: DataFrame) -> DataFrame:
    """The newest acceptance of each key; a re-acceptance replaces the older one."""
    newest = F.max(F.struct("accepted_at", "payment_id"))
    return (
        registry.groupBy("idempotency_key").agg(newest.alias("_e"))
        .select("idempotency_key", "_e.payment_id", "_e.accepted_at")
    )


def live_keys(registry: DataFrame, now: Column | str, ttl: int = S.TTL_SECONDS) -> DataFrame:
    """Registry size at an instant: entries taken by then and not yet expired."""
    at = F.to_timestamp(F.lit(now)) if isinstance(now, str) else now
    end = F.timestamp_micros(F.unix_micros("accepted_at") + F.lit(ttl * 1_000_000))
    return registry.filter((F.col("accepted_at") <= at) & (end > at)).agg(
        F.count_distinct("idempotency_key").alias("live_keys")
    )


def decision_counts(decided: DataFrame) -> DataFrame:
    """Processed, accepted, rejected and invalid totals of one run."""
    return decided.agg(
        F.count("*").alias("total_processed"),
        F.count_if(F.col("dedup_status") == S.ACCEPTED).alias("total_accepted"),
        F.count_if(F.col("dedup_status") == S.REJECTED_DUPLICATE).alias("total_rejected"),
        F.count_if(F.col("dedup_status") == S.REJECTED_INVALID).alias("total_errors"),
    )


COUNTERS = struct_of(
    "total_received long, total_processed long, total_accepted long, total_rejected long, total_errors long, batch_id long"
)


def batch_counts(decided: DataFrame, received: int, errors: int) -> DataFrame:
    """One batch: messages received, decided by finding, and refused. What is received is decided or refused;
    a refused message that is recorded as well counts once, as refused."""
    counts = decision_counts(decided.filter(F.col("dedup_status") != S.REJECTED_INVALID))
    return counts.select(F.lit(received).cast("long").alias("total_received"), "total_processed", "total_accepted", "total_rejected",
                         F.lit(errors).cast("long").alias("total_errors"))


def running_counts(counters: DataFrame, upto_batch: int | None = None) -> DataFrame:
    """Totals over the batches of a counter table, one row a batch."""
    if upto_batch is not None:
        counters = counters.filter(F.col("batch_id") <= upto_batch)
    names = COUNTERS.fieldNames()[:-1]
    return counters.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names], F.count("*").alias("batches"))
