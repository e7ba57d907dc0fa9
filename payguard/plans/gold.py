"""Gold aggregates over decisions. All are plain DataFrames; sinks are elsewhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from payguard import settings as S
from payguard.functions.measures import latency_counts, latency_profile, pct, profile_of, status_counts


def _hour():
    return F.date_trunc("hour", "decision_at").alias("hour_bucket")


def _day():
    return F.to_date("decision_at").alias("day_bucket")


def merchant_hourly(silver: DataFrame) -> DataFrame:
    """Volume, duplicate rate and latency by merchant and hour of decision."""
    return merchant_of(merchant_counts(silver))


def merchant_counts(silver: DataFrame) -> DataFrame:
    return latency_counts(silver, ["merchant_id", _hour()])


def merchant_of(counts: DataFrame) -> DataFrame:
    """The same from ``merchant_counts``, those of several parts added up."""
    return profile_of(counts).select(
        "merchant_id", "hour_bucket",
        F.col("n").alias("total_payments"),
        F.col("n_accepted").alias("accepted_payments"),
        F.col("n_rejected").alias("rejected_duplicates"),
        pct(F.col("n_rejected"), F.col("n")).alias("duplicate_rate_pct"),
        F.col("avg_ms").alias("avg_latency_ms"),
        F.col("p95_ms").alias("p95_latency_ms"),
        F.col("p99_ms").alias("p99_latency_ms"),
    )


def sla_hourly(silver: DataFrame, sla_ms: int = S.SLA_MS) -> DataFrame:
    """Share of decisions under the latency target, and its distribution, by hour."""
    return sla_of(sla_counts(silver), sla_ms)


def sla_counts(silver: DataFrame) -> DataFrame:
    return latency_counts(silver, [_hour()])


def sla_of(counts: DataFrame, sla_ms: int = S.SLA_MS) -> DataFrame:
    """The same from ``sla_counts``, those of several parts added up."""
    return profile_of(counts, sla_ms).select(
        "hour_bucket",
        F.col("n").alias("total_decisions"),
        F.col("n_within").alias("within_sla_count"),
        F.col("n_breached").alias("breached_sla_count"),
        pct(F.col("n_within"), F.col("n")).alias("sla_compliance_pct"),
        F.col("avg_ms").alias("avg_latency_ms"),
        F.col("max_ms").alias("max_latency_ms"),
        F.col("p50_ms").alias("p50_latency_ms"),
        F.col("p95_ms").alias("p95_latency_ms"),
        F.col("p99_ms").alias("p99_latency_ms"),
    )


def customer_daily(silver: DataFrame, threshold: int = S.REVIEW_THRESHOLD) -> DataFrame:
    """Attempts and duplicates by customer and day; flagged above the threshold.

    ``max_retries_single_txn`` is the plain 0/1 "any duplicate" mark; the true
    depth is in ``customer_retries``.
    """
    return customer_of(customer_counts(silver), threshold)


def customer_counts(silver: DataFrame) -> DataFrame:
    return silver.groupBy("customer_id", _day()).agg(*status_counts())


def customer_of(counts: DataFrame, threshold: int = S.REVIEW_THRESHOLD) -> DataFrame:
    """The same from ``customer_counts``, those of several parts added up."""
    return counts.select(
        "customer_id", "day_bucket",
        F.col("n").alias("total_payments"),
        F.col("n_accepted").alias("unique_payments"),
        F.col("n_rejected").alias("duplicate_attempts"),
        F.when(F.col("n_rejected") > 0, 1).otherwise(0).alias("max_retries_single_txn"),
        (F.col("n_rejected") > threshold).alias("flagged_for_review"),
    )


SKETCH_BITS = 12  # of a distinct count: 4,096 registers, a standard error of 1.04 / 64


def unique_sketches(silver: DataFrame) -> DataFrame:
    """Sketches of the customers and merchants of each day. Those of several parts unite, so a
    late slice adds its own and no day is counted again; ``system_daily`` has the exact counts."""
    return silver.groupBy(_day()).agg(
        F.hll_sketch_agg("customer_id", SKETCH_BITS).alias("customers"),
        F.hll_sketch_agg("merchant_id", SKETCH_BITS).alias("merchants"),
    )


def united(sketches: DataFrame) -> DataFrame:
    """Sketches of several parts as those of the whole."""
    return sketches.groupBy("day_bucket").agg(
        F.hll_union_agg("customers").alias("customers"), F.hll_union_agg("merchants").alias("merchants")
    )


def unique_estimates(sketches: DataFrame) -> DataFrame:
    """Estimated distinct customers and merchants by day."""
    return sketches.select(
        "day_bucket",
        F.hll_sketch_estimate("customers").alias("unique_customers_estimate"),
        F.hll_sketch_estimate("merchants").alias("unique_merchants_estimate"),
    )


def customer_retries(silver: DataFrame) -> DataFrame:
    """Per customer and day: deepest retry chain and mean seconds between attempts.

    A chain is an accepted payment with the duplicates that name it. Gaps between
    neighbours in a chain add up to its span, so minimum, maximum and count per
    chain and day are enough: partial aggregates instead of a window over all
    attempts, safe for a chain of any length. A gap counts on the day it ends; the
    window only bridges the days of one chain.
    """
    chain = F.coalesce("original_payment_id", "payment_id").alias("_chain")
    per_day = silver.groupBy("customer_id", chain, _day()).agg(
        F.count("*").alias("_n"),
        F.count_if(F.col("dedup_status") == S.REJECTED_DUPLICATE).alias("_dups"),
        F.min("decision_at").alias("_lo"),
        F.max("decision_at").alias("_hi"),
    )
    w = Window.partitionBy("customer_id", "_chain").orderBy("day_bucket")
    before = F.lag("_hi").over(w)
    gaps = per_day.select(
        "customer_id", "day_bucket", "_dups",
        (F.unix_micros("_hi") - F.unix_micros(F.coalesce(before, "_lo"))).alias("_span"),
        (F.col("_n") - F.when(before.isNull(), 1).otherwise(0)).alias("_gaps"),
    )
    seconds = F.sum("_span").cast("decimal(20,0)") / F.nullif(F.sum("_gaps"), F.lit(0)).cast("decimal(20,0)")
    return gaps.groupBy("customer_id", "day_bucket").agg(
        F.max("_dups").alias("max_retries_per_payment"),
        F.sum("_gaps").alias("retry_gaps"),
        F.round(seconds / 1_000_000, 2).alias("avg_retry_interval_sec"),
    )


def system_daily(bronze: DataFrame, silver: DataFrame, sla_ms: int = S.SLA_MS) -> DataFrame:
    """The whole system by day. Received counts Bronze by ingest day, the rest
    Silver by decision day; a day seen by one layer only is kept."""
    received = bronze.groupBy(F.to_date("ingested_at").alias("day_bucket")).agg(
        F.count("*").alias("total_events_received")
    )
    profile = latency_profile(silver, [_day()], sla_ms)
    distinct = silver.groupBy(_day()).agg(
        F.count_distinct("customer_id").alias("unique_customers"),
        F.count_distinct("merchant_id").alias("unique_merchants"),
    )
    joined = profile.join(distinct, "day_bucket").join(received, "day_bucket", "full_outer")
    zero = F.lit(0)
    return joined.select(
        "day_bucket",
        F.coalesce("total_events_received", zero).alias("total_events_received"),
        F.coalesce("n_accepted", zero).alias("total_accepted"),
        F.coalesce("n_rejected", zero).alias("total_rejected"),
        F.coalesce(pct(F.col("n_rejected"), F.col("n")), zero).alias("overall_duplicate_rate"),
        F.coalesce(pct(F.col("n_within"), F.col("n")), zero).alias("overall_sla_compliance"),
        F.col("avg_ms").alias("avg_latency_ms"),
        F.col("p99_ms").alias("p99_latency_ms"),
        F.coalesce("unique_customers", zero).alias("unique_customers"),
        F.coalesce("unique_merchants", zero).alias("unique_merchants"),
    )


def flagged_top(gold_customer: DataFrame, top: int = S.FLAGGED_TOP) -> DataFrame:
    """Flagged customer-days with most duplicates; ties by customer, then day."""
    return (
        gold_customer.filter("flagged_for_review")
        .select("customer_id", "day_bucket", "duplicate_attempts")
        .orderBy(F.desc("duplicate_attempts"), "customer_id", "day_bucket")
        .limit(top)
    )
