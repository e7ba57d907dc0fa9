"""Reconciliation of Bronze against Silver. Aggregates only; nothing is collected."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payguard import settings as S
from payguard.functions.measures import latency_profile, pct


def _accepted() -> Column:
    return F.col("dedup_status") == S.ACCEPTED


def _rejected() -> Column:
    return F.col("dedup_status") == S.REJECTED_DUPLICATE


def layer_counts(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """Total, duplicates and fresh per layer: one row for each."""
    b = bronze.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("is_retry_flag")).alias("duplicates"),
        F.count_if(~F.col("is_retry_flag")).alias("fresh"),
    )
    s = silver.agg(
        F.count("*").alias("total"), F.count_if(_rejected()).alias("duplicates"), F.count_if(_accepted()).alias("fresh")
    )
    return b.select(F.lit(S.BRONZE_LABEL).alias("layer"), "*").unionByName(
        s.select(F.lit(S.SILVER_LABEL).alias("layer"), "*")
    )


def _flag_by_status(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """Joined Bronze rows per status, split by the retry flag: one row per status.

    Bronze is counted per payment before the join, so copies of one message,
    however many, arrive as one row, and both sides are unique on the join key.
    """
    per_payment = bronze.groupBy("payment_id").agg(
        F.count_if(F.col("is_retry_flag")).alias("_retry"),
        F.count_if(~F.col("is_retry_flag")).alias("_fresh"),
    )
    return (
        per_payment.join(silver.select("payment_id", "dedup_status"), "payment_id")
        .groupBy("dedup_status")
        .agg(F.sum("_retry").alias("_retry"), F.sum("_fresh").alias("_fresh"))
    )


def detection_accuracy(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """Rows per (retry flag, decision), ordered."""
    cells = F.explode(
        F.array(
            F.struct(F.lit(False).alias("is_retry_flag"), F.col("_fresh").alias("count")),
            F.struct(F.lit(True).alias("is_retry_flag"), F.col("_retry").alias("count")),
        )
    )
    return (
        _flag_by_status(bronze, silver)
        .select("dedup_status", cells.alias("c"))
        .select("c.is_retry_flag", "dedup_status", "c.count")
        .filter("count > 0")
        .orderBy("is_retry_flag", "dedup_status")
    )


def confusion_matrix(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """One row: true and false positives and negatives; zeros on empty input."""

    def total(status: Column, part: str) -> Column:
        return F.coalesce(F.sum(F.when(status, F.col(part))), F.lit(0))

    return _flag_by_status(bronze, silver).agg(
        total(_rejected(), "_retry").alias("tp"),
        total(_accepted(), "_fresh").alias("tn"),
        total(_rejected(), "_fresh").alias("fp"),
        total(_accepted(), "_retry").alias("fn"),
    )


def precision_recall(matrix: DataFrame) -> DataFrame:
    """Adds precision and recall, zero where nothing was rejected or flagged."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")

    def ratio(a: Column, b: Column) -> Column:
        return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))

    return matrix.select(
        "tp", "tn", "fp", "fn",
        F.round(ratio(tp, tp + fp), 6).alias("precision"),
        F.round(ratio(tp, tp + fn), 6).alias("recall"),
    )


def sla_report(silver: DataFrame, sla_ms: int = S.SLA_MS) -> DataFrame:
    """One row: compliance and latency statistics over all decisions."""
    return latency_profile(silver, [], sla_ms).select(
        F.coalesce("n_within", F.lit(0)).alias("within_sla"),
        F.coalesce("n_breached", F.lit(0)).alias("breached"),
        pct(F.col("n_within"), F.col("n")).alias("compliance_pct"),
        "avg_ms", "p95_ms", "p99_ms", "max_ms",
    )


def merchant_rates(silver: DataFrame) -> DataFrame:
    """All-time duplicate rate by merchant, highest first (ties by merchant)."""
    return (
        silver.groupBy("merchant_id")
        .agg(F.count("*").alias("total"), F.count_if(_accepted()).alias("accepted"), F.count_if(_rejected()).alias("rejected"))
        .withColumn("duplicate_rate_pct", pct(F.col("rejected"), F.col("total")))
        .orderBy(F.desc("duplicate_rate_pct"), "merchant_id")
    )


def merchant_bands(rates: DataFrame) -> DataFrame:
    """Traffic light on the rate; both limits are strict."""
    rate = F.col("duplicate_rate_pct")
    band = F.when(rate > S.RATE_BAND_RED, "red").when(rate > S.RATE_BAND_YELLOW, "yellow").otherwise("green")
    return rates.withColumn("band", band)


def missing_decisions(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """Payments one layer has and the other lacks, with the number of Bronze rows.

    One full outer join of per-payment counts instead of two anti joins over rows.
    """
    b = bronze.groupBy("payment_id").agg(F.count("*").alias("_b"))
    s = silver.groupBy("payment_id").agg(F.count("*").alias("_s"))
    both = b.join(s, "payment_id", "full_outer")
    missing = F.when(F.col("_s").isNull(), "silver").when(F.col("_b").isNull(), "bronze")
    return both.select(
        "payment_id", missing.alias("missing_in"),
        F.coalesce("_b", "_s").alias("row_count"),
    ).filter(F.col("missing_in").isNotNull())


def summary(bronze: DataFrame, silver: DataFrame, gold_customer: DataFrame, sla_ms: int = S.SLA_MS) -> DataFrame:
    """One row with all totals.

    Silver is read once for its six figures. The three one-row results are put
    side by side by a union and a maximum, not by a product of tables.
    """
    profile = latency_profile(silver, [], sla_ms).select(
        F.coalesce("n", F.lit(0)).alias("silver_total"),
        F.coalesce("n_accepted", F.lit(0)).alias("accepted"),
        F.coalesce("n_rejected", F.lit(0)).alias("rejected"),
        F.col("avg_ms").alias("avg_latency_ms"),
        F.col("p99_ms").alias("p99_latency_ms"),
        F.coalesce("n_breached", F.lit(0)).alias("sla_breaches"),
    )
    received = bronze.agg(F.count("*").alias("bronze_total"))
    flagged = gold_customer.agg(F.count_if(F.col("flagged_for_review")).alias("flagged_customers"))
    wide = received.unionByName(profile, allowMissingColumns=True).unionByName(
        flagged, allowMissingColumns=True
    )
    one = wide.agg(*[F.max(c).alias(c) for c in wide.columns])
    rate = F.round(F.col("rejected").cast("decimal(20,0)") * 100
                   / F.nullif(F.col("bronze_total"), F.lit(0)).cast("decimal(20,0)"), 1)
    return one.select("*", rate.alias("duplicate_rate_pct"))


def verdicts(summary_row: DataFrame, matrix: DataFrame) -> DataFrame:
    """One row of checks. The overall status looks at totals and the latency
    target; detection accuracy is reported beside it, not part of it."""
    s = summary_row.select("bronze_total", "silver_total", "sla_breaches")
    wide = s.unionByName(matrix.select("fp", "fn"), allowMissingColumns=True)
    one = wide.agg(*[F.max(c).alias(c) for c in wide.columns])
    counts = F.col("bronze_total") == F.col("silver_total")
    sla = (F.col("sla_breaches") == 0) & (F.col("silver_total") > 0)
    overall = counts & (F.col("sla_breaches") == 0)
    # The two overall status texts.
    text = F.when(overall, "ALL CHECKS PASSED").otherwise("REVIEW REQUIRED")
    return one.select(
        counts.alias("counts_match"),
        ((F.col("fp") == 0) & (F.col("fn") == 0)).alias("detection_perfect"),
        sla.alias("sla_met"),
        text.alias("overall_status"),
    )
