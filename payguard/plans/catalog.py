"""Named queries: every operator and pipeline over the given tables.

Each takes (spark, folder of parquet tables) and returns a DataFrame. Results
are flattened to bigint, double, string, boolean and timestamp so that another
engine's result can be compared with them cell by cell.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from payguard import schemas
from payguard import settings as S
from payguard.functions import keys, measures
from payguard.operators import dedup, registry, tables, validity, watermark
from payguard.plans import gold, incremental, recon
from payguard.session import run_dir
from payguard.sources import derived, messages
from payguard.streaming import bronze as bronze_stream
from payguard.streaming import dedup as dedup_stream
from payguard.streaming import stateful

Query = Callable[[SparkSession, str], DataFrame]

# Instants used as marks and clocks; the derived events lie in January 2024.
MARK = "2024-01-15 12:20:00"
SECOND_RUN = "2024-01-20 09:30:00"
REGISTRY_CLOCK = "2024-01-15 12:00:00"
FAR_PAST = "1970-01-01 00:00:00"


def _ts(text: str):
    return F.lit(text).cast("timestamp")


def flat(df: DataFrame) -> DataFrame:
    """Comparable column types: integers to bigint, decimals to double, dates to text."""

    def to(field: T.StructField):
        c = F.col(field.name)
        if isinstance(field.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            return c.cast("bigint").alias(field.name)
        if isinstance(field.dataType, (T.DecimalType, T.FloatType)):
            return c.cast("double").alias(field.name)
        if isinstance(field.dataType, T.DateType):
            return c.cast("string").alias(field.name)
        return c

    return df.select(*[to(f) for f in df.schema.fields])


# -- layers -------------------------------------------------------------------


def bronze(spark: SparkSession, d: str, edge: bool = False) -> DataFrame:
    return derived.payments(spark, d, edge)


def silver(spark: SparkSession, d: str, edge: bool = False) -> DataFrame:
    """Decisions over all payments: the input of Gold and reconciliation."""
    return dedup.silver_records(dedup.decide(bronze(spark, d, edge)))


# -- keys and projections -----------------------------------------------------


def idempotency_key(spark, d):
    return bronze(spark, d).select("payment_id", "idempotency_key")


def five_minute_bucket(spark, d):
    ev = derived.events(spark, d)
    return ev.select(
        "event_id", keys.five_minute_bucket(F.col("ts").cast("timestamp")).alias("bucket")
    )


def key_mismatch(spark, d):
    """Edge payments under the keys of the plain ones: shifted retries stand out."""
    carried = bronze(spark, d).select("payment_id", "idempotency_key")
    shifted = bronze(spark, d, edge=True).drop("idempotency_key")
    return keys.key_mismatches(shifted.join(carried, "payment_id"))


def latency_ms(spark, d):
    return flat(bronze(spark, d).select("payment_id", measures.latency_ms().alias("latency_ms")))


def kafka_projection(spark, d):
    return derived.message_stream(bronze(spark, d)).select("key", "value")


def decisions_projection(spark, d):
    return messages.encode_decisions(silver(spark, d))


BRONZE_COLUMNS = [
    "payment_id", "idempotency_key", "customer_id", "merchant_id", "amount", "currency",
    "payment_method", "status", "retry_count", "is_retry_flag", "original_payment_id",
    "event_timestamp", "ingested_at",
]


def bronze_parse(spark, d):
    decoded = messages.decode(derived.message_stream(bronze(spark, d)))
    return flat(messages.typed(decoded).select(*BRONZE_COLUMNS))


def _checked(spark, d, layer="bronze"):
    return validity.with_reasons(
        messages.decode(derived.faulty_messages(bronze(spark, d))), layer
    )


def deadletter(spark, d):
    return flat(validity.dead_letters(_checked(spark, d)))


def bronze_append(spark, d):
    """Valid messages written to Bronze by ingest date, then read back."""
    path = run_dir(spark, "bronze")
    rows = schemas.conform(messages.typed(validity.valid(_checked(spark, d))), schemas.BRONZE)
    tables.append_partitions(rows.withColumn("ingested_date", F.to_date("ingested_at")), path, ["ingested_date"])
    back = spark.read.parquet(path)
    return flat(back.select(*BRONZE_COLUMNS, F.col("ingested_date")))


def decisions_with_invalid(spark, d):
    checked = _checked(spark, d, "silver")
    good = messages.typed(validity.valid(checked))
    decided = dedup.decide(good).select(
        "payment_id", "idempotency_key", "customer_id", "merchant_id", "dedup_status",
        "rejection_reason", "original_payment_id",
    )
    return decided.unionByName(validity.invalid_decisions(checked))


# -- registry and decisions ---------------------------------------------------


def dedup_decisions(spark, d):
    decided = dedup.decide(bronze(spark, d))
    return flat(decided.select(
        "payment_id", "idempotency_key", "registry_key", "customer_id", "merchant_id", "amount",
        "currency", "payment_method", "dedup_status", "rejection_reason", "original_payment_id",
        "processing_latency_ms", "event_timestamp", "decision_at",
    ))


def dedup_decisions_edge(spark, d):
    return dedup.decide(bronze(spark, d, edge=True)).select(
        "payment_id", "dedup_status", "original_payment_id"
    )


def dedup_decisions_ttl(spark, d):
    return dedup.decide(derived.coarse_payments(spark, d)).select(
        "payment_id", "idempotency_key", "dedup_status", "original_payment_id"
    )


def dedup_decisions_hot(spark, d):
    """The same with every key above four rows taken the way of hot keys."""
    return dedup.decide(derived.coarse_payments(spark, d), hot_rows=4).select(
        "payment_id", "idempotency_key", "dedup_status", "original_payment_id"
    )


def decision_counts(spark, d):
    return registry.decision_counts(decisions_with_invalid(spark, d))


def registry_snapshot(spark, d):
    taken = registry.acceptances(dedup.decide(bronze(spark, d)))
    return registry.live_keys(taken, _ts(REGISTRY_CLOCK))


def silver_insert_if_absent(spark, d):
    """Silver holds the decisions up to the mark; all decisions come in again,
    those after the mark twice, the second time an hour later."""
    s = silver(spark, d)
    existing = s.filter(F.col("decision_at") <= _ts(MARK))
    again = s.withColumn("decision_at", F.col("decision_at") + F.expr("interval 1 hour")).withColumn(
        "dedup_status", F.lit(S.REJECTED_DUPLICATE)
    )
    added = tables.insert_if_absent(s.unionByName(again), existing, order=["decision_at", "payment_id"])
    return added.select("payment_id", "dedup_status", "decision_at")


# -- Gold ---------------------------------------------------------------------


def gold_merchant_hourly(spark, d):
    return flat(gold.merchant_hourly(silver(spark, d)))


def gold_sla_hourly(spark, d):
    return flat(gold.sla_hourly(silver(spark, d)))


def gold_customer_daily(spark, d):
    return flat(gold.customer_daily(silver(spark, d)))


def _all_retries(spark, d):
    return gold.customer_retries(silver(spark, d))


def customer_retry_depth(spark, d):
    return flat(_all_retries(spark, d).select("customer_id", "day_bucket", "max_retries_per_payment"))


def customer_retry_interval(spark, d):
    return flat(
        _all_retries(spark, d).select("customer_id", "day_bucket", "retry_gaps", "avg_retry_interval_sec")
    )


def gold_system_summary(spark, d):
    return flat(gold.system_daily(bronze(spark, d), silver(spark, d)))


def gold_flagged_top10(spark, d):
    return flat(gold.flagged_top(gold.customer_daily(silver(spark, d))))


def _stored_silver(spark, d, path):
    """Decisions as a table partitioned by decision date, as the runs read it."""
    dated = silver(spark, d).withColumn("decision_date", F.to_date("decision_at"))
    tables.replace_partitions(dated, path, ["decision_date"], rebalance=True)
    return spark.read.parquet(path)


def _two_runs(spark, d, pipeline, mode):
    """Run up to the first bound, then up to the newest; returns paths and log."""
    base = run_dir(spark, f"gold-{pipeline.name}-{mode}")
    table, log = f"{base}/gold", f"{base}/marks"
    s = _stored_silver(spark, d, f"{base}/silver")
    watermark.seed(tables.read_table(spark, log, schemas.WATERMARKS)).write.mode("append").parquet(log)
    more = {"bronze": bronze(spark, d)} if pipeline is incremental.SYSTEM else {}
    incremental.run(pipeline, s, table, log, mode, until=_ts(SECOND_RUN), **more)
    incremental.run(pipeline, s, table, log, mode, **more)
    return table, log


def _gold_after_two_runs(pipeline, mode):
    def query(spark, d):
        table, _ = _two_runs(spark, d, pipeline, mode)
        out = incremental.read_gold(spark, pipeline, table)
        return flat(out.drop("aggregated_at", "avg_retry_interval_sec"))

    return query


def gold_unique_estimates(spark, d):
    """Distinct counts by day from sketches of two runs united, beside the exact ones: within three standard errors?"""
    table, _ = _two_runs(spark, d, incremental.UNIQUES, "merge")
    estimates = incremental.read_gold(spark, incremental.UNIQUES, table)
    exact = gold.system_daily(bronze(spark, d), silver(spark, d)).select("day_bucket", "unique_customers", "unique_merchants")

    def within(name):
        bound = F.col(name) * (3 * 1.04 / 2 ** (gold.SKETCH_BITS / 2)) + 1
        return (F.abs(F.col(f"{name}_estimate") - F.col(name)) <= bound).alias(f"{name}_within")

    return flat(estimates.join(exact, "day_bucket").select(
        "day_bucket", "unique_customers", "unique_merchants", within("unique_customers"), within("unique_merchants")))


def _upsert_of(compute, keys_):
    """Keyed upsert: Gold of everything up to the mark, then Gold of all after it."""

    def query(spark, d):
        s = silver(spark, d)
        old = compute(s.filter(F.col("decision_at") <= _ts(MARK)))
        new = compute(s.filter(F.col("decision_at") > _ts(MARK)))
        return flat(tables.upsert(old, new, keys_))

    return query


def hwm_max(spark, d):
    return watermark.new_mark(silver(spark, d), _ts(MARK))


def hwm_slice(spark, d):
    s = silver(spark, d)
    return watermark.slice_of(s, _ts(MARK), _ts(SECOND_RUN)).select("payment_id", "dedup_status", "decision_at")


def _marks(spark, d):
    """Control log after one run of two pipelines: one more mark each."""
    s = silver(spark, d)
    gold_rows = (
        gold.merchant_hourly(s).agg(F.count("*").alias("n")).select(F.lit(S.PIPELINE_MERCHANT).alias("pipeline_name"), "n")
        .unionByName(gold.sla_hourly(s).agg(F.count("*").alias("n")).select(F.lit(S.PIPELINE_SLA).alias("pipeline_name"), "n"))
    )
    newest = watermark.new_mark(s, _ts(FAR_PAST))
    ran = gold_rows.select(
        "pipeline_name", newest.scalar().alias("last_processed_at"),
        newest.scalar().alias("last_run_at"), F.col("n").alias("rows_processed"),
    )
    return schemas.conform(ran, schemas.WATERMARKS)


def hwm_seed(spark, d):
    """Seeds for the pipelines that have not run yet."""
    return watermark.seed(_marks(spark, d)).select("pipeline_name", "last_processed_at", "rows_processed")


def hwm_read(spark, d):
    """Marks of a pipeline that ran and of one that never did."""
    log = _marks(spark, d)
    return watermark.read(log, S.PIPELINE_SLA).unionByName(watermark.read(log, S.PIPELINE_SYSTEM))


def hwm_advance(spark, d):
    """State of the log: seeds, then one run of two pipelines."""
    log = watermark.seeds(spark).unionByName(_marks(spark, d))
    return watermark.current(log).select("pipeline_name", "last_processed_at", "rows_processed")


def hwm_advance_runs(spark, d):
    """Mark and row count left by two real incremental runs."""
    _, log = _two_runs(spark, d, incremental.MERCHANT, "slice")
    return watermark.current(tables.read_table(spark, log, schemas.WATERMARKS)).select(
        "pipeline_name", "last_processed_at", "rows_processed"
    )


# -- reconciliation -----------------------------------------------------------


def recon_layer_counts(spark, d):
    return recon.layer_counts(bronze(spark, d, edge=True), silver(spark, d, edge=True))


def recon_confusion(spark, d):
    return recon.detection_accuracy(bronze(spark, d, edge=True), silver(spark, d, edge=True))


def _matrix(spark, d):
    return recon.confusion_matrix(bronze(spark, d, edge=True), silver(spark, d, edge=True))


def recon_confusion_matrix(spark, d):
    return _matrix(spark, d)


def recon_precision_recall(spark, d):
    return recon.precision_recall(_matrix(spark, d))


def recon_sla(spark, d):
    return flat(recon.sla_report(silver(spark, d)))


def recon_merchant_rate(spark, d):
    return flat(recon.merchant_rates(silver(spark, d)))


def recon_merchant_band(spark, d):
    return flat(recon.merchant_bands(recon.merchant_rates(silver(spark, d))))


def recon_missing_decisions(spark, d):
    """Layers that each lost some payments: decisions on all of Bronze, of which those with one
    latency are gone, against a Bronze without the payments of another."""
    lost = lambda df, ms: df.filter(F.col("processing_latency_ms") != ms)
    return flat(recon.missing_decisions(lost(bronze(spark, d), 11), lost(silver(spark, d), 7)))


def recon_summary(spark, d):
    s = silver(spark, d)
    return flat(recon.summary(bronze(spark, d), s, gold.customer_daily(s)))


def recon_verdicts(spark, d):
    b, s = bronze(spark, d), silver(spark, d)  # one decision, which the plan's parts share
    total = recon.summary(b, s, gold.customer_daily(s))
    return recon.verdicts(total, recon.confusion_matrix(b, s))


def latency_histogram(spark, d):
    return flat(measures.latency_histogram(silver(spark, d)))


def latency_histogram_by_status(spark, d):
    return flat(measures.latency_histogram(silver(spark, d), ["dedup_status"]))


# -- streams ------------------------------------------------------------------


def _dealt(rows):
    """Event rows dealt evenly: a file of few row groups is read by as few tasks, and what is derived from a row costs far
    more than the row. Also for a stream, which does not size its shuffles by what they hold."""
    return rows.repartition(4 * rows.sparkSession.sparkContext.defaultParallelism)


def _event_stream(spark, d):
    schema = derived.events(spark, d).schema
    return _dealt(
        spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)
    )


def _faulty_rows(spark, d):
    return derived.faulty_messages(derived.payments_from(_dealt(derived.events(spark, d))))


def stream_bronze(spark, d):
    """The table read as a stream of messages, into Bronze and the dead letter."""
    base = run_dir(spark, "stream-bronze")
    stream = derived.faulty_messages(derived.payments_from(_event_stream(spark, d)))
    q = bronze_stream.start(stream, f"{base}/bronze", f"{base}/deadletter", f"{base}/offsets")
    q.awaitTermination()
    return flat(spark.read.parquet(f"{base}/bronze").select(*BRONZE_COLUMNS))


def stream_dedup(spark, d):
    """The table read as a stream, decided batch by batch against the registry table."""
    base = run_dir(spark, "stream-dedup")
    stream = derived.payments_from(_event_stream(spark, d))
    q = dedup_stream.start(stream, f"{base}/silver", f"{base}/registry", f"{base}/offsets")
    q.awaitTermination()
    return spark.read.parquet(f"{base}/silver").select("payment_id", "dedup_status", "original_payment_id")


def stream_dedup_stateful(spark, d):
    """The table read as a stream, decided with keyed state in the state store."""
    base = run_dir(spark, "stream-stateful")
    stream = derived.payments_from(_event_stream(spark, d))
    q = stateful.start(stream, f"{base}/silver", f"{base}/offsets",
                       partitions=spark.sparkContext.defaultParallelism)
    q.awaitTermination()
    return spark.read.parquet(f"{base}/silver").select("payment_id", "dedup_status", "original_payment_id")


def _in_batches(spark, df, base, start, at="ingested_at", parts=4, again_as=lambda rows, again: rows, wait=lambda q: q.awaitTermination()):
    """The rows as micro-batches: by arrival in equal spans, the second part delivered again
    with the last one, changed by ``again_as`` (None: not again). Each span is written with its own partitions, then ``start``, given the
    stream over the folder, takes the files it has not seen as one batch of the same checkpoint."""
    low, high = df.agg(F.unix_micros(F.min(at)), F.unix_micros(F.max(at))).first()
    span = (high - low) // parts + 1
    part = ((F.unix_micros(at) - low) / span).cast("int")
    for i in range(parts):
        again = (part == 1) if i == parts - 1 and again_as else F.lit(False)
        rows = df.where((part == i) | again)
        if again_as:
            rows = again_as(rows, again)
        rows.write.mode("append").parquet(f"{base}/in")
        wait(start(spark.readStream.schema(df.schema).parquet(f"{base}/in")))


def _coarse_events(spark, d):
    """Coarse keys, which outlive their time to live, with the columns a decision record needs."""
    none = {c: F.lit(None).cast("string") for c in ("customer_id", "merchant_id", "currency", "payment_method")}
    return _dealt(derived.coarse_payments(spark, d)).withColumns(
        {**none, "amount": F.lit(None).cast("decimal(18,4)"), "event_timestamp": F.col("ingested_at"),
         "decision_at": F.col("ingested_at"), "processing_latency_ms": F.lit(0).cast("bigint")}
    )


def stream_dedup_batches(spark, d):
    """Four micro-batches against the registry table: re-acceptance across batches, redelivery."""
    base = run_dir(spark, "stream-batches")
    _in_batches(spark, _coarse_events(spark, d), base, lambda stream: dedup_stream.start(
        stream, f"{base}/silver", f"{base}/registry", f"{base}/offsets"))
    return spark.read.parquet(f"{base}/silver").select("payment_id", "idempotency_key", "dedup_status", "original_payment_id")


def stream_dedup_stateful_batches(spark, d):
    """The same with keyed state. Nothing is cleared: the arrivals are far older than the topic keeps them."""
    base = run_dir(spark, "stream-stateful-batches")
    _in_batches(spark, _coarse_events(spark, d), base, lambda stream: stateful.start(
        stream, f"{base}/silver", f"{base}/offsets", evict=False, partitions=spark.sparkContext.defaultParallelism))
    return spark.read.parquet(f"{base}/silver").select("payment_id", "idempotency_key", "dedup_status", "original_payment_id")


def _moved(rows, again):
    """Messages delivered again under another key than the first time."""
    return rows.withColumn("idempotency_key", F.when(again, F.concat("idempotency_key", F.lit("|moved"))).otherwise(F.col("idempotency_key")))


def stream_dedup_moved_batches(spark, d):
    """Four micro-batches; the payments delivered again come under another key, and still have one decision."""
    base = run_dir(spark, "stream-moved")
    _in_batches(spark, _coarse_events(spark, d), base, lambda stream: dedup_stream.start(
        stream, f"{base}/silver", f"{base}/registry", f"{base}/offsets"), again_as=_moved)
    return spark.read.parquet(f"{base}/silver").select("payment_id", "idempotency_key", "dedup_status", "original_payment_id")


def stream_dedup_stateful_moved_batches(spark, d):
    """The same with keyed state."""
    base = run_dir(spark, "stream-stateful-moved")
    _in_batches(spark, _coarse_events(spark, d), base, lambda stream: stateful.start(
        stream, f"{base}/silver", f"{base}/offsets", evict=False, partitions=spark.sparkContext.defaultParallelism), again_as=_moved)
    return spark.read.parquet(f"{base}/silver").select("payment_id", "idempotency_key", "dedup_status", "original_payment_id")


# The topic of the replay keeps messages for a day: most keys expire between the batches.
REPLAY_RETENTION = 86_400


def _evicting(spark, d, name):
    """A replay whose clock is the arrival: watermark and timers run as they would have, and no row is lost."""
    base = run_dir(spark, name)
    _in_batches(spark, _coarse_events(spark, d), base, lambda stream: stateful.start(
        stream, f"{base}/silver", f"{base}/offsets", retention=REPLAY_RETENTION, clock="ingested_at",
        partitions=spark.sparkContext.defaultParallelism), again_as=None, wait=stateful.await_without_loss)
    return base


def stream_dedup_stateful_evict(spark, d):
    """Four micro-batches with keyed state that expires between them."""
    base = _evicting(spark, d, "stream-evict")
    return spark.read.parquet(f"{base}/silver").select("payment_id", "idempotency_key", "dedup_status", "original_payment_id")


def stream_state_after_evict(spark, d):
    """What the state still holds then: keys whose acceptance was in force at the last watermark or later; the others are cleared."""
    base = _evicting(spark, d, "stream-evict-state")
    return stateful.held_keys(spark, f"{base}/offsets")


def stream_running_counts(spark, d):
    """Totals over four micro-batches of faulty messages, from the counter table the job keeps."""
    base = run_dir(spark, "stream-counts")
    _in_batches(spark, _faulty_rows(spark, d), base, lambda stream: dedup_stream.start(
        dedup_stream.checked_events(stream), f"{base}/silver", f"{base}/registry", f"{base}/offsets",
        deadletter_path=f"{base}/deadletter", counters_path=f"{base}/counters"))
    return registry.running_counts(tables.read_table(spark, f"{base}/counters", registry.COUNTERS)).drop("total_accepted", "total_rejected")


def stream_deadletter(spark, d):
    """Messages of four micro-batches that the dedup job refuses, each once: the redelivered part is a second copy."""
    base = run_dir(spark, "stream-deadletter")
    _in_batches(spark, _faulty_rows(spark, d), base, lambda stream: dedup_stream.start(
        dedup_stream.checked_events(stream), f"{base}/silver", f"{base}/registry", f"{base}/offsets",
        deadletter_path=f"{base}/deadletter"))
    return flat(spark.read.parquet(f"{base}/deadletter").select(
        "payment_id", "invalid_reason", "raw_payload", "layer").distinct())


QUERIES: dict[str, Query] = {
    "idempotency_key": idempotency_key,
    "five_minute_bucket": five_minute_bucket,
    "key_mismatch": key_mismatch,
    "latency_ms": latency_ms,
    "kafka_projection": kafka_projection,
    "decisions_projection": decisions_projection,
    "bronze_parse": bronze_parse,
    "bronze_append": bronze_append,
    "deadletter": deadletter,
    "decisions_with_invalid": decisions_with_invalid,
    "dedup_decisions": dedup_decisions,
    "dedup_decisions_edge": dedup_decisions_edge,
    "dedup_decisions_ttl": dedup_decisions_ttl,
    "dedup_decisions_hot": dedup_decisions_hot,
    "decision_counts": decision_counts,
    "registry_snapshot": registry_snapshot,
    "silver_insert_if_absent": silver_insert_if_absent,
    "gold_merchant_hourly": gold_merchant_hourly,
    "gold_sla_hourly": gold_sla_hourly,
    "gold_customer_daily": gold_customer_daily,
    "customer_retry_depth": customer_retry_depth,
    "customer_retry_interval": customer_retry_interval,
    "gold_system_summary": gold_system_summary,
    "gold_flagged_top10": gold_flagged_top10,
    "gold_merchant_upsert": _upsert_of(gold.merchant_hourly, ["merchant_id", "hour_bucket"]),
    "gold_sla_upsert": _upsert_of(gold.sla_hourly, ["hour_bucket"]),
    "gold_customer_upsert": _upsert_of(gold.customer_daily, ["customer_id", "day_bucket"]),
    "gold_merchant_two_runs_slice": _gold_after_two_runs(incremental.MERCHANT, "slice"),
    "gold_merchant_two_runs_full": _gold_after_two_runs(incremental.MERCHANT, "full_bucket"),
    "gold_sla_two_runs_full": _gold_after_two_runs(incremental.SLA, "full_bucket"),
    "gold_customer_two_runs_full": _gold_after_two_runs(incremental.CUSTOMER, "full_bucket"),
    "gold_system_two_runs_full": _gold_after_two_runs(incremental.SYSTEM, "full_bucket"),
    "gold_merchant_two_runs_merge": _gold_after_two_runs(incremental.MERCHANT, "merge"),
    "gold_sla_two_runs_merge": _gold_after_two_runs(incremental.SLA, "merge"),
    "gold_customer_two_runs_merge": _gold_after_two_runs(incremental.CUSTOMER, "merge"),
    "gold_unique_estimates": gold_unique_estimates,
    "hwm_max": hwm_max,
    "hwm_slice": hwm_slice,
    "hwm_seed": hwm_seed,
    "hwm_read": hwm_read,
    "hwm_advance": hwm_advance,
    "hwm_advance_runs": hwm_advance_runs,
    "recon_layer_counts": recon_layer_counts,
    "recon_confusion": recon_confusion,
    "recon_confusion_matrix": recon_confusion_matrix,
    "recon_precision_recall": recon_precision_recall,
    "recon_sla": recon_sla,
    "recon_merchant_rate": recon_merchant_rate,
    "recon_merchant_band": recon_merchant_band,
    "recon_missing_decisions": recon_missing_decisions,
    "recon_summary": recon_summary,
    "recon_verdicts": recon_verdicts,
    "latency_histogram": latency_histogram,
    "latency_histogram_by_status": latency_histogram_by_status,
    "stream_bronze": stream_bronze,
    "stream_dedup": stream_dedup,
    "stream_dedup_stateful": stream_dedup_stateful,
    "stream_dedup_batches": stream_dedup_batches,
    "stream_dedup_stateful_batches": stream_dedup_stateful_batches,
    "stream_deadletter": stream_deadletter,
    "stream_dedup_moved_batches": stream_dedup_moved_batches,
    "stream_dedup_stateful_moved_batches": stream_dedup_stateful_moved_batches,
    "stream_dedup_stateful_evict": stream_dedup_stateful_evict,
    "stream_state_after_evict": stream_state_after_evict,
    "stream_running_counts": stream_running_counts,
}
