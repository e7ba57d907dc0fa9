"""Decisions on a stream, batch by batch, against the registry as a table.

Each micro-batch goes through the batch operator with the live registry entries
of its keys carried in, so stream and batch give the same decisions, hot keys
are split in the same way, and no row is dropped however late it is.

Registry and Silver are partitioned by date and batch. A batch reads only the
entries of earlier batches and replaces only its own partitions, so running it
again after a failure changes nothing: state and output stand or fall together.
Entries older than the time to live are pruned by date, which bounds what a
batch reads without any eviction.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from payguard import settings as S
from payguard.functions.measures import latency_ms
from payguard.operators import dedup, registry, tables, validity
from payguard.operators.id_index import IdIndex
from payguard.schemas import SILVER, conform, struct_of
from payguard.session import Workspace
from payguard.sources import messages
from payguard.streaming.bronze import writer

REGISTRY_TABLE = struct_of(
    "idempotency_key string, payment_id string, accepted_at timestamp,"
    " accepted_date date, batch_id long"
)


# What an index is built from where Silver has none: its payment ids, by batch.
SEEN = struct_of("payment_id string, batch_id long")
STAMPS = ("ingested_at", "kafka_partition", "kafka_offset", "decision_at")
NEEDED = {
    "payment_id", "idempotency_key", "customer_id", "merchant_id", "amount", "currency", "payment_method",
    "event_timestamp", "processing_latency_ms", *STAMPS,
}
# What a dead letter needs besides.
REFUSED = {"invalid_reason", "raw_payload"}


def stamp(stream: DataFrame) -> DataFrame:
    """Arrival, decision time and latency where the rows do not bring them.

    The clock of a micro-batch is fixed in the checkpoint, so a batch run again
    gets the same stamps. Messages not yet typed get their latency with the types.
    """
    for name in ("ingested_at", "decision_at"):
        if name not in stream.columns:
            stream = stream.withColumn(name, F.current_timestamp())
    if "processing_latency_ms" not in stream.columns and "invalid_reason" not in stream.columns:
        stream = stream.withColumn("processing_latency_ms", latency_ms())
    return stream


def checked_events(stream: DataFrame) -> DataFrame:
    """Messages with ``invalid_reason``, as the decision sees them: null in those fit for one."""
    return validity.with_reasons(messages.decode(messages.spread(stream)), "silver")


def valid_events(stream: DataFrame) -> DataFrame:
    """Messages as typed events, those fit for a decision only; give ``start`` the
    ``checked_events`` to have the others in a dead letter."""
    return messages.typed(validity.valid(checked_events(stream)))


def carried_entries(batch: DataFrame, rows: int, registry_path: str, batch_id: int, ttl: int) -> DataFrame | None:
    """Live entries of earlier batches for the keys of this batch."""
    spark = batch.sparkSession
    if not tables.path_exists(spark, registry_path):
        return None
    oldest_us = batch.agg(F.unix_micros(F.min("ingested_at"))).first()[0]
    horizon = F.timestamp_micros(F.lit(oldest_us - ttl * 1_000_000))
    live = tables.read_table(spark, registry_path, REGISTRY_TABLE).filter(
        (F.col("accepted_date") >= F.to_date(horizon))
        & (F.col("accepted_at") > horizon)
        & (F.col("batch_id") < batch_id)
    )
    wanted = batch.select("idempotency_key").distinct()
    # beyond the bound a shuffle, whatever size Spark takes from the files
    wanted = F.broadcast(wanted) if rows <= S.BROADCAST_ROWS else wanted.hint("merge")
    return registry.latest_entries(live.join(wanted, "idempotency_key", "left_semi"))


def start(
    stream: DataFrame,
    silver_path: str,
    registry_path: str,
    checkpoint: str,
    ttl: int = S.TTL_SECONDS,
    hot_rows: int = S.HOT_KEY_ROWS,
    interval: str | None = None,
    deadletter_path: str | None = None,
    record_invalid: bool = False,
    publish: Callable[[DataFrame, str], None] | None = None,
    report: Callable[[int, dict], None] | None = None,
    index: IdIndex | None = None,
    counters_path: str | None = None,
) -> StreamingQuery:
    """Start the job over events, or over messages such as ``checked_events`` gives.

    Refused messages, also those that Bronze took, go to ``deadletter_path`` with the
    layer that refused them; with ``record_invalid`` those that can be named become
    decisions with status invalid as well. Silver keeps the first decision of a
    payment_id, against the buckets of ``index`` (by default beside Silver) that the batch's ids fall into.
    ``report`` receives the counters of each finished batch (``registry.batch_counts``); with a ``counters_path``, where
    a row a batch is kept, also the totals of all batches so far, as ``running``. ``publish``
    (``messages.topic_writer``) also gets new decisions and refused messages as keyed
    messages with the name of their topic, at least once. Working tables of a batch are deleted when it is done.
    """
    index = index or IdIndex(f"{silver_path}_ids")
    if "invalid_reason" in stream.columns and deadletter_path is None:
        raise ValueError("checked messages need a deadletter_path")

    def refuse(batch: DataFrame, batch_id: int) -> None:
        rows = validity.dead_letters(batch).withColumn("layer", F.lit("silver"))
        dated = rows.withColumn("ingested_date", F.to_date("ingested_at")).withColumn("batch_id", F.lit(batch_id))
        tables.replace_partitions(dated, deadletter_path, ["ingested_date", "batch_id"])
        if publish is not None:
            publish(messages.encode_dead_letters(rows), S.TOPIC_DEADLETTER)

    def step(batch: DataFrame, batch_id: int) -> None:
        # Kept as written tables: a cache of whole messages unrolls a partition in an executor's memory.
        with Workspace(batch.sparkSession, "batch") as work:
            refused, errors = None, 0
            if "invalid_reason" in batch.columns:
                checked = work.keep(batch.select(*[c for c in batch.columns if c in NEEDED | REFUSED]))
                refuse(checked, batch_id)
                errors = checked.filter(F.col("invalid_reason").isNotNull()).count()
                refused = validity.invalid_decisions(checked, STAMPS) if record_invalid and errors else None
                events = messages.typed(validity.valid(checked)).withColumn("processing_latency_ms", latency_ms())
                events = events.select(*[c for c in events.columns if c in NEEDED])
            else:
                # What neither the decision nor its record needs is not kept or shuffled.
                events = work.keep(messages.spread(batch.select(*[c for c in batch.columns if c in NEEDED])))
            rows = events.count()
            decided = None
            if rows or refused is not None:
                decided = decide(events, rows, refused, batch_id, work)
            count(decided if rows else None, events, rows, errors, batch_id)

    def decide(events: DataFrame, rows: int, refused: DataFrame | None, batch_id: int, work: Workspace) -> DataFrame:
        spark = events.sparkSession
        carried = carried_entries(events, rows, registry_path, batch_id, ttl) if rows else None
        decided = dedup.decide(events, ttl, hot_rows=hot_rows, carried=carried, work=work).drop("registry_key")
        if refused is not None:
            decided = decided.unionByName(refused, allowMissingColumns=True)
        decided = work.keep(decided)
        taken = registry.acceptances(decided).withColumn("accepted_date", F.to_date("accepted_at"))
        # Narrow rows that every later batch reads: few files matter more than a shuffle.
        tables.replace_partitions(
            taken.withColumn("batch_id", F.lit(batch_id)), registry_path,
            ["accepted_date", "batch_id"], rebalance=True,
        )
        if not index.exists(spark) and tables.path_exists(spark, silver_path):
            index.build(tables.read_table(spark, silver_path, SEEN).filter(F.col("batch_id") < batch_id))
        earlier = index.seen(decided, batch_id)
        new = tables.insert_if_absent(decided, earlier, order=dedup.arrival_columns(decided), new_rows=rows or None)
        record = work.keep(conform(dedup.silver_records(new), SILVER))
        dated = record.withColumn("decision_date", F.to_date("decision_at")).withColumn("batch_id", F.lit(batch_id))
        tables.replace_partitions(dated, silver_path, ["decision_date", "batch_id"])
        index.add(record.select("payment_id", F.lit(batch_id).cast("long").alias("batch_id")))
        if publish is not None:
            publish(messages.encode_decisions(record), S.TOPIC_DECISIONS)
        return decided

    def count(decided: DataFrame | None, events: DataFrame, rows: int, errors: int, batch_id: int) -> None:
        if report is None and counters_path is None:
            return
        if decided is None:  # nothing to decide: the counters say so
            decided = events.select(F.lit(S.ACCEPTED).alias("dedup_status"))
        counts = registry.batch_counts(decided, rows + errors, errors).first().asDict()
        spark = events.sparkSession
        if counters_path is not None:
            row = spark.createDataFrame([(*counts.values(), batch_id)], registry.COUNTERS)
            tables.replace_partitions(row.coalesce(1), counters_path, ["batch_id"])
            everything = tables.read_table(spark, counters_path, registry.COUNTERS)
            counts = counts | {"running": registry.running_counts(everything, batch_id).first().asDict()}
        if report is not None:
            report(batch_id, counts)

    return writer(stamp(stream), step, checkpoint, interval)
