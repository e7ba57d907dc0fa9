"""Messages into Bronze, refused ones into the dead letter, in one pass.

Both tables are partitioned by date and batch. A batch that is run again after a
failure holds the same rows and replaces exactly its own partitions, so the
checkpoint and the tables agree: every message is kept once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from payguard import settings as S
from payguard.operators import tables, validity
from payguard.schemas import BRONZE, conform
from payguard.sources import messages


def start(
    stream: DataFrame,
    bronze_path: str,
    deadletter_path: str,
    checkpoint: str,
    interval: str | None = None,
    publish: Callable[[DataFrame, str], None] | None = None,
    report: Callable[[int, dict], None] | None = None,
) -> StreamingQuery:
    """Start the job. ``interval`` (such as ``30 seconds``) keeps it running;
    without it the job takes what is there and ends. ``publish`` also gets refused
    messages for their topic; ``report`` the counters of each batch."""
    if "ingested_at" not in stream.columns:
        stream = stream.withColumn("ingested_at", F.current_timestamp())

    def step(batch: DataFrame, batch_id: int) -> None:
        checked = validity.with_reasons(messages.decode(messages.spread(batch))).persist()
        try:
            for rows, path in (
                (conform(messages.typed(validity.valid(checked)), BRONZE), bronze_path),
                (validity.dead_letters(checked), deadletter_path),
            ):
                dated = rows.withColumn("ingested_date", F.to_date("ingested_at")).withColumn(
                    "batch_id", F.lit(batch_id)
                )
                tables.replace_partitions(dated, path, ["ingested_date", "batch_id"], rebalance=True)
            if publish is not None:
                publish(messages.encode_dead_letters(validity.dead_letters(checked)), S.TOPIC_DEADLETTER)
            if report is not None:
                refused = F.col("invalid_reason").isNotNull()
                counts = checked.agg(F.count("*").alias("total_received"), F.count_if(~refused).alias("total_stored"), F.count_if(refused).alias("total_errors"))
                report(batch_id, counts.first().asDict())
        finally:
            checked.unpersist()

    return writer(stream, step, checkpoint, interval)


def writer(stream: DataFrame, step, checkpoint: str, interval: str | None) -> StreamingQuery:
    w = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return (w.trigger(processingTime=interval) if interval else w.trigger(availableNow=True)).start()
