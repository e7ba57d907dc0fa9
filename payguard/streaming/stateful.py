"""Decisions on a stream with keyed state in the state store.

The shorter path when keys are even, as hashed keys are: a batch touches only
the state of the buckets its own keys fall into, by a hash. All rows of one key in one batch meet in one task,
bounded by the size of a batch; with hot keys use ``streaming.dedup``. A bucket is read and written as a whole: the number of
buckets is fixed with the first start, and a long history with small batches wants more of them.

A row is compared with the acceptance it finds, expired or not, so clearing state
decides nothing; it must only not come too early, and it needs a watermark, which
drops rows behind it. Both are settled by the topic's retention R: a row still to
come arrived at most R ago. The watermark clock is the arrival time, but at least
now - R and at most now, with a delay of R. So the watermark is never later than
now - R, whatever time a producer stamps: no row is behind it, and an entry whose
span ends before it meets no further row.

A payment is decided once whatever its key: what the keys decide goes on to a second operator, which keeps the
payment ids it has seen, for as long as a message can come again, and lets the first decision of each pass. A repeated
message still meets its key, as it does in the registry job. Files replayed with arrivals older than R fall under the second
branch of the clock: their entries stay for at least R of running time; for a
replay that runs longer, use ``streaming.dedup``, ``evict=False``, or a clock that follows the arrivals (``clock``).

Should a row be behind the watermark all the same, Spark drops it and counts it;
``await_without_loss`` stops the job then, and the registry job can decide the batch from Bronze.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from payguard import settings as S
from payguard.operators.dedup import arrival_columns, silver_records
from payguard.schemas import SILVER, conform, struct_of
from payguard.session import ROCKSDB
from payguard.streaming.dedup import NEEDED, stamp


# Numbers of the two operators in a checkpoint: the one nearest to the sink comes first.
KEYS, PAYMENTS = 1, 0
FOUND = struct_of("dedup_status string, rejection_reason string, original_payment_id string")

# The state of a bucket: one place in every array for each entry, and the earliest timer that is still to fire.
TEXTS, TIMES = T.ArrayType(T.StringType()), T.ArrayType(T.LongType())
HELD = T.StructType().add("keys", TEXTS).add("payments", TEXTS).add("accepted_us", TIMES).add("timers_ms", TIMES).add("next_ms", "long")
SENT = T.StructType().add("payments", TEXTS).add("timers_ms", TIMES).add("next_ms", "long")


class Bucket(StatefulProcessor):
    """The entries of all names (keys, payment ids) whose hash falls into one bucket, as one state value.

    A call to the state store costs far more than an entry does, so a bucket is read and written as a whole. One timer
    for the earliest entry stands for all of them: when it fires, what has expired goes and the next is registered.
    """

    evict: bool

    def open(self, handle: StatefulProcessorHandle, variable: str, schema: T.StructType) -> None:
        self.handle = handle
        self.state = handle.getValueState(variable, schema)

    def load(self) -> tuple[dict, int]:
        """Entries by name, the last of their fields the timer; the earliest timer still to fire, 0 if there is none."""
        if not self.state.exists():
            return {}, 0
        *columns, after = self.state.get()
        return {name: rest for name, *rest in zip(*columns)}, after

    def store(self, entries: dict, after: int, watermark: int = 0) -> None:
        if self.evict:
            first = min(timer for *_, timer in entries.values())
            if after <= watermark or first < after:  # none is left, or none so early
                self.handle.registerTimer(first)
                after = first
        columns = zip(*((name, *rest) for name, rest in entries.items()))
        self.state.update((*map(list, columns), after))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        entries, after = self.load()
        # Spark fires what lies before the watermark; an entry taken anew meanwhile has a later timer.
        watermark = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs() + 1)
        left = {name: rest for name, rest in entries.items() if rest[-1] >= watermark}
        if left:
            self.store(left, after, watermark - 1)
        elif entries:
            self.state.clear()
        return iter(())

    def close(self) -> None:
        pass


class FirstSight(Bucket):
    """Per key: who holds it since when. Rows are decided in arrival order.

    Times are compared as epoch microseconds (``_us``), which no time zone touches. The rows of a key in one batch
    are sorted here, so their number is bounded. ``key`` names the column that tells the keys of a bucket apart; without
    it all rows of a group are of one key.
    """

    def __init__(self, columns: list[str], order: list[str], ttl: int, evict: bool, most: int, key: str | None = None) -> None:
        self.columns, self.order, self.ttl_us, self.evict, self.most, self.key = columns, order, ttl * 1_000_000, evict, most, key

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.open(handle, "held", HELD)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        batch: dict = {}
        for r in rows:
            name = r[self.key] if self.key else key[0]
            own = batch.setdefault(name, [])
            if len(own) == self.most:
                raise ValueError(f"key {name} has more than {self.most} rows in one batch: run streaming.dedup, which splits hot keys")
            own.append(r)
        entries, after = self.load()
        position, changed = arrival_position(self.order), False
        for name, own in batch.items():
            payment, since, timer = entries.get(name, (None, None, 0))
            before, clock_us = since, 0
            for r in sorted(own, key=position):
                if since is None or r["_us"] >= since + self.ttl_us:
                    payment, since, clock_us = r["payment_id"], r["_us"], r["_clock_us"]
                    found = (S.ACCEPTED, None, None)
                else:
                    found = (S.REJECTED_DUPLICATE, S.DUPLICATE_REASON, payment)
                row = r.asDict()
                yield Row(**{c: row[c] for c in self.columns}, **dict(zip(FOUND.fieldNames(), found)))
            if since != before:
                if self.evict:
                    timer = (clock_us + self.ttl_us) // 1000 + 1
                entries[name], changed = (payment, since, timer), True
        if changed:
            self.store(entries, after)


class FirstOfPayment(Bucket):
    """Per payment id: whether a decision went out. Of several in one batch the first arrival passes."""

    def __init__(self, columns: list[str], order: list[str], evict: bool, retention: int) -> None:
        self.columns, self.order, self.evict, self.kept_us = columns, order, evict, retention * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.open(handle, "sent", SENT)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        entries, after = self.load()
        position = arrival_position([*self.order, "idempotency_key"])
        firsts: dict = {}
        for r in rows:
            # a minimum, not a list: any number of copies may come
            name = r["payment_id"]
            if name not in entries and (name not in firsts or position(r) < position(firsts[name])):
                firsts[name] = r
        for name, first in firsts.items():
            entries[name] = ((first["_clock_us"] + self.kept_us) // 1000 + 1,)
            row = first.asDict()
            yield Row(**{c: row[c] for c in self.columns})
        if firsts:
            self.store(entries, after)


def arrival_position(order: list[str]) -> Callable[[Row], tuple]:
    """Place of a row in arrival order. Null sorts before any value, as it does in the batch order."""
    return lambda r: tuple((r[c] is not None, r[c]) for c in order)


def _bucket(name: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(name), F.lit(buckets)).cast("int")


def _luggage(rows: DataFrame, names: list[str]) -> tuple[Column, Callable[[Column], list[Column]]]:
    """Columns that Python need not look at as one text, and the way back: every cell that crosses over costs time.
    What JSON would round or shift is written as whole numbers or plain text before."""
    there, back = [], {}
    for f in rows.select(*names).schema.fields:
        c, back[f.name] = F.col(f.name), lambda v: v
        if isinstance(f.dataType, T.TimestampType):
            c, back[f.name] = F.unix_micros(c), F.timestamp_micros
        elif isinstance(f.dataType, (T.DecimalType, T.TimestampNTZType)):
            c, back[f.name] = c.cast("string"), lambda v, kind=f.dataType: v.cast(kind)
        there.append(c.alias(f.name))
    layout = rows.select(*there).schema
    return F.to_json(F.struct(*there)), lambda text: [
        v(F.from_json(text, layout)[name]).alias(name) for name, v in back.items()
    ]


def decide_stream(
    stream: DataFrame,
    ttl: int = S.TTL_SECONDS,
    evict: bool = True,
    retention: int = S.TOPIC_RETENTION_SECONDS,
    clock: str | None = None,
    rows_per_key: int = S.STATE_ROWS_PER_KEY,
    buckets: int = S.STATE_BUCKETS,
) -> DataFrame:
    """The streaming counterpart of ``dedup.decide``: append output, one row per payment.

    ``clock`` names a column that tells the running time in place of the wall clock, for a replay in arrival order:
    watermark and timers then follow it, and no row may come later than the retention behind the newest one.
    ``buckets`` is the number of state values that each of the two operators keeps.
    """
    rows = stream.drop("original_payment_id")
    arrival = arrival_columns(rows)
    order = ["_us" if c == "ingested_at" else c for c in arrival]
    now = F.col(clock) if clock else F.current_timestamp()
    oldest = now - F.make_dt_interval(secs=F.lit(retention))
    mode, event_time = ("EventTime", "_clock") if evict else ("None", "")
    timed = rows.withColumn("_clock", F.least(F.greatest("ingested_at", oldest), now))
    if evict:
        timed = timed.withWatermark("_clock", f"{retention} seconds")
    own = [c for c in rows.columns if c in ("payment_id", "idempotency_key", *arrival) and c != "ingested_at"]
    packed, unpacked = _luggage(rows, [c for c in rows.columns if c not in own and c != "ingested_at"])
    narrow = timed.select(
        *own, F.unix_micros("ingested_at").alias("_us"), F.unix_micros("_clock").alias("_clock_us"),
        *([event_time] if evict else []), packed.alias("_rest"),
    )
    schema = T.StructType([*(f for f in narrow.schema.fields if not f.name.startswith("_clock")), *FOUND.fields])
    by_key = narrow.withColumn("_bucket", _bucket("idempotency_key", buckets)).groupBy("_bucket").transformWithState(
        statefulProcessor=FirstSight(narrow.columns, order, ttl, evict, rows_per_key, "idempotency_key"),
        outputStructType=T.StructType([*narrow.schema.fields, *FOUND.fields]),
        outputMode="append",
        timeMode=mode,
        eventTimeColumnName=event_time,
    )
    decided = by_key.withColumn("_bucket", _bucket("payment_id", buckets)).groupBy("_bucket").transformWithState(
        statefulProcessor=FirstOfPayment(schema.fieldNames(), order, evict, retention),
        outputStructType=schema,
        outputMode="append",
        timeMode=mode,
    )
    whole = decided.select(*own, F.timestamp_micros("_us").alias("ingested_at"), *unpacked(F.col("_rest")), *FOUND.fieldNames())
    return whole.select(*rows.columns, *FOUND.fieldNames())


def start(
    stream: DataFrame,
    silver_path: str,
    checkpoint: str,
    ttl: int = S.TTL_SECONDS,
    interval: str | None = None,
    evict: bool = True,
    retention: int = S.TOPIC_RETENTION_SECONDS,
    partitions: int | None = None,
    clock: str | None = None,
    buckets: int = S.STATE_BUCKETS,
) -> StreamingQuery:
    """Start the job; the file sink and the state commit with one checkpoint.

    ``partitions`` is the number of state partitions, by default that of shuffles, ``buckets`` that of the state values of
    each operator; both are fixed with the first start. The query copies the session settings when it
    starts, so they are put back right after.
    """
    conf = stream.sparkSession.conf
    shuffle = conf.get("spark.sql.shuffle.partitions")
    provider = conf.get("spark.sql.streaming.stateStore.providerClass", None)
    # This kind of state needs the RocksDB store; it also keeps large state off the heap.
    conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    conf.set("spark.sql.shuffle.partitions", str(partitions or shuffle))
    events = stamp(stream)
    # What neither the decision nor its record needs does not pass through Python.
    events = events.select(*[c for c in events.columns if c in NEEDED or c == clock])
    decided = decide_stream(events, ttl, evict, retention, clock, buckets=buckets)
    record = conform(silver_records(decided), SILVER).withColumn("decision_date", F.to_date("decision_at"))
    w = (
        record.writeStream.format("parquet").partitionBy("decision_date")
        .option("path", silver_path).option("checkpointLocation", checkpoint).outputMode("append")
    )
    try:
        return (w.trigger(processingTime=interval) if interval else w.trigger(availableNow=True)).start()
    finally:
        conf.set("spark.sql.shuffle.partitions", shuffle)
        if provider is None:
            conf.unset("spark.sql.streaming.stateStore.providerClass")
        else:
            conf.set("spark.sql.streaming.stateStore.providerClass", provider)


def rows_dropped(query: StreamingQuery) -> int:
    """Rows the query's operators dropped as behind the watermark, in the batches it still reports."""
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])


class RowsDropped(RuntimeError):
    """A stateful job lost rows behind its watermark; its batch has to be decided by the registry job."""


def await_without_loss(query: StreamingQuery, seconds: int = 10) -> None:
    """Wait for the query's end; stop it and fail as soon as it reports a dropped row."""
    done = False
    while not done:
        done = query.awaitTermination(seconds)
        lost = rows_dropped(query)
        if lost:
            query.stop()
            raise RowsDropped(f"{lost} rows were behind the watermark of {query.name or query.id}")


def _state(spark: SparkSession, checkpoint: str, variable: str, operator: int) -> DataFrame:
    reader = spark.read.format("statestore").option("operatorId", operator).option("stateVarName", variable)
    return reader.load(checkpoint)


def held_keys(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Registry entries in the state of a job, as of its last finished batch."""
    entries = F.arrays_zip("value.keys", "value.payments", "value.accepted_us")
    return _state(spark, checkpoint, "held", KEYS).select(F.explode(entries).alias("_e")).select(
        F.col("_e.keys").alias("idempotency_key"),
        F.col("_e.payments").alias("payment_id"),
        F.timestamp_micros("_e.accepted_us").alias("accepted_at"),
    )


def sent_payments(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Payment ids that a job still remembers, as of its last finished batch."""
    return _state(spark, checkpoint, "sent", PAYMENTS).select(F.explode("value.payments").alias("payment_id"))
