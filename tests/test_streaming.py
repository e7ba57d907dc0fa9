"""Streams over split input give the decisions of the batch, also after a restart."""

import os
import tempfile

import pytest

from payguard.schemas import SILVER
from payguard.sources import messages
from payguard.streaming import bronze as bronze_stream
from payguard.streaming import dedup as dedup_stream
from payguard.streaming import stateful
from rows import at, decide_by_loop, decisions
from test_dedup import mixed_rows
from test_tables import GOOD

COLUMNS = ("payment_id string, idempotency_key string, customer_id string, merchant_id string, amount decimal(18,4),"
           " currency string, payment_method string, event_timestamp timestamp, ingested_at timestamp,"
           " kafka_partition int, processing_latency_ms int, decision_at timestamp")


def write_parts(spark, rows, folder, parts):
    """Rows in arrival order, split into files that are read one per batch."""
    rows = sorted(rows, key=lambda r: (r[2], r[0]))
    step = -(-len(rows) // parts)
    for i in range(parts):
        part = [(p, k, "c", "m", None, "USD", "card", t, t, 0, 1, t) for p, k, t in rows[i * step:(i + 1) * step]]
        df = spark.createDataFrame(part, COLUMNS).coalesce(1)
        df.write.mode("append").parquet(folder)
        # the file source reads oldest first; space the times so the order is certain
        for f in os.listdir(folder):
            path = os.path.join(folder, f)
            if f.endswith(".parquet") and os.path.getmtime(path) > 10_000:
                os.utime(path, (1000 + i, 1000 + i))


def read_stream(spark, folder, per_trigger=1):
    schema = spark.createDataFrame([], COLUMNS).schema
    return messages.file_stream(spark, folder, "parquet", per_trigger, schema)


def start(kind, stream, base):
    if kind == "registry":
        return dedup_stream.start(stream, f"{base}/silver", f"{base}/registry", f"{base}/offsets", hot_rows=20)
    return stateful.start(stream, f"{base}/silver", f"{base}/offsets")


@pytest.mark.parametrize("kind", ["registry", "stateful"])
def test_stream_equals_batch(spark, kind):
    rows = mixed_rows(21, 240)
    base = tempfile.mkdtemp()
    write_parts(spark, rows, f"{base}/in", 3)
    q = start(kind, read_stream(spark, f"{base}/in"), base)
    q.awaitTermination()
    out = spark.read.parquet(f"{base}/silver")
    assert out.count() == len(rows)
    assert decisions(out) == decide_by_loop(rows)
    assert set(SILVER.fieldNames()) <= set(out.columns)


@pytest.mark.parametrize("kind", ["registry", "stateful"])
def test_restart_neither_repeats_nor_loses(spark, kind):
    rows = sorted(mixed_rows(22, 120), key=lambda r: (r[2], r[0]))
    base = tempfile.mkdtemp()
    for part in (rows[:50], rows[50:]):
        write_parts(spark, part, f"{base}/in", 1)
        start(kind, read_stream(spark, f"{base}/in"), base).awaitTermination()
    out = spark.read.parquet(f"{base}/silver")
    assert out.count() == len(rows)
    assert decisions(out) == decide_by_loop(rows)


def test_state_is_the_registry(spark):
    base = tempfile.mkdtemp()
    write_parts(spark, [("a", "k", at(0)), ("b", "k", at(30)), ("c", "j", at(31))], f"{base}/in", 1)
    stateful.start(read_stream(spark, f"{base}/in"), f"{base}/silver", f"{base}/offsets").awaitTermination()
    held = stateful.held_keys(spark, f"{base}/offsets")
    assert {(r["idempotency_key"], r["payment_id"], r["accepted_at"]) for r in held.collect()} == {
        ("k", "b", at(30)), ("j", "c", at(31)),
    }


def test_eviction_clears_state_and_changes_no_decision(spark):
    """Time to live one second, retention two: entries expire between the runs."""
    import time
    from datetime import datetime, timedelta, timezone

    base = tempfile.mkdtemp()
    rows, removed = [], 0
    for i in range(4):
        now = datetime.now(timezone.utc).replace(tzinfo=None)
        part = [(f"p{i}-{k}", f"k{k}" if k % 2 else f"k{k}-{i}", now + timedelta(milliseconds=k - 50))
                for k in range(12)]
        rows += part
        write_parts(spark, part, f"{base}/in", 1)
        q = stateful.start(read_stream(spark, f"{base}/in"), f"{base}/silver", f"{base}/offsets", ttl=1, retention=2)
        q.awaitTermination()
        removed += sum(s["numRowsRemoved"] for p in q.recentProgress for s in p["stateOperators"])
        time.sleep(1)
    out = spark.read.parquet(f"{base}/silver")
    assert out.count() == len(rows)
    assert decisions(out) == decide_by_loop(rows, ttl=1)
    assert removed > 0


def test_a_batch_that_fails_after_the_registry_write_is_repeated(spark, monkeypatch):
    rows = mixed_rows(23, 90)
    base = tempfile.mkdtemp()
    write_parts(spark, rows, f"{base}/in", 1)

    def stop(*a, **k):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(dedup_stream.tables, "insert_if_absent", stop)
        q = start("registry", read_stream(spark, f"{base}/in"), base)
        with pytest.raises(Exception):
            q.awaitTermination()
    assert os.path.exists(f"{base}/registry") and not os.path.exists(f"{base}/silver")
    start("registry", read_stream(spark, f"{base}/in"), base).awaitTermination()
    assert decisions(spark.read.parquet(f"{base}/silver")) == decide_by_loop(rows)


def test_late_and_redelivered_rows_get_the_right_decision(spark):
    """A row older than the entry that holds its key is a duplicate, not dropped;
    a payment_id seen before keeps its first decision."""
    base = tempfile.mkdtemp()
    write_parts(spark, [("a", "k", at(30))], f"{base}/in", 1)
    start("registry", read_stream(spark, f"{base}/in"), base).awaitTermination()
    write_parts(spark, [("late", "k", at(-10)), ("a", "k", at(31)), ("b", "k", at(54))], f"{base}/in", 1)
    start("registry", read_stream(spark, f"{base}/in"), base).awaitTermination()
    out = spark.read.parquet(f"{base}/silver")
    assert out.count() == 3
    assert decisions(out) == {
        "a": ("ACCEPTED", None), "late": ("REJECTED_DUPLICATE", "a"), "b": ("ACCEPTED", None),
    }


def test_bronze_stream_splits_good_and_bad(spark):
    base = tempfile.mkdtemp()
    os.makedirs(f"{base}/in")
    with open(f"{base}/in/1.txt", "w") as f:
        f.write("\n".join([GOOD % "a", '{"broken', GOOD % "b", GOOD % "a"]) + "\n")
    stream = messages.file_stream(spark, f"{base}/in", "text")
    counts = {}
    bronze_stream.start(
        stream, f"{base}/bronze", f"{base}/dead", f"{base}/offsets", report=counts.__setitem__
    ).awaitTermination()
    assert counts == {0: {"total_received": 4, "total_stored": 3, "total_errors": 1}}
    # redelivered messages stay in Bronze, which is the audit trail
    assert sorted(r["payment_id"] for r in spark.read.parquet(f"{base}/bronze").collect()) == ["a", "a", "b"]
    assert [r["raw_payload"] for r in spark.read.parquet(f"{base}/dead").collect()] == ['{"broken']


def test_messages_become_decisions(spark):
    """Text in, decisions out; a refused message neither decides nor holds its key."""
    base = tempfile.mkdtemp()
    os.makedirs(f"{base}/in")
    lines = [GOOD.replace('"customer_id":"c"', '"customer_id":null') % "bad", GOOD % "a", '{"broken', GOOD % "b"]
    with open(f"{base}/in/1.txt", "w") as f:
        f.write("\n".join(lines) + "\n")
    events = dedup_stream.valid_events(messages.file_stream(spark, f"{base}/in", "text"))
    counts = {}
    dedup_stream.start(
        events, f"{base}/silver", f"{base}/registry", f"{base}/offsets", report=counts.__setitem__
    ).awaitTermination()
    assert counts == {0: {"total_received": 2, "total_processed": 2, "total_accepted": 1, "total_rejected": 1, "total_errors": 0}}
    assert decisions(spark.read.parquet(f"{base}/silver")) == {
        "a": ("ACCEPTED", None), "b": ("REJECTED_DUPLICATE", "a"),
    }


@pytest.mark.parametrize("kind", ["registry", "stateful"])
def test_a_redelivered_payment_is_decided_once(spark, kind):
    base = tempfile.mkdtemp()
    parts = [
        [("a", "k", at(0)), ("a", "k", at(0, minutes=1)), ("b", "k", at(1))],
        [("a", "k", at(2)), ("b", "k", at(30)), ("c", "k", at(31))],
    ]
    for part in parts:
        write_parts(spark, part, f"{base}/in", 1)
        start(kind, read_stream(spark, f"{base}/in"), base).awaitTermination()
    out = spark.read.parquet(f"{base}/silver")
    assert out.count() == 3
    got = decisions(out)
    assert got["a"] == ("ACCEPTED", None) and got["b"] == ("REJECTED_DUPLICATE", "a")


def test_an_event_stamped_ahead_drops_none(spark):
    from datetime import datetime, timedelta, timezone

    base = tempfile.mkdtemp()
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    parts = [[("far", "f", now + timedelta(days=400)), ("a", "x", now)], [("b", "y", now), ("c", "x", now)], [("d", "z", now)]]
    for part in parts:
        write_parts(spark, part, f"{base}/in", 1)
        start("stateful", read_stream(spark, f"{base}/in"), base).awaitTermination()
    assert set(decisions(spark.read.parquet(f"{base}/silver"))) == {"far", "a", "b", "c", "d"}


@pytest.mark.parametrize("invalid", [False, True])
def test_what_only_the_decision_refuses_is_a_dead_letter(spark, invalid):
    import json

    base = tempfile.mkdtemp()
    os.makedirs(f"{base}/in")
    long_key = json.dumps(json.loads(GOOD % "long") | {"idempotency_key": "k" * 100})
    with open(f"{base}/in/1.txt", "w") as f:
        f.write("\n".join([GOOD % "a", long_key, GOOD % "a", '{"broken']) + "\n")
    messages_in = messages.file_stream(spark, f"{base}/in", "text")
    counts = {}
    dedup_stream.start(
        dedup_stream.checked_events(messages_in), f"{base}/silver", f"{base}/registry", f"{base}/offsets",
        deadletter_path=f"{base}/dead", record_invalid=invalid, report=counts.__setitem__,
        publish=messages.folder_writer(f"{base}/topics"),
    ).awaitTermination()
    sent = {t: spark.read.json(f"{base}/topics/{t}").collect() for t in ("payments.decisions", "payments.deadletter")}
    assert sorted(json.loads(r["value"])["payment_id"] for r in sent["payments.decisions"]) == ["a", "long"][: 1 + invalid]
    assert len(sent["payments.deadletter"]) == 2
    dead = spark.read.parquet(f"{base}/dead")
    assert {(r["payment_id"], r["layer"]) for r in dead.collect()} == {("long", "silver"), (None, "silver")}
    silver = {r["payment_id"]: r["dedup_status"] for r in spark.read.parquet(f"{base}/silver").collect()}
    assert silver == {"a": "ACCEPTED"} | ({"long": "REJECTED_INVALID"} if invalid else {})
    # four messages: one decision, its repeat, two refused, recorded or not
    assert {k: counts[0][k] for k in ("total_received", "total_processed", "total_errors")} == {"total_received": 4, "total_processed": 2, "total_errors": 2}


@pytest.mark.parametrize("invalid", [False, True])
def test_counters_add_up_over_batches(spark, invalid):
    """Also a batch of refused messages alone, and one with nothing wrong; a batch run again counts once."""
    base = tempfile.mkdtemp()
    os.makedirs(f"{base}/in")
    counts = {}
    for i, lines in enumerate([[GOOD % "a", '{"broken'], ['{"broken', "no json"], [GOOD % "b", GOOD % "c"]]):
        with open(f"{base}/in/{i}.txt", "w") as f:
            f.write("\n".join(lines) + "\n")
        dedup_stream.start(
            dedup_stream.checked_events(messages.file_stream(spark, f"{base}/in", "text")), f"{base}/silver", f"{base}/registry",
            f"{base}/offsets", deadletter_path=f"{base}/dead", record_invalid=invalid, report=counts.__setitem__,
            counters_path=f"{base}/counters",
        ).awaitTermination()
    assert [counts[i]["total_errors"] for i in range(3)] == [1, 2, 0]
    assert [counts[i]["total_processed"] for i in range(3)] == [1, 0, 2]
    assert all(c["total_received"] == c["total_processed"] + c["total_errors"] for c in counts.values())
    assert counts[2]["running"] == {
        "total_received": 6, "total_processed": 3, "total_accepted": 1, "total_rejected": 2, "total_errors": 3, "batches": 3,
    }


@pytest.mark.parametrize("kind", ["registry", "stateful"])
def test_a_payment_under_another_key_is_decided_once(spark, kind):
    base = tempfile.mkdtemp()
    parts = [
        [("a", "k", at(0)), ("b", "m", at(0, minutes=1))],
        [("a", "n", at(1)), ("c", "n", at(2)), ("d", "k", at(3)), ("b", "k", at(4))],
        [("e", "q", at(5)), ("e", "r", at(6)), ("f", "r", at(7))],
    ]
    for part in parts:
        write_parts(spark, part, f"{base}/in", 1)
        start(kind, read_stream(spark, f"{base}/in"), base).awaitTermination()
    out = spark.read.parquet(f"{base}/silver")
    assert out.count() == 6
    # a repeated message meets its key all the same: a holds n, e holds r
    assert decisions(out) == {
        "a": ("ACCEPTED", None), "b": ("ACCEPTED", None), "c": ("REJECTED_DUPLICATE", "a"),
        "d": ("REJECTED_DUPLICATE", "a"), "e": ("ACCEPTED", None), "f": ("REJECTED_DUPLICATE", "e"),
    }


def test_a_batch_reads_the_buckets_of_its_ids_alone(spark):
    from payguard.operators.id_index import IdIndex

    index = IdIndex(tempfile.mkdtemp() + "/ids", 16)
    ids = lambda names: spark.createDataFrame([(n,) for n in names], "payment_id string")
    from pyspark.sql import functions as F

    for batch in range(3):
        index.add(ids([f"p{batch}-{i}" for i in range(100)]).withColumn("batch_id", F.lit(batch).cast("long")))
    wanted = ids(["p0-1", "p1-5", "p2-7", "new"])
    touched = index.touched(wanted)
    assert 1 <= len(touched) <= 4
    seen = index.seen(wanted, 2)
    plan = seen._jdf.queryExecution().executedPlan().toString()
    assert "bucket" in plan[plan.index("PartitionFilters"):plan.index("PushedFilters")]
    files = [r[0] for r in seen.select(F.input_file_name()).distinct().collect()]
    assert files and {int(f.split("bucket=")[1].split("/")[0]) for f in files} <= set(touched)
    assert all("batch_id=2" not in f for f in files)
    assert {"p0-1", "p1-5"} <= {r[0] for r in seen.collect()} and "p2-7" not in {r[0] for r in seen.collect()}
    # a batch that is run again replaces its part
    index.add(ids(["p2-0"]).withColumn("batch_id", F.lit(2).cast("long")))
    assert index.seen(wanted, 9).where("payment_id = 'p2-0'").count() <= 1


def test_an_index_is_built_for_a_silver_table_that_has_none(spark):
    import shutil

    base = tempfile.mkdtemp()
    write_parts(spark, [("a", "k", at(0)), ("b", "m", at(1))], f"{base}/in", 1)
    start("registry", read_stream(spark, f"{base}/in"), base).awaitTermination()
    shutil.rmtree(f"{base}/silver_ids")
    write_parts(spark, [("a", "x", at(2)), ("c", "y", at(3))], f"{base}/in", 1)
    start("registry", read_stream(spark, f"{base}/in"), base).awaitTermination()
    assert sorted(r["payment_id"] for r in spark.read.parquet(f"{base}/silver").collect()) == ["a", "b", "c"]


def test_working_tables_of_a_batch_are_gone(spark, monkeypatch):
    from payguard import session

    root = tempfile.mkdtemp()
    monkeypatch.setattr(session, "shared_dir", lambda _: root)
    base = tempfile.mkdtemp()
    write_parts(spark, mixed_rows(25, 90), f"{base}/in", 3)
    start("registry", read_stream(spark, f"{base}/in"), base).awaitTermination()
    left = [f for _, _, files in os.walk(root) for f in files]
    assert left == []


def test_a_dropped_row_stops_the_job(spark):
    """The clock of a replay follows the arrivals; a row later than the retention is dropped by Spark, and told."""
    base = tempfile.mkdtemp()
    go = lambda: stateful.start(read_stream(spark, f"{base}/in"), f"{base}/silver", f"{base}/offsets", retention=3600, clock="ingested_at")
    for part in ([("a", "k", at(0))], [("b", "m", at(10))], [("c", "n", at(20))]):
        write_parts(spark, part, f"{base}/in", 1)
        stateful.await_without_loss(go())
    write_parts(spark, [("late", "z", at(1))], f"{base}/in", 1)
    with pytest.raises(stateful.RowsDropped):
        stateful.await_without_loss(go(), seconds=1)


def test_a_key_with_too_many_rows_is_refused(spark):
    from payguard.streaming.stateful import FirstSight

    class Handle:
        def getValueState(self, *a):
            class State:
                exists = staticmethod(lambda: False)
            return State()

    keys = FirstSight(["payment_id"], ["_us"], 60, False, 2)
    keys.init(Handle())
    with pytest.raises(ValueError, match="streaming.dedup"):
        list(keys.handleInputRows(("k",), iter([{"_us": 1}] * 3), None))


def test_keys_of_a_bucket_share_a_state_value(spark):
    """A call to the state store for every key made a large batch slow; the store now holds a few values."""
    rows = mixed_rows(26, 240)
    base = tempfile.mkdtemp()
    write_parts(spark, rows, f"{base}/in", 3)
    stateful.start(read_stream(spark, f"{base}/in"), f"{base}/silver", f"{base}/offsets", buckets=4).awaitTermination()
    assert decisions(spark.read.parquet(f"{base}/silver")) == decide_by_loop(rows)
    for variable, operator in (("held", stateful.KEYS), ("sent", stateful.PAYMENTS)):
        assert 1 <= stateful._state(spark, f"{base}/offsets", variable, operator).count() <= 4
    assert {r[0] for r in stateful.held_keys(spark, f"{base}/offsets").select("idempotency_key").collect()} == {k for _, k, _ in rows}
    assert sorted(r[0] for r in stateful.sent_payments(spark, f"{base}/offsets").collect()) == sorted(p for p, _, _ in rows)


def test_a_bucket_forgets_its_entries_one_by_one(spark):
    """All keys in one bucket: each goes when its own time is over, also one whose timer was not the earliest."""
    base = tempfile.mkdtemp()
    held = []
    for part in ([("a", "k", at(0)), ("b", "m", at(40))], [("c", "n", at(50))], [("d", "q", at(70))]):
        write_parts(spark, part, f"{base}/in", 1)
        stateful.await_without_loss(stateful.start(
            read_stream(spark, f"{base}/in"), f"{base}/silver", f"{base}/offsets", retention=3600, clock="ingested_at", buckets=1))
        held.append({r[0] for r in stateful.held_keys(spark, f"{base}/offsets").select("idempotency_key").collect()})
    assert held == [{"m"}, {"m", "n"}, {"n", "q"}]
    assert {r[0] for r in stateful.sent_payments(spark, f"{base}/offsets").collect()} == {"d"}


def test_fields_beside_the_decision_pass_the_state_unchanged(spark):
    from datetime import datetime
    from decimal import Decimal

    base = tempfile.mkdtemp()
    odd = [
        ("a", "k", 'q"\\\né\U0001f600', "", Decimal("12345678901234.5678"), None, "card", datetime(1969, 12, 31, 23, 59, 59, 999999), at(0), None, 1, at(0)),
        ("b", None, None, None, None, "USD", None, None, at(1), 3, None, datetime(2024, 1, 1, 0, 0, 0, 1)),
    ]
    spark.createDataFrame(odd, COLUMNS).coalesce(1).write.parquet(f"{base}/in")
    start("stateful", read_stream(spark, f"{base}/in"), base).awaitTermination()
    names = ["payment_id", "idempotency_key", "customer_id", "merchant_id", "amount", "currency", "payment_method",
             "event_timestamp", "processing_latency_ms", "decision_at"]
    out = {r["payment_id"]: tuple(r) for r in spark.read.parquet(f"{base}/silver").select(*names).collect()}
    assert out == {r[0]: (*r[:8], *r[10:]) for r in odd}


@pytest.mark.parametrize("kind", ["bronze", "messages", "events"])
def test_a_batch_from_one_file_is_dealt_over_tasks(spark, monkeypatch, kind):
    """One file is one split; parsing and deciding all of it in one task was slow, and that task read it all from the cache."""
    from pyspark.sql import functions as F

    base, seen = tempfile.mkdtemp(), []
    small = "spark.sql.adaptive.coalescePartitions.minPartitionSize"  # else so few rows are put into one task again
    spark.conf.set(small, "1k")

    def watch(module, name):
        known = getattr(module, name)
        def watched(df, *a, **k):
            if not df.isStreaming:
                seen.append([r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()])
            return known(df, *a, **k)
        monkeypatch.setattr(module, name, watched)

    if kind == "events":
        write_parts(spark, [(f"p{i}", f"k{i}", at(0)) for i in range(4000)], f"{base}/in", 1)
        watch(dedup_stream.dedup, "decide")
        dedup_stream.start(read_stream(spark, f"{base}/in"), f"{base}/silver", f"{base}/registry", f"{base}/offsets").awaitTermination()
    else:
        os.makedirs(f"{base}/in")
        with open(f"{base}/in/1.txt", "w") as f:
            f.write("\n".join(GOOD % f"p{i}" for i in range(4000)) + "\n")
        stream = messages.file_stream(spark, f"{base}/in", "text")
        watch(bronze_stream.messages, "typed")
        if kind == "bronze":
            bronze_stream.start(stream, f"{base}/bronze", f"{base}/dead", f"{base}/offsets").awaitTermination()
        else:
            dedup_stream.start(dedup_stream.checked_events(stream), f"{base}/silver", f"{base}/registry", f"{base}/offsets",
                               deadletter_path=f"{base}/dead").awaitTermination()
    spark.conf.unset(small)
    assert seen and sum(seen[0]) == 4000
    assert len(seen[0]) > 1 and max(seen[0]) <= 2 * min(seen[0])


def test_a_batch_is_not_held_in_memory(spark):
    """What a batch keeps are written tables: none of its frames reads a cache of whole messages."""
    base = tempfile.mkdtemp()
    os.makedirs(f"{base}/in")
    with open(f"{base}/in/1.txt", "w") as f:
        f.write("\n".join([GOOD % "a", GOOD % "b", '{"broken']) + "\n")
    plans = []
    dedup_stream.start(
        dedup_stream.checked_events(messages.file_stream(spark, f"{base}/in", "text")), f"{base}/silver", f"{base}/registry",
        f"{base}/offsets", deadletter_path=f"{base}/dead", record_invalid=True,
        publish=lambda rows, topic: plans.append(rows._jdf.queryExecution().optimizedPlan().toString()),
    ).awaitTermination()
    assert len(plans) == 2 and not [p for p in plans if "InMemoryRelation" in p]


def test_large_batches_meet_history_by_shuffle(spark, tmp_path):
    """Rows counted beyond the bound are never broadcast, however small their files look."""
    from payguard import settings
    from payguard.operators import tables

    rows = settings.BROADCAST_ROWS + 1
    new = spark.createDataFrame([("a", at(1)), ("b", at(2))], "payment_id string, ingested_at timestamp")
    old = spark.createDataFrame([("a",)], "payment_id string")
    out = tables.insert_if_absent(new, old, new_rows=rows)
    assert "Broadcast" not in out._jdf.queryExecution().sparkPlan().toString()
    assert [r["payment_id"] for r in out.collect()] == ["b"]
    live = [("k", "a", at(1), at(1).date(), 0), ("l", "z", at(1), at(1).date(), 0)]
    spark.createDataFrame(live, dedup_stream.REGISTRY_TABLE).write.partitionBy("accepted_date", "batch_id").parquet(f"{tmp_path}/registry")
    batch = spark.createDataFrame([("k", at(2))], "idempotency_key string, ingested_at timestamp")
    carried = dedup_stream.carried_entries(batch, rows, f"{tmp_path}/registry", 1, settings.TTL_SECONDS)
    assert "Broadcast" not in carried._jdf.queryExecution().sparkPlan().toString()
    assert [r["payment_id"] for r in carried.collect()] == ["a"]
