import random

import pytest
from pyspark.sql import functions as F

from payguard import settings
from payguard.functions.keys import idempotency_key, key_mismatches
from payguard.operators import dedup, registry
from rows import at, decide_by_loop, decisions, events


def payment(spark, times):
    return spark.createDataFrame(
        [(f"p{i}", "c", "m", 6.55, "USD", t) for i, t in enumerate(times)],
        "payment_id string, customer_id string, merchant_id string, amount double, currency string, event_timestamp timestamp",
    ).withColumn("idempotency_key", idempotency_key()).withColumn("ingested_at", F.col("event_timestamp"))


def test_bucket_edge_gives_two_payments(spark):
    df = payment(spark, [at(minutes=4, seconds=59), at(minutes=5)])
    assert decisions(dedup.decide(df)) == {"p0": ("ACCEPTED", None), "p1": ("ACCEPTED", None)}


def test_same_bucket_is_one_payment(spark):
    df = payment(spark, [at(), at(minutes=4, seconds=59)])
    assert decisions(dedup.decide(df)) == {"p0": ("ACCEPTED", None), "p1": ("REJECTED_DUPLICATE", "p0")}


def test_key_is_the_published_formula(spark):
    import hashlib

    df = payment(spark, [at(hours=1, minutes=7, seconds=3)])
    text = "c|m|6.5500|USD|2024-03-01T01:05:00+00:00"
    assert df.first()["idempotency_key"] == hashlib.sha256(text.encode()).hexdigest()


def test_key_is_null_when_a_part_is_null(spark):
    df = payment(spark, [at()]).withColumn("currency", F.lit(None).cast("string"))
    assert df.select(idempotency_key().alias("k")).first()["k"] is None


def test_key_mismatch_is_listed_and_decision_unchanged(spark):
    df = payment(spark, [at(), at(minutes=1)]).withColumn(
        "idempotency_key", F.when(F.col("payment_id") == "p1", "other").otherwise(F.col("idempotency_key"))
    )
    assert [r["payment_id"] for r in key_mismatches(df).collect()] == ["p1"]
    assert decisions(dedup.decide(df))["p1"] == ("ACCEPTED", None)


HOT = [50_000, 1]  # the usual bound, and one that sends every key the hot way


@pytest.mark.parametrize("hot_rows", HOT)
def test_expiry_boundary(spark, hot_rows):
    df = events(spark, [("a", "k", at(0)), ("b", "k", at(24, milliseconds=-1)), ("c", "k", at(24))])
    assert decisions(dedup.decide(df, hot_rows=hot_rows)) == {
        "a": ("ACCEPTED", None), "b": ("REJECTED_DUPLICATE", "a"), "c": ("ACCEPTED", None),
    }


@pytest.mark.parametrize("hot_rows", HOT)
def test_duplicates_do_not_extend_the_span(spark, hot_rows):
    df = events(spark, [(f"p{h}", "k", at(h)) for h in (0, 20, 30, 50, 55)])
    got = decisions(dedup.decide(df, hot_rows=hot_rows))
    assert got == {
        "p0": ("ACCEPTED", None), "p20": ("REJECTED_DUPLICATE", "p0"), "p30": ("ACCEPTED", None),
        "p50": ("REJECTED_DUPLICATE", "p30"), "p55": ("ACCEPTED", None),
    }


def test_order_of_rows_in_the_table_does_not_matter(spark):
    df = events(spark, [("late", "k", at(2)), ("early", "k", at(1))])
    assert decisions(dedup.decide(df)) == {"early": ("ACCEPTED", None), "late": ("REJECTED_DUPLICATE", "early")}


def mixed_rows(seed, n=600):
    """A third of the rows on one key, others sparse; spans from minutes to ten days."""
    r = random.Random(seed)
    rows = []
    for i in range(n):
        u = r.random()
        if u < 0.34:
            key, t = "hot", r.uniform(0, 240)
        elif u < 0.6:
            key, t = f"long{r.randrange(12)}", r.uniform(0, 240)
        else:
            k = r.randrange(120)
            key, t = f"short{k}", k + r.uniform(0, 2)
        # whole minutes make ties in arrival time likely
        rows.append((f"p{i:04d}", key, at(hours=0, minutes=int(t * 60))))
    return rows


@pytest.mark.parametrize("hot_rows", [50_000, 100, 15, 1])
def test_all_ways_equal_a_plain_loop(spark, hot_rows):
    rows = mixed_rows(hot_rows)
    got = decisions(dedup.decide(events(spark, rows), hot_rows=hot_rows))
    assert got == decide_by_loop(rows)


@pytest.mark.parametrize("hot_rows", [50_000, 15, 1])
def test_carried_entries_hold_their_keys(spark, hot_rows):
    rows = mixed_rows(7)
    rows.append(("before", "hot", at(-30)))  # late: older than the entry that holds the key
    held = {"hot": ("old1", at(-3)), "long3": ("old2", at(-40)), "short5": ("old3", at(4))}
    carried = spark.createDataFrame(
        [(k, p, t) for k, (p, t) in held.items()],
        "idempotency_key string, payment_id string, accepted_at timestamp",
    )
    got = decisions(dedup.decide(events(spark, rows), hot_rows=hot_rows, carried=carried))
    assert got == decide_by_loop(rows, held=held)


def test_more_long_keys_than_may_be_broadcast(spark, monkeypatch):
    monkeypatch.setattr(settings, "BROADCAST_ROWS", 3)
    rows = mixed_rows(3)
    got = decisions(dedup.decide(events(spark, rows), hot_rows=100))
    assert got == decide_by_loop(rows)


@pytest.mark.parametrize("partitions", [1, 3, 17])
def test_partitioning_does_not_matter(spark, partitions):
    rows = mixed_rows(11)
    df = events(spark, rows).repartition(partitions)
    assert decisions(dedup.decide(df, hot_rows=15)) == decide_by_loop(rows)


def test_properties(spark):
    rows = mixed_rows(5)
    out = dedup.decide(events(spark, rows))
    assert out.count() == len(rows)
    accepted = {r["payment_id"]: r for r in out.filter("dedup_status = 'ACCEPTED'").collect()}
    for r in out.filter("dedup_status = 'REJECTED_DUPLICATE'").collect():
        first = accepted[r["original_payment_id"]]
        assert first["idempotency_key"] == r["idempotency_key"]
        assert first["ingested_at"] <= r["ingested_at"] < first["ingested_at"] + (at(24) - at(0))


def test_copies_with_one_arrival_are_one_event(spark):
    rows = [("a", "k", at(0)), ("a", "k", at(0)), ("b", "k", at(1))]
    for hot_rows in HOT:
        out = dedup.decide(events(spark, rows), hot_rows=hot_rows)
        assert sorted((r["payment_id"], r["dedup_status"]) for r in out.collect()) == [
            ("a", "ACCEPTED"), ("a", "ACCEPTED"), ("b", "REJECTED_DUPLICATE"),
        ]


def test_registry_entries_and_live_keys(spark):
    decided = dedup.decide(events(spark, [("a", "k", at(0)), ("b", "k", at(30)), ("c", "j", at(10))]))
    entries = registry.acceptances(decided)
    assert {(r["idempotency_key"], r["payment_id"]) for r in registry.latest_entries(entries).collect()} == {
        ("k", "b"), ("j", "c"),
    }
    sizes = [registry.live_keys(entries, F.lit(t)).first()[0] for t in (at(-1), at(5), at(12), at(24), at(33), at(60))]
    assert sizes == [0, 1, 2, 1, 2, 0]


def test_empty_input(spark):
    assert dedup.decide(events(spark, [])).count() == 0
