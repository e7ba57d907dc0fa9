import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from payguard import schemas
from payguard import settings as S
from payguard.functions import measures
from payguard.operators import tables, validity, watermark
from payguard.plans import gold, incremental, recon
from payguard.sources import messages
from rows import at

SILVER = "payment_id string, customer_id string, merchant_id string, dedup_status string, original_payment_id string, processing_latency_ms int, decision_at timestamp"


def silver(spark, rows):
    """(id, customer, merchant, status, latency, time) as decisions."""
    return spark.createDataFrame(
        [(i, c, m, s, "orig" if s != S.ACCEPTED else None, ms, t) for i, c, m, s, ms, t in rows], SILVER
    )


def a_day(spark, n=40):
    return silver(spark, [
        (f"p{i}", f"c{i % 3}", f"m{i % 2}", S.ACCEPTED if i % 4 else S.REJECTED_DUPLICATE, (i * 7) % 61,
         at(8, minutes=i * 13))
        for i in range(n)
    ])


def as_set(df):
    return {tuple(r) for r in df.collect()}


# -- sinks --


def test_redelivered_payment_is_kept_once(spark):
    new = silver(spark, [("a", "c", "m", S.REJECTED_DUPLICATE, 2, at(2)), ("a", "c", "m", S.ACCEPTED, 1, at(1))])
    out = tables.insert_if_absent(new, None, order=["decision_at"])
    assert [r["dedup_status"] for r in out.collect()] == [S.ACCEPTED]
    assert tables.insert_if_absent(new, out, order=["decision_at"]).count() == 0
    assert out.columns == new.columns


def test_upsert_replaces_and_keeps(spark):
    old = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    new = spark.createDataFrame([(2, "z"), (3, "w")], "k int, v string")
    assert as_set(tables.upsert(old, new, ["k"])) == {(1, "x"), (2, "z"), (3, "w")}


# -- incremental runs --


def run_twice(spark, mode, pipeline=incremental.MERCHANT, rows=None):
    d = tempfile.mkdtemp()
    s = rows if rows is not None else a_day(spark)
    cut = F.lit(at(10, minutes=30))  # in the middle of an hour
    first = incremental.run(pipeline, s, f"{d}/g", f"{d}/w", mode, until=cut)
    second = incremental.run(pipeline, s, f"{d}/g", f"{d}/w", mode)
    third = incremental.run(pipeline, s, f"{d}/g", f"{d}/w", mode)
    assert third is None
    out = incremental.read_gold(spark, pipeline, f"{d}/g").drop("aggregated_at")
    log = watermark.current(tables.read_table(spark, f"{d}/w", schemas.WATERMARKS)).first()
    return out, log, first, second


def expected(spark, pipeline, s):
    return as_set(schemas.conform(pipeline.compute(s), pipeline.schema).drop("aggregated_at"))


@pytest.mark.parametrize("pipeline", [incremental.MERCHANT, incremental.SLA, incremental.CUSTOMER])
def test_two_full_runs_equal_one(spark, pipeline):
    out, log, first, second = run_twice(spark, "full_bucket", pipeline)
    assert as_set(out) == expected(spark, pipeline, a_day(spark))
    assert log["rows_processed"] == first.rows + second.rows


def test_hourly_partitions_give_the_same(spark):
    import dataclasses

    out, *_ = run_twice(spark, "full_bucket", dataclasses.replace(incremental.MERCHANT, part_unit="hour"))
    assert as_set(out) == expected(spark, incremental.MERCHANT, a_day(spark))


def test_slice_run_keeps_only_the_last_slice_of_a_bucket(spark):
    out, *_ = run_twice(spark, "slice")
    s, cut = a_day(spark), F.lit(at(10, minutes=30))
    early = expected(spark, incremental.MERCHANT, s.filter(F.col("decision_at") <= cut))
    late = expected(spark, incremental.MERCHANT, s.filter(F.col("decision_at") > cut))
    keys = {r[:2] for r in late}
    assert as_set(out) == late | {r for r in early if r[:2] not in keys}
    assert as_set(out) != expected(spark, incremental.MERCHANT, s)


def test_a_run_stopped_before_its_mark_is_repeated(spark, monkeypatch):
    d = tempfile.mkdtemp()
    s = a_day(spark)

    def stop(*a, **k):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(incremental, "append_mark", stop)
        with pytest.raises(RuntimeError):
            incremental.run(incremental.SLA, s, f"{d}/g", f"{d}/w")
    incremental.run(incremental.SLA, s, f"{d}/g", f"{d}/w")
    out = incremental.read_gold(spark, incremental.SLA, f"{d}/g").drop("aggregated_at")
    assert as_set(out) == expected(spark, incremental.SLA, s)


def test_empty_silver_leaves_everything_alone(spark):
    d = tempfile.mkdtemp()
    assert incremental.run(incremental.SLA, silver(spark, []), f"{d}/g", f"{d}/w") is None
    assert incremental.read_gold(spark, incremental.SLA, f"{d}/g").count() == 0
    assert gold.sla_hourly(silver(spark, [])).count() == 0


def test_marks_default_and_seed(spark):
    log = spark.createDataFrame([], schemas.WATERMARKS)
    assert str(watermark.read(log, "any").first()["last_processed_at"]) == "1970-01-01 00:00:00"
    seeded = watermark.seed(log)
    assert seeded.count() == 4 and watermark.seed(seeded).count() == 0


# -- Gold values --


def test_latency_target_is_strict(spark):
    r = gold.sla_hourly(silver(spark, [("a", "c", "m", S.ACCEPTED, 49, at(1)), ("b", "c", "m", S.ACCEPTED, 50, at(1))])).first()
    assert (r["within_sla_count"], r["breached_sla_count"], float(r["sla_compliance_pct"])) == (1, 1, 50.0)


def test_review_flag_is_strict(spark):
    rows = [(f"x{i}", "three", "m", S.REJECTED_DUPLICATE, 1, at(1)) for i in range(3)]
    rows += [(f"y{i}", "four", "m", S.REJECTED_DUPLICATE, 1, at(1)) for i in range(4)]
    got = {r["customer_id"]: r["flagged_for_review"] for r in gold.customer_daily(silver(spark, rows)).collect()}
    assert got == {"three": False, "four": True}


def test_percentiles_equal_numpy(spark):
    values = [(i * i) % 97 for i in range(83)]
    s = silver(spark, [(str(i), "c", "m", S.ACCEPTED, v, at(1)) for i, v in enumerate(values)])
    r = measures.latency_profile(s, []).first()
    for name, q in (("p50_ms", 50), ("p95_ms", 95), ("p99_ms", 99)):
        assert r[name] == pytest.approx(round(float(np.percentile(values, q)), 2))
    assert float(r["avg_ms"]) == pytest.approx(round(float(np.mean(values)), 2))


def test_histogram_equals_numpy(spark):
    values = [(i * 37) % 61 for i in range(500)]
    s = silver(spark, [(str(i), "c", "m", S.ACCEPTED, v, at(1)) for i, v in enumerate(values)])
    rows = sorted(measures.latency_histogram(s).collect(), key=lambda r: r["bin"])
    counts, edges = np.histogram(values, bins=30)
    assert [r["n"] for r in rows] == counts.tolist()
    assert [r["bin_start"] for r in rows] == pytest.approx(edges[:-1].tolist())


def test_histogram_of_a_constant(spark):
    s = silver(spark, [(str(i), "c", "m", S.ACCEPTED, 7, at(1)) for i in range(5)])
    rows = sorted(measures.latency_histogram(s).collect(), key=lambda r: r["bin"])
    counts, _ = np.histogram([7] * 5, bins=30)
    assert [r["n"] for r in rows] == counts.tolist() and rows[15]["n"] == 5
    assert rows[0]["bin_start"] == 6.5 and rows[29]["bin_end"] == 7.5


def test_retry_gaps_cross_midnight(spark):
    rows = [("a", at(23, minutes=50)), ("b", at(23, minutes=58)), ("c", at(24, minutes=2))]
    s = spark.createDataFrame(
        [(p, "c", "m", S.ACCEPTED if p == "a" else S.REJECTED_DUPLICATE, None if p == "a" else "a", 1, t) for p, t in rows], SILVER
    )
    got = {str(r["day_bucket"]): (r["max_retries_per_payment"], r["retry_gaps"], float(r["avg_retry_interval_sec"]))
           for r in gold.customer_retries(s).collect()}
    assert got == {"2024-03-01": (1, 1, 480.0), "2024-03-02": (1, 1, 240.0)}


def test_system_summary_keeps_days_of_one_layer(spark):
    bronze = spark.createDataFrame([(at(0),), (at(48),)], "ingested_at timestamp")
    rows = gold.system_daily(bronze, silver(spark, [("a", "c", "m", S.ACCEPTED, 3, at(24))])).orderBy("day_bucket").collect()
    assert [(r["total_events_received"], r["total_accepted"]) for r in rows] == [(1, 0), (0, 1), (1, 0)]


# -- reconciliation --


def test_missing_rows_show_in_both_directions(spark):
    bronze = spark.createDataFrame([("a",), ("b",), ("b",)], "payment_id string")
    s = spark.createDataFrame([("a",), ("c",)], "payment_id string")
    assert as_set(recon.missing_decisions(bronze, s)) == {("b", "silver", 2), ("c", "bronze", 1)}


def test_reports_on_empty_layers(spark):
    bronze = spark.createDataFrame([], "payment_id string, is_retry_flag boolean")
    s = silver(spark, [])
    m = recon.precision_recall(recon.confusion_matrix(bronze, s)).first()
    assert tuple(m) == (0, 0, 0, 0, 0.0, 0.0)
    total = recon.summary(bronze, s, gold.customer_daily(s)).first()
    assert total["bronze_total"] == 0 and total["duplicate_rate_pct"] is None
    assert recon.sla_report(s).first()["compliance_pct"] is None


# -- messages --

GOOD = ('{"payment_id":"%s","idempotency_key":"k","customer_id":"c","merchant_id":"m","amount":6.55,"currency":"USD",'
        '"payment_method":"card","status":"pending","event_timestamp":"2024-03-01T00:00:01.5+00:00"}')


def test_bad_rows_leave_alone(spark):
    bad = {
        '{"payment_id": "x': "not valid JSON",
        GOOD.replace('"payment_id":"%s",', ""): "payment_id missing",
        GOOD.replace("USD", "USDX") % "b3": "currency longer than 3",
        GOOD.replace("6.55", '"abc"') % "b4": "amount not a decimal",
        GOOD.replace('"customer_id":"c"', '"customer_id":null') % "b5": "customer_id missing",
    }
    values = [GOOD % "g1", *bad, GOOD % "g2"]
    frame = spark.createDataFrame([(v,) for v in values], "value string")
    checked = validity.with_reasons(messages.decode(frame))
    good = messages.typed(validity.valid(checked)).collect()
    assert sorted(r["payment_id"] for r in good) == ["g1", "g2"]
    assert {r["raw_payload"]: r["invalid_reason"] for r in validity.dead_letters(checked).collect()} == bad
    assert sorted(r["payment_id"] for r in validity.invalid_decisions(checked).collect()) == ["b3", "b4", "b5"]
    row = good[0]
    assert (row["retry_count"], row["is_retry_flag"], str(row["amount"])) == (0, False, "6.5500")
    assert row["event_timestamp"].microsecond == 500_000 and row["raw_payload"] == GOOD % row["payment_id"]


def test_explicit_null_takes_the_default(spark):
    value = (GOOD % "a").replace('"status"', '"retry_count":null,"is_retry_flag":null,"status"')
    frame = spark.createDataFrame([(value,)], "value string")
    r = messages.typed(validity.valid(validity.with_reasons(messages.decode(frame)))).first()
    assert (r["retry_count"], r["is_retry_flag"]) == (0, False)


def test_latency_truncates(spark):
    df = spark.createDataFrame([(at(), at(microseconds=1_999))], "event_timestamp timestamp, decision_at timestamp")
    assert df.select(measures.latency_ms()).first()[0] == 1


def test_latency_of_a_replayed_event(spark):
    df = spark.createDataFrame([(at(), at(24 * 60))], "event_timestamp timestamp, decision_at timestamp")
    hours = (at(24 * 60) - at()).total_seconds()
    assert df.select(measures.latency_ms()).first()[0] == hours * 1000 > 2**31


def test_counters_and_latencies_beyond_32_bits(spark):
    from payguard import schemas

    big = 3_000_000_000
    df = spark.createDataFrame([("m", at(), big, big)], "merchant_id string, hour_bucket timestamp, total_payments long, avg_latency_ms long")
    row = schemas.conform(df, schemas.GOLD_MERCHANT).first()
    assert (row["total_payments"], int(row["avg_latency_ms"])) == (big, big)


def test_percentiles_of_everything_match_those_of_one_group(spark):
    import random

    rng = random.Random(4)
    values = [rng.choice([None, -rng.randrange(10), rng.randrange(60), rng.randrange(10**6), rng.randrange(10**10)]) for _ in range(3_000)]
    df = spark.createDataFrame([("g", "ACCEPTED", v) for v in values], "g string, dedup_status string, processing_latency_ms long").repartition(6)
    names = ["n", "n_within", "avg_ms", "min_ms", "max_ms", "p50_ms", "p95_ms", "p99_ms"]
    everything = measures.latency_profile(df, []).select(*names).first()
    assert everything == measures.latency_profile(df, ["g"]).select(*names).first()
    timed = sorted(v for v in values if v is not None)
    k = (len(timed) - 1) * 95
    low = timed[k // 100]
    want = low + (timed[min(k // 100 + 1, len(timed) - 1)] - low) * (k % 100) / 100
    assert abs(float(everything["p95_ms"]) - want) < 0.01 and everything["n"] == 3_000


@pytest.mark.parametrize("zone", ["UTC", "Asia/Kolkata", "America/New_York"])
def test_key_does_not_depend_on_the_session_zone(spark, zone):
    import hashlib

    from payguard.functions import keys

    old = spark.conf.get("spark.sql.session.timeZone")
    df = spark.range(1).select(F.timestamp_seconds(F.lit(1_710_053_999)).alias("t"))  # an hour before a change of clocks
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        key = df.select(keys.idempotency_key(F.lit("c"), F.lit("m"), F.lit(5), F.lit("USD"), "t")).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert key == hashlib.sha256(b"c|m|5.0000|USD|2024-03-10T06:55:00+00:00").hexdigest()


def test_system_summary_counts_bronze_that_comes_late(spark):
    """Bronze of a day that Silver's run has passed, and a run with news of Bronze alone."""
    base = tempfile.mkdtemp()
    received = "payment_id string, ingested_at timestamp, batch_id long"
    first = [("a", at(0), 0), ("b", at(24), 0)]
    s = silver(spark, [("a", "c", "m", S.ACCEPTED, 3, at(0)), ("b", "c", "m", S.ACCEPTED, 3, at(24))])

    def run(bronze):
        return incremental.run(incremental.SYSTEM, s, f"{base}/gold", f"{base}/marks", bronze=spark.createDataFrame(bronze, received))

    assert run(first).rows == 2
    late = [*first, ("late", at(1), 1)]
    assert run(late).rows == 1
    assert run(late) is None
    got = incremental.read_gold(spark, incremental.SYSTEM, f"{base}/gold").orderBy("day_bucket").collect()
    assert [r["total_events_received"] for r in got] == [2, 1]
    assert [r["total_accepted"] for r in got] == [1, 1]


@pytest.mark.parametrize("text,good", [
    ("10.0.0.1", True), ("255.255.255.255/32", True), ("256.1.1.1", False), ("10.0.0", False), ("::1", True), ("2001:db8::ff00:42:8329", True),
    ("1:2:3:4:5:6:7:8", True), ("1::2::3", False), ("::ffff:10.0.0.1", True), ("host", False), ("", False),
])
def test_addresses(spark, text, good):
    assert spark.range(1).select(F.lit(text).rlike(validity.ADDRESS)).first()[0] == good
