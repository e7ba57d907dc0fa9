"""Gold from stored counters: late slices, crashes, and what a run reads."""

import tempfile

import pytest
from pyspark.sql import functions as F

from payguard import schemas
from payguard.operators import tables, watermark
from payguard.plans import gold, incremental
from rows import at
from test_tables import as_set, silver

BOUND = at(10)


def events(spark, seed, n=200):
    import random

    r = random.Random(seed)
    return silver(spark, [
        (f"p{i}", f"c{r.randrange(9)}", f"m{r.randrange(3)}", r.choice(["ACCEPTED", "REJECTED_DUPLICATE"]),
         r.choice([None, 1, 7, 49, 50, 61]), at(minutes=r.randrange(3_000)))
        for i in range(n)
    ])


def paths():
    base = tempfile.mkdtemp()
    return f"{base}/gold", f"{base}/marks"


def stored(spark, pipeline, path):
    return as_set(incremental.read_gold(spark, pipeline, path).drop("aggregated_at"))


def expected(pipeline, s):
    computed = schemas.conform(pipeline.compute(s).withColumn("aggregated_at", F.current_timestamp()), pipeline.schema)
    return as_set(computed.drop("aggregated_at"))


@pytest.mark.parametrize("pipeline", [incremental.MERCHANT, incremental.SLA, incremental.CUSTOMER, incremental.UNIQUES])
def test_runs_merge_to_one(spark, pipeline):
    s = events(spark, 1)
    path, marks = paths()
    for until in (at(10), at(20), None):
        incremental.run(pipeline, s, path, marks, "merge", until=None if until is None else F.lit(until))
    assert stored(spark, pipeline, path) == expected(pipeline, s)
    assert incremental.run(pipeline, s, path, marks, "merge") is None


def test_counters_of_a_run_that_stopped_are_passed_over(spark, monkeypatch):
    """It stopped before its mark; the next one has a larger slice, which holds the same rows again."""
    s = events(spark, 2)
    path, marks = paths()
    incremental.run(incremental.MERCHANT, s, path, marks, "merge", until=F.lit(at(10)))

    def stop(*a):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(incremental, "append_mark", stop)
        with pytest.raises(RuntimeError):
            incremental.run(incremental.MERCHANT, s, path, marks, "merge", until=F.lit(at(20)))
    incremental.run(incremental.MERCHANT, s, path, marks, "merge")
    assert stored(spark, incremental.MERCHANT, path) == expected(incremental.MERCHANT, s)


def test_the_same_run_twice(spark, monkeypatch):
    s = events(spark, 3)
    path, marks = paths()
    with monkeypatch.context() as m:
        m.setattr(incremental, "append_mark", lambda *a: None)
        incremental.run(incremental.CUSTOMER, s, path, marks, "merge")
    incremental.run(incremental.CUSTOMER, s, path, marks, "merge")
    assert stored(spark, incremental.CUSTOMER, path) == expected(incremental.CUSTOMER, s)


def test_keys_of_the_slice_are_reported(spark):
    s = events(spark, 4)
    path, marks = paths()
    first = incremental.run(incremental.MERCHANT, s, path, marks, "merge", until=F.lit(BOUND))
    assert first.rows == gold.merchant_hourly(s.where(F.col("decision_at") <= F.lit(BOUND))).count()


def test_a_late_slice_reads_no_day_of_silver(spark, monkeypatch):
    """Only rows after the mark are counted, though the day they touch has others."""
    s = events(spark, 5)
    path, marks = paths()
    incremental.run(incremental.SLA, s, path, marks, "merge", until=F.lit(BOUND))
    seen = []
    counted = incremental.SLA.count
    spy = incremental.Pipeline(**{**incremental.SLA.__dict__, "count": lambda df: seen.append(df.count()) or counted(df)})
    incremental.run(spy, s, path, marks, "merge")
    assert seen == [s.where(F.col("decision_at") > F.lit(BOUND)).count()]
    assert stored(spark, incremental.SLA, path) == expected(incremental.SLA, s)


def test_a_pipeline_without_counters_has_no_merge(spark):
    with pytest.raises(ValueError):
        incremental.run(incremental.SYSTEM, events(spark, 6, 5), *paths(), "merge")


def test_sketches_of_parts_unite_within_their_bound(spark):
    people = spark.range(30_000).select(
        F.concat(F.lit("c"), F.col("id") % 20_000).alias("customer_id"), F.concat(F.lit("m"), F.col("id") % 700).alias("merchant_id"),
        F.lit(at(3)).alias("decision_at"), (F.col("id") % 5).alias("part"))
    parts = [gold.unique_sketches(people.where(F.col("part") == i)) for i in range(5)]
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    row = gold.unique_estimates(gold.united(whole)).first()
    bound = 3 * 1.04 / 2 ** (gold.SKETCH_BITS / 2)
    assert abs(row["unique_customers_estimate"] - 20_000) <= 20_000 * bound
    assert abs(row["unique_merchants_estimate"] - 700) <= 700 * bound


def test_marks_are_read_from_the_log(spark):
    path, marks = paths()
    s = events(spark, 7, 20)
    incremental.run(incremental.UNIQUES, s, path, marks, "merge")
    log = tables.read_table(spark, marks, schemas.WATERMARKS)
    newest = watermark.read(log, incremental.UNIQUES.name).first()["last_processed_at"]
    assert newest == s.agg(F.max("decision_at")).first()[0]
