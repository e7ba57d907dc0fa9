"""What the physical plans must and must not contain."""

import tempfile

import pytest
from pyspark.sql import functions as F

from payguard.functions import measures
from payguard.operators import dedup, tables, watermark
from payguard.plans import catalog, gold, incremental, recon
from test_tables import a_day

STREAMS = {n for n in catalog.QUERIES if n.startswith("stream_")}
RUNS = {n for n in catalog.QUERIES if "two_runs" in n} | {"hwm_advance_runs", "bronze_append"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - STREAMS - RUNS))
def test_no_product_of_tables_and_no_python(spark, sf_dir, name):
    text = plan(catalog.QUERIES[name](spark, sf_dir))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ArrowEval"):
        assert word not in text


def test_decisions_read_only_what_the_result_needs(spark, sf_dir):
    text = plan(catalog.gold_customer_daily(spark, sf_dir))
    assert "event_type" not in text and "props" not in text
    assert text.count("Exchange hashpartitioning") == 2  # one for the decision, one for the groups


def test_a_run_prunes_partitions_and_pushes_the_range(spark):
    path = tempfile.mkdtemp() + "/silver"
    tables.replace_partitions(a_day(spark).withColumn("decision_date", F.to_date("decision_at")), path, ["decision_date"])
    source = incremental.bucket_input(
        spark.read.parquet(path), watermark.instant(1_709_280_000_000_000), watermark.instant(1_709_290_000_000_000), "day"
    )
    text = source._jdf.queryExecution().explainString(
        source.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert "PartitionFilters: [isnotnull(decision_date" in text
    assert "GreaterThan(decision_at" in text and "LessThanOrEqual(decision_at" in text


def test_groups_are_counted_before_they_are_gathered(spark):
    text = plan(measures.latency_profile(a_day(spark), ["merchant_id"]))
    first, last = text.rindex("Exchange hashpartitioning"), text.index("Exchange hashpartitioning")
    assert "processing_latency_ms" in text[first:first + 120]
    assert "partial_count" in text[first:]
    assert last < first


def test_copies_collapse_before_the_join(spark):
    s = a_day(spark)
    b = s.select("payment_id", F.lit(True).alias("is_retry_flag"))
    text = plan(recon.confusion_matrix(b, s))
    assert "partial_count" in text[text.index("Join"):]


def test_uniqueness_check_shrinks_copies_in_each_task(spark):
    text = plan(tables.insert_if_absent(a_day(spark), None, order=["decision_at"]))
    assert "partial_min" in text and "Window" not in text


def test_hot_keys_never_meet_in_a_window(spark):
    from test_dedup import mixed_rows
    from rows import events

    text = plan(dedup.decide(events(spark, mixed_rows(1)), hot_rows=1).filter("payment_id is not null"))
    hot = text[text.rindex("Union") :] if "Union" in text else text
    assert "_slice" in hot and "Join" in hot


def test_top_list_is_a_bounded_sort(spark):
    assert "TakeOrderedAndProject" in plan(gold.flagged_top(gold.customer_daily(a_day(spark))))
