"""The input of the stream queries: micro-batches of several files."""

from pyspark.sql import functions as F

from payguard.plans import catalog
from payguard.session import run_dir
from payguard.streaming.bronze import writer


def test_a_span_is_a_batch_of_several_files(spark):
    base, got = run_dir(spark, "batches"), {}
    df = spark.range(0, 400, 1, 5).select("id", F.timestamp_seconds(F.col("id") % 40).alias("ingested_at"))

    def step(batch, batch_id):
        rows = batch.select("id", F.input_file_name().alias("f")).collect()
        got[batch_id] = (len(rows), len({r["f"] for r in rows}))

    catalog._in_batches(spark, df, base, lambda stream: writer(stream, step, f"{base}/offsets", None))
    assert got == {0: (100, 5), 1: (100, 5), 2: (100, 5), 3: (200, 5)}
