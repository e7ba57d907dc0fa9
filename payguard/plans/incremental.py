"""Incremental Gold runs: from a pipeline's mark to the newest decision.

Order of a run: read the mark, freeze the upper bound, write Gold, then append
the new mark. A run that stops in between is simply run again.

Two modes:

``full_bucket`` (default)
    Gold is partitioned by day. The slice is contiguous in decision time, so only
    the day holding the old mark can be half covered: reading Silver from the start
    of that day recomputes every touched bucket in full. The run replaces whole
    partitions, reads no old Gold and can be repeated at will, at the price of at
    most one day of narrow Silver columns beyond the slice. Where that matters more
    than file count, ``part_unit="hour"`` partitions an hourly table by hour.
``merge``
    For pipelines whose counters add up. A run counts the slice alone, stores these counters beside Gold
    (``<gold>_parts``, by day and run), and computes the days it touched from the counters of all runs: no Silver row is
    read twice, however late a slice comes. Counters of a run that never wrote its mark are passed over, so a
    run that stopped can be repeated with a larger slice. Such a pipeline keeps this mode from its first run.
``slice``
    Aggregates the slice alone and replaces the keys it holds: a bucket spread
    over two runs keeps the values of the last slice only.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from payguard import schemas
from payguard import settings as S
from payguard.functions.measures import added
from payguard.operators import tables, watermark
from payguard.plans import gold

PART = "bucket_part"


@dataclass(frozen=True)
class Pipeline:
    """One Gold table: how it is computed, keyed and bucketed."""

    name: str
    compute: Callable[..., DataFrame]
    keys: Sequence[str]
    bucket: str
    unit: str  # bucket length: "hour" or "day"
    schema: StructType
    part_unit: str = "day"  # partition length; never shorter than the bucket
    # for the merge mode: counters of a slice, those of several slices as one, Gold from them
    count: Callable[[DataFrame], DataFrame] | None = None
    merge: Callable[[DataFrame], DataFrame] | None = None
    finish: Callable[[DataFrame], DataFrame] | None = None

    def part(self) -> Column:
        pattern = "yyyy-MM-dd-HH" if self.part_unit == "hour" else "yyyy-MM-dd"
        return F.date_format(self.bucket, pattern).alias(PART)

    def table_schema(self) -> StructType:
        return StructType([*self.schema.fields]).add(PART, "string")


MERCHANT = Pipeline(S.PIPELINE_MERCHANT, gold.merchant_hourly, ("merchant_id", "hour_bucket"),
                    "hour_bucket", "hour", schemas.GOLD_MERCHANT,
                    count=gold.merchant_counts, merge=added, finish=gold.merchant_of)
SLA = Pipeline(S.PIPELINE_SLA, gold.sla_hourly, ("hour_bucket",),
               "hour_bucket", "hour", schemas.GOLD_SLA, count=gold.sla_counts, merge=added, finish=gold.sla_of)
CUSTOMER = Pipeline(S.PIPELINE_CUSTOMER, gold.customer_daily, ("customer_id", "day_bucket"),
                    "day_bucket", "day", schemas.GOLD_CUSTOMER,
                    count=gold.customer_counts, merge=added, finish=gold.customer_of)
# Estimates of distinct counts; the exact ones are in the system summary.
UNIQUES = Pipeline(S.PIPELINE_UNIQUES, lambda silver: gold.unique_estimates(gold.unique_sketches(silver)), ("day_bucket",),
                   "day_bucket", "day", schemas.GOLD_UNIQUES,
                   count=gold.unique_sketches, merge=gold.united, finish=gold.unique_estimates)

# Computed from Silver and, by day, from Bronze; ``run`` takes the latter as ``bronze``.
SYSTEM = Pipeline(S.PIPELINE_SYSTEM, gold.system_daily, ("day_bucket",),
                  "day_bucket", "day", schemas.GOLD_SYSTEM)


def slice_input(silver: DataFrame, mark: Column, high: Column) -> DataFrame:
    return watermark.slice_of(silver, mark, high)


def bucket_input(silver: DataFrame, mark: Column, high: Column, unit: str) -> DataFrame:
    """From the start of the partition that holds the mark, up to the frozen bound."""
    start = F.date_trunc(unit, mark) - F.expr("interval 1 microsecond")
    return watermark.slice_of(silver, start, high)


def touched_keys(pipeline: Pipeline, silver: DataFrame, mark: Column, high: Column) -> DataFrame:
    """Keys with at least one row in the slice: what an upsert would report."""
    bucket = F.date_trunc(pipeline.unit, "decision_at")
    if pipeline.unit == "day":
        bucket = bucket.cast("date")
    named = [bucket.alias(k) if k == pipeline.bucket else F.col(k) for k in pipeline.keys]
    return slice_input(silver, mark, high).select(*named).distinct()


@dataclass(frozen=True)
class RunResult:
    """New mark in epoch microseconds, and Gold rows upserted."""

    mark_us: int
    rows: int


def run(
    pipeline: Pipeline,
    silver: DataFrame,
    gold_path: str,
    log_path: str,
    mode: str = "full_bucket",
    until: Column | None = None,
    bronze: DataFrame | None = None,
) -> RunResult | None:
    """One incremental run; None when there was nothing newer than the mark.

    Only two values reach the driver: the mark and the frozen upper bound.
    ``until`` lowers the bound, to catch up in portions. ``bronze`` is for the system
    summary, see ``run_system``.
    """
    if bronze is not None:
        return run_system(pipeline, bronze, silver, gold_path, log_path, until)
    if mode not in ("full_bucket", "slice", "merge") or mode == "merge" and pipeline.count is None:
        raise ValueError(f"unknown mode {mode!r}, or not one of {pipeline.name}")
    spark = silver.sparkSession
    if until is not None:
        silver = silver.filter(F.col("decision_at") <= until)
    log = tables.read_table(spark, log_path, schemas.WATERMARKS)
    mark_us = watermark.read(log, pipeline.name).select(F.unix_micros("last_processed_at")).first()[0]
    mark = watermark.instant(mark_us)
    high_us = watermark.new_mark(silver, mark).select(F.unix_micros("max_decision_at")).first()[0]
    if high_us is None:
        return None
    high = watermark.instant(high_us)
    if mode == "merge":
        rows = merge_slice(pipeline, slice_input(silver, mark, high), gold_path, log, high_us)
        append_mark(spark, log_path, pipeline.name, high_us, rows)
        return RunResult(high_us, rows)
    source = slice_input(silver, mark, high) if mode == "slice" else bucket_input(silver, mark, high, pipeline.part_unit)
    stamped = schemas.conform(
        pipeline.compute(source).withColumn("aggregated_at", F.current_timestamp()), pipeline.schema
    ).withColumn(PART, pipeline.part())
    if mode == "slice":
        tables.upsert_partitions(stamped, gold_path, pipeline.table_schema(), pipeline.keys, PART)
    else:
        tables.replace_partitions(stamped, gold_path, [PART], rebalance=True)
    rows = touched_keys(pipeline, silver, mark, high).count()
    append_mark(spark, log_path, pipeline.name, high_us, rows)
    return RunResult(high_us, rows)


def merge_slice(pipeline: Pipeline, news: DataFrame, gold_path: str, log: DataFrame, run_us: int) -> int:
    """Store the slice's counters, then replace the Gold partitions it touches from those of all runs; how
    many keys the slice has."""
    spark, path = news.sparkSession, f"{gold_path}_parts"
    counted = pipeline.count(news)
    schema = StructType([*counted.schema.fields]).add(PART, "string").add("run_us", "long")
    dated = counted.withColumn(PART, pipeline.part()).withColumn("run_us", F.lit(run_us))
    tables.replace_partitions(dated, path, [PART, "run_us"], rebalance=True)
    everything = spark.read.schema(schema).parquet(path)
    own = everything.where(F.col("run_us") == run_us)
    touched = [r[0] for r in own.select(PART).distinct().collect()]  # the days of a slice
    finished = log.where(F.col("pipeline_name") == pipeline.name).select(F.unix_micros("last_processed_at").alias("run_us")).distinct()
    runs = finished.where(F.col("run_us") != run_us).unionByName(spark.createDataFrame([(run_us,)], "run_us long"))
    parts = everything.where(F.col(PART).isin(touched)).join(runs, "run_us", "left_semi").drop(PART, "run_us")
    result = pipeline.finish(pipeline.merge(parts)).withColumn("aggregated_at", F.current_timestamp())
    stamped = schemas.conform(result, pipeline.schema).withColumn(PART, pipeline.part())
    tables.replace_partitions(stamped, gold_path, [PART], rebalance=True)
    return own.select(*pipeline.keys).distinct().count()


def run_system(
    pipeline: Pipeline, bronze: DataFrame, silver: DataFrame, gold_path: str, log_path: str, until: Column | None = None
) -> RunResult | None:
    """One run over both layers, each with a mark of its own.

    Silver's mark is a decision time, Bronze's (``<name>:bronze``) an ingest time and,
    where Bronze has batches, its last batch: a batch written late is new whatever day
    its rows were ingested on. The days that either layer has news of are recomputed
    in full from both and replaced. Days are dates, so their list is short.
    """
    spark = silver.sparkSession
    log = tables.read_table(spark, log_path, schemas.WATERMARKS)

    def mark_of(name: str) -> int:
        return watermark.read(log, name).select(F.unix_micros("last_processed_at")).first()[0]

    if until is not None:
        silver = silver.filter(F.col("decision_at") <= until)
    mark_us, seen = mark_of(pipeline.name), mark_of(f"{pipeline.name}:bronze")
    # the log holds instants; a batch number is kept as so many microseconds
    batches = "batch_id" in bronze.columns
    order = F.col("batch_id") + 1 if batches else F.unix_micros("ingested_at")
    high_us = watermark.new_mark(silver, watermark.instant(mark_us)).select(F.unix_micros("max_decision_at")).first()[0]
    new_bronze = bronze.filter(order > seen)
    if not batches and until is not None:
        new_bronze = new_bronze.filter(F.col("ingested_at") <= until)
    high_bronze = new_bronze.agg(F.max(order)).first()[0]
    if high_us is None and high_bronze is None:
        return None
    new_silver = silver.filter((F.col("decision_at") > watermark.instant(mark_us)))
    days = new_bronze.select(F.to_date("ingested_at").alias("d")).union(new_silver.select(F.to_date("decision_at").alias("d")))
    touched = [r["d"] for r in days.distinct().collect() if r["d"] is not None]

    def of_days(df: DataFrame, at: str, date: str) -> DataFrame:
        low = min(touched, default=None)
        out = df.filter((F.col(at) >= F.lit(low).cast("timestamp")) & F.to_date(at).isin(touched))
        return out.filter(F.col(date).isin(touched)) if date in df.columns else out

    frozen = silver if high_us is None else silver.filter(F.col("decision_at") <= watermark.instant(high_us))
    seen_rows = bronze if high_bronze is None else bronze.filter(order <= max(seen, high_bronze))
    result = pipeline.compute(of_days(seen_rows, "ingested_at", "ingested_date"), of_days(frozen, "decision_at", "decision_date"))
    stamped = schemas.conform(result.withColumn("aggregated_at", F.current_timestamp()), pipeline.schema)
    tables.replace_partitions(stamped.withColumn(PART, pipeline.part()), gold_path, [PART], rebalance=True)
    if high_bronze is not None:
        append_mark(spark, log_path, f"{pipeline.name}:bronze", high_bronze, 0)
    if high_us is not None:
        append_mark(spark, log_path, pipeline.name, high_us, len(touched))
    return RunResult(mark_us if high_us is None else high_us, len(touched))


def append_mark(spark: SparkSession, log_path: str, name: str, mark_us: int, rows: int) -> None:
    watermark.entry(spark, name, mark_us, rows).write.mode("append").parquet(log_path)


def read_gold(spark: SparkSession, pipeline: Pipeline, path: str) -> DataFrame:
    return tables.read_table(spark, path, pipeline.table_schema()).drop(PART)
