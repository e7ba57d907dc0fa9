"""High-water marks of the pipelines, kept as an append-only log.

Each run adds one row; the state of a pipeline is its latest row with the sum of
its counts. Nothing is rewritten, so a lost executor or a stopped run cannot
damage the marks of any pipeline.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from payguard import settings as S
from payguard.schemas import WATERMARKS, conform

EPOCH = "1970-01-01 00:00:00"


def current(log: DataFrame) -> DataFrame:
    """One row per pipeline: latest mark and run, total rows."""
    latest = F.max(F.struct("last_run_at", "last_processed_at"))
    return (
        log.groupBy("pipeline_name")
        .agg(latest.alias("_l"), F.sum("rows_processed").alias("rows_processed"))
        .select("pipeline_name", "_l.last_processed_at", "_l.last_run_at", "rows_processed")
    )


def read(log: DataFrame, pipeline: str) -> DataFrame:
    """One row with the pipeline's mark; the epoch if it has none."""
    mark = current(log.filter(F.col("pipeline_name") == pipeline)).agg(F.max("last_processed_at").alias("m"))
    return mark.select(
        F.lit(pipeline).alias("pipeline_name"),
        F.coalesce("m", F.lit(EPOCH).cast("timestamp")).alias("last_processed_at"),
    )


def seeds(spark: SparkSession, pipelines: Sequence[str] = S.PIPELINES) -> DataFrame:
    return conform(
        spark.createDataFrame([(p,) for p in pipelines], "pipeline_name string").select(
            "pipeline_name",
            F.lit(EPOCH).cast("timestamp").alias("last_processed_at"),
            F.lit(EPOCH).cast("timestamp").alias("last_run_at"),
            F.lit(0).alias("rows_processed"),
        ),
        WATERMARKS,
    )


def seed(log: DataFrame, pipelines: Sequence[str] = S.PIPELINES) -> DataFrame:
    """Seed rows for the pipelines the log does not know yet."""
    return seeds(log.sparkSession, pipelines).join(
        log.select("pipeline_name").distinct(), "pipeline_name", "left_anti"
    )


def instant(micros: int) -> Column:
    """A mark held on the driver, as epoch microseconds: exact in any time zone."""
    return F.timestamp_micros(F.lit(micros))


def entry(spark: SparkSession, pipeline: str, mark_us: int, rows: int) -> DataFrame:
    """The log row a finished run appends."""
    return conform(
        spark.range(1).select(
            F.lit(pipeline).alias("pipeline_name"), instant(mark_us).alias("last_processed_at"),
            F.current_timestamp().alias("last_run_at"), F.lit(rows).alias("rows_processed"),
        ),
        WATERMARKS,
    )


def new_mark(silver: DataFrame, mark: Column) -> DataFrame:
    """Upper bound of the next slice; null when nothing is newer than ``mark``."""
    newer = silver.filter(F.col("decision_at") > mark)
    if "decision_date" in silver.columns:
        newer = newer.filter(F.col("decision_date") >= F.to_date(mark))
    return newer.agg(F.max("decision_at").alias("max_decision_at"))


def slice_of(silver: DataFrame, low: Column, high: Column) -> DataFrame:
    """Rows in ``(low, high]``; bounds the date partition too where there is one."""
    at = F.col("decision_at")
    out = silver.filter((at > low) & (at <= high))
    if "decision_date" in silver.columns:
        out = out.filter(F.col("decision_date").between(F.to_date(low), F.to_date(high)))
    return out
