"""Insert-if-absent and keyed upsert over parquet tables, without a table format.

Where the tables live in a format that has MERGE, ``DataFrame.mergeInto`` does
the same; plain parquet has no row-level writes, so partitions are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payguard import settings as S
from payguard.operators import manifest
from payguard.operators.dedup import arrival_columns
from payguard.session import Workspace


def first_per_key(new: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The earliest row of each key.

    An aggregate rather than a window: copies of one key, however many, shrink
    to one row per task before the shuffle.
    """
    rest = [c for c in new.columns if c not in order and c != key]
    lead = [c for c in order if c != key]
    first = F.min(F.struct(*lead, *rest)).alias("_r")
    return new.groupBy(key).agg(first).select(key, "_r.*").select(*new.columns)


def insert_if_absent(
    new: DataFrame,
    existing: DataFrame | None,
    key: str = "payment_id",
    order: Sequence[str] | None = None,
    new_rows: int | None = None,
) -> DataFrame:
    """Rows to append: the first of each key in ``new`` whose key ``existing`` lacks.

    The aggregate leaves the rows partitioned by the key, which the anti join
    reuses, and unique, so the join has no skew; only the key column of
    ``existing`` is read. With few ``new_rows`` (counted by the caller) their keys
    are broadcast to thin out ``existing`` during its scan, and history is not
    shuffled at all.
    """
    order = list(order) if order else arrival_columns(new)
    firsts = first_per_key(new, key, order)
    if existing is None:
        return firsts
    seen = existing.select(key)
    if new_rows is not None and new_rows <= S.BROADCAST_ROWS:
        seen = seen.join(F.broadcast(new.select(key).distinct()), key, "left_semi")
    elif new_rows is not None:
        seen = seen.hint("merge")  # ids compress well: by its files the history would pass for small
    return firsts.join(seen, key, "left_anti")


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Old rows whose key is not in ``new``, and all of ``new`` (unique per key)."""
    kept = old.join(new.select(*keys), list(keys), "left_anti")
    return kept.unionByName(new)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(jvm_path)


def read_table(spark: SparkSession, path: str, schema) -> DataFrame:
    """The table, or an empty frame of its schema before the first write; its live parts where it was compacted."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    known = manifest.newest(spark, path)
    if known is not None:
        return manifest.read(spark, path, schema, known)
    return spark.read.schema(schema).parquet(path)


def replace_partitions(df: DataFrame, path: str, by: Sequence[str], rebalance: bool = False) -> None:
    """Overwrite just the partitions present in ``df``.

    ``rebalance`` is for small results spread over many partitions: adaptive
    execution then sizes the files, splitting a big partition over tasks and
    letting small ones share one. Wide rows are written where they are.
    """
    if rebalance:
        df = df.hint("rebalance", *by)
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def append_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    df.write.mode("append").partitionBy(*by).parquet(path)


def upsert_partitions(new: DataFrame, path: str, schema, keys: Sequence[str], part: str) -> None:
    """Keyed upsert into a partitioned table; reads only the partitions touched.

    A plan must not overwrite what it reads, so the merged rows are written to the shared folder
    first; those working tables are deleted at the end.
    """
    spark = new.sparkSession
    with Workspace(spark, "upsert") as work:
        new = work.keep(new)
        if path_exists(spark, path):
            touched = [r[0] for r in new.select(part).distinct().collect()]  # a few dates or hours
            old = spark.read.schema(schema).parquet(path).filter(F.col(part).isin(touched))
            new = work.keep(upsert(old, new, keys))
        replace_partitions(new, path, [part], rebalance=True)
