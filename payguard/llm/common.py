"""Small helpers the operators share: words, stored intermediate tables, byte spans."""

from __future__ import annotations

import gc
import re

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from payguard.session import run_dir

# Fixed value: a word is a run of anything but space and the ASCII controls 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"
WORD_RE = re.compile(WORD)
NULL_ID = -(2**63)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def whole_id(column: str) -> Column:
    """The id for pandas, which would make a long column with nulls one of floats: null is the
    least number there. ``null_id`` turns it back."""
    return F.coalesce(F.col(column).cast("long"), F.lit(NULL_ID))


def null_id(column: str) -> Column:
    return F.when(F.col(column) != NULL_ID, F.col(column)).alias(column)


def text_of(column: str | Column) -> Column:
    """The text, a null one being empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def words(column: str | Column) -> Column:
    return F.regexp_extract_all(text_of(column), F.lit(WORD), F.lit(0))


def n_words(column: str | Column) -> Column:
    """Number of words, counted without building them."""
    return F.regexp_count(text_of(column), F.lit(WORD)).cast("long")


def stored(df: DataFrame, label: str, *over: DataFrame) -> DataFrame:
    """The frame written below the cluster's shared folder and read again: its lineage is cut
    and a lost executor costs a read, not the work. Tables in ``over``, which nothing needs any
    more once this one is written, are deleted."""
    spark = df.sparkSession
    path = run_dir(spark, label)
    df.write.parquet(path)
    for old in over:
        _delete(spark, old.stored_at)
    free_shuffles(spark)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def shuffled(df: DataFrame) -> DataFrame:
    """For a join neither of whose sides may be broadcast. Spark sizes a table by its file or by the table it comes from,
    which is far too low after an ``explode`` and where equal texts or ids compress well, so it would send the driver
    tables that do not fit it; adaptive execution keeps to this hint and still splits skewed partitions."""
    return df.hint("merge")


def _delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def free_shuffles(spark: SparkSession) -> None:
    """Spark deletes the shuffle files of a job that is over when the driver collects its
    garbage, which a small driver may do after many jobs only; this asks for it now."""
    gc.collect()
    spark._jvm.System.gc()


def merge_spans(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Half-open spans as maximal runs in order; overlapping and touching ones are joined."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    first = np.flatnonzero(np.r_[True, start[1:] > reach[:-1]])
    return start[first], reach[np.r_[first[1:] - 1, len(start) - 1]]
