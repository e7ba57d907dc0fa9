"""Which payments were decided: their ids by bucket of a hash, and by batch.

A batch looks its ids up in the buckets they fall into, which partition pruning reads alone, instead of the id
column of every Silver file ever written. A bucket holds nothing but ids. The number of buckets is part of the path, so that
tables of different counts never mix; raise it as history grows: a batch of fewer ids than
buckets reads that share of the history, a larger one reads ids alone.

Like every table a batch writes, the index is partitioned by batch as well: a batch run again replaces its own
part, and looks only at earlier ones.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from payguard import settings as S
from payguard.operators import tables
from payguard.schemas import struct_of

INDEX = struct_of("payment_id string, bucket integer, batch_id long")


@dataclass(frozen=True)
class IdIndex:
    root: str
    buckets: int = S.INDEX_BUCKETS

    @property
    def path(self) -> str:
        return f"{self.root}/of_{self.buckets}"

    def bucket(self, key: str = "payment_id") -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def exists(self, spark: SparkSession) -> bool:
        return tables.path_exists(spark, self.path)

    def add(self, ids: DataFrame) -> None:
        """Ids (``payment_id, batch_id``) of one or more batches; replaces what the index had of those batches."""
        dealt = ids.select("payment_id", self.bucket().alias("bucket"), "batch_id")
        # one file for a bucket and batch, since every later batch opens them, written by as many tasks as can run:
        # a number given keeps small batches from being put into one
        tasks = min(self.buckets, ids.sparkSession.sparkContext.defaultParallelism)
        tables.replace_partitions(dealt.repartition(tasks, "bucket"), self.path, ["bucket", "batch_id"])

    def touched(self, ids: DataFrame) -> list[int]:
        """Buckets the ids fall into; never more than there are."""
        return sorted(r[0] for r in ids.where(F.col("payment_id").isNotNull()).select(self.bucket().alias("b")).distinct().collect())

    def seen(self, ids: DataFrame, before_batch: int) -> DataFrame | None:
        """Ids of earlier batches in the buckets of ``ids``; None before the first batch."""
        spark = ids.sparkSession
        if not self.exists(spark):
            return None
        all_ids = tables.read_table(spark, self.path, INDEX)
        return all_ids.where(F.col("bucket").isin(self.touched(ids)) & (F.col("batch_id") < before_batch)).select("payment_id")

    def build(self, silver: DataFrame) -> None:
        """The index of a Silver table written before there was one."""
        self.add(silver.select("payment_id", "batch_id"))
