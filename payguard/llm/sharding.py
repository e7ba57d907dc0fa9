"""Sharding by rendezvous hashing of stable record keys over weighted shards.

Each shard scores a key with ``-weight / ln(u)``, u being the key's and the shard's uniform
hash; the key goes to the highest score. A further shard can only win keys for itself, and a
shard gets keys in proportion to its weight. The choice is a projection: nothing is shuffled
for it. Slots, gapless within a shard, need two narrow passes over keys and sizes: counts by
shard and hash bucket, and a window within each bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from payguard.llm.common import documents, stored, text_of

SHARDS = 8
# Rows a slot bucket should hold; the number of buckets grows with the table.
BUCKET_ROWS = 20_000


def _score(key: Column, shard: int, weight: float) -> Column:
    bits = F.conv(F.substring(F.md5(F.concat(key, F.lit(f":{shard}"))), 1, 13), 16, 10).cast("long")
    uniform = (bits.cast("double") + 0.5) / F.lit(float(2**52))
    return F.lit(-float(weight)) / F.log(uniform)


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """Shard of a key: an expression. Weights must be positive; ties go to the higher shard."""
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive")
    scores = [F.struct(_score(key, i, w).alias("score"), F.lit(i).alias("shard")) for i, w in enumerate(weights)]
    best = F.greatest(*scores) if len(scores) > 1 else scores[0]
    return best["shard"]


def assign(docs: DataFrame, weights: Sequence[float] = (1,) * SHARDS, grown: Sequence[float] | None = None,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Shard, slot and grown shard of every row: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    The key is the id as text, a null id being the text "null"; a null text has no bytes, so
    size 1. Rows of one id share a shard. Slots run from 0 in the order of a hash of the row,
    then id, checksum and size; rows equal in all of these are interchangeable. Other columns
    are ignored; an empty table gives an empty result.
    """
    grown = list(grown) if grown is not None else [*weights, 1]
    key = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    rows = stored(docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text_of(text_col)) + 1).cast("long").alias("size"),
        F.crc32(text_of(text_col).cast("binary")).alias("text_crc32"),
        rendezvous(key, weights).alias("shard"),
        rendezvous(key, grown).alias("grown_shard")), "shards")
    buckets = -(-rows.count() // (BUCKET_ROWS * len(weights))) or 1
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(buckets)))
    counts = rows.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(
        Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("shard", "bucket", before.alias("start"))
    order = Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size")
    placed = rows.withColumn("at", F.row_number().over(order)).join(starts, ["shard", "bucket"])
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("start") + F.col("at") - 1).cast("long").alias("slot"), "grown_shard")


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign(documents(spark, sf_dir))
