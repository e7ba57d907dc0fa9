"""Mixing sources to target weights by hash-threshold histograms.

Every document gets a uniform 60-bit hash of its id and text. A source with target T and size S takes
each document floor(T / S) times and, once more, those whose hash lies below a threshold. The
threshold is found without sorting: sizes are summed by source and hash bucket, the running
sum over at most 4,096 buckets a source names the bucket in which the budget ends, and only
that bucket's documents are summed again by the next 12 bits, five levels down. Documents are
read as (id, source, size), never shuffled, and never sorted; a level shuffles at most 4,096
sums a source and task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from payguard.llm.common import documents, n_words, stored, text_of

# Fixed values of the recipe: weights by the sources' order, and the most passes over a source.
WEIGHTS = (5, 2, 1)
MOST = 3
BITS, LEVELS = 12, 5
# A table of sources up to this size (some 50 bytes a row) may be broadcast; a larger one is joined by shuffle.
BROADCAST_SOURCES = 100_000


def targets(sizes: list[tuple[str | None, int]], weights=WEIGHTS, most: int = MOST) -> list[dict]:
    """Targets by source: shares of the whole by weight, at most ``most`` times the source.

    Sources are ordered by code point, null last; weights repeat along that order. What a full
    source leaves is shared again by weight until none is above its limit, which is the level
    at which the uncapped sources' shares just use up the rest. One row a source: a recipe
    names its sources, so this table is the driver's to hold. Sources without words get 0.
    """
    order = sorted(sizes, key=lambda x: (x[0] is None, x[0] or ""))
    rows = [{"source": s, "size": n, "weight": weights[i % len(weights)]} for i, (s, n) in enumerate(order)]
    total, taken, weight = sum(r["size"] for r in rows), 0, sum(r["weight"] for r in rows)
    # in the order in which sources fill up while all shares grow together
    for r in sorted(rows, key=lambda r: r["size"] / r["weight"]):
        if weight and (total - taken) * r["weight"] >= most * r["size"] * weight:
            r["capped"] = True
            taken += most * r["size"]
            weight -= r["weight"]
        else:
            r["capped"] = False
    for r in rows:
        exact = most * r["size"] if r["capped"] else (total - taken) * r["weight"]
        r["target"] = float(exact) if r["capped"] else exact / weight
        r["passes"] = min(most, math.floor(r["target"] / r["size"])) if r["size"] else 0
        r["rest"] = r["target"] - r["passes"] * r["size"]
    return rows


def _hash(id_col: str, text_col: str) -> Column:
    """Of id and text, so that texts with one id, or without one, are told apart."""
    named = F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.lit(":"), F.md5(text_of(text_col).cast("binary")))
    digits = F.substring(F.md5(named.cast("binary")), 1, 15)
    return F.conv(digits, 16, 10).cast("long")


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """The mix, a row a source: ``s, source_size, target, passes, below`` (the hash threshold)."""
    spark = docs.sparkSession
    rows = stored(docs.select(F.col(source_col).cast("string").alias("source"), n_words(text_col).alias("size"), _hash(id_col, text_col).alias("h")), "mix")
    totals = [(r["source"], r["size"]) for r in rows.groupBy("source").agg(F.sum("size").alias("size")).collect()]
    recipe = targets(totals, weights, most)
    wanted = [(r["source"], 0, r["rest"]) for r in recipe]
    for level in range(LEVELS):
        wanted = _narrow(rows, wanted, level)
    out = [(r["source"], r["size"], r["target"], r["passes"], below) for r, (_, below, _) in zip(recipe, wanted, strict=True)]
    return _table(spark, out, "s string, source_size long, target double, passes int, below long")


def _table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    df = spark.createDataFrame(rows, schema)
    return F.broadcast(df) if len(rows) <= BROADCAST_SOURCES else df


def with_copies(docs: DataFrame, mixed: DataFrame, id_col: str = "doc_id", source_col: str = "source", most: int = MOST, text_col: str = "text") -> DataFrame:
    """The rows with the columns of their source's ``plan`` and ``copies``; nothing is shuffled."""
    rows = docs.join(mixed, F.col(source_col).cast("string").eqNullSafe(F.col("s")))
    return rows.withColumn("copies", F.least(F.lit(most), F.col("passes") + (_hash(id_col, text_col) < F.col("below")).cast("int")))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """How often each document goes into the mix.

    Returns ``doc_id, size, source, source_size, target, copies, taken`` for every row. Other
    columns are ignored. Null or empty texts have size 0 and copies like their hash says; rows
    with one id and one text share a hash, so repeated rows are taken or left together; a null id hashes
    like the text "null". The threshold falls on the document border nearest the target. An
    empty table gives an empty result.
    """
    mixed = plan(docs, id_col, text_col, source_col, weights, most)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), F.col(text_col).alias("text"))
    out = with_copies(rows, mixed, most=most).withColumn("size", n_words("text"))
    return out.select("doc_id", "size", "source", "source_size", "target", "copies", (F.col("copies") * F.col("size")).cast("long").alias("taken"))


def _narrow(rows: DataFrame, wanted: list, level: int) -> list:
    """One level down: (source, start of the boundary bucket, what is left to take from it).

    At the last level a bucket is one hash; the threshold passes it if its half fits.
    """
    spark, shift = rows.sparkSession, BITS * (LEVELS - 1 - level)
    bound = _table(spark, wanted, "s string, low long, rest double")
    inside = rows.join(bound, F.col("source").eqNullSafe(F.col("s")))
    if level:
        inside = inside.where(F.shiftright("h", shift + BITS) == F.shiftright("low", shift + BITS))
    histogram = inside.groupBy("source", "low", "rest", F.shiftright("h", shift).alias("bucket")).agg(F.sum("size").alias("n"))
    run = F.sum("n").over(Window.partitionBy("source").orderBy("bucket"))
    summed = histogram.withColumn("run", run)
    reached = F.col("run") - F.col("n") / 2 if level == LEVELS - 1 else F.col("run")
    passed = (reached <= F.col("rest")) & (F.col("rest") > 0)
    found = {r["source"]: r for r in summed.groupBy("source").agg(
        F.min(F.when(~passed, F.col("bucket"))).alias("bucket"),
        F.coalesce(F.max(F.when(passed, F.col("run"))), F.lit(0)).alias("run")).collect()}
    out = []
    for source, low, rest in wanted:
        if source not in found:
            out.append((source, low, rest))
            continue
        bucket, run = found[source]["bucket"], found[source]["run"]
        # all of a boundary bucket passes only where its last hash passes by half
        end = bucket if bucket is not None else ((low >> (shift + BITS)) + 1) << BITS
        out.append((source, end << shift, rest - run))
    return out


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


SQL = """
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || md5(coalesce(text, ''))), 1, 15) AS BIGINT) AS h
  FROM documents),
s AS (
  SELECT source, sum(size) AS size,
         [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w
  FROM d GROUP BY source),
f AS (
  SELECT *, sum(size) OVER () AS total,
         coalesce(sum(3 * size) OVER (ORDER BY size / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS filled,
         sum(w) OVER (ORDER BY size / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w_left
  FROM s),
g AS (SELECT *, (total - filled) * w >= 3 * size * w_left AS capped FROM f),
t AS (
  SELECT source, size AS source_size,
         CASE WHEN capped THEN CAST(3 * size AS DOUBLE)
              ELSE CAST((total - coalesce((SELECT sum(3 * size) FROM g WHERE capped), 0)) * w AS DOUBLE)
                   / (SELECT sum(w) FROM g WHERE NOT capped) END AS target
  FROM g),
u AS (
  SELECT d.*, t.source_size, t.target, CASE WHEN t.source_size = 0 THEN 0 ELSE least(3, floor(t.target / t.source_size)) END AS passes
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
v AS (
  SELECT *, target - passes * source_size AS rest,
         sum(size) OVER (PARTITION BY source ORDER BY h) AS run,
         sum(size) OVER (PARTITION BY source, h) AS n
  FROM u)
SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, target,
       CAST(size * least(3, passes + CASE WHEN rest > 0 AND run - n / 2 <= rest THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM v
"""
