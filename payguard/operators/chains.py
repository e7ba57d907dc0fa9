"""Acceptances of hot keys in rounds that grow with the logarithm of the time they span.

A key is taken by its first instant, and anew by the first instant at least one time to live
later, and so on: a chain. Every instant points to the one that would follow it, found
within ranges of instants of even size. A slice is as long as the time to live, so it holds at most one
link of a chain; a block is 2, 4, 8 ... slices. Only instants at which a chain can enter a block matter to it:
those of its first slice and the next one after it. Their pointers out of the block come from
two pointers out of its halves, so each round halves the instants and doubles the time they
leap over; all rounds together handle some three times the instants.

Rounds end when a key has few instants left, whose pointers one fold follows, or when one block
spans everything, where the first instant is the only entry. The way back down
asks each round's pointers for the links in between: joins of the chain, which is small, with each round's table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from payguard import settings as S
from payguard.session import Workspace

_START, _END = Window.unboundedPreceding, Window.currentRow


def neighbours(instants: DataFrame, key: str, ttl_us: int, work: Workspace) -> DataFrame:
    """``key, t, before, next``: the instant before, and the first at least one time to live later.

    Instants and the questions they ask (``t`` plus the time to live) are cut together into ranges of even size, so
    that a key with any number of instants is spread over many tasks; what a range cannot answer comes from the
    ends of the key's other ranges, one row for each.
    """
    asks = instants.select(key, (F.col("t") + ttl_us).alias("at"), F.col("t").alias("asks"))
    both = instants.select(key, F.col("t").alias("at"), F.lit(None).cast("bigint").alias("asks")).unionByName(asks)
    dealt = work.keep(both.repartitionByRange(key, "at").withColumn("part", F.spark_partition_id()))

    instant, question = F.when(F.col("asks").isNull(), F.col("at")), F.col("asks").isNotNull()
    here = Window.partitionBy("part", key)
    # an instant answers a question about the very same time, hence comes first on the way down
    down = here.orderBy(F.desc("at"), question).rowsBetween(_START, _END)
    up = here.orderBy("at", question).rowsBetween(_START, -1)
    found = dealt.select(
        key, "part", "at", "asks", F.min(instant).over(down).alias("_next"), F.max(instant).over(up).alias("_before")
    )
    ends = dealt.groupBy(key, "part").agg(F.min(instant).alias("_first"), F.max(instant).alias("_last"))
    parts = Window.partitionBy(key)
    ends = ends.select(
        key, "part",
        F.min("_first").over(parts.orderBy(F.desc("part")).rowsBetween(_START, -1)).alias("_after"),
        F.max("_last").over(parts.orderBy("part").rowsBetween(_START, -1)).alias("_until"),
    )
    joined = found.join(ends, [key, "part"])
    return joined.groupBy(key, F.coalesce("asks", "at").alias("t")).agg(
        F.max(F.when(~question, F.coalesce("_before", "_until"))).alias("before"),
        F.max(F.when(question, F.coalesce("_next", "_after"))).alias("next"),
    )


def _block(t: Column, span: int) -> Column:
    return F.floor(t / F.lit(span)).cast("bigint")


def _leap(now: DataFrame, key: str, ttl_us: int, span: int) -> DataFrame:
    """Pointers out of blocks of ``span`` from those out of their halves, for the instants that can enter a block."""
    t, following = F.col("t"), F.col("next")
    first_slice_ends = _block(t, span) * span + ttl_us
    entries = now.where(F.col("before").isNull() | (F.col("before") < first_slice_ends))
    halves = now.select(key, F.col("t").alias("_via"), F.col("next").alias("_over"))
    # the end of a chain goes by itself, so that no key gathers them
    via = entries.withColumn("_via", F.coalesce("next", "t")).join(halves, [key, "_via"], "left")
    inside = _block(following, span) == _block(t, span)
    return via.select(key, "t", "before", F.when(inside, F.col("_over")).otherwise(following).alias("next"))


def _followed(now: DataFrame, key: str) -> DataFrame:
    """The chain of each key along its pointers; a key has a bounded number of rows here."""
    rows = now.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("t", "next"))).alias("_rows"))
    start = F.struct(F.col("_rows")[0]["t"].alias("wanted"), F.array().cast("array<bigint>").alias("taken"))

    def step(chain: Column, row: Column) -> Column:
        longer = F.struct(row["next"].alias("wanted"), F.concat(chain["taken"], F.array(row["t"])).alias("taken"))
        return F.when(row["t"] == chain["wanted"], longer).otherwise(chain)

    return rows.select(key, F.explode(F.aggregate("_rows", start, step)["taken"]).alias("t"))


def accepted(
    instants: DataFrame, key: str, ttl: int, work: Workspace, low: int, high: int,
    fold_rows: int | None = None, small: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """The instants (``key, t`` in epoch microseconds, distinct) at which each key is taken.

    All instants lie from ``low`` to ``high``. ``small`` may mark the chain as one to broadcast; see ``dedup``.
    """
    fold_rows = S.HOT_KEY_ROWS if fold_rows is None else fold_rows
    ttl_us = ttl * 1_000_000
    shifted = instants.select(key, (F.col("t") - low).alias("t"))
    rounds = [work.keep(neighbours(shifted, key, ttl_us, work))]
    span = ttl_us
    while True:
        most = rounds[-1].groupBy(key).count().agg(F.max("count")).first()[0] or 0
        if most <= fold_rows:
            chain = _followed(rounds[-1], key)
            break
        if span > high - low:
            chain = rounds[-1].groupBy(key).agg(F.min("t").alias("t"))
            break
        span *= 2
        rounds.append(work.keep(_leap(rounds[-1], key, ttl_us, span)))
    for pointers in reversed(rounds[:-1]):
        both = pointers.join(small(chain), [key, "t"]).select(key, F.explode(F.array("t", "next")).alias("t"))
        chain = both.where(F.col("t").isNotNull()).distinct()
    return chain.select(key, (F.col("t") + low).alias("t"))
