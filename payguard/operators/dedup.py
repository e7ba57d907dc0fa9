"""First sight or duplicate: the decision for every event of a table.

Rule: a key is taken by the first event that arrives while it is free and stays
taken for the time to live, counted from that event and never extended. An
event at or after the end of that span takes the key anew.

Three ways lead to the same answer and a cheap profile picks the way per key:

* keys whose rows all lie within one time to live: one window over the key;
* keys that outlive it: a fold over the key's own sorted arrivals;
* hot keys (more rows than ``hot_rows``): acceptances come from pointers that leap over
  twice the time in each round (``chains``), and the rows meet them in a
  map-side join. Rows of a hot key are never brought together.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from payguard import settings as S
from payguard.functions.keys import registry_key
from payguard.operators import chains
from payguard.session import Workspace

_PRIOR = "_is_event"  # 0 on a carried registry entry, 1 on an event: entries sort first


def arrival_columns(df: DataFrame, order: Sequence[str] = S.ARRIVAL_ORDER) -> list[str]:
    return [c for c in order if c in df.columns]


def _arrival(df: DataFrame) -> Column:
    """Sort position of a row, with the payment it names as the last field."""
    lead = [_PRIOR] if _PRIOR in df.columns else []
    return F.struct(*[F.col(c) for c in [*lead, *arrival_columns(df)]])


def _ttl_end(instant: Column, ttl: int) -> Column:
    return F.timestamp_micros(F.unix_micros(instant) + F.lit(ttl * 1_000_000))


@dataclass(frozen=True)
class KeyProfile:
    """Keys that need more than the window, by 64-bit hash of the key.

    ``flagged`` is null when there are none. A hash shared by two keys can only
    flag a key needlessly, and every way gives the same decisions.
    """

    flagged: DataFrame | None
    long_keys: int = 0
    hot_keys: int = 0


def _small(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast hint for a frame of counted size; beyond the bound the join
    shuffles and adaptive execution splits its skewed partitions."""
    return F.broadcast(df) if rows <= S.BROADCAST_ROWS else df


def profile_keys(events: DataFrame, key: str, ttl: int, hot_rows: int, work: Workspace) -> KeyProfile:
    """Find long and hot keys in one pass over two columns.

    Everything shuffled is a fixed-width number, 32 bytes per key and task after
    map-side combine; no row and no key text moves.
    """
    micros = F.unix_micros("ingested_at")
    flagged = (
        events.groupBy(F.xxhash64(key).alias("_h"))
        .agg(F.count("*").alias("_n"), F.min(micros).alias("_lo"), F.max(micros).alias("_hi"))
        .select(
            "_h",
            (F.col("_n") > hot_rows).alias("_hot"),
            (F.col("_hi") - F.col("_lo") >= F.lit(ttl * 1_000_000)).alias("_long"),
        )
        .filter("_hot or _long")
    )
    flagged = work.keep(flagged)
    long_keys, hot_keys = flagged.select(
        F.count_if(F.expr("_long and not _hot")), F.count_if(F.col("_hot"))
    ).first()
    if not long_keys and not hot_keys:
        return KeyProfile(None)
    return KeyProfile(flagged, long_keys, hot_keys)


def _tagged(rows: DataFrame, key: str, flagged: DataFrame, n: int) -> DataFrame:
    """Rows with the hash of their key, ``_tag`` true where it is among ``flagged``."""
    marks = flagged.select("_h", F.lit(True).alias("_tag"))
    return rows.withColumn("_h", F.xxhash64(key)).join(_small(marks, n), "_h", "left")


def _by_window(rows: DataFrame, by: list[str]) -> DataFrame:
    """Keys within one time to live: the first arrival is accepted, the rest name it."""
    cols = [_PRIOR, *arrival_columns(rows)] if _PRIOR in rows.columns else arrival_columns(rows)
    w = Window.partitionBy(*by).orderBy(*cols)
    return rows.select(
        "*",
        # rank, not row_number: copies with one arrival position are one event
        (F.rank().over(w) == 1).alias("_taken"),
        F.first("payment_id").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("_holder"),
    )


def _greedy(sorted_arrivals: Column, ttl: int) -> Column:
    """Arrivals that take the key, oldest first; state is only the list of those."""

    def step(taken: Column, a: Column) -> Column:
        free = a["ingested_at"] >= _ttl_end(F.element_at(taken, -1)["ingested_at"], ttl)
        return F.when(free, F.concat(taken, F.array(a))).otherwise(taken)

    return F.aggregate(
        F.slice(sorted_arrivals, 2, F.size(sorted_arrivals)), F.slice(sorted_arrivals, 1, 1), step
    )


def _assign(rows: DataFrame, arrival: Column) -> DataFrame:
    """Give each row the acceptance in force when it arrived.

    ``_epochs`` is sorted and starts at the key's first arrival, so the one in
    force is the last that does not come after the row.
    """
    epoch = F.element_at(F.filter("_epochs", lambda e: e <= arrival), -1)
    return (
        rows.withColumn("_epoch", epoch)
        .withColumn("_taken", F.col("_epoch") == arrival)
        .withColumn("_holder", F.col("_epoch")["payment_id"])
        .drop("_epochs", "_epoch")
    )


def _by_fold(rows: DataFrame, by: list[str], ttl: int) -> DataFrame:
    """Keys that outlive the time to live, each with a bounded number of rows.

    One shuffle: the rows of a key travel once, are sorted, folded and unpacked
    in place, with no join back.
    """
    rest = [c for c in rows.columns if c not in by]
    arrival = _arrival(rows)
    packed = rows.groupBy(*by).agg(
        F.sort_array(F.collect_list(F.struct(arrival.alias("_a"), F.struct(*rest).alias("_r")))).alias("_rows")
    )
    folded = packed.select(
        *by, "_rows", _greedy(F.transform("_rows", lambda r: r["_a"]), ttl).alias("_epochs")
    )
    flat = folded.select(*by, "_epochs", F.explode("_rows").alias("_row"))
    return _assign(flat.select(*by, "_epochs", "_row._r.*"), arrival)


def _slice(at: Column, ttl: int) -> Column:
    return F.floor(F.unix_micros(at) / F.lit(ttl * 1_000_000)).cast("bigint")


def _by_slices(rows: DataFrame, key: str, ttl: int, hot_keys: int, work: Workspace) -> DataFrame:
    """Hot keys. Their number is bounded by rows / hot_rows and was counted.

    Two acceptances of a key are at least one time to live apart, so a slice of that length
    holds at most one. A row meets two acceptances at most: the one of its own slice, and the
    last one before. They are laid out per key and slice, so the join is a plain
    equality and the choice a single comparison.
    """
    arrival, at = _arrival(rows), F.unix_micros("ingested_at").alias("t")
    entries, own = None, rows
    if _PRIOR in rows.columns:
        # Carried entries hold their keys before any event does.
        entries = work.keep(rows.filter(F.col(_PRIOR) == 0).groupBy(key).agg(F.min(arrival).alias("_a")))
        own = rows.filter(F.col(_PRIOR) == 1)
    instants = work.keep(own.groupBy(key, at).agg(F.min(arrival).alias("_a")))
    free = instants.select(key, "t")
    if entries is not None:
        until = entries.select(key, (F.unix_micros("_a.ingested_at") + ttl * 1_000_000).alias("_until"))
        free = free.join(_small(until, hot_keys), key, "left").filter(
            F.col("_until").isNull() | (F.col("t") >= F.col("_until"))
        ).select(key, "t")
    n, low, high = instants.agg(F.count("*"), F.min("t"), F.max("t")).first()
    if not n:  # carried entries alone
        return rows.select("*", F.lit(False).alias("_taken"), F.lit(None).cast("string").alias("_holder"))
    # an acceptance, and a line of the layout, for each key and slice at most
    slots = min(n, hot_keys * ((high - low) // (ttl * 1_000_000) + 2)) + hot_keys
    chain = chains.accepted(free, key, ttl, work, low, high, small=lambda df: _small(df, slots))
    taken = instants.join(_small(chain, slots), [key, "t"], "left_semi")
    epochs = taken.select(key, _slice(F.timestamp_micros("t"), ttl).alias("_slice"), F.col("_a").alias("_within"))
    slices = instants.select(key, _slice(F.timestamp_micros("t"), ttl).alias("_slice")).distinct()
    laid_out = slices.join(epochs, [key, "_slice"], "left")
    if entries is not None:
        laid_out = laid_out.unionByName(entries.select(key, F.lit(-(2**63)).alias("_slice"), F.col("_a").alias("_within")))
    earlier = Window.partitionBy(key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    laid_out = work.keep(laid_out.withColumn("_before", F.last("_within", ignorenulls=True).over(earlier)))
    met = rows.withColumn("_slice", _slice(F.col("ingested_at"), ttl)).join(_small(laid_out, slots), [key, "_slice"])
    holder = F.when(arrival >= F.col("_within"), F.col("_within")).otherwise(F.col("_before"))
    return met.withColumn("_epoch", holder).select(
        *rows.columns, (F.col("_epoch") == arrival).alias("_taken"),
        F.col("_epoch")["payment_id"].alias("_holder"),
    )


def decide(
    events: DataFrame,
    ttl: int = S.TTL_SECONDS,
    key: str = "idempotency_key",
    hot_rows: int = S.HOT_KEY_ROWS,
    carried: DataFrame | None = None,
    profile: KeyProfile | None = None,
    work: Workspace | None = None,
) -> DataFrame:
    """Add ``dedup_status``, ``rejection_reason``, ``original_payment_id``, ``registry_key``.

    Every row needs a key, an arrival and a payment_id, as ``validity`` ensures.
    ``carried`` holds registry entries (key, payment_id, accepted_at) from earlier
    batches, at most one per key: they take their keys before any event does.
    The ground-truth ``original_payment_id`` of the message, if present, is
    replaced by the finding of the registry, as in the decision record.
    ``work`` holds the working tables the result reads; without one they stay below the shared folder.
    """
    work = work or Workspace(events.sparkSession, "decide")
    rows = events.drop("original_payment_id")
    columns = rows.columns
    if carried is not None:
        rows = rows.withColumn(_PRIOR, F.lit(1)).unionByName(
            carried.select(key, "payment_id", F.col("accepted_at").alias("ingested_at"),
                           F.lit(0).alias(_PRIOR)),
            allowMissingColumns=True,
        )
    profile = profile or profile_keys(rows, key, ttl, hot_rows, work)
    ways = []
    if profile.hot_keys:
        hot = _tagged(rows, key, profile.flagged.filter("_hot"), profile.hot_keys)
        ways.append(_by_slices(hot.filter("_tag").drop("_h", "_tag"), key, ttl, profile.hot_keys, work))
        rows = hot.filter("_tag is null").drop("_h", "_tag")
    if profile.long_keys:
        # Grouping by hash and key lets the shuffle of a tagging join, where the
        # long keys are too many to broadcast, serve the window and the fold too.
        long = _tagged(rows, key, profile.flagged.filter("_long and not _hot"), profile.long_keys)
        by = ["_h", key]
        ways.append(_by_window(long.filter("_tag is null").drop("_tag"), by).drop("_h"))
        ways.append(_by_fold(long.filter("_tag").drop("_tag"), by, ttl).drop("_h"))
    else:
        ways.append(_by_window(rows, [key]))
    out = ways[0]
    for w in ways[1:]:
        out = out.unionByName(w)
    if carried is not None:
        out = out.filter(F.col(_PRIOR) == 1)
    dup = ~F.col("_taken")
    return out.select(
        *columns,
        F.when(dup, S.REJECTED_DUPLICATE).otherwise(S.ACCEPTED).alias("dedup_status"),
        F.when(dup, S.DUPLICATE_REASON).alias("rejection_reason"),
        F.when(dup, F.col("_holder")).alias("original_payment_id"),
        registry_key(F.col(key)).alias("registry_key"),
    )


def silver_records(decided: DataFrame) -> DataFrame:
    """The decision record: identity, business fields, finding, latency, times.

    Needs ``processing_latency_ms`` and ``decision_at`` on the rows. Fields the
    writer leaves empty are added as nulls by the sink.
    """
    return decided.select(
        "payment_id", "idempotency_key", F.col("idempotency_key").alias("idempotency_key_hash"),
        "customer_id", "merchant_id", "amount", "currency", "payment_method", "dedup_status",
        "rejection_reason", "original_payment_id", "processing_latency_ms", "event_timestamp",
        "decision_at",
    )
