"""Ratios, roundings and latency statistics shared by Gold and reconciliation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from payguard import settings as S


def pct(part: Column, whole: Column) -> Column:
    """``part / whole`` in percent, two decimals half away from zero, null on zero.

    Decimal throughout: a double would round ties such as 1.005 the wrong way.
    """
    exact = part.cast("decimal(20,0)") * F.lit(100) / F.nullif(whole, F.lit(0)).cast("decimal(20,0)")
    return F.round(exact, 2)


def mean2(total: Column, n: Column) -> Column:
    """Exact integer mean rounded to two decimals, null on zero rows."""
    exact = total.cast("decimal(24,0)") / F.nullif(n, F.lit(0)).cast("decimal(20,0)")
    return F.round(exact, 2)


def latency_ms(event_timestamp: str = "event_timestamp", decision_at: str = "decision_at") -> Column:
    """Whole milliseconds from event to decision, truncated toward zero, as a bigint:
    a replayed event has a latency of days or years."""
    micros = F.unix_micros(F.col(decision_at)) - F.unix_micros(F.col(event_timestamp))
    return ((micros - micros % 1000) / 1000).cast("bigint")


def status_counts() -> tuple[Column, Column, Column]:
    """Decisions, accepted and rejected as aggregate columns."""
    return (
        F.count("*").alias("n"),
        F.count_if(F.col("dedup_status") == S.ACCEPTED).alias("n_accepted"),
        F.count_if(F.col("dedup_status") == S.REJECTED_DUPLICATE).alias("n_rejected"),
    )


COUNTS = ("n", "n_accepted", "n_rejected")


def latency_counts(silver: DataFrame, keys: Sequence[Column | str]) -> DataFrame:
    """Rows counted per (group, latency): a hash aggregate with map-side combine, so a group holding a
    third of all rows leaves each task as a few counters. Counts of disjoint rows add up (``added``)."""
    named = [k if isinstance(k, Column) else F.col(k) for k in keys]
    return silver.groupBy(*named, F.col("processing_latency_ms")).agg(*status_counts())


def added(counts: DataFrame) -> DataFrame:
    """Counts of several parts as those of the whole."""
    groups = [c for c in counts.columns if c not in COUNTS]
    return counts.groupBy(*groups).agg(*[F.sum(c).alias(c) for c in COUNTS])


def latency_profile(silver: DataFrame, keys: Sequence[Column | str], sla_ms: int = S.SLA_MS) -> DataFrame:
    """Counts, sums and exact percentiles of the latency per group, skew-proof.

    Only counters, bounded by the number of distinct latencies
    rather than by rows, meet per group. There a running count finds the values
    on either side of each percentile: a sort that can spill, no map in memory.
    """
    return profile_of(latency_counts(silver, keys), sla_ms)


def profile_of(per_value: DataFrame, sla_ms: int = S.SLA_MS) -> DataFrame:
    """The profile from ``latency_counts``."""
    lat, n = F.col("processing_latency_ms"), F.col("n")
    names = [c for c in per_value.columns if c not in ("processing_latency_ms", *COUNTS)]
    # a row without a latency is a decision, but has no place among the latencies
    per_value = per_value.withColumn("_timed", F.when(lat.isNotNull(), n).otherwise(0))
    ranked = _ranked(per_value, names, lat) if names else _ranked_all(per_value, lat)
    out = ranked.groupBy(*names).agg(
        F.sum("n").alias("n"),
        F.sum("n_accepted").alias("n_accepted"),
        F.sum("n_rejected").alias("n_rejected"),
        F.sum(F.when(lat < sla_ms, n).otherwise(0)).alias("n_within"),
        F.sum(F.when(lat >= sla_ms, n).otherwise(0)).alias("n_breached"),
        F.sum("_timed").alias("_timed"),
        F.sum(lat.cast("decimal(20,0)") * n).alias("sum_ms"),
        F.min(lat).alias("min_ms"),
        F.max(lat).alias("max_ms"),
        *[_percentile(lat, percent).alias(f"p{percent}_ms") for percent in (50, 95, 99)],
    )
    return out.withColumn("avg_ms", mean2(F.col("sum_ms"), F.col("_timed"))).drop("sum_ms", "_timed")


def _ranked(per_value: DataFrame, names: Sequence[str], lat: Column) -> DataFrame:
    """Adds ``_upto``, the timed rows up to a latency within its group, and ``_all``, those of the group."""
    group = Window.partitionBy(*names)
    upto = group.orderBy(lat).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return per_value.select("*", F.sum("_timed").over(upto).alias("_upto"), F.sum("_timed").over(group).alias("_all"))


def _ranked_all(per_value: DataFrame, lat: Column) -> DataFrame:
    """The same over everything, without a window that one task would have to run.

    Latencies are dealt to ranges that widen with their size (64 to each doubling, some
    5,000 for all 64-bit numbers). What lies before a range is summed over the ranges alone;
    the running count within it is a window of its own.
    """
    part = (F.signum(lat) * F.floor(F.log2(F.abs(lat.cast("double")) + 1) * 64)).cast("int")
    dealt = per_value.withColumn("_part", F.coalesce(part, F.lit(-(2**31))))
    parts = dealt.groupBy("_part").agg(F.sum("_timed").alias("_here"))
    order = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = parts.select("_part", F.coalesce(F.sum("_here").over(order), F.lit(0)).alias("_before"), F.sum("_here").over(whole).alias("_all"))
    inside = Window.partitionBy("_part").orderBy(lat).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = dealt.withColumn("_inside", F.sum("_timed").over(inside)).join(F.broadcast(before), "_part")
    return rows.withColumn("_upto", F.col("_before") + F.col("_inside")).drop("_part", "_before", "_inside")


def _percentile(value: Column, percent: int) -> Column:
    """Interpolated percentile of integers, exact to its two decimals.

    With N rows the position is (N - 1) * percent / 100; its whole part names the
    lower neighbour and its hundredths the weight of the upper one, so integers
    do all the work.
    """
    position = (F.col("_all") - 1) * percent
    rest = position % 100
    upto = F.col("_upto") * 100
    below = F.min(F.when(upto > position - rest, value)).cast("bigint")
    above = F.min(F.when(upto > position + (100 - rest) % 100, value)).cast("bigint")
    weight = F.max(rest)
    return F.round((below * 100 + (above - below) * weight).cast("decimal(20,0)") / 100, 2)


def latency_histogram(silver: DataFrame, by: Sequence[str] = (), bins: int = S.HISTOGRAM_BINS) -> DataFrame:
    """Equal-width histogram of the latency, each group over its own range.

    The last bin is closed; a constant group gets a range half a unit to each
    side. Bins without rows are listed with zero. The rows are read once and
    counted per distinct latency; range, bins and empty bins are worked out on
    those counters. The bin of an integer latency is found by integer division,
    so no edge is lost to rounding.
    """
    by = list(by)
    lat = F.col("processing_latency_ms").cast("bigint")
    per_value = silver.filter(lat.isNotNull()).groupBy(*by, lat.alias("ms")).agg(F.count("*").alias("n"))
    ends = per_value.groupBy(*by).agg(F.min("ms").alias("lo"), F.max("ms").alias("hi"))
    if by:  # a null group is a group as well
        same = [F.col(f"v.{c}").eqNullSafe(F.col(f"e.{c}")) for c in by]
        ranged = per_value.alias("v").join(ends.alias("e"), same).select("v.*", "e.lo", "e.hi")
    else:
        ranged = per_value.select("*", ends.select("lo").scalar().alias("lo"), ends.select("hi").scalar().alias("hi"))
    lo, hi = F.col("lo"), F.col("hi")
    flat = lo == hi
    slot = F.expr(f"least({bins - 1}, (ms - lo) * {bins} div nullif(hi - lo, 0))")
    filled = (
        ranged.groupBy(*by, "lo", "hi", F.when(flat, bins // 2).otherwise(slot).cast("int").alias("bin"))
        .agg(F.sum("n").alias("n"))
        .groupBy(*by, "lo", "hi")
        .agg(F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("_filled"))
    )
    start = F.when(flat, lo - F.lit(0.5)).otherwise(lo.cast("double"))
    width = F.when(flat, F.lit(1.0 / bins)).otherwise((hi - lo).cast("double") / bins)
    every = F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")
    return filled.select(*by, "_filled", start.alias("_start"), width.alias("_width"), every).select(
        *by, "bin",
        F.round(F.col("_start") + F.col("bin") * F.col("_width"), 6).alias("bin_start"),
        F.round(F.col("_start") + (F.col("bin") + 1) * F.col("_width"), 6).alias("bin_end"),
        F.coalesce(F.try_element_at("_filled", F.col("bin")), F.lit(0)).cast("bigint").alias("n"),
    )
