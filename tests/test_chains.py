"""Chains of acceptances by leaps equal those of a plain walk, in few rounds."""

import random
import uuid

import pytest

from payguard import settings
from payguard.operators import chains, dedup
from payguard.session import Workspace
from rows import at, decide_by_loop, decisions, events
from test_dedup import mixed_rows


def walk(times, ttl_us):
    out, until = set(), None
    for t in sorted(times):
        if until is None or t >= until:
            out.add(t)
            until = t + ttl_us
    return out


def jobs(spark, action):
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        result = action()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return result, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def keyed_times(seed):
    r = random.Random(seed)
    ttl = 10_000_000
    keys = {
        "dense": [r.randrange(400 * ttl) for _ in range(3_000)],
        "even": [i * ttl for i in range(60)],
        "just short": [i * (ttl - 1) for i in range(60)],
        "gaps": [i * 37 * ttl + r.randrange(ttl) for i in range(10)],
        "one": [5],
        "burst": [200 * ttl + i for i in range(300)] + [0, 399 * ttl],
        "before the epoch": [r.randrange(-50 * ttl, 50 * ttl) for _ in range(200)],
    }
    return {k: sorted(set(v)) for k, v in keys.items()}, ttl


@pytest.mark.parametrize("fold_rows", [1, 7, 500, 100_000])
def test_chains_equal_a_walk(spark, fold_rows):
    keys, ttl_us = keyed_times(fold_rows)
    df = spark.createDataFrame([(k, t) for k, ts in keys.items() for t in ts], "k string, t long").repartition(6)
    with Workspace(spark, "chains") as work:
        ends = min(map(min, keys.values())), max(map(max, keys.values()))
        rows = chains.accepted(df, "k", ttl_us // 1_000_000, work, *ends, fold_rows=fold_rows).collect()
    got = {k: {r["t"] for r in rows if r["k"] == k} for k in keys}
    assert len(rows) == sum(map(len, got.values()))
    assert got == {k: walk(ts, ttl_us) for k, ts in keys.items()}


def test_neighbours_across_ranges(spark):
    """Ranges far smaller than a key: the ends of its other ranges answer."""
    keys, ttl_us = keyed_times(3)
    df = spark.createDataFrame([(k, t) for k, ts in keys.items() for t in ts], "k string, t long")
    was = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        with Workspace(spark, "neighbours") as work:
            rows = chains.neighbours(df, "k", ttl_us, work).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", was[1])
    got = {(r["k"], r["t"]): (r["before"], r["next"]) for r in rows}
    want = {}
    for k, ts in keys.items():
        for i, t in enumerate(ts):
            want[k, t] = (ts[i - 1] if i else None, next((x for x in ts if x >= t + ttl_us), None))
    assert got == want


def test_five_thousand_slices_in_thirty_jobs(spark):
    """A minute of life over three and a half days: 5,000 slices, each with its acceptance."""
    rows = [(f"p{i:05d}", "hot", at(minutes=i, seconds=i % 50)) for i in range(5_000)]
    df = events(spark, rows)
    with Workspace(spark, "many-slices") as work:
        decided, n = jobs(spark, lambda: dedup.decide(df, ttl=60, hot_rows=1, work=work))
        out = decisions(decided)
    assert out == decide_by_loop(rows, ttl=60)
    assert n <= 30


def test_rounds_grow_with_the_logarithm(spark, monkeypatch):
    """Eight times the slices take three more rounds, not eight times as many."""
    made = []
    leap = chains._leap
    monkeypatch.setattr(chains, "_leap", lambda *a: made.append(1) or leap(*a))
    counts = []
    for n in (64, 512):
        made.clear()
        df = spark.createDataFrame([("k", i * 60_000_000 + i % 7) for i in range(n)], "k string, t long")
        with Workspace(spark, "rounds") as work:
            chains.accepted(df, "k", 60, work, 0, n * 60_000_000, fold_rows=4).collect()
        counts.append(len(made))
    assert counts[1] - counts[0] == 3


@pytest.mark.parametrize("ttl", [60, 3_600, 86_400])
def test_hot_way_by_leaps_equals_a_plain_loop(spark, monkeypatch, ttl):
    monkeypatch.setattr(settings, "HOT_KEY_ROWS", 10)
    rows = mixed_rows(ttl)
    assert decisions(dedup.decide(events(spark, rows), ttl=ttl, hot_rows=5)) == decide_by_loop(rows, ttl=ttl)


def test_a_workspace_leaves_nothing(spark):
    import os

    with Workspace(spark, "gone") as work:
        kept = work.keep(spark.range(10))
        assert kept.count() == 10 and os.path.isdir(work.path)
    assert not os.path.exists(work.path)
