"""Clustering against plain rounds, on awkward vectors."""

from __future__ import annotations

import hashlib
import math
from collections import Counter

import numpy as np
import pytest

from payguard.llm import clustering

SCHEMA = "vec_id long, embedding array<float>, label int, v string, cells int, c int, cluster string"


def plain(rows, k=16, rounds=3):
    vectors = [(r[0], [math.floor(64 * float(np.float32(x))) for x in r[1]]) for r in rows
               if r[1] is not None and len(r[1]) == 64 and all(x is not None and math.isfinite(x) for x in r[1])]
    clamp = lambda v: [max(-(1 << 27), min(1 << 27, x)) for x in v]
    vectors = [(i, clamp(v)) for i, v in vectors]
    start = sorted((hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in vectors)
    centroids = [v for _, v in start[:k]]

    def assign():
        out = []
        for _, v in vectors:
            d = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in centroids]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        got = assign()
        for c in range(len(centroids)):
            mine = [v for (_, v), (a, _) in zip(vectors, got, strict=True) if a == c]
            if mine:
                centroids[c] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    got = assign()
    per = Counter()
    for c, d in got:
        per[c] += d
    return Counter((i, c, d, per[c], sum(per.values()), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest())
                   for (i, _), (c, d) in zip(vectors, got, strict=True))


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(5)
    middle = rng.normal(0, 0.3, (6, 64))
    rows = [(i, (middle[i % 6] + rng.normal(0, 0.08, 64)).astype(np.float32).tolist()) for i in range(300)]
    same = rows[3][1]
    rows += [(1000 + i, same) for i in range(90)] + [rows[7]] * 4 + [(None, rows[5][1]), (None, rows[6][1])]
    rows += [(2000, None), (2001, []), (2002, [0.1] * 63), (2003, [0.1] * 65), (2004, [None] + [0.1] * 63),
             (2005, [float("nan")] + [0.1] * 63), (2006, [float("-inf")] + [0.1] * 63), (2007, [9.0] * 64), (2008, [0.0] * 64), (2009, [3e37] + [0.0] * 63)]
    return [(i, v, 1, "v", 2, 3, "c") for i, v in rows]


def test_clusters_equal_plain_rounds(spark, vectors):
    got = clustering.clustered(spark.createDataFrame(vectors, SCHEMA).repartition(5)).collect()
    assert Counter(map(tuple, got)) == plain(vectors)


@pytest.mark.parametrize("n", [0, 1, 5])
def test_few_vectors(spark, vectors, n):
    got = clustering.clustered(spark.createDataFrame(vectors[:n], SCHEMA)).collect()
    assert Counter(map(tuple, got)) == plain(vectors[:n])


def test_no_vector_can_be_kept(spark):
    assert clustering.clustered(spark.createDataFrame([(1, None, 1, "v", 2, 3, "c")], SCHEMA)).collect() == []


def test_intervals_hold_and_decide(vectors):
    """Every distance lies in its interval, the nearest is always among the candidates, and most vectors need no fetch."""
    v = np.floor(np.array([r[1] for r in vectors[:300]]) * 64).astype(np.int64)
    edges = clustering.cell_edges(v[:200])
    centroids = np.stack([v[i::6].sum(0) // 50 for i in range(6)])
    tables = clustering.Tables.of(centroids, edges)
    cells = clustering.cells_of(v, edges)
    exact = np.square(v[:, None] - centroids[None]).sum(2)
    may = tables.overlapping(cells)
    assert may[np.arange(len(v)), exact.argmin(1)].all()
    low = sum(tables.low[b][cells[:, b]] for b in range(cells.shape[1]))
    high = sum(tables.high[b][cells[:, b]] for b in range(cells.shape[1]))
    assert (low <= exact).all() and (exact <= high).all()
    cluster, fetched = tables.nearest(cells, v.__getitem__)
    assert (cluster == exact.argmin(1)).all()
    assert fetched < len(v) / 2


def test_odd_number_of_components(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(0, 1, 5).tolist()) for i in range(40)]
    got = clustering.clustered(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), k=3, dimensions=5)
    assert got.count() == 40 and got.select("cluster").distinct().count() <= 3


def test_sums_of_one_round(spark, vectors):
    kept = clustering.kept(spark.createDataFrame(vectors, SCHEMA))
    first = clustering.first_vectors(kept, 64)
    assert len(first) == 64
    edges = clustering.cell_edges(first)
    counts, sums, fetched = clustering.cluster_sums(clustering.compressed(kept, edges), first[:16], edges)
    assert counts.sum() == kept.count() and 0 <= fetched <= counts.sum()
    total = [sum(x) for x in zip(*(r["v"] for r in kept.collect()), strict=True)]
    assert sums.sum(0).tolist() == total
