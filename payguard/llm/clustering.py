"""Centroid clustering of integer vectors over a VA-file.

Every vector is compressed once to a cell of six bits per component, kept in a byte. In
a round the driver's centroids become lookup tables: for each component, cell and centroid the
least and the greatest squared distance any value in that cell can have. Summed over the
components they bound a vector's distance to every centroid; where the least upper bound lies below
all other lower bounds the cluster is known from the cells alone, and only where intervals
overlap is the full vector fetched and measured. Cell edges come from at most ``SAMPLE`` vectors
with the least hashes; they decide how much is fetched, never a result, since values beyond the
outermost edges lie in cells of their own that reach to the limit of components.

The rounds scan one stored table. A task keeps one running sum a centroid, so that a round
shuffles at most (centroids x components) sums a task, and the driver holds the centroids alone.

Rows: a vector is kept when it is not null, has the right length, and no component is null, NaN or
infinite. Repeated rows and repeated or null ids are vectors of their own; a null id hashes as the empty
text, and start vectors of one hash go by their components. With fewer vectors than
centroids there are as many centroids as vectors; no vector gives an empty result. Components beyond
+-2^27 after scaling are set to that limit, as no long could hold their squared distances; inertias
beyond a long are set to its greatest value. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from payguard.llm.common import stored

DIMENSIONS, CENTROIDS, ROUNDS, SCALE = 64, 16, 3, 64
SAMPLE = 1_024
LIMIT = 1 << 27
BITS = 6  # of a cell; with fewer, nearly every vector of the test tables had to be fetched, see the README
CELLS = 1 << BITS
BATCH = 2_048  # vectors bounded at once


def kept(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """``vec_id, v array<int>`` of the vectors that can be clustered."""
    v = F.col(vector_col)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    whole = F.transform(v, lambda x: F.floor(F.greatest(F.lit(-float(LIMIT)), F.least(F.lit(float(LIMIT)), x.cast("double") * scale))).cast("int"))
    return embeddings.where((F.size(v) == dimensions) & finite).select(F.col(id_col).cast("long").alias("vec_id"), whole.alias("v"))


def _start_hash() -> Column:
    return F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)


def first_vectors(vectors: DataFrame, n: int) -> np.ndarray:
    """At most ``n`` vectors with the least hashes, in their order. A bound on the hash, from the number of
    vectors, leaves some two ``n`` rows before anything is ordered."""
    total, share = vectors.count(), 2.0 * n
    while True:
        hashed = vectors.select(_start_hash().alias("h"), "v")
        if share < total:
            hashed = hashed.where(F.col("h") < f"{int(share / total * 2**60):015x}")
        rows = hashed.orderBy("h", "v").limit(n).collect()
        if len(rows) == n or share >= total:
            return np.array([r["v"] for r in rows], np.int64)
        share *= 4


def cell_edges(sample: np.ndarray) -> np.ndarray:
    """Edges by component, ascending and evenly spaced between the sample's slightly padded extremes."""
    low, high = sample.min(0), sample.max(0)
    pad = (high - low) // 16 + 1
    width = -(-(high - low + 2 * pad) // (CELLS - 2))
    return (low - pad)[:, None] + width[:, None] * np.arange(CELLS - 1)


def cells_of(v: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Cells of vectors, one a byte."""
    cells = np.empty(v.shape, np.uint8)
    for d in range(v.shape[1]):
        cells[:, d] = np.searchsorted(edges[d], v[:, d], side="right")
    return cells


@dataclass
class Tables:
    """Distance bounds: (component, cell, centroid)."""

    centroids: np.ndarray
    low: np.ndarray
    high: np.ndarray

    @classmethod
    def of(cls, centroids: np.ndarray, edges: np.ndarray) -> Tables:
        dims = centroids.shape[1]
        first = np.hstack([np.full((dims, 1), -LIMIT), edges])[:, :, None]
        last = np.hstack([edges - 1, np.full((dims, 1), LIMIT)])[:, :, None]
        c = centroids.T[:, None, :]
        low = np.square(np.maximum(np.maximum(first - c, c - last), 0))
        high = np.square(np.maximum(np.abs(c - first), np.abs(c - last)))
        return cls(centroids, low, high)

    def overlapping(self, cells: np.ndarray) -> np.ndarray:
        """Which centroids may be nearest, by row: those whose interval reaches the least upper bound."""
        shape = (len(cells), self.low.shape[2])
        low, high = np.zeros(shape, np.int64), np.zeros(shape, np.int64)
        for d in range(cells.shape[1]):
            low += self.low[d].take(cells[:, d], 0)
            high += self.high[d].take(cells[:, d], 0)
        return low <= high.min(1)[:, None]

    def distance(self, v: np.ndarray, cluster: np.ndarray) -> np.ndarray:
        return np.square(v - self.centroids[cluster]).sum(1)

    def nearest(self, cells: np.ndarray, fetch) -> tuple[np.ndarray, int]:
        """Cluster of each row, and how many rows ``fetch`` was asked for."""
        may = self.overlapping(cells)
        cluster = may.argmax(1)
        open_rows = np.flatnonzero(may.sum(1) > 1)
        if len(open_rows):
            v, may = fetch(open_rows), may[open_rows]
            far = np.iinfo(np.int64).max
            found = np.stack([np.where(may[:, c], np.square(v - self.centroids[c]).sum(1), far) for c in range(len(self.centroids))], 1)
            cluster[open_rows] = found.argmin(1)
        return cluster, len(open_rows)


def _vectors(column: pa.ListArray, dimensions: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)


def compressed(vectors: DataFrame, edges: np.ndarray) -> DataFrame:
    """The vectors with their cells beside them: ``vec_id, v, cells binary``."""
    dims = len(edges)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = cells_of(_vectors(batch["v"], dims), edges)
            data = pa.array([row.tobytes() for row in cells], pa.binary())
            yield pa.RecordBatch.from_arrays([batch["vec_id"], batch["v"], data], ["vec_id", "v", "cells"])

    return vectors.select("vec_id", "v").mapInArrow(run, "vec_id long, v array<int>, cells binary")


def _parts(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for whole in batches:
        for at in range(0, whole.num_rows, BATCH):
            batch = whole.slice(at, BATCH)
            flat = np.frombuffer(b"".join(batch["cells"].to_pylist()), np.uint8)
            yield batch, flat.reshape(-1, width)


def cluster_sums(table: DataFrame, centroids: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Count and component sums of each cluster, and the number of vectors fetched for comparison."""
    k, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = Tables.of(centroids, edges)
        sums, counts, fetched = np.zeros((k, dims), np.int64), np.zeros(k, np.int64), 0
        for batch, cells in _parts(batches, dims):
            v = _vectors(batch["v"], dims).astype(np.int64)
            cluster, asked = tables.nearest(cells, v.__getitem__)
            fetched += asked
            counts += np.bincount(cluster, minlength=k)
            order = np.argsort(cluster, kind="stable")
            found, first = np.unique(cluster[order], return_index=True)
            sums[found] += np.add.reduceat(v[order], first, axis=0)
        row = np.hstack([counts[:, None], np.r_[fetched, np.zeros(k - 1, np.int64)][:, None], sums])
        yield pa.RecordBatch.from_arrays([pa.array(range(k), pa.int32()), pa.array(list(row))], ["c", "s"])

    rows = table.select("v", "cells").mapInArrow(run, "c int, s array<long>").select("c", F.posexplode("s").alias("d", "s"))
    out = np.zeros((k, dims + 2), np.int64)
    for r in rows.groupBy("c", "d").agg(F.sum("s").alias("s")).collect():  # centroids x components rows
        out[r["c"], r["d"]] = r["s"]
    return out[:, 0], out[:, 2:], int(out[0, 1])


def assigned(table: DataFrame, centroids: np.ndarray, edges: np.ndarray) -> DataFrame:
    """``vec_id, cluster, distance`` of every vector."""
    dims = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = Tables.of(centroids, edges)
        for batch, cells in _parts(batches, dims):
            v = _vectors(batch["v"], dims).astype(np.int64)
            cluster, _ = tables.nearest(cells, v.__getitem__)
            yield pa.RecordBatch.from_arrays([batch["vec_id"], pa.array(cluster, pa.int32()), pa.array(tables.distance(v, cluster))], ["vec_id", "cluster", "distance"])

    return table.select("vec_id", "v", "cells").mapInArrow(run, "vec_id long, cluster int, distance long")


def lloyd(table: DataFrame, centroids: np.ndarray, edges: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Centroids after so many rounds; an empty cluster keeps its centroid."""
    for _ in range(rounds):
        counts, sums, _ = cluster_sums(table, centroids, edges)
        full = counts > 0
        centroids = centroids.copy()
        centroids[full] = sums[full] // counts[full, None]  # floor, exact
    return centroids


def clustered(embeddings: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, id_col: str = "vec_id", vector_col: str = "embedding", dimensions: int = DIMENSIONS) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of each kept vector."""
    spark = embeddings.sparkSession
    vectors = kept(embeddings, id_col, vector_col, dimensions)
    sample = first_vectors(vectors, max(SAMPLE, k))
    if not len(sample):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    edges = cell_edges(sample)
    table = stored(compressed(vectors, edges), "va-file")
    centroids = lloyd(table, sample[:k], edges, rounds)
    rows = stored(assigned(table, centroids, edges), "clusters", table)
    inertia = {r["cluster"]: int(r["s"]) for r in rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    most = 2**63 - 1
    total = min(sum(inertia.values()), most)
    facts = [(c, min(inertia.get(c, 0), most), total, hashlib.sha256(",".join(map(str, v)).encode()).hexdigest()) for c, v in enumerate(centroids.tolist())]
    by_cluster = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(by_cluster), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op11_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustered(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def _sql() -> str:
    parts = [f"""kept as materialized (
  select row_number() over () as r, vec_id, list_transform(embedding, lambda x: cast(floor({SCALE} * cast(x as double)) as bigint)) as v
  from embeddings where len(embedding) = {DIMENSIONS} and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = {DIMENSIONS}),
xs as materialized (select r, unnest(v) as x, generate_subscripts(v, 1) as d from kept),
start as (select row_number() over (order by h, v) - 1 as c, v from (select sha256('1:' || coalesce(cast(vec_id as varchar), '')) as h, v from kept) order by h, v limit {CENTROIDS}),
c0 as materialized (select c, unnest(v) as x, generate_subscripts(v, 1) as d from start)"""]
    for i in range(ROUNDS + 1):
        parts.append(f"""a{i} as materialized (select r, c, s from (
  select *, row_number() over (partition by r order by s, c) as n from (
    select r, c, cast(sum((xs.x - c{i}.x) * (xs.x - c{i}.x)) as bigint) as s from xs join c{i} using (d) group by r, c)) where n = 1)""")
        if i < ROUNDS:
            parts.append(f"""m{i} as (select c, d, cast(sum(x) as bigint) as s, count(*) as n from xs join a{i} using (r) group by c, d),
c{i + 1} as materialized (select c, d, case when n is null then x else cast((s - ((s % n) + n) % n) / n as bigint) end as x from c{i} left join m{i} using (c, d))""")
    return "with " + ",\n".join(parts) + f""",
sha as (select c, sha256(string_agg(cast(x as varchar), ',' order by d)) as centroid_sha256 from c{ROUNDS} group by c)
select vec_id, cast(c as integer) as cluster, s as distance, cast(sum(s) over (partition by c) as bigint) as cluster_inertia,
  cast(sum(s) over () as bigint) as inertia, centroid_sha256
from a{ROUNDS} join kept using (r) join sha using (c)"""


SQL = _sql()
