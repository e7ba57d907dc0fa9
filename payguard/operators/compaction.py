"""Small files of a table into large ones while readers and writers go on.

Streaming batches leave a folder of small files each, by date and batch. ``compact`` rewrites, date by date, the
batches up to a bound into one part and commits a manifest (see ``manifest``): until then nothing has
changed for any reader, and from then on ``tables.read_table`` reads the new part. A crash before the commit leaves a folder
no manifest names. ``vacuum`` deletes what was replaced, and such leftovers, after a grace that the longest
reader needs.

The bound must lie below the last batch, which a job may run again: rows of the batches up to it are never
written again. Rows of merged batches carry the highest of their numbers. One compaction of a table runs at a time; a second
one fails at its commit. Tables that the stateful job writes have a log of Spark's own and are left alone.
"""

from __future__ import annotations

import time
from collections import defaultdict
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from payguard.operators import manifest as M
from payguard.operators import tables
from payguard.session import delete


def _values(part: str) -> dict[str, str]:
    return dict(x.split("=", 1) for x in part.split("/") if "=" in x)


def compact(spark: SparkSession, table: str, schema: T.StructType, by: Sequence[str] = (), upto: int | None = None, least: int = 2) -> int:
    """Rewrite parts into one for each value of ``by[0]`` that has at least ``least`` of them; how many were replaced.

    ``by``: the table's partition columns, the batch last; ``upto``: the last batch to touch. A table without
    partitions is rewritten as a whole.
    """
    if not tables.path_exists(spark, table):
        return 0
    known = M.newest(spark, table) or M.Manifest(bool(by))
    live = known.live(M.parts(spark, table, schema, bool(by)))
    groups: dict[str, list[str]] = defaultdict(list)
    for part in live:
        values = _values(part)
        if by and upto is not None and int(values[by[-1]]) > upto:
            continue
        groups[values[by[0]] if by else ""].append(part)
    merged = sorted(p for group in groups.values() if len(group) >= least for p in group)
    if not merged:
        return 0
    version = known.version + 1
    folder = f"{M.REWRITTEN}/_rewrite=c{version}_{time.time_ns()}"
    rows = M.read_parts(spark, table, schema, merged)
    if by:
        last = max(int(_values(p)[by[-1]]) for p in merged)
        rows = rows.withColumn(by[-1], F.lit(last).cast(schema[by[-1]].dataType))
        rows.hint("rebalance", by[0]).write.partitionBy(*by).parquet(f"{table}/{folder}")
        added = M.parts(spark, f"{table}/{folder}", schema, True)
    else:
        rows.hint("rebalance").write.parquet(f"{table}/{folder}")
        added = {""}
    added = {f"{folder}/{p}".rstrip("/") for p in added}
    M.commit(spark, table, M.Manifest(known.partitioned, version, known.replaced | set(merged), known.added | added))
    return len(merged)


def vacuum(spark: SparkSession, table: str, older_than: float = 86_400) -> int:
    """Delete replaced parts and leftovers of crashed runs older than so many seconds; how many.

    What is gone is dropped from the next manifest.
    """
    known = M.newest(spark, table)
    fs, where = M._fs(spark, table)
    if not fs.exists(where):
        return 0
    before = (time.time() - older_than) * 1000
    gone, leftovers = set(), 0

    def old(path: str) -> bool:
        where = M._fs(spark, path)[1]
        return fs.exists(where) and fs.getFileStatus(where).getModificationTime() <= before

    committed = M._fs(spark, f"{table}/{M.FOLDER}/{known.version:010d}.json")[1] if known else None
    if known and fs.getFileStatus(committed).getModificationTime() <= before:
        for part in known.replaced:
            if fs.exists(M._fs(spark, f"{table}/{part}")[1]):
                delete(spark, f"{table}/{part}")
            gone.add(part)
    rewritten = M._fs(spark, f"{table}/{M.REWRITTEN}")[1]
    if fs.exists(rewritten):
        for status in fs.listStatus(rewritten):
            name = f"{M.REWRITTEN}/{status.getPath().getName()}"
            named = any(p == name or p.startswith(name + "/") for p in (known.added if known else ()))
            if not named and old(f"{table}/{name}"):
                delete(spark, f"{table}/{name}")
                leftovers += 1
    if gone:
        M.commit(spark, table, M.Manifest(known.partitioned, known.version + 1, known.replaced - gone, known.added - gone))
    return len(gone) + leftovers
