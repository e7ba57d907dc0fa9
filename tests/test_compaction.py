"""Compaction: the same rows in fewer files, whatever reads or fails in between."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from payguard import jobs, schemas
from payguard.operators import compaction, manifest, tables, watermark
from payguard.schemas import struct_of

TABLE = struct_of("k string, v integer, day date, batch_id long")
BY = ["day", "batch_id"]


def write_batches(spark, path, batches, first=0):
    for b in range(first, first + batches):
        rows = [(f"b{b}-{i}", i, f"2024-01-0{1 + i % 3}" if i % 7 else None) for i in range(30)]
        df = spark.createDataFrame(rows, "k string, v int, day string").withColumn("day", F.col("day").cast("date"))
        tables.replace_partitions(df.withColumn("batch_id", F.lit(b).cast("long")), path, BY)


def rows_of(spark, path):
    return sorted(tuple(r) for r in tables.read_table(spark, path, TABLE).select("k", "v", F.col("day").cast("string")).na.fill("none").collect())


def files(path):
    return sum(f.endswith(".parquet") for _, _, names in os.walk(path) for f in names)


def test_rows_stay_and_files_go(spark):
    path = tempfile.mkdtemp() + "/t"
    write_batches(spark, path, 5)
    before, many = rows_of(spark, path), files(path)
    reader = tables.read_table(spark, path, TABLE)
    assert compaction.compact(spark, path, TABLE, BY, upto=3) == 16
    # a reader that has begun still finds its files
    assert reader.count() == len(before)
    assert rows_of(spark, path) == before
    now = tables.read_table(spark, path, TABLE)
    assert len(now.inputFiles()) < many
    assert {r[0] for r in now.select("batch_id").distinct().collect()} == {3, 4}
    # pruning still works on what was rewritten
    assert now.where("day = date'2024-01-02'").count() == sum(r[2] == "2024-01-02" for r in before)
    assert compaction.vacuum(spark, path, 0) == 16
    assert rows_of(spark, path) == before and files(path) < many


def test_a_crash_before_the_commit_changes_nothing(spark, monkeypatch):
    path = tempfile.mkdtemp() + "/t"
    write_batches(spark, path, 4)
    before = rows_of(spark, path)

    def crash(*a):
        raise RuntimeError("crash")

    with monkeypatch.context() as m:
        m.setattr(compaction.M, "commit", crash)
        with pytest.raises(RuntimeError):
            compaction.compact(spark, path, TABLE, BY, upto=2)
    assert rows_of(spark, path) == before
    assert compaction.compact(spark, path, TABLE, BY, upto=2) > 0
    assert rows_of(spark, path) == before
    # the leftover of the crash goes with what was replaced
    assert compaction.vacuum(spark, path, 0) == 12 + 1
    assert rows_of(spark, path) == before
    assert len(os.listdir(f"{path}/_compacted")) == 1


def test_writers_go_on(spark):
    """Batches before, between and after compactions; the size of the folder does not grow with their number."""
    path = tempfile.mkdtemp() + "/t"
    counts = []
    for i in range(4):
        write_batches(spark, path, 4, 4 * i)
        assert compaction.compact(spark, path, TABLE, BY, upto=4 * i + 2) > 0
        compaction.vacuum(spark, path, 0)
        counts.append(files(path))
        assert len(rows_of(spark, path)) == 30 * 4 * (i + 1)
    assert max(counts[1:]) <= counts[0] * 2 and counts[3] <= counts[1] + 1
    # the last batch may be run again
    write_batches(spark, path, 1, 15)
    assert len(rows_of(spark, path)) == 30 * 16


def test_vacuum_waits(spark):
    path = tempfile.mkdtemp() + "/t"
    write_batches(spark, path, 3)
    compaction.compact(spark, path, TABLE, BY)
    many = files(path)
    assert compaction.vacuum(spark, path, 3_600) == 0 and files(path) == many


def test_nothing_to_do(spark):
    path = tempfile.mkdtemp() + "/t"
    assert compaction.compact(spark, path, TABLE, BY) == 0 and compaction.vacuum(spark, path) == 0
    write_batches(spark, path, 1)
    assert compaction.compact(spark, path, TABLE, BY) == 0
    assert manifest.newest(spark, path) is None


def test_a_second_compaction_of_the_same_version_fails(spark):
    path = tempfile.mkdtemp() + "/t"
    write_batches(spark, path, 2)
    compaction.compact(spark, path, TABLE, BY)
    with pytest.raises(RuntimeError, match="another compaction"):
        manifest.commit(spark, path, manifest.Manifest(True, 1))


def test_mark_log(spark):
    path = tempfile.mkdtemp() + "/marks"
    for i in range(4):
        watermark.entry(spark, "p", 1_000_000 * i, i).write.mode("append").parquet(path)
    before = sorted(map(str, tables.read_table(spark, path, schemas.WATERMARKS).collect()))
    assert compaction.compact(spark, path, schemas.WATERMARKS) >= 4
    watermark.entry(spark, "p", 9_000_000, 9).write.mode("append").parquet(path)
    compaction.vacuum(spark, path, 0)
    log = tables.read_table(spark, path, schemas.WATERMARKS)
    assert set(before) < set(map(str, log.collect())) and log.count() == 5


def test_jobs_go_on_over_compacted_tables(spark):
    from payguard.sources import messages
    from test_tables import GOOD

    root = tempfile.mkdtemp()
    os.makedirs(f"{root}/in")

    def batch(i, ids):
        with open(f"{root}/in/{i}.txt", "w") as f:
            f.write("\n".join(GOOD % x for x in ids) + "\n")
        for run in (jobs.run_bronze, jobs.run_dedup):
            run(spark, root, messages.file_stream(spark, f"{root}/in", "text"))

    for i, ids in enumerate([["a", "b"], ["c", "a"], ["d"]]):
        batch(i, ids)
    done = jobs.run_compact(spark, root, vacuum_after=0)
    assert done[f"{root}/silver"] == 2 and done[f"{root}/bronze"] == 2
    batch(3, ["b", "e"])
    assert sorted(r["payment_id"] for r in jobs.silver_table(spark, root).collect()) == ["a", "b", "c", "d", "e"]
    assert jobs.bronze_table(spark, root).count() == 7
    assert jobs.run_gold(spark, root, ["merchant", "system"])["merchant"] == 1
    total = jobs.reports(spark, root)["summary"].first()
    assert (total["bronze_total"], total["silver_total"]) == (7, 5)
