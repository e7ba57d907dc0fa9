"""Which parts of a table are live, where some were rewritten.

A table that was compacted has numbered manifests. The newest names the parts (partition folders,
or files of a table without partitions) that were replaced, and the folders that hold their rows now. Parts it does not
name, such as those of later batches, are live as they are. A reader that has begun keeps the parts it
listed; they stay on disk until they are vacuumed.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

FOLDER, REWRITTEN = "_manifest", "_compacted"


@dataclass
class Manifest:
    partitioned: bool
    version: int = 0
    replaced: set[str] = field(default_factory=set)
    added: set[str] = field(default_factory=set)

    def live(self, plain: set[str]) -> list[str]:
        return sorted((plain | self.added) - self.replaced)


def _fs(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def newest(spark: SparkSession, table: str) -> Manifest | None:
    """The newest committed manifest; None for a table that was never compacted."""
    fs, folder = _fs(spark, f"{table}/{FOLDER}")
    if not fs.exists(folder):
        return None
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    versions = [int(n.split(".")[0]) for n in names if n.endswith(".json") and n.split(".")[0].isdigit()]
    if not versions:
        return None
    text = spark.read.option("wholetext", True).text(f"{table}/{FOLDER}/{max(versions):010d}.json").first()[0]
    known = json.loads(text)
    return Manifest(known["partitioned"], max(versions), set(known["replaced"]), set(known["added"]))


def commit(spark: SparkSession, table: str, manifest: Manifest) -> None:
    """The manifest appears under its final name at once: it is written beside it, then renamed."""
    fs, final = _fs(spark, f"{table}/{FOLDER}/{manifest.version:010d}.json")
    beside = spark._jvm.org.apache.hadoop.fs.Path(f"{table}/{FOLDER}/.{manifest.version:010d}.tmp")
    out = fs.create(beside, True)
    text = {"partitioned": manifest.partitioned, "replaced": sorted(manifest.replaced), "added": sorted(manifest.added)}
    out.write(bytearray(json.dumps(text).encode()))
    out.close()
    if fs.exists(final) or not fs.rename(beside, final):
        raise RuntimeError(f"another compaction of {table} has committed version {manifest.version}")


def parts(spark: SparkSession, table: str, schema, partitioned: bool) -> set[str]:
    """Parts as the table's own folders hold them: paths below the table."""
    fs, where = _fs(spark, table)
    root = fs.makeQualified(where).toUri().getPath().rstrip("/") + "/"
    files = [f.split(root, 1)[1] for f in spark.read.schema(schema).parquet(table).inputFiles()]
    return {f.rsplit("/", 1)[0] if partitioned else f for f in files}


def read(spark: SparkSession, table: str, schema, known: Manifest) -> DataFrame:
    return read_parts(spark, table, schema, known.live(parts(spark, table, schema, known.partitioned)))


def read_parts(spark: SparkSession, table: str, schema, live: list[str]) -> DataFrame:
    """The rows of the parts given, with the partition columns of their folders."""
    out = None
    for base, some in ((f"{table}/{REWRITTEN}", [p for p in live if p.startswith(REWRITTEN)]), (table, [p for p in live if not p.startswith(REWRITTEN)])):
        if some:
            df = spark.read.schema(schema).option("basePath", base).parquet(*[f"{table}/{p}" for p in some])
            df = df.select(*schema.fieldNames())
            out = df if out is None else out.unionByName(df)
    return spark.createDataFrame([], schema) if out is None else out
