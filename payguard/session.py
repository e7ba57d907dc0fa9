"""Session helpers: settings the jobs rely on and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_LOCAL_FALLBACK: dict[str, str] = {}


def local_session(cores: int | str = "*", partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and the benchmark; a cluster brings its own."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("payguard")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    )
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local master may fall back to a temporary folder: there the driver
    and the executors are one process.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context_dir = spark.sparkContext.getCheckpointDir()
    if context_dir:
        return context_dir.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_FALLBACK:
        _LOCAL_FALLBACK[app] = tempfile.mkdtemp(prefix="payguard-")
    return _LOCAL_FALLBACK[app]


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Give the context a reliable checkpoint folder unless it has one already."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(os.path.join(shared_dir(spark), "checkpoints"))


def run_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder for one run's tables and checkpoints."""
    return f"{shared_dir(spark)}/payguard/{label}-{uuid.uuid4().hex}"


def delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


class Workspace:
    """Working tables of one run below the shared folder, deleted together.

    A table kept here cuts the lineage and survives lost executors. Whoever uses the last
    result closes the workspace, as the streaming jobs do after each batch; as a context manager it closes itself.
    """

    def __init__(self, spark: SparkSession, label: str) -> None:
        self.spark, self.path, self.tables = spark, run_dir(spark, label), 0

    def keep(self, df):
        """The frame written and read again."""
        self.tables += 1
        path = f"{self.path}/{self.tables:03d}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def close(self) -> None:
        if self.tables:
            delete(self.spark, self.path)
            self.tables = 0

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *exc) -> None:
        self.close()


def cut(df):
    """Reliable checkpoint: cuts the lineage and survives lost executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
