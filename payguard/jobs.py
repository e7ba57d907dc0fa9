"""The jobs by name: bronze, dedup, gold, recon, compact.

    python -m payguard.jobs --root s3a://bucket/payments bronze --servers host:9092 --interval "30 seconds"
    python -m payguard.jobs --root ... dedup --servers host:9092 --interval "1 minute"
    python -m payguard.jobs --root ... gold merchant sla customer system
    python -m payguard.jobs --root ... recon
    python -m payguard.jobs --root ... compact --vacuum-after 86400

On a cluster, where executors need the package as well:

    spark-submit --py-files payguard.zip run_jobs.py --root ... bronze ...

with a ``run_jobs.py`` of ``from payguard.jobs import main; main()``, or the package installed.

All tables of a deployment lie below one root; reports are tables below ``recon``. Without
``--interval`` a streaming job takes what is there and ends, in batches of bounded size.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from payguard import schemas
from payguard import settings as S
from payguard.operators import compaction, tables, watermark
from payguard.operators.id_index import INDEX, IdIndex
from payguard.plans import incremental, recon
from payguard.sources import messages
from payguard.streaming import bronze as bronze_stream
from payguard.streaming import dedup as dedup_stream

PIPELINES = {
    "merchant": incremental.MERCHANT,
    "sla": incremental.SLA,
    "customer": incremental.CUSTOMER,
    "system": incremental.SYSTEM,
    "uniques": incremental.UNIQUES,
}


def source(spark: SparkSession, servers: str | None, files: str | None, most: int | None = None) -> DataFrame:
    """Messages from a topic, or from text files with one message per line.
    ``most`` bounds a batch: messages of a topic, or files."""
    if servers:
        return messages.kafka_stream(spark, servers, max_per_trigger=most or S.MAX_MESSAGES_PER_TRIGGER)
    return messages.file_stream(spark, files, "text", most or S.MAX_FILES_PER_TRIGGER)


def log(job: str):
    return lambda batch_id, counts: print(f"{job} batch {batch_id}: {counts}", flush=True)


def run_bronze(spark: SparkSession, root: str, stream: DataFrame, interval: str | None = None, publish=None) -> None:
    bronze_stream.start(
        stream, f"{root}/bronze", f"{root}/deadletter", f"{root}/offsets/bronze", interval, publish, log("bronze")
    ).awaitTermination()


def run_dedup(
    spark: SparkSession, root: str, stream: DataFrame, interval: str | None = None,
    ttl: int = S.TTL_SECONDS, record_invalid: bool = False, publish=None,
) -> None:
    dedup_stream.start(
        dedup_stream.checked_events(stream), f"{root}/silver", f"{root}/registry", f"{root}/offsets/dedup",
        ttl=ttl, interval=interval, deadletter_path=f"{root}/deadletter_silver", record_invalid=record_invalid,
        publish=publish, report=log("dedup"), index=id_index(root), counters_path=f"{root}/counters",
    ).awaitTermination()


def id_index(root: str) -> IdIndex:
    return IdIndex(f"{root}/silver_ids")


def bronze_table(spark: SparkSession, root: str) -> DataFrame:
    return tables.read_table(spark, f"{root}/bronze", schemas.BRONZE_TABLE)


def silver_table(spark: SparkSession, root: str) -> DataFrame:
    return tables.read_table(spark, f"{root}/silver", schemas.SILVER_TABLE)


def run_compact(spark: SparkSession, root: str, keep_batches: int = 1, vacuum_after: float | None = None, least: int = 2) -> dict[str, int]:
    """Compact every table that grows by files a batch; parts replaced by table.

    The last ``keep_batches`` batches of each table stay as they are, since a job may run the last one again.
    """
    index = id_index(root)
    batched = {
        f"{root}/bronze": (schemas.BRONZE_TABLE, ["ingested_date", "batch_id"]),
        f"{root}/silver": (schemas.SILVER_TABLE, ["decision_date", "batch_id"]),
        f"{root}/registry": (dedup_stream.REGISTRY_TABLE, ["accepted_date", "batch_id"]),
        index.path: (INDEX, ["bucket", "batch_id"]),
    }
    replaced = {}
    for table, (schema, by) in batched.items():
        if not tables.path_exists(spark, table):
            continue
        last = tables.read_table(spark, table, StructType([schema["batch_id"]])).agg(F.max("batch_id")).first()[0]
        if last is not None:
            replaced[table] = compaction.compact(spark, table, schema, by, upto=last - keep_batches, least=least)
    marks = f"{root}/gold/marks"
    replaced[marks] = compaction.compact(spark, marks, schemas.WATERMARKS, least=least)
    if vacuum_after is not None:
        for table in replaced:
            compaction.vacuum(spark, table, vacuum_after)
    return replaced


def run_gold(spark: SparkSession, root: str, names: list[str], mode: str = "full_bucket") -> dict[str, int]:
    """Incremental runs one after the other; Gold rows upserted by name."""
    marks = f"{root}/gold/marks"
    missing = watermark.seed(tables.read_table(spark, marks, schemas.WATERMARKS))
    if not missing.isEmpty():
        missing.coalesce(1).write.mode("append").parquet(marks)
    silver = silver_table(spark, root)
    rows = {}
    for name in names:
        bronze = bronze_table(spark, root) if name == "system" else None
        done = incremental.run(PIPELINES[name], silver, f"{root}/gold/{name}", marks, mode, bronze=bronze)
        rows[name] = done.rows if done else 0
    return rows


def reports(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The reconciliation reports over the stored layers."""
    bronze, silver = bronze_table(spark, root), silver_table(spark, root)
    customer = incremental.read_gold(spark, incremental.CUSTOMER, f"{root}/gold/customer")
    matrix = recon.confusion_matrix(bronze, silver)
    total = recon.summary(bronze, silver, customer)
    return {
        "layer counts": recon.layer_counts(bronze, silver),
        "detection accuracy": recon.detection_accuracy(bronze, silver),
        "precision and recall": recon.precision_recall(matrix),
        "latency": recon.sla_report(silver),
        "duplicate rate by merchant": recon.merchant_bands(recon.merchant_rates(silver)),
        "payments missing in a layer": recon.missing_decisions(bronze, silver).groupBy("missing_in").agg(
            F.count("*").alias("payments")
        ),
        "summary": total,
        "verdicts": recon.verdicts(total, matrix),
    }


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("--root", required=True, help="folder of all tables")
    jobs = parser.add_subparsers(dest="job", required=True)
    for name in ("bronze", "dedup"):
        p = jobs.add_parser(name)
        where = p.add_mutually_exclusive_group(required=True)
        where.add_argument("--servers", help="Kafka bootstrap servers")
        where.add_argument("--files", help="folder of text files, one message per line")
        p.add_argument("--publish", help="bootstrap servers that get decisions and dead letters as messages")
        p.add_argument("--max-per-trigger", type=int, help="messages of a topic, or files, in one batch at most")
        p.add_argument("--interval", help="trigger interval; default: take what is there and end")
        if name == "dedup":
            p.add_argument("--ttl", type=int, default=S.TTL_SECONDS)
            p.add_argument("--record-invalid", action="store_true", help="decide refused messages as invalid")
    p = jobs.add_parser("gold")
    p.add_argument("names", nargs="+", choices=sorted(PIPELINES))
    p.add_argument("--mode", choices=("full_bucket", "slice", "merge"), default="full_bucket")
    jobs.add_parser("recon")
    p = jobs.add_parser("compact")
    p.add_argument("--keep-batches", type=int, default=1, help="last batches to leave as they are")
    p.add_argument("--vacuum-after", type=float, help="also delete what was replaced so many seconds ago")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName(f"payguard-{args.job}").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    publish = messages.topic_writer(args.publish) if getattr(args, "publish", None) else None
    if args.job == "bronze":
        run_bronze(spark, args.root, source(spark, args.servers, args.files, args.max_per_trigger), args.interval, publish)
    elif args.job == "dedup":
        run_dedup(spark, args.root, source(spark, args.servers, args.files, args.max_per_trigger), args.interval,
                  args.ttl, args.record_invalid, publish)
    elif args.job == "gold":
        print(run_gold(spark, args.root, args.names, args.mode))
    elif args.job == "compact":
        print(run_compact(spark, args.root, args.keep_batches, args.vacuum_after))
    else:
        for title, report in reports(spark, args.root).items():
            path = f"{args.root}/recon/{title.replace(' ', '_')}"
            report.write.mode("overwrite").parquet(path)
            print(f"{title}: {path}")
        spark.read.parquet(f"{args.root}/recon/verdicts").show(truncate=False)  # one row


if __name__ == "__main__":
    main()
