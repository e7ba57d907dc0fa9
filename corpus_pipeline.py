"""A training corpus from raw documents: five stages, each an operator of ``payguard.llm``.

Every stage gets what its predecessor kept, written as Parquet and read again, and all but the
last return the columns of ``documents``. No stage can be said in SQL (a trained network, linked
fingerprints, byte spans, exact encoding), so there is no SQL counterpart; tests compare each
stage with a plain version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payguard.llm import language, mixing, pieces, simhash, suffixes
from payguard.llm.common import shuffled, stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
LEAST_SCORE = 0.5
# Documents that travel to a Python worker at once: whole texts, some of them very long, so far fewer than Spark's 10,000.
BATCH_ROWS = 1_000
ORACLE_SQL = None


def _documents(docs: DataFrame) -> DataFrame:
    """The columns of ``documents``, in batches that keep a worker's memory small."""
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return docs.select(*COLUMNS)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognisable language go: no letter, or a pooled probability below one half.

    Where nothing can be learned (no label, or every labelled document held out), only null texts
    and those without a letter go.
    """
    docs = _documents(docs)
    model = language.train(docs)
    if model is None:
        return language.lettered(docs)
    found = language.predict(docs, model)
    return found.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one document stays: the smallest id, a null one last, and of
    one id the text with the least hashes; of repeated rows one.

    Near duplicates are linked as ``op2_simhash`` links them, by fingerprints of four-word shingles that differ in
    four bits or fewer. Null, empty and blank texts are one group. Of rows equal in id and text the one with
    the least lang, source and n_chars stays, null first. An empty table gives an empty result.
    """
    docs = _documents(docs)
    stay = simhash.survivors(docs)
    key = ["i", "h1", "h2"]
    keyed = docs.select(*simhash.row_key(), *COLUMNS).join(shuffled(stay), key)
    rest = [c for c in COLUMNS if c != "text"]
    # equal rows but for these columns: one of them, the same in every run
    first = keyed.groupBy(*key).agg(F.min(F.struct("lang", "source", "n_chars")).alias("r"), F.first("doc_id").alias("doc_id"), F.first("text").alias("text"))
    return first.select(*[F.col("doc_id") if c == "doc_id" else F.col(f"r.{c}") if c in rest else F.col(c) for c in COLUMNS])


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 100 bytes that also start earlier are cut; the rest of each document stays.

    A null text stays null, an empty one empty; a document that is cut to nothing goes (see ``suffixes.cleaned``). Of
    repeated rows the first keeps its text. An empty table gives an empty result."""
    cut = suffixes.cleaned(_documents(docs))
    return cut.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.char_length("text")).otherwise(F.col("n_chars")).cast("long")).select(*COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: none to three rows each. Null and empty texts have no words and
    come as their hash says; repeated rows come or stay out together. An empty table gives an empty result."""
    docs = _documents(docs)
    rows = mixing.with_copies(docs, mixing.plan(docs)).where("copies > 0")
    return rows.select(*COLUMNS, F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select(*COLUMNS)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's ids, with begin and end, and the text they decode to; null texts are encoded like empty ones, each
    repeated row has its own. An empty table gives an empty result."""
    return pieces.encode_documents(_documents(docs), pieces.model_path())


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("mixed", mixed),
    ("encoded", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}", *last)
        last = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
