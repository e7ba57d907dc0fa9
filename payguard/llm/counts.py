"""Token counts of documents without their ids: each distinct pre-token is encoded once.

A text falls into pre-tokens that no merge of the model crosses: a word with the spaces before it,
a run of spaces before a line break, and a line break. So the number of its tokens is the sum, over its pre-tokens, of frequency
times pieces. One pass counts pre-tokens over the corpus (each task adds up before it hands on), the library
encodes every distinct one once, and only its number of pieces is kept, under a 64-bit hash. Hashes stand for pre-tokens
since the dictionary proves them to: were two pre-tokens of one hash to differ in pieces, another seed is taken.

A second pass gives each document's frequencies. Pre-tokens that make up at least one ``COMMON``-th of all occurrences
are at most ``COMMON`` pairs of numbers (24 MB), which every task holds and sums at once. The others, none of which is
frequent enough to fill a task, leave as (document, hash, frequency) and meet their pieces in a join by hash.

Rows: a null text counts like an empty one, which has no token. Equal rows have equal results and
each keeps its own row; documents are told apart by 96 bits of hashes of id and text. Null ids
stay null. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from payguard.llm.common import documents, free_shuffles, stored, text_of
from payguard.llm.pieces import SPACE, PieceModel, model_path

COMMON = 1 << 21
HELD = 100_000  # distinct pre-tokens a task adds up before it hands them on
HELD_CHARS = 32_000_000  # or so many characters of text
ROWS = 512  # documents whose frequencies travel in one batch
LIMIT = 4_096
COPIES = 65_536
SEEDS = 64


def split(text: str) -> list[str]:
    """The pre-tokens of a text, the space set before it included."""
    return _PRE_TOKEN.findall(" " + text.replace(SPACE, " ")) if text else []


_PRE_TOKEN = re.compile("\n| *[^ \n]+| +")


def keys_of(tokens: list[str], seed: int) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(t, seed) for t in tokens], np.uint64).view(np.int64)


def check_model(path: str) -> bytes:
    """The model's bytes, if no piece of it crosses the borders of pre-tokens."""
    with open(path, "rb") as f:  # a file of the driver, as a parameter
        data = f.read()
    model = PieceModel(data)
    if not model.whole_words or any("\n" in p for p in model.ids):
        raise ValueError("pieces cross words or lines")
    return data


def frequencies(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``token, n`` over all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        chars = 0

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["token", "n"])

        for batch in batches:
            for text in batch["t"]:
                held.update(split(text.as_py()))
                chars += len(text.as_py())
                if len(held) >= HELD or chars >= HELD_CHARS:
                    yield rows()
                    held.clear()
                    chars = 0
        if held:
            yield rows()

    found = docs.select(text_of(text_col).alias("t")).mapInArrow(run, "token string, n long")
    return found.groupBy("token").agg(F.sum("n").alias("n"))


def with_pieces(tokens: DataFrame, model: bytes, seed: int = 0) -> DataFrame:
    """``key, n, pieces``: each pre-token's hash and number of pieces, the latter by the library.

    A line break, which no piece holds, is set before it: what the library adds at the start of a text
    then stays apart from the pre-token.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_proto=model)
        alone = len(library.encode("\n"))
        for whole in batches:
            for at in range(0, whole.num_rows, 1_000):
                batch = whole.slice(at, 1_000)
                found = batch["token"].to_pylist()
                pieces = [len(ids) - alone for ids in library.encode(["\n" + t for t in found], num_threads=1)]
                yield pa.RecordBatch.from_arrays([pa.array(keys_of(found, seed)), batch["n"], pa.array(pieces, pa.int64())], ["key", "n", "pieces"])

    return tokens.select("token", "n").mapInArrow(run, "key long, n long, pieces long")


def dictionary(docs: DataFrame, model: bytes, text_col: str = "text", first_seed: int = 0) -> tuple[DataFrame, int]:
    """``key, n, pieces`` of all pre-tokens, one row a key, and the seed with which keys name pieces without doubt."""
    for seed in range(first_seed, first_seed + SEEDS):
        by_key = with_pieces(frequencies(docs, text_col), model, seed).groupBy("key").agg(
            F.sum("n").alias("n"), F.min("pieces").alias("pieces"), F.max("pieces").alias("most"))
        table = stored(by_key, "pre-tokens")
        if table.where("pieces <> most").isEmpty():
            return table.drop("most"), seed
    raise ValueError("no seed keeps the pre-tokens apart")


def document_frequencies(docs: DataFrame, keys: np.ndarray, pieces: np.ndarray, seed: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``h1, h2, doc, key, n``: for each document a row with ``doc`` (id, bytes, tokens of the pre-tokens in
    ``keys``) and nothing to look up, and a row for each other pre-token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                found = [Counter(split(text)) for text in batch["t"].to_pylist()]
                key = keys_of([t for f in found for t in f], seed)
                n = np.fromiter((x for f in found for x in f.values()), np.int64, len(key))
                ends = np.cumsum([0, *map(len, found)])
                place = np.searchsorted(keys, key)
                place[place == len(keys)] = 0
                known = keys[place] == key if len(keys) else np.zeros(len(key), bool)
                total = np.r_[0, np.cumsum(np.where(known, n * pieces[place] if len(keys) else 0, 0))]
                left = np.r_[0, np.cumsum(~known)]
                entries = pa.StructArray.from_arrays([pa.array(key[~known]), pa.array(n[~known])], ["key", "n"])
                lists = pa.ListArray.from_arrays(pa.array(left[ends], pa.int32()), entries)
                yield pa.RecordBatch.from_arrays([*(batch[c] for c in ("doc_id", "h1", "h2", "n_bytes")), pa.array(np.diff(total[ends])), lists], ["doc_id", "h1", "h2", "n_bytes", "known", "rest"])

    t = text_of(text_col)
    keyed = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(id_col), t).alias("h1"), F.hash(F.col(id_col), t).alias("h2"),
                        F.octet_length(t).cast("long").alias("n_bytes"), t.alias("t"))
    lists = keyed.mapInArrow(run, "doc_id long, h1 long, h2 int, n_bytes long, known long, rest array<struct<key long, n long>>")
    nothing = F.array(F.struct(F.col("h1").alias("key"), F.lit(0).cast("long").alias("n")))
    rows = lists.select("h1", "h2", F.struct("doc_id", "n_bytes", "known").alias("d"), F.posexplode(F.concat(nothing, "rest")).alias("at", "e"))
    return rows.select("h1", "h2", F.when(F.col("at") == 0, F.col("d")).alias("doc"), "e.key", "e.n")


def _repeated(times: Column) -> Column:
    """An array as long as the number of blocks of copies, each the block's size."""
    return F.transform(F.sequence(F.lit(0), ((times - 1) / COPIES).cast("long")), lambda b: F.least(F.lit(COPIES), times - b * COPIES))


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT, common: int = COMMON) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row."""
    pieces, seed = dictionary(docs, check_model(path), text_col)
    free_shuffles(docs.sparkSession)  # those of the dictionary, before the documents' own
    total = pieces.agg(F.sum("n")).first()[0] or 0
    # at most ``common`` keys can reach this share of all occurrences
    often = F.col("n") * common >= F.lit(total)
    known = pieces.where(often).select("key", F.col("pieces").cast("int")).toArrow().sort_by("key")
    rows = document_frequencies(docs, known["key"].to_numpy(), known["pieces"].to_numpy(), seed, id_col, text_col)
    met = rows.join(pieces.where(~often).select("key", "pieces"), "key", "left")
    tokens = F.coalesce("doc.known", F.lit(0)) + F.coalesce(F.col("n") * F.col("pieces"), F.lit(0))
    summed = met.groupBy("h1", "h2").agg(
        F.max("doc.doc_id").alias("doc_id"), F.max("doc.n_bytes").alias("n_bytes"), F.sum(tokens).alias("tokens"), F.count("doc").alias("rows"))
    # equal rows were added up: their number divides the sum
    each = summed.select("doc_id", "n_bytes", F.expr("tokens div rows").alias("n_tokens"), F.explode(_repeated(F.col("rows"))).alias("block"))
    out = each.select("doc_id", "n_bytes", "n_tokens", F.explode(F.sequence(F.lit(1), F.col("block"))).alias("copy"))
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir), model_path())
