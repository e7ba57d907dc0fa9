"""Substring dedup by level-wise doubling.

Windows that are repeated at one length alone are extended to twice that length. The first
level takes runs of 8 words, and of these only the anchors (see ``anchors``), one in every
window of 35; the runs that occur once end there. Around the others the documents' blocks are
cut out, equal blocks are aggregated to one row with its count (all their windows are repeated),
and the rest climb: runs of 16, then 32, then 35 words are counted by hash, and at each level
only windows whose run is repeated go on, until the full length is reached or none is left.
Every count is an aggregate with map-side combine over hashes, so a passage that a third of all
documents hold is a few rows a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payguard.llm.anchors import Units, by_document, distinct_blocks, keyed, repeated_blocks, with_contents
from payguard.llm.common import NULL_ID, documents, merge_spans, stored

WINDOW, SEED = 35, 8


class Words(Units):
    def split(self, text: str) -> list[bytes]:
        return text.encode().split()  # at space and the controls 9 to 13

    def numbers(self, parts: list[bytes]) -> np.ndarray:
        import xxhash

        return np.fromiter(map(xxhash.xxh64_intdigest, parts), np.uint64, len(parts))

    def stretch(self, parts: list[bytes], a: int, b: int) -> bytes:
        return b" ".join(parts[a:b])


def levels(window: int, seed: int) -> list[int]:
    out = [2 * seed]
    while 2 * out[-1] < window:
        out.append(2 * out[-1])
    return [n for n in out if n < window] + [window]


def repeated_windows(rows: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """``id, v, spans``: the word spans ``a, b`` of each document that are covered by repeated windows;
    their union is what to remove."""
    units = Words()
    blocks = repeated_blocks(rows, units, seed, window, "words")
    alike = distinct_blocks(blocks, "words-distinct")
    whole = blocks.join(alike.where("n > 1").select("anchor", "h"), ["anchor", "h"]).select(
        "id", "v", F.col("start").alias("a"), (F.col("start") + F.col("size")).alias("b"))
    # blocks that share an anchor but are not equal climb the levels, each standing for its copies
    several = stored(alike.groupBy("anchor").agg(F.count(F.lit(1)).alias("m"), F.min("n").alias("fewest")).where("m > 1 AND fewest = 1").select("anchor"), "words-several")
    live = stored(with_contents(rows, alike.join(several, "anchor"), units, seed, window), "words-0", several)
    last = live
    live = live.select("n", "id", "v", "start", "at", F.col("block").cast("string").alias("block"),
                       F.lit(0).alias("o1"), (F.col("size") - window).alias("o2"))
    for length in levels(window, seed):
        live = last = _climb(live, length, window, seed, last)
    single = live.where("n = 1").select("id", "v", (F.col("start") + F.col("o1")).alias("a"), (F.col("start") + F.col("o2") + window).alias("b"))
    return stored(by_document(whole.unionByName(single)), "words-spans", blocks, alike, last)


def _climb(live: DataFrame, length: int, window: int, seed: int, last: DataFrame) -> DataFrame:
    """The live windows whose run of ``length`` words around the anchor is repeated; the table ``last`` is deleted.

    A window with its anchor at place q takes the run that starts ``back`` words before the
    anchor, which depends on q alone, so equal windows take equal runs.
    """
    slack = window - length
    runs: dict[int, list[int]] = {}
    for q in range(window - seed + 1):
        runs.setdefault(min((slack + 1) * (q // (slack + 1)), length - seed), []).append(q)
    # windows o1..o2 of a block have their anchor at places at - o2 .. at - o1
    parts = F.array(*[F.struct(
        F.lit(back).alias("back"),
        F.greatest(F.col("o1"), F.col("at") - max(q)).alias("o1"),
        F.least(F.col("o2"), F.col("at") - min(q)).alias("o2")) for back, q in runs.items()])
    rows = live.withColumn("words", F.split("block", " ")).withColumn("p", F.explode(F.filter(parts, lambda p: p["o1"] <= p["o2"])))
    run = F.array_join(F.slice("words", F.col("at") - F.col("p.back") + 1, length), " ")
    above = ["at", "block"] if length < window else []  # what a further level needs
    rows = rows.select("n", "id", "v", "start", *above, "p.o1", "p.o2", F.struct(F.col("p.back"), F.md5(run.cast("binary"))).alias("k"))
    # a table of its own, so that adaptive execution may split the windows of a frequent run
    often = stored(rows.groupBy("k").agg(F.sum("n").alias("total")).where("total > 1").select("k"), f"words-{length}-often")
    return stored(rows.join(often, "k").drop("k"), f"words-{length}", last, often)


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """``doc_id, n_words, n_removed, kept``: each row's words outside repeated windows, one space apart.

    A window is repeated if its words also start anywhere else; every occurrence goes, judged on
    the input. Null and empty texts have no words. Repeated rows are documents of their own, so
    each repeats the other. Other columns are ignored; an empty table gives an empty result.
    """
    rows = keyed(docs, id_col, text_col)
    found = repeated_windows(rows, window, seed)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for i, text, spans in frame[["id", "text", "spans"]].itertuples(index=False):
                words = text.encode().split()
                keep = np.ones(len(words), bool)
                if spans is not None:
                    a, b = np.array([(s["a"], s["b"]) for s in spans]).T
                    for x, y in zip(*merge_spans(a, b), strict=True):
                        keep[x:y] = False
                kept = b" ".join(w for w, k in zip(words, keep, strict=True) if k)
                out.append((None if i == NULL_ID else i, len(words), int((~keep).sum()), kept.decode()))
            yield pd.DataFrame(out, columns=["doc_id", "n_words", "n_removed", "kept"]).astype({"doc_id": "Int64"})

    return rows.join(found, ["id", "v"], "left").mapInPandas(run, "doc_id long, n_words long, n_removed long, kept string")


def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicate(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


SQL = """
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
t AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS j FROM d),
h AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)),
r AS (SELECT doc_id, i FROM h WHERE h IN (SELECT h FROM h GROUP BY h HAVING count(*) > 1)),
c AS (SELECT DISTINCT doc_id, i + k AS j FROM (SELECT doc_id, i, unnest(range(0, 35)) AS k FROM r)),
k AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY j) AS kept
  FROM t ANTI JOIN c USING (doc_id, j) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""
