"""SimHash near duplicates by covering locality-sensitive hashing.

Every bit position gets a vector over GF(2) of one dimension more than the radius. Each of the
non-zero vectors makes a table, whose mask keeps the positions with an odd inner product. Up
to ``radius`` differing positions never span the whole space, so some table's mask keeps none
of them: every pair within the radius meets in a bucket of some table, with certainty.

Work is on distinct fingerprints: copies are aggregated away first. Buckets are counted with
map-side combine; a bucket with one fingerprint ends there. The others are cut into blocks of
bounded size, every two of which meet in one task; a task gives a spanning forest of the links
it finds, never all pairs, so a bucket of any size costs bounded memory and few rows and loses
no link. Components follow from the forests.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from payguard.llm.common import documents, null_id, shuffled, stored, whole_id
from payguard.llm.components import components
from payguard.session import cut

# The hash seed and the upper-case letters that are lowered.
SEED = 42
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
BITS, RADIUS, SHINGLE = 64, 4, 4
BLOCK = 8_192


def shingles(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """The 64-bit hashes of the text's word shingles in order; a text of fewer words is one, none without words."""
    import xxhash

    words = (text or "").encode().translate(LOWER).split()  # splits at space and controls 9 to 13
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    n = max(1, len(words) - shingle + 1)
    starts = np.r_[0, ends[: n - 1] + 1].tolist()
    ends = ends[len(words) - n :].tolist()
    h = xxhash.xxh64_intdigest
    return np.array([h(joined[a:b], SEED) for a, b in zip(starts, ends, strict=True)], np.uint64)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of the text's word shingles as an unsigned number; 0 without words."""
    hashes = shingles(text, shingle)
    n = len(hashes)
    if not n:
        return 0
    bits = np.unpackbits(hashes.view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    ones = bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def row_key(id_col: str = "doc_id", text_col: str = "text") -> list[Column]:
    """``i, h1, h2``: the id (null is the least number) and two hashes of the text; equal for equal rows."""
    return [whole_id(id_col).alias("i"), F.xxhash64(F.lit(1), text_col).alias("h1"), F.xxhash64(F.lit(2), text_col).alias("h2")]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, keyed: bool = False) -> DataFrame:
    """``doc_id, fp`` of every row, the fingerprint as a signed long, and its ``row_key`` if ``keyed``; one pass, no shuffle."""
    more = ["h1", "h2"] if keyed else []

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            fp = np.array([fingerprint(t, shingle) for t in frame["t"]], np.uint64)
            yield pd.DataFrame({"doc_id": frame["i"], "fp": fp.view(np.int64), **{c: frame[c] for c in more}})

    rows = docs.select(*row_key(id_col, text_col)[: 1 + len(more)], F.col(text_col).alias("t"))
    out = rows.mapInPandas(run, "doc_id long, fp long" + "".join(f", {c} long" for c in more))
    return out.select(null_id("doc_id"), "fp", *([F.col("doc_id").alias("i"), *more] if keyed else []))


def masks(radius: int = RADIUS, bits: int = BITS) -> list[int]:
    """The covering masks as signed longs: 2^(radius + 1) - 1 of them, each of about half the bits."""
    size = 1 << (radius + 1)
    vectors = [1 + i % (size - 1) for i in range(bits)]
    out = [sum(1 << i for i, m in enumerate(vectors) if (v & m).bit_count() & 1) for v in range(1, size)]
    return [m - (1 << 64) if m >> 63 else m for m in out]


def forest(x: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Spanning forest of the links within ``radius`` among distinct fingerprints (unsigned)."""
    out: list[tuple[int, int]] = []
    rest = x
    while len(rest) > 1:
        ahead, rest = [rest[0]], rest[1:]
        while ahead and len(rest):
            at = ahead.pop()
            near = np.bitwise_count(rest ^ at) <= radius
            if near.any():
                found, rest = rest[near], rest[~near]
                out += ((int(at), int(f)) for f in found)
                ahead += list(found)
    return out


def links(nodes: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """Edges ``u, v`` that connect all fingerprints within the radius of each other.

    ``nodes`` has distinct ``fp``. The edges are a subset of the links with the same components.
    """
    tables = F.array(*[F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(m))) for i, m in enumerate(masks(radius))])
    keys = nodes.select("fp", F.explode(tables).alias("key"))
    # a table of its own, so that adaptive execution may split the fingerprints of a frequent key
    shared = cut(keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    # Spark sizes the keys like the fingerprints, one for each mask
    rows = keys.join(shuffled(shared), "key").withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
    rows = rows.withColumn("b", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    meets = rows.select("key", "fp", "b", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("o"))
    groups = meets.groupBy("key", F.least("b", "o").alias("i"), F.greatest("b", "o").alias("j")).agg(F.collect_list("fp").alias("fps"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out: list[tuple[int, int]] = []
            for fps in frame["fps"]:
                out += forest(np.asarray(fps, np.int64).view(np.uint64), radius)
            pairs = np.array(out, np.uint64).reshape(-1, 2).view(np.int64)
            yield pd.DataFrame({"u": pairs[:, 0], "v": pairs[:, 1]})

    return groups.where(F.size("fps") > 1).select("fps").mapInPandas(run, "u long, v long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    radius: int = RADIUS) -> DataFrame:
    """``doc_id, fp, component_id`` of every row: the smallest id reachable over links.

    Texts without words (null, empty, blank) have fingerprint zero and link like others. Rows
    with equal texts share a fingerprint and so a component; a null id is never the smallest
    unless all are null. Other columns are ignored; an empty table gives an empty result.
    """
    fps = stored(fingerprints(docs, id_col, text_col, shingle), "simhash")
    nodes, roots = _linked(fps, radius)
    linked = shuffled(nodes).join(roots, F.col("fp") == F.col("node"))
    least = linked.groupBy("root").agg(F.min("first").alias("least"))
    linked = roots.join(least, "root").select(F.col("node").alias("fp"), "least")
    named = nodes.join(linked, "fp", "left").select("fp", F.coalesce("least", "first").alias("component_id"))
    return fps.join(shuffled(named), "fp").select("doc_id", "fp", "component_id")


def _linked(fps: DataFrame, radius: int) -> tuple[DataFrame, DataFrame]:
    """Distinct fingerprints, with their least id, and the root of each one that has a link."""
    nodes = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("first")))
    return nodes, cut(components(links(nodes, radius)))


def survivors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``i, h1, h2`` (``row_key``) of the one document that stays of each component of ``near_duplicates``.

    It is the one with the smallest id, a null one last, and of one id the text with the least hashes; equal rows
    have one key. Components go by their root, not by an id, so neither null nor repeated ids join or part them.
    Other columns are ignored; an empty table gives an empty result.
    """
    fps = stored(fingerprints(docs, id_col, text_col, shingle, keyed=True), "simhash-rows")
    _, roots = _linked(fps, radius)
    # one row for each distinct fingerprint before the components meet
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "i", "h1", "h2")
    first = fps.groupBy("fp").agg(F.min(order).alias("x"))
    of = first.join(roots, F.col("fp") == F.col("node"), "left").select(F.coalesce("root", "fp").alias("root"), "x")
    return of.groupBy("root").agg(F.min("x").alias("x")).select("x.i", "x.h1", "x.h2")


def hex_digits(fp: str | Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", hex_digits("fp").alias("fingerprint"), "component_id")
