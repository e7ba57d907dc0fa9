"""Document fingerprints from closed syncmers.

A text is a sequence of tokens; a run of five is an anchor if the least hash among its inner
runs of two stands at its first or last place. Whether a run is chosen depends on the run
alone, never on what surrounds it, so two documents that share a passage share its anchors, their
positions shifted alike (``with_anchors`` gives them, ``matching`` lets them vote). The fingerprint holds the 128 least anchor
hashes of the whole text without positions; the likeness of two fingerprints estimates the share
of anchors in common among those in either, in whatever order.

All of it is column expressions. The query needs each document's successor by descending id:
rows are cut into id ranges by quantiles, and those of an id that takes up several of them once
more by length and text; the first row of the next range is added to each as its end, and one window per range reads the successor; texts are shuffled once.
"""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from payguard.llm.common import NULL_ID, documents, text_of

# A token is a character of a script written without spaces, or up to 16 characters of a word.
UNSPACED = r"぀-ヿ㐀-鿿가-힯฀-๿"
TOKEN = rf"[{UNSPACED}]|[^\x20\x09-\x0D{UNSPACED}]{{1,16}}"
K, S = 5, 2
MARKS = 128
RANGE_ROWS, MOST_RANGES = 2_000, 65_536


def with_anchors(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds ``out``: an array of ``(at, mark)``, the token number and hash of each closed syncmer.

    A text of one to four tokens has one anchor, its whole; one without tokens has none.
    """
    n, w, h, g = (f"{out}_{x}" for x in "nwhg")
    df = df.withColumn(w, F.regexp_extract_all(text_of(text), F.lit(TOKEN), F.lit(0)))
    df = df.withColumn(h, F.transform(w, lambda x: F.xxhash64(x))).withColumn(n, F.size(w)).drop(w)
    inner = F.transform(F.sequence(F.lit(0), F.greatest(F.col(n) - S, F.lit(0))), lambda i: F.xxhash64(F.get(h, i), F.get(h, i + 1)))
    df = df.withColumn(g, inner)
    last = K - S
    edge = lambda i: F.least(F.get(g, i), F.get(g, i + last))
    within = lambda i: F.least(*[F.get(g, i + j) for j in range(1, last)])
    places = F.filter(F.sequence(F.lit(0), F.greatest(F.col(n) - K, F.lit(0))), lambda i: edge(i) <= within(i))
    mark = lambda *x: F.xxhash64(*x).bitwiseAND(F.lit(0xFFFFFFFF))
    anchors = F.transform(places, lambda i: F.struct(i.alias("at"), mark(*[F.get(h, i + j) for j in range(K)]).alias("mark")))
    whole = F.array(F.struct(F.lit(0).alias("at"), mark(F.col(h)).alias("mark")))
    none = F.filter(whole, lambda x: F.lit(False))
    return df.withColumn(out, F.when(F.col(n) == 0, none).when(F.col(n) < K, whole).otherwise(anchors)).drop(n, h, g)


def with_marks(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds ``out``: the least 128 distinct anchor hashes in order."""
    df = with_anchors(df, text, f"{out}_a")
    marks = F.slice(F.array_sort(F.array_distinct(F.transform(f"{out}_a", lambda x: x["mark"]))), 1, MARKS)
    return df.withColumn(out, marks).drop(f"{out}_a")


def matching(pairs: DataFrame, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Where two texts agree: ``a, b, shift, votes, first_at, last_at`` for the pairs ``a, b`` of ids.

    Each anchor that both have votes for its shift, the tokens by which it stands later in ``b``; a mark's occurrences
    are paired in order, the first with the first. A shared passage is a row with many votes, between the tokens
    ``first_at`` and ``last_at`` of ``a``; behind an insertion another shift begins. Work per pair grows with its texts,
    also where a mark is repeated. An id should have one text; of several the longest counts, of equally long ones the
    greatest. Repeated pairs are one; null ids, unknown ids and texts without a token match nothing.
    """
    pairs = pairs.select(F.col("a").cast("long"), F.col("b").cast("long")).distinct()
    texts = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    texts = texts.join(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "id")
    texts = texts.groupBy("id").agg(F.max(F.struct(F.char_length("text").alias("n"), "text")).alias("x")).select("id", F.col("x.text").alias("text"))
    each = with_anchors(texts, "text", "anchors").select("id", F.explode("anchors").alias("x"))
    places = each.groupBy("id", "x.mark").agg(F.sort_array(F.collect_list("x.at")).alias("at"))
    side = lambda c: pairs.join(places.select(F.col("id").alias(c), "mark", F.col("at").alias(f"{c}_at")), c)
    both = side("a").join(side("b"), ["a", "b", "mark"]).withColumn("n", F.least(F.size("a_at"), F.size("b_at")))
    at = F.explode(F.arrays_zip(F.slice("a_at", F.lit(1), F.col("n")), F.slice("b_at", F.lit(1), F.col("n")))).alias("x")
    votes = both.select("a", "b", at).select("a", "b", F.col("x.0").alias("at"), (F.col("x.1") - F.col("x.0")).alias("shift"))
    return votes.groupBy("a", "b", "shift").agg(F.count(F.lit(1)).alias("votes"), F.min("at").alias("first_at"), F.max("at").alias("last_at"))


def written(marks: str) -> Column:
    """Marks as a string, eight hex digits each; empty without anchors."""
    return F.array_join(F.transform(marks, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")), "")


def likeness(a: str, b: str) -> Column:
    """Estimated share of common anchors, 0 to 1; two empty fingerprints are alike, one and none are not."""
    least = F.slice(F.array_sort(F.array_union(a, b)), 1, MARKS)
    common = F.size(F.array_intersect(least, F.array_intersect(a, b)))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(common / F.greatest(F.size(least), F.lit(1)))


def _subkey() -> Column:
    """Orders the rows of one id like length and text, as far as the text's first four bytes tell."""
    first = F.conv(F.rpad(F.hex(F.substring(F.col("text").cast("binary"), 1, 4)), 8, "0"), 16, 10).cast("long")
    return F.char_length("text").cast("long") * (1 << 32) + first


def _parted(docs: DataFrame, bounds: list[int], accuracy: int) -> DataFrame:
    """Adds ``sub`` and ``subkey``: rows of an id that takes up several quantiles are cut once more, by length and text.

    Parts descend with their number; other ids of the range are above its repeated one and have part -1.
    Rows of one id that agree in length and first four bytes stay together.
    """
    parts: dict[int, list[int]] = {}  # ids by their number of quantiles, up to a power of two
    for i, n in Counter(bounds).items():
        if n > 1:
            parts.setdefault(1 << n.bit_length(), []).append(i)
    if not parts:
        return docs.withColumns({"sub": F.lit(-1), "subkey": F.lit(0).cast("long")})
    spark, table = docs.sparkSession, []
    for n, ids in parts.items():  # at most 16; together they collect some four times as many cuts as there are bounds
        rows = docs.join(F.broadcast(spark.createDataFrame([(i,) for i in ids], "id long")), "id")
        cuts = rows.groupBy("id").agg(F.percentile_approx(_subkey(), [i / n for i in range(1, n)], accuracy).alias("cuts"))
        table += [(r["id"], sorted(set(r["cuts"]))) for r in cuts.collect()]
    joined = docs.join(F.broadcast(spark.createDataFrame(table, "id long, cuts array<long>")), "id", "left")
    keyed = joined.withColumn("subkey", F.when(F.col("cuts").isNull(), F.lit(0).cast("long")).otherwise(_subkey()))
    above = F.size(F.filter("cuts", lambda x: x > F.col("subkey")))
    return keyed.withColumn("sub", F.when(F.col("cuts").isNull(), -1).otherwise(above)).drop("cuts")


def _ranged(docs: DataFrame) -> DataFrame:
    """Rows ``(id, text)`` with their range ``range, sub``, and each range's end: the next range's first row.

    Ranges descend with their numbers. The bounds are at most 65,535 numbers, those of parts some four times as many.
    """
    rows = docs.count()
    ranges = min(MOST_RANGES, rows // RANGE_ROWS + 1)
    if ranges == 1:
        with_range = docs.withColumns({"range": F.lit(0), "sub": F.lit(-1), "subkey": F.lit(0).cast("long")})
    else:
        quantiles, accuracy = [i / ranges for i in range(1, ranges)], max(10_000, 10 * ranges)
        found = docs.agg(F.percentile_approx("id", quantiles, accuracy)).first()[0]
        bounds = sorted(set(found))
        width = math.isqrt(len(bounds)) + 1
        many, coarse = F.lit(bounds), F.lit(bounds[::width])
        part = F.size(F.filter(coarse, lambda x: x <= F.col("id")))
        inside = F.slice(many, F.greatest(part - 1, F.lit(0)) * width + 1, width)
        below = F.when(part == 0, 0).otherwise((part - 1) * width + F.size(F.filter(inside, lambda x: x <= F.col("id"))))
        with_range = _parted(docs, sorted(found), accuracy).withColumn("range", (F.lit(len(bounds)) - below).cast("int"))
    place = ["range", "sub"]
    firsts = with_range.groupBy(*place).agg(F.max(F.struct("id", "subkey")).alias("x")).orderBy(*place).collect()  # a row a range
    if not firsts:
        return with_range.drop("subkey").withColumn("end", F.lit(0))
    spark = docs.sparkSession
    ends = [(r["range"], r["sub"], *following["x"], following["range"], following["sub"])
            for r, following in zip(firsts, firsts[1:] + firsts[:1], strict=True)]
    table = spark.createDataFrame(ends, "to int, to_sub int, id long, subkey long, range int, sub int")
    wanted = with_range.join(F.broadcast(table), ["range", "sub", "id", "subkey"])
    end_rows = wanted.groupBy("to", "to_sub", "id").agg(F.max(F.struct(F.char_length("text").alias("n"), "text")).alias("x"))
    return with_range.drop("subkey").withColumn("end", F.lit(0)).unionByName(
        end_rows.select("id", F.col("x.text").alias("text"), F.col("to").alias("range"), F.col("to_sub").alias("sub"), F.lit(1).alias("end")))


def with_successor(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text, marks, next_text, next_marks`` of every row, next by descending id.

    The last row's successor is the first; a single row is its own. Rows with one id follow
    each other longest text first; a null id counts as the least; null texts are empty.
    """
    rows = _ranged(docs.select(F.coalesce(F.col(id_col), F.lit(NULL_ID)).alias("id"), text_of(text_col).alias("text")))
    marked = with_marks(rows, "text", "marks")
    order = Window.partitionBy("range", "sub").orderBy("end", F.desc("id"), F.desc(F.char_length("text")), F.desc("text"))
    both = marked.withColumn("next", F.lead(F.struct("text", "marks")).over(order)).where("end = 0")
    return both.select(F.when(F.col("id") != NULL_ID, F.col("id")).alias("doc_id"), "text", "marks",
                       F.col("next.text").alias("next_text"), F.col("next.marks").alias("next_marks"))


def edited(df: DataFrame) -> DataFrame:
    """Adds ``n_chars`` and ``edited``: the last third of the code points gives way to as many of the next text's first."""
    df = df.withColumn("n_chars", F.char_length("text").cast("long"))
    third = F.floor(F.col("n_chars") / 3).cast("int")
    kept = F.substring(F.col("text"), F.lit(1), (F.col("n_chars") - third).cast("int"))
    return df.withColumn("edited", F.concat(kept, F.substring(F.col("next_text"), F.lit(1), third)))


def op1_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_marks(edited(with_successor(documents(spark, sf_dir))), "edited", "edited_marks")
    return rows.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        written("marks").alias("fingerprint"), written("edited_marks").alias("edited_fingerprint"),
        likeness("marks", "edited_marks").alias("near_edited"), likeness("marks", "next_marks").alias("near_next"))
