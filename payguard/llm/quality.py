"""Quality by weak supervision: rules vote or abstain, and what they agree on is learned.

Each rule says good (1), bad (-1) or nothing (0) about a document. Expectation maximisation
estimates how often each rule is right, on good and on bad documents, without any label, and the posterior probability that a
document is good replaces the demand that it pass every rule. Votes are column expressions;
the corpus enters the estimate as counts by vote pattern, of which there are at most 3 to the
number of rules (6,561), whatever its size. Everything is DataFrame expressions on the
executors: one pass over the texts, one aggregate with map-side combine.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from payguard.llm.common import documents, stored, text_of, words

WINDOW = 8
# Fixed values of the base check.
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30
# The estimate: rounds at most, smoothing counts, limits of an accuracy, and where it starts.
# It starts from rules that seldom object to a good document and often miss a bad one, which
# ties the two classes to their names.
ROUNDS, SMOOTH, LEAST, MOST = 50, 1.0, 0.01, 0.999
START_SHARE, START = 0.7, (0.95, 0.5)


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of every row: ``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words``
    and, for the rules, ``n_lines, n_letters, n_ends, longest``."""
    df = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("t"))
    df = df.withColumn("w", words("t"))
    lines = F.filter(F.split("t", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    last = F.size("w") - WINDOW + 1
    windows = F.when(last >= 1, F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.xxhash64(F.slice("w", i, WINDOW))))
    df = df.withColumn("lines", lines).withColumn("h", windows)
    repeats = F.size("h") > F.size(F.array_distinct("h"))
    placed = F.when(repeats, F.array_sort(F.transform("h", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    df = df.withColumn("s", placed)
    alike = lambda x, i: (F.get("s", i - 1)["h"] == x["h"]) | (F.get("s", i + 1)["h"] == x["h"])
    found = F.filter("s", lambda x, i: F.coalesce(alike(x, i), F.lit(False)))
    df = df.withColumn("at", F.array_sort(F.transform(found, lambda x: x["i"])))
    start = F.struct(F.lit(-WINDOW).alias("p"), F.lit(0).alias("n"))
    covered = F.aggregate("at", start, lambda a, p: F.struct(
        p.alias("p"), (a["n"] + F.least(F.lit(WINDOW), p - a["p"])).alias("n")), lambda a: a["n"])
    long = lambda c: c.cast("long")
    return df.select(
        "doc_id", long(F.size("w")).alias("n_words"), long(F.char_length(F.array_join("w", ""))).alias("word_chars"),
        long(F.regexp_count("t", F.lit(r"[#*$%&|<>]"))).alias("n_symbols"),
        long(F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        long(F.coalesce(covered, F.lit(0))).alias("n_repeat_words"),
        long(F.size("lines")).alias("n_lines"), long(F.regexp_count("t", F.lit(r"\p{L}"))).alias("n_letters"),
        long(F.regexp_count("t", F.lit(r"[.!?][\"')\]]*(?:[\x20\x09-\x0D]|\z)"))).alias("n_ends"),
        F.coalesce(F.array_max(F.transform("w", lambda x: F.char_length(x))), F.lit(0)).alias("longest"))


def rules() -> dict[str, Column]:
    """The rules as votes over ``measures``: good above one limit, bad below another, else none."""
    share = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))

    def vote(good: Column, bad: Column) -> Column:
        return F.when(bad, -1).when(good, 1).otherwise(0)

    mean = share("word_chars", "n_words")
    symbols, letters = share("n_symbols", "word_chars"), share("n_letters", "word_chars")
    dup, repeat, ends = share("n_dup_lines", "n_lines"), share("n_repeat_words", "n_words"), share("n_ends", "n_words")
    return {
        "length": vote(F.col("n_words") >= 50, F.col("n_words") < MIN_WORDS),
        "word_length": vote((mean >= 3) & (mean <= 10), (mean < 2) | (mean > 15)),
        "symbols": vote(symbols <= 0.01, symbols > 0.05),
        "letters": vote(letters >= 0.9, letters < 0.8),
        "lines": vote(dup <= 0.05, dup > 0.3),
        "repeats": vote(repeat <= 0.05, repeat > 0.2),
        "sentences": vote((ends >= 0.02) & (ends <= 0.3), (F.col("n_words") >= 50) & (ends < 0.002)),
        "longest_word": vote(F.col("longest") <= 40, F.col("longest") > 100),
    }


def estimate(patterns: list[tuple[tuple[int, ...], int]], rounds: int = ROUNDS) -> tuple[float, list[tuple[float, float]]]:
    """Share of good documents, and each rule's accuracies, from counts by vote pattern.

    A rule has two accuracies: how often it votes good on good documents and bad on bad ones,
    among those it votes on. A rule no better than chance gets no weight. Stops when nothing
    moves by a millionth. Without documents the start values come back.
    """
    n_rules = len(patterns[0][0]) if patterns else 0
    share, right = START_SHARE, [START] * n_rules
    for _ in range(rounds if patterns else 0):
        weight = [weights(*a) for a in right]
        base = math.log(share / (1 - share))
        all_n = good_n = 0.0
        hits, cast = [[0.0, 0.0] for _ in right], [[0.0, 0.0] for _ in right]
        for votes, n in patterns:
            logit = base + sum(w[v < 0] for w, v in zip(weight, votes, strict=True) if v)
            p = 1 / (1 + math.exp(-max(-700.0, min(700.0, logit))))
            all_n += n
            good_n += n * p
            for j, v in enumerate(votes):
                if v:
                    cast[j][0] += n * p
                    cast[j][1] += n * (1 - p)
                    hits[j][v < 0] += n * (p if v > 0 else 1 - p)
        new = [tuple(min(MOST, max(LEAST, (h + s * SMOOTH) / (c + SMOOTH))) for h, c, s in zip(*x, START, strict=True)) for x in zip(hits, cast, strict=True)]
        part = min(0.99, max(0.01, (good_n + SMOOTH) / (all_n + 2 * SMOOTH)))
        moved = max(abs(part - share), *(abs(x - y) for a, b in zip(new, right, strict=True) for x, y in zip(a, b, strict=True)))
        share, right = part, new
        if moved < 1e-6:
            break
    return share, right


def weights(on_good: float, on_bad: float) -> tuple[float, float]:
    """What a good vote and a bad vote add to the log odds of being good."""
    if on_good + on_bad <= 1:
        return 0.0, 0.0
    return math.log(on_good / (1 - on_bad)), math.log((1 - on_good) / on_bad)


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5) -> DataFrame:
    """Measures, votes' posterior and verdict of every row.

    ``base_failed`` is true under 20 words or with over 30 % of the words in repeated windows
    of 8; ``kept`` is false for those, else whether the posterior reaches ``least``. Null texts
    are empty and so fail. Equal texts get equal verdicts. Other columns are ignored; an empty
    table gives an empty result.
    """
    names = list(rules())
    voted = measures(docs, id_col, text_col).withColumns({f"vote_{k}": v for k, v in rules().items()})
    voted = stored(voted, "quality")
    columns = [f"vote_{k}" for k in names]
    counts = voted.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).collect()  # at most 3^8 rows
    good, right = estimate([(tuple(r[c] for c in columns), r["n"]) for r in counts])
    logit = F.lit(math.log(good / (1 - good)))
    for c, accuracy in zip(columns, right or [START] * len(columns), strict=True):
        up, down = weights(*accuracy)
        logit = logit + F.when(F.col(c) > 0, up).when(F.col(c) < 0, down).otherwise(0.0)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    posterior = 1 / (1 + F.exp(-logit))
    out = voted.withColumn("posterior", posterior).withColumn("base_failed", failed)
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= least))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior")
