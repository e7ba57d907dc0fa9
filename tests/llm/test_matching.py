"""Anchors that vote for shifts, the bounded training sample, and parts of bounded size."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from payguard.llm import language, syncmers
from tests.llm.conftest import sentence


def plain_matching(anchors: dict, pairs: set) -> set:
    out = set()
    for a, b in pairs:
        if a not in anchors or b not in anchors:
            continue
        places = []
        for i in (a, b):
            at = defaultdict(list)
            for x in sorted(anchors[i]):
                at[x[1]].append(x[0])
            places.append(at)
        votes = defaultdict(list)
        for mark in places[0].keys() & places[1].keys():
            for x, y in zip(places[0][mark], places[1][mark]):
                votes[y - x].append(x)
        out |= {(a, b, shift, len(x), min(x), max(x)) for shift, x in votes.items()}
    return out


def test_anchors_vote_for_shifts(spark):
    rng = random.Random(8)
    base = sentence(rng, 240).split()
    moved = ["zero"] * 7 + base[:120] + ["new", "words", "here"] + base[120:]
    swapped = base[120:] + base[:120]
    texts = [(1, " ".join(base)), (2, " ".join(moved)), (3, " ".join(swapped)), (4, "x " * 300), (5, "x " * 200), (6, None), (7, ""),
             (None, " ".join(base)), (8, sentence(rng, 200)), (9, "two words")]
    docs = spark.createDataFrame([(*t, "other") for t in texts], "doc_id long, text string, mark string")
    pairs = [(1, 2), (1, 2), (1, 3), (4, 5), (6, 7), (None, 1), (1, 8), (9, 9), (1, 99)]
    got = syncmers.matching(spark.createDataFrame(pairs, "a long, b long"), docs).collect()
    anchors = {r[0]: r[1] for r in syncmers.with_anchors(docs.where("doc_id IS NOT NULL"), "text", "anchors").select("doc_id", "anchors").collect()}
    want = plain_matching(anchors, {p for p in pairs if None not in p})
    assert Counter(map(tuple, got)) == Counter(want)
    best = lambda a, b: sorted((r for r in got if (r["a"], r["b"]) == (a, b)), key=lambda r: -r["votes"])[:2]
    assert {r["shift"] for r in best(1, 2)} == {7, 10}  # the tokens before the text, and those within it
    front, back = best(1, 3)
    assert {front["shift"], back["shift"]} == {120, -120}
    empty = docs.where("false")
    assert syncmers.matching(empty.select(F.col("doc_id").alias("a"), F.col("doc_id").alias("b")), empty).count() == 0


def test_rows_of_one_id_do_not_come_to_the_driver_together(spark):
    rows = [(1, f"text number {i} of one id", "en") for i in range(3_000)] + [(1, "the same row", "fr")] * 2_000
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    assert not docs.select(language.held_out().alias("x")).first()["x"]
    found = Counter(r["lang"] for r in language.sample(docs, sample_docs=50, sample_chars=9))
    assert found == {"en": 50, "fr": 1}
    assert max(len(r["text"]) for r in language.sample(docs, sample_docs=50, sample_chars=9)) == 9


def test_parts_are_bounded(monkeypatch):
    monkeypatch.setattr(language, "PART_DOCS", 3)
    monkeypatch.setattr(language, "PART_CHARS", 10)
    texts = ["a" * n for n in (1, 2, 3, 4, 20, 1, 9, 5)]
    assert list(language._parts(texts, [0, 1, 2, 3, 4, 5, 6])) == [[0, 1, 2], [3, 4], [5, 6]]
    assert list(language._parts(texts, [])) == []
