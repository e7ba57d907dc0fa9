"""Token counts against the library, over whole texts."""

from __future__ import annotations

import random
from collections import Counter

import pytest

from payguard.llm import counts
from payguard.llm.pieces import model_path


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=model_path())


def plain(library, rows):
    out = Counter()
    for i, t in rows:
        n = len(library.encode(t or ""))
        out[i, len((t or "").encode()), n, n > 4096] += 1
    return out


AWKWARD = [" ", "  ", "\n", " \n ", "a\n\nb", "x  \n  y", "▁", "a▁b ▁▁ c", "<s> </s> <unk> <0x0A>", "\t tab nbsp em", "日本語 のテキスト", "🙂🙂 🙂",
           "é é", "\x00 a\x00b", "\r\n x", "ab" * 3_000, "é" * 5_000, " " * 700, "word " * 5_000, "a b" * 40 + "\n" * 50]


@pytest.mark.parametrize("common", [counts.COMMON, 1, 20])
def test_counts_equal_the_library(spark, docs, rows, library, common):
    extra = [(50_000 + i, t) for i, t in enumerate(AWKWARD)] + [(50_003, AWKWARD[8])] * 3 + [(None, AWKWARD[5]), (None, None), (None, "ab" * 3_000)]
    more = spark.createDataFrame(extra, "doc_id long, text string")
    got = counts.token_counts(docs.select("doc_id", "text").unionByName(more).repartition(4), model_path(), common=common)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert Counter(map(tuple, got.collect())) == plain(library, [(r[0], r[1]) for r in rows] + extra)


def test_clashing_columns_and_empty(spark, docs, empty):
    assert counts.token_counts(docs, model_path()).count() == docs.count()
    assert counts.token_counts(empty, model_path()).collect() == []
    nulls = spark.createDataFrame([(None, None)] * 3, "doc_id long, text string")
    assert Counter(map(tuple, counts.token_counts(nulls, model_path()).collect())) == {(None, 0, 0, False): 3}


def test_random_texts(spark, library):
    rng = random.Random(8)
    alphabet = ["a", "b", "th", "e", " ", "  ", "\n", "▁", "é", "中", "1", "23", ".", "<s>", "🙂", "\t"]
    rows = [(i, "".join(rng.choice(alphabet) for _ in range(rng.randrange(60)))) for i in range(400)]
    got = counts.token_counts(spark.createDataFrame(rows, "doc_id long, text string"), model_path())
    assert Counter(map(tuple, got.collect())) == plain(library, rows)


def test_each_distinct_pre_token_once(spark, docs):
    found = counts.frequencies(docs)
    assert found.count() == found.select("token").distinct().count()
    want = Counter(t for r in docs.select("text").collect() for t in counts.split(r[0] or ""))
    assert dict(map(tuple, found.collect())) == want


def test_a_seed_that_confuses_pre_tokens_is_left(spark, docs, monkeypatch):
    plain = counts.keys_of
    monkeypatch.setattr(counts, "keys_of", lambda tokens, seed: plain(tokens, seed) % 5 if seed < 2 else plain(tokens, seed))
    with open(model_path(), "rb") as f:
        table, seed = counts.dictionary(docs, f.read())
    assert seed == 2
    assert table.count() == counts.frequencies(docs).count()


def test_many_equal_rows(spark, monkeypatch):
    monkeypatch.setattr(counts, "COPIES", 7)
    docs = spark.range(50).selectExpr("cast(1 as long) as doc_id", "'one two three' as text")
    got = counts.token_counts(docs, model_path()).groupBy("doc_id", "n_tokens").count().collect()
    assert [r["count"] for r in got] == [50]


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_query_over_the_whole_table(spark, library, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert Counter(map(tuple, counts.op12_token_counts(spark, sf).collect())) == plain(library, rows)
