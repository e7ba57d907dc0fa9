"""Source audit against a plain version, and its pointer sort against Python's."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from payguard.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(UPPER))


def plain(rows, least=30, ranks=50):
    n, df = defaultdict(Counter), defaultdict(Counter)
    groups = defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        n[lang, source].update(terms(text))
        df[lang].update(set(terms(text)))
    out = set()
    for lang, sources in groups.items():
        kept = [t for t, d in df[lang].items() if d >= least]
        v = len(kept)
        share = lambda c, total: 1 + 10**9 * (c + 5) // (total + 5 * v)
        size = {s: sum(n[lang, s][t] for t in kept) for s in sources}
        p = {s: {t: share(n[lang, s][t], size[s]) for t in kept} for s in sources}
        q = {t: share(sum(n[lang, s][t] for s in sources), sum(size.values())) for t in kept}
        for s in sources:
            pair = sorted(((-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in sources if o != s))
            out |= {(lang, s, "pair", o, -f, i + 1) for i, (f, _, o) in enumerate(pair)}
            term = sorted((-(p[s][t] - q[t]), t.encode(), t) for t in kept if n[lang, s][t] and p[s][t] > q[t])[:ranks]
            out |= {(lang, s, "term", t, -f, i + 1) for i, (f, _, t) in enumerate(term)}
    return out


def got(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def corpus(seed, n):
    rng = random.Random(seed)
    words = ["the", "The", "of", "Über", "straße", "a", "ab", "abc", "internationalisation", "internationalist", "日本", "x" * 40, "é", "É", "zz"]
    rows = []
    for i in range(n):
        text = rng.choice([" ", ", ", "1", "-"]).join(rng.choice(words[: rng.randrange(1, 16)]) for _ in range(rng.randrange(0, 40)))
        rows.append((rng.choice([text, text, text, "", None]) if i % 9 == 0 else text, rng.choice(["en", "de", None, ""]), rng.choice(["a", "b", "c", None, "ä", "Z"])))
    return rows + [("only one here", "xx", "lonely"), (None, "yy", "m"), (None, "yy", "n")] + [rows[0]] * 40


@pytest.mark.parametrize("shard_bytes, small", [(divergence.SHARD_BYTES, divergence.SMALL), (300, 3)])
def test_equals_plain(spark, monkeypatch, shard_bytes, small):
    monkeypatch.setattr(divergence, "SHARD_BYTES", shard_bytes)
    monkeypatch.setattr(divergence, "SMALL", small)
    rows = corpus(2, 500)
    df = spark.createDataFrame([(*r, 1, "t", 3) for r in rows], "text string, lang string, source string, n int, term string, docs int").repartition(3)
    assert got(divergence.audit(df)) == plain(rows)


@pytest.mark.parametrize("cells, shard_rows", [(7, 5), (2_000_000, 40)])
def test_equals_plain_in_small_parts(spark, monkeypatch, cells, shard_rows):
    monkeypatch.setattr(divergence, "CELLS", cells)
    monkeypatch.setattr(divergence, "SHARD_ROWS", shard_rows)
    rows = corpus(3, 400)
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    assert got(divergence.audit(df, least_docs=3, term_ranks=4)) == plain(rows, 3, 4)


def test_empty_and_null_tables(spark):
    schema = "text string, lang string, source string"
    assert got(divergence.audit(spark.createDataFrame([], schema))) == set()
    rows = [(None, None, None), (None, None, "a"), (None, "en", None)]
    assert got(divergence.audit(spark.createDataFrame(rows, schema))) == plain(rows)


def test_awkward_documents(docs, rows):
    assert got(divergence.audit(docs, least_docs=2)) == plain([(r[1], r[2], r[3]) for r in rows], 2)


@pytest.mark.parametrize("small", [1, 4, 1_024])
def test_pointer_sort(monkeypatch, small):
    monkeypatch.setattr(divergence, "SMALL", small)
    rng = random.Random(small)
    texts = ["".join(rng.choice("aAbBcé日 .\n1") for _ in range(rng.randrange(80))) for _ in range(200)]
    texts += ["abcdefgh", "abcdefghabcdefgh", "abcdefg", "abcdefghi", "", "a" * 300, "a" * 301, "b" * 300 + " " + "b" * 300, "end", "start"]
    data = [t.encode() for t in texts]
    buffer, ends = np.frombuffer(b"".join(data), np.uint8), np.cumsum([len(x) for x in data])
    pointers = divergence.Pointers(buffer, ends)
    order, runs = pointers.sort()
    whole = pointers.data.tobytes()
    found = [whole[s : s + k] for s, k in zip(pointers.start[order], pointers.length[order], strict=True)]
    want = sorted((t.encode(), i) for i, t in enumerate(w for text in texts for w in terms(text)))
    assert found == [t for t, _ in want]
    assert order.tolist() == [i for _, i in want]
    assert runs.tolist() == [i for i in range(len(found)) if not i or found[i] != found[i - 1]]


def test_shares_of_great_counts(spark):
    cases = [(0, 1, 1), (7, 10**12, 3), (10**12, 10**12, 10**6), (10**14 + 1, 3 * 10**14, 10**7), (0, 10**15, 5)]
    df = spark.createDataFrame(cases, "n long, a long, v long")
    from pyspark.sql import functions as F

    out = [r[0] for r in df.select(divergence.share(F.col("n"), F.col("a"), F.col("v"))).collect()]
    assert out == [1 + 10**9 * (n + 5) // (a + 5 * v) for n, a, v in cases]
