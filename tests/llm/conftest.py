"""Small documents with the awkward cases: nulls, empty and blank texts, ties, repeated rows,
long texts, other columns with names the operators use themselves."""

from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp long, id long, v string, `end` int, anchors string, score string"
WORDS = "the of and in to was for on that with be by is are from this have not but they ever more said some time than only new could these two may then do first any my now such like our over man me even most made after also did many before must through back years where much your way well down should because each just those people".split()


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", ",", "."]) for _ in range(n))


@pytest.fixture(scope="session")
def rows() -> list[tuple]:
    rng = random.Random(3)
    passage, line = sentence(rng, 60), sentence(rng, 12)
    texts: list[str | None] = [None, "", "   \n\t ", "a", "one two three", "a\x00b \x0b c", "日本語のテキストです。" * 30, "ab" * 400]
    for i in range(60):
        text = sentence(rng, rng.choice([5, 30, 90, 200]))
        if i % 4 == 0:
            text += " " + passage + " " + sentence(rng, 10)
        if i % 5 == 0:
            text = line + "\n" + text + "\n" + line
        texts.append(text)
    near = sentence(rng, 300).split()
    for i in range(12):
        copy = list(near)
        copy[rng.randrange(300)] = f"changed{i}"
        texts.append(" ".join(copy))
    texts += [texts[10]] * 5 + [sentence(rng, 4_000), "x " * 500, (sentence(rng, 9) + " ") * 6]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    out = [(7 * i, t, ["en", "fr", None][i % 3], [None, "a", "b", "c", ""][i % 5 if i % 2 else 1], len(t or ""), 1, 2, "v", 3, "x", "s")
           for i, t in zip(ids, texts, strict=True)]
    return [*out, out[12], out[12], (None, "no id at all", None, None, None, 1, 2, "v", 3, "x", "s")]


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
