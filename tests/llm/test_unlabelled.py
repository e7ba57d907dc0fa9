"""The language stage of the corpus pipeline where nothing can be learned."""

from __future__ import annotations

import zlib

import pytest

import corpus_pipeline

TEXTS = [None, "", " 12 _ -", "a clean document", "another one, 2", "日本語"]
HELD_OUT = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5 == 0]


@pytest.mark.parametrize("lang", [None, "en"])
def test_only_texts_without_a_letter_go(spark, lang):
    ids = HELD_OUT if lang else range(len(TEXTS))
    rows = [(i, t, lang, "a", len(t or "")) for i, t in zip(ids, TEXTS)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.language_id(spark, df, "")
    assert kept.columns == corpus_pipeline.COLUMNS
    assert sorted(tuple(r) for r in kept.collect()) == [r for r in rows if r[1] in TEXTS[3:]]
