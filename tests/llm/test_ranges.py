"""Ranges of op1 where many rows share an id."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from conftest import sentence
from payguard.llm import syncmers


def test_rows_of_one_id_spread_over_ranges(spark, monkeypatch):
    rng = random.Random(8)
    texts = [sentence(rng, rng.randint(1, 60)) for _ in range(600)]
    ids = [None] * 200 + [5] * 200 + list(range(200))
    df = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string").repartition(3)
    whole = sorted(map(str, syncmers.with_successor(df).collect()))
    monkeypatch.setattr(syncmers, "RANGE_ROWS", 20)
    assert sorted(map(str, syncmers.with_successor(df).collect())) == whole
    rows = df.select(F.coalesce("doc_id", F.lit(syncmers.NULL_ID)).alias("id"), "text")
    keys = [c for c in syncmers._ranged(rows).columns if c not in ("id", "text", "end")]
    sizes = [r["count"] for r in syncmers._ranged(rows).where("end = 0").groupBy(*keys).count().collect()]
    assert sum(sizes) == 600 and max(sizes) <= 60
