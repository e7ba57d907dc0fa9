"""Tables that Spark would size too low are not broadcast: the driver would have to hold them."""

from __future__ import annotations

import pytest

import corpus_pipeline
from payguard.llm import anchors, common, components, simhash, suffixes

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def planned(df) -> str:
    return df._jdf.queryExecution().sparkPlan().toString()


@pytest.fixture
def plans(monkeypatch):
    """The plans, as Spark's estimates make them, of all frames that are checkpointed or stored."""
    out = []
    for module, name in ((simhash, "cut"), (components, "cut"), (simhash, "stored"), (anchors, "stored"), (suffixes, "stored")):
        def kept(df, *more, f=getattr(module, name)):
            out.append(planned(df))
            return f(df, *more)

        monkeypatch.setattr(module, name, kept)
    return out


@pytest.fixture
def few(spark):
    base = " ".join(f"w{i}" for i in range(400))
    texts = [base, base, base.replace("w200 ", "changed "), "another text", None, "", " ".join(f"v{i}" for i in range(90))]
    return spark.createDataFrame([(i, t, "en", "a", 1) for i, t in enumerate(texts)], SCHEMA).repartition(2)


def test_hint(spark):
    a, b = (spark.range(4).selectExpr("id", "explode(sequence(1, 50)) AS n") for _ in range(2))
    assert "BroadcastHashJoin" in planned(a.join(b, "id"))
    assert "SortMergeJoin" in planned(a.join(common.shuffled(b), "id"))


def test_simhash_broadcasts_no_keys(few, plans):
    plans.append(planned(simhash.near_duplicates(few)))
    assert any("SortMergeJoin" in p and "Generate explode" in p for p in plans)
    assert not [p for p in plans if "BroadcastHashJoin" in p and ("Generate explode(array(xxhash64" in p or "parquet" in p)]


def test_the_links_of_fingerprints_are_shuffled(spark, plans):
    nodes = spark.range(40).selectExpr("id AS fp")
    assert "BroadcastHashJoin" not in planned(simhash.links(nodes))
    assert not [p for p in plans if "BroadcastHashJoin" in p]


def planned_stage(spark, few, plans, stage, tmp_path) -> str:
    few.write.parquet(str(tmp_path / "documents.parquet"))
    plans.append(planned(stage(spark, spark.read.parquet(str(tmp_path / "documents.parquet")), "")))
    return "\n".join(plans)


def test_near_duplicates_broadcast_no_texts(spark, few, plans, tmp_path):
    text = planned_stage(spark, few, plans, corpus_pipeline.near_duplicates, tmp_path)
    assert "SortMergeJoin [i#" in text and "BroadcastHashJoin [i#" not in text


def test_passages_broadcast_nothing(spark, few, plans, tmp_path):
    text = planned_stage(spark, few, plans, corpus_pipeline.repeated_passages, tmp_path)
    assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text
