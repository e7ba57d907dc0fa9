"""Each stage of the corpus pipeline against a plain version, on its own input."""

from __future__ import annotations

import math
from collections import Counter

import pytest

import corpus_pipeline
from payguard.llm import language, mixing, pieces
from test_operators import plain_components, plain_earlier, plain_fingerprint


@pytest.fixture(scope="module")
def steps(spark, docs, tmp_path_factory):
    """Rows before the first stage and after each, as (doc_id, text, lang, source, n_chars)."""
    base = str(tmp_path_factory.mktemp("pipeline"))
    docs.write.parquet(f"{base}/documents.parquet")
    now, out = spark.read.parquet(f"{base}/documents.parquet"), []
    out.append([tuple(r) for r in now.select(*corpus_pipeline.COLUMNS).collect()])
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, now, base).write.parquet(f"{base}/{name}")
        now = spark.read.parquet(f"{base}/{name}")
        if i < 4:
            assert now.columns == corpus_pipeline.COLUMNS
        out.append([tuple(r) for r in now.collect()])
    return out, base


def test_language_keeps_what_it_recognises(spark, docs, steps):
    before, after = steps[0][:2]
    assert not Counter(after) - Counter(before)
    model = language.train(docs)
    for row in before:
        p = language.probabilities(model, [row[1]])[0]
        stays = bool(row[1]) and any(c.isalpha() for c in row[1]) and p.max() >= corpus_pipeline.LEAST_SCORE
        assert (row in after) == stays or abs(p.max() - corpus_pipeline.LEAST_SCORE) < 1e-4


def test_one_of_each_group_of_near_duplicates_stays(steps):
    before, after = steps[0][1:3]
    fps: dict[int, float] = {}
    for r in before:
        f = plain_fingerprint(r[1])
        fps[f] = min(fps.get(f, math.inf), math.inf if r[0] is None else r[0])
    component = plain_components(fps)
    want = {(r[0], r[1]) for r in before if component[plain_fingerprint(r[1])] == (math.inf if r[0] is None else r[0])}
    assert Counter((r[0], r[1]) for r in after) == Counter(want)


def test_repeated_passages_are_cut(steps):
    before, after = steps[0][2:4]
    want = Counter()
    texts = {r[0]: r[1] for r in before}
    for (i, _, removed, _, kept), n in plain_earlier(before, 100).items():
        text = kept.decode("utf-8", "ignore")
        if text or not texts[i]:
            want[i, text if removed else texts[i]] += n
    assert Counter((r[0], r[1]) for r in after) == want
    assert all(r[4] == len(r[1]) for r in after if r[1] is not None)


def test_documents_come_as_often_as_the_mix_takes_them(spark, docs, steps):
    before, after = steps[0][3:5]
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(spark.createDataFrame(before, "doc_id long, text string, lang string, source string, n_chars long")).collect()}
    assert Counter(after) == Counter({r: copies[r[0]] for r in before if copies[r[0]]})


def test_every_row_is_encoded(steps):
    import sentencepiece

    before, after = steps[0][4:6]
    lib = sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())
    want = Counter((r[0], tuple(lib.encode(r[1] or "", add_bos=True, add_eos=True))) for r in before)
    assert Counter((r[0], tuple(r[1])) for r in after) == want


def test_run_gives_the_last_stage(spark, steps):
    rows, base = steps
    assert Counter(str(tuple(r)) for r in corpus_pipeline.run(spark, base).collect()) == Counter(map(str, rows[-1]))


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_null_and_shared_ids_leave_one_document_of_a_group(spark):
    """Ids neither join nor part groups: near copies without an id, different texts without one, copies under one id."""
    base = " ".join(f"w{i}" for i in range(400))
    near = base.replace("w200 ", "changed ")
    other = " ".join(f"v{i}" for i in range(400))
    rows = [(None, base, "en", "a", 1), (None, near, "en", "a", 1), (None, other, "en", "b", 1), (9, "quite another text here", "en", "a", 1),
            (9, other + " end", None, "c", 1), (9, other + " end", "en", "c", 1), (3, None, None, None, None), (4, "", None, None, 0), (None, " ", "x", "y", 1)]
    assert plain_components({plain_fingerprint(t): 0 for t in (base, near)})  # both known to the plain version
    kept = [tuple(r) for r in corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, SCHEMA).repartition(3), "").collect()]
    groups: dict[int, list] = {}
    roots = {}
    fps = {plain_fingerprint(r[1]) for r in rows}
    for x in fps:
        roots[x] = min(y for y in fps if plain_components({x: 0, y: 1})[x] == plain_components({x: 0, y: 1})[y])
    for r in rows:
        groups.setdefault(roots[plain_fingerprint(r[1])], []).append(r)
    assert len(kept) == len(groups)
    for members in groups.values():
        mine = [r for r in kept if r in members]
        assert len(mine) == 1
        ids = [r[0] for r in members if r[0] is not None]
        assert mine[0][0] == (min(ids) if ids else None)
    # of rows that differ only in lang the null one stays, in every run
    assert (9, "quite another text here", "en", "a", 1) in kept
    again = [tuple(r) for r in corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows[::-1], SCHEMA), "").collect()]
    assert sorted(map(str, kept)) == sorted(map(str, again))


@pytest.mark.parametrize("rows", [[], [(1, "a single text", "en", "s", 13)], [(None, None, None, None, None)] * 3])
def test_tiny_tables_go_through(spark, rows, tmp_path):
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert [r["decoded"] for r in out] == [r[1] for r in rows if r[1]]
