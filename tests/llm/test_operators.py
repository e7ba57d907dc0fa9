"""Operators against brute force, on the awkward documents and on an empty table."""

from __future__ import annotations

import array
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from payguard.llm import language, mixing, pieces, quality, sharding, simhash, substrings, suffixes, syncmers, warc

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(b: bytes) -> str:
    return hashlib.sha256(b).hexdigest()


def words(t):
    return WORD.findall(t or "")


# 1 -----------------------------------------------------------------------------------------
def test_syncmers(docs, rows):
    got = syncmers.edited(syncmers.with_successor(docs)).collect()
    order = sorted(rows, key=lambda r: (-math.inf if r[0] is None else r[0], len(r[1] or ""), r[1] or ""), reverse=True)
    want = Counter()
    for r, following in zip(order, order[1:] + order[:1], strict=True):
        t, n = r[1] or "", len(r[1] or "")
        want[r[0], t[: n - n // 3] + (following[1] or "")[: n // 3]] += 1
    assert Counter((r["doc_id"], r["edited"]) for r in got) == want
    by_text = defaultdict(set)
    for r in got:
        by_text[r["text"]].add(tuple(r["marks"]))
    assert all(len(x) == 1 for x in by_text.values())


def test_syncmers_ranges(docs, monkeypatch):
    whole = sorted(map(str, syncmers.with_successor(docs).collect()))
    monkeypatch.setattr(syncmers, "RANGE_ROWS", 7)
    assert sorted(map(str, syncmers.with_successor(docs).collect())) == whole


def test_syncmers_chosen_by_content_alone(spark):
    base = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau"
    df = spark.createDataFrame([(base,), ("other words before it " + base + " and after",)], "t string")
    a, b = (r["x"] for r in syncmers.with_anchors(df, "t", "x").collect())
    inner = {(x["at"] + 4, x["mark"]) for x in a}
    assert inner and inner <= {(x["at"], x["mark"]) for x in b}
    near = syncmers.with_marks(syncmers.with_marks(df.select("t", F.lit(base).alias("u")), "t", "x"), "u", "y")
    like = [r[0] for r in near.select(syncmers.likeness("x", "y")).collect()]
    assert like[0] == 1.0 and 0.4 < like[1] < 1.0


# 2 -----------------------------------------------------------------------------------------
def plain_fingerprint(t, k=4):
    import xxhash

    w = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x) for x in words(t)]
    if not w:
        return 0
    h = [xxhash.xxh64(" ".join(w[i : i + k]).encode(), seed=42).intdigest() for i in range(max(1, len(w) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(fps: dict, radius=4):
    root = {x: x for x in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    keys = list(fps)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if (a ^ b).bit_count() <= radius:
                root[find(a)] = find(b)
    least: dict = {}
    for x in keys:
        least[find(x)] = min(least.get(find(x), math.inf), fps[x])
    return {x: least[find(x)] for x in keys}


def test_a_hub_is_split(spark):
    """The final plan of a star: a root with all nodes for neighbours does not stay in one task."""
    from payguard.llm.components import components

    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold", "spark.sql.adaptive.advisoryPartitionSizeInBytes",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "spark.sql.adaptive.skewJoin.skewedPartitionFactor", "spark.sql.adaptive.coalescePartitions.enabled"]
    was = {n: spark.conf.get(n, None) for n in names}
    for n, v in zip(names, ["-1", "-1", "100KB", "100KB", "2", "false"], strict=True):
        spark.conf.set(n, v)
    try:
        hub = spark.range(1, 200_000, numPartitions=16).selectExpr("0L as u", "id as v")
        rest = spark.range(300_000, 400_000, 2, numPartitions=16).selectExpr("id as u", "id + 1 as v")
        both = hub.unionByName(rest).unionByName(rest.selectExpr("v as u", "u as v"))
        least = simhash.cut(both.groupBy("u").agg(F.min("v").alias("m")))
        joined = both.join(least, "u")
        joined.write.format("noop").mode("overwrite").save()
        rows = joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "isFinalPlan=true" in plan and "skew=true" in plan
        assert len(rows) == 199_999 + 100_000
        found = components(hub.unionByName(rest))
        assert found.where("root = 0").count() == 200_000 and found.count() == 200_000 + 100_000
    finally:
        for n, v in was.items():
            spark.conf.unset(n) if v is None else spark.conf.set(n, v)


@pytest.mark.parametrize("block", [simhash.BLOCK, 3])
def test_simhash(docs, rows, block, monkeypatch):
    monkeypatch.setattr(simhash.links, "__defaults__", (simhash.RADIUS, block))
    got = simhash.near_duplicates(docs).select("doc_id", simhash.hex_digits("fp").alias("f"), "component_id").collect()
    fps: dict[int, float] = {}
    for r in rows:
        f = plain_fingerprint(r[1])
        fps[f] = min(fps.get(f, math.inf), math.inf if r[0] is None else r[0])
    want = plain_components(fps)
    expected = Counter()
    for r in rows:
        f = plain_fingerprint(r[1])
        expected[r[0], f"{f:016x}", None if want[f] == math.inf else want[f]] += 1
    assert Counter(map(tuple, got)) == expected


def test_masks_cover_every_pair_within_the_radius():
    import random

    rng, all_masks = random.Random(1), simhash.masks()
    for _ in range(3_000):
        differ = sum(1 << i for i in rng.sample(range(64), rng.randint(1, 4)))
        assert any(differ & (m % (1 << 64)) == 0 for m in all_masks)


# 3 -----------------------------------------------------------------------------------------
def test_mixing(docs, rows):
    got = mixing.mix(docs).collect()
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(words(r[1]))
    total, order = sum(sizes.values()), sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target = {s: total * weight[s] / sum(weight.values()) for s in order}
    capped: set = set()
    while over := [s for s in order if s not in capped and target[s] >= 3 * sizes[s]]:
        capped |= set(over)
        left, w = total - sum(3 * sizes[s] for s in capped), sum(weight[s] for s in order if s not in capped)
        target = {s: 3 * sizes[s] if s in capped else left * weight[s] / w for s in order}
    taken, largest = Counter(), Counter()
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(target[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    assert len(got) == len(rows)
    assert all(abs(taken[s] - target[s]) <= 3 * largest[s] / 2 + 1 for s in order)
    assert sorted(map(str, mixing.mix(docs.repartition(3)).collect())) == sorted(map(str, got))


@pytest.mark.parametrize("one_id", [None, 7])
def test_mixing_cuts_inside_an_id(spark, one_id):
    """Texts that share an id, or have none, are told apart: the mix comes near its target all the same."""
    rows = [(one_id, f"{i} " + "w " * (i % 9), "a") for i in range(400)] + [(1_000 + i, f"x{i} y z", s) for i in range(400) for s in ("b", "c")]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    taken, target = Counter(), {}
    for r in got:
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    assert all(abs(taken[s] - target[s]) <= 15 for s in target)


# 4 -----------------------------------------------------------------------------------------
def test_sharding(docs, rows, monkeypatch):
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 3)
    got = sharding.assign(docs).collect()
    assert len(got) == len(rows)
    expected = Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == expected
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
        assert r["grown_shard"] in (r["shard"], 8)

        def score(i, key="null" if r["doc_id"] is None else str(r["doc_id"])):
            return -1 / math.log((int(hashlib.md5(f"{key}:{i}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52)

        assert r["shard"] == max(range(8), key=score) and r["grown_shard"] == max(range(9), key=score)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_weighted_shards(spark):
    df = spark.range(20_000).select(sharding.rendezvous(F.col("id").cast("string"), [1, 2, 5]).alias("s"))
    n = {r["s"]: r["count"] for r in df.groupBy("s").count().collect()}
    assert [round(8 * n[i] / 20_000) for i in range(3)] == [1, 2, 5]
    with pytest.raises(ValueError):
        sharding.rendezvous(F.lit("x"), [1, 0])


# 5 -----------------------------------------------------------------------------------------
PAGE = ("<html lang='fr'><head><title>A &amp; B</title><script>var t='</p>';</script></head><body><!-- no --><h1>Hi</h1>"
        "<p>One&nbsp;two <b>three</b> &#233;<p>x &lt; y<a href='/z?a=1&amp;b=2'>go</a><a href=\"/z?a=1&amp;b=2\">again</a></body></html>")


def test_warc_records(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://e.org/d/", PAGE), (2, None, ""), (3, "http://e.org/", None), (4, "x", "<p>open <!-- never closed")], "page_id long, url string, html string")
    source = warc.responses(pages)
    got = {(r["page_id"], r["record_type"]): r for r in warc.derive(source).collect()}
    assert len(got) == 8
    text = got[1, "conversion"]
    assert text["block"] == "Hi\nOne two three é\nx < ygoagain"
    meta = got[1, "metadata"]["block"].split("\r\n")
    assert meta[:3] == ["title: A & B", "language: fr", "outlink: http://e.org/z?a=1&b=2"] and len(meta) == 5
    ids = {r["page_id"]: r["record_id"] for r in source.collect()}
    for (page, kind), r in got.items():
        other = got[page, "metadata" if kind == "conversion" else "conversion"]
        assert r["refers_to"] == ids[page] and r["concurrent_to"] == other["record_id"]
        assert r["block_digest"] == "sha256:" + sha(r["block"].encode()) and r["content_length"] == len(r["block"].encode())
    assert text["payload_digest"] == "sha256:" + sha(PAGE.encode()) and "text/html" in text["source_headers"]
    assert got[2, "conversion"]["block"] == got[3, "conversion"]["block"] == "" and got[4, "conversion"]["block"] == "open"
    warc.write(warc.derive(source).coalesce(1), str(tmp_path / "w"))
    data = b"".join(p.read_bytes() for p in (tmp_path / "w").glob("part-*"))
    n = at = 0
    while at < len(data):  # records parse by their own lengths
        head, _, rest = data[at:].partition(b"\r\n\r\n")
        length = int(re.search(rb"\r\nContent-Length: (\d+)", head)[1])
        assert head.startswith(b"WARC/1.1\r\n") and rest[length : length + 4] == b"\r\n\r\n"
        at, n = at + len(head) + 4 + length + 4, n + 1
    assert n == 8
    assert warc.derive(warc.responses(pages.limit(0))).count() == 0


# 6 -----------------------------------------------------------------------------------------
def plain_windows(rows, window):
    seen = Counter()
    for r in rows:
        w = words(r[1])
        seen.update(tuple(w[i : i + window]) for i in range(len(w) - window + 1))
    out = Counter()
    for r in rows:
        w = words(r[1])
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        out[r[0], len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)] += 1
    return out


@pytest.mark.parametrize("window,seed", [(35, 8), (9, 4), (16, 8)])
def test_substrings(docs, rows, window, seed):
    assert Counter(map(tuple, substrings.deduplicate(docs, window=window, seed=seed).collect())) == plain_windows(rows, window)


# 7 -----------------------------------------------------------------------------------------
def test_gradients_by_differences():
    import numpy as np

    rng = np.random.default_rng(0)
    model = language.ByteGru(["a", "b", "c"], hidden=3)
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    windows, mask, owner = language._windows([b"abcde", b"xyz", b"hello world"], 6)
    target = np.array([0, 1, 2])[owner]

    def loss():
        states = np.zeros((6, 6, len(owner)))
        for d, order, at in (("f", range(6), slice(0, 3)), ("b", range(5, -1, -1), slice(3, 6))):
            h = np.zeros((3, len(owner)))
            for t in order:
                gate, _, c = model._step(d, windows[t], h)
                h = (c + gate[:3] * (h - c)) * mask[t]
                states[t, at] = h
        p = model.positions(states)
        return float(-(np.log(p[:, target, np.arange(len(owner))]) * mask).sum() / mask.sum())

    model32 = language.ByteGru(["a", "b", "c"], hidden=3)
    model32.p = {k: v.astype(np.float32) for k, v in model.p.items()}
    value, g = model32.gradients(windows, mask, target)
    assert value == pytest.approx(loss(), rel=1e-4)
    for name, v in model.p.items():
        for _ in range(6):
            at = tuple(rng.integers(0, s) for s in v.shape)
            if name[0] == "x":
                at = (at[0], int(windows[0, 0]))
            old = v[at]
            v[at] = old + 1e-5
            up = loss()
            v[at] = old - 1e-5
            down = loss()
            v[at] = old
            assert g[name][at] == pytest.approx((up - down) / 2e-5, rel=2e-2, abs=2e-5)


def test_language(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language.op7_language(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id")
    held = found.where("held_out AND lang_pred <> 'und'").agg(F.count(F.lit(1)), F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()
    assert held[0] > 100 and held[1] > 0.95


def test_language_awkward(docs, rows):
    model = language.fit(["the house is on the hill " * 20, "la maison est sur la colline " * 20], ["en", "fr"], steps=20)
    got = language.predict(docs, model)
    assert got.columns == [*(c for c in docs.columns if c != "score"), "lang_pred", "score"]
    for r in got.collect():
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters) and 0 <= r["score"] <= 1
    assert {r["lang_pred"] for r in language.predict(docs, None).collect()} == {"und"}
    assert len(language.label_positions(model, "la maison")) == 9


# 8 -----------------------------------------------------------------------------------------
def test_pieces(docs, rows):
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())
    want = Counter()
    for r in rows:
        ids = lib.encode(r[1] or "", add_bos=True, add_eos=True)
        want[r[0], len(ids), sha(array.array("I", ids).tobytes()), sha(lib.decode(ids).encode())] += 1
    assert Counter(map(tuple, pieces.digest_documents(docs, pieces.model_path()).collect())) == want
    for r in pieces.encode_documents(docs, pieces.model_path()).collect():
        assert lib.decode(r["ids"]) == r["decoded"]


def test_pieces_on_odd_texts():
    import random

    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())
    with open(pieces.model_path(), "rb") as f:
        model = pieces.PieceModel(f.read())
    rng, alphabet = random.Random(5), "aeiounstrhl éèçß\n\t  ▁.,;:!?0123456789#<>ABCxyz日本語한국🙂ü​\x00"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.choice([1, 3, 20, 200]))) for _ in range(1_500)]
    texts += [" " * k for k in range(40)] + ["a" + " " * k + "b" for k in range(40)] + ["=" * 3_000, "the" * 800, "<s> </s> <unk> <0x41>"]
    for t in texts:
        ids = array.array("I", model.encode(t)).tolist()
        assert ids == lib.encode(t) and model.decode(ids) == lib.decode(ids)


def test_a_million_characters_without_a_space():
    """Time in proportion to the text: each place is looked at a bounded number of times."""
    import random
    import time

    import numpy as np
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())
    with open(pieces.model_path(), "rb") as f:
        model = pieces.PieceModel(f.read())
    text = "".join(random.Random(1).choice("etaoinshrdlu") for _ in range(1_000_000))
    start = time.process_time()
    ids = np.frombuffer(model.encode(text), "<u4")
    assert time.process_time() - start < 10
    assert ids.tolist() == lib.encode(text)


def test_pairs_remembered_are_bounded(monkeypatch):
    monkeypatch.setattr(pieces, "AGREES", 50)
    with open(pieces.model_path(), "rb") as f:
        model = pieces.PieceModel(f.read())
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())
    text = "internationalisation of encyclopaedias, notwithstanding 日本語 " * 20
    import array

    assert array.array("I", model.encode(text)).tolist() == lib.encode(text)
    assert len(model.agrees) <= 50


# 9 -----------------------------------------------------------------------------------------
def test_quality_measures(docs, rows):
    want = Counter()
    for r in rows:
        t, w = r[1] or "", words(r[1])
        lines = [x for x in t.split("\n") if WORD.search(x)]
        seen = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        again = {j for i in range(len(w) - 7) if seen[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
        want[r[0], len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(again)] += 1
    got = quality.judge(docs).collect()
    assert Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in got) == want
    for r in got:
        failed = r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"]
        assert r["base_failed"] == failed and r["kept"] == (not failed and r["posterior"] >= 0.5)


def test_estimated_accuracies():
    import random

    rng = random.Random(2)
    right = [(0.99, 0.6), (0.95, 0.7), (0.9, 0.9), (0.97, 0.4), (0.8, 0.3), (0.9, 0.1)]
    patterns = Counter()
    for _ in range(30_000):
        bad = rng.random() >= 0.7
        votes = [0 if rng.random() < 0.2 else (1 if (rng.random() < a[bad]) != bad else -1) for a in right]
        patterns[tuple(votes)] += 1
    share, found = quality.estimate(list(patterns.items()))
    assert share == pytest.approx(0.7, abs=0.03)
    assert [x for a in found for x in a] == pytest.approx([x for a in right for x in a], abs=0.06)
    assert quality.weights(0.4, 0.5) == (0.0, 0.0)


# 10 ----------------------------------------------------------------------------------------
def plain_earlier(rows, window):
    unique = {(r[0], r[1] or "") for r in rows}
    seen: set = set()
    result = {}
    for i, t in sorted(unique, key=lambda x: (-math.inf if x[0] is None else x[0])):
        b, gone = t.encode(), set()
        for j in range(len(b) - window + 1):
            if b[j : j + window] in seen:
                gone.update(range(j, j + window))
            seen.add(b[j : j + window])
        runs = sum(1 for x in gone if x - 1 not in gone)
        result[i, t] = (len(b), len(gone), runs, bytes(x for k, x in enumerate(b) if k not in gone))
    return Counter((r[0], *result[r[0], r[1] or ""]) for r in rows)


@pytest.mark.parametrize("window,seed,hot,shard", [(100, 16, 20_000, 4_000_000), (100, 16, 1, 2_000), (20, 8, 3, 500)])
def test_suffix_arrays(docs, rows, window, seed, hot, shard, monkeypatch):
    monkeypatch.setattr(suffixes, "SHARD_BYTES", shard)
    got = suffixes.deduplicate(docs, window=window, seed=seed, hot=hot).collect()
    assert Counter((r[0], r[1], r[2], r[3], bytes(r[4])) for r in got) == plain_earlier(rows, window)


def test_a_passage_in_ten_thousand_blocks_is_sorted_in_shards(spark):
    """Phrases between neighbours from a few hundred left and right ones: blocks differ, their halves often don't."""
    rng = random.Random(4)
    letters = "abcdefghijklmnopqrstuvwxyz "
    some = lambda n: "".join(rng.choice(letters) for _ in range(n))
    phrase, left, right = some(40), [some(70) for _ in range(300)], [some(70) for _ in range(300)]
    pairs = rng.sample([(a, b) for a in left for b in right], 10_000)
    rows = [(i, a + phrase + b + (some(30) if i % 2 else "")) for i, (a, b) in enumerate(pairs)]
    got = suffixes.deduplicate(spark.createDataFrame(rows, "doc_id long, text string").repartition(8)).collect()
    assert Counter((r[0], r[1], r[2], r[3], bytes(r[4])) for r in got) == plain_earlier(rows, 100)


def test_halves_of_an_anchor_s_places():
    assert suffixes._widths(85) == [43, 22, 11, 6, 3, 2, 1]
    assert suffixes._widths(1) == [1]


def test_sorted_by_induction():
    import random

    import numpy as np

    rng = random.Random(0)
    for _ in range(1_000):
        t = [rng.randrange(rng.choice([1, 2, 3, 9])) for _ in range(rng.randint(0, 40))]
        assert suffixes.suffix_array(np.array(t, np.int64)).tolist() == sorted(range(len(t)), key=lambda i: t[i:])


# all ---------------------------------------------------------------------------------------
def test_empty_tables(empty):
    assert syncmers.edited(syncmers.with_successor(empty)).count() == 0
    assert simhash.near_duplicates(empty).count() == 0
    assert mixing.mix(empty).count() == 0
    assert sharding.assign(empty).count() == 0
    assert substrings.deduplicate(empty).count() == 0
    assert language.predict(empty, language.train(empty)).count() == 0
    assert pieces.encode_documents(empty, pieces.model_path()).count() == 0
    assert quality.judge(empty).count() == 0
    assert suffixes.deduplicate(empty).count() == 0
    assert suffixes.cleaned(empty).count() == 0
