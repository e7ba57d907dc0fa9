"""Suffix-array dedup with arrays sorted by induction.

Documents' 100-byte windows are dealt to shards by their anchors (see ``anchors``), so equal
windows meet in one shard whatever documents they come from; windows whose anchor occurs once
need no look. Equal blocks are aggregated first: all their occurrences but the first are
repeats. The distinct blocks that share an anchor are laid end to end in shards of bounded
size; each shard's suffix array is sorted by induction, the permuted common prefixes give runs
of suffixes that share 100 bytes, and of each run all but the earliest are repeats. A block
without another that has the same anchor and the same bytes on one side of it is left out. An anchor that
more distinct blocks share than a shard should hold is cut by what stands around it: windows with
the anchor in their left half share more bytes on its right, the others on its left, and halving
goes on until the groups are small enough to be sorted.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payguard.llm.anchors import Units, by_document, distinct_blocks, keyed, repeated_blocks, with_company, with_contents
from payguard.llm.common import NULL_ID, documents, merge_spans, shuffled, stored

WINDOW, SEED = 100, 16
# Bytes a shard should hold, and the distinct blocks of one anchor above which they are cut into
# halves that share more than the anchor, as no shard could hold them.
SHARD_BYTES, HOT_BLOCKS = 1_000_000, 5_000


def _types(t: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one. Behind the end stands something smaller than all."""
    n = len(t)
    change = np.flatnonzero(t[1:] != t[:-1])
    up = np.r_[t[1:][change] > t[change], False]  # by run of equal symbols; the last run goes down
    return np.repeat(up, np.diff(np.r_[0, change + 1, n]))


def _chains(start: np.ndarray, steps: np.ndarray, key_in: np.ndarray, key_end: np.ndarray) -> np.ndarray:
    """Order of suffixes that run ``steps`` symbols to a place whose order is known.

    The keys of the places on the way are compared from the last to the first, each in one
    stable sort, so every suffix is placed by the one that follows it. ``key_in`` is a place's
    key inside a chain, ``key_end`` its key as the end of one.
    """
    by_steps = np.argsort(steps, kind="stable")
    ordered = steps[by_steps]
    done = np.zeros(0, np.int64)
    high = len(ordered)
    for d in range(int(ordered[-1]) if high else 0, -1, -1):
        low = int(np.searchsorted(ordered, d, "left"))
        new = start[by_steps[low:high]]
        high = low
        keys = np.r_[key_in[done + d], key_end[new + d]]
        both = np.r_[done, new]
        done = both[np.argsort(keys, kind="stable")]
    return done


def _induce(t: np.ndarray, small: np.ndarray, lms: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Suffix array from the ranks of the leftmost-smaller suffixes: larger ones first, then smaller ones.

    ``small`` holds the types, ``lms`` the leftmost-smaller places in order, ``rank`` their ranks
    (equal ranks: order unknown, any).
    """
    n = len(t)
    symbol = t.astype(np.int64)
    place = np.arange(n, dtype=np.int64)
    # larger suffixes descend to the next leftmost-smaller place or the end, which is least
    width = len(lms) + 2
    inside = np.r_[symbol * width, -1]
    ends = np.full(n + 1, -1, np.int64)
    ends[lms] = symbol[lms] * width + 1 + rank
    large = place[~small]
    after = np.r_[lms, n]
    steps = after[np.searchsorted(lms, large, "right")] - large
    large = _chains(large, steps, inside, ends)
    # smaller suffixes ascend to the next larger place; there is one, the last place being larger
    width = len(large) + 2
    ends[large] = symbol[large] * width + np.arange(len(large))
    inside = np.r_[symbol * width + width - 1, -1]
    rising, falls = place[small], place[~small]
    steps = falls[np.searchsorted(falls, rising, "right")] - rising if len(rising) else rising
    rising = _chains(rising, steps, inside, ends)
    both = np.r_[large, rising]
    return both[np.argsort(symbol[both], kind="stable")]


def suffix_array(t: np.ndarray) -> np.ndarray:
    """Places of the suffixes of an array of non-negative numbers in their order.

    Suffixes are classified, the leftmost-smaller substrings sorted by induction and named, the
    string of names sorted in the same way unless all differ, and the whole induced from it.
    """
    n = len(t)
    if n < 2:
        return np.arange(n, dtype=np.int64)
    small = _types(t)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    if not len(lms):
        return _induce(t, small, lms, lms)
    order = _induce(t, small, lms, np.zeros(len(lms), np.int64))
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    order = order[is_lms[order]]
    # name the substrings, each up to and with the next leftmost-smaller place
    index = np.zeros(n, np.int64)
    index[lms] = np.arange(len(lms))
    length = np.r_[np.diff(lms) + 1, n + 1]  # the last one is like no other
    a, b = order[:-1], order[1:]
    same = length[index[a]] == length[index[b]]
    left = np.flatnonzero(same)
    d = 0
    while len(left):
        equal = t[a[left] + d] == t[b[left] + d]
        same[left[~equal]] = False
        d += 1
        left = left[equal]
        left = left[length[index[a[left]]] > d]
    names = np.zeros(len(lms), np.int64)
    names[index[order]] = np.r_[0, np.cumsum(~same)]
    if names.max() + 1 < len(lms):
        rank = np.zeros(len(lms), np.int64)
        rank[suffix_array(names)] = np.arange(len(lms))
    else:
        rank = names
    return _induce(t, small, lms, rank)


def permuted_prefixes(data: np.ndarray, order: np.ndarray, limit: int) -> np.ndarray:
    """By place: bytes its suffix shares with the one before it in the array, at most ``limit``."""
    n = len(data)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    padded = np.r_[data, np.zeros(8, np.uint8)]
    eight = sum((padded[i : n + i].astype(np.uint64) << np.uint64(8 * i) for i in range(8)), np.zeros(n, np.uint64))
    shared = np.zeros(n, np.int64)
    left = np.flatnonzero(before >= 0)
    while len(left):
        at = shared[left]
        a, b = left + at, before[left] + at
        room = np.minimum(limit - at, n - np.maximum(a, b))  # bytes still to compare
        differ = eight[np.minimum(a, n - 1)] ^ eight[np.minimum(b, n - 1)]
        low = differ & (~differ + np.uint64(1))
        equal = np.where(differ == 0, 8, np.bitwise_count(low - np.uint64(1)).astype(np.int64) // 8)
        step = np.minimum(equal, room)
        shared[left] += step
        left = left[(step == 8) & (room > 8)]
    return shared


def repeats_in_shard(blocks: list[bytes], key: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of the blocks that equal an earlier one, as runs: block, first and last window.

    ``key`` ranks the blocks' first windows by document and place, in steps that leave room for
    a block's own windows.
    """
    lengths = np.array([len(b) for b in blocks], np.int64)
    begins = np.r_[0, np.cumsum(lengths + 1)]
    data = np.frombuffer(b"\xff".join(blocks) + b"\xff", np.uint8)  # a byte that UTF-8 has not
    t = data.astype(np.int64) + 1
    t[begins[1:] - 1] = 0  # between the blocks, less than any byte
    order = suffix_array(t)
    shared = permuted_prefixes(data, order, window)
    owner = np.repeat(np.arange(len(blocks)), lengths + 1)
    offset = np.arange(len(data)) - begins[owner]
    valid = offset + window <= lengths[owner]
    order = order[valid[order]]
    if not len(order):
        return owner[:0], offset[:0], offset[:0]
    rank = key[owner[order]] + offset[order]
    heads = np.flatnonzero(np.r_[True, shared[order][1:] < window])
    earliest = np.repeat(np.minimum.reduceat(rank, heads), np.diff(np.r_[heads, len(order)]))
    late = np.sort(order[rank > earliest])
    if not len(late):
        return owner[:0], offset[:0], offset[:0]
    first = np.flatnonzero(np.r_[True, (late[1:] != late[:-1] + 1) | (owner[late[1:]] != owner[late[:-1]])])
    last = np.r_[first[1:] - 1, len(late) - 1]
    return owner[late[first]], offset[late[first]], offset[late[last]]


class Bytes(Units):
    def split(self, text: str) -> bytes:
        return text.encode()

    def numbers(self, parts: bytes) -> np.ndarray:
        return np.frombuffer(parts, np.uint8).astype(np.uint64)

    def stretch(self, parts: bytes, a: int, b: int) -> bytes:
        return parts[a:b]


def _sorted_shards(blocks: DataFrame, window: int, shards: int) -> DataFrame:
    """Repeats among distinct blocks ``anchor, id, v, start, block``: ``id, v, a, b``."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["id", "v", "start"], kind="stable").reset_index(drop=True)
        start = frame["start"].to_numpy()
        # rank of a window: its document's number in the shard, then its place
        number = (frame[["id", "v"]] != frame[["id", "v"]].shift()).any(axis=1).cumsum().to_numpy()
        owner, a, b = repeats_in_shard(list(frame["block"]), number * np.int64(1 << 40) + start, window)
        return pd.DataFrame({"id": frame["id"].to_numpy()[owner], "v": frame["v"].to_numpy()[owner], "a": start[owner] + a, "b": start[owner] + b + window})

    dealt = blocks.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))
    return dealt.groupBy("shard").applyInPandas(run, "id long, v long, a long, b long")


def _halved(blocks: DataFrame, window: int) -> DataFrame:
    """The blocks cut in two where their anchor lies in the window: in its left or its right half of places ``lo..hi``.

    The windows of a half have the more bytes around the anchor in common, ``window`` less the width of the half; the
    anchor and these bytes, hashed, are the new ``anchor``. ``h`` is a hash of the half's contents.
    """
    half = lambda lo, hi: F.struct(
        lo.alias("lo"), hi.alias("hi"), F.greatest(F.lit(0), F.col("at") - hi).alias("o1"),
        F.least(F.octet_length("block") - window, F.col("at") - lo).alias("o2"))
    middle = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
    halves = F.filter(F.array(half(F.col("lo"), middle), half(middle + 1, F.col("hi"))), lambda p: (p["o1"] <= p["o2"]) & (p["lo"] <= p["hi"]))
    rows = blocks.withColumn("p", F.explode(halves))
    common = F.substring(F.col("block"), F.col("at") - F.col("p.lo") + 1, F.col("p.lo") - F.col("p.hi") + window)
    part = F.substring(F.col("block"), F.col("p.o1") + 1, F.col("p.o2") - F.col("p.o1") + window)
    return rows.select(F.xxhash64("anchor", "p.lo", common).alias("anchor"), F.md5(part).alias("h"), "id", "v", (F.col("start") + F.col("p.o1")).alias("start"),
                       (F.col("at") - F.col("p.o1")).alias("at"), "p.lo", "p.hi", part.alias("block"))


def _narrowed(blocks: DataFrame, window: int, seed: int, hot: int) -> tuple[list[DataFrame], list[DataFrame], list[DataFrame]]:
    """Blocks of anchors that more than ``hot`` distinct ones share, cut until each group is small enough to be sorted.

    Halving goes on while a group has more than ``hot`` distinct parts; it ends with a single place, where a group's
    windows have all their bytes in common and are one part. Equal parts are aggregated to the earliest; the others
    are repeats. Gives tables of blocks to sort, of repeats ``id, v, a, b``, and all tables to delete once both are used.
    """
    rest = blocks.select("anchor", "id", "v", "start", "at", F.lit(0).alias("lo"), F.lit(window - seed).alias("hi"), "block")
    cool, late, tables = [], [], []
    for width in _widths(window - seed + 1):
        if rest.isEmpty():
            break
        parts = stored(_halved(rest, window), "bytes-halves")
        place = F.struct("id", "v", "start")
        first = stored(parts.groupBy("anchor", "h").agg(F.min(place).alias("x"), *[F.first(c).alias(c) for c in ("at", "lo", "hi", "block")]), "bytes-parts")
        several = stored(first.groupBy("anchor").agg(F.count(F.lit(1)).alias("m")).where("m > 1"), "bytes-groups")
        tables += [parts, first, several]
        late.append(parts.join(shuffled(first.select("anchor", "h", "x")), ["anchor", "h"]).where(place > F.col("x")).select(
            "id", "v", F.col("start").alias("a"), (F.col("start") + F.octet_length("block")).alias("b")))
        shared = first.join(shuffled(several), "anchor").select("anchor", "x.*", "at", "lo", "hi", "block", "m")
        fits = F.col("m") <= hot if width > 1 else F.lit(True)
        cool.append(shared.where(fits).select("anchor", "id", "v", "start", "block"))
        rest = shared.where(~fits).drop("m")
    return cool, late, tables


def _widths(n: int) -> list[int]:
    """Places in the wider half at each halving of ``n``, down to one."""
    out = [-(-n // 2)]
    while out[-1] > 1:
        out.append(-(-out[-1] // 2))
    return out


def repeated_spans(rows: DataFrame, window: int = WINDOW, seed: int = SEED, hot: int = HOT_BLOCKS) -> DataFrame:
    """``id, v, spans``: the byte spans ``a, b`` of each document that are covered by windows that
    also start earlier; their union is what to remove."""
    units = Bytes()
    blocks = repeated_blocks(rows, units, seed, window, "bytes")
    first = distinct_blocks(blocks, "bytes-distinct")
    again = blocks.join(shuffled(first.where("n > 1").select("anchor", "h", F.struct("id", "v", "start").alias("x"))), ["anchor", "h"])
    again = again.where(F.struct("id", "v", "start") > F.col("x")).select("id", "v", F.col("start").alias("a"), (F.col("start") + F.col("size")).alias("b"))
    # a table of its own, so that adaptive execution may split the blocks of a frequent anchor
    several = stored(first.groupBy("anchor").agg(F.count(F.lit(1)).alias("m")).where("m > 1"), "bytes-several")
    near = stored(with_contents(rows, first.join(shuffled(several), "anchor").select("anchor", "id", "v", "start", "at", "size", "m"), units, seed, window), "bytes-near", several)
    near = with_company(near, "bytes-company")
    cool, late, tables = _narrowed(near.where(F.col("m") > hot), window, seed, hot)
    dealt = reduce(DataFrame.unionByName, cool, near.where(F.col("m") <= hot).select("anchor", "id", "v", "start", "block"))
    size = dealt.agg(F.coalesce(F.sum(F.octet_length("block")), F.lit(0))).first()[0]
    spans = reduce(DataFrame.unionByName, late, again.unionByName(_sorted_shards(dealt, window, max(1, -(-size // SHARD_BYTES)))))
    return stored(by_document(spans), "bytes-spans", blocks, first, near, *tables)


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                seed: int = SEED, hot: int = HOT_BLOCKS) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept binary`` of every row.

    A byte goes if a window over it also starts earlier: in a document of smaller id, or before
    it in the same one, overlaps included, judged on the input. Null texts are empty. Rows that
    repeat id and text are one document and get one result; different texts of one id are
    ordered by a hash; a null id comes first. Other columns are ignored; an empty table gives
    an empty result.
    """
    rows = keyed(docs, id_col, text_col)
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    return _with_spans(rows, window, seed, hot).mapInPandas(_cut, schema)


def _with_spans(rows: DataFrame, window: int, seed: int, hot: int) -> DataFrame:
    return rows.join(shuffled(repeated_spans(rows.select("id", "v", "text"), window, seed, hot)), ["id", "v"], "left")


def without_spans(data: bytes, spans) -> tuple[bytes, int, int]:
    """What is left of the text, bytes removed, and maximal runs removed."""
    if spans is None:
        return data, 0, 0
    a, b = merge_spans(*np.array([(s["a"], s["b"]) for s in spans]).T)
    return b"".join(data[x:y] for x, y in zip([0, *b], [*a, len(data)], strict=True)), int((b - a).sum()), len(a)


def _cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        out = []
        for i, text, spans in frame[["id", "text", "spans"]].itertuples(index=False):
            data = text.encode()
            kept, removed, n = without_spans(data, spans)
            out.append((None if i == NULL_ID else i, len(data), removed, n, kept))
        yield pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]).astype({"doc_id": "Int64"})


def cleaned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
            seed: int = SEED, hot: int = HOT_BLOCKS) -> DataFrame:
    """The rows with their columns and the repeated bytes cut from the text.

    Halves of a character that a cut leaves go too. A text that loses all it had goes with its
    row; null and empty texts stay as they are.
    """
    fields, names = docs.schema.fields, docs.columns
    carried = [f"c{i}" for i in range(len(names))]
    columns = [F.col(f"`{n}`").alias(c) for n, c in zip(names, carried, strict=True)]
    both = docs.withColumn("__row", F.struct(*columns))
    rows = keyed(both, id_col, text_col, ["__row"])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        at = names.index(text_col)
        for batch in batches:
            texts, keep = batch.column(names_in.index("text")).to_pylist(), []
            spans = batch.column(names_in.index("spans")).to_pylist()
            row = batch.column(names_in.index("__row"))
            old = row.field(at).to_pylist()
            new = [o if s is None else without_spans(t.encode(), s)[0].decode("utf-8", "ignore") for o, t, s in zip(old, texts, spans, strict=True)]
            keep = pa.array([bool(n) or not o for n, o in zip(new, old, strict=True)], pa.bool_())
            columns = [pa.array(new, pa.string()) if i == at else row.field(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays(columns, names).filter(keep)

    joined = _with_spans(rows, window, seed, hot)
    names_in = joined.columns
    return joined.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields))


def op10_suffix_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicate(documents(spark, sf_dir)).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
