"""How far sources of a language diverge in their terms, by sorting pointers to word starts.

A task lays the texts of a shard (some 16 MB of Arrow buffers, whole documents, ordered by language and source)
into one byte buffer, lower-cases it, and builds one pointer for every place where a term starts. The pointers, not the
terms, are sorted by multikey quicksort: a slice is parted by eight bytes at a time into less, equal and greater,
the equal part goes on with the next eight bytes, and small slices are finished by a plain sort of those
columns of bytes. Equal runs are the terms; the sort keeps the order of the text, so that within a run documents and
sources come in order, and one comparison with the neighbour gives document frequency and occurrences by source. Only these
counts leave the task and are added up by Spark.

Shares are integers (``share``), computed by long division in steps that no long overflows.
Distances between all sources of a language are summed by shards of its terms, each of bounded size:
every shard gives the sum for each pair over its own terms, and the sums are added up. The result holds
a row for each pair; nothing else is ever paired.

Rows: null text, lang and source count as ''. Every row is a document, repeated ones too; ids are not read, so that
null or repeated ids change nothing. A group without a kept term takes part with the share its absence of occurrences
gives; a language without a kept term has distances 0 and no term rows. Ties rank by item. Other columns are ignored.
An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from payguard.llm.common import documents, stored

# What a term is made of (all but these bytes), and how shares and ranks are formed.
LEAST_DOCS, SMOOTHING, UNIT, TERM_RANKS = 30, 5, 1_000_000_000, 50
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
SHARD_BYTES = 16 << 20
SMALL = 1_024  # pointers a plain sort finishes
PLAIN_BYTES = 64  # and the most bytes it looks at
SHARD_ROWS = 200_000  # counts of one language in a task
CELLS = 2_000_000  # numbers in a block of shares

_IN_TERM = np.array([b >= 0x80 or chr(b).isalpha() for b in range(256)])
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


class Pointers:
    """Places in a buffer where terms start, and their lengths in bytes."""

    def __init__(self, data: np.ndarray, ends: np.ndarray):
        """``data``: the texts one after the other; ``ends``: where each ends."""
        self.data = np.concatenate([_LOWER[data], np.zeros(8, np.uint8)])
        inside = _IN_TERM[data]
        opens = np.zeros(len(data) + 1, bool)
        opens[np.r_[0, ends]] = True  # a text starts or ends here
        first = inside & (opens[:-1] | ~np.r_[False, inside[:-1]])
        last = inside & (opens[1:] | ~np.r_[inside[1:], False])
        self.start = np.flatnonzero(first)
        self.length = np.flatnonzero(last) + 1 - self.start
        self.eight = np.ndarray((len(data) + 1,), ">u8", self.data.data, strides=(1,))

    def column(self, which: np.ndarray, depth: int) -> np.ndarray:
        """Eight bytes of each term from ``depth`` on as a number; beyond its end zeros, which no term holds."""
        left = np.clip(self.length[which] - depth, 0, 8)
        at = np.where(left > 0, self.start[which] + depth, 0)
        mask = np.r_[np.uint64(0), np.uint64(0xFFFFFFFFFFFFFFFF) << np.arange(56, -1, -8, dtype=np.uint64)]
        return self.eight[at].astype(np.uint64) & mask[left]

    def sort(self) -> tuple[np.ndarray, np.ndarray]:
        """Order of the pointers by term, those of equal terms by place, and where each run of equal terms starts."""
        order = np.arange(len(self.start))
        opens = np.zeros(len(order) + 1, bool)
        todo = [(0, len(order), 0, self.column(order, 0))] if len(order) else []
        while todo:
            lo, hi, depth, keys = todo.pop()
            part = order[lo:hi]
            opens[lo] = True
            if hi - lo == 1:
                continue
            if hi - lo <= SMALL:
                longest = int(self.length[part].max())
                if longest - depth <= PLAIN_BYTES:
                    columns = [keys, *(self.column(part, d) for d in range(depth + 8, longest, 8))]
                    by = np.lexsort(columns[::-1])
                    order[lo:hi] = part[by]
                    for c in columns:
                        opens[lo + 1 : hi] |= np.diff(c[by]) != 0
                    continue
            sample = np.sort(keys[:: max(1, len(keys) // 31)])
            pivot = sample[len(sample) // 2]
            less, equal = keys < pivot, keys == pivot
            greater = ~(less | equal)
            a, b = lo + int(less.sum()), hi - int(greater.sum())
            order[lo:hi] = np.concatenate([part[less], part[equal], part[greater]])
            if a > lo:
                todo.append((lo, a, depth, keys[less]))
            if b < hi:
                todo.append((b, hi, depth, keys[greater]))
            opens[a] = True
            if pivot & np.uint64(255):  # the terms may go on
                todo.append((a, b, depth + 8, self.column(order[a:b], depth + 8)))
        return order, np.flatnonzero(opens[:-1])


def shard_counts(data: np.ndarray, ends: np.ndarray, group: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms of a shard, and for each term and group that has it: term, group, documents, occurrences.

    ``group`` numbers the texts' groups and does not fall along the texts.
    """
    pointers = Pointers(data, ends)
    order, runs = pointers.sort()
    if not len(order):
        none = np.zeros(0, np.int64)
        return [], none, none, none, none
    text = np.searchsorted(ends, pointers.start, side="right")[order]
    run = np.zeros(len(order), np.int64)
    run[runs[1:]] = 1
    run = np.cumsum(run)
    new_run = np.r_[True, np.diff(run) != 0]
    new_text = new_run | np.r_[True, np.diff(text) != 0]
    new_group = new_run | np.r_[True, np.diff(group[text]) != 0]
    at = np.flatnonzero(new_group)
    n = np.diff(np.r_[at, len(order)])
    docs = np.add.reduceat(new_text.astype(np.int64), at)
    head = order[runs]
    whole = pointers.data.tobytes()
    terms = [whole[s : s + k] for s, k in zip(pointers.start[head].tolist(), pointers.length[head].tolist(), strict=True)]
    return terms, run[at], group[text[at]], docs, n


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Whole documents of some ``SHARD_BYTES``, a longer document in a shard of its own size."""
    held, size = [], 0
    for batch in batches:
        ends = np.cumsum(batch["n"].to_numpy())
        at = 0
        while at < batch.num_rows:
            before = int(ends[at - 1]) if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, before + SHARD_BYTES - size, side="right")))
            held.append(batch.slice(at, stop - at))
            size += int(ends[stop - 1]) - before
            at = stop
            if size >= SHARD_BYTES or stop < batch.num_rows:
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``lang, source, term, docs, n``: documents and occurrences by group and term."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in _shards(batches):
            shard = shard.drop_columns("n").sort_by([("lang", "ascending"), ("source", "ascending")]).combine_chunks()
            lang, source = shard["lang"].combine_chunks(), shard["source"].combine_chunks()
            names = pd.MultiIndex.from_arrays([lang.to_pandas(), source.to_pandas()])
            group, found = pd.factorize(names)
            text = shard["t"].combine_chunks()
            data = np.concatenate([np.zeros(0, np.uint8), *(_bytes(c) for c in (text.chunks if isinstance(text, pa.ChunkedArray) else [text]))])
            sizes = np.asarray(pa.compute.binary_length(text)).astype(np.int64)
            terms, term, of, documents_, n = shard_counts(data, np.cumsum(sizes), group)
            words = pa.array(terms, pa.binary()).cast(pa.string())
            for at in range(0, len(term), 100_000):
                cut = slice(at, at + 100_000)
                first = of[cut]
                yield pa.RecordBatch.from_arrays([
                    pa.array([x[0] for x in found]).cast(pa.string()).take(pa.array(first)), pa.array([x[1] for x in found]).cast(pa.string()).take(pa.array(first)),
                    words.take(pa.array(term[cut])), pa.array(documents_[cut]), pa.array(n[cut])], ["lang", "source", "term", "docs", "n"])

    t = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(blank(lang_col).alias("lang"), blank(source_col).alias("source"), t.alias("t"), F.octet_length(t).cast("long").alias("n"))
    return rows.mapInArrow(run, "lang string, source string, term string, docs long, n long").groupBy("lang", "source", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("n"))


def _bytes(text: pa.Array) -> np.ndarray:
    """The bytes of a string array as they lie in its Arrow buffer."""
    offsets = np.frombuffer(text.buffers()[1], np.int32 if pa.types.is_string(text.type) else np.int64)[text.offset : text.offset + len(text) + 1]
    data = text.buffers()[2]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)


def share(count: Column, all_terms: Column, v: Column) -> Column:
    """1 + floor(UNIT * (count + 5) / (all_terms + 5 v)), exact: three decimal digits of the quotient at a time."""
    above, below = count + SMOOTHING, all_terms + SMOOTHING * v
    div = lambda a: F.call_function("div", a, below)
    whole, rest = div(above), above % below
    for _ in range(3):
        whole, rest = whole * 1_000 + div(rest * 1_000), (rest * 1_000) % below
    return whole + 1


def pair_sums(source: np.ndarray, term: np.ndarray, p: np.ndarray, absent: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For each source the sum of |p - q| to every source over the terms given.

    ``absent``: by source the share of a term it lacks. Sources and terms are numbered from 0.
    """
    n, terms = len(absent), int(term.max()) + 1 if len(term) else 0
    by = np.argsort(term, kind="stable")
    source, term, p = source[by], term[by], p[by]
    width = height = max(1, CELLS // max(1, n))
    for top in range(0, n, height):
        sums = np.zeros((min(height, n - top), n), np.int64)
        for left in range(0, terms, width):
            a, b = np.searchsorted(term, [left, left + width])
            block = np.repeat(absent[:, None], min(width, terms - left), 1)
            block[source[a:b], term[a:b] - left] = p[a:b]
            for i in range(len(sums)):
                sums[i] += np.abs(block - block[top + i]).sum(1)
        for i, row in enumerate(sums):
            yield top + i, row


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least_docs: int = LEAST_DOCS, term_ranks: int = TERM_RANKS) -> DataFrame:
    """``lang, source, part, item, value, rank``: part ``pair`` ranks the other sources of the language by their
    distance, part ``term`` the terms a source has more of than its language."""
    counts = stored(term_counts(docs, text_col, lang_col, source_col), "term-counts")
    by_term = Window.partitionBy("lang", "term")
    kept = stored(counts.withColumn("df", F.sum("docs").over(by_term)).withColumn("m", F.sum("n").over(by_term))
                  .where(F.col("df") >= least_docs).select("lang", "source", "term", "n", "m"), "kept-terms", counts)
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    groups = docs.select(blank(lang_col).alias("lang"), blank(source_col).alias("source")).distinct()
    sizes = kept.groupBy("lang", "source").agg(F.sum("n").alias("in_group"))
    langs = kept.groupBy("lang").agg(F.count_if(F.col("n") > 0).alias("entries"), F.sum("n").alias("in_lang"))
    langs = langs.join(kept.select("lang", "term").distinct().groupBy("lang").agg(F.count("*").alias("v")), "lang")
    groups = stored(groups.join(sizes, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0, ["in_group", "in_lang", "v", "entries"]), "term-groups")

    # a kept term's share in its group and its language
    shares = kept.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "v", "entries", share(F.col("n"), F.col("in_group"), F.col("v")).alias("p"), share(F.col("m"), F.col("in_lang"), F.col("v")).alias("q"))
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    above = shares.where(F.col("p") > F.col("q")).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    above = above.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= term_ranks)

    n_shards = F.ceil(F.greatest(F.col("entries"), F.lit(1)) / SHARD_ROWS).cast("int")
    lacking = F.when(F.col("v") > 0, share(F.lit(0), F.col("in_group"), F.when(F.col("v") > 0, F.col("v")).otherwise(1))).otherwise(0)
    heads = groups.select("lang", "source", F.lit(None).cast("string").alias("term"), lacking.alias("p"), F.explode(F.sequence(F.lit(0), n_shards - 1)).alias("shard"))
    entries = shares.select("lang", "source", "term", "p", F.pmod(F.xxhash64("term"), n_shards).cast("int").alias("shard"))

    def distances(key: tuple[Any, ...], frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(frames))
        head = rows["term"].isna()
        sources = pd.Index(rows.loc[head, "source"].sort_values())
        absent = rows.loc[head].set_index("source")["p"].reindex(sources).to_numpy(np.int64)
        rows = rows.loc[~head]
        for i, sums in pair_sums(sources.get_indexer(rows["source"]), pd.factorize(rows["term"])[0], rows["p"].to_numpy(np.int64), absent):
            others = np.arange(len(sources)) != i
            yield pd.DataFrame({"lang": key[0], "source": sources[i], "item": sources[others], "value": sums[others]})

    sums = heads.unionByName(entries).groupBy("lang", "shard").applyInPandas(distances, "lang string, source string, item string, value long")
    pairs = sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    return pairs.withColumn("rank", F.row_number().over(ranked)).unionByName(above)


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(documents(spark, sf_dir))


def _share_sql(count: str, all_terms: str, v: str) -> str:
    return f"cast(1 + cast({UNIT} as hugeint) * ({count} + {SMOOTHING}) // ({all_terms} + {SMOOTHING} * {v}) as bigint)"


SQL = rf"""with d as (select row_number() over () as r, coalesce(text, '') as text, coalesce(lang, '') as lang, coalesce(source, '') as source from documents),
w as (select r, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{TERM}')) as term from d),
t as materialized (select lang, source, term, count(*) as n, count(distinct r) as docs from w group by all),
k as materialized (select lang, term, sum(n) as m from t group by all having sum(docs) >= {LEAST_DOCS}),
l as materialized (select lang, count(*) as v, sum(m) as nl from k group by lang),
g as materialized (select lang, source, coalesce(v, 0) as v, coalesce(nl, 0) as nl, coalesce((select sum(n) from t join k using (lang, term) where t.lang = x.lang and t.source = x.source), 0) as gn
  from (select distinct lang, source from d) x left join l using (lang)),
p as materialized (select g.lang, g.source, k.term, coalesce(t.n, 0) as n, {_share_sql('coalesce(t.n, 0)', 'gn', 'v')} as p, {_share_sql('m', 'nl', 'v')} as q
  from g join k using (lang) left join t on t.lang = g.lang and t.source = g.source and t.term = k.term),
pair as (select a.lang, a.source, b.source as item, cast(coalesce(s.f, 0) as bigint) as value
  from g a join g b on a.lang = b.lang and a.source <> b.source
  left join (select x.lang, x.source, y.source as other, sum(abs(x.p - y.p)) as f from p x join p y on x.lang = y.lang and x.term = y.term and x.source <> y.source group by all) s
    on s.lang = a.lang and s.source = a.source and s.other = b.source),
term as (select lang, source, term as item, p - q as value from p where n > 0 and p > q)
select lang, source, 'pair' as part, item, value, cast(row_number() over (partition by lang, source order by value desc, encode(item)) as integer) as rank from pair
union all
select * from (select lang, source, 'term' as part, item, value, cast(row_number() over (partition by lang, source order by value desc, encode(item)) as integer) as rank from term) where rank <= {TERM_RANKS}"""
