"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads windows of 128 bytes in both directions, labels every position, and a
document's probabilities are the mean over all positions of its whole text. It is trained in
numpy by back-propagation through time on a bounded sample; prediction is one Arrow pass in
which all windows of a batch of documents advance together, no shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from payguard.llm.common import documents, text_of

UNKNOWN = "und"
# Usual bounds of the training sample: documents a language, and code points of each.
SAMPLE_DOCS, SAMPLE_CHARS = 400, 1_200
HIDDEN, WINDOW = 8, 128
TRAIN_WINDOW, TRAIN_BATCH, STEPS, RATE = 64, 128, 260, 0.02
LANES = 2_048  # windows that advance together
PART_DOCS, PART_CHARS = 256, 1 << 20  # documents whose windows are laid out at once, and code points after which no further one joins them
_LETTER = re.compile(r"[^\W\d_]")


class ByteGru:
    """Parameters of both directions and the position labels; gates in the order update, reset, candidate."""

    def __init__(self, classes: list[str], hidden: int = HIDDEN, seed: int = 7):
        rng = np.random.default_rng(seed)
        f32 = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        self.classes, self.hidden = classes, hidden
        self.p = {"out": f32(len(classes), 2 * hidden, scale=0.2), "bias": np.zeros((len(classes), 1), np.float32)}
        for d in "fb":
            self.p[f"x{d}"] = f32(3 * hidden, 256, scale=0.3)
            self.p[f"u{d}"] = f32(3 * hidden, hidden, scale=hidden**-0.5)

    @staticmethod
    def _sigmoid(a: np.ndarray) -> np.ndarray:
        a *= 0.5
        np.tanh(a, out=a)
        a *= 0.5
        a += 0.5
        return a

    def _step(self, d: str, byte: np.ndarray, h: np.ndarray):
        n = self.hidden
        x, m = self.p[f"x{d}"][:, byte], self.p[f"u{d}"] @ h
        gate = x[: 2 * n]
        gate += m[: 2 * n]
        self._sigmoid(gate)
        c = m[2 * n :] * gate[n:]
        c += x[2 * n :]
        np.tanh(c, out=c)
        return gate, m[2 * n :], c

    def states(self, windows: np.ndarray, mask: np.ndarray, keep: bool = False):
        """Hidden states by position, both directions: (time, 2 * hidden, lanes). Padded places keep none."""
        time, lanes = windows.shape
        n = self.hidden
        out = np.zeros((time, 2 * n, lanes), np.float32)
        kept: dict[str, list] = {"f": [], "b": []}
        for d, order, at in (("f", range(time), slice(0, n)), ("b", range(time - 1, -1, -1), slice(n, 2 * n))):
            h = np.zeros((n, lanes), np.float32)
            for t in order:
                gate, mc, c = self._step(d, windows[t], h)
                new = h - c
                new *= gate[:n]
                new += c
                new *= mask[t]
                out[t, at] = new
                if keep:
                    kept[d].append((t, h, gate, mc, c))
                h = new
        return (out, kept) if keep else out

    def positions(self, states: np.ndarray) -> np.ndarray:
        """Class probabilities at every position: (time, classes, lanes)."""
        logits = self.p["out"] @ states
        logits += self.p["bias"]
        logits -= logits.max(axis=1, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=1, keepdims=True)
        return logits

    def gradients(self, windows: np.ndarray, mask: np.ndarray, target: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross entropy over positions, and its gradient through time."""
        time, lanes = windows.shape
        n, n_classes = self.hidden, len(self.classes)
        states, kept = self.states(windows, mask, keep=True)
        prob = self.positions(states)
        total = max(1.0, float(mask.sum()))
        lane = np.arange(lanes)
        loss = float(-(np.log(prob[:, target, lane] + 1e-9) * mask).sum() / total)
        dz = prob.copy()
        dz[:, target, lane] -= 1
        dz *= mask[:, None, :] / total
        flat = lambda a: a.transpose(1, 0, 2).reshape(a.shape[1], -1)
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        g["out"] = flat(dz) @ flat(states).T
        g["bias"] = dz.sum(axis=(0, 2)).reshape(n_classes, 1)
        dstates = self.p["out"].T @ dz
        for d, at in (("f", slice(0, n)), ("b", slice(n, 2 * n))):
            u = self.p[f"u{d}"]
            carried = np.zeros((n, lanes), np.float32)
            for t, h, gate, mc, c in reversed(kept[d]):
                dh = (dstates[t, at] + carried) * mask[t]
                z, r = gate[:n], gate[n:]
                dc = dh * (1 - z) * (1 - c * c)
                da = np.concatenate([dh * (h - c) * z * (1 - z), dc * mc * r * (1 - r), dc])
                dm = np.concatenate([da[: 2 * n], dc * r])
                g[f"u{d}"] += dm @ h.T
                for row in range(3 * n):
                    g[f"x{d}"][row] += np.bincount(windows[t], da[row], 256)
                carried = dh * z + u.T @ dm
        return loss, g


def _windows(data: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all documents cut into windows: (time, lanes) bytes, mask, and each lane's document."""
    counts = [-(-len(b) // size) for b in data]
    lanes = sum(counts)
    flat, length = np.zeros((lanes, size), np.uint8), np.zeros(lanes, np.int64)
    owner = np.repeat(np.arange(len(data)), counts)
    at = 0
    for b, n in zip(data, counts, strict=True):
        if n:
            flat[at : at + n].reshape(-1)[: len(b)] = np.frombuffer(b, np.uint8)
            length[at : at + n] = size
            length[at + n - 1] = len(b) - (n - 1) * size
            at += n
    mask = (np.arange(size)[:, None] < length[None, :]).astype(np.float32)
    return np.ascontiguousarray(flat.T), mask, owner


def fit(texts: list[str], labels: list[str], steps: int = STEPS, seed: int = 11) -> ByteGru | None:
    """Trained network, or None without labelled texts. Languages weigh alike; order and seed fix the result."""
    classes = sorted(set(labels))
    if not classes:
        return None
    model = ByteGru(classes)
    windows, mask, owner = _windows([t.encode() for t in texts], TRAIN_WINDOW)
    target = np.array([classes.index(x) for x in labels])[owner]
    pools = [p for p in (np.flatnonzero(target == i) for i in range(len(classes))) if len(p)]
    if not pools:
        return None
    rng = np.random.default_rng(seed)
    first = {k: np.zeros_like(v) for k, v in model.p.items()}
    second = {k: np.zeros_like(v) for k, v in model.p.items()}
    for step in range(1, steps + 1):
        pick = np.concatenate([rng.choice(p, max(1, TRAIN_BATCH // len(pools))) for p in pools])
        _, g = model.gradients(windows[:, pick], mask[:, pick], target[pick])
        norm = float(np.sqrt(sum((v * v).sum() for v in g.values())))
        rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
        for k, v in g.items():
            v = v * min(1.0, 1.0 / (norm + 1e-9))
            first[k] = 0.9 * first[k] + 0.1 * v
            second[k] = 0.99 * second[k] + 0.01 * v * v
            model.p[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-6)
            model.p[k] = model.p[k].astype(np.float32)
    return model


def probabilities(model: ByteGru, texts: list[str | None]) -> np.ndarray:
    """Pooled class probabilities of each whole text; zeros where there is no byte."""
    data = [(t or "").encode() for t in texts]
    sums = np.zeros((len(data), len(model.classes)))
    counts = np.array([max(1, len(b)) for b in data], np.float64)
    windows, mask, owner = _windows(data, WINDOW)
    for at in range(0, len(owner), LANES):
        part = slice(at, at + LANES)
        m = mask[:, part]
        prob = model.positions(model.states(windows[:, part], m))
        prob *= m[:, None, :]
        np.add.at(sums, owner[part], prob.sum(axis=0, dtype=np.float64).T)
    return sums / counts[:, None]


def label_positions(model: ByteGru, text: str) -> list[str]:
    """The language at each byte of a text."""
    windows, mask, _ = _windows([text.encode()], WINDOW)
    best = model.positions(model.states(windows, mask)).argmax(axis=1)
    return [model.classes[i] for i in best.T.reshape(-1)[: len(text.encode())]]


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a row is never learned from: the checksum of its id as text leaves 0 modulo 5. A null id is "" here."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def sample(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
           sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS) -> list:
    """At most ``sample_docs`` labelled documents a language that are not held out, ``sample_chars`` code points of each
    from a place its hash names: those with the least hashes of id and text, so reruns agree. Rows equal in both are one."""
    rows = docs.where(~held_out(id_col)).where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    h = F.pmod(F.xxhash64(F.lit("sample"), F.col(id_col), F.col(text_col)), F.lit(1 << 40))
    rows = rows.select(F.col(lang_col).alias("lang"), h.alias("h"), F.col(text_col).alias("text"))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).collect()}
    if not counts:
        return []
    share = F.lit(0.0)
    for lang, n in counts.items():  # a language a row: labels are few
        share = F.when(F.col("lang") == lang, min(1.0, 2 * sample_docs / n)).otherwise(share)
    start = 1 + F.pmod(F.col("h"), F.greatest(F.char_length("text") - sample_chars, F.lit(1)))
    near = rows.where(F.col("h") < share * float(1 << 40)).select(
        "lang", "h", F.substring(F.col("text"), start.cast("int"), F.lit(sample_chars)).alias("text"))
    near = near.groupBy("lang", "h").agg(F.min("text").alias("text"))
    taken: dict[str, list] = {}
    for r in sorted(near.collect(), key=lambda r: (r["lang"], r["h"])):  # some 2 * sample_docs a language
        if len(taken.setdefault(r["lang"], [])) < sample_docs:
            taken[r["lang"]].append(r)
    return [r for rows in taken.values() for r in rows]


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS) -> ByteGru | None:
    """A network fitted to ``sample``; None where nothing can be learned."""
    rows = sample(docs, id_col, text_col, lang_col, sample_docs, sample_chars)
    return fit([r["text"] for r in rows], [r["lang"] for r in rows])


def _parts(texts: list, some: list[int]) -> Iterator[list[int]]:
    """The places ``some`` in parts of bounded size; a longer text is a part of its own or the last of one."""
    part, size = [], 0
    for i in some:
        part.append(i)
        size += len(texts[i])
        if len(part) == PART_DOCS or size >= PART_CHARS:
            yield part
            part, size = [], 0
    if part:
        yield part


def predict(docs: DataFrame, model: ByteGru | None, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` plus ``lang_pred`` and ``score``, the pooled probability of that language.

    A text that is null or has no letter is ``und`` with score 0, as is every text if nothing
    was learned. Columns named like the new ones are replaced. Ties go to the first language in order. Equal texts get
    equal labels, each repeated row its own; an empty table gives an empty result.
    """
    keep = [f for f in docs.schema.fields if f.name not in ("lang_pred", "score")]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in keep), "lang_pred string", "score double"])

    def run(frames: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in frames:
            texts = batch.column(text_col).to_pylist()
            known = [bool(model and t and _LETTER.search(t)) for t in texts]
            names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
            some = [i for i, k in enumerate(known) if k]
            for part in _parts(texts, some):
                for i, p in zip(part, probabilities(model, [texts[i] for i in part]), strict=True):
                    names[i], scores[i] = model.classes[int(p.argmax())], min(1.0, float(p.max()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names), pa.array(scores)], [*batch.schema.names, "lang_pred", "score"])

    return docs.select(*[F.col(f"`{f.name}`") for f in keep]).mapInArrow(run, schema)


def lettered(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows whose text has a letter; a null text has none."""

    def run(frames: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in frames:
            yield batch.filter(pa.array([bool(t and _LETTER.search(t)) for t in batch.column(text_col).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = predict(docs.select("doc_id", text_of("text").alias("text")), train(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
