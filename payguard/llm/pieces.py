"""SentencePiece encoding and decoding of merge-type models, exact and by backtracking.

An encoding by merges is the one sequence of pieces in which every two neighbours, merged
anew from their characters, come out as the same two pieces. So the encoder walks a stretch
of text with the longest piece an Aho-Corasick automaton finds at each place, accepts it when
it agrees with its left neighbour, and else tries the next shorter one or steps back; a bit
field keeps the places from which no encoding goes on, so none is tried twice. A stretch is
what no merge can cross: a word with the spaces before it, where no piece has a space behind
another character. Runs of spaces, whose pieces share one score, are merged directly.

Rows are independent: one Arrow pass, no shuffle. The model (some 500 KB) is read by the
driver and travels with the function. A worker remembers the stretches it has met, a bounded
number of them.
"""

from __future__ import annotations

import array
import hashlib
import heapq
import re
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payguard.llm.common import documents, null_id, whole_id

SPACE = "▁"
# Fixed values of the model format: piece types, and the fields of the normaliser.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
CACHE = 250_000  # stretches a worker keeps, some 60 MB; longer ones than LONG are not kept
LONG = 64
AGREES = 2_000_000  # pairs of pieces a worker remembers, some 200 MB at most
ROWS = 256  # documents encoded before their results are handed on


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Fields of one protocol-buffer message: number and value."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        else:
            n = {1: 8, 5: 4}.get(kind) or varint()
            yield tag >> 3, data[at : at + n]
            at += n


class _Known(dict):
    """Ids of the stretches met, of bounded size: emptied when full."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, stretch: str) -> bytes:
        ids = self.encode(stretch)
        if len(stretch) <= LONG:
            if len(self) >= CACHE:
                self.clear()
            self[stretch] = ids
        return ids


class PieceModel:
    """A merge-type SentencePiece model: vocabulary, encoder, decoder."""

    def __init__(self, data: bytes):
        self.pieces: list[tuple[str, float, int]] = []
        self.kind, dummy, squeeze, escape, charsmap = 1, True, True, True, b""
        for field, value in _fields(data):
            if field == 1:
                piece = {1: b"", 2: b"\0\0\0\0", 3: NORMAL} | dict(_fields(value))
                self.pieces.append((piece[1].decode(), struct.unpack("<f", piece[2])[0], piece[3]))
            elif field == 2:
                self.kind = dict(_fields(value)).get(3, 1)
            elif field == 3:
                spec = dict(_fields(value))
                charsmap, dummy, squeeze, escape = spec.get(2, b""), spec.get(3, 1), spec.get(4, 1), spec.get(5, 1)
        types = {t for _, _, t in self.pieces}
        if self.kind != 2 or charsmap or squeeze or not escape or not dummy or types & {USER_DEFINED, UNUSED} or BYTE not in types:
            raise ValueError("a merge-type model without normalisation, with dummy prefix and byte pieces is needed")
        self.ids = {p: i for i, (p, _, t) in enumerate(self.pieces) if t == NORMAL}
        self.score = {p: self.pieces[i][1] for p, i in self.ids.items()}
        self.byte = {int(p[3:5], 16): i for i, (p, _, t) in enumerate(self.pieces) if t == BYTE}
        control = {p: i for i, (p, _, t) in enumerate(self.pieces) if t == CONTROL}
        self.bos, self.eos = control.get("<s>"), control.get("</s>")
        self.whole_words = not any(SPACE in p.lstrip(SPACE) for p in self.ids)
        self.raw = [b"" if t == CONTROL else bytes([int(p[3:5], 16)]) if t == BYTE else " ⁇ ".encode() if t == UNKNOWN
                    else p.replace(SPACE, " ").encode() for p, _, t in self.pieces]
        # a line break no piece holds ends a stretch as well, which makes for more equal ones
        lines = not any("\n" in p for p in self.ids)
        self.stretch = re.compile(("\n| *[^ \n]+| +" if lines else " *[^ ]+| +") if self.whole_words else ".+", re.S)
        chars = "".join(map(re.escape, (p for p in self.ids if len(p) == 1)))
        self.runs = re.compile(f"[{chars}]+|[^{chars}]", re.S)
        self.longest = max(map(len, self.ids))
        self.agrees: dict[int, bool] = {}  # pairs of pieces, up to AGREES of them: some 10^5 in practice
        self.splits: dict[int, tuple[int, int] | None] = {}
        self.length = [len(p) for p, _, _ in self.pieces]
        self.path: dict[str, int] = {}
        self.shorter: dict[int, int] = {}
        self.known = _Known(self._encode)
        self._automaton = None

    @property
    def automaton(self):
        if self._automaton is None:
            import ahocorasick

            self._automaton = ahocorasick.Automaton()
            for piece in self.ids:
                self._automaton.add_word(piece, len(piece))
            self._automaton.make_automaton()
            # the longest piece that begins each path of the automaton, and that begins each piece
            for piece, i in sorted(self.ids.items(), key=lambda x: len(x[0])):
                self.shorter[i] = next((self.ids[piece[:n]] for n in range(len(piece) - 1, 0, -1) if piece[:n] in self.ids), -1)
                for n in range(len(piece), 0, -1):
                    if n < len(piece) and piece[:n] in self.ids:
                        break
                    self.path.setdefault(piece[:n], i if n == len(piece) else self.shorter[i])
        return self._automaton

    def merged(self, text: str, stop: str | None = None) -> list[str]:
        """The pieces by plain merging: best score first, the left one of equal scores.
        ``stop`` is a piece whose merge is not carried out."""
        parts: list[str | None] = list(text)
        left, right = list(range(-1, len(parts) - 1)), list(range(1, len(parts) + 1))
        heap: list[tuple[float, int, int, str]] = []

        def offer(i: int, j: int) -> None:
            if i >= 0 and j < len(parts):
                both = parts[i] + parts[j]
                if both in self.score:
                    heapq.heappush(heap, (-self.score[both], i, j, both))

        for i in range(len(parts) - 1):
            offer(i, i + 1)
        while heap:
            _, i, j, both = heapq.heappop(heap)
            if parts[i] is None or parts[j] is None or right[i] != j or parts[i] + parts[j] != both or both == stop:
                continue
            parts[i], parts[j] = both, None
            right[i] = right[j]
            if right[j] < len(parts):
                left[right[j]] = i
            offer(left[i], i)
            offer(i, right[i])
        return [p for p in parts if p is not None]

    def _split(self, i: int) -> tuple[int, int] | None:
        """The two pieces whose merge makes piece ``i``; None for a character, (-1, -1) if merging
        the characters of the piece ends elsewhere or in an order other than that of the scores."""
        if i not in self.splits:
            piece = self.pieces[i][0]
            split = None
            if len(piece) > 1:
                split = (-1, -1)
                last = self.merged(piece, stop=piece)
                if len(last) == 2:
                    parts = tuple(map(self.ids.__getitem__, last))
                    grown = [p for p in parts if len(self.pieces[p][0]) > 1]
                    if all(self.pieces[p][1] >= self.pieces[i][1] and self._split(p) != (-1, -1) for p in grown):
                        split = parts
            self.splits[i] = split
        return self.splits[i]

    def _agree(self, a: int, b: int) -> bool:
        """Whether two neighbours, merged anew from their characters, stay these two.

        The merges of both are undone from the last to the first; at each step the two pieces at
        the border must not have been due for merging before one of them was used up. Pieces
        that don't follow the order of scores are merged in full. ``a`` is -1 at the start.
        """
        pieces = self.pieces
        x, y = a, b
        sx, sy = self._split(a) if a >= 0 else None, self._split(b)
        if (-1, -1) in (sx, sy):
            whole = [pieces[i][0] for i in (a, b) if i >= 0]
            return self.merged("".join(whole)) == whole
        if a < 0:
            return True
        used_x = used_y = float("-inf")  # score of the merge that used up the piece
        while True:
            both = self.score.get(pieces[x][0] + pieces[y][0])
            if both is not None and both > used_x and both >= used_y:
                return False
            if sx is None and sy is None:
                return True
            if sy is not None and (sx is None or pieces[y][1] <= pieces[x][1]):
                used_y, y = pieces[y][1], sy[0]
                sy = self._split(y)
            else:
                used_x, x = pieces[x][1], sx[1]
                sx = self._split(x)

    def backtrack(self, text: str) -> list[int]:
        """Ids of a text whose characters are all pieces."""
        n, most, prefix = len(text), self.longest, self.automaton.longest_prefix
        paths, shorter, length, agrees = self.path, self.shorter, self.length, self.agrees
        failed = bytearray((n >> 3) + 1)  # a bit a place from which no encoding goes on
        out: list[int] = []
        at, before = 0, -1
        piece = paths[text[: prefix(text[:most])]]
        while at < n:
            while piece >= 0:
                end = at + length[piece]
                if not failed[end >> 3] >> (end & 7) & 1:
                    key = (before << 32) + piece
                    agree = agrees.get(key)
                    if agree is None:
                        if len(agrees) >= AGREES:
                            agrees.clear()
                        agree = agrees[key] = self._agree(before, piece)
                    if agree:
                        break
                piece = shorter[piece]
            if piece >= 0:
                out.append(piece)
                before, at = piece, end
                if at < n:
                    ahead = text[at : at + most]
                    piece = paths[ahead[: prefix(ahead)]]
            else:
                failed[at >> 3] |= 1 << (at & 7)
                last = out.pop()
                at -= length[last]
                piece = shorter[last]
                before = out[-1] if out else -1
        return out

    def _encode(self, stretch: str) -> bytes:
        out: list[int] = []
        for part in self.runs.findall(stretch.replace(" ", SPACE)):
            if part[0] not in self.ids:
                out += map(self.byte.__getitem__, part.encode())
            elif not self.whole_words or part.startswith(SPACE * 2):
                out += map(self.ids.__getitem__, self.merged(part))
            else:
                out += self.backtrack(part)
        return struct.pack(f"<{len(out)}I", *out)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers, without begin and end."""
        if not text:
            return b""
        text = " " + text.replace(SPACE, " ")
        return b"".join(map(self.known.__getitem__, self.stretch.findall(text)))

    def decode(self, ids) -> str:
        """Text of ids; control ids give nothing, the space set before the text goes."""
        text = b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


_MODELS: dict[bytes, PieceModel] = {}


def model_of(data: bytes) -> PieceModel:
    """The model, built once in a worker."""
    key = hashlib.sha256(data).digest()
    if key not in _MODELS:
        _MODELS.clear()
        _MODELS[key] = PieceModel(data)
    return _MODELS[key]


def encode_documents(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids array<int>, decoded`` of every row, with begin and end ids.

    A null text is encoded like an empty one: begin and end, decoded to an empty text. Equal
    rows give equal results; other columns are ignored; an empty table gives an empty result.
    """
    return _per_row(docs, model_path, id_col, text_col, "doc_id long, ids array<int>, decoded string", lambda ids, text: {
        "ids": [np.frombuffer(x, "<i4") for x in ids], "decoded": text})


def digest_documents(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: like ``encode_documents``, but digests
    in place of ids and texts, so that little leaves the workers."""
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return _per_row(docs, model_path, id_col, text_col, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", lambda ids, text: {
        "n_tokens": [len(x) // 4 for x in ids], "ids_sha256": [sha(x) for x in ids],
        "decoded_sha256": [sha(t.encode()) for t in text]})


def _per_row(docs: DataFrame, model_path: str, id_col: str, text_col: str, schema: str, columns) -> DataFrame:
    with open(model_path, "rb") as f:  # a file of the driver, as a parameter
        data = f.read()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = model_of(data)
        begin, end = struct.pack("<I", model.bos), struct.pack("<I", model.eos)
        for frame in frames:
            for at in range(0, len(frame), ROWS):
                part = frame.iloc[at : at + ROWS]
                ids = [begin + model.encode(t or "") + end for t in part["t"]]
                text = [model.decode(array.array("I", x)) for x in ids]
                yield pd.DataFrame({"doc_id": part["i"].to_numpy()} | columns(ids, text))

    out = docs.select(whole_id(id_col).alias("i"), F.col(text_col).alias("t")).mapInPandas(run, schema)
    return out.select(null_id("doc_id"), *out.columns[1:])


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_documents(documents(spark, sf_dir), model_path())
