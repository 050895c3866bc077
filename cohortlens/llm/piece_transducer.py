"""SentencePiece encoding and decoding by a weighted finite-state transducer (operator 3).

The model file is compiled into three transducers: the normaliser (a space prefix, spaces written as U+2581), the
pieces (a trie automaton with an arc for every piece) and byte fallback (for a character that no piece holds, its
UTF-8 bytes, at a cost). A fourth, over pairs of pieces, accepts a pair at cost 0 if merging its text gives that pair
back, and at infinite cost otherwise. A segmentation by merges is the one whose neighbouring pieces all have that
property, so the shortest path of the composition in the tropical semiring (min, +) is the model's own
segmentation. Pair costs are worked out when a pair is first met and kept.

No piece crosses from text into a space mark, over a line feed, or from a letter to another character (this is checked
when the model is compiled), so a text is cut there and each stretch is composed on its own, and the results of recent stretches are kept in a bounded cache.

Defined cases: null and empty texts have no ids; U+2581 in a text is read as a space (and decodes to one); repeated
rows are encoded alike; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
_NUMERIC = "²³¹¼½¾"  # word characters that are neither letters nor digits
_LETTERS, _OTHERS = f"[^\\W\\d_{_NUMERIC}]", f"(?:[^\\w{SPACE}\\n]|[\\d_{_NUMERIC}])"
_STRETCH = re.compile(f"{SPACE}*{_OTHERS}*{_LETTERS}+|{SPACE}*{_OTHERS}+|{SPACE}+|\n")
_WHOLE = re.compile(f"{SPACE}*{_OTHERS}*{_LETTERS}*")


def _fields(data: bytes) -> Iterator[tuple[int, bytes | int]]:
    """(number, value) of the fields of a protocol-buffer message."""
    def varint(i: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            c = data[i]
            i += 1
            value |= (c & 127) << shift
            shift += 7
            if c < 128:
                return value, i
    i = 0
    while i < len(data):
        tag, i = varint(i)
        kind = tag & 7
        if kind == 0:
            value, i = varint(i)
        else:
            size, i = (8, i) if kind == 1 else (4, i) if kind == 5 else varint(i)
            value, i = data[i:i + size], i + size
        yield tag >> 3, value


def read_model(path: str) -> list[tuple[str, float, int]]:
    """(piece, score, type) in order of ids; types: 1 ordinary, 2 unknown, 3 control, 6 byte."""
    with open(path, "rb") as f:
        data = f.read()
    out = []
    for number, value in _fields(data):
        if number == 1:
            d = dict(_fields(value))
            out.append((d[1].decode(), struct.unpack("<f", d[2])[0] if 2 in d else 0.0, d.get(3, 1)))
        elif number == 3 and dict(_fields(value)).get(2):
            raise ValueError("only models without a character map in their normaliser are supported")
    return out


class PieceTransducer:
    """Composition of the compiled model with inputs."""

    def __init__(self, path: str, cache: int = 150_000):
        import ahocorasick

        self.pieces = read_model(path)
        self.score = {p: s for p, s, kind in self.pieces if kind == 1}
        self.ids = {p: i for i, (p, _, kind) in enumerate(self.pieces) if kind == 1}
        self.byte_ids = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(self.pieces) if kind == 6}
        crossing = [p for p in self.ids if not _WHOLE.fullmatch(p)]
        if crossing:
            raise ValueError(f"pieces cross the cuts between stretches: {crossing[:3]}")
        self.known = {c for c in self.ids if len(c) == 1}
        self.arcs = ahocorasick.Automaton()
        for p, i in self.ids.items():
            self.arcs.add_word(p, (len(p), i))
        self.arcs.make_automaton()
        self.pair: dict[int, bool] = {}
        self.limit, self.young, self.old = cache, {}, {}
        shown = [p.replace(SPACE, " ").encode() if kind == 1 else bytes([int(p[3:5], 16)]) if kind == 6 else b"" for p, _, kind in self.pieces]
        self.size = np.array([len(s) for s in shown])
        self.at = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(shown), np.uint8)
        self.is_byte = np.array([kind == 6 for _, _, kind in self.pieces])

    def merged(self, text: str) -> list[str]:
        """Segmentation of a short text by the model's merges: best score first, then leftmost."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, 0
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def joins(self, a: int, b: int) -> bool:
        """Whether piece ``b`` may follow piece ``a`` (-1: a boundary that no merge crosses)."""
        key = (a + 1) << 20 | b
        got = self.pair.get(key)
        if got is None:
            if len(self.pair) > 1_000_000:
                self.pair.clear()
            y = self.pieces[b][0]
            x = [self.pieces[a][0]] if a >= 0 else []
            got = self.pair[key] = self.merged("".join([*x, y])) == [*x, y]
        return got

    def shortest_path(self, text: str) -> list[int]:
        """Ids on the best path of the composition with one stretch."""
        n, ids, joins = len(text), self.ids, self.joins
        unknown = [] if self.known.issuperset(text) else [i for i, c in enumerate(text) if c not in ids]
        if unknown:  # every such character is a boundary, crossed by its bytes at a cost
            out, at = [], 0
            for i in [*unknown, n]:
                out += self.shortest_path(text[at:i]) if i > at else []
                out += [self.byte_ids[b] for b in text[i].encode()] if i < n else []
                at = i + 1
            return out
        # without byte arcs all finite costs are 0: a state is reached (its last piece, shifted) or it is not
        state: list[int | None] = [None] * (n + 1)
        state[0] = 0
        back, pair = [0] * (n + 1), self.pair
        for end, (size, piece) in self.arcs.iter(text):
            at = end + 1 - size
            a = state[at]
            if a is not None and state[end + 1] is None:
                ok = pair.get(a | piece)
                if joins((a >> 20) - 1, piece) if ok is None else ok:
                    state[end + 1], back[end + 1] = (piece + 1) << 20, at
        if state[n] is None:
            raise ValueError(f"no path for {text!r}")
        path: list[int] = []
        while n:
            path.append((state[n] >> 20) - 1)
            n = back[n]
        return path[::-1]

    def _packed(self, stretch: str) -> bytes:
        got = self.old.get(stretch)
        if got is None:
            got = np.array(self.shortest_path(stretch), "<u4").tobytes()
        return got

    def encode(self, text: str) -> np.ndarray:
        """The ids of a whole text, as uint32."""
        if not text:
            return np.zeros(0, np.uint32)
        if len(self.young) > self.limit:
            self.old, self.young = self.young, _Filled(self._packed)
        elif not isinstance(self.young, _Filled):
            self.young = _Filled(self._packed)
        stretches = _STRETCH.findall(SPACE + text.replace(" ", SPACE))
        return np.frombuffer(b"".join(map(self.young.__getitem__, stretches)), "<u4")

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: piece bytes joined, without the space that the normaliser put first."""
        size = self.size[ids]
        step = np.repeat(self.at[ids] - (np.cumsum(size) - size), size)
        raw = self.flat[step + np.arange(len(step))].tobytes()
        return (raw[1:] if raw[:1] == b" " else raw).decode(errors="replace")


class _Filled(dict):
    """A dict that works out missing values."""

    def __init__(self, fill):
        super().__init__()
        self.fill = fill

    def __missing__(self, key):
        value = self[key] = self.fill(key)
        return value


_OPEN: dict[str, PieceTransducer] = {}


def transducer(path: str) -> PieceTransducer:
    """One compiled model per worker process and file."""
    if path not in _OPEN:
        _OPEN[path] = PieceTransducer(path)
    return _OPEN[path]


def _round_task(path: str, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = transducer(path)
        for batch in batches:
            rows, packed = [], []
            for text in batch.column("text"):
                text = text.as_py() or ""
                ids = model.encode(text)
                back = model.decode(ids)
                rows.append((len(ids), int(model.is_byte[ids].sum()), zlib.crc32(ids.tobytes()), zlib.crc32(text.encode()),
                             zlib.crc32(back.encode()), back == text.replace(SPACE, " ")))
                packed.append(ids.tobytes() if with_ids else None)
            cols = list(zip(*rows, strict=True)) if rows else [()] * 6
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c, pa.int64()) for c in cols[:5]], pa.array(cols[5], pa.bool_()), pa.array(packed, pa.binary())],
                names=["doc_id", "n_ids", "n_byte_ids", "ids_crc32", "text_crc32", "decoded_crc32", "round_trip", "ids"])
    return run


def encode_and_decode(docs: DataFrame, model: str, with_ids: bool = False) -> DataFrame:
    """doc_id, n_ids, n_byte_ids, ids_crc32, text_crc32, decoded_crc32, round_trip (and ids); no shuffle."""
    out = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        _round_task(model, with_ids), "doc_id long, n_ids long, n_byte_ids long, ids_crc32 long, text_crc32 long, "
        "decoded_crc32 long, round_trip boolean, ids binary")
    return out if with_ids else out.drop("ids")
