"""Vectorised text primitives for Arrow batches (numpy inside Spark tasks).

A batch of texts is one UTF-8 byte buffer plus offsets. All helpers work on slices of a bounded number of
bytes, so a task's memory depends on the slice size and on the longest single text, never on the batch.
Hashes are 64-bit polynomial span hashes over a random byte table, finished with a mixer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19

#: Word separators of the contracts: space and the controls 0x09-0x0D.
WS = np.zeros(256, bool)
WS[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PIECE = 1 << 18


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POW = _powers(_BASE, _PIECE + 1)
_POW_INV = _powers(_BASE_INV, _PIECE + 1)


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finisher, so that every bit of a result depends on all bits of its input."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def text_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary Arrow array; a null counts as empty."""
    kind = pa.large_binary() if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type) else pa.large_string()
    col = col.cast(kind)
    if col.null_count:
        col = col.fill_null(b"" if kind == pa.large_binary() else "")
    _, offsets, data = col.buffers()
    offs = np.frombuffer(offsets, np.int64)[col.offset:col.offset + len(col) + 1] if len(col) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0]:offs[-1]], offs - offs[0]


def slices(col: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a column into row ranges (lo, hi, bytes, offsets) of about ``limit`` bytes; a longer text is alone."""
    data, offs = text_buffer(col)
    lo, n = 0, len(offs) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1)
        hi = min(hi, n)
        yield lo, hi, data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
        lo = hi


def per_row(flags: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Number of set flags in each row's span."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[offs[1:]] - total[offs[:-1]]


def word_spans(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of every maximal run of non-separators; runs never cross rows."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    solid = ~WS[data]
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    before = np.concatenate([[False], solid[:-1]])
    after = np.concatenate([solid[1:], [False]])
    starts = np.flatnonzero(solid & (~before | edge[:n]))
    ends = np.flatnonzero(solid & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(offs, starts, "right") - 1


def line_spans(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of the non-empty \\n-separated lines."""
    full = np.flatnonzero(offs[1:] > offs[:-1])
    breaks = np.flatnonzero(data == 10)
    starts = np.sort(np.concatenate([offs[full], breaks + 1]))
    ends = np.sort(np.concatenate([offs[full + 1], breaks]))
    some = ends > starts
    starts, ends = starts[some], ends[some]
    return starts, ends, np.searchsorted(offs, starts, "right") - 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span (spans sorted by start); equal bytes give equal hashes."""
    out = np.zeros(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        base = starts[i]
        j = int(np.searchsorted(starts, base + (_PIECE >> 1), "left"))
        while j > i + 1 and ends[j - 1] - base > _PIECE:
            j -= 1
        top = int(ends[i:j].max())
        if top - base > _PIECE:  # one span longer than a piece: Horner over its pieces
            h = np.uint64(0)
            with np.errstate(over="ignore"):
                for s in range(int(base), int(ends[i]), _PIECE):
                    block = _BYTE[data[s:min(s + _PIECE, int(ends[i]))]]
                    h = mix(np.array([h + (block * _POW[:len(block)]).sum(dtype=np.uint64)], np.uint64))[0]
            out[i] = h
            i += 1
            continue
        sums = np.zeros(top - base + 1, np.uint64)
        np.cumsum(_BYTE[data[base:top]] * _POW[:top - base], out=sums[1:])
        s, e = starts[i:j] - base, ends[i:j] - base
        out[i:j] = mix((sums[e] - sums[s]) * _POW_INV[s] + (e - s).astype(np.uint64))
        i = j
    return out


def windows(h: np.ndarray, row: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``width`` consecutive items of one row, and the index of its first item."""
    if len(h) < width:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    n = len(h) - width + 1
    acc = np.zeros(n, np.uint64)
    for k in range(width):
        acc = acc * np.uint64(0xD6E8FEB86659FD93) + h[k:k + n]
    first = np.flatnonzero(row[width - 1:] == row[:n])
    return mix(acc[first]), first


def repeats(key: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For items (row, key): a flag for those whose key occurs twice or more in the row, and a flag for all but
    the first of each key."""
    tagged = key ^ mix(row.astype(np.uint64) + np.uint64(1))
    order = np.argsort(tagged, kind="stable")
    same = np.zeros(len(key) + 1, bool)
    same[1:-1] = tagged[order][1:] == tagged[order][:-1] if len(key) > 1 else False
    many, later = np.zeros(len(key), bool), np.zeros(len(key), bool)
    later[order] = same[:-1]
    many[order] = same[:-1] | same[1:]
    return many, later
