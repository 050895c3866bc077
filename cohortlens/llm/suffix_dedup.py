"""Removal of repeated passages with longest-previous-factor arrays over a sparse suffix array (operator 5).

A byte goes when a string of ``length`` bytes around it also starts earlier (smaller doc_id, or earlier in the same
document). The suffixes that can decide this are found first, so that only they are ever sorted:

1. Every window of ``length`` bytes is owned by an anchor, its least-hashed k-gram. Equal windows have equal anchors
   at equal places, so a window can only repeat where its anchor does. A task gives one row per anchor: hash of the
   k-gram, hash of the block (all windows the anchor owns), place. Equal blocks of one slice are reduced to the first
   of them at once, so a passage of many copies costs one row per slice.
2. Rows meet by k-gram. All but the first of equal blocks are repeats as a whole. The first blocks of k-grams with
   different blocks are left: passages that begin, end or differ there.
3. The suffixes at the window starts of these blocks are sorted (sparse suffix array, ``length`` bytes deep; equal
   ones by place). In that order the previous smaller place of a suffix that ties with one before it is a previous
   factor of at least ``length`` bytes; the first of a tie has shorter ones on both sides. Blocks are sorted in
   chunks of bounded size, small ones unless a k-gram needs more; where one k-gram fills several of the largest, its
   windows that are first in their chunk are compared by 128-bit hash across chunks.
4. Spans are joined to the documents and cut out.

Defined cases: null and empty texts have no bytes; texts shorter than ``length`` keep all; repeated rows of one id
count as one place and are all cut alike; a row without an id has no place in the order, so it keeps its whole text and is
nobody's earlier copy; an empty table gives no rows; other columns are passed through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm import textkit as T
from cohortlens.llm.shared import compressed, freed_shuffles, in_parts, open_text
from cohortlens.session import cut_lineage

GRAM = 32
_PIECE = 1 << 19
_POS = np.uint64((1 << 24) - 1)


def _segments(col: pa.Array, length: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, byte offset, bytes, offsets): slices of rows, and overlapping pieces of one very long text."""
    for lo, _, data, offs in T.slices(col):
        if len(data) <= 2 * _PIECE:
            yield lo, 0, data, offs
            continue
        for at in range(0, len(data), _PIECE):
            piece = data[at:at + _PIECE + length - 1]
            yield lo, at, piece, np.array([0, len(piece)])


def anchors(data: np.ndarray, offs: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(row, first start, number of starts, k-gram hash, block hash) of the anchors of all windows."""
    n, span = len(data), length - GRAM + 1
    empty = np.zeros(0, np.int64)
    if n < length:
        return empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    h, w = T._BYTE[data], 1
    while w < GRAM:
        h = h[:-w] * T._POW[w] * np.uint64(w + 2) + h[w:]
        w *= 2
    h = T.mix(h)
    low = (h & ~_POS) | np.arange(len(h), dtype=np.uint64)
    w = 1
    while 2 * w <= span:
        low = np.minimum(low[:-w], low[w:])
        w *= 2
    if w < span:
        low = np.minimum(low[:-(span - w)], low[span - w:])
    starts = np.ones(len(low), bool)  # starts of windows inside one row
    stops = np.zeros(n + 2, np.int64)
    np.add.at(stops, np.maximum(offs[1:] - length + 1, offs[:-1]), 1)
    np.subtract.at(stops, offs[1:], 1)
    starts &= np.cumsum(stops)[:len(low)] == 0
    p = np.flatnonzero(starts)
    if not len(p):
        return empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    at = (low[p] & _POS).astype(np.int64)
    row = np.searchsorted(offs, p, "right") - 1
    new = np.ones(len(p), bool)
    new[1:] = (at[1:] != at[:-1]) | (row[1:] != row[:-1])
    i = np.flatnonzero(new)
    first, count = p[i], np.diff(np.append(i, len(p)))
    block = T.span_hashes(data, first, first + count + length - 1)
    return row[i], first, count, h[at[i]], T.mix(block + (at[i] - first).astype(np.uint64))


def _spans(doc: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping or touching spans of each document merged."""
    if not len(doc):
        return doc, lo, hi
    order = np.lexsort((lo, doc))
    doc, lo, hi = doc[order], lo[order], hi[order]
    group = np.cumsum(np.concatenate([[0], (doc[1:] != doc[:-1]).astype(np.int64)]))
    reach = np.maximum.accumulate(hi + group * (1 << 40)) - group * (1 << 40)
    new = np.ones(len(doc), bool)
    new[1:] = (group[1:] != group[:-1]) | (lo[1:] > reach[:-1])
    i = np.flatnonzero(new)
    return doc[i], lo[i], np.maximum.reduceat(hi, i)


_ANCHOR = "key long, block long, doc long, place long"  # place: first start << 8 | starts, or a span with block null
_MARK = "doc long, lo long, hi long, key long"  # a repeated span, or (key not null) the starts of an open block


def _anchor_task(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            for first_row, base, data, offs in _segments(batch.column("text"), length):
                row, lo, count, key, block = anchors(data, offs, length)
                doc, lo = ids[first_row + row], lo - offs[row] + base
                order = np.lexsort((lo, doc))
                _, at, group = np.unique((key ^ T.mix(block))[order], return_index=True, return_inverse=True)
                first = np.empty(len(doc), np.int64)
                first[order] = order[at][group]
                keep = first == np.arange(len(doc))
                later = (doc != doc[first]) | (lo != lo[first])
                d, a, b = _spans(doc[later], lo[later], (lo + count + length - 1)[later])
                # spans ride along under a key of their own, with their end as block and a negative place
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate([key[keep].view(np.int64), d])), pa.array(np.concatenate([block[keep].view(np.int64), b])),
                    pa.array(np.concatenate([doc[keep], d])),
                    pa.array(np.concatenate([lo[keep] << 8 | count[keep], -a - 1]))], names=["key", "block", "doc", "place"])
    return run


def _marks(spans: tuple, opened: tuple) -> pa.RecordBatch:
    doc, lo, hi = (np.concatenate([s, o]) for s, o in zip(spans, opened[:3], strict=True))
    key = np.concatenate([np.zeros(len(spans[0]), np.int64), opened[3]])
    return pa.RecordBatch.from_arrays([pa.array(doc), pa.array(lo), pa.array(hi), pa.array(key, mask=np.arange(len(key)) < len(spans[0]))],
                                      names=["doc", "lo", "hi", "key"])


def _meet_task(length: int):
    """Rows sorted by (key, block, doc, place): spans of repeated blocks, and the first blocks of keys with several.
    Only the last class of a batch is carried on, so a key of any number of rows streams through."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple | None = None  # key, block, doc and place of the last class's first row; whether it was given out
        for batch in batches:
            key, block, doc, place = (batch.column(c).to_numpy() for c in ("key", "block", "doc", "place"))
            ready = place < 0
            spans = doc[ready], -place[ready] - 1, block[ready]
            key, block, doc, place = (c[~ready] for c in (key, block, doc, place))
            opened = (np.zeros(0, np.int64),) * 4
            if len(key):
                if last is not None:
                    key, block, doc, place = (np.insert(c, 0, x) for c, x in zip((key, block, doc, place), last, strict=False))
                new_key = np.ones(len(key), bool)
                new_key[1:] = key[1:] != key[:-1]
                new_class = new_key.copy()
                new_class[1:] |= block[1:] != block[:-1]
                first = np.maximum.accumulate(np.where(new_class, np.arange(len(key)), 0))
                later = (doc != doc[first]) | (place != place[first])
                c = np.flatnonzero(new_class)
                several = ~new_key[c]
                several[:-1] |= ~new_key[c[1:]]  # a key's first class, when another one follows
                given = np.zeros(len(c), bool)
                if last is not None and last[4]:
                    given[0] = several[0] = True
                o = c[several & ~given]
                lo, hi = place >> 8, (place >> 8) + (place & 255)
                opened = doc[o], lo[o], hi[o], key[o]
                spans = tuple(np.concatenate([s, x[later]]) for s, x in zip(spans, (doc, lo, hi + length - 1), strict=True))
                last = key[-1], block[-1], doc[c[-1]], place[c[-1]], bool(several[-1])
            yield _marks(_spans(*spans), opened)
    return run


def _blocks_task(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches):
            rows = []
            for doc, z, parts in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(),
                                     batch.column("parts").to_pylist(), strict=True):
                text = open_text(z)
                rows += [(p["key"], doc, p["lo"], text[p["lo"]:p["hi"] + length - 1]) for p in parts if p["hi"] + length - 1 <= len(text)]
            cols = list(zip(*rows, strict=True)) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols[:3]] + [pa.array(cols[3], pa.binary())],
                                             names=["key", "doc", "lo", "block"])
    return run


def repeats_before(buffer: np.ndarray, starts: np.ndarray, place: np.ndarray, length: int) -> np.ndarray:
    """For suffixes of ``buffer`` at ``starts``: whether the longest previous factor, among suffixes of smaller
    ``place``, reaches ``length``.

    The suffix array is built eight bytes at a time, only inside runs that still tie, and ties after ``length`` bytes
    are ordered by place. A suffix with a predecessor of smaller place in its run has it as previous smaller place,
    with a common prefix of ``length``; the first of a run has its previous and next smaller places outside the run,
    where common prefixes are shorter."""
    padded = np.concatenate([buffer, np.zeros(16, np.uint8)])
    word = np.zeros(len(buffer) + 8, np.uint64)
    for k in range(8):
        word = word << np.uint64(8) | padded[k:k + len(word)].astype(np.uint64)
    run, tied = np.zeros(len(starts), np.int64), np.arange(len(starts))
    for depth in range(0, length, 8):
        w = word[starts[tied] + depth]
        if length - depth < 8:
            w = w >> np.uint64(8 * (8 - length + depth))
        order = np.lexsort((w, run[tied]))
        tied, w = tied[order], w[order]
        new = np.ones(len(tied), bool)
        new[1:] = (run[tied][1:] != run[tied][:-1]) | (w[1:] != w[:-1])
        run[tied] = np.cumsum(new)
        alone = new.copy()
        alone[:-1] &= new[1:]
        tied = tied[~alone]
    out = np.zeros(len(starts), bool)
    if len(tied):
        tied = tied[np.lexsort((place[tied], run[tied]))]
        new = np.ones(len(tied), bool)
        new[1:] = run[tied][1:] != run[tied][:-1]
        previous = np.maximum.accumulate(np.where(new, np.arange(len(tied)), 0))
        out[tied] = place[tied] > place[tied[previous]]
    return out


def _ranks(doc: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Numbers of the places (doc, at) in their order; equal places get equal ones."""
    order = np.lexsort((at, doc))
    new = np.zeros(len(order), bool)
    new[1:] = (np.diff(doc[order]) != 0) | (np.diff(at[order]) != 0)
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


_FOUND = "doc long, lo long, hi long, w1 long, w2 long"


def _factor_task(length: int, chunk: int):
    """Blocks sorted by key, in chunks: spans of windows with a previous factor; where a key goes beyond its chunk,
    also the hashes of its windows that have none inside it. Whole keys are given out from a fifth of ``chunk`` on."""
    enough = max(chunk // 5, 1)

    def work(rows: list[tuple], from_key: int | None, to_key: int | None) -> pa.RecordBatch:
        sizes = np.array([len(r[3]) for r in rows])
        base = np.cumsum(sizes) - sizes
        buffer = np.frombuffer(b"".join(r[3] for r in rows), np.uint8)
        count = sizes - length + 1
        owner = np.repeat(np.arange(len(rows)), count)
        inside = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        doc, lo, key = (np.array([r[i] for r in rows], np.int64) for i in (1, 2, 0))
        at = lo[owner] + inside
        hit = repeats_before(buffer, base[owner] + inside, _ranks(doc[owner], at), length)
        d, a, b = _spans(doc[owner][hit], at[hit], at[hit] + length)
        beyond = ~hit & np.isin(key[owner], [k for k in (from_key, to_key) if k is not None])
        digests = [hashlib.md5(buffer[s:s + length].tobytes()).digest() for s in (base[owner] + inside)[beyond]]
        words = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
        n = len(d)
        none = np.arange(n + len(words)) < n
        return pa.RecordBatch.from_arrays([
            pa.array(np.concatenate([d, doc[owner][beyond]])), pa.array(np.concatenate([a, at[beyond]])),
            pa.array(np.concatenate([b, at[beyond] + length])),
            *[pa.array(np.concatenate([np.zeros(n, np.int64), words[:, i]]), mask=none) for i in (0, 1)]], names=["doc", "lo", "hi", "w1", "w2"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        left_key = None  # key that goes on from the chunk before
        for batch in batches:
            rows += zip(*[batch.column(c).to_pylist() for c in ("key", "doc", "lo", "block")], strict=True)
            while len(rows) > enough:
                cut = min(chunk, len(rows) - 1)  # end the chunk where a key ends, if one does
                while cut and rows[cut - 1][0] == rows[cut][0]:
                    cut -= 1
                open_key = None
                if not cut:
                    if len(rows) <= chunk:  # the key may end within the chunk yet
                        break
                    cut, open_key = chunk, rows[chunk][0]
                yield work(rows[:cut], left_key, open_key)
                left_key, rows = open_key, rows[cut:]
        if rows:
            yield work(rows, left_key, None)
    return run


def repeated_spans(texts: DataFrame, length: int = 100, chunk: int = 20_000) -> DataFrame:
    """(doc, spans): the spans [lo, hi) to remove from (doc_id, text), overlapping where matches do."""
    rows = texts.where("doc_id is not null").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    with freed_shuffles(texts.sparkSession):
        marks = cut_lineage(rows.mapInArrow(_anchor_task(length), _ANCHOR)
                            .repartition("key").sortWithinPartitions("key", "block", "doc", "place")
                            .mapInArrow(_meet_task(length), _MARK))
    parts = (marks.where("key is not null").groupBy("doc").agg(F.collect_list(F.struct("key", "lo", "hi")).alias("parts"))
             .withColumnRenamed("doc", "doc_id"))  # at most a row per anchor of the document
    blocks = compressed(rows).join(parts.hint("merge"), "doc_id").select("doc_id", "text", "parts").mapInArrow(
        _blocks_task(length), "key long, doc long, lo long, block binary")
    with freed_shuffles(texts.sparkSession):
        found = cut_lineage(blocks.repartition("key").sortWithinPartitions("key", "doc", "lo").mapInArrow(_factor_task(length, chunk), _FOUND))
    wide = found.where("w1 is not null")
    first = wide.groupBy("w1", "w2").agg(F.min(F.struct("doc", "lo")).alias("f"), F.count("*").alias("n")).where("n > 1")
    later = wide.join(first, ["w1", "w2"]).where(F.struct("doc", "lo") != F.col("f"))
    every = (marks.where("key is null").select("doc", "lo", "hi")
             .unionByName(found.where("w1 is null").select("doc", "lo", "hi")).unionByName(later.select("doc", "lo", "hi")))
    return every.groupBy("doc").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))


def cut_out(text: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int]:
    """(what is left, number of maximal removed runs)."""
    kept, at, runs = [], 0, 0
    for lo, hi in sorted(spans):
        if lo > at or not runs:
            kept.append(text[at:lo])
            runs += 1
        at = max(at, hi)
    kept.append(text[at:])
    return b"".join(kept), runs


#: Working column; named so that no column of a documents table clashes.
SPANS = "__lpf_spans"


def _cut_task(with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches):
            rows = []
            for z, spans in zip(batch.column("text").to_pylist(), batch.column(SPANS).to_pylist(), strict=True):
                text = open_text(z)
                left, runs = cut_out(text, [(s["lo"], min(s["hi"], len(text))) for s in spans or [] if s["lo"] < len(text)])
                if with_text:
                    rows.append((None if z is None else left.decode(errors="ignore"),))
                else:
                    rows.append((len(text), len(text) - len(left), runs, hashlib.sha256(left).hexdigest()))
            names = ["text"] if with_text else ["n_bytes", "n_removed", "n_spans", "kept_sha256"]
            types = [pa.string()] if with_text else [pa.int64()] * 3 + [pa.string()]
            cols = list(zip(*rows, strict=True)) if rows else [()] * len(names)
            kept = [c for c in batch.schema.names if c not in ("text", SPANS)]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + [pa.array(c, t) for c, t in zip(cols, types, strict=True)],
                                             names=[*kept, *names])
    return run


def _cut(docs: DataFrame, length: int, with_text: bool) -> DataFrame:
    spans = repeated_spans(docs, length).withColumnsRenamed({"doc": "doc_id", "spans": SPANS})
    joined = compressed(docs).join(spans.hint("merge"), "doc_id", "left")
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in joined.schema if f.name not in ("text", SPANS)]
    out = "text string" if with_text else "n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return joined.mapInArrow(_cut_task(with_text), ", ".join([*kept, out]))


def removal_digest(docs: DataFrame, length: int = 100) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans (maximal removed runs) and kept_sha256 of every row."""
    return _cut(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), length, False)


def remove_repeats(docs: DataFrame, length: int = 100) -> DataFrame:
    """The rows of ``docs``, all columns, with what is left of their texts (a character that a cut halves is dropped)."""
    return _cut(docs, length, True).select(*[f"`{c}`" for c in docs.columns])
