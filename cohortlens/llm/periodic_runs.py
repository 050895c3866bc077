"""Periodic runs of words by a dictionary of basic factors (operator 12).

The words of a text are its maximal stretches of ``[^\\x20\\x09-\\x0D]``. A run is a maximal stretch of words with smallest
period q (words q apart are identical) of at least max(``min_words``, ``min_periods`` * q) words.

For every power of two L the factors of L consecutive words get names (the dictionary of basic factors: the name of a
factor of 2L words is the pair of names of its halves). For each occurrence of a factor its successor, the next
occurrence in the same document, is looked up. Let q be the smallest period of a run of at least 4q words and L the
power of two with L <= 3q < 2L. A factor of L > 1.5q words inside the run comes back after q words and, by the theorem of
Fine and Wilf, not before: a return after d < q would give it a period min(d, q - d) <= q / 2 beside q. So all
occurrences of one factor within a run form an arithmetic progression of difference q, every start i of the run whose
copy i + q still fits proposes q, and starts next to each other that propose the same q extend one another to exactly the
run; the start before and the one after are proposals of another distance. As 3q fixes L, a run is proposed at one length
only; proposals of other distances than L <= 3d < 2L are left to the length that they belong to.

A factor that occurs once in its document occurs in no longer repeated factor: only repeated ones go on to the next
length, so ordinary prose costs about three rounds. All documents of a slice of text are worked on at once; there is no
shuffle, a task holds one slice (or one longer text) at a time.

Defined cases: a null or empty text, or one without words, has no words and no runs (four nulls); a null doc_id is kept
as null; repeated rows give repeated results; equal words are equal byte strings (no case folding); among runs of the
greatest exact exponent the one with the smallest start, then the smallest period is reported; an empty table gives
no rows; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.llm import textkit as T

MIN_WORDS, MIN_PERIODS = 6, 4
RUN = "struct<start:long,length:long,period:long>"


def find_runs(codes: np.ndarray, offs: np.ndarray, min_words: int = MIN_WORDS,
              min_periods: int = MIN_PERIODS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs of the word codes, whose documents lie between neighbouring ``offs``; starts
    count over all documents, the result is ordered by start, then period. ``min_periods`` is at least 4."""
    if min_periods < 4:
        raise ValueError("the proposals are complete for runs of four periods or more")
    doc = np.repeat(np.arange(len(offs) - 1), np.diff(offs))
    at, name = _repeated(np.arange(len(codes)), doc * (int(codes.max(initial=0)) + 1) + codes)
    found, size = [], 1
    dense = np.full(len(codes) + 1, -1, np.int64)
    while len(at):
        order = np.argsort(name, kind="stable")  # positions ascend within a name
        nearest = np.zeros(len(at), np.int64)
        nearest[order[:-1]] = np.where(name[order[1:]] == name[order[:-1]], at[order[1:]] - at[order[:-1]], 0)
        fits = (3 * nearest >= size) & (3 * nearest < 2 * size)
        start, period = at[fits], nearest[fits]
        if len(start):
            first = np.flatnonzero(np.concatenate([[True], (np.diff(start) != 1) | (np.diff(period) != 0)]))
            count = np.diff(np.concatenate([first, [len(start)]]))
            length = count - 1 + size + period[first]
            long = length >= np.maximum(min_words, min_periods * period[first])
            found.append((start[first][long], length[long], period[first][long]))
        dense[at] = name  # names of this length, to be paired with those one length further on
        ahead = np.minimum(at + size, len(codes))
        second = dense[ahead]
        both = (second >= 0) & (doc[np.minimum(ahead, len(codes) - 1)] == doc[at])
        pair = name[both] * (int(name.max()) + 1) + second[both]
        dense[at] = -1
        at, name = _repeated(at[both], pair)
        size *= 2
    if not found:
        z = np.zeros(0, np.int64)
        return z, z, z
    start, length, period = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def _repeated(at: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The positions whose key occurs at least twice, and dense names of their keys."""
    if not len(at):
        return at, key
    order = np.argsort(key, kind="stable")
    new = np.concatenate([[True], key[order][1:] != key[order][:-1]])
    group = np.cumsum(new) - 1
    many = np.bincount(group)[group] > 1
    name = np.empty(len(at), np.int64)
    name[order] = np.where(many, group, -1)
    kept = name >= 0
    return at[kept], name[kept]


def planted_index(doc_id: int | None, n: int) -> np.ndarray:
    """For each word position of a document of ``n`` words the original word that stands there once a periodic tail has
    been planted in the documents whose checksum is divisible by ten."""
    index = np.arange(n)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            index[a:] = a + np.arange(n - a) % (1 + (n - a) // (3 + g % 8))
    return index


def _search(batches: Iterator[pa.RecordBatch], plant: bool, min_words: int, min_periods: int) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))
    for batch in batches:
        ids = batch.column("doc_id")
        for lo, hi, data, offs in T.slices(batch.column("text")):
            raw = data.tobytes()
            doc_ids = ids.slice(lo, hi - lo)
            words = [raw[offs[i]:offs[i + 1]].split() for i in range(hi - lo)]  # at 0x20 and 0x09-0x0D
            if plant:
                for i, (doc_id, w) in enumerate(zip(doc_ids.to_pylist(), words)):
                    index = planted_index(doc_id, len(w))
                    if len(w) and index[-1] != len(w) - 1:
                        words[i] = [w[k] for k in index]
            ends = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)
            flat = np.empty(int(ends[-1]), object)
            for i, w in enumerate(words):
                flat[ends[i]:ends[i + 1]] = w
            codes = pd.factorize(flat)[0].astype(np.int64) if len(flat) else np.zeros(0, np.int64)
            start, length, period = find_runs(codes, ends, min_words, min_periods)
            cut = np.zeros(len(flat) + 1, np.int64)
            np.add.at(cut, start + period, 1)
            np.subtract.at(cut, start + length, 1)
            stays = np.cumsum(cut)[:-1] == 0
            of = np.searchsorted(ends, start, "right") - 1
            bounds = np.searchsorted(of, np.arange(hi - lo + 1))
            runs = pa.StructArray.from_arrays([pa.array(start - ends[of]), pa.array(length), pa.array(period)], fields=list(kind.value_type))
            text = [b" ".join(flat[ends[i]:ends[i + 1]][stays[ends[i]:ends[i + 1]]]) for i in range(hi - lo)]
            yield pa.RecordBatch.from_arrays(
                [doc_ids, pa.array(np.diff(ends)), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), runs),
                 pa.array(text, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, plant: bool = False, min_words: int = MIN_WORDS,
                  min_periods: int = MIN_PERIODS) -> DataFrame:
    """doc_id, n_words, runs (all of them, by start, then period) and the text with every run collapsed to its first
    period, words joined by one space. ``plant`` first puts periodic tails into some documents (``planted_index``)."""
    if min_periods < 4:
        raise ValueError("the proposals are complete for runs of four periods or more")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _search(batches, plant, min_words, min_periods)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(task, f"doc_id long, n_words long, runs array<{RUN}>, collapsed string")


def strongest(runs: Column) -> Column:
    """The run with the greatest exact length / period; ties go to the smallest start, then the smallest period."""
    def better(a: Column, b: Column) -> Column:
        left, right = a["length"] * b["period"], b["length"] * a["period"]
        earlier = (a["start"] < b["start"]) | ((a["start"] == b["start"]) & (a["period"] <= b["period"]))
        return (left > right) | ((left == right) & earlier)

    none = F.lit(None).cast(RUN)
    return F.aggregate(runs, none, lambda a, b: F.when(a.isNull() | ~better(a, b), b).otherwise(a))


def run_digest(docs: DataFrame, plant: bool = False) -> DataFrame:
    """One row per document: number of runs, the strongest run, and SHA-256 digests of all runs and of the collapsed
    text."""
    found = periodic_runs(docs, plant)
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    best = strongest(F.col("runs"))
    return (found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256")))
