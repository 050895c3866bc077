"""Periodic runs against the definition, stretch by stretch."""

import hashlib
import random
import re
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from cohortlens.llm import periodic_runs as R
from cohortlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, start string, period int, runs int, n_words string, collapsed int, best int"


def brute(words):
    """All runs (start, length, period) of a list of words, by the definition."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            smaller = any(all(words[k] == words[k + p] for k in range(i, i + length - p)) for p in range(1, q))
            if length >= max(6, 4 * q) and not smaller:
                out.append((i, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def expected(doc_id, text, plant=True):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if plant and doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words)
    gone = {k for s, m, q in runs for k in range(s + q, s + m)}
    best = max(runs, key=lambda r: (r[1] * 10**12 // r[2], -r[0], -r[2]), default=None)
    for r in runs:  # exact, with no rounding
        if best and (r[1] * best[2], -r[0], -r[2]) > (best[1] * r[2], -best[0], -best[2]):
            best = r
    s, m, q = best or (None, None, None)
    return (doc_id, len(runs), s, m, q, best and 1000 * m // q,
            hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for k, w in enumerate(words) if k not in gone)).hexdigest())


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def as_tuples(frame):
    return sorted((tuple(r[c] for c in COLUMNS) for r in frame.collect()), key=repr)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=70), min_size=1, max_size=4), st.integers(1, 9), st.integers(2, 9))
def test_runs_of_codes(docs, period, times):
    docs = [*docs, docs[0][:period] * times + docs[-1][:5]]
    offs = np.concatenate([[0], np.cumsum([len(d) for d in docs])]).astype(np.int64)
    got = list(zip(*(x.tolist() for x in R.find_runs(np.array(sum(docs, []), np.int64), offs))))
    assert got == [(s + int(o), m, q) for d, o in zip(docs, offs) for s, m, q in brute(d)]


def test_edges(spark):
    rng = random.Random(3)
    rows = [(0, None), (1, ""), (2, " \n\t"), (3, "a a a a a"), (4, "a a a a a a"), (5, "A a " * 4), (None, "x y " * 9), (None, None)]
    rows += [(6, "é b é b " * 3), (7, "a b " * 5 + "c d e " * 6 + "c"), (8, "p q r s t " * 4), (9, "u " * 5 + "v " * 4)]
    rows += [(7, "a b " * 5 + "c d e " * 6 + "c"), (10, " ".join(rng.choice("ab") for _ in range(300))), (11, "w " * 3000)]
    rows += [(12, "a b " * 3 + "a " + "b a b b " * 8)]  # runs that overlap
    rows += [(i, " ".join(rng.choice(["the", "cat", "sat", "on"]) for _ in range(rng.randint(0, 60)))) for i in range(20, 160)]
    table = spark.createDataFrame([(i, t, "x", 1, 2, "y", 3, 4) for i, t in rows], SCHEMA).repartition(3)
    assert as_tuples(R.run_digest(table, plant=True)) == sorted((expected(i, t) for i, t in rows), key=repr)
    assert as_tuples(R.run_digest(table)) == sorted((expected(i, t, False) for i, t in rows), key=repr)
    assert R.run_digest(table.limit(0)).collect() == []
    full = {r["doc_id"]: r for r in R.periodic_runs(table.where("doc_id = 7")).collect()}[7]
    assert full["collapsed"] == "a b c d e" and [tuple(r) for r in full["runs"]] == [(0, 10, 2), (10, 19, 3)]


def test_registered_query(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    short = {i for i, t in docs if len((t or "").split()) <= 1500}
    got = [r for r in as_tuples(QUERIES["op12_periodic_runs"](spark, SF))]
    assert len(got) == len(docs)
    assert [r for r in got if r[0] in short] == sorted((expected(i, t) for i, t in docs if i in short), key=repr)
    assert any(r[1] for r in got)
