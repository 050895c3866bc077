"""Conversation repair against every sequence of edits, and the query against its SQL (test_corpus_queries)."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest

from cohortlens.llm import conversation_repair as R

SCHEMA = "conv_id long, turn long, role string, text string, task int, block int, codes int, edits string, copies int"


def cheapest(rows):
    """(cost, audit, repaired) of rows (role, text, must_go, truncated): the least over all sequences of edits. Two
    inserts in a row are enough, as a third only repeats the first."""
    @lru_cache(None)
    def rest(i, state, inserts):
        options = []
        turn = "a" if state == "u" else "u"
        name = {"u": "user", "a": "assistant"}[turn]
        if inserts < 2:
            c, a, t = rest(i, turn, inserts + 1)
            options.append((c + 2, "I" + a, ((name, ""),) + t))
        if i == len(rows):
            if state in ("0", "a"):
                options.append((0, "", ()))
            return min(options) if options else (10**9, "", ())
        role, text, must_go, truncated = rows[i]
        c, a, t = rest(i + 1, state, 0)
        options.append((c + 3, "D" + a, t))
        if not must_go:
            if role[:1] == turn or (role[:1] == "s" and state == "0"):
                c, a, t = rest(i + 1, role[:1], 0)
                options.append((c + truncated, "K" + a, ((role, text),) + t))
            c, a, t = rest(i + 1, turn, 0)
            options.append((c + 2 + truncated, "R" + a, ((name, text),) + t))
        return min(options, key=lambda o: o[:2])

    for i in range(len(rows), 0, -50):  # from the end, so that the recursion stays flat
        for state in "0sua":
            rest(i, state, 0)
    return rest(0, "0", 0)


def expected(table, damage=True):
    convs = {}
    for conv, turn, role, text in table:
        rows = convs.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20 if damage else 9
        role, text = " " if role is None else role, " " if text is None else text
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        rows += [(turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    out = {}
    for conv, rows in convs.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, judged, counts = set(), [], [0, 0, 0]
        for _, role, text in rows:
            solid = re.sub("[\x20\x09-\x0d]", "", text)
            fault = 0 if not solid else 1 if (role, text) in seen else 2 if solid[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                counts[fault] += 1
            judged.append((role, text, fault in (0, 1), int(fault == 2)))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        turns = [t for t, *_ in rows if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        cost, audit, said = cheapest(tuple(judged))
        text = "\n".join(f"{r}:{t}" for r, t in said)
        out[conv] = (gaps, *counts, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return out


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def as_dict(frame):
    rows = frame.collect()
    out = {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in rows}
    assert len(out) == len(rows)
    return out


def conversation(rng, conv, n):
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None]
    texts = ["Yes.", "No", "  ", "", None, "Why?", "so", "ok!", "Yes. \n", "\x0b", "été", "é!"]
    return [(conv, rng.choice([rng.randint(0, n), i, i, i, i, None]), rng.choice(roles), rng.choice(texts) if rng.random() < 0.4 else f"{rng.random()}.")
            for i in range(n)]


@pytest.fixture(scope="module")
def table():
    rng = random.Random(11)
    rows = [r for conv in range(150) for r in conversation(rng, conv, rng.choice([1, 2, 3, 5, 8, 13]))]
    rows += conversation(rng, None, 9) + conversation(rng, 500, 45) + [(600, None, "user", "a.")] * 3 + [(601, 5, None, None)]
    rows += [(602, t, "system", "Be kind.") for t in range(3)] + [(603, 2**62, "user", "x."), (603, 2**62 + 1, "assistant", "y.")]
    rows += [(604, t, "user", f"{t} and on") for t in range(80)]  # two edits at every turn
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, 7, 7, 7, "x", 7) for r in rows], SCHEMA).repartition(3)


def test_every_conversation(spark, table):
    got = as_dict(R.summary(R.repair(R.damaged(frame(spark, table)), "copies")))
    assert got == expected(table)
    assert as_dict(R.summary(R.repair(frame(spark, table)))) == expected(table, damage=False)


def test_long_conversation_lies_in_many_blocks_and_tasks(spark, monkeypatch):
    rng = random.Random(2)
    rows = conversation(rng, 1, 700) + conversation(rng, 2, 3) + [(1, 300, "user", "same again.")] * 40
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        pieces = R.repair(frame(spark, rows)).collect()
        assert len({p["task"] for p in pieces if p["conv"] == 1 and p["n"]}) > 3
        assert max(len(p["edits"]) for p in pieces) < 200
        got = as_dict(R.summary(R.repair(frame(spark, rows))))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert got == expected(rows, damage=False)


def test_pieces_hold_the_repaired_turns(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "There."), (1, 2, "assistant", ""), (2, 0, "assistant", "Go")]
    pieces = sorted(R.repair(frame(spark, rows)).collect(), key=lambda p: (p["conv"], p["task"], p["block"]))
    said = {c: [(t["role"], t["text"]) for p in pieces if p["conv"] == c for t in p["repaired"]] for c in (1, 2)}
    assert said == {1: [("user", "Hi."), ("assistant", "There.")], 2: []}


def test_empty(spark):
    assert R.summary(R.repair(R.damaged(frame(spark, [])), "copies")).collect() == []
    gone = next(i for i in range(100) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    got = as_dict(R.summary(R.repair(R.damaged(frame(spark, [(gone, 0, "user", "x.")])), "copies")))
    assert got == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_alignment_of_a_block_equals_every_start(spark):
    """The banded tables of a block against plain dynamic programming over the four states."""
    rng = random.Random(4)
    for _ in range(300):
        rows = tuple((rng.choice("suaoxUASO"), rng.choice([1, 1, 1, 2])) for _ in range(rng.randint(1, 14)))
        table = R.block_table(rows)
        for p in range(4):
            after = tuple(rng.choice([0, 1, 2, 5, R.INF]) for _ in range(4))
            best = min(table[4 * p + q] + after[q] for q in range(4))
            got = R.align(rows, p, after)
            assert min(got[0], R.INF) == min(best, R.INF)
