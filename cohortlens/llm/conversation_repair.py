"""Structure repair of conversations by Wagner-Fischer alignment to an alternating grammar (operator 13).

The rows of a conversation, by turn (nulls first; rows of one turn by role, then text), are aligned to a target whose
role initials match ``(s?(ua)+)?``: Keep (0), Rerole to user or assistant (2), Delete (3; the only edit for blank rows and
repeats), Insert an empty user or assistant turn (2); a truncated row that is not deleted adds 1. Among the cheapest
alignments the one with the ASCII-least string of edits (D, I, K, R) wins.

Targets of one start are prefixes of one alternating string, one for each feasible length. ``align`` goes through the
lengths from the nearest to the number of rows that may stay, fills the Wagner-Fischer table of each from its end, inside
the Ukkonen band that the best alignment so far (the incumbent) leaves open, follows the least edits through the table and
compares the audits of equal cost. A length whose distance alone costs more than the incumbent ends the search.

A conversation may hold any share of all rows, so its rows lie in blocks of at most ``BLOCK_ROWS`` turns, which are
aligned by themselves. Between blocks only what was put out last matters (nothing, s, u or a): a block is a 4 x 4 table of
least costs from start to end, and such tables compose in (min, +):

1. equal rows are added up, repeats are told by their first turn (joined on the unique row, so no group of equal texts
   meets in one task), rows are dealt by ranges of (conversation, turn, ...) and cut into blocks, which are written;
2. each task composes the tables of its blocks from the last one on; per conversation and task (at most one row for each
   task) the costs of all that follows are carried from the last to the first;
3. with these costs every block is aligned for each of the four starts, in any task;
4. in the order of the rows the start of each block picks its alignment. Inserts stand before a row or at the very end,
   so the audits of blocks never depend on where the cuts are.

Steps 2 and 4 stream the blocks of one conversation through one task, as the digest of its whole text demands; they hold
one block at a time.

Defined cases: null roles and texts are one space; a null conv_id is a conversation of its own; null turns come first and
count in no gap; roles are told by their first character, of which s, u and a (lower case) fit; rows equal in
conversation, turn, role and text follow one another, all but the first are repeats; rows of one turn and role whose texts
agree in their first 1,000 characters are ordered by the SHA-256 of the text; a conversation without rows has cost 0 and
an empty audit; an empty table gives no rows; columns other than conv_id, turn, role and text are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.shared import in_parts, stored

BLOCK_ROWS, BLOCK_BYTES = 32, 1 << 20
KEEP, REROLE, DELETE, INSERT = 0, 2, 3, 2
INF = 1 << 40
#: What was put out last: nothing, s, u or a. An end in one of them still needs so many inserts.
START, S, U, A = range(4)
CLOSING = (0, 2 * INSERT, INSERT, 0)
LEGAL = ["su", "ua", "au"]
SOLID = "[^\\x20\\x09-\\x0D]"


def _target(start: int, with_s: bool, length: int) -> str:
    """The first ``length`` initials of the alternating string that may follow ``start``."""
    first = "a" if start == U else "u"
    other = "u" if first == "a" else "a"
    rest = (first + other) * (length // 2 + 1)
    return ("s" + rest if with_s else rest)[:length]


def _end(start: int, target: str) -> int:
    return "sua".index(target[-1]) + 1 if target else start


def _edits(rows: tuple[tuple[str, int], ...], target: str, limit: int) -> tuple[int, str] | None:
    """(cost, ASCII-least edits) of the cheapest alignment of ``rows`` to ``target`` within ``limit``; None beyond it.

    ``rows`` are (code, copies): code is the role's initial, upper case where the row is truncated, ``x`` where it must
    go; copies after the first must go. No insert stands after the last row."""
    n, m = len(rows), len(target)
    may_stay = [0] * (n + 1)  # rows from i on that need not go
    for i in range(n - 1, -1, -1):
        may_stay[i] = may_stay[i + 1] + (rows[i][0] != "x")

    def apart(stay: int, out: int) -> int:
        return INSERT * (out - stay) if out > stay else DELETE * (stay - out)

    forced = sum(DELETE * (c if code == "x" else c - 1) for code, c in rows)
    limit -= forced
    table: list[dict[int, int]] = [{} for _ in range(n)] + [{m: 0}]
    for i in range(n - 1, -1, -1):
        code, here, after = rows[i][0], table[i], table[i + 1]
        done = may_stay[0] - may_stay[i]
        for j in range(m, -1, -1):
            if apart(done, j) + apart(may_stay[i], m - j) > limit:
                continue  # outside the band
            gone = after.get(j, INF) + (0 if code == "x" else DELETE)
            best = gone
            if j < m:
                if code != "x":
                    step = KEEP if code.lower() == target[j] else REROLE if target[j] != "s" else INF
                    best = min(best, after.get(j + 1, INF) + step + code.isupper())
                if target[j] != "s":
                    best = min(best, here.get(j + 1, INF) + INSERT)
            if best < INF:
                here[j] = best
    cost = table[0].get(0, INF)
    if cost >= INF or cost > limit:
        return None
    out, i, j = [], 0, 0
    while i < n:
        code, copies = rows[i]
        left = table[i][j]
        if table[i + 1].get(j, INF) + (0 if code == "x" else DELETE) == left:
            edit = "D"
        elif j < m and target[j] != "s" and table[i].get(j + 1, INF) + INSERT == left:
            out.append("I")
            j += 1
            continue
        else:
            edit = "K" if code.lower() == target[j] else "R"
            j += 1
        out.append(edit + "D" * (copies - 1))
        i += 1
    return cost + forced, "".join(out)


def align(rows: tuple[tuple[str, int], ...], start: int, after: tuple[int, ...]) -> tuple[int, str, int]:
    """(cost, edits, end) of the cheapest alignment of ``rows`` that begins after ``start``, where an end in state q costs
    ``after[q]`` more; cost INF where there is none. The cost counts ``after`` in."""
    stay = sum(code != "x" for code, _ in rows)
    best: tuple[int, str, int] = (INF, "", start)
    lengths = [(length, with_s) for with_s in ((False, True) if start == START else (False,))
               for length in range(int(with_s), 2 * (len(rows) + 2) + stay)]
    forced = sum(DELETE * (c if code == "x" else c - 1) for code, c in rows)
    least = min(after)
    for length, with_s in sorted(lengths, key=lambda x: (abs(x[0] - stay), x)):
        target = _target(start, with_s, length)
        end = _end(start, target)
        distance = forced + (INSERT * (length - stay) if length > stay else DELETE * (stay - length))
        if distance + least > best[0] and length > stay:
            break  # all that follow are farther, and inserts are the cheaper distance
        if after[end] >= INF or distance + after[end] > best[0]:
            continue
        found = _edits(rows, target, best[0] - after[end])
        if found and (found[0] + after[end], found[1]) < best[:2]:
            best = (found[0] + after[end], found[1], end)
    return best


@lru_cache(maxsize=50_000)
def block_table(rows: tuple[tuple[str, int], ...]) -> tuple[int, ...]:
    """The least costs of a block from each start to each end, row by row."""
    ends = [tuple(0 if k == q else INF for k in range(4)) for q in range(4)]
    return tuple(min(INF, align(rows, p, e)[0]) for p in range(4) for e in ends)


@lru_cache(maxsize=50_000)
def block_choices(rows: tuple[tuple[str, int], ...], after: tuple[int, ...]) -> tuple[tuple[int, str, int], ...]:
    """For each start the cost of the block itself, its edits and its end."""
    return tuple((cost - after[end], edits, end) for cost, edits, end in (align(rows, p, after) for p in range(4)))


def compose(first: tuple[int, ...], then: tuple[int, ...]) -> tuple[int, ...]:
    """(min, +) product of two tables, or of a table and a column."""
    w = len(then) // 4
    return tuple(min(INF, *(first[4 * p + k] + then[w * k + q] for k in range(4))) for p in range(4) for q in range(w))


NOTHING = tuple(0 if p == q else INF for p in range(4) for q in range(4))


def _prepared(turns: DataFrame, copies: Column) -> DataFrame:
    """One row for equal rows, with their number, whether the first of them is a repeat, and the code of the first.
    Nulls in keys are told by has_conv and has_turn."""
    conv, turn = F.col("conv_id").cast("long"), F.col("turn").cast("long")
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    rows = turns.select(conv.isNotNull().alias("has_conv"), F.coalesce(conv, F.lit(0)).alias("conv"),
                        turn.isNotNull().alias("has_turn"), F.coalesce(turn, F.lit(0)).alias("turn"),
                        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), text.alias("text"),
                        F.sha2(text.cast("binary"), 256).alias("digest"), copies.cast("long").alias("copies")).where("copies > 0")
    said = ["has_conv", "conv", "role", "digest"]
    keys = ["has_conv", "conv", "has_turn", "turn", "role", "digest"]
    rows = rows.groupBy(*keys).agg(F.max("text").alias("text"), F.sum("copies").alias("copies"))
    when = F.min(F.struct("has_turn", "turn")).alias("when")
    firsts = (rows.groupBy(*said).agg(when)
              .select("has_conv", "conv", "when.has_turn", "when.turn", "role", "digest", F.lit(True).alias("first")))
    rows = rows.join(firsts, keys, "left")
    last = F.regexp_extract("text", f"({SOLID})[\\x20\\x09-\\x0D]*$", 1)
    blank = ~F.col("text").rlike(SOLID)
    truncated = ~last.isin(".", "!", "?")
    initial = F.substring("role", 1, 1)
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    code = (F.when(blank | F.col("first").isNull(), "x").when(truncated, F.upper(known)).otherwise(known))
    return rows.select(*keys, "text", "copies", blank.alias("blank"), initial.alias("initial"), code.alias("code"))


FACTS = "n long, blank long, duplicate long, truncated long, illegal long, first_initial string, last_initial string, min_turn long, max_turn long, n_turns long"
BLOCK = ("has_conv boolean, conv long, task int, block long, codes array<string>, copies array<long>, roles array<string>, "
         f"texts array<string>, {FACTS}, later array<long>, upto array<long>")


_KINDS = {"boolean": pa.bool_(), "int": pa.int32(), "long": pa.int64(), "string": pa.string()}


def _kind(name: str) -> pa.DataType:
    if name.startswith("array<"):
        return pa.list_(_kind(name[6:-1]))
    if name.startswith("struct<"):
        return pa.struct([(k, _kind(v)) for k, v in (x.split(":") for x in name[7:-1].split(","))])
    return _KINDS[name]


def _arrow(ddl: str) -> pa.Schema:
    """The Arrow schema of one of the schemas of this module."""
    return pa.schema([(name, _kind(kind)) for name, kind in (x.split(" ") for x in ddl.split(", "))])


def _facts(rows: list[dict]) -> dict:
    """Counts of a block; ``rows`` in their order."""
    turns = [r["turn"] for r in rows if r["has_turn"]]
    initials = [r["initial"] for r in rows]
    return {
        "n": sum(r["copies"] for r in rows), "blank": sum(r["copies"] for r in rows if r["blank"]),
        "duplicate": sum(r["copies"] - (r["code"] != "x") for r in rows if not r["blank"]),
        "truncated": sum(r["code"].isupper() for r in rows),
        "illegal": sum(r["copies"] - 1 for r in rows) + sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])),
        "first_initial": initials[0], "last_initial": initials[-1], "min_turn": turns[0] if turns else None,
        "max_turn": turns[-1] if turns else None, "n_turns": len(set(turns)),
    }


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of the rows of a task, which come from the last to the first."""
    task = TaskContext.get().partitionId()
    state: dict = {"conv": None, "later": NOTHING, "block": 0}
    schema = _arrow(BLOCK)

    def block(rows: list[dict]) -> dict:
        conv = (rows[0]["has_conv"], rows[0]["conv"])
        if conv != state["conv"]:
            state.update(conv=conv, later=NOTHING)
        rows = rows[::-1]
        later, table = state["later"], block_table(tuple((r["code"], r["copies"]) for r in rows))
        state["block"] -= 1
        state["later"] = compose(table, later)
        return {"has_conv": conv[0], "conv": conv[1], "task": task, "block": state["block"], "codes": [r["code"] for r in rows],
                "copies": [r["copies"] for r in rows], "roles": [r["role"] for r in rows], "texts": [r["text"] for r in rows],
                **_facts(rows), "later": later, "upto": state["later"]}

    held: list[dict] = []
    size = 0
    for part in in_parts(batches):
        out = []
        for row in part.to_pylist():
            new = bool(held) and (row["has_conv"], row["conv"]) != (held[0]["has_conv"], held[0]["conv"])
            if new or len(held) == BLOCK_ROWS or size > BLOCK_BYTES:
                out.append(block(held))
                held, size = [], 0
            held.append(row)
            size += len(row["text"])
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)
    if held:
        yield pa.RecordBatch.from_pylist([block(held)], schema)


AHEAD = "has_conv boolean, conv long, task int, after array<long>"


def _ahead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For (conversation, task) the costs of all rows behind that task's, from each state; tasks come from the last on."""
    conv, after = None, CLOSING
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            if (r["has_conv"], r["conv"]) != conv:
                conv, after = (r["has_conv"], r["conv"]), CLOSING
            out.append({"has_conv": conv[0], "conv": conv[1], "task": r["task"], "after": after})
            after = compose(tuple(r["upto"]), after)
        yield pa.RecordBatch.from_pylist(out, _arrow(AHEAD))


CHOICE = "has_conv boolean, conv long, task int, block long, choices array<struct<cost:long,edits:string,end:int>>"


def _choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in in_parts(batches):
        out = []
        for r in part.to_pylist():
            after = compose(tuple(r["later"]), tuple(r["after"]))
            least = min(after)  # only differences matter; equal blocks meet in the cache
            got = block_choices(tuple(zip(r["codes"], r["copies"])), tuple(x - least for x in after))
            out.append({k: r[k] for k in ("has_conv", "conv", "task", "block")}
                       | {"choices": [dict(zip(("cost", "edits", "end"), c)) for c in got]})
        yield pa.RecordBatch.from_pylist(out, _arrow(CHOICE))


PIECE = f"has_conv boolean, conv long, task int, block long, cost long, edits string, repaired array<struct<role:string,text:string>>, {FACTS}"
_ROLE = {"u": "user", "a": "assistant"}


def _put_out(edits: str, start: int, rows: list[tuple[str, str]]) -> list[dict]:
    """The repaired turns of a block; ``rows`` are (role, text) of every edit that takes one."""
    out, last, k = [], "?sua"[start], 0
    for e in edits:
        row = rows[k] if e != "I" else ("", "")
        k += e != "I"
        if e == "D":
            continue
        turn = "a" if last == "u" else "u"
        last = row[0][:1] if e == "K" else turn
        out.append({"role": row[0] if e == "K" else _ROLE[turn], "text": row[1]})
    return out


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversations in order, for each block first its choices, then its rows; an opening row without either begins a
    conversation, and its closing inserts go with the last block."""
    schema = _arrow(PIECE)
    conv, state, choices, held = None, START, None, None

    def close(piece: dict | None) -> list[dict]:
        if piece is None:
            return []
        tail = "I" * (CLOSING[state] // INSERT)
        return [piece | {"cost": piece["cost"] + CLOSING[state], "edits": piece["edits"] + tail,
                         "repaired": piece["repaired"] + _put_out(tail, state, [])}]

    for part in in_parts(batches):
        out = []
        for r in part.to_pylist():
            if (r["has_conv"], r["conv"]) != conv:
                out += close(held)
                conv, state = (r["has_conv"], r["conv"]), START
                held = {f.name: r.get(f.name) for f in schema} | {"cost": 0, "edits": "", "repaired": [], "n": 0, "blank": 0,
                                                                  "duplicate": 0, "truncated": 0, "illegal": 0, "n_turns": 0}
            if r["choices"] is not None:
                choices = r["choices"]
            elif r["texts"] is not None:
                out.append(held)
                c = choices[state]
                rows = [(a, b) for a, b, n in zip(r["roles"], r["texts"], r["copies"]) for _ in range(n)]
                held = {f.name: r.get(f.name) for f in schema} | {"cost": c["cost"], "edits": c["edits"],
                                                                  "repaired": _put_out(c["edits"], state, rows)}
                state = c["end"]
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)
    if held:
        yield pa.RecordBatch.from_pylist(close(held), schema)


def repair(turns: DataFrame, copies: str | None = None) -> DataFrame:
    """The repaired conversations in pieces: has_conv, conv, task and block (their order), edits, cost, the repaired
    turns, and counts of the faults. Each conversation lies in one partition, its pieces in order; the first piece of
    each is empty. ``copies`` names the column that says how often a row stands there (none: once)."""
    conv = ["has_conv", "conv"]
    keys = [*conv, "has_turn", "turn", "role", F.substring("text", 1, 1000), "digest"]
    rows = _prepared(turns, F.col(copies) if copies else F.lit(1)).repartitionByRange(*keys)
    ordered = rows.sortWithinPartitions(*[F.desc(k) if isinstance(k, str) else k.desc() for k in keys])
    blocks = stored(ordered.mapInArrow(_cut, BLOCK), "turns")
    runs = blocks.groupBy(*conv, "task").agg(F.min_by("upto", "block").alias("upto"))
    ahead = runs.repartition(*conv).sortWithinPartitions(*conv, F.desc("task")).mapInArrow(_ahead, AHEAD)
    costs = blocks.select(*conv, "task", "block", "codes", "copies", "later").join(ahead, [*conv, "task"])
    choices = costs.mapInArrow(_choose, CHOICE)
    names = [f.name for f in blocks.schema if f.name not in ("codes", "later", "upto")]
    opening = turns.select(F.col("conv_id").cast("long").alias("c")).distinct().select(
        F.col("c").isNotNull().alias("has_conv"), F.coalesce("c", F.lit(0)).alias("conv"), F.lit(-1).alias("task"),
        F.lit(-(1 << 62)).cast("long").alias("block"))
    every = (blocks.select(*names).unionByName(choices, allowMissingColumns=True)
             .unionByName(opening, allowMissingColumns=True))
    # choices (no texts) sort before the rows of their block
    return every.repartition(*conv).sortWithinPartitions(*conv, "task", "block", F.col("texts").isNotNull()).mapInArrow(_walk, PIECE)


SUMMARY = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
           "repaired_sha256 string")


def _sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = _arrow(SUMMARY)
    row: dict | None = None
    edits: list[str] = []
    low = high = initial = None
    distinct = 0
    text = hashlib.sha256()
    wrote = False

    def close() -> list[dict]:
        if row is None:
            return []
        gaps = 0 if low is None else high - low + 1 - distinct
        return [row | {"gaps": gaps, "audit": "".join(edits), "repaired_sha256": text.hexdigest()}]

    conv = None
    for batch in in_parts(batches):
        out = []
        for r in batch.to_pylist():
            if (r["has_conv"], r["conv"]) != conv:
                out += close()
                conv = (r["has_conv"], r["conv"])
                row = {"conv_id": r["conv"] if r["has_conv"] else None, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0}
                edits, low, high, initial, distinct, text, wrote = [], None, None, None, 0, hashlib.sha256(), False
            for k in ("blank", "duplicate", "truncated", "illegal", "cost"):
                row[k] += r[k]
            edits.append(r["edits"])
            if r["n"]:
                row["illegal"] += initial is not None and initial + r["first_initial"] not in LEGAL
                initial = r["last_initial"]
            if r["min_turn"] is not None:
                distinct += r["n_turns"] - (high == r["min_turn"])
                low, high = r["min_turn"] if low is None else low, r["max_turn"]
            for t in r["repaired"]:
                text.update((("\n" if wrote else "") + t["role"] + ":" + t["text"]).encode())
                wrote = True
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)
    if row is not None:
        yield pa.RecordBatch.from_pylist(close(), schema)


def summary(repaired: DataFrame) -> DataFrame:
    """One row per conversation of ``repair``'s result: faults, cost, the whole audit and the digest of the repaired
    turns (``role:text``, joined by newlines)."""
    return repaired.mapInArrow(_sum_up, SUMMARY)


def damaged(turns: DataFrame) -> DataFrame:
    """Rows damaged by the checksum of ``conv_id:turn`` (nulls: one space) modulo 20: 0 takes the row away, 1 empties its
    text, 2 takes ``.!?`` out of it, 3 doubles the row, 4 makes its role user. The column ``copies`` says how often a row
    stands there then (0: not at all)."""
    space = F.lit(" ")

    def known(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), space)

    fault = F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn")).cast("binary")) % 20
    text = F.when(fault == 1, "").when(fault == 2, F.translate(known("text"), ".!?", "")).otherwise(known("text"))
    copies = F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1)
    return turns.select("conv_id", "turn", F.when(fault == 4, "user").otherwise(known("role")).alias("role"),
                        text.alias("text"), copies.alias("copies"))
