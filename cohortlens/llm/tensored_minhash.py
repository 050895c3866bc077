"""Near-duplicate documents by MinHash with tensored banding, candidates verified on full shingle sets (operator 8).

Two collections of ``m`` sub-keys, each of two MinHash values, give m * m table keys of four values by pairing a
sub-key of one collection with a sub-key of the other: 4m MinHash values do the work of 4m * m. A table key can only
be shared where both its sub-keys are, so only pairs of sub-keys that occur elsewhere are formed. With m = 11, two
sets of similarity s meet in a table with probability (1 - (1 - s^2)^11)^2: 0.9998 at s = 0.75.

Equal sets are one class with one representative, so groups of copies cost one row each. Round one verifies, for
every representative, the bucket leader it shares most tables with. Rounds two and three look again at the buckets
that still hold different components: first each row with the nearest one of another component, then all pairs
across components that can be similar. A pair is left out only where its sizes, or its parity bits, prove that it is not:
each of a set's 2,048 bits is the parity of the shingles that fall on it, so two sets differ in at least as many shingles
as in bits. Large buckets are split into blocks and met block against block, the rows of a bucket's largest component with
the others only, so no task holds a whole bucket, a family of near copies is not met with itself again, and no bucket or
candidate list is capped. Links are confirmed on the full sets; components come from a distributed contraction, and the
links of a later round join the components there are. Steps are stored and deleted as soon as nothing reads them any
more, and the shuffles of each are freed with it, so disk holds the largest step and not the sum of all.

Defined cases: null texts and texts without words have an empty set and are linked with nothing; texts with fewer
words than a shingle have one shingle, the whole sequence; repeated rows are linked as equal sets; ties cannot
arise (the least id names a component); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.llm import textkit as T
from cohortlens.llm.components import connected, joined
from cohortlens.llm.shared import dropped, freed_shuffles, of_ids, opened, stored

PARITY = 2048
_RNG = np.random.default_rng(7)
_MULT = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64)


def shingle_sets(data: np.ndarray, offs: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct shingles of each row, sorted by row and hash."""
    n = len(offs) - 1
    low = T.LOWER[data]
    starts, ends, row = T.word_spans(low, offs)
    h = T.span_hashes(low, starts, ends)
    key, first = T.windows(h, row, width)
    count = np.bincount(row, minlength=n)
    short = np.flatnonzero((count > 0) & (count < width))
    begin = np.concatenate([[0], np.cumsum(count)])
    whole = np.zeros(len(short), np.uint64)
    for k in range(width - 1):
        more = count[short] > k
        whole[more] = T.mix(whole[more] * np.uint64(0x9E3779B97F4A7C15) + h[begin[short[more]] + k] + np.uint64(k + 1))
    rows = np.concatenate([row[first], short])
    keys = np.concatenate([key, whole])
    order = np.lexsort((keys, rows))
    rows, keys = rows[order], keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (keys[1:] != keys[:-1])
    return rows[new], keys[new]


def signatures(keys: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """MinHash values (32 bits) of consecutive non-empty sets that start at ``at``."""
    out = np.empty((len(at), size), np.uint32)
    for i in range(size):
        out[:, i] = np.minimum.reduceat(((keys * _MULT[i] + _ADD[i]) >> np.uint64(32)).astype(np.uint32), at)
    return out


def _sketch(width: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offs in T.slices(batch.column("text")):
                rows, keys = shingle_sets(data, offs, width)
                n = np.bincount(rows, minlength=hi - lo)
                full = np.flatnonzero(n)
                at = (np.cumsum(n) - n)[full]
                sums, sigs = np.zeros((2, hi - lo), np.uint64), np.full(hi - lo, None, object)
                if len(full):
                    for k in range(2):
                        sums[k, full] = np.add.reduceat(T.mix(keys ^ _ADD[200 + k]), at)
                    sigs[full] = [s.tobytes() for s in signatures(keys, at, size)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), pa.array(n.astype(np.int64)), *[pa.array(s.view(np.int64)) for s in sums],
                     pa.array(sigs.tolist(), pa.binary())], names=["doc_id", "n", "d1", "d2", "sig"])
    return run


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in opened(batches):
            for lo, hi, data, offs in T.slices(batch.column("text")):
                rows, keys = shingle_sets(data, offs, width)
                cut = np.searchsorted(rows, np.arange(hi - lo + 1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo),
                     pa.array([keys[a:b].tobytes() for a, b in zip(cut, cut[1:], strict=False)], pa.binary())], names=["id", "items"])
    return run


def parity_bits(keys: np.ndarray) -> np.ndarray:
    """For each of ``PARITY`` places whether an odd number of shingles falls on it, packed in 64-bit words."""
    on = np.bincount((T.mix(keys) % np.uint64(PARITY)).astype(np.int64), minlength=PARITY) & 1
    return np.packbits(on.astype(bool)).view(np.uint64)


def can_link(bits_x: np.ndarray, bits_y: np.ndarray, n_x: np.ndarray, n_y: np.ndarray, percent: int) -> np.ndarray:
    """False only for sets that are surely less similar: the sets differ in d shingles or more, d the bits in which their
    parities differ, and similar ones differ in at most (100 - percent) / (100 + percent) of the sum of their sizes."""
    differ = np.bitwise_count(bits_x ^ bits_y).sum(-1, dtype=np.int64)
    return (100 + percent) * differ <= (100 - percent) * (n_x + n_y)


def _parity_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(rep, parity) of each set."""
    for batch in batches:
        bits = [parity_bits(np.frombuffer(x.as_buffer(), np.uint64)).tobytes() for x in batch.column("items")]
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(bits, pa.binary())], names=["rep", "parity"])


def _sub_keys(m: int):
    """(key, rep, slot): the 2m sub-keys of each representative, two MinHash values each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint32).reshape(-1, 4 * m).astype(np.uint64)
            slot = np.arange(2 * m)
            key = T.mix((sig[:, 0::2] << np.uint64(32) | sig[:, 1::2]) ^ _MULT[slot])
            rep = np.repeat(batch.column("rep").to_numpy(), 2 * m)
            yield pa.RecordBatch.from_arrays([pa.array(key.ravel().view(np.int64)), pa.array(rep),
                                              pa.array(np.tile(slot, len(key)).astype(np.int32))], names=["key", "rep", "slot"])
    return run


def _tables(m: int):
    """(key, rep, slot): the table keys of each representative, from its shared sub-keys of both collections; ``slot``
    numbers the table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, reps, tables = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
            for rep, subs in zip(batch.column("rep").to_pylist(), batch.column("subs"), strict=True):
                slot = subs.values.field("slot").to_numpy()
                key = subs.values.field("key").to_numpy().view(np.uint64)
                a, b = key[slot < m], key[slot >= m]
                pairs = T.mix(a[:, None] * np.uint64(0x9E3779B97F4A7C15) + b[None, :]).ravel()
                keys.append(pairs)
                reps.append(np.full(len(pairs), rep))
                tables.append((slot[slot < m][:, None] * m + slot[slot >= m][None, :] - m).ravel().astype(np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(reps)),
                                             pa.array(np.concatenate(tables))], names=["key", "rep", "slot"])
    return run


def _shared(extra: str | None):
    """From rows sorted by (key, rep): the rows whose key has a second one, with the key's first rep as leader.
    Only the last row of a batch is carried on, so a key of any number of rows streams through."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple | None = None  # key, rep, extra, leader, whether it was given out
        names = ["key", "rep", *([extra] if extra else [])]
        for batch in batches:
            if not batch.num_rows:
                continue
            key, rep = batch.column("key").to_numpy(), batch.column("rep").to_numpy()
            more = batch.column(extra).to_numpy() if extra else None
            n = len(key)
            starts = np.ones(n, bool)
            starts[1:] = key[1:] != key[:-1]
            carried = last is not None and last[0] == key[0]
            starts[0] = not carried
            head = np.maximum.accumulate(np.where(starts, np.arange(n), 0))
            leader = rep[head]
            if carried:
                leader[:np.flatnonzero(starts)[0] if starts.any() else n] = last[3]
            goes_on = np.zeros(n, bool)
            goes_on[:-1] = ~starts[1:]
            out = ~starts | goes_on
            cols = [key[out], rep[out], *([more[out]] if extra else []), leader[out]]
            if carried and not last[4]:
                first = [last[0], last[1], *([last[2]] if extra else []), last[3]]
                cols = [np.concatenate([np.array([x], c.dtype), c]) for x, c in zip(first, cols, strict=True)]
            last = (key[-1], rep[-1], more[-1] if extra else None, leader[-1], bool(out[-1]))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=[*names, "leader"])
    return run


def _similar(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * both >= percent * (len(x) + len(y) - both))
            keep = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["a", "b"])
    return run


def verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets (id, items) reach the similarity; by the same joins at every size."""
    y, x = sets.withColumnsRenamed({"id": "b", "items": "y"}), sets.withColumnsRenamed({"id": "a", "items": "x"})
    return pairs.select("a", "b").join(y.hint("merge"), "b").join(x.hint("merge"), "a").select("a", "b", "x", "y").mapInArrow(_similar(percent), "a long, b long")


def _across(block_sort: list[str], least: int, percent: int, nearest: bool):
    """From rows sorted by (key, i, j): the pairs of different components whose sizes and parities allow a link. A pair
    meets in many tables; it is given out in the first of them only, which its signatures tell. With ``nearest``: for
    each row only the one whose signature agrees most, if in ``least`` values, with that number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([held, table]) if held is not None else table
            held = None
            if table.num_rows:
                ends = _runs(table, block_sort)
                held = table.slice(ends[-2])  # the last group may go on in the next batch
                yield _pairs(table.slice(0, ends[-2]), block_sort, least, percent, nearest)
        if held is not None:
            yield _pairs(held, block_sort, least, percent, nearest)
    return run


def _runs(table: pa.Table, by: list[str]) -> np.ndarray:
    new = np.zeros(table.num_rows, bool)
    new[:1] = True
    for c in by:
        v = table.column(c).to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return np.append(np.flatnonzero(new), table.num_rows)


def _pairs(table: pa.Table, by: list[str], least: int, percent: int, nearest: bool) -> pa.RecordBatch:
    out = [[np.zeros(0, np.int64)] for _ in range(3)]
    if table.num_rows:
        ends = _runs(table, by)
        rep, comp, n, sub = (table.column(c).to_numpy() for c in ("rep", "component", "n", "sub"))
        i, j, slot = (table.column(c).to_numpy() for c in ("i", "j", "slot"))
        sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint32).reshape(table.num_rows, -1)
        bits = np.frombuffer(b"".join(table.column("parity").to_pylist()), np.uint64).reshape(table.num_rows, -1)
        for s, e in zip(ends, ends[1:], strict=False):
            left = s + np.flatnonzero(sub[s:e] == i[s])
            right = s + np.flatnonzero(sub[s:e] == j[s])
            for p in left:  # one row against the block at a time: memory follows the block, not its square
                q = right if nearest or i[s] != j[s] else right[rep[right] > rep[p]]
                q = q[(comp[q] != comp[p]) & (100 * np.minimum(n[q], n[p]) >= percent * np.maximum(n[q], n[p]))]
                same = sig[q] == sig[p]
                if nearest:
                    agree = same.sum(1)
                    q = q[agree >= max(least, agree.max(initial=0))][:1]
                    for o, v in zip(out, (np.repeat(rep[p], len(q)), rep[q], agree.max(initial=0).repeat(len(q))), strict=True):
                        o.append(v)
                    continue
                met = same[:, 0::2] & same[:, 1::2]  # sub-keys in common, of the first collection and the second
                m = met.shape[1] // 2
                q = q[met[:, :m].argmax(1) * m + met[:, m:].argmax(1) == slot[p]]
                q = q[can_link(bits[q], bits[p], n[q], n[p], percent)]
                for o, v in zip(out, (np.minimum(rep[p], rep[q]), np.maximum(rep[p], rep[q]), np.zeros(len(q), np.int64)), strict=True):
                    o.append(v)
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(o).astype(np.int64)) for o in out], names=["a", "b", "agree"])


def _candidates(buckets: DataFrame, comps: DataFrame, reps: DataFrame, m: int, block: int, least: int, percent: int,
                nearest: bool) -> DataFrame:
    """Pairs (a, b) across components that share a bucket, see ``_across``; large buckets are met block by block."""
    if nearest:
        buckets = buckets.where(F.expr(f"slot div {m} = slot % {m}"))
    named = (buckets.select("key", "rep", "slot").join(comps.withColumnRenamed("v", "rep").hint("merge"), "rep", "left")
             .select("key", "rep", "slot", F.coalesce("component", "rep").alias("component")))
    # the rows of a bucket's largest component meet only the others, which are few where a family fills the bucket
    mixed = (named.groupBy("key", "component").agg(F.count("*").alias("c"))
             .groupBy("key").agg(F.max(F.struct("c", "component")).alias("main"), F.sum("c").alias("rows"), F.count("*").alias("kinds"))
             .where("kinds > 1").select(
                 "key", F.col("main.component").alias("main"), "kinds", (F.col("rows") <= block).alias("small"),
                 F.ceil(F.col("main.c") / block).cast("int").alias("main_parts"),
                 F.ceil((F.col("rows") - F.col("main.c")) / block).cast("int").alias("other_parts")))
    first = F.col("component") == F.col("main")
    parts = F.when(first, F.col("main_parts")).otherwise(F.col("other_parts"))
    place = F.pmod(F.xxhash64("rep"), parts).cast("int")
    sub = F.when(F.col("small"), 0).when(first, place).otherwise(-1 - place).cast("int")  # blocks of others are negative

    def blocks(last: str, pair) -> Column:
        return F.transform(F.sequence(F.lit(0), F.col(last) - 1), lambda k: F.struct(*[x.cast("int").alias(c) for x, c in zip(pair(k), "ij")]))

    none = F.slice(blocks("main_parts", lambda k: (k, k)), 1, 0)
    others = F.when(F.col("kinds") > 2, blocks("other_parts", lambda k: (F.least("sub", -1 - k), F.greatest("sub", -1 - k)))).otherwise(none)
    groups = (F.when(F.col("small"), F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j"))))
              .when(first, blocks("other_parts", lambda k: (-1 - k, F.col("sub"))))
              .otherwise(F.concat(blocks("main_parts", lambda k: (F.col("sub"), k)), others)))
    member = (named.join(mixed.hint("merge"), "key").withColumn("sub", sub).withColumn("at", F.explode(groups))
              .select("key", "rep", "slot", "component", "sub", "at.i", "at.j"))
    group = ["key", "i", "j"]
    found = (member.join(reps.hint("merge"), "rep").repartition(*group).sortWithinPartitions(*group)
             .mapInArrow(_across(group, least, percent, nearest), "a long, b long, agree long"))
    if nearest:
        return found.groupBy("a").agg(F.max(F.struct("agree", "b")).alias("x")).select("a", F.col("x.b").alias("b"))
    return found.select("a", "b").distinct()


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 75, m: int = 11, block: int = 512) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row."""
    with freed_shuffles(docs.sparkSession):
        rows, comps = _linked(docs, width, percent, m, block)
    named_docs = (rows.join(comps.withColumnsRenamed({"v": "rep"}), "rep", "left")
                  .withColumn("component_id", F.coalesce("component", "rep", "doc_id")))
    return named_docs.select("doc_id", F.col("n").alias("n_shingles"), "component_id",
                             (F.col("doc_id") == F.col("component_id")).alias("kept"))


def _linked(docs: DataFrame, width: int, percent: int, m: int, block: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n, rep) of every row, with the representative of its class, and the components (v, component) of the
    representatives that are linked. What else is stored on the way is deleted."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    sketch = stored(texts.mapInArrow(_sketch(width, 4 * m), "doc_id long, n long, d1 long, d2 long, sig binary"))
    slim = sketch.drop("sig")
    classes = stored(slim.where("n > 0").groupBy("d1", "d2", "n").agg(F.min("doc_id").alias("rep")))
    reps = stored(classes.select("rep", "n", "d1", "d2").join(
        sketch.where("n > 0").withColumnRenamed("doc_id", "rep"), ["rep", "n", "d1", "d2"])
        .dropDuplicates(["rep"]).select("rep", "n", "sig"))
    rows = stored(slim.join(classes, ["d1", "d2", "n"], "left").select("doc_id", "n", "rep"))
    dropped(spark, [sketch, classes])

    def by_key(rows: DataFrame, extra: str | None, schema: str) -> DataFrame:
        return rows.repartition("key").sortWithinPartitions("key", "rep").mapInArrow(_shared(extra), schema + ", leader long")

    subs = by_key(reps.select("rep", "sig").mapInArrow(_sub_keys(m), "key long, rep long, slot int"), "slot", "key long, rep long, slot int")
    paired = (subs.groupBy("rep").agg(F.collect_list(F.struct("slot", "key")).alias("subs"))  # at most 2m per representative
              .where(F.exists("subs", lambda s: s.slot < m) & F.exists("subs", lambda s: s.slot >= m)))
    buckets = stored(by_key(paired.mapInArrow(_tables(m), "key long, rep long, slot int"), "slot", "key long, rep long, slot int"))

    # round one: the leader with which a representative shares most tables
    shared = buckets.where("leader <> rep").groupBy("rep", "leader").agg(F.count("*").alias("tables"))
    best = shared.groupBy("rep").agg(F.max(F.struct("tables", "leader")).alias("x")).select(F.col("x.leader").alias("a"), F.col("rep").alias("b"))
    ids = buckets.select(F.col("rep").alias("doc_id")).distinct()
    sets = stored(of_ids(texts, ids).mapInArrow(_sets(width), "id long, items binary").dropDuplicates(["id"]))
    links = stored(verify(best, sets, percent))
    comps = connected(links)

    # rounds two and three: buckets that hold more than one component; first the nearest row of another component for
    # each row, in the diagonal tables, then every pair that is left
    least = int(4 * m * (percent / 100 - 0.19))  # only the nearest round skips those below; the last one does not
    sharp = stored(reps.join(sets.where(F.length("items") > 0).mapInArrow(_parity_task, "rep long, parity binary").hint("merge"), "rep"))
    dropped(spark, [links, reps])
    for nearest in (True, False):
        pairs = _candidates(buckets, comps, sharp, m, block, least, percent, nearest)
        more = stored(verify(pairs, sets, percent))
        if not more.isEmpty():
            before, comps = comps, joined(comps, more)
            dropped(spark, [before])
        dropped(spark, [more])
    dropped(spark, [buckets, sets, sharp])
    return rows, comps
