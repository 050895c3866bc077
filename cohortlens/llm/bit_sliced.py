"""Exact top-k inner products on a bit-sliced index (operator 4).

Vectors are quantised to integers and dealt into blocks. A block's index holds, for every attribute and every bit,
one bitmap over its rows (the attribute shifted to start at 0). A query adds the slices of all attributes, shifted
by the bits of its own components, with carry-save bitmap arithmetic; negative components add the complemented
slices. The sum's slices are then read from the most significant one downward: rows that have a bit stay ahead of
those that lack it until ``k`` rows are fixed, and rows that tie at the boundary are resolved exactly by id. This is done
with the upper slices and the upper bits of the query first, to drop the rows that they prove to lie below ``k`` others;
where few are left, their scores are taken from their values, else from the sum of all slices. Each block gives its own
best ``k`` for each query, and a last step ranks those.

Rows are packed into blocks, and the stated queries into batches, partition by partition as they are read. A task holds
one part of the batches and streams one part of the blocks past them, keeping the best ``k`` of each query as it goes.
What is shuffled is the blocks and the batches, once each; a part of either has a bounded size, so neither the driver
nor a task holds more of them as the table grows, and no pair of rows is ever shuffled.

Defined cases: vectors that are null or hold a null or non-finite component, and rows without an id, take no part; missing components of
shorter vectors count as 0; ties go to the smaller id; repeated ids are rows of their own, a query's own id is never
its answer; an empty table gives no rows; other columns are ignored. Scores must fit a 64-bit integer.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.session import cut_lineage


def pack_bits(flags: np.ndarray) -> np.ndarray:
    """Rows of flags as rows of 64-bit words."""
    pad = -flags.shape[-1] % 64
    flags = np.concatenate([flags, np.zeros((*flags.shape[:-1], pad), bool)], -1)
    return np.packbits(flags, axis=-1, bitorder="little").view(np.uint64)


#: Slices of the rows and bits of a query (of each, the most significant) that tell which rows can be among the best.
_UPPER_SLICES, _UPPER_BITS = 6, 4


class Slices:
    """Bit-sliced index of one block: ``planes[bit, attribute]`` are bitmaps over the rows, followed by their
    complements; ``low`` the shifts."""

    def __init__(self, x: np.ndarray):
        self.x, self.n, self.wide = x, *x.shape
        self.low = x.min(0)
        shifted = x - self.low
        self.depth = max(int(shifted.max()).bit_length(), 1) if shifted.size else 1
        self.ones = pack_bits(np.ones((1, self.n), bool))[0]
        columns = np.ascontiguousarray(shifted.T)
        planes = np.stack([pack_bits((columns >> b) & 1 == 1) for b in range(self.depth)])
        self.planes = np.concatenate([planes, ~planes & self.ones], 1)
        self.cut = max(0, self.depth - _UPPER_SLICES)
        # means of what lies above and below the cut, and how far from them a row lies at most
        (self.upper, self.far), (self.lower, self.near) = (
            (part.mean(0), np.sqrt(((part - part.mean(0)) ** 2).sum(1).max())) for part in (shifted >> self.cut, shifted & ((1 << self.cut) - 1)))

    def sums(self, q: np.ndarray, cut: int = 0) -> tuple[list[np.ndarray], int]:
        """Slices of the inner products with the attributes' bits from ``cut`` on, least significant first, and the
        constant to add to their value (the shifts are left out)."""
        size, depth = np.abs(q), self.depth - cut
        base = -int(size[q < 0].sum()) * ((1 << depth) - 1)
        source = np.arange(self.wide) + self.wide * (q < 0)
        chosen = [source[(size >> i) & 1 == 1] for i in range(int(size.max(initial=0)).bit_length())]
        out, carries = [], []
        while len(out) < depth + len(chosen) - 1 or carries:
            p = len(out)
            here = [(self.planes[cut + p - i], c) for i, c in enumerate(chosen) if 0 <= p - i < depth]
            n = sum(len(c) for _, c in here) + sum(map(len, carries))
            rows, at = np.empty((max(n, 1), len(self.ones)), np.uint64), 0
            for plane, c in here:
                plane.take(c, 0, out=rows[at:at + len(c)], mode="clip")
                at += len(c)
            for c in carries:
                rows[at:at + len(c)] = c
                at += len(c)
            carries = []
            while n > 1:  # carry-save adders: three (or two) bitmaps become a sum and a carry
                m = n // 3
                if m:  # in place: the sums stay among the rows, the carries take the room of the last ones
                    c, b, a = rows[n - 3 * m:n - 2 * m], rows[n - 2 * m:n - m], rows[n - m:n]
                    half = a ^ b
                    a &= b
                    a |= np.bitwise_and(half, c, out=b)
                    c ^= half
                    carries.append(a)
                    n -= 2 * m
                else:
                    carries.append(rows[:1] & rows[1:2])
                    rows[0] ^= rows[1]
                    n = 1
            out.append(rows[0] if n else np.zeros(len(self.ones), np.uint64))
        return out, base

    def best(self, slices: list[np.ndarray], k: int, allowed: np.ndarray) -> np.ndarray:
        """Row numbers of the ``k`` allowed rows of largest sums, boundary ties to the lower row number."""
        fixed, level = np.zeros_like(self.ones), allowed
        for s in reversed(slices):
            have = fixed | (level & s)
            count = int(np.bitwise_count(have).sum())
            if count > k:
                level = level & s
            else:
                fixed, level = have, level & ~s
        sure, tied = _rows(fixed), _rows(level)
        return np.concatenate([sure, tied[:k - len(sure)]])

    def within_reach(self, q: np.ndarray, k: int, allowed: np.ndarray, floor: int | None) -> np.ndarray:
        """The allowed rows without those whose upper slices prove a score below ``floor``, or, where none is given,
        below those of ``k`` others. What the cut bits of rows and query add differs from its mean by at most the
        product of two lengths (Cauchy and Schwarz)."""
        drop = max(0, int(np.abs(q).max(initial=0)).bit_length() - _UPPER_BITS)
        g = (q + ((1 << drop) >> 1)) >> drop
        slices, base = self.sums(g, self.cut)
        if floor is None:
            rows = self.best(slices, k, allowed)
            if len(rows) < k:
                return allowed
            floor = int((self.x[rows] @ q).min())
        f, e, unit = q.astype(float), (q - (g << drop)).astype(float), 2.0 ** self.cut
        mean = f @ self.low + f @ self.lower + unit * (e @ self.upper)
        slack = np.sqrt(f @ f) * self.near + unit * np.sqrt(e @ e) * self.far
        slack += 1 + 1e-13 * (1 + self.wide) * (np.abs(f) @ (np.abs(self.low) + 2.0 ** self.depth))  # of the doubles
        least = int(np.floor((floor - mean - slack) / (unit * 2.0 ** drop))) - base
        if least <= 0:
            return allowed
        if least >> len(slices):
            return np.zeros_like(allowed)
        above, level = np.zeros_like(allowed), allowed
        for p in reversed(range(len(slices))):
            if least >> p & 1:
                level = level & slices[p]
            else:
                above, level = above | (level & slices[p]), level & ~slices[p]
        return above | level

    def top_k(self, q: np.ndarray, k: int, allowed: np.ndarray, floor: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(row numbers, scores) of the ``k`` best allowed rows, boundary ties to the lower row number. Rows below
        ``floor`` may be left out."""
        reach = self.within_reach(q, k, allowed, floor)
        if int(np.bitwise_count(reach).sum()) <= max(k, self.n // 8):
            rows = _rows(reach)
            score = self.x[rows] @ q
            order = np.lexsort((rows, ~score))[:k]  # ~ turns the order of integers round without overflow
            return rows[order], score[order]
        slices, base = self.sums(q)
        rows = self.best(slices, k, reach)
        score = np.full(len(rows), base + int((q * self.low).sum()), np.int64)
        word, shift = rows // 64, (rows % 64).astype(np.uint64)
        for p, s in enumerate(slices):
            score += ((s[word] >> shift) & np.uint64(1)).astype(np.int64) << p
        return rows, score


def _rows(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


#: A block or batch: its ids and vectors (integers of ``item`` bytes, row by row), and which rows are queries.
_PACKED = "n long, ids binary, vectors binary, item int, n_asked long, asked binary"

#: Numbers in a block or batch; it has fewer rows where vectors are long.
_VALUES = 1 << 20

#: Rows that a task streams past its queries; answers that it keeps for those, and bytes of their vectors.
_PART_ROWS, _PART_ANSWERS, _PART_BYTES = 1 << 17, 1 << 19, 1 << 24

#: Tasks there are at least, if the rows suffice.
_TASKS = 64


def _matrix(vectors: pa.ListArray) -> np.ndarray:
    lengths = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
    x = np.zeros((len(vectors), lengths.max(initial=0)), np.int64)
    x[np.arange(x.shape[1]) < lengths[:, None]] = vectors.flatten().to_numpy()
    return x


def _pack(most: int):
    """Rows of (vec_id, q, asked) as blocks of at most ``most`` rows."""
    def block(rows: pa.Table) -> pa.RecordBatch:
        ids, asked = rows.column("vec_id").to_numpy(), rows.column("asked").to_numpy().astype(bool)
        x = _matrix(rows.column("q").combine_chunks())
        low, high = x.min(initial=0), x.max(initial=0)
        item = next(b for b in (1, 2, 4, 8) if np.iinfo(f"i{b}").min <= low and high <= np.iinfo(f"i{b}").max)
        cols = [(len(ids), pa.int64()), (ids.astype("<i8").tobytes(), pa.binary()), (x.astype(f"<i{item}").tobytes(), pa.binary()),
                (item, pa.int32()), (int(asked.sum()), pa.int64()), (asked.tobytes(), pa.binary())]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in cols], names=["n", "ids", "vectors", "item", "n_asked", "asked"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in chain(batches, [None]):
            if batch is not None:
                new = pa.Table.from_batches([batch])
                rest = new if rest is None else pa.concat_tables([rest, new])
            while rest is not None and rest.num_rows:
                widest = pc.max(pc.list_value_length(rest.column("q").slice(0, most))).as_py()
                rows = min(most, max(64, _VALUES // max(widest, 1)))
                if rest.num_rows < rows and batch is not None:
                    break
                yield block(rest.slice(0, rows))
                rest = rest.slice(rows)
    return run


def _opened(batch: pa.RecordBatch, at: int, prefix: str = "") -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of a block or batch."""
    ids = np.frombuffer(batch.column(f"{prefix}ids")[at].as_py(), "<i8")
    x = np.frombuffer(batch.column(f"{prefix}vectors")[at].as_py(), f"<i{batch.column(f'{prefix}item')[at].as_py()}")
    return ids, x.reshape(len(ids), len(x) // len(ids))


def _asked_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The queries among the rows of blocks."""
    for batch in batches:
        for at in range(batch.num_rows):
            ids, x = _opened(batch, at)
            asked = np.frombuffer(batch.column("asked")[at].as_py(), bool)
            q = x[asked].astype(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(q) + 1) * q.shape[1], pa.int32()), pa.array(q.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(ids[asked]), lists, pa.array(np.ones(len(q), bool))], names=["vec_id", "q", "asked"])


class Best:
    """The best ``k`` rows so far of each query of a batch: score, row id, and whether the place is taken."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.score, self.row = np.zeros((2, len(ids), k), np.int64)
        self.taken = np.zeros((len(ids), k), bool)

    def add(self, row_ids: np.ndarray, index: Slices, wide: int) -> None:
        """``row_ids``: the ids of the index's rows, in order."""
        q = self.vectors[:, :wide].astype(np.int64)
        q = np.pad(q, ((0, 0), (0, wide - q.shape[1])))
        own = np.stack([np.searchsorted(row_ids, self.ids, side) for side in ("left", "right")], 1)
        score, row, taken = np.zeros_like(self.score), np.zeros_like(self.row), np.zeros_like(self.taken)
        for i, (first, end) in enumerate(own):
            allowed = index.ones
            if first < end:
                at = np.arange(index.n)
                allowed = pack_bits(((at < first) | (at >= end))[None])[0]
            rows, found = index.top_k(q[i], self.k, allowed, int(self.score[i, -1]) if self.taken[i, -1] else None)
            score[i, :len(rows)], row[i, :len(rows)], taken[i, :len(rows)] = found, row_ids[rows], True
        score, row, taken = (np.concatenate(c, 1) for c in ((self.score, score), (self.row, row), (self.taken, taken)))
        order = np.lexsort((row, ~score, ~taken))[:, :self.k]
        self.score, self.row, self.taken = (np.take_along_axis(c, order, 1) for c in (score, row, taken))

    def found(self) -> pa.RecordBatch:
        cols = (np.repeat(self.ids, self.taken.sum(1)), self.row[self.taken], self.score[self.taken])
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["query_id", "vec_id", "score"])


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None
        best: dict[int, Best] = {}
        for batch in batches:
            for at in range(batch.num_rows):
                block, asked = batch.column("block")[at].as_py(), batch.column("q_block")[at].as_py()
                if held is None or held[0] != block:
                    ids, x = _opened(batch, at)
                    order = np.argsort(ids, kind="stable")  # row numbers follow ids, so ties do too
                    held = (block, ids[order], Slices(x[order].astype(np.int64)), x.shape[1])
                if asked not in best:
                    best[asked] = Best(*_opened(batch, at, "q_"), k)
                best[asked].add(*held[1:])
        for b in best.values():
            yield b.found()
    return run


def quantise(vector: Column, scale: int = 1024) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))


def top_k(vectors: DataFrame, queries: Column, k: int = 10, block_rows: int = 16384, batch_queries: int = 4096) -> DataFrame:
    """query_id, rank (from 1), vec_id, score for every row of (vec_id, embedding) that ``queries`` marks."""
    v = F.col("embedding")
    usable = F.col("vec_id").isNotNull() & v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.where(usable).select(F.col("vec_id").cast("long"), quantise(v).alias("q"), F.coalesce(queries, F.lit(False)).alias("asked"))
    packed = _numbered(rows, block_rows)
    n = packed.agg(F.count("*").alias("blocks"), *(F.coalesce(F.sum(c), F.lit(0)).alias(name) for name, c in (
        ("n", F.col("n")), ("asked", F.col("n_asked")), ("bytes", F.length("vectors"))))).first()
    # Both kinds of part have a bounded size, and there are enough of them for many tasks. Long parts of blocks are better
    # than short ones (from the second block on, a query has a floor), as long as an index serves many queries.
    asked_parts = max(-(-n["asked"] * k // _PART_ANSWERS), -(-n["asked"] * n["bytes"] // max(n["n"], 1) // _PART_BYTES),
                      min(8, -(-n["asked"] // 2048)), 1)
    parts = max(1, min(n["blocks"], max(-(-n["n"] // _PART_ROWS), -(-_TASKS // asked_parts))))
    asked_parts = max(asked_parts, min(-(-_TASKS // parts), -(-n["asked"] // 256)))
    asked = packed.where("n_asked > 0").mapInArrow(_asked_task, "vec_id long, q array<long>, asked boolean")
    asked = _numbered(asked.repartition(asked_parts), batch_queries)
    # by parts of stored rows, whatever their size: a join on a key would copy the queries for every block, in a shuffle
    # or, where their size before the copying is small, by way of the driver
    tiles = (packed.select("block", "ids", "vectors", "item").repartition(parts).hint("shuffle_replicate_nl")
             .crossJoin(asked.select(*(F.col(c).alias(f"q_{c}") for c in ("block", "ids", "vectors", "item")))))
    found = tiles.mapInArrow(_search(k), "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _numbered(rows: DataFrame, most: int) -> DataFrame:
    """Stored blocks of the rows, each with a number."""
    return cut_lineage(rows.mapInArrow(_pack(most), _PACKED).withColumn("block", F.monotonically_increasing_id()))
