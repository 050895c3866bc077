"""Bounded-space online packing of token sequences (operator 7).

Each task reads its documents once, in order, with a fixed number of open windows. A document's full windows are
cut off at once; the rest goes to the open window it fits best (least room left). When it fits none and all
windows are open, the fullest is emitted. So a task holds at most ``open_windows`` windows, whatever it reads. At
the end of a task its open windows are leftovers; leftovers of ``merge_tasks`` tasks at a time meet in one merge
task (a bounded number of windows), where pieces are placed best-fit in decreasing size and the emptiest windows
are then cut up to fill the gaps of the others.

Defined cases: a null text is empty; an empty text is the separator token alone; documents longer than a window
take several; repeated rows are packed one by one; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.wordpiece_ids import encoder
from cohortlens.session import cut_lineage

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_NAMES = [x.split()[0] for x in PIECE.split(", ")]


class _Windows:
    """Open windows by the room they have left; at most ``most`` of them."""

    def __init__(self, size: int, most: int):
        self.size, self.most = size, most
        self.rooms: list[tuple[int, int]] = []  # (room, key), sorted
        self.held: dict[int, list[tuple]] = {}
        self.key = 0

    def place(self, piece: tuple, length: int) -> list[tuple] | None:
        """Put a piece into the window it fits best; returns the window that had to be emitted or was filled."""
        out = None
        i = bisect.bisect_left(self.rooms, (length, -1))
        if i < len(self.rooms):
            room, key = self.rooms.pop(i)
        else:
            if len(self.rooms) == self.most:
                out = self.held.pop(self.rooms.pop(0)[1])  # the fullest
            room, key = self.size, self.key
            self.key += 1
            self.held[key] = []
        self.held[key].append((piece, self.size - room))
        if room == length:
            if out is None:
                return self.held.pop(key)
            # one window leaves per call; a window filled by its first piece never gets here (full ones are cut off)
        bisect.insort(self.rooms, (room - length, key))
        return out


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())


def _pack_task(path: str, size: int, open_windows: int, separator: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(path)
        task = TaskContext.get().partitionId()
        wins, done = _Windows(size, open_windows), 0
        rows: list[tuple] = []

        def emit(window: list[tuple], left: bool) -> None:
            nonlocal done
            seq = (task << 36) + done
            done += 1
            for (doc, start, ids, total), offset in window:
                rows.append((doc, start, len(ids), _crc(ids), total, seq, offset, task if left else None,
                             ids.astype("<u4").tobytes() if left or with_ids else None))

        def flush() -> pa.RecordBatch:
            cols = list(zip(*rows, strict=True)) if rows else [()] * 9
            out = pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in cols[:8]] + [pa.array(cols[8], pa.binary())], names=[*_NAMES, "task", "ids"])
            rows.clear()
            return out

        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ids = np.append(words.encode(text.as_py() or ""), np.uint32(separator))
                n, start = len(ids), 0
                while n - start >= size:
                    emit([((doc, start, ids[start:start + size], n), 0)], False)
                    start += size
                if start < n:
                    full = wins.place((doc, start, ids[start:], n), n - start)
                    if full:
                        emit(full, False)
                if len(rows) >= 5000:
                    yield flush()
        for window in wins.held.values():
            emit(window, True)
        yield flush()
    return run


def _merge(size: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "task", "sequence_id", "offset"], ascending=[False, True, True, True])
        wins = _Windows(size, len(rows) + 1)
        full = []
        for doc, start, total, ids in zip(rows["doc_id"], rows["start"], rows["doc_tokens"], rows["ids"], strict=True):
            out = wins.place((doc, start, np.frombuffer(ids, "<u4"), total), len(ids) // 4)
            if out:
                full.append([p for p, _ in out])
        # emptiest windows last; their pieces are cut to fill the room of the fuller ones
        bins = [[p for p, _ in wins.held[k]] for _, k in wins.rooms]
        room = [r for r, _ in wins.rooms]
        i, j = 0, len(bins) - 1
        while i < j:
            if not room[i]:
                i += 1
            elif not bins[j]:
                j -= 1
            else:
                doc, start, ids, total = bins[j].pop()
                take = min(room[i], len(ids))
                if take < len(ids):
                    bins[j].append((doc, start + take, ids[take:], total))
                bins[i].append((doc, start, ids[:take], total))
                room[i] -= take
                room[j] += take
        out = []
        for k, window in enumerate(full + [b for b in bins if b]):
            at = 0
            for doc, start, ids, total in window:
                out.append((doc, start, len(ids), _crc(ids), total, (1 << 62) + (int(key[0]) << 36) + k, at, ids.tobytes()))
                at += len(ids)
        return pd.DataFrame(out, columns=[*_NAMES, "ids"])
    return run


def pack(docs: DataFrame, vocabulary: str, size: int = 4096, open_windows: int = 64, separator: int = 2,
         merge_tasks: int = 16, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids)."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    placed = cut_lineage(rows.mapInArrow(_pack_task(vocabulary, size, open_windows, separator, with_ids),
                                         f"{PIECE}, task long, ids binary"))  # read twice; ids only where still open
    extra = ["ids"] if with_ids else []
    merged = (placed.where("task is not null").withColumn("bucket", F.expr(f"task div {merge_tasks}"))
              .groupBy("bucket").applyInPandas(_merge(size), f"{PIECE}, ids binary"))
    return placed.where("task is null").select(*_NAMES, *extra).unionByName(merged.select(*_NAMES, *extra))
