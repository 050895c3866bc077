"""Operator 4: how queries reach the blocks, and what the upper slices may drop."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from cohortlens.llm import bit_sliced


def expected(rows, asked, k):
    out = []
    for qid, q in rows:
        if asked(qid):
            scores = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), i) for i, v in rows if i != qid)[:k]
            out += [(qid, r + 1, i, -s) for r, (s, i) in enumerate(scores)]
    return sorted(out)


def test_queries_reach_blocks_without_broadcast(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [int(c) for c in rng.integers(-900, 900, 6)]) for i in range(400)]
    frame = spark.createDataFrame([(i, [c / 1024 for c in v]) for i, v in rows], "vec_id long, embedding array<double>").repartition(4)
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") != "-1"
    df = bit_sliced.top_k(frame, F.col("vec_id") % 10 == 0, k=5, block_rows=50, batch_queries=8)
    assert sorted(map(tuple, df.collect())) == expected(rows, lambda i: i % 10 == 0, 5)
    plan = df._jdf.queryExecution().executedPlan().toString()  # the last one, as adaptive execution ran it
    assert "Broadcast" not in plan and "Generate" not in plan


def test_blocks_are_bounded_by_rows_and_numbers():
    def table(n, wide):
        lists = pa.array([[1] * wide] * n, pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays([pa.array([7] * n), lists, pa.array([True] * n)], names=["vec_id", "q", "asked"])

    sizes = [b.column("n")[0].as_py() for b in bit_sliced._pack(100)(iter([table(30, 2), table(180, 2), table(45, 2)]))]
    assert sizes == [100, 100, 55]  # one id for all: no block grows with it
    sizes = [b.column("n")[0].as_py() for b in bit_sliced._pack(4096)(iter([table(200, 1 << 13)]))]
    assert sizes == [128, 72]
    assert list(bit_sliced._pack(100)(iter([]))) == []


def test_upper_slices_drop_no_answer():
    rng = np.random.default_rng(6)
    dropped = 0
    for trial in range(60):
        n, wide, k, most = (int(rng.choice(c)) for c in ((1, 63, 64, 200, 600), (0, 1, 5, 16), (1, 4, 10), (1, 40, 1000, 10**6)))
        x = rng.integers(-most, most + 1, (n, wide))
        if trial % 3 == 0:
            x[rng.integers(0, n, n // 2)] = x[0]  # ties
        index, allowed = bit_sliced.Slices(x), rng.random(n) < 0.8
        bits = bit_sliced.pack_bits(allowed[None])[0]
        for q in (x[0], -x[-1], np.zeros(wide, np.int64), rng.integers(-most, most + 1, wide)):
            want = sorted((-int(s), i) for i, s in enumerate(x @ q) if allowed[i])[:k]
            for floor in (None, *([-want[-1][0], -want[-1][0] - 3] if len(want) == k else [])):
                rows, score = index.top_k(q, k, bits, floor)
                assert sorted(zip((-score).tolist(), rows.tolist(), strict=True)) == want
                dropped += int(np.bitwise_count(index.within_reach(q, k, bits, floor)).sum()) < allowed.sum()
    assert dropped > 60
