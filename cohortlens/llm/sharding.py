"""Sharding by vector bin packing: bytes, tokens and rows are balanced jointly (operator 1).

Documents with equal texts are one group and stay in one shard; only a group above a shard's fair share of bytes,
tokens or rows is split, by document id. Every group is a vector (bytes, tokens, rows) in units of the shard capacities and
goes to the shard whose residual capacity has the highest dot product with it, large groups first.

Groups with more than 1 / (shards * heavy_parts) of any total, and the parts of split ones, are a few times
shards * heavy_parts at most, so they are
packed on the driver. The rest is dealt by text digest into cells of about ``cell_rows`` rows; each cell packs its
groups into its share of what the large ones left, so all cells work at the same time and their sums fit. Slots
are ranks inside a cell plus the cell's offset in its shard, so no task ever orders a whole shard.

Defined cases: a null text counts as empty; repeated rows of one id are placed row by row; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.session import cut_lineage

DIMS = ["size", "tokens", "n"]
#: Weights of the dimensions in the dot product: the law is near-equal bytes; larger ones for tokens and rows cost it.
WEIGHTS = np.array([1.0, 0.1, 0.01])


def place(items: np.ndarray, residual: np.ndarray) -> np.ndarray:
    """Shard of each item (a row of ``items``, in units of ``residual``), largest first; ties go to the lower shard.
    ``residual`` is used up in place."""
    out = np.zeros(len(items), np.int64)
    weighted = items * WEIGHTS
    for i in np.argsort(-weighted.sum(1), kind="stable"):
        k = int(np.argmax(residual @ weighted[i]))
        out[i] = k
        residual[k] -= items[i]
    return out


def _pack_cell(left: np.ndarray):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        light = rows["shard"].isna().to_numpy()
        shard = rows["shard"].fillna(0).to_numpy(np.int64).copy()
        if light.any():
            code, _ = pd.factorize(rows["digest"][light])
            n = code.max() + 1
            items = np.column_stack([np.bincount(code, rows[d][light], n) for d in ("size", "tokens")] + [np.bincount(code, minlength=n)])
            items = items / np.maximum(items.sum(0), 1)
            residual = left.copy()
            shard[light] = place(items, residual)[code]
        rows = rows.assign(shard=shard).sort_values(["shard", "doc_id"], kind="stable")
        return rows.assign(rank=rows.groupby("shard").cumcount())[["doc_id", "size", "text_crc32", "cell", "shard", "rank"]]
    return run


def assign_shards(docs: DataFrame, shards: int = 24, heavy_parts: int = 64, cell_rows: int = 4000) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot for every row."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = cut_lineage(docs.select(
        F.col("doc_id").cast("long"), (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        (F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit(""))) + 1).cast("long").alias("tokens"),
        F.unhex(F.md5(text)).alias("digest")))
    groups = cut_lineage(rows.groupBy("digest").agg(F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count("*").alias("n")))
    sums = groups.agg(*[F.sum(d).alias(d) for d in DIMS]).first()
    total = np.array([sums[d] or 0 for d in DIMS], float)
    capacity = np.maximum(total / shards, 1)

    large = F.lit(False)
    for d, t in zip(DIMS, total, strict=True):
        large = large | (F.col(d) > t / (shards * heavy_parts))
    big = groups.where(large).collect()  # at most 3 * shards * heavy_parts rows
    shares = {bytes(g["digest"]): max(g[d] / c for d, c in zip(DIMS, capacity, strict=True)) for g in big}
    parts = {digest: 1 if share <= 1 else math.ceil(heavy_parts * share) for digest, share in shares.items()}
    heavy = spark.createDataFrame([(d, p) for d, p in parts.items()], "digest binary, parts int")
    part = F.pmod(F.xxhash64("doc_id"), F.col("parts")).cast("int")
    tagged = rows.join(F.broadcast(heavy), "digest", "left").withColumn("part", part)
    split = {(bytes(r["digest"]), r["part"]): r for r in
             tagged.where("parts > 1").groupBy("digest", "part").agg(*[F.sum(x).alias(x) for x in ("size", "tokens")], F.count("*").alias("n")).collect()}
    items = [((bytes(g["digest"]), 0), [g[d] for d in DIMS]) for g in big if parts[bytes(g["digest"])] == 1]
    items += [(k, [r[d] for d in DIMS]) for k, r in split.items()]
    items.sort(key=lambda x: x[0])
    residual = np.ones((shards, len(DIMS)))
    vectors = np.array([v for _, v in items], float).reshape(-1, len(DIMS))
    where = place(vectors / capacity, residual)
    placed = spark.createDataFrame([(k[0], k[1], int(s)) for (k, _), s in zip(items, where, strict=True)],
                                   "digest binary, part int, shard int")

    heavy_rows = int(vectors[:, 2].sum())
    light_cells = max(1, math.ceil((total[2] - heavy_rows) / cell_rows))
    heavy_cells = max(1, math.ceil(heavy_rows / cell_rows))
    left = np.maximum(residual, 0)
    left = left / np.maximum(left.sum(0), 1e-12)
    cell = F.when(F.col("shard").isNull(), F.pmod(F.xxhash64("digest"), F.lit(light_cells))).otherwise(
        light_cells + F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(heavy_cells)))
    dealt = tagged.join(F.broadcast(placed), ["digest", "part"], "left").select(
        "doc_id", "size", "text_crc32", "tokens", "digest", F.col("shard").cast("double"), cell.cast("long").alias("cell"))
    done = cut_lineage(dealt.groupBy("cell").applyInPandas(
        _pack_cell(left), "doc_id long, size long, text_crc32 long, cell long, shard int, rank long"))
    counts = done.groupBy("shard", "cell").agg(F.count("*").alias("m"))
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "cell", F.coalesce(F.sum("m").over(before), F.lit(0)).alias("base"))
    return done.join(offsets, ["shard", "cell"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("base") + F.col("rank")).alias("slot"))
