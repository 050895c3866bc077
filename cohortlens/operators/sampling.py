"""Deterministic sampling, splits and folds.

Assignments come from arithmetic on a key, not from ``rand()``/``randomSplit``: they are stable under
repartitioning and task retries (an executor lost mid-job recomputes the same rows) and can be
reproduced by plain SQL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A prime modulus, and the multiplier of a common linear congruential generator. Products of a
# residue and the multiplier stay below 2^62, so no key overflows.
HASH_MODULUS = 2147483647
HASH_MULTIPLIER = 1103515245
LOW_BITS = 16


def key_hash(key: str | Column, seed: int = 0) -> Column:
    """Integer keys of any size: ``(key mod m * multiplier + seed) mod m`` with ``m = 2^31 - 1`` (identical in any SQL
    engine), in ``[0, m)``."""
    k = F.col(key) if isinstance(key, str) else key
    m = F.lit(HASH_MODULUS).cast("long")
    return F.pmod(F.pmod(k.cast("long"), m) * F.lit(HASH_MULTIPLIER).cast("long") + F.lit(seed).cast("long"), m)


def string_key_hash(key: str | Column, seed: int = 0) -> Column:
    """String keys: ``xxhash64(key, seed) mod m``."""
    k = F.col(key) if isinstance(key, str) else key
    return F.pmod(F.xxhash64(k, F.lit(seed)), F.lit(HASH_MODULUS).cast("long"))


def hash_class(h: Column, classes: int) -> Column:
    """Class ``0 .. classes-1`` of a hash, from its high bits: low bits of a product repeat those of the key."""
    return F.pmod(F.shiftright(h, LOW_BITS), F.lit(classes).cast("long"))


def sample_n(df: DataFrame, n: int, key: str, seed: int = 0, hash_col: Column | None = None) -> DataFrame:
    """O3: the ``n`` rows with the smallest (hash, key): a fixed-size, reproducible sample.

    One counting job gives the rows per high-bits class of the hash (at most 32,768 numbers). Classes below the one
    in which the ``n``-th row falls are kept by a filter; only that class is ordered, which holds about one in
    32,768 rows. No task sorts the sample, whatever its size."""
    h = hash_col if hash_col is not None else key_hash(key, seed)
    x = df.withColumn("_h", h)
    top = F.shiftright("_h", LOW_BITS)
    counts = x.groupBy(top.alias("c")).agg(F.count(F.lit(1)).alias("k")).collect()
    left, edge = n, None
    for r in sorted(counts, key=lambda r: r["c"]):
        if r["k"] > left:
            edge = r["c"]
            break
        left -= r["k"]
    if edge is None:
        return df
    rest = x.where(top == F.lit(edge)).orderBy("_h", key).limit(left)
    return x.where(top < F.lit(edge)).unionByName(rest).drop("_h")


def sample_fraction(df: DataFrame, fraction: float, key: str, seed: int = 0, hash_col: Column | None = None) -> DataFrame:
    """O3 (size may vary): each row kept when its key hash falls below ``fraction x 2^32``. A filter, no
    shuffle; the same rows are kept on every run and after any repartitioning."""
    h = hash_col if hash_col is not None else key_hash(key, seed)
    return df.where(h < F.lit(int(fraction * HASH_MODULUS)))


def train_test_split(df: DataFrame, key: str, fraction: float = 0.9, seed: int = 0, hash_col: Column | None = None,
                     name: str = "split") -> DataFrame:
    """``train`` when the hash's class of 1000 is below ``1000 * fraction``, else ``test``."""
    h = hash_col if hash_col is not None else key_hash(key, seed)
    return df.withColumn(name, F.when(hash_class(h, 1000) < int(round(fraction * 1000)), F.lit("train"))
                         .otherwise(F.lit("test")))


def hash_folds(df: DataFrame, key: str, k: int, seed: int = 0, hash_col: Column | None = None,
               name: str = "fold") -> DataFrame:
    """O5 (default): fold = the hash's class of ``k``; balanced in expectation within every stratum."""
    h = hash_col if hash_col is not None else key_hash(key, seed)
    return df.withColumn(name, hash_class(h, k).cast("int"))


def stratified_folds(df: DataFrame, key: str, strata: Sequence[str], k: int, seed: int = 0,
                     hash_col: Column | None = None, name: str = "fold", partitions: int | None = None) -> DataFrame:
    """O5 (exact): within each stratum, rows ordered by (hash, key) get folds 0,1,..,k-1,0,1,..

    Equals ``row_number() over (partition by strata order by hash, key) - 1`` mod k, but no task holds
    a whole stratum and the rows are shuffled only once:
    1. range-partition on (strata, hash, key) and sort within partitions; ``monotonically_increasing_id``
       then carries the partition index (upper bits) and the row's position in it (lower 33 bits);
       this frame is checkpointed, so partitioning, order and ids are fixed (and survive lost executors);
    2. per (partition, stratum): row count and first position -- a table of at most
       partitions x strata rows;
    3. a running sum over that small table gives each (partition, stratum) the number of rows of its
       stratum in earlier partitions; rank = offset + position - first position. Whether the small
       table is broadcast is left to the optimizer, which measures its bytes."""
    from ..session import cut_lineage

    h = hash_col if hash_col is not None else key_hash(key, seed)
    st = list(strata)
    nparts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    x = cut_lineage(
        df.withColumn("_h", h)
        .repartitionByRange(nparts, *st, "_h", key)
        .sortWithinPartitions(*st, "_h", key)
        .withColumn("_id", F.monotonically_increasing_id()))
    x = x.withColumns({"_pid": F.shiftright("_id", 33), "_pos": F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))})
    counts = x.groupBy("_pid", *st).agg(F.count(F.lit(1)).alias("_cnt"), F.min("_pos").alias("_start"))
    before = Window.partitionBy(*st).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", *st, "_start", F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"))
    o = offsets.select(F.col("_pid").alias("_o_pid"), *[F.col(c).alias(f"_o_{c}") for c in st], "_start", "_off")
    cond = F.col("_pid") == F.col("_o_pid")
    for c in st:  # null-safe: a null stratum is a stratum of its own, its rows are kept
        cond = cond & F.col(c).eqNullSafe(F.col(f"_o_{c}"))
    y = x.join(o, cond).drop("_o_pid", *[f"_o_{c}" for c in st])
    rank = F.col("_off") + F.col("_pos") - F.col("_start")
    return y.withColumn(name, F.pmod(rank, F.lit(k)).cast("int")).drop("_h", "_id", "_pid", "_pos", "_start", "_off")
