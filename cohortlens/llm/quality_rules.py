"""Quality rules with adaptive thresholds (operator 10).

Each document gets integer metrics. For every (language, source) and metric a mergeable quantile sketch is kept:
counts over integer buckets whose width grows with the value (relative error at most 1/32). Sketches of a
language, and of everything, are sums of those of the sources. They count the different texts of a source that pass the
base rules: neither copies of one junk text, however many, nor texts that are rejected anyway can open a fence. A
document is rejected when a metric lies beyond the fence Q3 + ``width`` * max(Q3 - Q1, ``slack``) of its own group; a
group with fewer than ``min_rows`` such texts uses the fence of its language, and a language with fewer uses the one of
all documents. Thresholds are joined back to the documents. Where no text of a group has any repeats, the repeat fence
is ``width * slack`` = 180 per mille, below the 300 of the base rules.

Defined cases: a null text has no words, its counts are 0 and ``base_failed`` is true; null languages and sources
are groups of their own; repeated rows are judged row by row; an empty table gives no rows; other columns of the
input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm import textkit as T
from cohortlens.session import cut_lineage

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Metrics and the slack of their fences, in their own integer units.
SLACK = {"symbols_permille": 10, "dup_lines_permille": 80, "repeat_permille": 60, "word_len_tenths": 5}
#: Working columns; named so that no column of a documents table clashes.
TEXT_KEY, BASE_FAILED = "__text_key", "base_failed"
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _count_slice(data: np.ndarray, offs: np.ndarray) -> dict[str, np.ndarray]:
    n = len(offs) - 1
    starts, ends, row = T.word_spans(data, offs)
    lead = (data & 0xC0) != 0x80  # first bytes of characters
    ls, le, lrow = T.line_spans(data, offs)
    word_at = np.zeros(len(data) + 1, np.int64)
    word_at[starts + 1] = 1
    np.cumsum(word_at, out=word_at)
    wordy = word_at[le] > word_at[ls]
    # a separator inside a line starts no word, and a line's first word starts within it
    ls, le, lrow = ls[wordy], le[wordy], lrow[wordy]
    _, later = T.repeats(T.span_hashes(data, ls, le), lrow)
    key, first = T.windows(T.span_hashes(data, starts, ends), row, 8)
    many, _ = T.repeats(key, row[first])
    cover = np.zeros(len(row) + 9, np.int64)
    np.add.at(cover, first[many], 1)
    np.subtract.at(cover, first[many] + 8, 1)
    covered = np.cumsum(cover)[:len(row)] > 0
    return {
        "n_words": np.bincount(row, minlength=n), "word_chars": T.per_row(lead & ~T.WS[data], offs),
        "n_symbols": T.per_row(_SYMBOL[data], offs), "n_dup_lines": np.bincount(lrow[later], minlength=n),
        "n_repeat_words": np.bincount(row[covered], minlength=n), "n_lines": np.bincount(lrow, minlength=n),
    }


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept = [c for c in batch.schema.names if c != "text"]
        for lo, hi, data, offs in T.slices(batch.column("text")):
            got = _count_slice(data, offs)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).slice(lo, hi - lo) for c in kept]
                + [pa.array(got[c].astype(np.int64)) for c in [*COUNTS, "n_lines"]], names=[*kept, *COUNTS, "n_lines"])


def text_counts(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, a hash of the text and the counts of every whole text; one pass, no shuffle."""
    rows = docs.select(F.col("doc_id").cast("long"), "text", F.col("lang").cast("string"), F.col("source").cast("string"),
                       F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias(TEXT_KEY))
    schema = f"doc_id long, lang string, source string, {TEXT_KEY} long, " + ", ".join(f"{c} long" for c in [*COUNTS, "n_lines"])
    return rows.mapInArrow(_count, schema)


def _metrics() -> dict[str, Column]:
    def share(a: str, b: str, unit: int) -> Column:
        return F.expr(f"({unit} * {a}) div greatest({b}, 1)")
    return {"symbols_permille": share("n_symbols", "word_chars", 1000),
            "dup_lines_permille": share("n_dup_lines", "n_lines", 1000),
            "repeat_permille": share("n_repeat_words", "n_words", 1000),
            "word_len_tenths": share("word_chars", "n_words", 10)}


def _bucket(v: Column) -> Column:
    """Lower bound of the sketch bucket of a non-negative integer: all but its six leading bits cleared."""
    drop = F.greatest(F.length(F.bin(v)) - 6, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", v, drop), drop)


def sketches(counts: DataFrame) -> DataFrame:
    """lang, source, metric, bucket, n: the mergeable quantile sketch of every group (counts add up) over its different
    texts; buckets that only texts beyond the base rules fall into count 0."""
    texts = counts.dropDuplicates(["lang", "source", TEXT_KEY])  # equal texts have equal counts; copies combine before the shuffle
    entries = F.array(*[F.struct(F.lit(m).alias("metric"), _bucket(v).alias("bucket")) for m, v in _metrics().items()])
    return (texts.select("lang", "source", BASE_FAILED, F.explode(entries).alias("e"))
            .groupBy("lang", "source", "e.metric", "e.bucket").agg(F.count_if(~F.col(BASE_FAILED)).alias("n")))


def fences(sketch: DataFrame, width: int, min_rows: int) -> DataFrame:
    """One row per (lang, source) with the fence of every metric, from the narrowest group of ``min_rows``."""
    def quartiles(level: DataFrame, keys: list[str]) -> DataFrame:
        merged = level.groupBy(*keys, "metric", "bucket").agg(F.sum("n").alias("n"))
        w = Window.partitionBy(*keys, "metric")
        ranked = merged.withColumn("upto", F.sum("n").over(w.orderBy("bucket"))).withColumn("rows", F.sum("n").over(w))
        q1 = F.min(F.when(F.col("upto") * 4 >= F.col("rows"), F.col("bucket")))
        q3 = F.min(F.when(F.col("upto") * 4 >= F.col("rows") * 3, F.col("bucket")))
        slack = F.create_map(*[F.lit(x) for kv in SLACK.items() for x in kv])[F.col("metric")]
        high = (ranked.groupBy(*keys, "metric").agg(q1.alias("q1"), q3.alias("q3"), F.first("rows").alias("rows"))
                .withColumn("fence", F.col("q3") + F.lit(width) * F.greatest(F.col("q3") - F.col("q1"), slack)))
        return high.groupBy(*keys).agg(F.first("rows").alias("rows"),
                                       *[F.max(F.when(F.col("metric") == m, F.col("fence"))).alias(m) for m in SLACK])

    own, lang = quartiles(sketch, ["lang", "source"]), quartiles(sketch, ["lang"])
    every = quartiles(sketch.withColumn("whole", F.lit(1)), ["whole"]).first()  # one row of a few numbers
    o, g = own.alias("o"), lang.alias("g")
    joined = o.join(g, F.col("o.lang").eqNullSafe(F.col("g.lang")), "left")

    def pick(m: str) -> Column:
        return (F.when(F.col("o.rows") >= min_rows, F.col(f"o.{m}"))
                .when(F.col("g.rows") >= min_rows, F.col(f"g.{m}")).otherwise(F.lit(every[m] if every else None).cast("long")))
    return joined.select("o.lang", "o.source", *[pick(m).alias(f"max_{m}") for m in SLACK])


def adaptive_rules(docs: DataFrame, width: int = 3, min_rows: int = 100, min_words: int = 20,
                   repeat_percent: int = 30) -> DataFrame:
    """doc_id, counts, base_failed, kept, and the metrics with their fences, for all documents."""
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words"))
    counts = cut_lineage(text_counts(docs).withColumn(BASE_FAILED, failed))  # read twice: sketches, then the joined filter
    limits = fences(cut_lineage(sketches(counts)), width, min_rows)
    c, f = counts.withColumns(_metrics()).alias("c"), limits.alias("f")
    joined = c.join(f, F.col("c.lang").eqNullSafe(F.col("f.lang")) & F.col("c.source").eqNullSafe(F.col("f.source")), "left")
    within = F.lit(True)
    for m in SLACK:
        within = within & (F.col(f"c.{m}") <= F.col(f"f.max_{m}"))
    return joined.select("c.doc_id", *[f"c.{x}" for x in COUNTS], f"c.{BASE_FAILED}",
                         (~F.col(f"c.{BASE_FAILED}") & within).alias("kept"), *[f"c.{m}" for m in SLACK], *[f"f.max_{m}" for m in SLACK])
