"""Dates joined to a table of intervals that contain them: an equi-join at any number, length and overlap.

An interval of days is cut into the fewest blocks of the form [k * 2**level, (k + 1) * 2**level): at most two for each
level, and at the coarsest level as many as it takes. A day lies in exactly one block of each level, so day and
interval meet in exactly one (level, block), and a hash or merge join on these two finds every pair once: no inequality
is left to check, no pair of a day and an interval apart is ever formed.

Days are taken distinct first, so a day that holds a third of all rows is one row of the join; numbers per day are summed
per block before they meet the days. Intervals whose start or end is null, or whose end is before the start, contain no
day; null days lie in no interval; both ends belong to the interval; timestamps count by their date.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Coarsest level: blocks of 2**15 days (90 years).
TOP = 15


def _number(day: str | Column) -> Column:
    return F.unix_date((F.col(day) if isinstance(day, str) else day).cast("date")).cast("long")


def _blocks_of_interval(start: str, end: str) -> Column:
    a, b = _number(start), _number(end) + 1

    def entry(level: int, block: Column, valid: Column) -> Column:
        return F.when(valid, F.struct(F.lit(level).alias("level"), block.alias("block")))

    parts = []
    for level in range(TOP):
        first, past = F.shiftright(a + ((1 << level) - 1), level), F.shiftright(b, level)
        some = first < past
        parts += [entry(level, first, some & (F.pmod(first, F.lit(2)) == 1)), entry(level, past - 1, some & (F.pmod(past, F.lit(2)) == 1))]
    first, past = F.shiftright(a + ((1 << TOP) - 1), TOP), F.shiftright(b, TOP)
    coarse = F.when(first < past, F.transform(F.sequence(first, past - 1), lambda k: F.struct(F.lit(TOP).alias("level"), k.alias("block"))))
    return F.concat(F.filter(F.array(*parts), lambda e: e.isNotNull()), F.coalesce(coarse, F.slice(F.array(parts[0]), 1, 0)))


def interval_blocks(events: DataFrame, start: str, end: str) -> DataFrame:
    """The events, one row for each of their blocks (``__level``, ``__block``)."""
    valid = events.where(F.col(start).isNotNull() & F.col(end).isNotNull() & (F.col(start).cast("date") <= F.col(end).cast("date")))
    out = valid.withColumn("__at", F.explode(_blocks_of_interval(start, end)))
    return out.withColumns({"__level": F.col("__at.level"), "__block": F.col("__at.block")}).drop("__at")


def day_blocks(days: DataFrame, day: str) -> DataFrame:
    """``day``, one row for each level with the block that it lies in; every day once."""
    each = days.select(F.col(day).cast("date").alias("__day")).where("__day IS NOT NULL").distinct()
    at = F.explode(F.array(*[F.struct(F.lit(k).alias("level"), F.shiftright(_number("__day"), k).alias("block")) for k in range(TOP + 1)]))
    return each.select("__day", at.alias("__at")).select("__day", F.col("__at.level").alias("__level"), F.col("__at.block").alias("__block"))


def events_on_days(days: DataFrame, day: str, events: DataFrame, start: str, end: str) -> DataFrame:
    """Every pair of a distinct day of ``days`` (as ``__day``) and an event in force on it, with the event's columns."""
    return (day_blocks(days, day).join(interval_blocks(events, start, end), ["__level", "__block"])
            .select("__day", *events.columns))


def totals_on_days(days: DataFrame, day: str, events: DataFrame, start: str, end: str, sums: dict[str, Column]) -> DataFrame:
    """For every distinct day (as ``__day``) the sums of ``sums`` (name -> value) over the events in force; days without
    events are left out. Values are summed per block first, so what meets the days is no larger than the blocks that occur."""
    marked = interval_blocks(events.withColumns({f"__v_{k}": v for k, v in sums.items()}), start, end)
    per_block = marked.groupBy("__level", "__block").agg(*[F.sum(f"__v_{k}").alias(k) for k in sums])
    met = day_blocks(days, day).join(per_block, ["__level", "__block"])
    return met.groupBy("__day").agg(*[F.sum(k).alias(k) for k in sums])


def label_events_from(df: DataFrame, date: str, events: DataFrame, name: str, start: str, end: str, into: str = "event_labels") -> DataFrame:
    """P15 with a table: ``df`` with the names of all events in force on its date, by start, then name, joined by
    ``', '``; null where there is none."""
    ordered = F.array_sort(F.collect_list(F.struct(F.col(start).cast("date").alias("a"), F.col(name).cast("string").alias("b"))))
    text = F.array_join(F.transform(ordered, lambda e: e["b"]), ", ")
    labels = (events_on_days(df, date, events.select(name, start, end).where(F.col(name).isNotNull()), start, end)
              .groupBy("__day").agg(text.alias(into)))
    rows = df.drop(into)
    return rows.join(labels, rows[date].cast("date") == F.col("__day"), "left").select(*[rows[c] for c in rows.columns], into)
