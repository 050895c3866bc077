"""String-encoded maps ``{k=v, k2=v2}``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scalar import col_, round_half_up


def parse_map(c: str | Column) -> Column:
    """Text map -> ``map<string,double>``. Braces removed, pairs split on ``,\\s*``, keys and values
    trimmed, values parsed with ``try_cast``; of entries with the same key the last one counts. A null or empty
    text gives an empty map (SURVEY Q20)."""
    text = F.trim(F.regexp_replace(col_(c), r"[{}]", ""))
    empty = F.create_map().cast("map<string,double>")
    pair = F.transform(F.split(text, r",\s*"), lambda x: F.split(x, "=", 2))
    entries = F.transform(pair, lambda x: F.struct(F.trim(x[0]).alias("k"), F.trim(F.get(x, 1)).try_cast("double").alias("v")))
    return F.when(text.isNull() | (text == ""), empty).otherwise(F.map_from_entries(_let(entries, _last_of_each_key)))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once a row: a lambda that names an outer expression computes it for each of
    its elements."""
    return F.transform(F.array(value), use)[0]


def _last_of_each_key(entries: Column) -> Column:
    """The last entry of each key. A key that repeats is rare, which the names alone tell; only then are entries numbered
    and ordered by key, so that the last of a key is the one whose neighbour has another."""
    def dropped(numbered: Column) -> Column:
        last = F.filter(numbered, lambda e, i: F.coalesce(F.get(numbered, i + 1)["k"] != e["k"], F.lit(True)))
        back = F.array_sort(F.transform(last, lambda e: F.struct(e["i"].alias("i"), e["k"].alias("k"), e["v"].alias("v"))))
        return F.transform(back, lambda e: F.struct(e["k"].alias("k"), e["v"].alias("v")))

    names = F.transform(entries, lambda e: e["k"])
    numbered = F.transform(entries, lambda e, i: F.struct(e["k"].alias("k"), i.alias("i"), e["v"].alias("v")))
    return F.when(F.size(F.array_distinct(names)) == F.size(entries), entries).otherwise(_let(F.array_sort(numbered), dropped))


def map_keys(df: DataFrame, c: str | Column) -> list[str]:
    """The distinct keys of a map column, or of a text map column, sorted: the columns that a wide form of it has. Too many
    of them are an error (see ``summarise.distinct_values``)."""
    from ..operators.summarise import distinct_values

    typed = df.select(col_(c).alias("m"))
    m = F.col("m") if typed.schema["m"].dataType.typeName() == "map" else parse_map("m")
    return distinct_values(typed.select(F.explode(F.map_keys(m)).alias("k")), "k")


def format_map_text(df: DataFrame, key: str, k: str, v: str, out: str, digits: int = 4) -> DataFrame:
    """Inverse of ``parse_map``: one text map per ``key`` from long rows (key, k, v).

    Entries are sorted by ``k``; values are rounded half-up to ``digits`` and printed with exactly
    ``digits`` decimals. Groups are bounded by the number of distinct ``k`` values per key."""
    entries = F.array_sort(F.collect_list(F.struct(F.col(k).alias("k"), round_half_up(v, digits).alias("v"))))
    text = F.array_join(F.transform(entries, lambda e: F.concat(e["k"], F.lit("="), F.format_string(f"%.{digits}f", e["v"]))), ", ")
    return df.groupBy(key).agg(F.concat(F.lit("{"), text, F.lit("}")).alias(out))
