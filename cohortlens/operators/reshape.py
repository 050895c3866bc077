"""Nested data and reshaping."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.maps import map_keys, parse_map


def explode_map(df: DataFrame, key: str, text_col: str, k: str, v: str) -> DataFrame:
    """R1 + R2: text map -> one row per entry (key, k, v). Null/empty maps give no rows."""
    return df.select(key, F.explode(parse_map(text_col)).alias(k, v))


def map_to_columns(df: DataFrame, text_col: str, prefix: str, keys: Sequence[str] | None = None, fill: float = 0.0,
                   keep: Sequence[str] = ()) -> DataFrame:
    """One column per key, missing -> ``fill``. Without ``keys`` they are those of the data. The text is parsed
    once per row; the columns are a projection of the map."""
    keys = map_keys(df, text_col) if keys is None else keys
    return df.select(*keep, parse_map(text_col).alias("_map")).select(
        *keep, *[F.coalesce(F.col("_map")[k], F.lit(fill)).alias(f"{prefix}{k}") for k in keys])


def pivot_long(df: DataFrame, key: str, name_col: str, value_col: str, values: Sequence[str] | None = None,
               prefix: str = "", fill: float = 0.0) -> DataFrame:
    """R3 from long rows: ``groupBy(key).pivot(name, values)``. Without ``values`` they are the names found in the
    data, so no category is lost; a caller that knows them saves that job. Two rows of one key and name are an error: which
    of them should count is not known here. A null among them is a category of its own,
    in a last column named ``NA``, with underscores added where a name of the data would give the same column."""
    from .summarise import distinct_values

    values = list(distinct_values(df, name_col) if values is None else values)
    if None in values:
        names = {re.sub(r"\W", "_", str(v)).lower() for v in values if v is not None}
        label = "NA"
        while label.lower() in names:
            label += "_"
        df = df.withColumn(name_col, F.coalesce(F.col(name_col).cast("string"), F.lit(label)))
        values = [str(v) for v in values if v is not None] + [label]
    once = F.when(F.count(F.lit(1)) > 1, F.raise_error(F.concat(F.lit("more than one row for "), F.first(F.col(key).cast("string")))))
    wide = df.groupBy(key).pivot(name_col, values).agg(F.coalesce(once.cast(df.schema[value_col].dataType), F.first(value_col)))
    return wide.select(key, *[F.coalesce(F.col(f"`{v}`"), F.lit(fill)).alias(f"{prefix}{v}") for v in values])


def unpivot(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str, value: str) -> DataFrame:
    """Wide -> long."""
    return df.unpivot(list(ids), list(values), name, value)


def separate(df: DataFrame, col: str, sep: str, into: Sequence[str | None], types: Mapping[str, str] | None = None,
             drop: bool = True) -> DataFrame:
    """Split a text column on a literal separator into typed columns; ``None`` skips a part.
    Missing parts give null (``get``), never an index error."""
    parts = F.split(F.col(col), _quote(sep))
    types = dict(types or {})
    new = {}
    for i, name in enumerate(into):
        if name is None:
            continue
        c = F.get(parts, i)
        new[name] = c.try_cast(types[name]) if name in types else c
    out = df.withColumns(new)
    return out.drop(col) if drop and col not in new else out


def _quote(sep: str) -> str:
    return re.escape(sep)


def transpose(df: DataFrame, key: str, value_cols: Sequence[str], name: str = "variable") -> DataFrame:
    """R6 for small results: one row per value column, one column per key level.
    (unpivot, then pivot on the key; the key levels are read from the small frame.)"""
    from .summarise import distinct_values

    levels = [str(v) for v in distinct_values(df, key)]
    long = df.select(F.col(key).cast("string").alias(key), *[F.col(c).cast("double").alias(c) for c in value_cols]) \
        .unpivot([key], list(value_cols), name, "value")
    return long.groupBy(name).pivot(key, levels).agg(F.first("value"))


def one_hot(df: DataFrame, col: str, levels: Sequence[str], prefix: str | None = None) -> DataFrame:
    """0/1 column per level (levels from ``summarise.distinct_values``). A null is a level of its own, named
    ``missing``, and 0 in all others. Levels whose columns would have one name (a real ``missing``, other cases of the same
    letters) get underscores, in the order of ``levels``."""
    pre = prefix if prefix is not None else f"{col}_"
    names = _free_names([f"{pre}{'missing' if lv is None else lv}" for lv in levels])
    return df.withColumns({n: F.col(col).eqNullSafe(F.lit(lv)).cast("int") for n, lv in zip(names, levels)})


def _free_names(names: Sequence[str]) -> list[str]:
    """The names, with underscores added where an earlier one is the same but for case."""
    out: list[str] = []
    for n in names:
        while n.lower() in {x.lower() for x in out}:
            n += "_"
        out.append(n)
    return out


def union_missing(frames: Sequence[DataFrame], fill=0) -> DataFrame:
    """Union by name; columns missing in a frame are null, then filled."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out.fillna(fill)


def ordered_terms(df: DataFrame, term: str = "term", marker: str = "Distr") -> DataFrame:
    """Rows whose term does not contain ``marker`` first, then those that do (one sort, no union)."""
    return df.orderBy(F.col(term).contains(marker).cast("int"), F.col(term))
