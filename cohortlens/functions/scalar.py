"""Scalar column functions. All are built-in Spark expressions: they stay in
whole-stage codegen, no Python per row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money_sum(c: str | Column) -> Column:
    """Exact sum of amounts: decimal(28,6) accumulation (a millionth of a unit is kept), result as double.
    Summation order (partitioning) cannot change the result."""
    return F.sum(col_(c).cast("decimal(28,6)")).cast("double")


def money_avg(c: str | Column) -> Column:
    """Mean from an exact sum and a count (deterministic)."""
    x = col_(c)
    return money_sum(x) / F.count(x)


def round_half_up(c: str | Column, digits: int = 2) -> Column:
    """Round half up on the double value: ``floor(x * 10^d + 0.5) / 10^d``.

    Written out so that any engine computing in IEEE doubles gives the same bits (SQL ``round`` on
    doubles differs between engines at representational ties; SURVEY Q22)."""
    scale = 10 ** digits
    return F.floor(col_(c) * scale + 0.5) / scale


def safe_div(a: str | Column, b: str | Column) -> Column:
    """Division that yields null on a zero denominator (ANSI mode raises DIVIDE_BY_ZERO otherwise)."""
    return F.try_divide(col_(a), col_(b))


def zero_pad_parts(d: Column, names: Sequence[str] = ("year", "month", "day")) -> list[Column]:
    """Zero-padded string parts of a date, as used by date-partitioned tables."""
    fmts = ("yyyy", "MM", "dd")
    return [F.date_format(d, f).alias(n) for f, n in zip(fmts, names)]


def partition_date(y: str = "year", m: str = "month", d: str = "day") -> Column:
    """``year || '-' || month || '-' || day`` of string partition columns (reaches PartitionFilters)."""
    return F.concat_ws("-", F.col(y), F.col(m), F.col(d))


def match_game(c: str | Column, game: str, exclude_qa: bool = False) -> Column:
    """Game filter (P5): the lower-cased name contains the lower-cased game, taken as plain text. By default QA
    builds stay, as they do in the reference (SURVEY Q1); ``exclude_qa=True`` drops names whose game part (before
    the platform) ends in ``qa``."""
    lowered = F.lower(col_(c))
    match = lowered.contains(game.lower())
    return match & ~lowered.rlike("^[^_]*qa(_|$)") if exclude_qa else match


def strip_device_prefix(c: str | Column) -> Column:
    """Device id to ad-network id (P13): upper case, without the ``IDFV`` mark and its separator."""
    s = col_(c)
    return F.upper(F.when(s.startswith("IDFV"), F.substr(s, F.lit(6))).otherwise(s))


def platform_of(game_name: str | Column) -> Column:
    """Second ``_``-separated part of the game name, null when absent (F6, SURVEY Q27)."""
    return F.get(F.split(col_(game_name), "_"), 1)


def flag(cond: Column) -> Column:
    """0/1 integer flag; a null condition gives 0 (Spark ``when`` semantics, SURVEY Q21)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def null_tolerant_equals(c: str | Column, value: str) -> Column:
    """``coalesce(c, value) = value`` written as a disjunction that can reach the parquet scan."""
    x = col_(c)
    return x.isNull() | (x == value)
