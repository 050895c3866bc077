"""Row-level preparation: projections, filters, bins, flags, fills, casts, derived terms
(SURVEY P1 P2 P7-P12 P14 P15 M13). All narrow transformations: no shuffle."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import col_, round_half_up

# Bin edges and labels of the player-value report (labels as written in the analysis;
# ">40" means ">= 40" and ">4.5" means ">= 4.5").
SUBMISSION_BINS = ((10, "<10"), (20, "<20"), (40, "<40"))
SUBMISSION_TOP = ">40"
STARS_ZERO = "0 / None"
STARS_BINS = ((3.5, "<3.5"), (4.0, "<4"), (4.5, "<4.5"))
STARS_TOP = ">4.5"
USA_CANADA = ("United States", "Canada")


def select_columns(df: DataFrame, keep: Sequence[str] | None = None, drop: Sequence[str] = (),
                   rename: Mapping[str, str] | None = None) -> DataFrame:
    """Select / drop / rename / reorder with declared lists."""
    out = df.select(*keep) if keep is not None else df
    out = out.drop(*drop)
    return out.withColumnsRenamed(dict(rename)) if rename else out


def columns_matching(df: DataFrame, pattern: str | None = None, suffix: str | None = None,
                     start: str | None = None, end: str | None = None) -> list[str]:
    """Column names by regex, suffix or an inclusive position range ``start..end``."""
    cols = list(df.columns)
    if start is not None or end is not None:
        i = cols.index(start) if start is not None else 0
        j = cols.index(end) if end is not None else len(cols) - 1
        cols = cols[i:j + 1]
    if pattern is not None:
        rx = re.compile(pattern, re.IGNORECASE)
        cols = [c for c in cols if rx.search(c)]
    if suffix is not None:
        cols = [c for c in cols if c.endswith(suffix)]
    return cols


def fill_nulls(df: DataFrame, value, cols: Sequence[str] | None = None) -> DataFrame:
    """Null replacement for the given (or all type-compatible) columns."""
    return df.fillna(value, subset=list(cols) if cols is not None else None)


def cast_numeric(df: DataFrame, cols: Iterable[str], to: str = "double", strict: bool = False) -> DataFrame:
    """Numeric casts; ``strict=False`` uses ``try_cast`` (unparseable text -> null)."""
    return df.withColumns({c: (F.col(c).cast(to) if strict else F.col(c).try_cast(to)) for c in cols})


def bin_column(c: str | Column, edges: Sequence[tuple[float, str]], top: str, zero_label: str | None = None):
    """P10: ordered bins ``x < e1 -> l1, x < e2 -> l2, ..., else top``; an optional exact-zero bin first.
    Returns (label column, rank column); rank 0 is the zero bin when present."""
    x = col_(c)
    label = None
    rank = None
    offset = 0
    if zero_label is not None:
        label = F.when(x == 0, F.lit(zero_label))
        rank = F.when(x == 0, F.lit(0))
        offset = 1
    for i, (edge, name) in enumerate(edges):
        label = F.when(x < edge, F.lit(name)) if label is None else label.when(x < edge, F.lit(name))
        rank = F.when(x < edge, F.lit(i + offset)) if rank is None else rank.when(x < edge, F.lit(i + offset))
    return label.otherwise(F.lit(top)), rank.otherwise(F.lit(len(edges) + offset))


def clean_players(players: DataFrame, cap: float = 2000.0, refilter_after_round: bool = True) -> DataFrame:
    """Spenders only, null rating -> 0, cents -> currency rounded to 2 places, cap.
    The positivity test is repeated after rounding (SURVEY Q23) unless ``refilter_after_round=False``."""
    df = players.where(F.col("d365_RPI") > 0).withColumns({
        "avg_rating_received": F.coalesce(F.col("avg_rating_received"), F.lit(0.0)),
        "d365_RPI": round_half_up(F.col("d365_RPI") / 100, 2),
    }).where(F.col("d365_RPI") <= cap)
    return df.where(F.col("d365_RPI") > 0) if refilter_after_round else df


def bin_players(df: DataFrame) -> DataFrame:
    """P10: submissions and star-rating bins with their order."""
    sub, sub_rank = bin_column("submissions", SUBMISSION_BINS, SUBMISSION_TOP)
    st, st_rank = bin_column("avg_rating_received", STARS_BINS, STARS_TOP, zero_label=STARS_ZERO)
    return df.withColumns({"submissions_bin": sub, "submissions_bin_rank": sub_rank,
                           "stars_received_bin": st, "stars_received_bin_rank": st_rank})


def region_bucket(country: str | Column, members: Sequence[str] = USA_CANADA, inside: str = "USA_Canada",
                  outside: str = "ROW") -> Column:
    """``country %in% members`` -> inside / outside."""
    return F.when(col_(country).isin(*members), F.lit(inside)).otherwise(F.lit(outside))


def label_period(date: str | Column, windows: Mapping[str, tuple[dt.date, dt.date]], other: str = "other") -> Column:
    """Inclusive date windows -> label; first matching window wins."""
    d = col_(date)
    out = None
    for name, (a, b) in windows.items():
        cond = d.between(F.lit(a), F.lit(b))
        out = F.when(cond, F.lit(name)) if out is None else out.when(cond, F.lit(name))
    return out.otherwise(F.lit(other))


def label_events(date: str | Column, events: Mapping[str, tuple[dt.date, dt.date]]) -> Column:
    """Names of all overlay intervals containing the date, ``', '``-joined in the given order,
    null when none. The interval list is a parameter, so this is a projection, not a join."""
    d = col_(date)
    parts = [F.when(d.between(F.lit(a), F.lit(b)), F.lit(name)) for name, (a, b) in events.items()]
    txt = F.concat_ws(", ", *parts)
    return F.when(txt == "", F.lit(None).cast("string")).otherwise(txt)


def sanitize_names(df: DataFrame, prefix: str = "") -> DataFrame:
    """Spaces and other non-word characters in column names -> ``_`` (optional prefix). Of names that come out the same
    (but for case) the later ones are numbered from 2."""
    names, used = [], set()
    for c in df.columns:
        clean = name = prefix + re.sub(r"\W", "_", c)
        number = 2
        while name.lower() in used:
            name, number = f"{clean}_{number}", number + 1
        used.add(name.lower())
        names.append(name)
    return df.toDF(*names)


def add_terms(df: DataFrame, squares: Sequence[str] = (), interactions: Mapping[str, tuple[str, str]] | None = None,
              square_suffix: str = "Sqd") -> DataFrame:
    """Squared and product terms as new columns."""
    new = {f"{c}{square_suffix}": F.pow(F.col(c), 2) for c in squares}
    for name, (a, b) in (interactions or {}).items():
        new[name] = F.col(a) * F.col(b)
    return df.withColumns(new)


PLAYER_SQUARES = ("submissions", "sessions", "avg_rating_received")
PLAYER_INTERACTIONS = {
    "fb_x_sessions": ("facebook_connected", "sessions"),
    "fb_x_paid_source": ("facebook_connected", "paid_source"),
    "fb_x_united_states": ("facebook_connected", "united_states"),
}
