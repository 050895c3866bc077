"""Every SQL-checkable registered query equals its independent DuckDB statement (sf0.001)."""

import datetime as dt
import decimal
import math

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL

CORPUS = set(entry._corpus()[0])  # tested with their subpackage
ORACLES = {k: v for k, v in entry.oracle_sql().items() if k not in CORPUS}


def _norm(v):
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _rows(cols, rows, order):
    idx = [cols.index(c) for c in order]
    return sorted((tuple(_norm(r[i]) for i in idx) for r in rows), key=repr)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, key):
    df = entry.queries()[key](spark, SF_SMALL)
    srows = df.collect()
    rel = duck.execute(ORACLES[key])
    ocols = [d[0] for d in rel.description]
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    order = sorted(df.columns)
    assert len(srows) == len(orows)
    assert _rows(df.columns, srows, order) == _rows(ocols, orows, order)


def test_every_query_has_oracle_or_is_model_fit():
    qs = set(entry.queries()) - CORPUS
    rows_only = set(qs) - set(ORACLES)
    assert set(ORACLES) <= set(qs)
    assert rows_only <= {
        "kmeans_sweep", "assign_clusters", "kmeans_profile", "hurdle_cv", "hurdle_fit",
        "feature_importance", "score_cohort", "backfill_predictions", "registry_round_trip",
        "impact_learned_level"}  # variances by expectation maximisation


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns[:5] == ["s", "install_dt", "platform", "usa", "publisher_name"]
    rows = df.collect()
    assert rows and all(r["install_dt"] is not None for r in rows)
