"""Property: the rounding and money-sum conventions used on both sides of the oracle give identical
values in Spark and DuckDB (random inputs)."""

import duckdb
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cohortlens.functions.scalar import money_sum, round_half_up

values = st.lists(st.floats(min_value=-1e6, max_value=1e6, allow_nan=False, allow_infinity=False),
                  min_size=1, max_size=200)
cents = st.lists(st.integers(min_value=-10**9, max_value=10**9), min_size=1, max_size=300)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(xs=values, digits=st.integers(min_value=0, max_value=6))
def test_round_half_up_matches_duckdb(spark, xs, digits):
    df = spark.createDataFrame([(i, float(x)) for i, x in enumerate(xs)], "i int, x double")
    got = [r[0] for r in df.orderBy("i").select(round_half_up("x", digits)).collect()]
    con = duckdb.connect()
    con.execute("CREATE TABLE t(i INT, x DOUBLE)")
    con.executemany("INSERT INTO t VALUES (?, ?)", [(i, float(x)) for i, x in enumerate(xs)])
    want = [r[0] for r in con.execute(f"SELECT floor(x * {10 ** digits} + 0.5) / {10 ** digits} FROM t ORDER BY i").fetchall()]
    assert got == want


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(cs=cents)
def test_money_sum_is_order_free_and_matches_duckdb(spark, cs):
    amounts = [c / 100 for c in cs]
    df = spark.createDataFrame([(a,) for a in amounts], "amt double")
    got = df.repartition(7).agg(money_sum("amt")).first()[0]
    got2 = df.coalesce(1).agg(money_sum("amt")).first()[0]
    con = duckdb.connect()
    con.execute("CREATE TABLE t(amt DOUBLE)")
    con.executemany("INSERT INTO t VALUES (?)", [(a,) for a in amounts])
    want = con.execute("SELECT CAST(SUM(CAST(amt AS DECIMAL(28,6))) AS DOUBLE) FROM t").fetchall()[0][0]
    assert got == got2 == want
