"""Bins, rounding, maps, scaling, reshaping (FIXTURES X9, X11, X12, X13; properties of SURVEY §5)."""

import pytest
from pyspark.sql import functions as F

from cohortlens.functions.maps import format_map_text, parse_map
from cohortlens.functions.scalar import round_half_up
from cohortlens.operators import prepare as prep
from cohortlens.operators import reshape as rs
from cohortlens.operators import scaling as sc
from cohortlens.operators import summarise as sm


def test_x11_bin_edges(spark):
    df = spark.createDataFrame([(10, 0.0), (20, 3.5), (40, 4.0), (9, 4.5), (39, 4.49)],
                               "submissions long, avg_rating_received double")
    got = [(r["submissions_bin"], r["stars_received_bin"], r["submissions_bin_rank"], r["stars_received_bin_rank"])
           for r in prep.bin_players(df).collect()]
    assert got == [("<20", "0 / None", 1, 0), ("<40", "<4", 2, 2), (">40", "<4.5", 3, 3),
                   ("<10", ">4.5", 0, 4), ("<40", "<4.5", 2, 3)]  # ">40" means >= 40 (Q16)


def test_x13_rounding_and_refilter(spark):
    rows = [(1, 0.4), (2, 0.5), (3, 200000.0), (4, 200001.0), (5, 1234.5)]
    df = spark.createDataFrame([(k, v, None, 1, 1, 0, 0, 0, 0) for k, v in rows],
                               "player_id long, d365_RPI double, avg_rating_received double, submissions long, "
                               "sessions long, united_states int, facebook_connected int, paid_source int, returner int")
    got = {r["player_id"]: r["d365_RPI"] for r in prep.clean_players(df).collect()}
    # 0.4 cents -> 0.00 is dropped after rounding (Q23); 0.5 cents rounds half up to 0.01; cap 2000 inclusive
    assert got == {2: 0.01, 3: 2000.0, 5: 12.35}
    lit = {r["player_id"] for r in prep.clean_players(df, refilter_after_round=False).collect()}
    assert 1 in lit


def test_round_half_up(spark):
    df = spark.createDataFrame([(0.125,), (2.5,), (-2.5,), (1.0049,)], "x double")
    assert [r[0] for r in df.select(round_half_up("x", 2)).collect()] == [0.13, 2.5, -2.5, 1.0]
    assert [r[0] for r in df.select(round_half_up("x", 0)).collect()] == [0.0, 3.0, -2.0, 1.0]


def test_x12_maps(spark):
    df = spark.createDataFrame([("{}",), (None,), ("{a=1}",), ("{a=0.5,  b=0.5}",), ("{key one=0.25, k2=x}",)], "m string")
    got = [r[0] for r in df.select(parse_map("m")).collect()]
    assert got[0] == {} and got[1] == {}  # null map -> empty, no "0" category (Q20)
    assert got[2] == {"a": 1.0}
    assert got[3] == {"a": 0.5, "b": 0.5}
    assert got[4] == {"key one": 0.25, "k2": None}


def test_map_round_trip(spark):
    long = spark.createDataFrame([(1, "b", 0.75), (1, "a", 0.25), (2, "z", 1.0)], "id int, k string, v double")
    text = format_map_text(long, "id", "k", "v", "m")
    assert {r["id"]: r["m"] for r in text.collect()} == {1: "{a=0.2500, b=0.7500}", 2: "{z=1.0000}"}
    back = text.select("id", F.explode(parse_map("m")).alias("k", "v"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, long.collect()))


def test_x9_min_max_scale_drops_constant(spark):
    df = spark.createDataFrame([(1, 5.0, 2.0), (2, 5.0, 4.0), (3, 5.0, 6.0)], "id int, const double, x double")
    scaled, dropped = sc.min_max_scale(df, ["const", "x"], keep=["id"])
    assert dropped == ["const"]  # instead of NaN (Q11)
    vals = [r["x"] for r in scaled.orderBy("id").collect()]
    assert vals == [0.0, 0.5, 1.0]


def test_share_of_total_sums_to_one(spark):
    df = spark.createDataFrame([(v,) for v in [0, 0, 0, 1]], "vip int")
    rows = sm.share_of_total(df, "vip").collect()
    assert abs(sum(r["pct"] for r in rows) - 1.0) < 1e-12


def test_separate_and_transpose(spark):
    df = spark.createDataFrame([("nrounds=25_eta=0.05",), ("nrounds=50",)], "m string")
    out = rs.separate(df, "m", "_", ["a", "b"]).collect()
    assert (out[0]["a"], out[0]["b"]) == ("nrounds=25", "eta=0.05") and out[1]["b"] is None
    prof = spark.createDataFrame([(0, 10, 1.5), (1, 20, 2.5)], "cluster int, n long, x double")
    t = {r["variable"]: (r["0"], r["1"]) for r in rs.transpose(prof, "cluster", ["n", "x"]).collect()}
    assert t == {"n": (10.0, 20.0), "x": (1.5, 2.5)}


def test_union_missing_and_ordered_terms(spark):
    a = spark.createDataFrame([(1, 2.0)], "id int, x double")
    b = spark.createDataFrame([(2, 3.0)], "id int, y double")
    got = sorted(map(tuple, rs.union_missing([a, b], 0).collect()))
    assert got == [(1, 2.0, 0.0), (2, 0.0, 3.0)]
    t = spark.createDataFrame([("Spend Distr A",), ("sessions",), ("avg",)], "term string")
    assert [r[0] for r in rs.ordered_terms(t).collect()] == ["avg", "sessions", "Spend Distr A"]


def test_label_events_and_periods(spark):
    import datetime as dt
    df = spark.createDataFrame([(dt.date(2024, 1, d),) for d in (1, 5, 21)], "date date")
    ev = {"A": (dt.date(2024, 1, 1), dt.date(2024, 1, 2)), "B": (dt.date(2024, 1, 20), dt.date(2024, 1, 25)),
          "C": (dt.date(2024, 1, 21), dt.date(2024, 1, 21))}
    got = [r[0] for r in df.select(prep.label_events("date", ev)).collect()]
    assert got == ["A", None, "B, C"]


def test_histogram_max_in_last_bin(spark):
    df = spark.createDataFrame([(float(x),) for x in range(0, 31)], "v double")
    h = {r["bin"]: r["n"] for r in sm.histogram(df, "v", 30).collect()}
    assert sum(h.values()) == 31 and max(h) == 30 and h[30] == 2


def test_levels_and_keys_come_from_the_data(spark):
    df = spark.createDataFrame([(1, "{a=1, b=2, a=3}", "x"), (2, None, None), (3, "{c=oops}", "x")], "id int, m string, g string")
    assert sm.distinct_values(df, "g") == ["x", None]
    hot = sorted(map(tuple, rs.one_hot(df, "g", sm.distinct_values(df, "g")).select("id", "g_x", "g_missing").collect()))
    assert hot == [(1, 1, 0), (2, 0, 1), (3, 1, 0)]
    wide = rs.map_to_columns(df, "m", "k_", keep=["id"])
    assert wide.columns == ["id", "k_a", "k_b", "k_c"]
    assert sorted(map(tuple, wide.collect())) == [(1, 3.0, 2.0, 0.0), (2, 0.0, 0.0, 0.0), (3, 0.0, 0.0, 0.0)]
    long = spark.createDataFrame([(1, "p", 0.5), (1, "unlisted", 0.5)], "id int, n string, v double")
    assert rs.pivot_long(long, "id", "n", "v").columns == ["id", "p", "unlisted"]


def test_null_category_is_a_column(spark):
    long = spark.createDataFrame([(1, "p", 0.5), (1, None, 0.5), (2, None, 1.0), (3, "p", 1.0)], "player_id int, category_name string, pct_spend double")
    wide = rs.pivot_long(long, "player_id", "category_name", "pct_spend", prefix="Spend Distr ")
    assert wide.columns == ["player_id", "Spend Distr p", "Spend Distr NA"]
    assert sorted(map(tuple, wide.collect())) == [(1, 0.5, 0.5), (2, 0.0, 1.0), (3, 1.0, 0.0)]
    named = long.union(spark.createDataFrame([(4, "na", 0.7)], long.schema))  # a real name keeps its column
    wide = rs.pivot_long(named, "player_id", "category_name", "pct_spend")
    assert wide.columns == ["player_id", "na", "p", "NA_"]
    assert sorted(map(tuple, wide.collect())) == [(1, 0.0, 0.5, 0.5), (2, 0.0, 0.0, 1.0), (3, 0.0, 1.0, 0.0), (4, 0.7, 0.0, 0.0)]
    numbers = spark.createDataFrame([(1, 5, 0.5), (1, None, 0.5)], "id int, n int, v double")
    assert [tuple(r) for r in rs.pivot_long(numbers, "id", "n", "v").collect()] == [(1, 0.5, 0.5)]


def test_sums_below_a_cent_and_literal_game_names(spark):
    from cohortlens.functions.scalar import match_game, money_sum
    assert spark.range(1000).select(F.lit(0.004).alias("x")).agg(money_sum("x")).first()[0] == 4.0
    df = spark.createDataFrame([("MygameQatar_IOS",), ("MygameQA_IOS",), ("my.game_IOS",)], "g string")
    keep = lambda game, qa: [r[0] for r in df.select(match_game("g", game, qa)).collect()]
    assert keep("Mygame", False) == [True, True, False]
    assert keep("Mygame", True) == [True, False, False]
    assert keep("My.Game", False) == [False, False, True]


def test_projection_helpers(spark):
    df = spark.createDataFrame([(1, "2", None, "x")], "id int, num_txt string, v double, tenure_days string")
    assert prep.columns_matching(df, pattern="^NUM") == ["num_txt"]
    assert prep.columns_matching(df, start="num_txt", end="v") == ["num_txt", "v"]
    assert prep.columns_matching(df, suffix="_days") == ["tenure_days"]
    out = prep.cast_numeric(prep.fill_nulls(df, 0.0, ["v"]), ["num_txt", "tenure_days"])
    r = out.first()
    assert (r["num_txt"], r["v"], r["tenure_days"]) == (2.0, 0.0, None)
    sel = prep.select_columns(df, keep=["id", "v", "num_txt"], drop=["v"], rename={"num_txt": "n"})
    assert sel.columns == ["id", "n"]
    assert prep.sanitize_names(spark.createDataFrame([(1,)], "`Spend Distr Kid's Decor` int")).columns == ["Spend_Distr_Kid_s_Decor"]
    clash = spark.createDataFrame([(1, 2, 3)], "`A B` int, `A_B` int, `a-b` int")
    assert prep.sanitize_names(clash, "S_").columns == ["S_A_B", "S_A_B_2", "S_a_b_3"] and prep.sanitize_names(clash).select("A_B_2").first()[0] == 2
