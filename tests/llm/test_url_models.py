"""URL models against SQL on edge cases, their probabilities against the definition, and planted urls."""

import math
import random

import duckdb
import pandas as pd
import pytest

from cohortlens.llm import url_models as U
from cohortlens.llm.oracles import ORACLES
from cohortlens.llm.shared import stored

SCHEMA = "page_id long, url string, host string, path string, n long, text string, score string, held int, window int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 3, "z", "s", 1, 2) for r in rows], SCHEMA).repartition(3)


def against_sql(spark, rows):
    con = duckdb.connect()
    con.register("pages", pd.DataFrame(rows, columns=["page_id", "url"]).astype({"page_id": "Int64", "url": "string"}))
    cur = con.execute(ORACLES["op11_url_models"])
    names = [d[0] for d in cur.description]
    want = sorted(map(repr, cur.fetchall()))
    got = U.judge(frame(spark, rows)).collect()
    assert sorted(repr(tuple(r[c] for c in names)) for r in got) == want
    return got


def test_edges_equal_sql(spark):
    rng = random.Random(6)
    rows = [(0, None), (1, ""), (2, "no scheme.example.com/en/"), (3, "://"), (4, "http://"), (5, "http://?q"), (6, "HTTP://WWW.Example.COM/en/A?b#c"),
            (7, "https://example.com/en/x"), (8, "https://notexample.com/en/x"), (9, "https://a.example.com/EN/x"), (10, "https://example.com/en"),
            (11, "http://net/es/"), (12, "http://a.net/fr/1"), (13, "http://user@b.net:80/es/"), (14, "http://b.net?/es/"), (15, "http://com"),
            (16, "http://x.org/été/ÀÉ"), (17, "http://ÀB.org/1://2"), (18, "http://x.org/\x01\x02\n\t"), (19, "http://x.org/" + "ab/" * 3000), (None, "http://n.org/"),
            (20, "http://x.org/" + "q" * 243), (21, "http://x.org/" + "q" * 244), (20, "http://x.org/")]
    for i in range(30, 300):
        host = rng.choice(["", "www.", "blog."]) + rng.choice(["garden", "river", "cheap-pills", "spam-farm"]) + rng.choice([".example.com", ".com", ".net", ".org"])
        rows.append((i, f"https://{host}/{rng.choice(['en', 'es', 'fr', 'de'])}/{rng.randint(0, 99)}"))
    rows += [(1000 + i, "https://hot.org/all/the/same") for i in range(150)]
    got = against_sql(spark, rows)
    by = {r["page_id"]: r for r in got}
    assert [by[i]["rule"] for i in (6, 7, 8, 9, 10, 11, 12, 13, 14, 15)] == ["www.example.com/en/", "example.com/en/", "com/", "com/", "com/",
                                                                               "net/es/", "net/fr/", None, None, None]
    assert by[6]["host"] == "www.example.com" and (by[2]["host"], by[2]["path"]) == ("", "") and by[5]["path"] == ""


def test_without_a_class_and_empty(spark):
    rows = [(i, f"http://a{i}.org/x") for i in range(20)]
    assert {(r["score"], r["lowest"], r["verdict"]) for r in against_sql(spark, rows)} == {(0, 0, "allow")}
    assert U.judge(frame(spark, [])).collect() == []
    only = against_sql(spark, rows + [(100 + i, f"http://b{i}.com/y") for i in range(20)])
    assert {r["lowest"] for r in only if r["rule"] is None} == {0}


def test_probabilities_by_definition(spark):
    rng = random.Random(8)
    texts = ["".join(rng.choice("abc/") for _ in range(rng.randint(0, 30))) for _ in range(120)]
    rows = [(t, i % 3 == 0, i % 3 == 1, i % 3 == 2) for i, t in enumerate(texts)]
    got = {r["window"]: r["weight"] for r in U.train(spark.createDataFrame(rows, "text string, accepted boolean, rejected boolean, used boolean"), 3, 3).collect()}

    def model(kind):
        n = {}
        for row in rows:
            if row[kind]:
                t = U.OPEN * 3 + row[0] + U.END
                for i in range(3, len(t)):
                    for k in range(4):
                        after = n.setdefault(t[i - k:i], {})
                        after[t[i]] = after.get(t[i], 0) + 1

        def p(context, c):
            seen = n.get(context, {})
            if not context:
                return (seen.get(c, 0) + (len(seen) + 1) / U.CODE_POINTS) / (sum(seen.values()) + len(seen) + 1)
            low = p(context[1:], c)
            total = sum(seen.values())
            return (seen.get(c, 0) + len(seen) * low) / (total + len(seen)) if total >= 3 else low
        return p

    a, r = model(1), model(2)
    used = {(U.OPEN * 3 + t + U.END)[i:i + 4] for t in texts for i in range(len(t) + 1)}
    assert set(got) == used
    for w in used:
        assert got[w] == pytest.approx(1000 * math.log(a(w[:3], w[3]) / r(w[:3], w[3])), abs=0.51)
    sums = sum(a("", c) for c in "abc/\x02")
    assert 0.99 < sums <= 1


def test_scores_and_frequent_windows(spark):
    texts = ["abcabc", "abd", "", "x" * 700]
    urls = stored(spark.createDataFrame([(t, t, True, False, True) for t in texts] + [("r", "zzz", False, True, False)],
                                        "url string, text string, accepted boolean, rejected boolean, used boolean"))
    weights = stored(U.train(urls, 2, 1))
    w = {r["window"]: r["weight"] for r in weights.collect()}
    got = {r["url"]: r["score"] for r in U.score(urls.where("used"), weights, 2).collect()}
    for t in texts:
        padded = U.OPEN * 2 + t + U.END
        parts = [w[padded[i:i + 3]] for i in range(len(t) + 1)]
        assert got[t] == sum(parts) // len(parts)


def test_limit(spark):
    def limit(accepted, rejected):
        rows = [(s, True) for s in accepted] + [(s, False) for s in rejected]
        return U.calibrate(spark.createDataFrame(rows, "score long, accepted boolean"))

    assert limit([5, 9, 12], [-7, -3]) == 0
    assert limit([50, 60], [10, 20, 30]) == 50
    assert limit([], [1]) == 0 and limit([3], []) == 0
    assert limit([-5, 1, 2, 3], [-9, -5, 0, 1]) == 1  # by hand: errors 1/4 + 1/4


def test_planted_kinds_are_told_apart(spark):
    rng = random.Random(1)
    word = lambda letters: "".join(rng.choice(letters) for _ in range(8))
    rows, truth = [], {}
    for i in range(1200):
        bad = i % 2 == 0
        name = word("xqzk") if bad else word("aeirstn")
        if i < 800:
            rows.append((i, f"http://{name}.net/es/{i}" if bad else f"http://{name}.com/es/{i}"))
        else:
            rows.append((i, f"http://{name}.org/{i}"))
            truth[i] = "block" if bad else "allow"
    got = {r["page_id"]: r["verdict"] for r in U.judge(frame(spark, rows)).collect()}
    assert sum(got[i] == v for i, v in truth.items()) >= 0.97 * len(truth)
