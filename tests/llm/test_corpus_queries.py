"""Registered corpus queries: SQL parity, schemas, and the pipeline against its stages."""

import hashlib

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from cohortlens.llm.oracles import ORACLES
from cohortlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_sql(spark, key):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.execute(ORACLES[key])
    names = [d[0] for d in want.description]
    want = want.fetchall()
    got = QUERIES[key](spark, SF)
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(repr, (tuple(r[c] for c in names) for r in got.collect()))) == sorted(map(repr, want))


def test_registered():
    assert {int(k[2:].split("_")[0]) for k in QUERIES} == set(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql())


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    frames = [docs]
    for _, stage in corpus_pipeline.STAGES:
        frames.append(stage(spark, frames[-1], SF).cache())
    ids = [{r["doc_id"] for r in f.select("doc_id").collect()} for f in frames]
    assert all(f.columns == docs.columns for f in frames[:-1])
    good = {i for i, r in labels.items() if r["quality"] == 1}
    assert len(good & ids[1]) >= 0.97 * len(good) and len((set(labels) - good) & ids[1]) <= 0.1 * len(set(labels) - good)
    assert ids[2] <= ids[1] and ids[3] <= ids[2] and ids[4] == ids[3] and ids[5] == ids[4]
    # near-duplicates and repeats by brute force, each on its own input
    from test_corpus_operators import linked, removed

    before = [(r["doc_id"], r["text"]) for r in frames[2].collect()]
    assert ids[3] == {i for i, (_, c) in linked(before, 5, 75).items() if c == i}
    before = [(r["doc_id"], r["text"]) for r in frames[3].collect()]
    want = removed(before, 100)
    for r in frames[4].collect():
        assert r["text"] == want[r["doc_id"]][4].decode(errors="ignore") and r["n_chars"] == len(r["text"])
    run = corpus_pipeline.run(spark, SF)
    key = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    whole = {(r["doc_id"], r["doc_tokens"]) for r in run.collect()}
    assert whole == {(r["doc_id"], r["doc_tokens"]) for r in frames[5].select(*key).collect()}
    assert hashlib.sha256(repr(sorted(whole)).encode()).hexdigest()


def test_pipeline_keeps_one_row_per_document(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, "one text that stands here twice", "en", "a", 31), (1, "one text that stands here twice", "en", "a", 31),
            (2, "b first of two quite different texts", "en", "a", 36), (2, "a second text of the very same id", None, "a", 33),
            (3, "one text that stands here twice", "de", "b", 31), (None, "no id at all in this row", "en", "a", 24), (4, None, "en", "a", 0)]
    docs = spark.createDataFrame(rows, schema).repartition(3)
    out = corpus_pipeline.distinct(spark, docs, SF)
    assert out.columns == docs.columns
    assert sorted((r["doc_id"], r["text"]) for r in out.collect() if r["doc_id"] != 4) == [(1, rows[0][1]), (2, rows[3][1])]
    assert [r["doc_id"] for r in out.where("doc_id = 4").collect()] == [4]
    assert corpus_pipeline.distinct(spark, docs.limit(0), SF).count() == 0
