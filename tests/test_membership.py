"""Membership filter: no member is lost, few others pass, filters of parts add up, and its size is bounded."""

from pyspark.sql import functions as F

from cohortlens.operators.membership import keep_members, member_words


def test_members_pass_and_few_others(spark):
    members = spark.range(0, 40_000, 2).select(F.concat(F.lit("d"), "id").alias("s"))
    rows = spark.range(0, 40_000).select(F.concat(F.lit("d"), "id").alias("s"), F.col("id").alias("__mask"))
    words = member_words(members.union(members), "s", words=1 << 14)
    kept = {r["__mask"] for r in keep_members(rows, "s", words, words=1 << 14).collect()}
    assert kept >= set(range(0, 40_000, 2))
    assert len(kept) - 20_000 < 0.01 * 20_000


def test_parts_add_up_and_size_is_bounded(spark):
    keys = spark.range(0, 5000).select(F.col("id").alias("s"))
    whole = {r["__word"]: r["__bits"] for r in member_words(keys, "s", words=64).collect()}
    parts = member_words(keys.where("s < 100"), "s", words=64).union(member_words(keys.where("s >= 100"), "s", words=64))
    merged = {r["__word"]: r["b"] for r in parts.groupBy("__word").agg(F.bit_or("__bits").alias("b")).collect()}
    assert whole == merged and len(whole) == 64


def test_null_and_empty(spark):
    rows = spark.createDataFrame([("a",), (None,), ("b",)], "s string")
    assert keep_members(rows, "s", member_words(rows.where("false"), "s")).count() == 0
    kept = keep_members(rows, "s", member_words(rows.where("s is null or s = 'a'"), "s")).collect()
    assert {r["s"] for r in kept} == {"a", None}
