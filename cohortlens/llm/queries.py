"""Registered queries of the subpackage: each applies one operator, with production parameters, to whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm import bit_sliced, conversation_repair, kneser_ney, packing, periodic_runs, piece_transducer, quality_rules, sharding, suffix_dedup, tensored_minhash, toxicity, url_models, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@_query
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.adaptive_rules(_table(spark, sf_dir, "documents"))


@_query
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@_query
def op9_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = _table(spark, sf_dir, "labels").where("quality = 1")
    return kneser_ney.classify(_table(spark, sf_dir, "documents"), trusted)


@_query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.where(~toxicity.held_out("doc_id")))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", toxicity.held_out("doc_id").alias("held_out"), "score", "predicted", "clauses")


@_query
def op1_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign_shards(_table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


@_query
def op2_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.archive_and_index(_table(spark, sf_dir, "pages"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured",
                        "index_pos")


@_query
def op4_bit_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bit_sliced.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@_query
def op8_tensored_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tensored_minhash.near_duplicates(_table(spark, sf_dir, "documents"))


@_query
def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removal_digest(_table(spark, sf_dir, "documents"))


@_query
def op3_piece_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return piece_transducer.encode_and_decode(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@_query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.run_digest(_table(spark, sf_dir, "documents"), plant=True)


@_query
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = conversation_repair.damaged(_table(spark, sf_dir, "conversations"))
    return conversation_repair.summary(conversation_repair.repair(turns, "copies"))


@_query
def op11_url_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_models.judge(_table(spark, sf_dir, "pages"))
