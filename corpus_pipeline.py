"""Corpus pipeline over ``documents``: each stage calls one operator of ``cohortlens.llm`` and its result is written
as Parquet and read again as the documents of the next stage.

All stages but the last return the columns of ``documents``; the last returns the pieces of the packed sequences.
Rows keep their doc_id throughout. Null texts count as empty: the first stage rejects them. Documents whose text is
all repeats stay, empty, and are packed as their separator token. An empty table gives no pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm import kneser_ney, packing, suffix_dedup, tensored_minhash, toxicity
from cohortlens.llm.shared import scratch, small_batches


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity under the model of trusted text is within the limit of their language."""
    small_batches(spark)
    return kneser_ney.keep_good(docs, _labels(spark, sf_dir).where("quality = 1"))


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the pattern grammar does not call toxic."""
    small_batches(spark)
    model = toxicity.train(docs, _labels(spark, sf_dir).where(~toxicity.held_out("doc_id")))
    return toxicity.keep_clean(docs, model)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the least doc_id) of each group of near-duplicates. Of rows that share a doc_id the least one stays;
    rows without a doc_id can't be told apart later, so none stays."""
    small_batches(spark)
    kept = tensored_minhash.near_duplicates(docs).where("kept").select(F.col("doc_id").alias("__kept_id"))
    chosen = docs.join(kept, docs["doc_id"] == F.col("__kept_id"), "left_semi")
    several = docs.groupBy(F.col("doc_id").alias("__id")).agg(F.count("*").alias("n")).where("__id IS NOT NULL AND n > 1").select("__id")
    if several.isEmpty():  # as ids should be: no text is compared or moved again
        return chosen
    least = chosen.join(several, chosen["doc_id"] == F.col("__id"), "left_semi").groupBy("doc_id").agg(F.min(F.struct(*docs.columns)).alias("row"))
    return chosen.join(several, chosen["doc_id"] == F.col("__id"), "left_anti").unionByName(least.select("row.*"))


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without passages of 100 bytes or more that occur earlier."""
    small_batches(spark)
    cut = suffix_dedup.remove_repeats(docs)
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cut


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 4096 tokens."""
    small_batches(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality", quality), ("toxicity", clean), ("near_duplicates", distinct), ("repeats", without_repeats), ("packing", packed)]

#: Trained scores, hashes of many bytes and tokens are beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
