"""The corpus pipeline: quality filter, near-duplicate removal, source mixing and
packing. Each stage works on the whole output of the one before, which is written
as Parquet under the shared folder and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almanac.llm import mixing, ngram_join, packing, quality
from almanac.llm.common import bounded_batches, documents, settle


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    bounded_batches(spark)
    model = quality.learn(quality.prepared(docs, documents(spark, sf_dir, "labels")))
    score = quality.scorer(model)(F.col("text").cast("string"))
    return docs.where(score >= quality.THRESHOLD)


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    bounded_batches(spark)
    return ngram_join.one_of_each(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as often as systematic sampling takes it."""
    bounded_batches(spark)
    ties = (F.col("doc_id"), F.xxhash64("text"))
    return mixing.emitted(mixing.mixed(docs, mixing.word_count(F.col("text").cast("string")), F.col("source"), ties))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequences."""
    bounded_batches(spark)
    return packing.packed(docs)


STAGES = [("quality_classifier", quality_stage), ("ngram_jaccard_join", near_duplicates_stage),
          ("mix_sources", mixing_stage), ("best_fit_packing", packing_stage)]

#: No SQL: the classifier and the packing are iterative; tests/llm holds each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. Null and empty texts, repeated rows and empty
    tables follow the definitions of the stages' operators."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
