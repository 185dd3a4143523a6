"""From raw documents to a mixed, tokenised corpus: toxicity, line dedup, near-dedup, mixing, encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheetloom.llm import bpe, line_chunks, mixing, simhash, toxicity
from sheetloom.llm.queries import vocabulary
from sheetloom.session import scratch_path

#: Encoding and near-duplicates are not expressible in SQL; tests compare each stage with brute force.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones outside the held-out fold, does not call toxic."""
    model = toxicity.Toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    kept = model.score(docs).where("predicted = 0")
    return kept.select(*[F.col("row")[c].alias(c) for c in docs.columns])


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without chunks of lines that stand earlier."""
    return line_chunks.dedup_lines(docs)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component."""
    return simhash.one_of_each_group(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in the order of its schedule."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and digests of the ids and of what they decode to."""
    ranks, pattern = vocabulary()
    return bpe.decoded_digest(bpe.encode(docs, ranks, pattern), ranks)


STAGES = [("toxicity", drop_toxic), ("line_dedup", drop_lines), ("near_dedup", drop_near), ("mixing", mix), ("encoding", encode)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
