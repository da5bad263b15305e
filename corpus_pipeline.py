"""From raw documents to token ids: five stages, each over all rows that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexmill.llm import jaccard, mixing, quality, toxicity
from lexmill.llm.queries import QUALITY_LEAST, TOXIC_LEAST, bpe_digest
from lexmill.session import cut_lineage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with significant toxic passages go; the model learns from the labels of `docs`."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.without_toxic(docs, model, TOXIC_LEAST)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that labelled neighbours vote down go."""
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.good_documents(docs, model, QUALITY_LEAST)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked shingle sets stays."""
    return jaccard.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target takes it: not at all, once or twice."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digests of every document's token ids."""
    return bpe_digest(spark, docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", keep_good),
    ("near_copies", drop_near_copies),
    ("mixing", mix_sources),
    ("byte_bpe", encode),
]

# The two classifiers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; between two stages the rows are written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
