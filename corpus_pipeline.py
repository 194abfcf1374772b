"""The corpus pipeline: stages from raw documents to packed sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyframe.llm import exact_dedup, mixing, packing, shingles, toxicity
from tallyframe.llm.registry import tokenizer_path
from tallyframe.session import stored


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network, trained on the labels, takes for toxic go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.drop_toxic(docs, toxicity.train(docs, labels))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    return exact_dedup.drop_exact_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays whose fingerprints are near in BK-trees and whose five-word shingles similar by 0.8 or more."""
    return shingles.drop_similar(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; a part of one is its first words."""
    return mixing.repeat_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents by sequence."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [("toxicity", clean), ("exact dedup", exact), ("near dedup", near), ("mixing", mixed), ("packing", packed)]
ORACLE_SQL = None  # fingerprints, drawn repetitions and first-fit packing are not expressible


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
