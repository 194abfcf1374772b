"""Queries of this subpackage over the given tables, and the SQL that checks those SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyframe.llm import centroids, embedding_dedup, exact_dedup, html_text, language_id, licenses, mixing, packing, pii, prefix_trie, secrets_scan, simhash, toxicity
from tallyframe.llm.checks import ORACLES

TOKENIZER = "word_bpe_49k.json"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Where the vocabulary files are installed; the same on every machine."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract_text(_table(spark, folder, "pages"))


def op2_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.personal_data_report(_table(spark, folder, "documents"))


def op3_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets_scan.secrets_report(_table(spark, folder, "documents"))


def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_documents(_table(spark, folder, "documents"))


def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(_table(spark, folder, "documents"), tokenizer_path())


def op6_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, folder, "documents"))


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return toxicity.score_documents(docs, toxicity.train(docs, _table(spark, folder, "labels")))


def op8_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.license_report(_table(spark, folder, "documents"))


def op9_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_dedup.near_duplicate_vectors(_table(spark, folder, "embeddings"))


def op10_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_duplicates(_table(spark, folder, "documents"))


def op11_centroids(spark: SparkSession, folder: str) -> DataFrame:
    return centroids.cluster_vectors(_table(spark, folder, "embeddings"))


def op12_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return language_id.identify(docs, language_id.train(docs))


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.prefix_trie(_table(spark, folder, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_text": op1_html_text,
    "op2_pii": op2_pii,
    "op3_secrets": op3_secrets,
    "op4_mixing": op4_mixing,
    "op5_packing": op5_packing,
    "op6_simhash": op6_simhash,
    "op7_toxicity": op7_toxicity,
    "op8_licenses": op8_licenses,
    "op9_embedding_dedup": op9_embedding_dedup,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_centroids": op11_centroids,
    "op12_language_id": op12_language_id,
    "op13_prefix_trie": op13_prefix_trie,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
