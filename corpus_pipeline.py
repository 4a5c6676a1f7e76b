"""Cleaning of a document corpus in five stages, each written as Parquet and read by the next.

Toxic documents go, one document of each group of near copies (five-word similarity of 0.8) stays, documents that hold
benchmark items go, secrets are masked in place, and what is left is encoded. Every stage but
the last returns the columns of documents. A stage on an empty table returns an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quirework.llm import bpe, decontaminate, secrets, simhash, toxicity
from quirework.llm.session import fresh_path, materialize, table
from quirework.shipping import ship_package


#: Near copies: texts whose sets of shingles of so many words are so similar (Jaccard) or more.
SHINGLE_WORDS, SIMILARITY = 5, 0.8


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows that the model fitted on ``labels`` does not reject; null and empty texts stay, and repeated rows are judged alike."""
    ship_package(spark)
    return toxicity.keep_clean(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies, that of the smallest doc_id; null, empty and blank texts are one group, and repeated rows count as copies."""
    ship_package(spark)
    return simhash.one_of_each(docs, SHINGLE_WORDS, similarity=SIMILARITY)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows in whose text no item of ``benchmark`` is found; null and empty texts stay."""
    ship_package(spark)
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, secrets in their texts masked; null texts stay null."""
    ship_package(spark)
    return secrets.mask_secrets(docs, fresh_path(spark, "secret-ledger"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, digests and ids of every row; null and empty texts have no ids."""
    import public_tokenizers

    ship_package(spark)
    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, with_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_copies),
    ("decontamination", drop_benchmark_leaks),
    ("secrets", mask_secrets),
    ("encoding", encode),
]

#: A trained model, XXH64 fingerprints and a tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
