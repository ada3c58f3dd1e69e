"""The corpus pipeline: language ID, near-dedup, decontamination, personal data, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each result as Parquet in the shared folder
and reads it again as the next stage's docs, after which the table before it is deleted. All but the last stage return the
columns of docs, whatever their names. In all stages a null text is an empty one, an empty table gives an empty one, and
null ids are ids like any other.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from calltrail.llm import decontam, langid, neardup, pieces, pii
from calltrail.llm.common import discard, materialize, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the texts that are likelier in some language than in none; null and empty texts go, repeated rows stay repeated."""
    return langid.fuse(docs).where("__keep").select(*[F.col(f"`{c}`") for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest doc_id of each near-duplicate group. Rows that tie in id and text count once."""
    return neardup.keep_one(spark, docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts benchmark passages out; a document that is mostly such passages goes. Each row is judged on its own."""
    return decontam.remove_contamination(spark, docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by the name of its kind. All rows stay; null texts stay null."""
    return pii.redact_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encodes what is left and decodes it again: doc_id, n_tokens, ids_sha256, decoded_sha256, a row for each row."""
    return pieces.encode_digests(docs, public_tokenizers.path("piece_bpe_32k.model")).withColumnRenamed("id", "doc_id")


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("personal_data", personal_data),
    ("token_ids", token_ids),
]

#: SQL expresses neither the language model nor the merges; tests/llm holds the pipeline against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
        if before is not None:
            discard(before)
        before = docs
    return docs
