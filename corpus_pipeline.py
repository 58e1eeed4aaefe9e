"""A training-data pipeline over `documents`: each stage gets what its predecessor kept.

Rejected and repeated documents go, secrets are replaced in the texts, the rows are put in the order of the
mix, and the last stage returns what the encoder made of each text, with its place in the mix. All but the last keep the
columns of documents, under any names; extra ones stay.

Defined cases, for all stages: an empty table gives an empty one. Null and empty texts fail the quality rules. Null and
repeated ids are rows like any others: near-dedup drops rows, not ids. Equal rows leave one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelyard.llm import mixing, neardup, pieces, quality, secrets
from panelyard.llm.common import forget, scratch, table, written


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: documents that they reject go."""
    return quality.keep_good(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup: one document of each group stays."""
    return neardup.keep_one(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secret scans: what they find is replaced, n_chars follows."""
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing sources to target weights: all rows, in files and rows ordered by the mix."""
    return mixing.in_mixed_order(docs, mixing.PRODUCTION, mixing.PRODUCTION_OTHERS)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece: pieces of each text, whether they decode to it, and its place in the files (null for rows that come from none)."""
    return pieces.encoded_and_back(mixing.stored_places(docs), keep=("place",))


STAGES = [
    ("quality_rules", drop_poor),
    ("minhash_near_dedup", drop_near_duplicates),
    ("secret_scans", redact_secrets),
    ("mixing_sources", mix_sources),
    ("sentencepiece", encode_pieces),
]
#: SQL can't express the near-duplicate, secret and SentencePiece stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with scratch():  # what the stage has written goes when its result is there
            before, docs = docs, written(stage(spark, docs, sf_dir), name, lasting=True)
        forget(before)
    return docs
