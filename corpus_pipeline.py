"""The corpus pipeline: toxic documents go, of near duplicates one stays, secrets are
written over, sources are mixed to their target weights, and the mix is tokenized.

``run`` writes each stage as Parquet below the shared folder and reads it back, so a lost
executor repeats a part of one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from textmill.llm import bpe, mixing, neardup, secrets, toxicity
from textmill.llm.common import documents, labels
from textmill.session import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.accepted(docs, labels(spark, sf_dir))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.deduplicated(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redacted_documents(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.round_trip(docs, keep_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
    ("byte_bpe", tokenize),
]
#: A learned classifier, a sampled candidate search and Newton rounds have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
