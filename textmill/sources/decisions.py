"""The log of request decisions, appended as JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DECISION_SCHEMA = (
    "event string, client string, reason string, category string, token_count int, "
    "latency_ms double, model_version string, dataset_hash string, safe_mode boolean, request_id string"
)
_FIELDS = [f.strip().split(" ") for f in DECISION_SCHEMA.split(",")]


def decision_rows(df: DataFrame) -> DataFrame:
    """The log columns of a table; those it lacks are null."""
    return df.select(*[(F.col(n) if n in df.columns else F.lit(None)).cast(t).alias(n) for n, t in _FIELDS])


def append_decisions(df: DataFrame, path: str) -> None:
    decision_rows(df).write.mode("append").json(path)


def read_decisions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(DECISION_SCHEMA).json(path)
