"""Run logs: one JSON document per file, many runs per folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.operators.runlog import RUN_LOG_SCHEMA


def read_run_logs(spark: SparkSession, path: str) -> DataFrame:
    """All logs below a folder. A log without an id of its own gets its path."""
    runs = spark.read.schema(RUN_LOG_SCHEMA).option("multiLine", True).option("recursiveFileLookup", True).json(path)
    return runs.withColumn("run_id", F.coalesce("run_id", F.col("_metadata.file_path")))


def parse_run_log(document: Column) -> Column:
    """The same, for logs held in a string column."""
    return F.from_json(document, RUN_LOG_SCHEMA)
