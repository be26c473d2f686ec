"""Columns and table access shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def text_rows(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id``, ``text`` (null becomes empty) and the named columns; every
    other column stays out, so clashing names cannot matter."""
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *more)


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns that are computed once however often they are used later: a
    generator of one row is a border that expressions are not copied across."""
    fields = F.struct(*[c.alias(n) for n, c in columns.items()])
    made = df.select("*", F.explode(F.array(fields)).alias("__once"))
    return made.select(*df.columns, *[F.col(f"__once.{n}").alias(n) for n in columns])


def fold_remainder(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds
