"""The whole cleaning job: corpus in, split tables and manifest out."""

from __future__ import annotations

from pyspark.sql import DataFrame

from textmill import rules
from textmill.operators.cleaning import clean, manifest
from textmill.operators.split import assign_splits
from textmill.session import materialize
from textmill.sources.corpus import read_jsonl, read_manifest, write_row, write_splits


def clean_table(
    raw: DataFrame, output: str, input_name: str, seed: int = rules.SPLIT_SEED, limits: rules.Limits = rules.Limits()
) -> DataFrame:
    """Clean, split and write a table of ``(doc_id, text)``; returns the manifest. Rows
    without an id are ordered and split by the key of their raw text.

    The cleaned texts are stored once, as three steps need them; counters and hash
    are computed from the raw table in a narrow pass of their own.
    """
    cleaned = materialize(clean(raw, with_key=True, limits=limits), "cleaned")
    write_splits(assign_splits(cleaned, seed, limits), f"{output}/splits", seed=seed)
    write_row(manifest(raw, input_name, seed, limits), f"{output}/manifest")
    return read_manifest(raw.sparkSession, f"{output}/manifest")


def clean_corpus(
    spark, path: str, output: str, seed: int = rules.SPLIT_SEED, limits: rules.Limits = rules.Limits()
) -> DataFrame:
    return clean_table(read_jsonl(spark, path), output, path, seed, limits)
