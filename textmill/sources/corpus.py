"""JSON Lines corpora: raw records, split tables, manifests and result rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill import rules
from textmill.operators.split import order_key, row_key
from textmill.sources.ordered import in_ranges

RAW_SCHEMA = "doc_id bigint, text string, source string, label string"
MANIFEST_SCHEMA = (
    "cleaning_rules_version string, split_seed int, dataset_hash string, input_file string, "
    "stats struct<total_input: bigint, removed_duplicate: bigint, removed_html: bigint, removed_unicode: bigint, "
    "removed_pii: bigint, removed_length: bigint, removed_boilerplate: bigint, total_output: bigint, "
    "train_count: bigint, val_count: bigint, test_count: bigint>"
)


def read_jsonl(spark: SparkSession, path: str, schema: str = RAW_SCHEMA) -> DataFrame:
    """Records of a JSON Lines folder. Blank lines are skipped; a malformed line
    or a record without a text fails the job."""
    records = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    missing = F.raise_error(F.lit("record without a text"))
    return records.withColumn("text", F.coalesce("text", missing))


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def write_splits(
    assigned: DataFrame, path: str, mode: str = "overwrite", seed: int = rules.SPLIT_SEED
) -> None:
    """One JSON Lines folder per split, as raw UTF-8, in seeded order: the files of a folder,
    taken by name, hold its rows in order."""
    rows = assigned.select(
        "doc_id",
        "text",
        # Never null, so that the writer need not sort by it again.
        F.coalesce("split", F.lit("")).alias("split"),
        order_key(row_key(assigned), seed).alias("order_key"),
        row_key(assigned).alias("row_key"),
    )
    dealt = in_ranges(rows, "split", "order_key", "row_key").drop("order_key", "row_key")
    dealt.write.mode(mode).partitionBy("split").json(path)


def read_splits(spark: SparkSession, path: str, *names: str) -> DataFrame:
    """The named splits, or all of them; other splits' files are not opened. A split
    that got no rows is an empty table."""
    table = spark.read.schema("doc_id bigint, text string, split string").json(path)
    unknown = set(names) - set(rules.SPLITS)
    if unknown:
        raise ValueError(f"no such split: {sorted(unknown)}")
    return table.where(F.col("split").isin(*names)) if names else table


def write_row(row: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A one-row table (manifest, evaluation result) as a single JSON file."""
    row.coalesce(1).write.mode(mode).json(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST_SCHEMA).json(path)
