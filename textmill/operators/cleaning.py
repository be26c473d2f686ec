"""Rule classification, cleaned rows and cleaning counts.

All copies of a text fail the same rule, which makes three things cheap: cleaned
rows are filtered before they are deduplicated, so only texts that passed are
shuffled; counts need one row per (text, rule) and map task; and no operator
evaluates the rules after the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill import rules
from textmill.functions.quality import first_failure, passes_all
from textmill.functions.text import content_key, normalize_text, once
from textmill.operators.dedup import flag_duplicates
from textmill.operators.fingerprint import digest_of_sums, row_digest_sums
from textmill.operators.split import order_key, row_key, split_sizes


def with_normalized(df: DataFrame, text: str = "text") -> DataFrame:
    """Keys and normalized texts. A row without a text fails the job, in every operator
    alike."""
    raw = F.coalesce(F.col(text), F.raise_error(F.lit("record without a text")))
    return df.select("doc_id", content_key(raw).alias("content_key"), once(normalize_text(raw)).alias("norm"))


def classify(df: DataFrame, limits: rules.Limits = rules.Limits()) -> DataFrame:
    """``(doc_id, reason)`` for every row; ``keep`` marks the cleaned ones."""
    narrow = with_normalized(df).select("doc_id", "content_key", first_failure(F.col("norm"), limits).alias("rule"))
    return flag_duplicates(narrow).select(
        "doc_id",
        F.when(F.col("is_duplicate"), "duplicate").otherwise(F.coalesce("rule", F.lit("keep"))).alias("reason"),
    )


def clean(df: DataFrame, with_key: bool = False, limits: rules.Limits = rules.Limits()) -> DataFrame:
    """``(doc_id, text)`` of the kept rows, normalized; with ``content_key``, by which
    rows without ids can be told apart, if asked for."""
    passed = with_normalized(df).where(passes_all(F.col("norm"), limits))
    # Grouping by the text itself, which the key determines, keeps this a hash
    # aggregate with map-side combine.
    return (
        passed.groupBy("content_key", F.col("norm").alias("text"))
        .agg(F.min("doc_id").alias("doc_id"))
        .select("doc_id", *["content_key"] * with_key, "text")
    )


def _per_text(df: DataFrame, limits: rules.Limits, hash_texts: bool = False) -> DataFrame:
    """One narrow row per distinct raw text: its rule, copies and first id."""
    ruled = with_normalized(df).withColumn("rule", first_failure(F.col("norm"), limits))
    keys = ["content_key", "rule"]
    if hash_texts:
        ruled = ruled.withColumn("text_hash", F.when(F.col("rule").isNull(), F.sha2("norm", 256)))
        keys.append("text_hash")
    return ruled.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("doc_id"))


def _counts() -> list[Column]:
    n = F.coalesce(F.sum("copies"), F.lit(0))
    removed = [
        F.count_if(F.col("rule") == reason).alias(f"removed_{reason}") for reason in rules.REASONS[1:]
    ]
    return [
        n.alias("total_input"),
        (n - F.count(F.lit(1))).alias("removed_duplicate"),
        *removed,
        F.count_if(F.col("rule").isNull()).alias("total_output"),
    ]


STAT_NAMES = (
    "total_input", "removed_duplicate", "removed_html", "removed_unicode", "removed_pii",
    "removed_length", "removed_boilerplate", "total_output", "train_count", "val_count", "test_count",
)


def _with_split_counts(counts: DataFrame, limits: rules.Limits) -> DataFrame:
    sizes = split_sizes(F.col("total_output"), limits)
    return counts.withColumns({f"{name}_count": size for name, size in sizes.items()})


def cleaning_stats(df: DataFrame, limits: rules.Limits = rules.Limits()) -> DataFrame:
    """One row of counters. Split sizes follow from the number of kept rows."""
    return _with_split_counts(_per_text(df, limits).agg(*_counts()), limits).select(*STAT_NAMES)


def cleaning_report(stats: DataFrame) -> DataFrame:
    """Total removed and reduction in percent, next to the counters."""
    removed = sum(F.col(f"removed_{reason}") for reason in rules.REASONS)
    kept_share = F.col("total_output") / F.greatest(F.col("total_input"), F.lit(1))
    return stats.select(
        "*",
        removed.alias("total_removed"),
        F.round((1 - kept_share) * 100, 1).alias("reduction_pct"),
    )


def manifest(
    df: DataFrame, input_file: str, seed: int = rules.SPLIT_SEED, limits: rules.Limits = rules.Limits()
) -> DataFrame:
    """The manifest row: rules version, seed, dataset hash, input and counters.

    Counters and hash come out of one scan and one shuffle of narrow rows; the
    texts themselves are hashed where they are read.
    """
    kept, texts = F.col("rule").isNull(), _per_text(df, limits, hash_texts=True)
    sums = row_digest_sums(order_key(row_key(texts), seed), F.col("text_hash"), kept)
    totals = _with_split_counts(texts.agg(*_counts(), *sums), limits)
    return totals.select(
        F.lit(rules.RULES_VERSION).alias("cleaning_rules_version"),
        F.lit(seed).alias("split_seed"),
        digest_of_sums(F.col("total_output")).alias("dataset_hash"),
        F.lit(input_file).alias("input_file"),
        F.struct(*STAT_NAMES).alias("stats"),
    )
