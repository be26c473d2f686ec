"""Order-aware dataset fingerprint as a plain aggregate.

Every row is hashed together with its place in the seeded order, and the hashes
are added up (incremental hashing by addition: Bellare and Micciancio, 1997). The
sum changes with any text, with the order and with the seed, yet it combines on
the map side: no sort, no shuffle of texts, no list of hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill import rules
from textmill.operators.split import order_key, row_key

LANES = 4
HEX_PER_LANE = 15  # 60 bits fit a bigint
DIGEST_CHARS = 16


def row_digest_sums(key: Column, text_hash: Column, kept: Column | None = None) -> list[Column]:
    """Per lane, the sum over all (kept) rows of a 60-bit piece of the row hash."""
    digest = F.sha2(F.concat_ws(":", key, text_hash), 256)
    sums = []
    for lane in range(LANES):
        piece = F.conv(F.substring(digest, 1 + lane * HEX_PER_LANE, HEX_PER_LANE), 16, 10).cast("decimal(28,0)")  # the sum is decimal(38,0)
        total = F.sum(piece if kept is None else F.when(kept, piece))
        sums.append(F.coalesce(total, F.lit(0).cast("decimal(38,0)")).alias(f"lane_{lane}"))
    return sums


def digest_of_sums(n_rows: Column) -> Column:
    lanes = [F.col(f"lane_{lane}").cast("string") for lane in range(LANES)]
    return F.left(F.sha2(F.concat_ws(":", n_rows.cast("string"), *lanes), 256), F.lit(DIGEST_CHARS))


def dataset_fingerprint(cleaned: DataFrame, seed: int = rules.SPLIT_SEED) -> DataFrame:
    """``(n_rows, dataset_hash)`` of a cleaned table."""
    sums = row_digest_sums(order_key(row_key(cleaned), seed), F.sha2("text", 256))
    return cleaned.agg(F.count(F.lit(1)).alias("n_rows"), *sums).select(
        "n_rows", digest_of_sums(F.col("n_rows")).alias("dataset_hash")
    )
