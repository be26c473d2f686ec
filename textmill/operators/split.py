"""Seeded order and exact 80/10/10 split without a global sort.

The seeded order is by a hash of (seed, id). A row's split depends only on which
side of two cut points it falls, so the cut points are looked up exactly and the
rows are then labelled where they are: texts are never shuffled or ranked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmill import rules

BUCKET_HEX = 4  # at most 16 ** 4 buckets


def order_key(id_col: Column, seed: int = rules.SPLIT_SEED) -> Column:
    return F.sha2(F.concat_ws(":", F.lit(str(seed)), id_col.cast("string")), 256)


def row_key(df: DataFrame) -> Column:
    """What names a row: its id, or, in a table of one row per raw text that has
    ``content_key``, that key where there is no id."""
    own = F.col("doc_id").cast("string")
    return F.coalesce(own, F.col("content_key")) if "content_key" in df.columns else own


def seeded_order(df: DataFrame, seed: int = rules.SPLIT_SEED, id_col: str = "doc_id") -> DataFrame:
    """The rows in seeded order: the same for any partitioning of the input."""
    keyed = df.withColumn("order_key", order_key(F.col(id_col), seed))
    return keyed.orderBy("order_key", id_col)


def split_sizes(n: Column, limits: rules.Limits = rules.Limits()) -> dict[str, Column]:
    train = F.floor(n * limits.train_end)
    val = F.floor(n * limits.val_end)
    return {"train": train, "val": val - train, "test": n - val}


def _cut_points(keys: DataFrame, limits: rules.Limits) -> DataFrame:
    """One struct: the keys of the last train row and of the last val row."""
    bucket = F.left("order_key", F.lit(BUCKET_HEX))
    counts = keys.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    # Bounded by 16 ** BUCKET_HEX rows, whatever the table holds.
    upto = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    everything = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    running = counts.select(
        "bucket", "n", F.sum("n").over(upto).alias("upto"), F.sum("n").over(everything).alias("total")
    )
    train_end = F.floor(F.col("total") * limits.train_end)
    val_end = F.floor(F.col("total") * limits.val_end)
    before = F.col("upto") - F.col("n")

    def holds(rank: Column) -> Column:
        return (before < rank) & (rank <= F.col("upto"))

    cuts = running.where(holds(train_end) | holds(val_end)).select(
        "bucket", before.alias("before"), train_end.alias("train_end"), val_end.alias("val_end")
    )
    # Only the rows of the (at most two) buckets with a cut in them are ranked.
    within = Window.partitionBy("bucket").orderBy("order_key", "row_key")
    ranked = (
        keys.withColumn("bucket", bucket)
        .join(F.broadcast(cuts), "bucket")
        .withColumn("rank", F.row_number().over(within) + F.col("before"))
    )
    at = F.struct("order_key", "row_key")
    return ranked.agg(
        F.struct(
            F.max(F.when(F.col("rank") == F.col("train_end"), at)).alias("last_train"),
            F.max(F.when(F.col("rank") == F.col("val_end"), at)).alias("last_val"),
        ).alias("cuts")
    )


def assign_splits(df: DataFrame, seed: int = rules.SPLIT_SEED, limits: rules.Limits = rules.Limits()) -> DataFrame:
    """Add ``split``. Rows need keys (``row_key``) that are not null and not repeated,
    else the job fails. ``df`` is read for its texts once: give it a stored table."""
    key = F.coalesce(row_key(df), F.raise_error(F.lit("a row without an id")))
    keys = df.select(order_key(key, seed).alias("order_key"), key.alias("row_key"))
    cuts = _cut_points(keys, limits).scalar()
    copies = keys.groupBy("row_key").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).scalar()
    here = F.struct(order_key(key, seed).alias("order_key"), key.alias("row_key"))
    # A cut point is null when no row precedes it.
    split = (
        F.when(copies > 1, F.raise_error(F.lit("an id is repeated")))
        .when(here <= cuts["last_train"], "train")
        .when(here <= cuts["last_val"], "val")
        .otherwise("test")
    )
    return df.withColumn("split", split)


def split_counts(assigned: DataFrame) -> DataFrame:
    """Rows per split, with 0 for an empty one."""
    counted = assigned.agg(
        *[F.count_if(F.col("split") == name).alias(name) for name in rules.SPLITS]
    )
    return counted.select(
        F.inline(F.array(*[F.struct(F.lit(s).alias("split"), F.col(s).alias("n_rows")) for s in rules.SPLITS]))
    )
