"""Hash tree over a cleaned table, and what differs between two versions of it.

The seeded order cuts a table into buckets by the first digits of the order key: a leaf of
the tree is a bucket of ``LEAF_HEX`` digits, its parent the bucket of ``PARENT_HEX``, and the
root all of them. A leaf's hash is that of the sums of its rows' digests, which combine on
the map side like the whole table's fingerprint; hashes of parents are of their children's,
256 at most. So a tree has 65,793 nodes at most, whatever the table holds, and is kept
beside it: two versions are compared by their roots, then by parents, then by the leaves of
parents that differ, and only rows of those leaves are read to say what changed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill import rules
from textmill.operators.fingerprint import LANES, row_digest_sums
from textmill.operators.split import order_key, row_key

LEAF_HEX, PARENT_HEX = 4, 2


def _parents(nodes: DataFrame, digits: int) -> DataFrame:
    children = F.sort_array(F.collect_list(F.struct("bucket", "hash")))
    said = F.array_join(F.transform(children, lambda c: F.concat(c["bucket"], F.lit("="), c["hash"])), ",")
    return nodes.groupBy(F.left("bucket", F.lit(digits)).alias("bucket")).agg(
        F.sum("n_rows").alias("n_rows"), F.sha2(said, 256).alias("hash")
    )


def hash_tree(cleaned: DataFrame, seed: int = rules.SPLIT_SEED) -> DataFrame:
    """``(level, bucket, n_rows, hash)``: level 0 is the root (bucket ``""``), 2 the leaves.
    An empty table has no nodes."""
    key = order_key(row_key(cleaned), seed)
    sums = row_digest_sums(key, F.sha2("text", 256))
    counted = cleaned.groupBy(F.left(key, F.lit(LEAF_HEX)).alias("bucket")).agg(F.count(F.lit(1)).alias("n_rows"), *sums)
    lanes = [F.col(f"lane_{lane}").cast("string") for lane in range(LANES)]
    digest = F.sha2(F.concat_ws(":", F.col("n_rows").cast("string"), *lanes), 256)
    leaves = counted.select("bucket", "n_rows", digest.alias("hash"))
    parents = _parents(leaves, PARENT_HEX)
    levels = [_parents(parents, 0), parents, leaves]
    named = [nodes.select(F.lit(n).alias("level"), "bucket", "n_rows", "hash") for n, nodes in enumerate(levels)]
    return named[0].unionByName(named[1]).unionByName(named[2])


def _differing(before: DataFrame, after: DataFrame, level: int) -> DataFrame:
    old, new = (
        t.where(F.col("level") == level).select("bucket", F.col("n_rows").alias(f"n_{s}"), F.col("hash").alias(f"hash_{s}"))
        for t, s in ((before, "before"), (after, "after"))
    )
    return old.join(new, "bucket", "full").where(~F.col("hash_before").eqNullSafe(F.col("hash_after")))


def changed_buckets(before: DataFrame, after: DataFrame) -> DataFrame:
    """``(bucket, n_before, n_after)`` of the leaves that differ between two stored trees,
    found from the root down: below equal nodes nothing is compared."""
    roots = _differing(before, after, 0)
    parents = _differing(before, after, 1).join(roots.select(F.lit(1).alias("differ")), F.lit(True), "left_semi")
    leaves = _differing(before, after, 2).withColumn("parent", F.left("bucket", F.lit(PARENT_HEX)))
    below = leaves.join(parents.select(F.col("bucket").alias("parent")), "parent", "left_semi")
    return below.select(
        "bucket", F.coalesce("n_before", F.lit(0)).alias("n_before"), F.coalesce("n_after", F.lit(0)).alias("n_after")
    )


def changed_rows(before: DataFrame, after: DataFrame, buckets: DataFrame, seed: int = rules.SPLIT_SEED) -> DataFrame:
    """``(row_key, change)``: rows ``added``, ``removed`` or ``changed`` between two cleaned
    tables, out of the buckets that differ. Keys are unique; only hashes of texts move."""

    def side(table: DataFrame, name: str) -> DataFrame:
        key = row_key(table)
        bucket = F.left(order_key(key, seed), F.lit(LEAF_HEX))
        rows = table.select(key.alias("row_key"), bucket.alias("bucket"), F.sha2("text", 256).alias(name))
        return rows.join(buckets.select("bucket"), "bucket", "left_semi").drop("bucket")

    both = side(before, "old").join(side(after, "new"), "row_key", "full").where(~F.col("old").eqNullSafe(F.col("new")))
    change = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").otherwise("changed")
    return both.select("row_key", change.alias("change"))
