"""Merkle manifest of a dataset: a tree of hashes per group, a tree over the groups' roots,
and for every row the siblings that prove it.

Rows are numbered within their group without a single-task window: they are dealt into
ranges, sorted there and stored with their place in the range; what precedes a range is a
sum over the (few) ranges of the group. A number's base-``FAN`` digits are its way down the
tree. A block of ``FAN ** DIGITS`` neighbours is one row in the end: the last digit is
grouped away, then the next, each time nesting the child structs and hashing them. The
blocks' roots are numbered nodes again and go through the same rollup until every group has
one root; the groups' roots, in group order, make the tree on top.

Proofs come down the same way: a block gets its own proof by grouping it with the row that
the level above emitted for it, then transforms and explodes of the nested structs emit
one row per child with the siblings before and after it. No row holds more than a block,
no join looks up a sibling, and a hot group is only more blocks.

A run is ``FAN`` consecutive nodes; the last one may be shorter, even one node, and is
hashed, too. A lone node is its tree's root as it is.

Defined cases: null fields and the null group have hashes of their own (a null is written
``-``); repeated keys are ordered by their leaf; equal rows are leaves of their own; an
empty table gives no rows; columns may have any name, as they are carried in one struct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmill.session import materialize

FAN = 16
#: Digits that one block nests: at most ``FAN ** DIGITS`` rows of hashes in memory.
DIGITS = 3
BLOCK = FAN**DIGITS
_PROOF = "array<struct<before: string, after: string>>"


def field(value: Column) -> Column:
    """A value with its length, so that no two lists of fields read alike."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def proof_digest(proof: Column) -> Column:
    """One hash for all siblings, lowest level first, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda p: F.concat(p["before"], p["after"])), ""), 256)


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(proof, leaf, lambda h, p: F.sha2(F.concat(p["before"], h, p["after"]), 256))


def _hashes(kids: Column) -> Column:
    return F.transform(kids, lambda k: k["hash"])


def _numbered(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """Adds ``rank`` (from 0) and ``n`` within ``grp``, by the order columns."""
    keys = ["grp", *order]
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys)
    placed = materialize(
        dealt.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place")), name
    )
    spans = placed.groupBy("grp", "part").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("here"))
    earlier = Window.partitionBy("grp").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select(
        "grp",
        "part",
        "first",
        F.coalesce(F.sum("here").over(earlier), F.lit(0)).alias("before"),
        F.sum("here").over(Window.partitionBy("grp")).alias("n"),
    )
    # One row per range and group: stored, so that it is broadcast only if small.
    numbered = placed.join(materialize(spans, f"{name}-spans"), ["grp", "part"])
    return numbered.withColumn("rank", F.col("place") - F.col("first") + F.col("before")).drop(
        "part", "place", "first", "before"
    )


def _blocks(nodes: DataFrame) -> DataFrame:
    """``(grp, block, n, hash, kids)`` of ``(grp, rank, n, hash, row)``: the digits of the
    rank are grouped away one by one. A level is there if its group has more than one node
    below it; else the only child's hash goes up as it is."""
    digits = [f"d{i}" for i in range(DIGITS)]
    placed = nodes.select(
        "grp",
        "n",
        F.floor(F.col("rank") / BLOCK).alias("block"),
        *[(F.floor(F.col("rank") / FAN**i) % FAN).cast("int").alias(d) for i, d in enumerate(digits)],
        "hash",
        "row",
    )
    # Every grouping below keeps this partitioning.
    rolled, below = placed.repartition("grp", "block"), "row"
    for i, digit in enumerate(digits):
        child = F.struct(F.col(digit).alias("digit"), F.col("hash"), F.col(below).alias("below"))
        rolled = rolled.groupBy("grp", "block", "n", *digits[i + 1 :]).agg(F.sort_array(F.collect_list(child)).alias("kids"))
        run = F.sha2(F.array_join(_hashes(F.col("kids")), ""), 256)
        rolled = rolled.withColumn("hash", F.when(F.col("n") > FAN**i, run).otherwise(F.col("kids")[0]["hash"]))
        below = "kids"
    return rolled


def _rollup(nodes: DataFrame, name: str) -> tuple[list[DataFrame], DataFrame]:
    """The stored blocks of each storey, and ``(grp, hash)`` of the roots."""
    storeys = []
    largest = nodes.agg(F.max("n")).first()[0] or 0
    while True:
        stored = materialize(_blocks(nodes), f"{name}-{len(storeys)}")
        storeys.append(stored)
        if largest <= BLOCK:
            return storeys, stored.select("grp", "hash")
        largest = -(-largest // BLOCK)
        nodes = stored.select(
            "grp",
            F.col("block").alias("rank"),
            F.ceil(F.col("n") / BLOCK).alias("n"),
            "hash",
            F.lit(None).cast("string").alias("row"),
        )


def _handed_down(storeys: list[DataFrame], tops: DataFrame) -> DataFrame:
    """``(grp, rank, row, known, proof)`` of the lowest storey's nodes. ``tops`` has ``(grp,
    known, proof)``: what is known of a group, and the siblings of its root."""
    above = tops.withColumn("rank", F.lit(0).cast("bigint"))
    for blocks in reversed(storeys):
        told = above.select("grp", F.col("rank").alias("block"), "known", "proof")
        both = blocks.select("grp", "block", "n", "kids").unionByName(told, allowMissingColumns=True)
        met = both.groupBy("grp", "block").agg(
            *[F.first(c, ignorenulls=True).alias(c) for c in ("n", "kids", "known", "proof")]
        )
        above = met.withColumn("rank", F.col("block"))
        for i in reversed(range(DIGITS)):
            above = above.withColumn("run", _hashes(F.col("kids")))
            above = above.select("grp", "n", "known", "proof", "rank", "run", F.posexplode("kids").alias("at", "kid"))
            sibling = F.struct(
                F.array_join(F.slice("run", F.lit(1), F.col("at")), "").alias("before"),
                F.array_join(F.slice("run", F.col("at") + 2, F.lit(FAN)), "").alias("after"),
            )
            above = above.select(
                "grp",
                "n",
                "known",
                (F.col("rank") * FAN + F.col("kid.digit")).alias("rank"),
                F.when(F.col("n") > FAN**i, F.concat(F.array(sibling), "proof")).otherwise(F.col("proof")).alias("proof"),
                F.col("kid.below").alias("kids" if i else "row"),
            )
    return above


def manifest(rows: DataFrame, group: Column, order: list[Column], leaf: Column) -> DataFrame:
    """The rows with ``leaf``, ``proof`` (siblings before and after, lowest level first),
    ``subroot`` of their group and ``root``: columns ``row`` (a struct of all columns of
    ``rows``), ``leaf``, ``subroot``, ``root``, ``proof``. Rows are ordered by the order
    columns and their leaf within a group, groups by their UTF-8 bytes, null first."""
    keys = [f"k{i}" for i in range(len(order))]
    leaves = materialize(
        rows.select(
            F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit("")).alias("grp"),
            *[c.alias(k) for c, k in zip(order, keys, strict=True)],
            leaf.alias("hash"),
            F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"),
            F.monotonically_increasing_id().alias("nth"),
        ),
        "merkle-leaves",
    )
    # The last key spreads equal rows; which of them comes first cannot be told apart.
    numbered = _numbered(leaves, [*keys, "hash", "nth"], "merkle-numbered")
    held = F.struct(F.col("hash").alias("leaf"), "row").alias("row")
    storeys, subroots = _rollup(numbered.select("grp", "rank", "n", "hash", held), "merkle")
    named = subroots.select(F.lit("").alias("grp"), F.col("grp").alias("name"), "hash")
    groups = _numbered(named, ["name"], "merkle-groups")
    held = F.struct(F.col("name"), F.col("hash").alias("subroot")).alias("row")
    upper, roots = _rollup(groups.select("grp", "rank", "n", "hash", held), "merkle-upper")
    top = roots.select("grp", F.col("hash").alias("known"), F.array().cast(_PROOF).alias("proof"))
    told = _handed_down(upper, top).select(
        F.col("row.name").alias("grp"), F.struct(F.col("row.subroot").alias("subroot"), F.col("known").alias("root")).alias("known"), "proof"
    )
    return _handed_down(storeys, told).select("row.row", "row.leaf", "known.subroot", "known.root", "proof")


def document_leaf(text: Column) -> Column:
    return leaf_hash(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text)


def manifest_report(docs: DataFrame) -> DataFrame:
    """Every document's leaf, roots and proof, and whether the proof holds: each fifth
    document (crc32 of its id as text, null ids never) is folded with its text's ASCII
    letters in lower case. Only hashes leave the scan, no texts."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    tampered = F.translate("text", upper, upper.lower())
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    hashed = docs.select(
        "doc_id",
        "source",
        document_leaf(F.col("text")).alias("leaf"),
        F.when(chosen, document_leaf(tampered)).alias("tampered"),
    )
    proven = manifest(hashed, F.col("source"), [F.col("doc_id")], F.col("leaf"))
    seen = folded(F.coalesce("row.tampered", "leaf"), F.col("proof"))
    return proven.select(
        "row.doc_id",
        "leaf",
        "subroot",
        "root",
        proof_digest(F.col("proof")).alias("proof_sha256"),
        seen.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
