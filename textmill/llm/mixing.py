"""Mixing sources to target weights by entropy balancing, in DataFrame operations only.

Targets: sources in code point order take the given weights in turn and share the total
size; a source stops at ``cap`` times its size, and what is over goes to the others by
weight. That division has a closed form over the sources sorted by cap per weight.

Rates: of all document rates between 0 and ``cap`` that meet the targets, those closest
to 1 in relative entropy are exponentially tilted: ``min(cap, exp(lambda * size / mean))``
with one ``lambda`` per source. Newton's method solves the convex dual for all sources at
once; a step that leaves the bracket, and every step after ``NEWTON_ROUNDS``, halves it, so
rounds end when the target is met or no multiplier lies inside the bracket. Each round is one
aggregation with map-side combine over a table of (source, size, documents), which is stored
once; the multipliers are stored after each round, so a lost executor repeats one round at
most.

Copies: rates are rounded over each source's sizes from large to small by cumulative
sums, which leaves less than half the largest size; that rest is taken from, or given to,
the smallest documents. Copies of a size are dealt to its documents by a hash of the id;
equal sizes are ranked in hashed parts, so a source or a size that holds most rows is
spread.

Defined cases: a null text has size 0; documents of size 0 are taken as 0 words; a source
of size 0 has target 0; null is a source, the last; repeated rows are documents of their
own; other columns than ``doc_id``, ``text`` and ``source`` are ignored; an empty table
gives an empty result. The work of one window is a source's distinct sizes, or the table
of sources.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import count

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textmill.llm.common import WORD
from textmill.session import materialize

WEIGHTS = (5.0, 2.0, 1.0)
CAP = 3
#: Newton rounds end when every source is this close to its target, relatively.
TOLERANCE = 1e-6
#: After these rounds brackets are halved.
NEWTON_ROUNDS = 60
#: Hashed parts in which documents of one source and size are ranked.
PARTS = 256


def document_sizes(docs: DataFrame) -> DataFrame:
    """``(doc_id, source, key, size)``: words of each text; equal rows have equal keys."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select("doc_id", "source", F.xxhash64("doc_id", "source", "text").alias("key"), size.alias("size"))


def source_targets(cells: DataFrame, weights: Sequence[float] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``(source, place, source_size, target, mean)`` from ``(source, size, n)``. One row
    per source is all that is ranked in one task."""
    sources = cells.groupBy("source").agg(
        F.sum(F.col("size") * F.col("n")).alias("source_size"),
        F.coalesce(F.sum(F.when(F.col("size") > 0, F.col("n"))), F.lit(0)).alias("n"),
    )
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights)).cast("int"))
    limit = F.col("source_size") * F.lit(float(cap))
    ranked = (
        sources.withColumn("place", F.row_number().over(by_name) - 1)
        .withColumn("weight", weight)
        .withColumn("limit", limit)
        .withColumn("full_at", F.col("limit") / F.col("weight"))
    )
    order = Window.orderBy("full_at", "place")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # If exactly the sources before this one are full, the others get this per weight.
    share = (F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum(
        "weight"
    ).over(after)
    levels = ranked.withColumn("share", share)
    level = F.min(F.when(F.col("share") <= F.col("full_at"), F.struct("full_at", "place", "share"))).over(everything)
    return levels.select(
        "source",
        "place",
        "source_size",
        F.least("limit", F.col("weight") * F.coalesce(level["share"], F.lit(float("inf")))).alias("target"),
        F.greatest(F.col("source_size") / F.greatest("n", F.lit(1)), F.lit(1e-9)).alias("mean"),
    )


def _rate(cap: int):
    """The tilted rate of a size; the exponent stays below ln(cap), so nothing overflows."""
    return F.when(F.col("full"), F.lit(float(cap))).otherwise(
        F.exp(F.least(F.col("lam") * F.col("size") / F.col("mean"), F.log(F.lit(float(cap)))))
    )


def multipliers(cells: DataFrame, sources: DataFrame, cap: int = CAP) -> DataFrame:
    """``sources`` with ``lam``, and ``full`` where every document is taken ``cap`` times.
    ``cells`` is ``(place, size, n)``, stored."""
    state = sources.select(
        "*",
        (F.col("target") >= F.col("source_size") * cap * (1 - 1e-12)).alias("full"),
        F.lit(0.0).alias("lam"),
        F.lit(-1e9).alias("low"),
        F.lit(1e9).alias("high"),
        F.lit(float("inf")).alias("off"),
    )
    state = materialize(state, "mixing-state")
    columns = state.columns
    for number in count():
        rate, words = _rate(cap), F.col("size") * F.col("n")
        slope = F.when(rate < cap * (1 - 1e-15), words * rate * F.col("size") / F.col("mean")).otherwise(0.0)
        sums = (
            cells.join(state.select("place", "lam", "full", "mean"), "place")
            .groupBy("place")
            .agg(F.sum(words * rate).alias("taken"), F.sum(slope).alias("slope"))
        )
        over = F.coalesce("taken", F.lit(0.0)) - F.col("target")
        low = F.when(over < 0, F.col("lam")).otherwise(F.col("low"))
        high = F.when(over > 0, F.col("lam")).otherwise(F.col("high"))
        # A Newton step, no longer than twice the distance so far, inside the bracket.
        far = 2 * (1 + F.abs("lam"))
        step = F.when(F.col("slope") > 0, -over / F.col("slope")).otherwise(F.when(over > 0, -far).otherwise(far))
        aim = F.col("lam") + F.greatest(F.least(step, far), -far)
        middle = (low + high) / 2
        aim = F.when((aim > low) & (aim < high) & F.lit(number < NEWTON_ROUNDS), aim).otherwise(middle)
        off = F.abs(over) / F.greatest("target", F.lit(1e-9))
        # Nothing lies between two neighbouring numbers.
        done = F.col("full") | (off <= TOLERANCE) | (middle <= low) | (middle >= high)
        moved = state.join(sums, "place", "left").select(
            *[c for c in columns if c not in ("lam", "low", "high", "off")],
            F.when(done, F.col("lam")).otherwise(aim).alias("lam"),
            F.when(done, F.col("low")).otherwise(low).alias("low"),
            F.when(done, F.col("high")).otherwise(high).alias("high"),
            F.when(done, 0.0).otherwise(off).alias("off"),
        )
        state = materialize(moved.select(*columns), "mixing-state")
        if (state.agg(F.max("off").alias("off")).first().off or 0.0) <= TOLERANCE:
            break
    return state


def cell_copies(cells: DataFrame, state: DataFrame, cap: int = CAP) -> DataFrame:
    """``(place, size, n, copies)``: whole copies of each source and size."""
    rates = cells.where("size > 0").join(state.drop("source_size", "source"), "place").withColumn("rate", _rate(cap))
    down = Window.partitionBy("place").orderBy(F.col("size").desc())
    up_to = F.sum(F.col("n") * F.col("rate")).over(down)
    rounded = rates.withColumn("upto", F.floor(up_to + 0.5)).withColumn(
        "copies", F.col("upto") - F.coalesce(F.lag("upto").over(down), F.lit(0))
    )
    source = Window.partitionBy("place")
    up = source.orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    rest = F.col("target") - F.sum(F.col("copies") * F.col("size")).over(source)
    room = F.when(F.col("rest") >= 0, F.col("n") * cap - F.col("copies")).otherwise(F.col("copies"))
    mended = (
        rounded.withColumn("rest", rest)
        .withColumn("room", room)
        .withColumn("before", F.coalesce(F.sum(F.col("room") * F.col("size")).over(up), F.lit(0)))
    )
    more = F.least("room", F.floor(F.greatest(F.abs("rest") - F.col("before"), F.lit(0.0)) / F.col("size")))
    return mended.select(
        "place", "size", "n", (F.col("copies") + F.signum("rest") * more).cast("long").alias("copies")
    )


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``(doc_id, key, size, source, source_size, target, copies)`` of every document."""
    sizes = materialize(document_sizes(docs), "mixing-sizes")
    counted = sizes.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))
    sources = materialize(source_targets(counted, weights, cap), "mixing-sources")
    place = sources.select(F.col("source").alias("of"), "place")
    cells = counted.join(place, F.col("source").eqNullSafe(F.col("of"))).select("place", "size", "n")
    cells = materialize(cells, "mixing-cells")
    copies = cell_copies(cells, multipliers(cells, sources, cap), cap)

    mark = F.xxhash64("doc_id", F.lit("mix"))
    named = sources.select(F.col("source").alias("of"), "place", "source_size", "target")
    rows = (
        sizes.join(named, F.col("source").eqNullSafe(F.col("of")))
        .drop("of")
        .withColumn("mark", mark)
        .withColumn("part", F.pmod("mark", F.lit(PARTS)).cast("int"))
    )
    parts = rows.groupBy("place", "size", "part").agg(F.count(F.lit(1)).alias("own"))
    ahead = Window.partitionBy("place", "size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    dealt = (
        parts.withColumn("ahead", F.coalesce(F.sum("own").over(ahead), F.lit(0)))
        .join(copies, ["place", "size"], "left")
        .select("place", "size", "part", "ahead", F.coalesce("copies", F.lit(0)).alias("all_copies"), "n")
    )
    within = Window.partitionBy("place", "size", "part").orderBy("mark", "doc_id", "key")
    rank = F.col("ahead") + F.row_number().over(within) - 1
    number = F.coalesce(
        F.floor(F.col("all_copies") / F.col("n")) + F.when(rank < F.col("all_copies") % F.col("n"), 1).otherwise(0),
        F.lit(0),
    )
    return rows.join(dealt, ["place", "size", "part"]).select(
        "doc_id", "key", "size", "source", "source_size", "target", number.cast("long").alias("copies")
    )


def mix_report(docs: DataFrame, weights: Sequence[float] = WEIGHTS, cap: int = CAP) -> DataFrame:
    mixed = mix(docs, weights, cap)
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return mixed.select("doc_id", "size", "source_size", "target", taken, "copies")


def mixed_documents(docs: DataFrame, weights: Sequence[float] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """The mix itself: every row as often as it is taken, rows of size 0 once. Equal rows
    are numbered so that each meets its own share."""
    moved = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])  # by place, so columns may have any names
    doc_id, source, text = (F.col(f"c{docs.columns.index(c)}") for c in ("doc_id", "source", "text"))
    shares = mix(docs.select("doc_id", "source", "text"), weights, cap).select(
        F.col("doc_id").alias("of"),
        F.col("key").alias("of_key"),
        F.when(F.col("size") == 0, F.lit(1)).otherwise(F.col("copies")).cast("int").alias("copies"),
    )
    shares = shares.withColumn("of_n", F.row_number().over(Window.partitionBy("of", "of_key").orderBy("copies")))
    rows = moved.withColumns({"id": doc_id, "key": F.xxhash64(doc_id, source, text)})
    rows = rows.withColumn("n", F.row_number().over(Window.partitionBy("id", "key").orderBy(F.lit(0))))
    met = F.col("id").eqNullSafe(F.col("of")) & (F.col("key") == F.col("of_key")) & (F.col("n") == F.col("of_n"))
    taken = rows.join(shares, met).where("copies > 0")
    every = taken.select(*moved.columns, F.explode(F.sequence(F.lit(1), "copies")).alias("copy"))
    return every.drop("copy").toDF(*docs.columns)
