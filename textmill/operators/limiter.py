"""Sliding-log rate limit per client over a table of requests.

A request is accepted while fewer than ``limit`` accepted requests of its client
are younger than the window; rejected requests leave no trace. Decisions depend on
earlier decisions, so this is no range window. It is not a fold over whole clients
either, as one client may own a third of the table:

* Time is cut into cells as wide as the window. If a cell and the one before it
  hold at most ``limit`` requests together, all requests in it are accepted,
  whatever came earlier. Ordinary traffic ends here: no shuffle, no Python.
* The other cells form stretches. Each starts where the state is known (nothing
  in the cell before, or a cell of the first kind, whose requests are the state),
  so a busy client breaks up into many independent stretches.
* A stretch is folded as a stream of sorted batches with ``limit`` stamps of
  memory; no group is ever collected.
* A client that stays over the limit for long has one long stretch, and there each
  decision does depend on the one before. Of requests at one microsecond only the
  first ``limit`` can be accepted, so the others leave before the fold. The rest is
  cut into slabs of about ``slab_rows`` requests, numbered without gaps in each
  stretch, one round each, which hand on ``limit`` stamps per stretch. The cut falls
  between bins of a 4,096th of the window, also inside a burst within one window.
  Busy requests are stored once, by slab, and each round reads its own.

Earlier accepted requests can be given as ``history`` (of a stream): they count, and are
not decided again.
"""

from __future__ import annotations

from bisect import insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmill import rules
from textmill.session import materialize, scratch_path

SLAB_ROWS = 50_000_000
#: Bins of a window at which a stretch can be cut.
BINS = 4096
_OUT = "client string, stretch bigint, request_id bigint, ts_us bigint, carried boolean, accepted boolean"


def micros(df: DataFrame, ts: str) -> Column:
    """Microseconds since the epoch; a time without zone is taken as UTC."""
    if dict(df.dtypes)[ts] == "timestamp_ntz":
        # Field by field: a cast would bring the session's time zone in.
        days, seconds = F.unix_date(F.col(ts).cast("date")), F.extract(F.lit("SECOND"), F.col(ts))
        minutes = (F.hour(ts) * 60 + F.minute(ts)).cast("bigint")
        return days * F.lit(86_400_000_000) + minutes * F.lit(60_000_000) + (seconds * 1_000_000).cast("bigint")
    return F.unix_micros(F.col(ts).cast("timestamp"))


def requests_of(df: DataFrame, client: str, ts: str, id_col: str) -> DataFrame:
    """``(client, request_id, ts_us)``; a null client is one of its own."""
    return df.select(
        F.coalesce(F.col(client).cast("string"), F.lit(rules.UNKNOWN)).alias("client"),
        F.col(id_col).cast("bigint").alias("request_id"),
        micros(df, ts).alias("ts_us"),
    )


def _busy_cells(requests: DataFrame, limit: int) -> DataFrame:
    """``(client, cell, stretch)`` of the cells that need the fold.

    The counts are one row per client and window of time, so even a client with
    a third of all requests has few of them.
    """
    counts = requests.groupBy("client", "cell").agg(F.count(F.lit(1)).alias("n"))
    by_time = Window.partitionBy("client").orderBy("cell")
    adjacent_before = F.lag("cell").over(by_time) == F.col("cell") - 1
    n_before = F.when(adjacent_before, F.lag("n").over(by_time)).otherwise(0)
    marked = counts.select(
        "client",
        "cell",
        (F.col("n") + n_before <= limit).alias("known"),
        F.coalesce(adjacent_before, F.lit(False)).alias("adjacent"),
    )
    leads_busy = (F.lead("cell").over(by_time) == F.col("cell") + 1) & ~F.lead("known").over(by_time)
    starts = F.when(F.col("known") | ~F.col("adjacent"), F.col("cell"))
    return (
        marked.withColumns({"stretch": F.max(starts).over(by_time), "seeds": F.coalesce(leads_busy, F.lit(False))})
        .where(~F.col("known") | F.col("seeds"))
        .select("client", "cell", "stretch")
    )


def _slabs(rows: DataFrame, slab_rows: int) -> DataFrame:
    """``(client, stretch, bin, slab)``, slabs numbered densely in each stretch. The work
    of one window is bounded by the bins of a stretch, not by its requests."""
    bins = rows.groupBy("client", "stretch", "bin").agg(F.count(F.lit(1)).alias("n"))
    by_time = Window.partitionBy("client", "stretch").orderBy("bin")
    before = F.sum("n").over(by_time) - F.col("n")
    cut = bins.withColumn("cut", F.floor(before / slab_rows))
    by_cut = Window.partitionBy("client", "stretch").orderBy("cut")
    return cut.select("client", "stretch", "bin", (F.dense_rank().over(by_cut) - 1).alias("slab"))


def decide(stamps: np.ndarray, log: list[int], limit: int, window_us: int) -> np.ndarray:
    """Decisions for one sorted run of stamps, jumping from accept to accept. ``log``
    holds the latest accepted stamps, ``limit`` at most, in order; a stamp may come
    before some of them."""
    accepted = np.zeros(len(stamps), dtype=bool)
    if limit == 0:
        return accepted
    at = 0
    while at < len(stamps):
        if len(log) == limit:
            at = max(at, int(np.searchsorted(stamps, log[0] + window_us, side="left")))
            if at >= len(stamps):
                break
        accepted[at] = True
        insort(log, int(stamps[at]))
        del log[:-limit]
        at += 1
    return accepted


def _fold(limit: int, window_us: int):
    """Rows come sorted by client and stretch. Carried ones are logged, not decided."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, log = None, []
        for batch in batches:
            if batch.num_rows == 0:
                continue
            client = batch.column("client")
            stretch = batch.column("stretch").to_numpy()
            stamps = batch.column("ts_us").to_numpy()
            carried = batch.column("carried").to_numpy(zero_copy_only=False)
            code = client.dictionary_encode().indices.to_numpy()
            changed = (np.diff(code) != 0) | (np.diff(stretch) != 0) | (np.diff(carried.astype(np.int8)) != 0)
            bounds = [0, *(np.flatnonzero(changed) + 1).tolist(), len(stamps)]
            accepted = np.ones(len(stamps), dtype=bool)
            for lo, hi in zip(bounds, bounds[1:]):
                key = (client[lo].as_py(), int(stretch[lo]))
                if key != current:
                    current, log = key, []
                if carried[lo]:
                    log = sorted([*log, *stamps[lo:hi].tolist()])[-limit:] if limit else []
                else:
                    accepted[lo:hi] = decide(stamps[lo:hi], log, limit, window_us)
            yield batch.append_column("accepted", pa.array(accepted))

    return run


_SHAPE = ("client", "stretch", "request_id", "ts_us", "carried")


def fold(rows: DataFrame, limit: int, window_us: int) -> DataFrame:
    """``rows`` (client, stretch, request_id, ts_us, carried) with ``accepted``."""
    return (
        rows.select(*_SHAPE)
        .repartition("client", "stretch")
        .sortWithinPartitions("client", "stretch", F.desc("carried"), "ts_us", "request_id")
        .mapInArrow(_fold(limit, window_us), _OUT)
    )


def latest_accepted(decided: DataFrame, keys: list[str], limit: int) -> DataFrame:
    """The last ``limit`` accepted requests of every key."""
    latest = Window.partitionBy(*keys).orderBy(F.desc("ts_us"), F.desc("request_id"))
    ranked = decided.where("accepted").withColumn("recency", F.row_number().over(latest))
    return ranked.where(F.col("recency") <= limit).drop("recency")


def rate_limit(
    df: DataFrame,
    client: str = "client",
    ts: str = "ts",
    id_col: str = "request_id",
    limit: int = rules.RATE_LIMIT,
    window_seconds: int = rules.RATE_WINDOW_SECONDS,
    slab_rows: int = SLAB_ROWS,
    history: DataFrame | None = None,
) -> DataFrame:
    """``(client, request_id, ts, accepted)`` for every request. ``history`` has
    ``(client, request_id, ts_us)`` of earlier accepted requests, none later than any of
    its client's requests in ``df``."""
    window_us = window_seconds * 1_000_000
    requests = requests_of(df, client, ts, id_col).withColumn("carried", F.lit(False))
    if history is not None:
        earlier = history.select("client", "request_id", "ts_us", F.lit(True).alias("carried"))
        requests = requests.unionByName(earlier)
    width = max(1, window_us // BINS)
    requests = requests.withColumns(
        {
            "cell": F.floor((F.col("ts_us") - F.pmod("ts_us", F.lit(window_us))) / window_us),
            "bin": F.floor((F.col("ts_us") - F.pmod("ts_us", F.lit(width))) / width),
        }
    )
    # Stored, so the optimizer knows its size and broadcasts it only if small.
    busy = materialize(_busy_cells(requests, limit), "busy-cells")
    at_cell, ids = ["client", "cell"], ["client", "request_id"]
    free = requests.join(busy, at_cell, "left_anti").where("not carried")
    result = free.select("client", "request_id", "ts_us", F.lit(True).alias("accepted"))
    crowded = requests.join(busy, at_cell)
    at_once = Window.partitionBy("client", "ts_us").orderBy(F.desc("carried"), "request_id")
    kept = crowded.withColumn("place", F.row_number().over(at_once)).where(F.col("place") <= max(limit, 1))
    kept = materialize(kept.select(*_SHAPE, "bin"), "busy-requests")
    slabs = _slabs(kept, slab_rows)
    by_slab = scratch_path(df.sparkSession, "slabs")
    kept.join(slabs, ["client", "stretch", "bin"]).select(*_SHAPE, "slab").write.partitionBy("slab").parquet(by_slab)
    stored = df.sparkSession.read.schema(", ".join([*_OUT.split(", ")[:5], "slab int"])).parquet(by_slab)
    last_slab = stored.agg(F.max("slab")).first()[0]
    taken, decided = None, None
    for slab in range(0 if last_slab is None else last_slab + 1):
        rows = stored.where(F.col("slab") == slab).select(*_SHAPE)
        if decided is not None:
            # Stretches that end earlier hand on nothing; numbers have no gaps.
            going_on = rows.select("client", "stretch").distinct()
            handed = latest_accepted(decided, ["client", "stretch"], limit).withColumn("carried", F.lit(True))
            rows = rows.unionByName(handed.select(*_SHAPE).join(going_on, ["client", "stretch"], "left_semi"))
        decided = materialize(fold(rows, limit, window_us), "slab")
        own = decided.where("accepted and not carried").select(*ids)
        taken = own if taken is None else taken.unionByName(own)
    if taken is not None:
        # What left before the fold is rejected like what the fold rejects.
        judged = crowded.where("not carried").select("client", "request_id", "ts_us")
        judged = judged.join(taken.withColumn("accepted", F.lit(True)), ids, "left")
        result = result.unionByName(judged.withColumn("accepted", F.coalesce("accepted", F.lit(False))))
    return result.select("client", "request_id", F.timestamp_micros("ts_us").alias("ts"), "accepted")
