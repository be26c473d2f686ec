"""The sliding-log rate limit on a stream, with the clients' logs as keyed state.

A client's log is a state value of its own (``limit`` accepted stamps at most) in the
state store: a micro-batch reads and writes the logs of its own clients only, however many
others there are, and the store's change log and snapshots are Spark's. Every request gets a
decision: rows of different micro-batches are judged in arrival order, rows of one in time
order, so results equal the batch operator's when the input arrives in time order. A row that
is earlier than its client's log is judged by what the log holds: accepted requests less than
a window older than it and any later ones count.

Without a ``lateness`` logs are kept for good. With one, so that no request is further behind
the newest of all, it is the stream's watermark, and each log has a timer of its own that
lets it go once the watermark is a window past its newest stamp, when nothing can count it any
more. Requests behind the watermark break that promise and are dropped by Spark.

A client costs one read and at most one write of its log in a micro-batch, and no data frame:
its decisions leave as arrays, ``PACKED`` of them a row, that Spark unpacks.

Memory of a task: the stamps and ids of one client in one micro-batch (16 bytes a request, and
again for its decisions), whose size the source's own options bound.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from textmill import rules
from textmill.operators.limiter import decide, requests_of

DECISIONS = "client string, request_id bigint, ts timestamp, accepted boolean"
PACKED = 8192  # decisions in a row, at most
_PACKED = "client string, request_id array<bigint>, ts_us array<bigint>, accepted array<boolean>"
_Packed = Row("client", "request_id", "ts_us", "accepted")
_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class ClientLog(StatefulProcessor):
    """Decides one client's requests and keeps its accepted stamps."""

    def __init__(self, limit: int, window_us: int, expires: bool):
        self.limit, self.window_us, self.expires = limit, window_us, expires

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.log = handle, handle.getValueState("log", "stamps array<bigint>")

    def _stamps(self) -> list[int]:
        value = self.log.get()
        return sorted(value[0]) if value else []

    def _expiry_ms(self, stamps: list[int]) -> int:
        return -(-(stamps[-1] + self.window_us) // 1000)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        taken, numbers = array("q"), array("q")
        for row in rows:
            taken.append(row.ts_us)
            numbers.append(row.request_id)
        stamps, ids = (np.frombuffer(column, dtype=np.int64) for column in (taken, numbers))
        order = np.lexsort((ids, stamps))
        stamps, ids = stamps[order], ids[order]
        log = self._stamps()
        known = bool(log)
        accepted = decide(stamps, log, self.limit, self.window_us)
        if accepted.any():
            self.log.update(([int(stamp) for stamp in log],))
            if self.expires and not known:
                self.handle.registerTimer(self._expiry_ms(log))
        for at in range(0, len(ids), PACKED):
            part = slice(at, at + PACKED)
            yield _Packed(key[0], ids[part], stamps[part], accepted[part])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        log = self._stamps()
        if log and self._expiry_ms(log) > expiredTimerInfo.getExpiryTimeInMs():
            self.handle.registerTimer(self._expiry_ms(log))  # the client came back in between
        else:
            self.log.clear()
        return iter(())

    def close(self) -> None:
        pass


def judged_stream(
    stream: DataFrame,
    client: str = "client",
    ts: str = "ts",
    id_col: str = "request_id",
    limit: int = rules.RATE_LIMIT,
    window_seconds: int = rules.RATE_WINDOW_SECONDS,
    lateness_seconds: int | None = None,
) -> DataFrame:
    """The stream of decisions, ``DECISIONS``. Runs on a RocksDB state store."""
    requests = requests_of(stream, client, ts, id_col)
    if lateness_seconds is not None:
        requests = requests.withColumn("at", F.timestamp_micros("ts_us")).withWatermark("at", f"{lateness_seconds} seconds")
    judged = requests.groupBy("client").transformWithState(
        statefulProcessor=ClientLog(limit, window_seconds * 1_000_000, lateness_seconds is not None),
        outputStructType=_PACKED,
        outputMode="Append",
        timeMode="None" if lateness_seconds is None else "EventTime",
    )
    each = judged.select("client", F.inline(F.arrays_zip("request_id", "ts_us", "accepted")))
    return each.select("client", "request_id", F.timestamp_micros("ts_us").alias("ts"), "accepted")


def rate_limit_stream(stream: DataFrame, output: str, progress: str, trigger: dict | None = None, **options) -> StreamingQuery:
    """Starts the query. Decisions are appended to ``output`` (Parquet; read with
    ``DECISIONS``), state and progress go to ``progress``. ``options`` are those of
    ``judged_stream``, ``trigger`` those of ``DataStreamWriter.trigger``."""
    conf = stream.sparkSession.conf
    before = conf.get(_STORE)
    conf.set(_STORE, _ROCKSDB)  # a query keeps the store it was started with
    try:
        writer = judged_stream(stream, **options).writeStream.format("parquet").option("path", output)
        writer = writer.option("checkpointLocation", progress).outputMode("append")
        return writer.trigger(**trigger).start() if trigger else writer.start()
    finally:
        conf.set(_STORE, before)
