"""The guarded exchange on streams: requests, the limiter's decisions on them, and answers.

Three streams meet in two stream-stream joins. A decision carries its request's time, an
answer follows its request within ``wait_seconds``; with a watermark on each stream, both
sides of a join keep a row only until nothing can match it any more, so state is bounded by
the traffic of the wait and of the lateness. What is joined goes through the same row-local
columns as a batch: verdicts on prompt and answer, the text finally returned, the response.

A request that is invalid, over the limit, or that met no model has no answer to wait for.
An answer that comes too late, or never, gives no response row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from textmill.functions.text import once
from textmill.operators.requests import is_valid, log_events, parse_request, response_rows
from textmill.sources.decisions import decision_rows


def valid_requests(requests: DataFrame) -> DataFrame:
    """Requests that the limiter counts."""
    return requests.where(is_valid(parse_request(F.col("value"))))


def response_stream(
    requests: DataFrame,
    decisions: DataFrame,
    answers: DataFrame,
    manifests: DataFrame,
    model_version: str,
    wait_seconds: int = 60,
    lateness_seconds: int = 600,
) -> DataFrame:
    """``respond``'s rows of status 200, as a stream. ``requests`` has ``(request_id, client,
    ts, value, model_loaded)``, ``decisions`` the limiter's ``(request_id, ts, accepted)``,
    ``answers`` ``(request_id, done, generated)``; ``request_id`` is unique in each."""
    late = f"{lateness_seconds} seconds"
    asked = requests.where("model_loaded").select("request_id", "client", "ts", once(parse_request(F.col("value"))).alias("request"))
    asked = asked.where(is_valid(F.col("request"))).withWatermark("ts", late)
    admitted = decisions.where("accepted").select(F.col("request_id").alias("admitted_id"), F.col("ts").alias("admitted_at"))
    said = answers.select(F.col("request_id").alias("answered_id"), "done", "generated").withWatermark("done", late)
    met = asked.join(
        admitted.withWatermark("admitted_at", late), F.expr("request_id = admitted_id AND ts = admitted_at")
    ).join(
        said, F.expr(f"request_id = answered_id AND done >= ts AND done <= ts + INTERVAL {wait_seconds} SECONDS")
    )
    return response_rows(met.withColumn("status", F.lit(200)), manifests, model_version)


def event_stream(responses: DataFrame, decisions: DataFrame) -> DataFrame:
    """The log lines of the responses and of the requests over the limit."""
    over = decisions.where("not accepted").select("request_id", "client", F.lit(429).alias("status"))
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in responses.schema if f.name not in over.columns]
    return log_events(responses.unionByName(over.select("*", *nothing)))


def append_events(events: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append the log lines of all available input to the decision log."""
    writer = decision_rows(events).writeStream.format("json").option("path", path).option("checkpointLocation", checkpoint)
    return writer.outputMode("append").trigger(availableNow=True).start()
