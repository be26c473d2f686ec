"""Guard rules on a stream of requests: stateless, so the batch columns apply."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from textmill import rules
from textmill.functions.guards import check_input
from textmill.operators.requests import is_valid, parse_request
from textmill.sources.decisions import decision_rows


def screen_requests(stream: DataFrame) -> DataFrame:
    """Parse and screen ``(request_id, client, value)`` rows, batch or stream."""
    parsed = stream.withColumn("request", parse_request(F.col("value")))
    verdict = check_input(F.col("request.prompt"), F.col("request.safe_mode"))
    screened = parsed.withColumn("verdict", F.when(is_valid(F.col("request")), verdict))
    event = (
        F.when(F.col("verdict").isNull(), "invalid")
        .when(F.col("verdict.allowed"), "admitted")
        .otherwise("input_blocked")
    )
    return screened.select(
        "request_id",
        F.coalesce(F.col("client").cast("string"), F.lit(rules.UNKNOWN)).alias("client"),
        event.alias("event"),
        F.coalesce("verdict.reason", F.array_join("request.errors", ",")).alias("reason"),
        F.coalesce("verdict.category", F.lit("validation")).alias("category"),
        F.col("request.safe_mode").alias("safe_mode"),
    )


def log_decisions(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append the decisions on all available input to a JSON log."""
    return (
        decision_rows(stream)
        .writeStream.format("json")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
