"""Request validation, request outcome, latency and moderated exchanges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textmill import rules
from textmill.functions.guards import check_input, check_output, refuse_unless, response_tokens
from textmill.functions.text import strip_prompt
from textmill.operators.limiter import rate_limit
from textmill.session import materialize

#: Turn numbers within which a conversation's turns are put in order by one task.
TURN_RANGE = 1024

# Texts accepted as a boolean, besides true and false themselves (fixed values).
_TRUE = ("1", "true", "t", "yes", "y", "on")
_FALSE = ("0", "false", "f", "no", "n", "off")


def parse_request(body: Column) -> Column:
    """A JSON body as a struct of request fields with defaults, plus ``errors``:
    the names of the fields that are missing, of the wrong type or out of bounds.
    Such a field is null, but for a text of a wrong length."""
    # Each step reads the one before as a variable: what a body holds is looked up once.
    parsed = F.transform(F.array(F.try_parse_json(body)), _fields)
    return F.element_at(F.transform(F.transform(parsed, _tested), _request_struct), 1)


def _fields(v: Column) -> Column:
    """What is given in a body, each value once."""

    def got(name: str, kind: str) -> Column:
        return F.try_variant_get(v, f"$.{name}", kind)

    return F.struct(
        (F.schema_of_variant(got("prompt", "variant")) == "STRING").alias("is_text"),
        got("prompt", "string").alias("prompt"),
        *[got(name, "variant").isNotNull().alias(f"{name}_given") for name in ("max_tokens", "temperature", "safe_mode")],
        *[got(name, "double").alias(name) for name in ("max_tokens", "temperature")],
        F.lower(got("safe_mode", "string")).alias("flag"),
    )


def _tested(v: Column) -> Column:
    """The same with the verdict on each value; null where there is none."""
    tokens, flag = v["max_tokens"], v["flag"]
    return F.struct(
        *[v[name].alias(name) for name in ("is_text", "prompt", "max_tokens_given", "temperature_given", "safe_mode_given")],
        *[v[name].alias(name) for name in ("max_tokens", "temperature")],
        (v["is_text"] & F.length(v["prompt"]).between(1, rules.MAX_PROMPT_CHARS)).alias("prompt_ok"),
        ((tokens == F.floor(tokens)) & tokens.between(1, rules.MAX_NEW_TOKENS)).alias("tokens_ok"),
        v["temperature"].between(0.0, rules.MAX_TEMPERATURE).alias("temperature_ok"),
        F.when(flag.isin(*_TRUE), True).when(flag.isin(*_FALSE), False).alias("safe"),
    )


def _request_struct(v: Column) -> Column:
    def given(name: str) -> Column:
        return v[f"{name}_given"]

    prompt, is_text, prompt_ok = v["prompt"], v["is_text"], F.coalesce(v["prompt_ok"], F.lit(False))
    tokens, tokens_ok, temperature, temperature_ok = (v[n] for n in ("max_tokens", "tokens_ok", "temperature", "temperature_ok"))
    safe = v["safe"]

    def ok(name: str, check: Column) -> Column:
        return ~given(name) | F.coalesce(check, F.lit(False))

    checks = {
        "prompt": prompt_ok,
        "max_tokens": ok("max_tokens", tokens_ok),
        "temperature": ok("temperature", temperature_ok),
        "safe_mode": ok("safe_mode", safe.isNotNull()),
    }
    errors = F.array(*[F.when(~check, F.lit(name)) for name, check in checks.items()])
    return F.struct(
        F.when(is_text, prompt).alias("prompt"),
        F.when(~given("max_tokens"), rules.DEFAULT_NEW_TOKENS).when(tokens_ok, tokens.cast("int")).alias("max_tokens"),
        F.when(~given("temperature"), rules.DEFAULT_TEMPERATURE).when(temperature_ok, temperature).alias("temperature"),
        F.when(~given("safe_mode"), rules.DEFAULT_SAFE_MODE).otherwise(safe).alias("safe_mode"),
        F.filter(errors, lambda e: e.isNotNull()).alias("errors"),
    )


def is_valid(request: Column) -> Column:
    return F.size(request["errors"]) == 0


def request_status(
    df: DataFrame, limit: int = rules.RATE_LIMIT, window_seconds: int = rules.RATE_WINDOW_SECONDS
) -> DataFrame:
    """``(request_id, status)`` of ``(request_id, client, ts, value, model_loaded)``
    rows: 422 before 429 before 503 before 200. An invalid request uses no quota,
    one that meets no model does."""
    judged = materialize(
        df.select("request_id", "client", "ts", "model_loaded", is_valid(parse_request(F.col("value"))).alias("valid")),
        "judged-requests",  # the limiter reads its input three times: parse bodies once
    )
    decisions = rate_limit(judged.where("valid"), limit=limit, window_seconds=window_seconds)
    status = (
        F.when(~F.col("valid"), 422)
        .when(~F.col("accepted"), 429)
        .when(~F.col("model_loaded"), 503)
        .otherwise(200)
    )
    return judged.join(decisions.select("request_id", "accepted"), "request_id", "left").select(
        "request_id", status.alias("status")
    )


def latency_ms(start: Column, end: Column) -> Column:
    return F.round((F.unix_micros(end) - F.unix_micros(start)) / 1000, 2)


def exchanges(conversations: DataFrame) -> DataFrame:
    """Every user turn with the assistant turn that comes next, whatever its number.

    Turns follow each other within ranges of ``TURN_RANGE`` numbers, so a huge
    conversation spreads out; the last turn of a range is followed by the first one of
    the next range that has any.
    """
    turns = conversations.select(
        "conv_id", "turn", "role", "text", F.floor(F.col("turn") / TURN_RANGE).alias("range")
    )
    said = F.struct("role", "text")
    within = Window.partitionBy("conv_id", "range").orderBy("turn")
    firsts = turns.groupBy("conv_id", "range").agg(F.min_by(said, "turn").alias("first"))
    after = firsts.select(
        "conv_id", "range", F.lead("first").over(Window.partitionBy("conv_id").orderBy("range")).alias("beyond")
    )
    followed = turns.withColumn("following", F.lead(said).over(within)).where("role = 'user'")
    next_said = F.coalesce("following", "beyond")
    answer = F.when(next_said["role"] == "assistant", next_said["text"])
    return followed.join(after, ["conv_id", "range"], "left").select(
        "conv_id", "turn", F.col("text").alias("prompt"), F.coalesce(answer, F.lit("")).alias("generated")
    )


def moderate(pairs: DataFrame, safe_mode: Column | None = None) -> DataFrame:
    """Add the verdicts on prompt and answer and the text finally returned.

    ``pairs`` has ``prompt`` and ``generated``; all of this is row-local.
    """
    prompt = F.col("prompt")
    safe = F.lit(True) if safe_mode is None else safe_mode
    answered = pairs.withColumns(
        {
            "safe_mode": safe,
            "input_check": check_input(prompt, safe_mode),
            "answer": strip_prompt(F.col("generated"), prompt),
        }
    )
    checked = answered.withColumn("output_check", check_output(F.col("answer"), safe_mode))
    allowed_in, allowed_out = F.col("input_check.allowed"), F.col("output_check.allowed")
    final = checked.withColumn("generated_text", refuse_unless(allowed_in & allowed_out, F.col("answer")))
    return final.withColumns(
        {
            "token_count": response_tokens(allowed_in, F.col("generated_text")),
            # The output check never runs on an answer to a refused prompt.
            "event": F.when(~allowed_in, "input_blocked").when(~allowed_out, "output_blocked").otherwise("generate_request"),
            "reason": F.when(~allowed_in, F.col("input_check.reason")).otherwise(F.col("output_check.reason")),
            "category": F.when(~allowed_in, F.col("input_check.category")).otherwise(F.col("output_check.category")),
        }
    ).drop("answer")


def attach_manifest(df: DataFrame, manifests: DataFrame) -> DataFrame:
    """Add ``dataset_hash`` of the one-row manifest, ``unknown`` if there is none."""
    return df.withColumn(
        "dataset_hash", F.coalesce(manifests.select("dataset_hash").scalar(), F.lit(rules.UNKNOWN))
    )


def respond(
    served: DataFrame,
    manifests: DataFrame,
    model_version: str,
    limit: int = rules.RATE_LIMIT,
    window_seconds: int = rules.RATE_WINDOW_SECONDS,
) -> DataFrame:
    """What each of the ``(request_id, client, ts, done, value, model_loaded, generated)``
    rows is answered: ``status``, and for a 200 the whole response row and the verdicts;
    for other statuses the columns of the response are null. ``request_id`` is unique."""
    status = request_status(served, limit, window_seconds)
    parsed = served.join(status, "request_id").withColumn("request", parse_request(F.col("value")))
    return response_rows(parsed, manifests, model_version)


def response_rows(parsed: DataFrame, manifests: DataFrame, model_version: str) -> DataFrame:
    """The same for ``(request_id, client, ts, done, request, generated, status)`` rows, batch
    or stream; all of it is row-local."""
    rows = moderate(parsed.withColumn("prompt", F.col("request.prompt")), F.col("request.safe_mode"))
    rows = attach_manifest(rows, manifests)
    response = {
        "generated_text": F.col("generated_text"),
        "prompt": F.col("prompt"),
        "model_version": F.lit(model_version),
        "dataset_hash": F.col("dataset_hash"),
        "token_count": F.col("token_count").cast("bigint"),
        "latency_ms": latency_ms(F.col("ts"), F.col("done")),
        "safe_mode": F.col("safe_mode"),
        "input_check": F.col("input_check"),
        "output_check": F.col("output_check"),
    }
    return rows.select(
        "request_id",
        F.coalesce(F.col("client").cast("string"), F.lit(rules.UNKNOWN)).alias("client"),
        "status",
        *[F.when(F.col("status") == 200, value).alias(name) for name, value in response.items()],
    )


def log_events(responses: DataFrame) -> DataFrame:
    """The log lines of ``respond``'s rows: a request over the limit, a refused prompt, a
    refused answer (without its client) and, also for that, the generation itself."""

    def line(event: str, *columns: str, check: str | None = None) -> Column:
        fields = [F.lit(event).alias("event")]
        for name in ("client", "token_count", "latency_ms", "model_version", "dataset_hash", "safe_mode"):
            value = F.col(name)
            fields.append((value if name in columns else F.lit(None).cast(responses.schema[name].dataType)).alias(name))
        for name in ("reason", "category"):
            value = F.col(f"{check}.{name}") if check and name in columns else F.lit(None).cast("string")
            fields.append(value.alias(name))
        return F.struct(*fields)

    ok = F.col("status") == 200
    asked, answered = F.col("input_check.allowed"), F.col("output_check.allowed")
    lines = F.array(
        F.when(F.col("status") == 429, line("rate_limited", "client")),
        F.when(ok & ~asked, line("input_blocked", "client", "reason", "category", check="input_check")),
        F.when(ok & asked & ~answered, line("output_blocked", "reason", check="output_check")),
        F.when(
            ok & asked,
            line("generate_request", "client", "token_count", "latency_ms", "model_version", "dataset_hash", "safe_mode"),
        ),
    )
    return responses.select("request_id", F.inline(F.array_compact(lines)))
