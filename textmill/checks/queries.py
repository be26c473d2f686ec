"""One query per operator; names start with the operator's id."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill import rules
from textmill.checks import inputs
from textmill.functions import guards, quality, text, tokens
from textmill.functions.porter import stem_tokens
from textmill.operators import cleaning, dedup, fingerprint, hashtree, limiter, ngram, noise, overlap, requests, rulebook, runlog, split
from textmill.plans.cleaning import clean_corpus
from textmill.plans.evaluation import evaluate
from textmill.session import materialize, scratch_path
from textmill.sources import corpus as files
from textmill.sources import decisions, ordered, runlogs
from textmill.streaming.exchange import append_events, event_stream, response_stream, valid_requests
from textmill.streaming.guard import log_decisions, screen_requests
from textmill.streaming.limiter import DECISIONS, rate_limit_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

LIMIT, DAY = 3, 24 * 3600  # a limit the events table runs into
FILE_BYTES = 64 << 20  # of pairs, dealt into files
PART_ROWS = 4_000_000  # requests, about, that the joins of the responses hold in state at once


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _register(name: str, source: Query, **columns: Callable[[Column], Column]) -> None:
    """Columns over the text of a source, next to its id."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = source(spark, sf_dir)
        return rows.select("doc_id", *[make(F.col("text")).alias(c) for c, make in columns.items()])

    QUERIES[name] = run


def _normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.corpus(spark, sf_dir)
    return rows.select("doc_id", text.once(text.normalize_text(F.col("text"))).alias("text"))


def _cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialize(cleaning.clean(inputs.corpus(spark, sf_dir)), "cleaned")


def _logged(log: DataFrame) -> DataFrame:
    safe_mode = F.coalesce(F.col("safe_mode").cast("string"), F.lit("")).alias("safe_mode")
    return log.select("request_id", "client", "event", "reason", "category", safe_mode)


# --- Sources and sinks --------------------------------------------------------
@query
def s01_jsonl_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "raw")
    files.write_jsonl(noise.inject_noise(inputs.documents(spark, sf_dir)), path)
    return files.read_jsonl(spark, path)


def _split_files(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "splits")
    files.write_splits(split.assign_splits(_cleaned(spark, sf_dir)), path)
    return path


@query
def s02_split_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.read_splits(spark, _split_files(spark, sf_dir), "train", "val")


@query
def s03_split_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.read_splits(spark, _split_files(spark, sf_dir))


@query
def s03_split_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every row in its split's files."""
    rows = ordered.read_ordered(spark, _split_files(spark, sf_dir), "doc_id bigint, split string")
    return rows.select("split", "doc_id", F.col("ordinal").alias("place"))


@query
def s03_splits_without_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job on JSON Lines that hold texts only."""
    raw, out = scratch_path(spark, "raw"), scratch_path(spark, "cleaned")
    files.write_jsonl(inputs.corpus(spark, sf_dir).select("text"), raw)
    clean_corpus(spark, raw, out)
    return files.read_splits(spark, f"{out}/splits").select("text", "split")


@query
def s04_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "manifest")
    files.write_row(cleaning.manifest(inputs.corpus(spark, sf_dir), "corpus"), path)
    return files.read_manifest(spark, path).select("*", "stats.*").drop("stats")


@query
def s05_manifest_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifests = cleaning.manifest(inputs.documents(spark, sf_dir), "documents")
    turns = inputs.table(spark, sf_dir, "conversations").select("conv_id", "turn")
    return requests.attach_manifest(turns, manifests)


def _evaluation(spark: SparkSession, sf_dir: str, cap: int | None) -> DataFrame:
    texts = inputs.documents(spark, sf_dir)
    said = inputs.predictions(overlap.eval_texts(texts))
    return evaluate(texts, said, ngram.token_losses(texts, texts), "bigrams", "documents", cap)


@query
def s06_eval_result_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "results")
    row = _evaluation(spark, sf_dir, None)
    files.write_row(row, path)
    return spark.read.schema(row.schema).json(path)


_COMMITS = "mapreduce.fileoutputcommitter.algorithm.version"


@query
def s07_run_log_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "runs")
    rows = inputs.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("run_id"), F.col("s_suppkey").alias("n"), F.col("s_acctbal").alias("v")
    )
    documents = inputs.run_documents(rows).select("document")
    # A file for each run; tasks put their own files in place, not the driver one by one.
    spread = documents.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    spread.write.option("maxRecordsPerFile", 1).option(_COMMITS, "2").text(path)
    runs = runlogs.read_run_logs(spark, path)
    return runs.select(
        "run_id",
        "seed",
        "train_loss",
        F.col("config.num_epochs").alias("num_epochs"),
        F.col("config.lora.r").alias("lora_r"),
        F.size("history").cast("bigint").alias("n_history"),
    )


@query
def s08_decision_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "decisions")
    decisions.append_decisions(screen_requests(inputs.requests(spark, sf_dir)), path)
    return _logged(decisions.read_decisions(spark, path))


def _responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifests = cleaning.manifest(inputs.documents(spark, sf_dir), "documents")
    return requests.respond(inputs.served(spark, sf_dir), manifests, "stand-in", LIMIT, DAY)


@query
def s08_served_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "decisions")
    decisions.append_decisions(requests.log_events(_responses(spark, sf_dir)), path)
    return _served_log(decisions.read_decisions(spark, path))


def _served_log(log: DataFrame) -> DataFrame:
    texts = ("client", "reason", "category", "model_version", "dataset_hash")
    return log.select(
        "request_id",
        "event",
        *[F.coalesce(c, F.lit("")).alias(c) for c in texts],
        F.coalesce(F.col("token_count").cast("bigint"), F.lit(-1)).alias("token_count"),
        F.coalesce("latency_ms", F.lit(-1.0)).alias("latency_ms"),
        F.coalesce(F.col("safe_mode").cast("string"), F.lit("")).alias("safe_mode"),
    )


# --- Text columns -------------------------------------------------------------
_register("f01_nfc", inputs.corpus, nfc_text=text.nfc)
_register(
    "f02_valid_utf8",
    inputs.documents,
    # A lone continuation byte is put in front of every text.
    repaired=lambda t: text.valid_utf8(F.concat(F.unhex(F.lit("80")), F.encode(t, "utf-8")).cast("string")),
)
_register("f03_strip_control", inputs.corpus, stripped=text.strip_control)
_register("f04_strip_space", inputs.corpus, trimmed=text.strip_space)
_register("f05_normalize", inputs.corpus, norm=text.normalize_text)
_register("f06_content_key", inputs.corpus, content_key=text.content_key)
_register("f07_lower", inputs.corpus, lowered=F.lower)
_register("f08_length", inputs.corpus, n_chars=lambda t: F.length(t).cast("bigint"))
_register("f09_prompt_slices", inputs.documents, prompt=text.prompt_part, reference=text.continuation_part)
_register("f12_words", inputs.corpus, words=lambda t: F.array_join(tokens.words(t), " "))
_register("f13_truncated_tokens", inputs.corpus, words=lambda t: F.array_join(tokens.truncate(tokens.words(t)), " "))


@query
def f10_strip_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.guarded_exchanges(spark, sf_dir)
    return rows.select("conv_id", "turn", text.strip_prompt(F.col("generated"), F.col("prompt")).alias("answer"))


@query
def f11_prompt_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.table(spark, sf_dir, "conversations")
    return rows.select("conv_id", "turn", guards.render_prompt(F.col("text")).alias("modified_prompt"))


@query
def f14_response_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = requests.moderate(inputs.guarded_exchanges(spark, sf_dir), F.col("safe_mode"))
    return rows.select("conv_id", "turn", F.col("token_count").cast("bigint").alias("token_count"))


# --- Quality rules ------------------------------------------------------------
_register("p01_html_tag", _normalized, hit=quality.has_html_tag)
_register("p02_html_entity", _normalized, hit=quality.has_html_entity)
_register("p03_html", _normalized, hit=quality.has_html)
_register("p04_pii_email", _normalized, hit=lambda t: quality.has_pii_kind(t, "email"))
_register("p05_pii_ssn", _normalized, hit=lambda t: quality.has_pii_kind(t, "ssn"))
_register("p06_pii_phone", _normalized, hit=lambda t: quality.has_pii_kind(t, "phone"))
_register("p07_pii_card", _normalized, hit=lambda t: quality.has_pii_kind(t, "card"))
_register("p08_pii_dob", _normalized, hit=lambda t: quality.has_pii_kind(t, "dob"))
_register("p09_pii_mrn", _normalized, hit=lambda t: quality.has_pii_kind(t, "mrn"))
_register("p10_pii_ssn_label", _normalized, hit=lambda t: quality.has_pii_kind(t, "ssn_label"))
_register(
    "p11_pii_kinds", _normalized, hit=quality.has_pii, kinds=lambda t: F.array_join(quality.pii_kinds(t), ",")
)
_register("p12_broken_unicode", _normalized, hit=quality.has_broken_unicode)
_register("p13_length_band", _normalized, hit=lambda t: ~quality.length_ok(t))
_register(
    "p14_boilerplate",
    _normalized,
    score=lambda t: quality.boilerplate_score(t).cast("bigint"),
    hit=quality.is_boilerplate,
)


@query
def p15_eval_eligible(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.documents(spark, sf_dir).where(quality.eval_eligible(F.col("text"))).select("doc_id")


@query
def p16_scorable(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = inputs.corpus(spark, sf_dir).select("doc_id", tokens.token_count(F.col("text")).cast("bigint").alias("n_tokens"))
    return counted.where(quality.scorable(F.col("n_tokens")))


# --- Cleaning -----------------------------------------------------------------
@query
def d01_drop_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.drop_duplicates(inputs.corpus(spark, sf_dir)).select("doc_id", "content_key", "text")


@query
def c01_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.classify(inputs.corpus(spark, sf_dir))


@query
def c02_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean(inputs.corpus(spark, sf_dir))


@query
def a01_cleaning_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.cleaning_stats(inputs.corpus(spark, sf_dir))


@query
def a02_cleaning_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.cleaning_report(cleaning.cleaning_stats(inputs.corpus(spark, sf_dir)))


@query
def a03_split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.split_counts(split.assign_splits(_cleaned(spark, sf_dir)))


@query
def a04_dataset_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.dataset_fingerprint(cleaning.clean(inputs.corpus(spark, sf_dir)))


def _versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The cleaned corpus, and a later version in which some texts were edited and some rows
    taken out or put under a new id."""
    cleaned = _cleaned(spark, sf_dir)
    n, t = F.col("doc_id"), F.col("text")
    edited = F.when(n % 97 == 3, F.concat(t, F.lit(" (edited)"))).otherwise(t)
    later = cleaned.where(n % 89 != 5).select(F.when(n % 101 == 7, -n).otherwise(n).alias("doc_id"), edited.alias("text"))
    return cleaned.select("doc_id", "text"), later


@query
def a04_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hashtree.hash_tree(_cleaned(spark, sf_dir))


def _changed_buckets(versions: tuple[DataFrame, DataFrame]) -> DataFrame:
    trees = [materialize(hashtree.hash_tree(version), "hash-tree") for version in versions]
    return hashtree.changed_buckets(*trees)


@query
def a04_changed_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _changed_buckets(_versions(spark, sf_dir))


@query
def a04_changed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = _versions(spark, sf_dir)
    return hashtree.changed_rows(*versions, materialize(_changed_buckets(versions), "changed-buckets"))


@query
def k01_seeded_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.seeded_order(cleaning.clean(inputs.corpus(spark, sf_dir)).select("doc_id"))


@query
def k02_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.assign_splits(_cleaned(spark, sf_dir)).select("doc_id", "split")


# --- Evaluation ---------------------------------------------------------------
@query
def e01_eval_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap.eval_texts(inputs.documents(spark, sf_dir), rules.EVAL_CAP)


@query
def e02_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    references = overlap.eval_texts(inputs.documents(spark, sf_dir))
    return overlap.pair_up(references, inputs.predictions(references))


@query
def e02_positional_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions and references in files without ids, dealt differently."""
    rows, sides = materialize(inputs.pairs(spark, sf_dir), "pairs"), {}
    # Also how many files there are grows with the texts, so no task writes more than a file.
    n_bytes = rows.agg(F.coalesce(F.sum(F.octet_length("reference") + F.octet_length("prediction")), F.lit(0))).first()[0]
    for name, least in (("reference", 3), ("prediction", 5)):
        path = scratch_path(spark, name)
        dealt = rows.repartitionByRange(least + n_bytes // FILE_BYTES, "doc_id").sortWithinPartitions("doc_id")
        files.write_jsonl(dealt.select(F.col(name).alias("text")), path)
        sides[name] = ordered.read_ordered(spark, path)
    return overlap.pair_by_position(sides["reference"], sides["prediction"])


@query
def e03_token_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap.token_f1(inputs.pairs(spark, sf_dir))


@query
def e04_mean_token_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap.mean_token_f1(overlap.token_f1(inputs.pairs(spark, sf_dir)))


@query
def e05_rouge1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap.rouge_n(inputs.pairs(spark, sf_dir), orders=(1,))


@query
def e06_rouge2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap.rouge_n(inputs.pairs(spark, sf_dir), orders=(2,))


@query
def e07_rouge_l(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap.rouge_l(inputs.pairs(spark, sf_dir))


@query
def e08_stems(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = tokens.rouge_words(F.col("text"), stem=False)
    vocabulary = inputs.corpus(spark, sf_dir).select(F.explode(F.array_distinct(found)).alias("token")).distinct()
    return vocabulary.select("token", F.element_at(stem_tokens(F.array("token")), 1).alias("stem"))


@query
def e09_corpus_rouge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap.corpus_rouge(overlap.score_pairs(inputs.pairs(spark, sf_dir)))


def _test_losses(spark: SparkSession, sf_dir: str, order: int) -> DataFrame:
    """The test split under the model of the train split."""
    parts = materialize(split.assign_splits(_cleaned(spark, sf_dir)), "splits")
    train, test = (parts.where(F.col("split") == name).select("doc_id", "text") for name in ("train", "test"))
    return ngram.token_losses(test, train, order)


@query
def e10_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap.perplexity(_test_losses(spark, sf_dir, 2)).select(F.round("perplexity", 6).alias("perplexity"))


@query
def e10_token_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loss per document, by words, pairs and triples of words."""
    losses = _test_losses(spark, sf_dir, 3)
    return losses.select(
        "doc_id", F.round(F.coalesce("loss", F.lit(-1.0)), 6).alias("loss"), F.col("n_tokens").cast("bigint").alias("n_tokens")
    )


@query
def e11_eval_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _evaluation(spark, sf_dir, None)


# --- Guardrails ---------------------------------------------------------------
def _flat(rows: DataFrame, verdict: Column) -> DataFrame:
    return rows.select("conv_id", "turn", verdict.alias("v")).select("conv_id", "turn", "v.*")


def _guard(name: str, column: str, **columns: Callable[[Column], Column]) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = inputs.guarded_exchanges(spark, sf_dir)
        return rows.select("conv_id", "turn", *[make(F.col(column)).alias(n) for n, make in columns.items()])

    QUERIES[name] = run


_PROMPT, _ANSWER, _SAFE = "prompt", "generated", "safe_mode"
_guard("g02_input_too_short", _PROMPT, hit=guards.too_short)
_guard("g03_input_too_long", _PROMPT, hit=guards.too_long)
_guard("g04_guard_category", _PROMPT, category=lambda p: F.coalesce(guards.matched_category(p), F.lit("")))
_guard("g06_empty_output", _ANSWER, hit=guards.empty_output)
_guard("g07_output_pii", _ANSWER, hit=guards.output_has_pii)


@query
def g01_request_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.requests(spark, sf_dir).select("request_id", requests.parse_request(F.col("value")).alias("r"))
    return rows.select(
        "request_id",
        "r.prompt",
        F.coalesce(F.col("r.max_tokens"), F.lit(-1)).cast("bigint").alias("max_tokens"),
        "r.temperature",
        F.coalesce(F.col("r.safe_mode").cast("string"), F.lit("")).alias("safe_mode"),
        F.array_join("r.errors", ",").alias("errors"),
    )


@query
def g05_check_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(inputs.guarded_exchanges(spark, sf_dir), guards.check_input(F.col(_PROMPT)))


@query
def g08_check_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(inputs.guarded_exchanges(spark, sf_dir), guards.check_output(F.col(_ANSWER)))


@query
def g09_safe_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.guarded_exchanges(spark, sf_dir)
    checked = rows.select(
        "conv_id",
        "turn",
        guards.check_input(F.col(_PROMPT), F.col(_SAFE)).alias("i"),
        guards.check_output(F.col(_ANSWER), F.col(_SAFE)).alias("o"),
    )
    return checked.select(
        "conv_id", "turn", F.col("i.category").alias("input_category"), F.col("o.category").alias("output_category")
    )


@query
def g10_refusal(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.guarded_exchanges(spark, sf_dir)
    checked = rows.withColumn("allowed", guards.check_output(F.col(_ANSWER))["allowed"])
    return checked.select("conv_id", "turn", guards.refuse_unless(F.col("allowed"), F.col(_ANSWER)).alias("final_text"))


@query
def g11_moderated_exchanges(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = requests.moderate(inputs.guarded_exchanges(spark, sf_dir), F.col("safe_mode"))
    return rows.select(
        "conv_id", "turn", "event", "reason", "category", "generated_text",
        F.col("token_count").cast("bigint").alias("token_count"),
    )


@query
def g11_response_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _responses(spark, sf_dir).where("status = 200").drop("input_check", "output_check", "status")


@query
def g12_request_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests.request_status(inputs.requests(spark, sf_dir), limit=LIMIT, window_seconds=DAY)


@query
def g13_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = inputs.table(spark, sf_dir, "events")
    start = F.timestamp_micros(limiter.micros(events, "ts"))
    end = F.timestamp_micros(limiter.micros(events, "ts") + F.floor(F.col("value") * 1000))
    return events.select("event_id", requests.latency_ms(start, end).alias("latency_ms"))


# --- Rate limit and streams ---------------------------------------------------
def _event_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.table(spark, sf_dir, "events").select(
        F.col("event_id").alias("request_id"), F.col("user_id").alias("client"), "ts"
    )


@query
def w01_rate_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    decided = limiter.rate_limit(_event_requests(spark, sf_dir), limit=LIMIT, window_seconds=DAY)
    return decided.select("request_id", "client", "accepted")


@query
def w02_rate_limit_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _event_requests(spark, sf_dir)
    rows = events.withColumn("ts", F.timestamp_micros(limiter.micros(events, "ts")))
    staged, source, sink, progress = (scratch_path(spark, n) for n in ("staged", "requests", "admitted", "progress"))
    # Quarters of the time span arrive one after the other.
    at = F.unix_micros("ts")
    ends = rows.agg(F.struct(F.min(at).alias("lo"), F.max(at).alias("hi"))).scalar()
    quarter = F.least(F.floor((at - ends["lo"]) * 4 / F.greatest(ends["hi"] - ends["lo"], F.lit(1))), F.lit(3))
    rows.withColumn("quarter", quarter.cast("int")).write.partitionBy("quarter").parquet(staged)
    parts = spark.read.schema("request_id bigint, client bigint, ts timestamp, quarter int").parquet(staged)
    for number in range(4):
        parts.where(F.col("quarter") == number).drop("quarter").write.mode("append").parquet(source)
        stream = spark.readStream.schema(rows.schema).parquet(source)
        rate_limit_stream(stream, sink, progress, {"availableNow": True}, limit=LIMIT, window_seconds=DAY).awaitTermination()
    return spark.read.schema(DECISIONS).parquet(sink).select("request_id", "client", "accepted")


@query
def w03_guard_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, sink, progress = (scratch_path(spark, n) for n in ("requests", "decisions", "progress"))
    rows = inputs.requests(spark, sf_dir).select("request_id", "client", "value")
    rows.write.parquet(source)
    stream = spark.readStream.schema(rows.schema).parquet(source)
    log_decisions(screen_requests(stream), sink, progress).awaitTermination()
    return _logged(decisions.read_decisions(spark, sink))


_ASKED = "request_id bigint, client string, ts timestamp, value string, model_loaded boolean"
_ANSWERED = "request_id bigint, done timestamp, generated string"


def _arrivals(rows: DataFrame) -> list[list[int | None]]:
    """The ends, in microseconds, of the parts in which requests arrive: two halves of the time
    span, each cut by time into parts of about ``PART_ROWS`` requests. The last end is open."""
    at = F.col("at")
    middle = rows.agg(F.expr("(min(at) + max(at)) div 2")).first()[0]
    halves = []
    for lo, hi in ((None, middle), (middle, None)):
        half = _arriving(rows, "at", lo, hi)
        n_parts = -(-half.count() // PART_ROWS)
        shares = [k / n_parts for k in range(1, n_parts)]
        cuts = half.agg(F.percentile_approx(at, shares)).first()[0] if shares else []
        halves.append([lo, *sorted({c for c in cuts if c != lo}), hi])
    return halves


def _arriving(rows: DataFrame, at: str, lo: int | None, hi: int | None) -> DataFrame:
    """Rows from ``lo`` on and before ``hi``; an end that is None is open."""
    rows = rows.where(F.col(at).isNotNull())
    rows = rows if lo is None else rows.where(F.col(at) >= lo)
    return rows if hi is None else rows.where(F.col(at) < hi)


def _exchange_streams(spark: SparkSession, sf_dir: str, logged: bool) -> str:
    """Requests arrive in two halves of the time span, and the limiter runs after each. Requests,
    decisions and answers of a half then arrive in parts of bounded size, in order of time, and
    the responses, or the log lines, run after each. Returns the folder of what they wrote."""
    root = scratch_path(spark, "exchange")
    # Times are kept as numbers too: files have statistics of those, so a part reads its own files.
    served = inputs.served(spark, sf_dir, spread=True)
    rows = materialize(served.withColumns({"at": F.unix_micros("ts"), "done_at": F.unix_micros("done")}), "served")
    files.write_row(cleaning.manifest(inputs.documents(spark, sf_dir), "documents"), f"{root}/manifest")
    known = files.read_manifest(spark, f"{root}/manifest")
    now = {"availableNow": True}

    def names(schema: str) -> list[str]:
        return [c.split(" ")[0] for c in schema.split(", ")]

    def arrive(name: str, part: DataFrame, schema: str) -> DataFrame:
        part.select(*names(schema)).write.mode("append").parquet(f"{root}/{name}")
        return spark.readStream.schema(schema).parquet(f"{root}/{name}")

    for ends in _arrivals(rows):
        received = arrive("received", _arriving(rows, "at", ends[0], ends[-1]), _ASKED)
        rate_limit_stream(
            valid_requests(received), f"{root}/limited", f"{root}/limiter", now, limit=LIMIT, window_seconds=DAY
        ).awaitTermination()
        limited = spark.read.schema(DECISIONS).parquet(f"{root}/limited").withColumn("at", F.unix_micros("ts"))
        if len(ends) > 2:  # else the one part reads all of them anyway
            by_time = limited.repartitionByRange(spark.sparkContext.defaultParallelism, "at", "request_id")
            limited = materialize(_arriving(by_time, "at", ends[0], ends[-1]), "limited")
        for lo, hi in zip(ends, ends[1:]):
            asked = arrive("asked", _arriving(rows, "at", lo, hi), _ASKED)
            judged = arrive("judged", _arriving(limited, "at", lo, hi), DECISIONS)
            answered = arrive("answered", _arriving(rows, "done_at", lo, hi), _ANSWERED)
            responses = response_stream(asked, judged, answered, known, "stand-in")
            if logged:
                append_events(event_stream(responses, judged), f"{root}/log", f"{root}/logging").awaitTermination()
                continue
            writer = responses.writeStream.format("parquet").option("checkpointLocation", f"{root}/progress")
            writer.option("path", f"{root}/responses").trigger(**now).start().awaitTermination()
    return root


@query
def g11_response_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{_exchange_streams(spark, sf_dir, False)}/responses"
    return spark.read.parquet(path).drop("input_check", "output_check", "status")


@query
def w03_served_log_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _served_log(decisions.read_decisions(spark, f"{_exchange_streams(spark, sf_dir, True)}/log"))


# --- Run logs -----------------------------------------------------------------
def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = inputs.table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("run_id"), F.col("event_id").alias("n"), F.col("value").alias("v")
    )
    parsed = inputs.run_documents(events).select(runlogs.parse_run_log(F.col("document")).alias("run")).select("run.*")
    return runlog.history_rows(parsed)


@query
def t01_run_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _history(spark, sf_dir).select(
        "run_id", "position", "kind", "epoch", "step", "eval_loss", "loss", "train_loss", "train_runtime"
    )


@query
def t02_best_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlog.best_checkpoint(_history(spark, sf_dir))


@query
def t03_training_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = split.split_counts(split.assign_splits(_cleaned(spark, sf_dir)))
    pick = {name: F.sum(F.when(F.col("split") == name, F.col("n_rows"))) for name in ("train", "val")}
    return counts.agg(*[value.alias(f"{name}_samples") for name, value in pick.items()])


# --- Noise --------------------------------------------------------------------
def _noise(name: str, *classes: str) -> None:
    QUERIES[name] = lambda spark, sf_dir: noise.inject_noise(inputs.documents(spark, sf_dir), classes=classes)


@query
def n01_clean_draws(spark: SparkSession, sf_dir: str) -> DataFrame:
    return noise.inject_noise(inputs.documents(spark, sf_dir), classes=("clean",), rates={"clean": 0.5})


_noise("n02_duplicates", "duplicate")
_noise("n03_html", "html")
_noise("n04_unicode", "unicode")
_noise("n05_pii", "pii")
_noise("n06_long_lines", "long")
_noise("n07_boilerplate", "boilerplate")


@query
def n08_noisy_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "noisy")
    ordered = split.seeded_order(noise.inject_noise(inputs.documents(spark, sf_dir)))
    files.write_jsonl(ordered, path)
    return files.read_jsonl(spark, path, files.RAW_SCHEMA + ", order_key string")


# --- Extension points ---------------------------------------------------------
@query
def u02_rule_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows hit per entry of the pattern registries."""
    t = F.col("text")
    tests = {kind: quality.has_pii_kind(t, kind) for kind in rules.PII}
    tests |= {s: F.contains(F.lower(t), F.lit(s)) for s in rules.BOILERPLATE_SIGNALS}
    counted = _normalized(spark, sf_dir).agg(*[F.count_if(hit).alias(name) for name, hit in tests.items()])
    rows = [F.struct(F.lit(name).alias("rule"), F.col(f"`{name}`").alias("n_rows")) for name in tests]
    return counted.select(F.inline(F.array(*rows)))


@query
def u02_rule_book(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompts against a table of rules, one made of each document."""
    prompts = inputs.guarded_exchanges(spark, sf_dir).select("conv_id", "turn", "prompt")
    found = rulebook.match_rules(prompts, "prompt", inputs.rule_book(spark, sf_dir), spread=True)
    first = F.get("hits", F.lit(0))
    return found.select(
        "conv_id",
        "turn",
        F.aggregate("hits", F.lit(0).cast("bigint"), lambda n, hit: n + hit["n_rules"]).alias("n_rules"),
        F.coalesce(first["place"], F.lit(-1)).alias("rule"),
        F.coalesce(first["category"], F.lit("")).alias("category"),
    )


def all_queries() -> dict[str, Query]:
    return dict(sorted(QUERIES.items()))
