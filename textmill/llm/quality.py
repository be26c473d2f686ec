"""Quality rules with an isolation forest over their statistics.

Base rules count words, symbols, repeated lines and repeated eight-word windows of each
whole text. An isolation forest over ratios of those and a few more statistics judges what
the base rules keep: random splits isolate odd rows early, so a short mean path marks an
anomaly. Its threshold is calibrated on labelled rows.

The forest is fitted on a sample of at most ``SAMPLE`` documents, the first by a hash of
the id, which the driver holds (``SAMPLE`` rows of numbers). Scores, counts and the
calibration cover all rows; what the driver gets for the threshold is a histogram of at
most ``2 * (STEPS + 1)`` rows. Text is read once, row-locally.

Threshold: of the scores that reject at most ``GOOD_LOST`` of the labelled good rows, the
one that rejects most bad rows. Without labelled rows of both kinds nothing is rejected
by the forest.

Defined cases: a null or empty text has no words and fails the base rules; repeated rows
give equal rows (a repeated labelled document counts as often as it appears); columns
other than those named are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.common import text_rows
from textmill.llm.hashing import ODD, SPACE, mixed, word_hashes
from textmill.session import materialize

SAMPLE = 8192
TREES = 96
TREE_ROWS = 256
#: Scores are rounded to so many steps.
STEPS = 1000
GOOD_LOST = 0.002
#: Words of an average text that every ratio is mixed with.
SMOOTH = 50
SEED = 20

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"[#*$%&|<>]".strip(b"[]"))] = True
_UPPER = np.zeros(256, bool)
_UPPER[ord("A") : ord("Z") + 1] = True
#: Statistics of a text, in the order in which they are computed.
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
EXTRA = ("n_distinct_words", "n_upper")


def repeated_words(hashes: np.ndarray, n: int = 8) -> int:
    """Words in windows of ``n`` words that occur at least twice in the text."""
    if len(hashes) <= n:
        return 0
    with np.errstate(over="ignore"):
        grams, size = hashes, 1
        while size < n:
            grams = mixed(grams[:-size] * ODD + grams[size:])
            size *= 2
    order = np.argsort(grams, kind="stable")
    ranked = grams[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(grams), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    cover = np.zeros(len(hashes) + 1, np.int32)
    cover[np.flatnonzero(twice)] += 1
    cover[np.flatnonzero(twice) + n] -= 1
    return int((np.cumsum(cover[:-1]) > 0).sum())


def statistics(text: str) -> tuple[int, ...]:
    """The values of ``BASE`` and ``EXTRA``."""
    raw = text.encode()
    data = np.frombuffer(raw, np.uint8)
    if not len(data):
        return (0,) * (len(BASE) + len(EXTRA))
    starts, _, hashes = word_hashes(data)
    kinds = np.bincount(data, minlength=256)
    chars = int(kinds.sum() - kinds[SPACE].sum() - kinds[0x80:0xC0].sum())
    lines = [line for line in raw.split(b"\n") if line.strip(b" \t\n\x0b\x0c\r")]
    return (
        len(starts),
        chars,
        int(kinds[_SYMBOL].sum()),
        len(lines) - len(set(lines)),
        repeated_words(hashes),
        len(np.unique(hashes)),
        int(kinds[_UPPER].sum()),
    )


def rule_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the statistics of each text."""
    names = ["doc_id", *BASE, *EXTRA]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [statistics(text) for text in batch.column(1).to_pylist()]
            table = np.array(rows, np.int64).reshape(len(rows), len(names) - 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c) for c in table.T]], names)

    rows = text_rows(docs)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{n} bigint" for n in names[1:]))


def _features(table: np.ndarray) -> np.ndarray:
    """Ratios that do not depend on a text's length, drawn to the middle for short ones.
    Repeated lines and windows are left to the base rules: licence lines repeat too."""
    words, chars, symbols, _, _, distinct, upper = table.T.astype(float)
    more = words + SMOOTH
    return np.column_stack(
        [
            (chars + 5 * SMOOTH) / more,
            symbols / more,
            np.log1p(distinct) - np.log1p(words),
            upper / (chars + 5 * SMOOTH),
        ]
    )


def _expected(n: np.ndarray | float) -> np.ndarray:
    """Mean path of an unsuccessful search among ``n`` rows."""
    n = np.maximum(np.asarray(n, float), 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        path = 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n
    return np.where(n > 2, path, np.where(n == 2, 1.0, 0.0))


def fit_forest(features: np.ndarray, trees: int = TREES, rows: int = TREE_ROWS, seed: int = SEED) -> dict[str, np.ndarray]:
    """Trees as arrays: split feature, split value, left child (right is one further);
    a leaf has child 0 and its path length as the value."""
    rng = np.random.default_rng(seed)
    size = min(rows, len(features))
    depth = max(1, math.ceil(math.log2(max(size, 2))))
    most = 2 ** (depth + 1)
    feature = np.zeros((trees, most), np.int16)
    value = np.zeros((trees, most))
    child = np.zeros((trees, most), np.int32)
    for t in range(trees):
        open_ = [(0, 0, features[rng.choice(len(features), size, replace=False)])]
        used = 1
        while open_:
            node, level, own = open_.pop()
            low, high = own.min(axis=0), own.max(axis=0)
            wide = np.flatnonzero(high > low)
            if level >= depth or len(own) <= 1 or not len(wide):
                value[t, node] = level + _expected(len(own))
                continue
            f = int(rng.choice(wide))
            cut = rng.uniform(low[f], high[f])
            left = own[:, f] <= cut
            feature[t, node], value[t, node], child[t, node] = f, cut, used
            open_ += [(used, level + 1, own[left]), (used + 1, level + 1, own[~left])]
            used += 2
    return {"feature": feature, "value": value, "child": child, "depth": np.array(depth), "mean": _expected(size)}


def anomaly(features: np.ndarray, forest: dict[str, np.ndarray]) -> np.ndarray:
    """Between 0 and 1; higher is odder."""
    total = np.zeros(len(features))
    at_row = np.arange(len(features))
    for feature, value, child in zip(forest["feature"], forest["value"], forest["child"], strict=True):
        node = np.zeros(len(features), np.int32)
        for _ in range(int(forest["depth"])):
            below = child[node]
            right = features[at_row, feature[node]] > value[node]
            node = np.where(below > 0, below + right, node)
        total += value[node]
    return 2.0 ** (-total / len(forest["value"]) / max(float(forest["mean"]), 1e-9))


def threshold(histogram: list[tuple[int, int, int]], good_lost: float = GOOD_LOST) -> int:
    """The step from which rows are rejected, of ``(step, good, bad)`` counts."""
    good, bad = sum(g for _, g, _ in histogram), sum(b for *_, b in histogram)
    if not good or not bad:
        return STEPS + 1
    lost, cut = 0, STEPS + 1
    for step, g, b in sorted(histogram, reverse=True):
        lost += g
        if lost > good_lost * good:
            break
        if b:
            cut = step
    return cut


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, the base statistics, ``base_failed``, ``anomaly``, ``kept``.
    ``labels`` has ``doc_id`` and ``quality``."""
    n, repeat = F.col("n_words"), F.col("n_repeat_words")
    failed = (n < 20) | (100 * repeat > 30 * n)
    stats = materialize(rule_statistics(docs).withColumn("base_failed", failed), "quality-statistics")
    names = [*BASE, *EXTRA]
    order = [F.xxhash64("doc_id", F.lit(SEED)), F.col("doc_id"), *names]
    sample = stats.where("not base_failed").orderBy(*order).limit(SAMPLE).select(*names).toPandas().to_numpy()
    if len(sample) < 2:
        return stats.select("doc_id", *BASE, "base_failed", F.lit(0.0).alias("anomaly"), (~F.col("base_failed")).alias("kept"))
    forest = fit_forest(_features(sample))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(1, len(names) + 1)])
            steps = np.rint(anomaly(_features(table), forest) * STEPS).astype(np.int64)
            columns = [batch.column(i) for i in range(len(BASE) + 1)] + [batch.column(len(names) + 1), pa.array(steps)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", *BASE, "base_failed", "step"])

    kind = stats.schema["doc_id"].dataType.simpleString()
    shape = f"doc_id {kind}, " + ", ".join(f"{b} bigint" for b in BASE) + ", base_failed boolean, step bigint"
    scored = materialize(stats.select("doc_id", *names, "base_failed").mapInArrow(run, shape), "quality-scores")
    marked = labels.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    histogram = (
        scored.where("not base_failed")
        .select("doc_id", "step")
        .join(marked, "doc_id")
        .groupBy("step")
        .agg(F.count_if(F.col("quality") == 1).alias("good"), F.count_if(F.col("quality") == 0).alias("bad"))
        .collect()
    )
    cut = threshold([tuple(r) for r in histogram])
    return scored.select(
        "doc_id",
        *BASE,
        "base_failed",
        (F.col("step") / STEPS).alias("anomaly"),
        (~F.col("base_failed") & (F.col("step") < cut)).alias("kept"),
    )
