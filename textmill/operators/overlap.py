"""Clipped token overlap of prediction/reference pairs, and the scores on it."""

from __future__ import annotations

from string import ascii_lowercase, digits

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from textmill.functions.porter import stem
from textmill.functions.quality import eval_eligible
from textmill.functions.subsequence import lcs, lcs_of_numbers, numbered  # noqa: F401
from textmill.functions.text import continuation_part, once, prompt_part


def eval_texts(df: DataFrame, cap: int | None = None) -> DataFrame:
    """Prompt and reference of every text long enough, the rest being skipped.
    A cap counts texts before the length test, in id order."""
    head = df if cap is None else df.orderBy("doc_id").limit(cap)
    text = F.col("text")
    return head.where(eval_eligible(text)).select(
        "doc_id", prompt_part(text).alias("prompt"), continuation_part(text).alias("reference")
    )


def pair_up(references: DataFrame, predictions: DataFrame, how: str = "inner") -> DataFrame:
    """Predictions with their references, by id rather than by position."""
    return predictions.select("doc_id", "prediction").join(references.select("doc_id", "reference"), "doc_id", how)


def pair_by_position(references: DataFrame, predictions: DataFrame) -> DataFrame:
    """``(ordinal, prediction, reference)`` of two numbered tables of texts without ids; what
    one side has more than the other is left out."""
    said = predictions.select("ordinal", F.col("text").alias("prediction"))
    return said.join(references.select("ordinal", F.col("text").alias("reference")), "ordinal")


def f_measure(overlap: Column, n_pred: Column, n_ref: Column) -> Column:
    """Harmonic mean of precision and recall; 0 without any overlap."""
    precision = overlap / F.greatest(n_pred, F.lit(1))
    recall = overlap / F.greatest(n_ref, F.lit(1))
    return F.when(overlap > 0, 2 * precision * recall / (precision + recall)).otherwise(F.lit(0.0))


def _f(name: str) -> Column:
    return f_measure(*(F.col(f"counts.{name}_{x}") for x in ("overlap", "n_pred", "n_ref")))


def mean_token_f1(scores: DataFrame) -> DataFrame:
    return scores.agg(F.coalesce(F.round(F.avg("token_f1"), 4), F.lit(0.0)).alias("token_f1"))


#: Bytes of runs of ASCII letters and digits; all others part them.
_ASCII_WORD = bytes(c if chr(c) in ascii_lowercase + digits else ord(" ") for c in range(256))


def _common(a: np.ndarray, b: np.ndarray, size: int) -> tuple[int, int, int]:
    in_both = np.minimum(np.bincount(a, minlength=size), np.bincount(b, minlength=size))
    return int(in_both.sum()), len(a), len(b)


def _common_pairs(a: np.ndarray, b: np.ndarray, size: int) -> tuple[int, int, int]:
    """As ``_common``, of neighbours: the n-th of equal pairs of ``a`` counts if ``b`` has as many."""
    a, b = (np.sort(t[:-1] * size + t[1:]) for t in (a, b))
    before = np.arange(len(a)) - np.searchsorted(a, a)
    held = np.searchsorted(b, a, side="right") - np.searchsorted(b, a)
    return int(np.count_nonzero(before < held)), len(a), len(b)


def _pair_counts(prediction: str, reference: str, parts: tuple[str, ...], stemmed: bool) -> list[int]:
    counts: list[int] = []
    if "f1" in parts:
        a, b, different = numbered(prediction.split(), reference.split())
        counts += _common(a, b, len(different))
    if parts != ("f1",):
        a, b, different = numbered(*(t.encode().translate(_ASCII_WORD).split() for t in (prediction, reference)))
        if stemmed:
            stems, _, different = numbered([stem(token.decode()) for token in different], [])
            a, b = stems[a], stems[b]
        if "rouge1" in parts:
            counts += _common(a, b, len(different))
        if "rouge2" in parts:
            counts += _common_pairs(a, b, len(different))
        if "rougeL" in parts:
            counts += (lcs_of_numbers(a, b, len(different)), len(a), len(b))
    return counts


def _scored(pairs: DataFrame, parts: tuple[str, ...], stemmed: bool = True) -> DataFrame:
    """``(doc_id, counts)``: tokens in common and tokens per side for each part. All of
    it is row-local: both texts go to Python once, and one struct comes back."""
    names = [f"{part}_{what}" for part in parts for what in ("overlap", "n_pred", "n_ref")]

    @F.arrow_udf(StructType([StructField(n, LongType()) for n in names]))
    def count(prediction: pa.Array, reference: pa.Array) -> pa.Array:
        rows = [
            _pair_counts(p or "", r or "", parts, stemmed)
            for p, r in zip(prediction.to_pylist(), reference.to_pylist(), strict=True)
        ]
        columns = list(zip(*rows, strict=True)) if rows else [[] for _ in names]
        return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    return pairs.select("doc_id", once(count(F.lower("prediction"), F.lower("reference"))).alias("counts"))


def token_f1(pairs: DataFrame) -> DataFrame:
    return _scored(pairs, ("f1",)).select("doc_id", F.round(_f("f1"), 4).alias("token_f1"))


def rouge_l(pairs: DataFrame, stem: bool = True) -> DataFrame:
    return _scored(pairs, ("rougeL",), stem).select("doc_id", _f("rougeL").alias("rougeL"))


def rouge_n(pairs: DataFrame, orders: tuple[int, ...] = (1, 2), stem: bool = True) -> DataFrame:
    """ROUGE-1 and/or ROUGE-2 per pair."""
    parts = tuple(f"rouge{n}" for n in orders)
    return _scored(pairs, parts, stem).select("doc_id", *[_f(part).alias(part) for part in parts])


def score_pairs(pairs: DataFrame, stem: bool = True) -> DataFrame:
    """All four scores per pair. A missing text counts as an empty one."""
    parts = ("f1", "rouge1", "rouge2", "rougeL")
    scores = [_f(part).alias(part) for part in parts[1:]]
    return _scored(pairs, parts, stem).select("doc_id", F.round(_f("f1"), 4).alias("token_f1"), *scores)


def corpus_rouge(scores: DataFrame) -> DataFrame:
    """Means over all predictions, 0 when there are none."""
    return scores.agg(
        *[F.round(F.coalesce(F.avg(m), F.lit(0.0)), 4).alias(m) for m in ("rouge1", "rouge2", "rougeL")]
    )


def perplexity(scores: DataFrame, max_length: int | None = None) -> DataFrame:
    """Token-weighted perplexity of ``(doc_id, loss, n_tokens)`` rows. ``max_length`` is
    where the scorer cut its texts, if it did."""
    n = F.col("n_tokens")
    steps = (n if max_length is None else F.least(n, F.lit(max_length))) - 1
    usable = F.col("n_tokens") >= 2
    total = F.sum(F.when(usable, steps))
    weighted = F.sum(F.when(usable, F.col("loss") * steps))
    return scores.agg(
        F.when(total > 0, F.exp(weighted / total)).otherwise(F.lit(float("inf"))).alias("perplexity")
    )
