"""The evaluation job: metrics of a set of predictions and of scored texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.operators.overlap import corpus_rouge, eval_texts, mean_token_f1, pair_up, perplexity, score_pairs
from textmill.session import materialize


def evaluate(
    texts: DataFrame,
    predictions: DataFrame,
    scores: DataFrame,
    model_path: str,
    data_path: str,
    cap: int | None,
    stem: bool = True,
) -> DataFrame:
    """One row: sample count over all texts, perplexity, ROUGE and token F1 over
    the pairs. The pairs are scored in a single pass and stored as numbers."""
    pairs = pair_up(eval_texts(texts, cap), predictions)
    scored = materialize(score_pairs(pairs, stem), "pair-scores", release=True)
    rouge, f1 = corpus_rouge(scored), mean_token_f1(scored)
    counted = texts.agg(F.count(F.lit(1)).alias("num_samples"))
    return counted.select(
        F.lit(model_path).alias("model_path"),
        F.lit(data_path).alias("data_path"),
        "num_samples",
        F.round(perplexity(scores).scalar(), 2).alias("perplexity"),
        *[rouge.select(name).scalar().alias(name) for name in ("rouge1", "rouge2", "rougeL")],
        f1.scalar().alias("token_f1"),
    )
