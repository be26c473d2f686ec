"""Training run logs: history rows and best checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HISTORY_FIELDS = (
    "eval_loss", "eval_runtime", "eval_samples_per_second", "eval_steps_per_second",
    "loss", "grad_norm", "learning_rate",
    "train_runtime", "train_samples_per_second", "train_steps_per_second", "total_flos", "train_loss",
    "epoch",
)
RUN_LOG_SCHEMA = (
    "run_id string, seed int, model_name string, trainable_params bigint, total_params bigint, "
    "train_loss double, train_runtime_seconds double, train_samples int, val_samples int, "
    "config struct<model_name: string, dataset_dir: string, output_dir: string, seed: int, num_epochs: int, "
    "batch_size: int, gradient_accumulation_steps: int, learning_rate: double, weight_decay: double, "
    "warmup_ratio: double, max_seq_length: int, fp16: boolean, logging_steps: int, save_strategy: string, "
    "lora: struct<enabled: boolean, r: int, alpha: int, dropout: double, target_modules: array<string>>>, "
    f"history array<struct<{', '.join(f'{f}: double' for f in HISTORY_FIELDS)}, step: int>>"
)


def history_rows(runs: DataFrame) -> DataFrame:
    """One row per history entry; its kind shows in the keys it has."""
    exploded = runs.select("run_id", F.posexplode("history").alias("position", "entry"))
    kind = (
        F.when(F.col("entry.eval_loss").isNotNull(), "eval")
        .when(F.col("entry.loss").isNotNull(), "step")
        .otherwise("summary")
    )
    return exploded.select("run_id", "position", kind.alias("kind"), "entry.*")


def best_checkpoint(history: DataFrame) -> DataFrame:
    """Per run, the evaluation with the lowest loss; the earliest step on ties."""
    evals = history.where("kind = 'eval'")
    return evals.groupBy("run_id").agg(F.min(F.struct("eval_loss", "step", "epoch")).alias("best")).select(
        "run_id",
        F.col("best.step").alias("best_step"),
        F.col("best.epoch").alias("best_epoch"),
        F.col("best.eval_loss").alias("best_metric"),
    )
