"""Registered queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from textmill.llm import bpe, langid, merkle, mixing, neardup, neighbours, phrases, quality, secrets, suffix, tokencount, toxicity, winnow
from textmill.llm.common import documents, labels


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.deduplicated(documents(spark, sf_dir), keep_bytes=False)


def op2_isolation_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(documents(spark, sf_dir), labels(spark, sf_dir))


def op3_toxic_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(documents(spark, sf_dir), labels(spark, sf_dir))


def op4_ftrl_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(documents(spark, sf_dir))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.token_counts(documents(spark, sf_dir))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(documents(spark, sf_dir))


def op7_weighted_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(documents(spark, sf_dir))


def op8_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(documents(spark, sf_dir))


def op9_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.fingerprint_report(documents(spark, sf_dir))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_report(documents(spark, sf_dir))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(documents(spark, sf_dir))


def op12_pruned_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest_report(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest_report(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_isolation_forest": op2_isolation_forest,
    "op3_toxic_grammar": op3_toxic_grammar,
    "op4_ftrl_langid": op4_ftrl_langid,
    "op5_token_counts": op5_token_counts,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_weighted_minhash": op7_weighted_minhash,
    "op8_entropy_mix": op8_entropy_mix,
    "op9_winnowing": op9_winnowing,
    "op10_secret_scan": op10_secret_scan,
    "op11_collocations": op11_collocations,
    "op12_pruned_graph": op12_pruned_graph,
    "op13_merkle_manifest": op13_merkle_manifest,
}
