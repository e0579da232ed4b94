"""The registered queries of this subpackage, and their SQL where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, decontaminate, jpeg, licenses, ngram, pii, preferences, quality, simhash, toxicity


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def tokenizer() -> bpe.Codec:
    """The public byte-level vocabulary of 50,256 ranks; its place is a parameter of ``bpe.load``."""
    import public_tokenizers

    return bpe.load(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op1_jpeg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jpeg.media_features(jpeg.media_column(table(spark, sf_dir, "documents")))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detect(table(spark, sf_dir, "documents"))


def op3_ngram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram.score(table(spark, sf_dir, "documents"))


def op4_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preferences.preferences(table(spark, sf_dir, "conversations"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), tokenizer())


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_jpeg": op1_jpeg,
    "op2_pii": op2_pii,
    "op3_ngram": op3_ngram,
    "op4_preferences": op4_preferences,
    "op5_toxicity": op5_toxicity,
    "op6_simhash": op6_simhash,
    "op7_licenses": op7_licenses,
    "op8_bpe": op8_bpe,
    "op9_decontaminate": op9_decontaminate,
    "op10_quality": op10_quality,
}

SQL: dict[str, str] = {
    "op4_preferences": preferences.ORACLE,
    "op9_decontaminate": decontaminate.ORACLE,
}
