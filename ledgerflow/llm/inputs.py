"""Inputs of the check queries and the pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file() -> str:
    """The public byte-level tokenizer that the check queries use."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
