"""A training corpus from raw documents: quality, near duplicates, benchmark items, mixture, token files."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vitalgrid.llm import decontaminate, mixing, quality, signature_join, token_blocks
from vitalgrid.session import scratch_path, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the limits of their language and source."""
    return quality.quality_filter(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near copies."""
    return signature_join.one_per_component(docs)


def benchmark_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no item of `benchmark`."""
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def target_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample of half the tokens, with tempered shares of sources, languages and topics."""
    return mixing.mixed_documents(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in doc_id order, and what they hold: doc_id, start, n_tokens, ids_crc32."""
    return token_blocks.token_digest(docs, scratch_path(spark, "tokens"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_items", benchmark_items),
    ("target_weights", target_weights),
    ("token_files", token_files),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; the result of each is written and read again."""
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        rows = written(stage(spark, rows, sf_dir), f"pipeline-{name}")
    return rows


# SQL has no tokenizer: tests hold run() against a brute-force version
ORACLE_SQL = None
