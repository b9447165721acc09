"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again as the next one's input."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cotalake.llm import decontamination, language_id, line_dedup, mixing, near_dedup
from cotalake.llm.common import table, text_batches, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language, which becomes their ``lang``; the others go."""
    text_batches(spark)
    return language_id.keep_identified(docs)


def remove_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the lines that spread over many sources; ``n_chars``, where there is one, follows the text."""
    return line_dedup.cleaned(docs)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that with the smallest id."""
    text_batches(spark)
    return near_dedup.drop_near_duplicates(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontamination.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture: documents with the epoch, the number of leading tokens taken, and the text of these tokens."""
    return mixing.mix_documents(docs, with_text=True)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("line_dedup", remove_common_lines),
    ("near_dedup", remove_near_duplicates),
    ("decontamination", remove_benchmark),
    ("mixing", mix_sources),
]

#: Models and latent spaces are not SQL; the tests hold run() against its stages and brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
