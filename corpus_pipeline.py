"""The corpus pipeline: five training-data operators over ``documents``, each stage's result written and read again."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gridmix.llm import decontamination, line_dedup, mixing, ngram_join, toxicity
from gridmix.llm.queries import held_out
from gridmix.session import shared_dir


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: documents that score 0.7 or more go."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), train=~held_out())


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: of alike lines the first stays; documents that keep no line go."""
    return line_dedup.keep_lines(docs)


def join_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: one document of each linked component stays."""
    return ngram_join.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents that hold a benchmark item go."""
    return decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: how much of each remaining document the mix takes."""
    return mixing.mix_counts(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", reject_toxic),
    ("line dedup", dedup_lines),
    ("n-gram Jaccard join", join_near_copies),
    ("benchmark decontamination", decontaminate),
    ("mixing sources", mix_sources),
]

#: The stages before the mix score, match and pack; SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``; between two stages the rows lie as Parquet in the shared folder.

    The folder of a run is named at random below the shared folder and belongs
    to the caller, who may delete it once the result has been read.
    """
    folder = shared_dir(spark, f"pipeline-{uuid.uuid4().hex}")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        if number:
            path = f"{folder}/{number}"
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
        docs = stage(spark, docs, sf_dir)
    return docs
