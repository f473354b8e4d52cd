"""A training corpus out of raw documents: five stages, each working on all documents that the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from martloom.llm import decontaminate, mixing, simhash, substring, toxicity
from martloom.llm.common import stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the lexicon, learned from the labels, does not reject."""
    return toxicity.clean(docs, table(spark, sf_dir, "labels"), threshold=0.3)


def not_near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: fingerprints of three-word shingles, linked within two bits."""
    return simhash.one_of_each(docs, shingle=3, radius=2, stable=True)


def without_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that occur elsewhere; documents that are nothing else go."""
    return substring.trimmed(docs, window=35, period=21, stable=True)


def not_in_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the mix with the number of copies to train on; documents it does not take go."""
    return mixing.mix(docs).filter("copies > 0")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", not_toxic), ("near-duplicates", not_near_duplicate), ("substrings", without_passages),
    ("decontamination", not_in_benchmark), ("mixing", mixed)]

#: The learned stages cannot be told in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
