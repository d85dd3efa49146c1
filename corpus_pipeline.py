"""From raw documents to token ids: quality, toxicity, near duplicates, benchmark leaks, tokens.

Each stage gets the documents that its predecessor kept, reread from Parquet, and all but the last give documents back.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidegate.llm.bpe_automaton import bpe_round_trip
from tidegate.llm.common import ship, stored, table
from tidegate.llm.decontamination import without_benchmark
from tidegate.llm.parity_join import one_of_each_group
from tidegate.llm.quality import keep_good
from tidegate.llm.toxicity import keep_harmless

#: No SQL can express the learned stages; the tests compare the rows with a brute-force version.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality ranking rejects go."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity network rejects go."""
    return keep_harmless(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one with the smallest doc_id."""
    ship(spark)
    return one_of_each_group(spark, docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return without_benchmark(spark, docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents as token ids, with digests of the ids and of the text they decode to."""
    ship(spark)
    return bpe_round_trip(docs, public_tokenizers.path("byte_bpe_50k.json"), with_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality), ("toxicity", toxicity), ("near_duplicates", near_duplicates),
    ("decontamination", decontamination), ("tokens", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(spark, stage(spark, docs, sf_dir), name)
    return stored(spark, STAGES[-1][1](spark, docs, sf_dir), STAGES[-1][0])
