"""The registered queries of this folder, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ..session import work_dir
from .bag_search import bag_search
from .bpe_automaton import bpe_round_trip
from .common import table
from .decontamination import contaminated
from .licenses import license_scan
from .merkle import merkle_fingerprints
from .mixing import mix_sources
from .oracles import ORACLES
from .parity_join import ngram_jaccard_components
from .prefix_trie import prefix_trie
from .quality import quality_scores
from .token_counts import token_counts
from .toxicity import toxicity_scores
from .training_order import training_order
from .warc import captures_of_pages, revisit_digest

Query = Callable[[SparkSession, str], DataFrame]


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard_components(spark, table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Starts from an empty cache, so that all contents are encoded."""
    return token_counts(spark, table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"),
                        work_dir(spark, "token_cache"))


def op4_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_order(spark, table(spark, sf_dir, "documents"), tokenizer_path=public_tokenizers.path("byte_bpe_50k.json"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(spark, table(spark, sf_dir, "documents"))


def op7_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return revisit_digest(captures_of_pages(table(spark, sf_dir, "pages")))


def op8_merkle_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_fingerprints(table(spark, sf_dir, "documents"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_bag_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bag_search(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The operator also places every node in the tour."""
    return prefix_trie(spark, table(spark, sf_dir, "conversations")).drop("enter_at", "exit_at")


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(spark, table(spark, sf_dir, "documents"))


LLM_QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_ngram_jaccard_join, op2_toxicity, op3_token_counts, op4_training_order, op5_bpe,
    op6_license_scan, op7_warc_revisits, op8_merkle_fingerprints, op9_quality_classifier, op10_benchmark_decontamination,
    op11_bag_search, op12_prefix_trie, op13_mixing)}
LLM_ORACLES: dict[str, str] = ORACLES
