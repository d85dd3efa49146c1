"""Row expectations: named SQL predicates that a row must all satisfy to be kept."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F


def holds(rule: str) -> Column:
    """A predicate that is NULL counts as violated, as in WHERE."""
    return F.coalesce(F.expr(rule), F.lit(False))


def expect_all_or_drop(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    if not rules:
        return df
    return df.filter(reduce(lambda a, b: a & b, [F.expr(rule) for rule in rules.values()]))


def violation_counts(rules: dict[str, str]) -> list[Column]:
    return [F.count(F.lit(1)).alias("rows_seen"),
            *[F.count_if(~holds(rule)).alias(f"failed_{name}") for name, rule in rules.items()]]


def observe_rules(df: DataFrame, rules: dict[str, str], to: str | Observation) -> DataFrame:
    """Count violations while the rows flow by; no pass over the data of its own."""
    return df.observe(to, *violation_counts(rules))


def expectation_report(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """One row per rule: ``rule, passed, failed``, from a single aggregation without a key shuffle."""
    counts = df.agg(*violation_counts(rules))
    lines = F.array(*[
        F.struct(F.lit(name).alias("rule"),
                 (F.col("rows_seen") - F.col(f"failed_{name}")).alias("passed"),
                 F.col(f"failed_{name}").alias("failed"))
        for name in rules])
    return counts.select(F.inline(lines))


def report_of(spark: SparkSession, counts: dict[str, int], rules: dict[str, str]) -> DataFrame:
    """The same report from counts that :func:`observe_rules` has collected."""
    lines = [(rule, counts["rows_seen"] - counts[f"failed_{rule}"], counts[f"failed_{rule}"]) for rule in rules]
    return spark.createDataFrame(lines, "rule string, passed bigint, failed bigint")
