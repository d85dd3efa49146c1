"""Change feeds: rows of a table together with the commit that brought them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

CHANGE_TYPE, COMMIT_VERSION, COMMIT_TIMESTAMP = "_change_type", "_commit_version", "_commit_timestamp"
METADATA = (CHANGE_TYPE, COMMIT_VERSION, COMMIT_TIMESTAMP)
UPSERTS = ("insert", "update_postimage")


def as_change_feed(df: DataFrame, version: Column, timestamp: Column,
                   change_type: Column | None = None) -> DataFrame:
    kind = F.lit("insert") if change_type is None else change_type
    return df.select("*", kind.alias(CHANGE_TYPE), version.cast("bigint").alias(COMMIT_VERSION),
                     timestamp.cast("timestamp").alias(COMMIT_TIMESTAMP))


def dedup_within_commit(changes: DataFrame) -> DataFrame:
    """Drop copies of a row that came in the same commit.

    The commit version is part of the row, so equal rows of different commits stay apart and a stream
    needs no state across micro-batches. Copies are combined before the shuffle.
    """
    return changes.dropDuplicates()


def dedup_stream(changes: DataFrame, at: str, delay: str) -> DataFrame:
    """Drop copies of a row that come in later micro-batches of a stream, up to ``delay`` behind the newest ``at``.

    The state holds a digest per distinct row instead of the row, and forgets it when the watermark has passed; rows that
    are later than that are dropped, copies or not. Rows without a time are kept, and their copies with them.
    """
    row = F.to_json(F.struct(*[F.col(c) for c in sorted(changes.columns)]), {"ignoreNullFields": "false"})
    known = changes.filter(F.col(at).isNotNull()).withColumn("__digest", F.sha2(row, 256)).withWatermark(at, delay)
    return known.dropDuplicatesWithinWatermark(["__digest"]).drop("__digest").unionByName(changes.filter(F.col(at).isNull()))


def append_only(changes: DataFrame, granularity: str = "commit") -> DataFrame:
    """Inserted rows of commits that did nothing but insert; with ``row``, inserts of every commit."""
    inserts = changes.filter(F.col(CHANGE_TYPE) == "insert")
    if granularity == "row":
        return inserts
    if granularity != "commit":
        raise ValueError(f"granularity must be 'commit' or 'row', not {granularity!r}")
    rewriting = (changes.filter(F.col(CHANGE_TYPE) != "insert").select(COMMIT_VERSION).distinct())
    return inserts.join(rewriting, COMMIT_VERSION, "left_anti").select(*changes.columns)
