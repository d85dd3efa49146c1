"""Slowly changing dimensions, type 1 (current row) and type 2 (validity intervals), from a change feed.

Rules that hold for both types: rows with a NULL key or a NULL sequence are ignored; only ``insert`` and
``update_postimage`` changes apply; a later sequence value wins no matter when it arrives; among equal
sequence values the later commit wins, then the row that is greatest in column order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .changes import CHANGE_TYPE, COMMIT_TIMESTAMP, COMMIT_VERSION, METADATA, UPSERTS
from .ordered import MAX_GROUP_ROWS, check_order, heavy_or_none, with_chunks, with_next, with_previous

START_AT, END_AT, DELETED = "__START_AT", "__END_AT", "__deleted"


def applicable(changes: DataFrame, keys: Sequence[str], delete_when: Column | None = None,
               sequence_by: str | None = None) -> DataFrame:
    """Changes that take part in the merge, flagged with whether they delete their key.

    A change without a place in the sequence can neither win nor bound a version, so it takes no part.
    """
    deleted = F.lit(False) if delete_when is None else F.coalesce(delete_when, F.lit(False))
    rows = changes.withColumn(DELETED, deleted)
    for column in [*keys, *([sequence_by] if sequence_by else [])]:
        rows = rows.filter(F.col(column).isNotNull())
    if CHANGE_TYPE in changes.columns:
        rows = rows.filter(F.col(CHANGE_TYPE).isin(*UPSERTS) | F.col(DELETED))
    return rows


def _ranking(changes: DataFrame, group: Sequence[str], sequence_by: str) -> list[str]:
    """Columns that decide which change of a group wins: the greatest, with NULL as the smallest value."""
    first = [c for c in (sequence_by, COMMIT_VERSION) if c in changes.columns and c not in group]
    return first + [c for c in changes.columns if c not in group and c not in first]


def reduce_changes(changes: DataFrame, group: Sequence[str], sequence_by: str) -> DataFrame:
    """The winning change of every group; losers are dropped before the shuffle already."""
    ranked = _ranking(changes, group, sequence_by)
    winners = changes.groupBy(*group).agg(F.max(F.struct(*ranked)).alias("__row"))
    return winners.select(*group, "__row.*").select(*changes.columns)


def _reduce_in_place(changes: DataFrame, group: Sequence[str], sequence_by: str) -> DataFrame:
    """The same winners for rows that are partitioned by key already: the sort that ranks them also serves
    the windows that follow."""
    best = [F.desc(c) for c in _ranking(changes, group, sequence_by)]
    place = F.row_number().over(Window.partitionBy(*group).orderBy(*best))
    return changes.withColumn("__place", place).filter(F.col("__place") == 1).drop("__place")


def scd1(changes: DataFrame, keys: Sequence[str], sequence_by: str = COMMIT_TIMESTAMP,
         except_columns: Sequence[str] = METADATA, delete_when: Column | None = None) -> DataFrame:
    """The current row of every key."""
    latest = reduce_changes(applicable(changes, keys, delete_when, sequence_by), keys, sequence_by)
    return latest.filter(~F.col(DELETED)).drop(DELETED, *except_columns)


def scd2(changes: DataFrame, keys: Sequence[str], sequence_by: str = COMMIT_TIMESTAMP,
         except_columns: Sequence[str] = METADATA, delete_when: Column | None = None,
         collapse_unchanged: bool = True, max_group_rows: int = MAX_GROUP_ROWS,
         sized_by: DataFrame | None = None) -> DataFrame:
    """All versions of every key with ``__START_AT`` and ``__END_AT`` (NULL while current).

    ``sized_by`` may name a frame that is cheaper to count than the changes and has at least as many rows
    of each key, such as the raw feed.
    """
    keys = list(keys)
    check_order(changes, sequence_by)
    rows = applicable(changes, keys, delete_when, sequence_by)
    heavy = heavy_or_none(rows if sized_by is None else sized_by, keys, max_group_rows)
    group = [*keys, sequence_by]
    if heavy is None:
        # Every key fits a task, so one shuffle by key serves the reduction and both windows.
        versions = _reduce_in_place(rows.repartition(*keys), group, sequence_by)
    else:
        # Cut once: both windows use the same ranges.
        versions = with_chunks(reduce_changes(rows, group, sequence_by), heavy, keys, sequence_by, max_group_rows)

    if collapse_unchanged:
        untracked = {*keys, sequence_by, *METADATA, *except_columns}
        tracked = F.struct(*[F.col(c) for c in rows.columns if c not in untracked])
        versions = with_previous(versions, keys, sequence_by, tracked, "__previous", heavy, max_group_rows)
        same = F.col("__previous").isNotNull() & F.col("__previous.value").eqNullSafe(tracked)
        versions = versions.filter(~same).drop("__previous")

    versions = with_next(versions, keys, sequence_by, F.col(sequence_by), "__next", heavy, max_group_rows)
    kept = [c for c in changes.columns if c not in except_columns]
    return (versions.filter(~F.col(DELETED))
                    .select(*kept, F.col(sequence_by).alias(START_AT), F.col("__next.value").alias(END_AT)))


def current(history: DataFrame) -> DataFrame:
    return history.filter(F.col(END_AT).isNull())


def with_first_start(history: DataFrame, key: str, name: str = "min_start",
                     heavy: DataFrame | None = None) -> DataFrame:
    """Add the earliest start of the key.

    Ordinarily a window, which shares its shuffle with the history itself. With heavy keys it is an
    aggregate instead: partial minima before the shuffle and a join whose skewed side can be split.
    """
    if heavy is not None:
        return history.join(history.groupBy(key).agg(F.min(START_AT).alias(name)), key)
    return history.withColumn(name, F.min(START_AT).over(Window.partitionBy(key)))
