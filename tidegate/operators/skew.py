"""Joins with a dimension when a few keys hold most of the facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .ordered import MAX_BROADCAST_KEYS, MAX_GROUP_ROWS

SALT, SALTS = "__salt", "__salts"


def heavy_hitters(facts: DataFrame, key: str, max_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """(key, __salts) of the keys with more than ``max_rows`` facts: how many parts each needs. At most facts / max_rows rows."""
    return (facts.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("__rows"))
            .filter(F.col("__rows") > max_rows).select(key, F.ceil(F.col("__rows") / max_rows).alias(SALTS)))


def salted_join(facts: DataFrame, dimension: DataFrame, key: str, max_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Inner join by ``key`` in which no task meets much more than ``max_rows`` facts of one key.

    The facts are counted per key first, which reads one column. Facts of a heavy key are dealt out over as many parts as its
    count asks for, and only its dimension rows are repeated, once per part. Without a heavy key it is a plain join.
    ``facts`` are read twice, so they should be a stored table.
    """
    heavy = heavy_hitters(facts, key, max_rows)
    found = heavy.collect() if heavy.limit(MAX_BROADCAST_KEYS + 1).count() <= MAX_BROADCAST_KEYS else None
    if found == []:
        return facts.join(dimension, key, "inner")
    if found is not None:
        heavy = F.broadcast(facts.sparkSession.createDataFrame(found, heavy.schema))
    dealt = (facts.join(heavy, key, "left")
             .withColumn(SALT, F.coalesce(F.monotonically_increasing_id() % F.col(SALTS), F.lit(0))).drop(SALTS))
    last = F.coalesce(F.col(SALTS), F.lit(1)) - 1
    repeated = (dimension.join(heavy, key, "left")
                .withColumn(SALT, F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long")))).drop(SALTS))
    return dealt.join(repeated, [key, SALT], "inner").drop(SALT)
