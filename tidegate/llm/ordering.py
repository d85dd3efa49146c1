"""Global order and prefix sums over tables of any size, without a window that holds more than a bounded number of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import stored

#: Places of one key that a window sees together; longer keys are cut into chunks of so many places.
CHUNK = 4096
_ROW_BITS = 33  # of monotonically_increasing_id: the row in its partition; the bits above number the partition


def numbered(spark: SparkSession, df: DataFrame, order: Sequence[Column], name: str, label: str) -> DataFrame:
    """A stored copy of ``df`` with ``name``: 0, 1, 2, ... in the given order; equal rows come in any order.

    Rows are dealt by range and numbered inside each range; the sizes of the ranges, one row per task, say where each
    range begins. A salt at the end of the order splits rows that are equal in all of it.
    """
    dealt = (df.withColumn("__salt", F.rand(17)).repartitionByRange(*order, F.col("__salt"))
             .sortWithinPartitions(*order, "__salt").drop("__salt").withColumn("__place", F.monotonically_increasing_id()))
    kept = stored(spark, dealt, label)
    part = F.shiftright("__place", _ROW_BITS)
    sizes = kept.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    # As many rows as the shuffle has partitions.
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    begins = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__begin"))
    return (kept.withColumn("__part", part).join(F.broadcast(begins), "__part")
            .withColumn(name, F.col("__begin") + F.col("__place").bitwiseAND((1 << _ROW_BITS) - 1))
            .drop("__part", "__place", "__begin"))


def running(df: DataFrame, key: str, at: str, sums: dict[str, str], highest_after: dict[str, str] | None = None) -> DataFrame:
    """Adds, along the places ``at`` (0, 1, 2, ..., each once) of every ``key``: sums of a column up to and with the row
    ({new name: column}), and the highest value of a column from the row on, nulls left out.

    A key's places are taken in chunks; what comes from other chunks is a second table with one row per chunk of the
    keys that have more than one, so a key of n places brings n / CHUNK rows together at most.
    """
    highest_after = highest_after or {}
    chunked = df.withColumn("__chunk", F.floor(F.col(at) / CHUNK))
    inside = Window.partitionBy(key, "__chunk").orderBy(at)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    onward = inside.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    within = chunked.withColumns({n: F.sum(c).over(upto) for n, c in sums.items()}
                                 | {n: F.max(c).over(onward) for n, c in highest_after.items()})
    many = chunked.groupBy(key).agg(F.max("__chunk").alias("__last")).filter(F.col("__last") > 0).select(key)
    totals = chunked.join(many, key, "left_semi").groupBy(key, "__chunk").agg(
        *[F.sum(c).alias(f"__s_{n}") for n, c in sums.items()], *[F.max(c).alias(f"__m_{n}") for n, c in highest_after.items()])
    across = Window.partitionBy(key).orderBy("__chunk")
    earlier, later = across.rowsBetween(Window.unboundedPreceding, -1), across.rowsBetween(1, Window.unboundedFollowing)
    carried = totals.select(F.col(key).alias("__key"), F.col("__chunk").alias("__at_chunk"),
                            *[F.sum(f"__s_{n}").over(earlier).alias(f"__s_{n}") for n in sums],
                            *[F.max(f"__m_{n}").over(later).alias(f"__m_{n}") for n in highest_after])
    joined = within.join(carried, (F.col(key) == F.col("__key")) & (F.col("__chunk") == F.col("__at_chunk")), "left")
    return joined.select(*df.columns, *[(F.col(n) + F.coalesce(f"__s_{n}", F.lit(0))).alias(n) for n in sums],
                         *[F.greatest(n, f"__m_{n}").alias(n) for n in highest_after])
