"""Previous and next value within a key, for keys of any size.

A window function brings all rows of a key into one task. That is fine for ordinary keys. When some
key has more than ``max_rows`` rows, the timeline of the heavy keys is cut into ranges that hold about half as many rows
each, the window runs per (key, range), and the value that crosses a border comes from a summary with one row per
heavy (key, range). The borders are quantiles of the rows, whatever their times are: counted off where a key's rows fit a
task, and otherwise taken from a sketch. Rows of one key with the same order value stay together. Keys that are not heavy
stay whole and have no summary rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from ..session import remove_path, work_dir

MAX_GROUP_ROWS = 2_000_000
MAX_BROADCAST_KEYS = 100_000
CHUNK = "__chunk"
SPLITS = "__splits"
BEFORE_ALL = -1


#: Folders written inside :func:`written_alone`.
_inside: ContextVar[list[str] | None] = ContextVar("_inside", default=None)


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query that ends in here go when it has ended; otherwise they stay until the driver happens to collect garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` computed once and written down; what is built on it reads it back instead of computing it again."""
    spark, folder = df.sparkSession, work_dir(df.sparkSession, label)
    with shuffles_released(spark):
        df.write.option("compression", "zstd").parquet(folder)
    if _inside.get() is not None:
        _inside.get().append(folder)
    back = spark.read.schema(df.schema).parquet(folder)
    back._written = folder
    return back


def is_written(df: DataFrame) -> bool:
    """Whether ``df`` is what :func:`written` gave, so that writing it again would be a copy."""
    return hasattr(df, "_written")


def written_alone(spark: SparkSession, build: Callable[[], DataFrame], label: str) -> DataFrame:
    """What ``build`` returns, written down; the tables that it wrote on the way are removed, so nothing else may read them."""
    outer, own = _inside.get(), []
    token = _inside.set(own)
    try:
        result = written(build(), label)
    finally:
        _inside.reset(token)
    for folder in own:
        if folder != result._written:
            remove_path(spark, folder)
    if outer is not None:
        outer.append(result._written)
    return result


def heavy_keys(df: DataFrame, keys: Sequence[str], max_rows: int) -> DataFrame:
    """Keys with more than ``max_rows`` rows: at most (rows / max_rows) of them."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))
              .filter(F.col("__rows") > max_rows).select(*keys))


def largest_group(df: DataFrame, keys: Sequence[str]) -> int:
    """Rows of the biggest key: one column-pruned counting job, one number to the driver."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))
    return sizes.agg(F.max("__rows")).first()[0] or 0


def heavy_or_none(df: DataFrame, keys: Sequence[str], max_rows: int = MAX_GROUP_ROWS,
                  largest: int | None = None) -> DataFrame | None:
    """The heavy keys, or None when there are none and plain windows will do.

    They are written down and counted before they may be broadcast; beyond the bound the join shuffles instead.
    """
    if largest is not None and largest <= max_rows:
        return None
    heavy = written(heavy_keys(df, keys, max_rows), "heavy_keys")
    count = heavy.count()
    if count == 0:
        return None
    return F.broadcast(heavy) if count <= MAX_BROADCAST_KEYS else heavy


def check_order(df: DataFrame, order: str) -> None:
    """Times, dates and numbers can be cut into chunks; other orders are refused before any path is chosen."""
    kind = df.schema[order].dataType
    if not isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType, T.NumericType)):
        raise TypeError(f"{order} must be a time, a date or a number, not {kind.simpleString()}")


def split_points(df: DataFrame, keys: Sequence[str], order: str, max_rows: int) -> DataFrame:
    """(keys, __splits): rising values of ``order`` that cut the rows of every key into ranges of about ``max_rows`` / 2.

    One aggregation with partial sketches. The result is written down, so that all later steps see the same borders:
    all in all 2 * rows / ``max_rows`` values at most.
    """
    max_rows = max(1, max_rows)
    sizes = df.groupBy(*keys).agg(F.count(order).alias("__n"))
    largest = sizes.agg(F.max("__n")).first()[0] or 0
    most = max(1, math.ceil(2 * largest / max_rows))
    wanted = F.greatest(F.lit(1), F.ceil(2 * F.col("__n") / max_rows))
    quantiles = F.percentile_approx(order, [k / most for k in range(1, most)] or [0.5], max(10_000, 20 * most))
    found = df.groupBy(*keys).agg(F.count(order).alias("__n"), quantiles.alias("__q")).withColumn("__wanted", wanted)
    # Of the quantiles that the largest key needs, a smaller one takes as many as it needs, evenly.
    place = lambda i: F.floor((i + 1) * F.col("__wanted") / most)
    kept = F.array_distinct(F.filter("__q", lambda q, i: place(i) > F.floor(i * F.col("__wanted") / most)))
    splits = found.select(*keys, F.when(F.col("__wanted") > 1, kept).otherwise(F.slice("__q", 1, 0)).alias(SPLITS))
    return written(splits, "borders")


def range_of(order: str | Column, splits: Column) -> Column:
    """Number of the range of a value; rises with the order."""
    value = F.col(order) if isinstance(order, str) else order
    return F.size(F.filter(splits, lambda s: s <= value)).cast("long")


def with_chunks(df: DataFrame, heavy: DataFrame, keys: Sequence[str], order: str, max_rows: int = MAX_GROUP_ROWS,
                fits: int = MAX_GROUP_ROWS) -> DataFrame:
    """Add the range number: NULL for ordinary keys, so that each of them forms one group.

    Rows of a heavy key without an ordering value go to a range before all others. A key with up to ``fits`` rows is counted
    off in one task; only larger ones are sketched, since a sketch per key costs far more than the rows of a small one. The
    result is written down, because windows and summaries of ranges each read it.
    """
    return written_alone(df.sparkSession, lambda: _cut(df, heavy, keys, order, max_rows, fits), "ranges")


def _cut(df: DataFrame, heavy: DataFrame, keys: Sequence[str], order: str, max_rows: int, fits: int) -> DataFrame:
    df = df if is_written(df) else written(df, "uncut")
    rows = df.join(heavy.select(*keys, F.lit(True).alias("__heavy")), list(keys), "left").withColumn(SPLITS, F.lit(None).cast(
        T.ArrayType(df.schema[order].dataType)))
    huge = heavy_or_none(df.join(heavy, list(keys), "left_semi"), keys, max(fits, max_rows))
    if huge is not None:
        # At most rows / ``fits`` keys.
        borders = split_points(df.join(huge, list(keys), "left_semi"), keys, order, max_rows)
        if borders.count() <= MAX_BROADCAST_KEYS:
            borders = F.broadcast(borders)
        rows = rows.drop(SPLITS).join(borders, list(keys), "left")
    sketched = F.when(F.col(SPLITS).isNotNull(), F.when(F.col(order).isNull(), BEFORE_ALL).otherwise(range_of(order, F.col(SPLITS))))
    rows = rows.withColumn("__sketched", sketched)
    # Without a sketched key the rows are together by key already.
    place = F.rank().over(Window.partitionBy(*keys, *([] if huge is None else ["__sketched"])).orderBy(order))
    counted = F.when(F.col(order).isNull(), BEFORE_ALL).otherwise(F.floor((place - 1) / max(1, max_rows // 2)))
    chunk = F.when(F.col("__heavy"), F.coalesce("__sketched", counted)).cast("long")
    return rows.withColumn(CHUNK, chunk).select(*df.columns, CHUNK)


def _neighbour(df, keys, order, value, name, heavy, max_rows, step) -> DataFrame:
    check_order(df, order)
    pick = F.lag if step < 0 else F.lead
    # Boxed, so that a neighbour whose value is NULL differs from no neighbour at all.
    boxed = F.struct(value.alias("value"))
    if heavy is None:
        w = Window.partitionBy(*keys).orderBy(order)
        return df.withColumn(name, pick(boxed).over(w))

    # Rows that were cut before keep their ranges.
    chunked = df if CHUNK in df.columns else with_chunks(df, heavy, keys, order, max_rows)
    chunked = chunked.withColumn("__value", boxed)
    inside = Window.partitionBy(*keys, CHUNK).orderBy(order)
    # Nearest row of the neighbouring chunk: its last row when looking back, its first when looking ahead. The order is
    # boxed, because these aggregates skip rows whose order is NULL.
    edge = F.max_by if step < 0 else F.min_by
    borders = (chunked.filter(F.col(CHUNK).isNotNull()).groupBy(*keys, CHUNK)
                      .agg(edge("__value", F.struct(order)).alias("__edge")))
    across = Window.partitionBy(*keys).orderBy(CHUNK)
    borders = borders.select(*keys, CHUNK, pick("__edge").over(across).alias("__across"))
    return (chunked.withColumn(name, pick("__value").over(inside))
                   .join(borders, [*keys, CHUNK], "left")
                   .withColumn(name, F.coalesce(name, "__across"))
                   .select(*df.columns, name))


def with_previous(df: DataFrame, keys: Sequence[str], order: str, value: Column, name: str,
                  heavy: DataFrame | None = None, max_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Add ``name``: a struct with the ``value`` of the preceding row of the key, NULL on its first row."""
    return _neighbour(df, keys, order, value, name, heavy, max_rows, -1)


def with_next(df: DataFrame, keys: Sequence[str], order: str, value: Column, name: str,
              heavy: DataFrame | None = None, max_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Add ``name``: a struct with the ``value`` of the following row of the key, NULL on its last row."""
    return _neighbour(df, keys, order, value, name, heavy, max_rows, 1)


def running_total_before(amounts: DataFrame, points: DataFrame, at: str, amount: str,
                         max_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """For each distinct point in time: sum of ``amount`` over all rows strictly earlier than it.

    Amounts are first added up per point in time, and the points are cut into ranges of about ``max_rows`` / 2 rows.
    Totals run inside each range; what the earlier ranges add up to are 2 * rows / ``max_rows`` numbers, which the driver
    adds up. Returns ``at, total_before, rows_before``.
    """
    per_time = (amounts.filter(F.col(at).isNotNull()).groupBy(at)
                .agg(F.sum(amount).alias("__sum"), F.count(F.lit(1)).alias("__n")))
    events = (per_time.withColumn("__side", F.lit(1))
              .unionByName(points.select(at).filter(F.col(at).isNotNull()).distinct()
                           .withColumn("__side", F.lit(0)), allowMissingColumns=True))
    events = events.withColumn("__all", F.lit(0))
    borders = F.broadcast(split_points(events, ["__all"], at, max_rows))  # one row
    events = events.join(borders, "__all").withColumn(CHUNK, range_of(at, F.col(SPLITS))).drop("__all", SPLITS)

    ranges = events.groupBy(CHUNK).agg(F.sum("__sum").alias("__sum"), F.sum("__n").alias("__n"))
    kinds = {f.name: f.dataType for f in ranges.schema}
    earlier, upto_sum, upto_n = [], 0, 0
    for row in sorted(ranges.collect()):
        earlier.append((row[CHUNK], upto_sum, upto_n))
        upto_sum, upto_n = upto_sum + (row["__sum"] or 0), upto_n + (row["__n"] or 0)
    carried = amounts.sparkSession.createDataFrame(earlier, T.StructType([
        T.StructField(CHUNK, kinds[CHUNK]), T.StructField("__ranges_sum", kinds["__sum"]), T.StructField("__ranges_n", kinds["__n"])]))

    upto = (Window.partitionBy(CHUNK).orderBy(at, "__side")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    inside = (events.withColumn("__in_sum", F.sum("__sum").over(upto))
                    .withColumn("__in_n", F.sum("__n").over(upto))
                    .filter(F.col("__side") == 0))
    zero = F.lit(0)
    return inside.join(carried, CHUNK).select(
        at,
        (F.coalesce("__in_sum", zero) + F.coalesce("__ranges_sum", zero)).alias("total_before"),
        (F.coalesce("__in_n", zero) + F.coalesce("__ranges_n", zero)).alias("rows_before"))
