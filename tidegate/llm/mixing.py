"""Mixing sources to target weights by capped water-filling.

Every source shall get its weight's share of all words. A source that would be repeated too often is clamped at its
cap, and what it leaves is shared among the others by weight, until none is above its cap. A source's target is then
taken as whole repetitions of all its documents and one repetition of some of them: those that come first in an order
drawn from a seed. Built-in functions only.

The draw is a digit-by-digit selection: the sizes of a source are added up by the first digits of the order, which
shows the digits in which the target is reached; only documents with these digits are looked at more closely. So no
task sorts a source, however large.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import stored
from .ordering import numbered

MAX_EPOCHS = 3
SEED = "mix-1"
#: Hexadecimal digits of the order that one step looks at, and how many such steps come before the rest is sorted.
DIGITS, STEPS = 3, 2


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def cycled_weights(spark: SparkSession, sources: DataFrame, cycle: int = 3) -> DataFrame:
    """sources (source, ...) → with ``weight``: 1, 2, ... ``cycle``, 1, ... by code points of the name, null last."""
    rank = numbered(spark, sources, [F.col("source").asc_nulls_last()], "__rank", "sources")
    return rank.withColumn("weight", (F.col("__rank") % cycle + 1).cast("double")).drop("__rank")


def water_fill(sources: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """sources (source, source_size, weight) → with ``target``: the weights' shares of the sum of all sizes, none above
    ``max_epochs`` times its size.

    One aggregate of the source table per round brings two sums and a count to the driver. The clamped sources only grow in number,
    so the rounds end. Sources without size or weight get 0; nothing is lost as long as ``max_epochs`` is at least 1 and
    weights are positive.
    """
    cap, weight = (F.col("source_size") * max_epochs).cast("double"), F.col("weight")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, clamped = F.lit(0.0), -1
    while True:
        above = weight * level > cap
        spent, free, now = sources.agg(
            F.coalesce(F.sum(F.when(above, F.col("source_size"))), F.lit(0)) * max_epochs,
            F.coalesce(F.sum(F.when(~above, weight)), F.lit(0.0)), F.count_if(above)).first()
        if now == clamped or not free:
            break
        clamped, rest, shared = now, float(total - spent), free
        level = F.lit(rest) / F.lit(shared)
    if clamped < 0:  # no weight at all
        return sources.withColumn("target", F.lit(0.0))
    return sources.withColumn("target", F.when(weight * level > cap, cap).otherwise(F.lit(rest) * weight / F.lit(shared)))


def _step(draws: DataFrame, first: int) -> DataFrame:
    """draws (key, room, draw, size) → (key, digits, room): the digits in which the sizes, added up in the order of
    the draws, pass the room, and the room left there. No row where all draws fit."""
    digits = F.substring("draw", first, DIGITS)
    sums = draws.groupBy("key", "room", digits.alias("digits")).agg(F.sum("size").alias("here"))
    upto = Window.partitionBy("key").orderBy("digits").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    passed = sums.withColumn("upto", F.sum("here").over(upto)).filter((F.col("upto") > F.col("room"))
                                                                      & (F.col("upto") - F.col("here") <= F.col("room")))
    return passed.select("key", "digits", (F.col("room") - F.col("upto") + F.col("here")).alias("room"))


def mix_sources(spark: SparkSession, docs: DataFrame, weights=cycled_weights, max_epochs: int = MAX_EPOCHS,
                seed: str = SEED) -> DataFrame:
    """docs (doc_id, text, source, ...) → (doc_id, size, source_size, target, taken, repetitions, source).

    ``size`` counts words, ``taken`` is size times repetitions. ``weights`` gives a table (source, source_size) its
    ``weight`` column. One row per row of ``docs``; other columns are ignored. A null text has size 0; rows without a
    source form a source of their own, as do those with an empty one; a null doc_id stays. The order is the MD5 digest of
    seed, doc_id and text, so reruns agree and repeated rows, which are alike, may only change places. A source's taken
    words miss its target by less than half of the document at which it is reached. An empty table gives no rows.
    """
    # Joins go by a key that is never null: the name behind a letter, or nothing.
    rows = stored(spark, docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")).alias("key"),
        n_words(F.col("text")).alias("size"),
        F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
                          F.coalesce("text", F.lit("")))).alias("draw")), "mix")
    name = F.when(F.col("key") != "", F.substr("key", F.lit(2)))
    sums = rows.groupBy("key").agg(F.sum("size").alias("source_size")).withColumn("source", name)
    filled = water_fill(stored(spark, weights(spark, sums), "weights"), max_epochs)
    whole = F.coalesce(F.try_divide(F.floor("target"), F.col("source_size")).cast("long"), F.lit(0))
    room = F.floor("target") - F.col("whole") * F.col("source_size")
    filled = stored(spark, filled.withColumn("whole", whole).select("key", "source_size", "target", "whole", room.alias("room")),
                    "targets")

    # A document is before, in or behind the digits where its source's room ends; those in them go to the next step.
    rows = rows.join(filled, "key")
    open_rows, decided = rows.filter("room > 0"), [rows.filter("room <= 0").withColumn("extra", F.lit(0))]
    for step in range(STEPS):
        first = 1 + step * DIGITS
        ends = stored(spark, _step(open_rows, first), "ends").withColumnRenamed("room", "left")
        met = open_rows.join(ends, "key", "left")
        digits = F.substring("draw", first, DIGITS)
        inside = F.col("digits").isNotNull() & (digits == F.col("digits"))
        before = F.col("digits").isNull() | (digits < F.col("digits"))
        decided.append(met.filter(~inside).withColumn("extra", before.cast("int")).drop("digits", "left"))
        open_rows = met.filter(inside).withColumn("room", F.col("left")).drop("digits", "left")
    # Documents are taken as long as their middle lies in the room.
    along = Window.partitionBy("key").orderBy("draw", "doc_id", "size")
    upto = F.sum("size").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    decided.append(open_rows.withColumn("extra", (2 * upto - F.col("size") <= 2 * F.col("room")).cast("int")))
    out = decided[0]
    for part in decided[1:]:
        out = out.unionByName(part)
    repetitions = F.col("whole") + F.col("extra")
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * repetitions).alias("taken"),
                      repetitions.alias("repetitions"), name.alias("source"))
