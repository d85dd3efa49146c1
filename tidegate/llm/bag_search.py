"""Ranked lexical search by bag deduplication.

What a document scores for an item depends only on how often the items' words stand in it and on its length factor m.
Documents are therefore restricted to the words of the items, documents with the same counts and the same m form a class,
each class is scored once, and a class's score stands for its members, which follow by ascending doc_id.

Classes are found by a hash of counts and m and verified on both themselves. A class passes on as many of its smallest
doc_ids as an item's report can hold: tasks drop the others before the shuffle, so a class of any size stays small.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .common import stored

TOP = 10
#: Items are searched in blocks whose distinct words and word-item pairs stay below this, which bounds what a task holds.
BLOCK = 200_000
#: Bytes of a text that are cut into words at once.
SLICE = 1 << 20
#: Classes scored at once.
BATCH = 2048
_WORD = {*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)}
#: Byte by byte: letters A-Z lowered, all that is no part of a word a blank.
TABLE = bytes(b + 32 if 0x41 <= b < 0x5B else b if b in _WORD else 32 for b in range(256))
BAGS = "doc_id long, n_terms long, terms array<int>, tfs array<int>"
SCORED = "item_id long, score long, first_id long, members array<long>"


def words(text: str | None) -> Iterator[list[bytes]]:
    """The words of a text, some at a time."""
    data = (text or "").encode("utf-8", "replace").translate(TABLE)
    at = 0
    while at < len(data):
        stop = data.find(b" ", at + SLICE)
        stop = len(data) if stop < 0 else stop
        yield data[at:stop].split()
        at = stop


def bags(docs: DataFrame, vocabulary: Broadcast) -> DataFrame:
    """docs (doc_id, text) → (doc_id, n_terms, terms, tfs): the number of all words, and the counts of those in the
    vocabulary ({word: number}) by rising number."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for batch in batches:
            sizes, starts, terms, tfs = [], [0], [], []
            for text in batch.column(1):
                n, found = 0, Counter()
                for some in words(text.as_py()):
                    n += len(some)
                    found.update(filter(known.__contains__, some))
                bag = sorted((known[w], c) for w, c in found.items())
                sizes.append(n)
                terms += [t for t, _ in bag]
                tfs += [c for _, c in bag]
                starts.append(len(terms))
            offsets = pa.array(starts, pa.int32())
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(terms, pa.int32())),
                pa.ListArray.from_arrays(offsets, pa.array(tfs, pa.int32()))], names=["doc_id", "n_terms", "terms", "tfs"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(count, BAGS)


def item_blocks(items: DataFrame, block: int = BLOCK) -> Iterator[list[tuple[int | None, list[bytes]]]]:
    """The items' distinct words, in blocks of at most ``block`` words; an item with more is a block of its own.

    The stated queries pass through the driver one by one, never as a whole.
    """
    held, size = [], 0
    for row in items.select(F.col("item_id").cast("long").alias("item_id"), "text").toLocalIterator():
        distinct = sorted(set().union(*words(row["text"])))
        if held and size + len(distinct) > block:
            yield held
            held, size = [], 0
        held.append((row["item_id"], distinct))
        size += len(distinct)
    if held:
        yield held


def classes(found: DataFrame, top: int) -> DataFrame:
    """(doc_id, m, terms, tfs) → one row per distinct (m, terms, tfs), with the ``top`` smallest doc_ids, null last."""
    group = ["hash", "m", "terms", "tfs"]
    hashed = found.withColumn("hash", F.xxhash64("m", "terms", "tfs"))
    nth = F.row_number().over(Window.partitionBy(*group).orderBy(F.col("doc_id").asc_nulls_last()))
    first = hashed.withColumn("nth", nth).filter(F.col("nth") <= top)
    return first.groupBy(*group).agg(F.transform(
        F.array_sort(F.collect_list(F.struct("nth", "doc_id"))), lambda x: x["doc_id"]).alias("members")).drop("hash")


def _postings(block: list, weights: dict[int, int], vocabulary: dict[bytes, int]):
    """Items of every word, as one array with borders, and the words' weights."""
    pairs = sorted((vocabulary[w], i) for i, (_, ws) in enumerate(block) for w in ws)
    at = np.searchsorted([t for t, _ in pairs], np.arange(len(vocabulary) + 1))
    return (at, np.array([i for _, i in pairs], np.int64),
            np.array([weights.get(t, 0) for t in range(len(vocabulary))], np.int64), [i for i, _ in block])


def scored(found: DataFrame, held: Broadcast, top: int) -> DataFrame:
    """Classes → per task and item the ``top`` best classes by (score, smallest doc_id)."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, items, weights, names = held.value
        best: dict[int, list] = {}
        for batch in batches:
            for part in (batch.slice(k, BATCH) for k in range(0, batch.num_rows, BATCH)):
                m, (starts, terms), (_, tfs), members = (part.column(0).to_numpy(), _flat(part.column(1)), _flat(part.column(2)),
                                                         part.column(3).to_pylist())
                owner = np.repeat(np.arange(len(m)), np.diff(starts))
                value = weights[terms] * ((1_000_000_000 * tfs) // (1000 * tfs + 8 * m[owner]))
                n_items = at[terms + 1] - at[terms]
                total = np.concatenate(([0], np.cumsum(n_items)))
                place = np.arange(total[-1]) + np.repeat(at[terms] - total[:-1], n_items)
                table = np.zeros((len(names), len(m)), np.int64)
                np.add.at(table, (items[place], np.repeat(owner, n_items)), np.repeat(value, n_items))
                for i in np.flatnonzero((table > 0).any(axis=1)).tolist():
                    rows = np.flatnonzero(table[i] > 0)
                    if len(rows) > top:  # those that tie with the last one stay, too
                        least = np.partition(table[i][rows], len(rows) - top)[len(rows) - top]
                        rows = rows[table[i][rows] >= least]
                    new = [(-int(table[i][r]), members[r][0] is None, members[r][0] or 0, members[r]) for r in rows.tolist()]
                    best[i] = sorted(best.get(i, []) + new, key=lambda x: x[:3])[:top]
        rows = [(names[i], -s, ids[0], ids) for i, found in best.items() for s, _, _, ids in found]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)],
                                         names=["item_id", "score", "first_id", "members"])

    return found.select("m", "terms", "tfs", "members").mapInArrow(score, SCORED)


def _flat(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    starts = lists.offsets.to_numpy().astype(np.int64)
    return starts - starts[0], lists.flatten().to_numpy().astype(np.int64)


def bag_search(spark: SparkSession, docs: DataFrame, items: DataFrame, top: int = TOP, block: int = BLOCK) -> DataFrame:
    """docs (doc_id, text, ...), items (item_id, text, ...) → (item_id, rank, doc_id, score): the ``top`` best documents
    with a score above 0 for every item; equal scores by ascending doc_id, a null one last.

    Null and empty texts have no words, and items without words or with words that no document has find nothing. Every row
    of ``docs`` is a document, also if it is there several times. Rows of ``items`` that repeat an id are items of their
    own with the same id only if their texts differ. Other columns are ignored. Texts of any length are read whole.
    """
    results = []
    for held in item_blocks(items.select("item_id", "text").distinct(), block):
        vocabulary = {w: k for k, w in enumerate(sorted({w for _, ws in held for w in ws}))}
        found = stored(spark, bags(docs, spark.sparkContext.broadcast(vocabulary)), "bags")
        n, total = found.agg(F.count_if(F.col("n_terms") > 0), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
        # As many rows as the block has words.
        held_by = found.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
        weight = F.floor(1000 * F.log(F.lit(float(2 * n + 2)) / (2 * F.col("df") + 1)))
        weights = {r["term"]: r["w"] for r in held_by.select("term", weight.alias("w")).collect()}
        factor = (10 + F.floor(F.expr(f"(90 * n_terms * {n}L) div {max(total, 1)}L"))).cast("long")
        matched = found.filter(F.size("terms") > 0).select("doc_id", factor.alias("m"), "terms", "tfs")
        once = classes(matched, top)
        postings = spark.sparkContext.broadcast(_postings(held, weights, vocabulary))
        results.append(stored(spark, scored(once, postings, top), "scored"))
    if not results:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    best = results[0]
    for more in results[1:]:
        best = best.unionByName(more)
    ahead = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("first_id").asc_nulls_last())
    best = best.withColumn("nth", F.row_number().over(ahead)).filter(F.col("nth") <= top)
    ranks = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return (best.select("item_id", "score", F.explode("members").alias("doc_id")).withColumn("rank", F.row_number().over(ranks))
            .filter(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score"))
