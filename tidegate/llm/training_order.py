"""Sequences of token ids in training order, in shards of fixed-stride records.

Every document's ids are cut into sequences, which are numbered as the scan meets them. A keyed Feistel network permutes
the numbers 0..n-1: it works on the smallest even power of two that holds n, and walks along its cycle until the number is
below n. The permuted number is the sequence's slot in the training order. Slots are dealt to shards by range, one task
per shard, and a shard's file holds its records in order, all of the same length: the file's name and a multiplication
tell where a slot is. Reading from a slot on opens its shard and the later ones only. The committed files appear
together; a lost executor only repeats its shard.

A record holds ids of one, two or four bytes, little-endian: the tokens of a vocabulary of that size, or bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import work_dir
from .bpe_automaton import automaton, token_ids
from .common import discard, ship, stored
from .spans import PIECE, mix, pieces

#: A record: doc_id (8 bytes), part (4), number of ids (2), bytes of an id (2), ids, and one byte that ends it.
HEADER, STRIDE = 16, 512
IDS = STRIDE - HEADER - 1
END = "\n"
SHARD_SLOTS = 1 << 15
#: Records that are put together at once in a task.
BLOCK = 4096
ROUNDS = 6
NO_ID = -(1 << 63)
PACKED = "shard int, slots array<long>, packed binary"
RECORDS = "slot long, shard int, doc_id long, part int, n_tokens int, ids_sha256 string"


def _halves(n: int) -> int:
    return max(1, (max(n - 1, 1).bit_length() + 1) // 2)


def _round(x: np.ndarray, key: int, i: int, mask: np.uint64) -> np.ndarray:
    return mix(x + np.uint64((key * 0x9E3779B97F4A7C15 + (i + 1) * 0xD1B54A32D192ED03) & (2 ** 64 - 1))) & mask


def _walk(index: np.ndarray, n: int, step) -> np.ndarray:
    out = step(index.astype(np.uint64))
    far = np.flatnonzero(out >= n)
    while len(far):
        out[far] = step(out[far])
        far = far[out[far] >= n]
    return out.astype(np.int64)


def slot_of(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """Slots of the sequences with these numbers, a permutation of 0..n-1 for every key."""
    half = np.uint64(_halves(n))
    mask = np.uint64((1 << int(half)) - 1)

    def step(x):
        left, right = x >> half, x & mask
        for i in range(ROUNDS):
            left, right = right, left ^ _round(right, key, i, mask)
        return left << half | right

    return _walk(index, n, step)


def index_of(slot: np.ndarray, n: int, key: int) -> np.ndarray:
    """The inverse of ``slot_of``."""
    half = np.uint64(_halves(n))
    mask = np.uint64((1 << int(half)) - 1)

    def step(x):
        left, right = x >> half, x & mask
        for i in reversed(range(ROUNDS)):
            left, right = right ^ _round(left, key, i, mask), left
        return left << half | right

    return _walk(slot, n, step)


def _id_pieces(lists: pa.ListArray, width: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """As ``pieces``: (first list, bytes of its ids and the following ones', offsets of the lists in them)."""
    offsets, first = lists.offsets.to_numpy().astype(np.int64), 0
    while first < len(lists):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + PIECE // width, "right")) - 1)
        held = lists.values.slice(offsets[first], offsets[last] - offsets[first])
        ids = held.to_numpy(zero_copy_only=False)
        if held.null_count or len(ids) and (ids.min() < 0 or ids.max() >= 1 << 8 * width):
            raise ValueError(f"a token id is null or does not fit {width} bytes")
        yield first, ids.astype(f"<u{width}").view(np.uint8), (offsets[first: last + 1] - offsets[first]) * width
        first = last


def write_training_order(spark: SparkSession, docs: DataFrame, folder: str, key: int = 1,
                         shard_slots: int = SHARD_SLOTS, ids: str | None = None, width: int = 2) -> int:
    """Write docs (doc_id, text or ids, ...) as shards in ``folder``; gives the number of sequences.

    ``ids`` names a column of token ids, each written in ``width`` bytes (1, 2 or 4); an id that is null or does not fit
    stops the job. Without it the ids are the bytes of ``text``. Null and empty texts or lists have no sequence, a null
    doc_id is written as the smallest number, repeated rows are sequences of their own. ``docs`` must give the same rows in
    the same tasks each time it is run, as a scan of files does: sequence numbers come from a count per task, and a task
    that then meets another number of sequences stops the job.
    """
    ship(spark)
    width = width if ids else 1
    if width not in (1, 2, 4):
        raise ValueError("width is 1, 2 or 4")
    room = IDS // width * width
    content = F.coalesce(ids, F.array().cast("array<int>")) if ids else F.col("text")
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), content.alias("content"))
    size = F.size("content") * width if ids else F.octet_length("content")
    # One row per task.
    counts = {r["task"]: r["n"] or 0 for r in rows.groupBy(F.spark_partition_id().alias("task")).agg(
        F.sum(F.ceil(size / room)).alias("n")).collect()}
    order = sorted(counts)
    ends = np.cumsum([counts[t] for t in order])
    first = {t: int(e - counts[t]) for t, e in zip(order, ends)}
    n = int(ends[-1]) if len(ends) else 0
    if not n:
        return 0

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton.cache_clear()  # a worker that encoded before holds one; it is not needed any more
        task = TaskContext.get().partitionId()
        at, end = first.get(task, 0), first.get(task, 0) + counts.get(task, 0)
        for batch in batches:
            doc_id = batch.column(0).to_numpy()
            for begin, data, offsets in _id_pieces(batch.column(1), width) if ids else pieces(batch.column(1)):
                parts = -(-np.diff(offsets) // room)
                before = np.cumsum(parts) - parts
                total = int(parts.sum())
                if at + total > end:
                    raise RuntimeError("the input gives other rows than when it was counted; store it first")
                for low in range(0, total, BLOCK):
                    number = np.arange(low, min(total, low + BLOCK))
                    which = np.searchsorted(before + parts, number, "right")
                    part = number - before[which]
                    start = offsets[which] + part * room
                    held = np.minimum(room, offsets[which + 1] - start)
                    record = np.zeros((len(which), STRIDE - 1), np.uint8)
                    record[:, :8] = doc_id[begin + which].astype("<i8")[:, None].view(np.uint8)
                    record[:, 8:12] = part.astype("<i4")[:, None].view(np.uint8)
                    record[:, 12:14] = (held // width).astype("<u2")[:, None].view(np.uint8)
                    record[:, 14:16] = np.array([width], "<u2").view(np.uint8)
                    column = np.arange(room)
                    source = np.minimum(start[:, None] + column, len(data) - 1)
                    record[:, HEADER: HEADER + room] = np.where(column < held[:, None], data[source], 0)
                    yield _packed(slot_of(at + number, n, key), record, shard_slots)
                at += total
        if at != end:
            raise RuntimeError("the input gives other rows than when it was counted; store it first")

    shards = -(-n // shard_slots)
    dealt = rows.mapInArrow(cut, PACKED).repartitionById(shards, F.col("shard"))
    (dealt.mapInArrow(_in_order, "record binary").select(F.col("record").cast("string").alias("value"))
     .write.mode("overwrite").option("lineSep", END).option("compression", "none").text(folder))
    return n


def _packed(slot: np.ndarray, record: np.ndarray, shard_slots: int) -> pa.RecordBatch:
    """The records of each shard together, compressed, so that the shuffle moves few rows and bytes."""
    order = np.argsort(slot)
    slot, record = slot[order], record[order]
    shard = slot // shard_slots
    cuts = np.flatnonzero(np.append(True, shard[1:] != shard[:-1]))
    ends = np.append(cuts[1:], len(slot))
    packed = [pa.compress(np.ascontiguousarray(record[a:b]).tobytes(), codec="zstd", asbytes=True) for a, b in zip(cuts, ends)]
    return pa.RecordBatch.from_arrays(
        [pa.array(shard[cuts].astype(np.int32)), pa.ListArray.from_arrays(pa.array(np.append(cuts, len(slot)), pa.int32()),
                                                                          pa.array(slot)), pa.array(packed, pa.binary())],
        names=["shard", "slots", "packed"])


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records of one shard by slot. A shard has at most ``shard_slots`` of them, which bounds the memory."""
    automaton.cache_clear()
    slots, records = [], []
    for batch in batches:
        for own, packed in zip(batch.column(1), batch.column(2)):
            slots.append(own.values.to_numpy())
            raw = pa.decompress(packed.as_buffer(), len(slots[-1]) * (STRIDE - 1), codec="zstd")
            records.append(np.frombuffer(raw, np.uint8).reshape(-1, STRIDE - 1))
    if not slots:
        return
    record = np.concatenate(records)
    del records
    order = np.argsort(np.concatenate(slots))
    for at in range(0, len(order), 4096):
        some = np.ascontiguousarray(record[order[at: at + 4096]])
        yield pa.RecordBatch.from_arrays([pa.FixedSizeBinaryArray.from_buffers(
            pa.binary(STRIDE - 1), len(some), [None, pa.py_buffer(some)]).cast(pa.binary())], names=["record"])


def _numbers_between(low: int, high: int) -> list[str]:
    """File patterns of the numbers low..high as they stand in file names, with five digits or more."""
    out = []
    for digits in range(5, 11):
        at, last = max(low, 10 ** (digits - 1) if digits > 5 else 0), min(high, 10 ** digits - 1)
        while at <= last:
            # The longest run of whole decades that begins here.
            k = max(k for k in range(digits) if at % 10 ** k == 0 and 10 ** k <= last - at + 1)
            digit = at // 10 ** k % 10
            top = min(9, digit + (last - at + 1) // 10 ** k - 1)
            prefix = str(at // 10 ** (k + 1)).zfill(digits - k - 1) if digits > k + 1 else ""
            out.append(f"{prefix}[{digit}-{top}]" + "?" * k)
            at += (top - digit + 1) * 10 ** k
    return out


def read_training_order(spark: SparkSession, folder: str, first_slot: int = 0, slots: int | None = None,
                        shard_slots: int = SHARD_SLOTS, with_ids: bool = False) -> DataFrame:
    """(slot, shard, doc_id, part, n_tokens, ids_sha256[, ids]) of the slots from ``first_slot`` on.

    Only the shards that hold these slots are opened; of each, a task looks at the records of these slots alone. The digest
    is that of the ids' bytes as they are stored.
    """
    ship(spark)
    last_slot = 2 ** 62 if slots is None else first_slot + slots
    schema = RECORDS + ", ids array<int>" * with_ids
    if last_slot <= first_slot:
        return spark.createDataFrame([], schema)
    names = _numbers_between(first_slot // shard_slots, (last_slot - 1) // shard_slots)
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "part-{" + ",".join(names) + "}-*").load(folder)
             .select(F.regexp_extract("path", r"part-(\d+)", 1).cast("int").alias("shard"), "content"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton.cache_clear()
        for batch in batches:
            for shard, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                held = np.frombuffer(content.as_buffer(), np.uint8)
                begin = shard * shard_slots
                stop = min(len(held) // STRIDE, last_slot - begin)
                for at in range(max(0, first_slot - begin), stop, BLOCK):
                    some = held[at * STRIDE: min(at + BLOCK, stop) * STRIDE].reshape(-1, STRIDE)
                    yield _unpacked(some, begin + at, shard, with_ids)

    return files.mapInArrow(read, schema)


def _unpacked(some: np.ndarray, slot: int, shard: int, with_ids: bool) -> pa.RecordBatch:
    """What the records say; they stand in the order from ``slot`` on."""
    doc_id = np.ascontiguousarray(some[:, :8]).view("<i8").ravel()
    part = np.ascontiguousarray(some[:, 8:12]).view("<i4").ravel()
    count, width = np.ascontiguousarray(some[:, 12:16]).view("<u2").astype(np.int32).T
    digests = [hashlib.sha256(r[HEADER: HEADER + size].tobytes()).hexdigest() for r, size in zip(some, count * width)]
    columns = [pa.array(slot + np.arange(len(some))), pa.array(np.full(len(some), shard, np.int32)),
               pa.array(doc_id, mask=doc_id == NO_ID), pa.array(part), pa.array(count), pa.array(digests, pa.string())]
    names = ["slot", "shard", "doc_id", "part", "n_tokens", "ids_sha256"]
    if with_ids:
        ids = [r[HEADER: HEADER + c * w].view(f"<u{w}").astype(np.int32) for r, c, w in zip(some, count, width)]
        columns.append(pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(count))), pa.int32()),
                                                pa.array(np.concatenate(ids))))
        names.append("ids")
    return pa.RecordBatch.from_arrays(columns, names=names)


def training_order(spark: SparkSession, docs: DataFrame, key: int = 1, tokenizer_path: str | None = None) -> DataFrame:
    """Materialise the training order in the shared folder and give back what the shards hold, one row per sequence.

    The texts' ids are those of the tokenizer at ``tokenizer_path``, encoded once and stored before they are counted, in two
    bytes each; without a tokenizer they are the texts' bytes.
    """
    folder = work_dir(spark, "training_order")
    if tokenizer_path:
        encoded, ids = stored(spark, token_ids(docs, tokenizer_path), "token_ids", with_folder=True)
        n = write_training_order(spark, ids, folder, key, ids="ids")
        discard(spark, encoded)
    else:
        n = write_training_order(spark, docs, folder, key)
    return read_training_order(spark, folder) if n else spark.createDataFrame([], RECORDS)
