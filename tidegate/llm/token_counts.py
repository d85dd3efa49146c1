"""Token counts through a cache keyed by digests of the content and of the tokenizer.

The cache is a Parquet table (digest, n_tokens) with a folder per tokenizer digest. Contents are joined to it by
digest; each distinct content that it lacks is encoded once and appended, so a later run only encodes what is new.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import path_exists
from .spans import Memo, pieces, spans, word_hashes

LIMIT = 4096
CACHE = "digest string, n_tokens long"
#: The character that stands for a blank in pieces.
BLANK = "▁".encode()


class PieceCounter:
    """Counts tokens as sentencepiece does.

    Where no piece holds a blank after another character, merges don't reach across the blank before a word, and a text
    without double or trailing blanks is counted word by word, each distinct word once. Other texts, those that hold the
    character that stands for a blank in pieces, and all texts of other models, are encoded whole.
    """

    def __init__(self, model: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.memo, self.counts = Memo(), np.zeros(0, np.int64)
        all_pieces = [self.model.id_to_piece(i) for i in range(self.model.vocab_size())]
        probe = "ﬁ ①　x"
        self.by_word = (not any("▁" in p.lstrip("▁") for p in all_pieces)
                        and self.model.normalize(probe) == "▁" + probe.replace(" ", "▁"))

    def _whole(self, texts: list[str]) -> list[int]:
        return [len(ids) for ids in self.model.encode(texts, num_threads=1)]

    def count(self, texts: pa.Array) -> np.ndarray:
        out = [np.zeros(0, np.int64)]
        for _, data, offsets in pieces(texts):
            n = len(offsets) - 1
            blank = data == 32
            starts, ends, owner = spans(~blank, offsets)
            # A text is odd if it has more blanks than one between each two words.
            blanks = np.concatenate(([0], np.cumsum(blank)))
            words = np.bincount(owner, minlength=n)
            odd = blanks[offsets[1:]] - blanks[offsets[:-1]] != np.maximum(words - 1, 0)
            raw = data.tobytes()
            place = raw.find(BLANK)
            while place >= 0:
                odd[np.searchsorted(offsets, place, "right") - 1] = True
                place = raw.find(BLANK, place + len(BLANK))
            if not self.by_word:
                odd[:] = True
            fine = ~odd[owner]
            starts, ends, owner = starts[fine], ends[fine], owner[fine]
            hashes, place, which = np.unique(word_hashes(data, starts, ends), return_index=True, return_inverse=True)

            def add(new, first):
                counts = self._whole([raw[starts[i]: ends[i]].decode() for i in place[new]])
                self.counts = np.concatenate((self.counts[:first], np.array(counts, np.int64)))

            rows = self.memo.look_up(hashes, add)
            total = np.bincount(owner, self.counts[rows][which] if len(rows) else None, n).astype(np.int64)
            for i in np.flatnonzero(odd):
                total[i] = self._whole([raw[offsets[i]: offsets[i + 1]].decode()])[0]
            out.append(total)
        return np.concatenate(out)


class LibraryCounter:
    """Counts tokens as the tokenizers library does, special tokens not added."""

    def __init__(self, model: bytes):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_str(model.decode())
        self.model.no_truncation()
        self.model.no_padding()

    def count(self, texts: pa.Array) -> np.ndarray:
        return np.array([len(self.model.encode(t or "", add_special_tokens=False).ids) for t in texts.to_pylist()], np.int64)


@cache
def _counter(kind: str, model: bytes):
    return PieceCounter(model) if kind == ".model" else LibraryCounter(model)


def digest(text) -> F.Column:
    """Digest of a content; a null one counts as empty."""
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def token_counts(spark: SparkSession, docs: DataFrame, model_path: str, cache_path: str) -> DataFrame:
    """docs (doc_id, text, ...) → (doc_id, n_bytes, n_tokens, over_limit), one row per row of ``docs``.

    Null and empty texts have 0 bytes and 0 tokens, a null doc_id stays, repeated rows and equal texts are encoded once.
    Other columns are ignored. ``model_path`` is a .json of tokenizers or a .model of sentencepiece on the driver; its
    content travels with the job.
    """
    model = Path(model_path).read_bytes()
    kind = Path(model_path).suffix
    folder = f"{cache_path}/version={hashlib.sha256(model).hexdigest()}"
    held = spark.sparkContext.broadcast(model)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(kind, held.value)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counter.count(batch.column(1)), pa.int64())],
                                             names=["digest", "n_tokens"])

    # Equal contents fall together before the shuffle, so a content that fills the table is one row per task.
    contents = docs.select(digest(F.col("text")).alias("digest"),
                           F.coalesce("text", F.lit("")).alias("content")).dropDuplicates(["digest"])
    if path_exists(spark, folder):
        contents = contents.join(_cached(spark, folder), "digest", "left_anti")
    contents.select("digest", "content").mapInArrow(encode, CACHE).write.mode("append").parquet(folder)

    rows = docs.select("doc_id", digest(F.col("text")).alias("digest"),
                       F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    return (rows.join(_cached(spark, folder), "digest")
            .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit")))


def _cached(spark: SparkSession, folder: str) -> DataFrame:
    """Two jobs may have appended the same content; it counts once."""
    return spark.read.schema(CACHE).parquet(folder).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
