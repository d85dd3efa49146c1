import fnmatch
import hashlib
import os
import random

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from helpers import documents, LONG, SCHEMA, TEXTS
from tidegate.llm.bpe_automaton import Automaton, automaton, bpe_round_trip
from tidegate.llm.token_counts import _cached, token_counts
from tidegate.llm.training_order import (IDS, _numbers_between, index_of, read_training_order, slot_of, training_order, write_training_order)

BPE, PIECES = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


def test_round_trip_equals_the_library(spark):
    tokenizer = Tokenizer.from_file(BPE)
    got = bpe_round_trip(documents(spark), BPE).collect()
    want = []
    for i, text in TEXTS:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(decoded.encode()).hexdigest()))
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert bpe_round_trip(spark.createDataFrame([], SCHEMA), BPE).collect() == []


def test_random_texts_equal_the_library():
    rng = random.Random(5)
    alphabets = ("aeb 's\n\t.1é't<|日  ", "abcdehilnorst", "a ", "'sdtrelvm x", " \n\t\r ")
    texts = ["".join(rng.choice(a) for _ in range(rng.randint(0, 50))) for a in alphabets for _ in range(300)]
    texts += ["".join(chr(rng.choice([rng.randint(0, 0x24FF), rng.randint(0x3000, 0xD7FF), rng.randint(0x1F300, 0x1F9FF)]))
                      for _ in range(20)) for _ in range(300)]
    with open(BPE, encoding="utf-8") as file:
        machine = automaton(file.read())
    tokenizer, at = Tokenizer.from_file(BPE), 0
    for ids, first in machine.encode(pa.array(texts)):
        for a, b in zip(first[:-1], first[1:]):
            assert ids[a:b].tolist() == tokenizer.encode(texts[at], add_special_tokens=False).ids, repr(texts[at])
            at += 1
    assert at == len(texts)


def test_a_tokenizer_of_another_kind_is_refused():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        with pytest.raises((ValueError, KeyError, TypeError)):
            Automaton(file.read())


def test_token_counts_and_the_cache(spark, tmp_path):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    key = lambda r: (r[0] is None, r[0] or 0)
    got = sorted(map(tuple, token_counts(spark, documents(spark), PIECES, str(tmp_path)).collect()), key=key)
    want = [(i, len((t or "").encode()), n := len(model.encode(t or "")), n > 4096) for i, t in TEXTS]
    assert got == sorted(want, key=key)
    folder = next(str(p) for p in tmp_path.iterdir())
    held = _cached(spark, folder).count()
    assert held == len({t or "" for _, t in TEXTS})
    # The second run encodes what is new and nothing else.
    more = spark.createDataFrame([(1, "brand new text"), (2, TEXTS[0][1])], SCHEMA)
    assert token_counts(spark, more, PIECES, str(tmp_path)).count() == 2
    assert spark.read.parquet(folder).count() == held + 1
    assert token_counts(spark, spark.createDataFrame([], SCHEMA), PIECES, str(tmp_path)).collect() == []


def test_counts_of_a_json_tokenizer(spark, tmp_path):
    rows = [(1, "Hello there, General"), (2, None)]
    path = public_tokenizers.path("word_bpe_49k.json")
    want = len(Tokenizer.from_file(path).encode("Hello there, General", add_special_tokens=False).ids)
    got = token_counts(spark, spark.createDataFrame(rows, SCHEMA), path, str(tmp_path))
    assert {r.doc_id: r.n_tokens for r in got.collect()} == {1: want, 2: 0}


@pytest.mark.parametrize("n", [1, 2, 3, 5, 17, 256, 4097])
def test_slots_are_a_keyed_permutation(n):
    slots = slot_of(np.arange(n), n, 3)
    assert sorted(slots) == list(range(n))
    assert (index_of(slots, n, 3) == np.arange(n)).all()
    assert n < 17 or (slots != slot_of(np.arange(n), n, 4)).any()


def test_training_order_round_trip(spark, tmp_path):
    df = documents(spark)
    got = training_order(spark, df).collect()
    want = sorted((i is None, i or 0, k, hashlib.sha256(raw[k * IDS:(k + 1) * IDS]).hexdigest())
                  for i, t in TEXTS for raw in [(t or "").encode()] for k in range(-(-len(raw) // IDS)))
    assert sorted(r.slot for r in got) == list(range(len(want)))
    assert sorted((r.doc_id is None, r.doc_id or 0, r.part, r.ids_sha256) for r in got) == want
    # Resuming in the middle reads the same records.
    folder = str(tmp_path / "order")
    n = write_training_order(spark, df, folder, key=1, shard_slots=64)
    resumed = read_training_order(spark, folder, 100, 150, shard_slots=64).collect()
    by_slot = {r.slot: r.ids_sha256 for r in got}
    assert sorted(r.slot for r in resumed) == list(range(100, 250)) and n == len(want)
    assert all(by_slot[r.slot] == r.ids_sha256 for r in resumed)
    assert training_order(spark, spark.createDataFrame([(1, None), (2, "")], SCHEMA)).collect() == []
    assert LONG  # one text fills many sequences


def test_training_order_of_token_ids(spark):
    """Records hold the library's ids, in pieces, each document's in order."""
    tokenizer = Tokenizer.from_file(BPE)
    got = training_order(spark, documents(spark), tokenizer_path=BPE).collect()
    room = IDS // 2
    want = sorted((i is None, i or 0, k, hashlib.sha256(np.array(ids[k * room:(k + 1) * room], "<u2").tobytes()).hexdigest())
                  for i, t in TEXTS for ids in [tokenizer.encode(t or "", add_special_tokens=False).ids] for k in range(-(-len(ids) // room)))
    assert sorted((r.doc_id is None, r.doc_id or 0, r.part, r.ids_sha256) for r in got) == want
    assert sorted(r.slot for r in got) == list(range(len(want)))
    assert training_order(spark, spark.createDataFrame([], SCHEMA), tokenizer_path=BPE).collect() == []


@pytest.mark.parametrize("width", [1, 2, 4])
def test_ids_of_every_width_come_back(spark, tmp_path, width):
    rng = random.Random(width)
    top = min(2 ** (8 * width), 2 ** 31)
    rows = [(i, [rng.randrange(top) for _ in range(rng.choice((0, 1, 300, 2000)))] + [10, top - 1]) for i in range(40)]
    rows += [(900, []), (901, None)]
    df = spark.createDataFrame(rows, "doc_id long, tokens array<int>")
    folder = str(tmp_path / "order")
    n = write_training_order(spark, df, folder, shard_slots=16, ids="tokens", width=width)
    got = read_training_order(spark, folder, shard_slots=16, with_ids=True).collect()
    assert sorted(r.slot for r in got) == list(range(n))
    back = {}
    for r in sorted(got, key=lambda r: (r.doc_id, r.part)):
        back.setdefault(r.doc_id, []).extend(r.ids)
    assert back == {i: ids for i, ids in rows if ids}
    if width < 4:
        with pytest.raises(Exception, match="does not fit"):
            write_training_order(spark, spark.createDataFrame([(1, [top])], df.schema), folder, ids="tokens", width=width)


def test_resuming_opens_no_other_shards(spark, tmp_path):
    """Shards outside the slots asked for are made too long to be read."""
    folder = tmp_path / "order"
    rows = [(i, list(range(i % 7 + 1))) for i in range(400)]
    n = write_training_order(spark, spark.createDataFrame(rows, "doc_id long, ids array<int>"), str(folder), shard_slots=32, ids="ids")
    assert n == 400
    whole = {r.slot: r for r in read_training_order(spark, str(folder), shard_slots=32).collect()}
    for file in folder.glob("part-*"):
        if int(file.name[5:10]) not in (4, 5):
            os.truncate(file, 3 << 30)
    got = read_training_order(spark, str(folder), 130, 60, shard_slots=32).collect()
    assert {r.slot: r for r in got} == {s: whole[s] for s in range(130, 190)}
    assert read_training_order(spark, str(folder), 130, 0, shard_slots=32).collect() == []


def test_input_that_changes_after_the_count_stops_the_job(spark, tmp_path):
    def some(batches):
        for batch in batches:
            keep = np.random.default_rng().random(len(batch)) < 0.5
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(keep)), pa.array(["some"] * int(keep.sum()))], names=["doc_id", "text"])

    changing = spark.range(20_000, numPartitions=2).mapInArrow(some, "doc_id long, text string")
    with pytest.raises(Exception, match="store it first"):
        write_training_order(spark, changing, str(tmp_path / "order"))


def test_patterns_of_file_numbers():
    for low, high in ((0, 0), (3, 3), (0, 99_999), (7, 1234), (128, 10 ** 9), (99_990, 100_020), (5, 4)):
        names = _numbers_between(low, high)
        tried = {*range(0, 1500), *range(99_900, 100_100), 10 ** 9, 10 ** 9 + 1}
        assert all(any(fnmatch.fnmatchcase(f"{i:05d}", p) for p in names) == (low <= i <= high) for i in tried)
        assert len(names) < 120


def test_random_counts_equal_the_library():
    from tidegate.llm.token_counts import PieceCounter

    rng = random.Random(9)
    alphabets = ("ab ▁", "▁ \n", "a▁ 🙂é", "the of ▁x", " ab")
    texts = ["".join(rng.choice(a) for _ in range(rng.randint(0, 30))) for a in alphabets for _ in range(4000)]
    texts += ["▁ ▁", "a▁ 🙂", "▁ \n"]
    with open(PIECES, "rb") as file:
        got = PieceCounter(file.read()).count(pa.array(texts))
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    assert got.tolist() == [len(ids) for ids in model.encode(texts, num_threads=1)]


def test_words_whose_polynomial_hashes_agree_are_told_apart():
    """The sequence of Thue and Morse and its complement: all terms of a polynomial modulo 2^64 cancel out."""
    bits = [bin(n).count("1") % 2 for n in range(1024)]
    a, b = ("".join("ab"[x ^ flip] for x in bits) for flip in (0, 1))
    text = a + "\n" + b
    with open(BPE, encoding="utf-8") as file:
        machine = automaton(file.read())
    (ids, _), = machine.encode(pa.array([text]))
    assert ids.tolist() == Tokenizer.from_file(BPE).encode(text, add_special_tokens=False).ids


def test_a_long_text_that_the_library_splits(spark):
    """Emoji and special tokens in a text of a megabyte; the split takes time in proportion."""
    text = "some words, 🙂 and <|endoftext|> others é\n" * 24_000
    tokenizer = Tokenizer.from_file(BPE)
    got = bpe_round_trip(spark.createDataFrame([(1, text)], SCHEMA), BPE).first()
    ids = tokenizer.encode(text, add_special_tokens=False).ids
    assert got["n_tokens"] == len(ids) and got["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()


def test_texts_are_encoded_in_small_pieces():
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        machine = automaton(file.read())
    text = "some words of a text " * 100
    parts = list(machine.encode(pa.array([text] * 400)))
    assert len(parts) >= 3 and sum(len(first) - 1 for _, first in parts) == 400
    alone = next(machine.encode(pa.array([text])))[0].tolist()
    assert all(ids.tolist() == alone * (len(first) - 1) for ids, first in parts)
