"""Byte-pair encoding and decoding by an automaton that is compiled from the list of merges.

*Compilation.* The automaton reads tokens and accepts exactly the sequences that byte-pair encoding can give. It starts
with one state per byte and an arc for every byte everywhere. Merges are then put in one after another, each by a gadget
for u v → w: wherever an arc u starts, an arc w is added; a state w is made that continues like the state v does at that
moment; and the arc v out of the state u goes away, since from now on w stands for it. After the last merge an arc x out
of a state t exists exactly if no step of that history took it away. The history is kept instead of the arcs: per token
the step that made it and its two parts, and a table of the arcs that steps took away. An arc is looked up by going back
from the later of t and x to the part it was made from.

*Encoding.* A text is split as the tokenizer's pre-tokenizer does. A word's encoding is the one path that spells it, and
the encoding of each prefix is a prefix of that path. So the table-driven run over a word finds, for every byte, the one
token that ends there and has an arc from the token before it. All distinct words of a piece of text run side by side.

*Decoding.* The arcs' labels, which are the tokens' bytes, are emitted one after another.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .spans import Memo, pieces, word_hashes

#: Unicode's White_Space characters, which the pre-tokenizer takes for blanks.
WHITE = (*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
#: Letters after an apostrophe that make a word of their own.
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")
OTHER, LETTER, NUMBER, BLANK, UNSURE = range(5)
#: Texts are encoded in pieces of about this many bytes; a step holds some ninety bytes of numbers for each of them.
ENCODED = 1 << 18


def byte_letters() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@cache
def character_classes() -> np.ndarray:
    """Class of every code point. Where versions of Unicode disagree it is UNSURE, and the library splits the text."""
    import unicodedata

    old = unicodedata.ucd_3_2_0
    out = np.zeros(0x110000, np.uint8)
    kinds = {"L": LETTER, "N": NUMBER}
    for c in range(0x110000):
        now, then = unicodedata.category(chr(c)), old.category(chr(c))
        out[c] = kinds.get(now[0], OTHER) if now == then and now != "Cn" else UNSURE
    out[list(range(0x1C, 0x20)) + [0x180E]] = UNSURE
    out[list(WHITE)] = BLANK
    return out


class Automaton:
    def __init__(self, source: str):
        """``source`` is the JSON of a byte-level BPE of the tokenizers library."""
        from tokenizers import Tokenizer

        parsed = json.loads(source)
        model, pre = parsed["model"], parsed["pre_tokenizer"]
        if model["type"] != "BPE" or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or parsed["normalizer"]:
            raise ValueError("a byte-level BPE without normalizer and prefix space is needed")
        letters = byte_letters()
        vocabulary = model["vocab"]
        size = max(vocabulary.values()) + 1
        self.special = {t["content"]: t["id"] for t in parsed["added_tokens"]}
        self.library = Tokenizer.from_str(source)
        self.library.no_truncation()
        self.library.no_padding()
        size = max(size, *(i + 1 for i in self.special.values())) if self.special else size
        labels = [b""] * size
        for token, i in vocabulary.items():
            labels[i] = bytes(letters[c] for c in token)
        for token, i in self.special.items():
            labels[i] = token.encode()
        self.label_at = np.concatenate(([0], np.cumsum([len(x) for x in labels])))
        self.label_bytes = np.frombuffer(b"".join(labels), np.uint8)

        # The gadgets, in order: when a token is made and of which parts, and which arc goes away then.
        self.made = np.full(size, -1, np.int64)
        self.left, self.right = np.zeros(size, np.int64), np.zeros(size, np.int64)
        gone = {}
        for step, merge in enumerate(model["merges"]):
            u, v = merge if isinstance(merge, list) else merge.split(" ")
            a, b, w = vocabulary[u], vocabulary[v], vocabulary[u + v]
            if self.made[w] >= 0:
                raise ValueError("a token that two merges make has no state of its own")
            self.made[w], self.left[w], self.right[w] = step, a, b
            gone[a << 32 | b] = step
        keys = np.array(sorted(gone), np.int64)
        self.gone_bits = 20
        self.gone_keys, self.gone_step = self._table(keys, np.array([gone[k] for k in keys], np.int64))

        # A trie of the labels of all tokens that encoding can give: next node by (node, byte), token by node.
        nodes, ends = [{}], [-1]
        for token, i in vocabulary.items():
            if self.made[i] < 0 and len(labels[i]) != 1:
                continue
            at = 0
            for byte in labels[i]:
                if byte not in nodes[at]:
                    nodes[at][byte] = len(nodes)
                    nodes.append({})
                    ends.append(-1)
                at = nodes[at][byte]
            ends[at] = i
        self.next = np.zeros((len(nodes), 256), np.int32)
        for at, out in enumerate(nodes):
            for byte, to in out.items():
                self.next[at, byte] = to
        self.token = np.array(ends, np.int64)
        self.memo = Memo()
        self.ids, self.id_at = np.zeros(0, np.int32), np.zeros(1, np.int64)

    # ---- the arcs that went away: open addressing, so that many are looked up at once

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.gone_bits)).astype(np.int64)

    def _table(self, keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = 1 << self.gone_bits
        slots, steps = np.full(size, -1, np.int64), np.full(size, -1, np.int64)
        for key, value, at in zip(keys.tolist(), values.tolist(), self._slot(keys).tolist()):
            while slots[at] >= 0:
                at = (at + 1) % size
            slots[at], steps[at] = key, value
        return slots, steps

    def _step_of(self, keys: np.ndarray) -> np.ndarray:
        """The step at which each arc went away; beyond all steps if it never did."""
        out = np.full(len(keys), 1 << 40, np.int64)
        todo, at = np.arange(len(keys)), self._slot(keys)
        while len(todo):
            held = self.gone_keys[at]
            hit = held == keys[todo]
            out[todo[hit]] = self.gone_step[at[hit]]
            on = ~hit & (held >= 0)
            todo, at = todo[on], (at[on] + 1) & ((1 << self.gone_bits) - 1)
        return out

    def arcs(self, t: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Whether an arc x leaves the state t in the finished automaton."""
        out = np.ones(len(t), bool)
        todo = np.arange(len(t))
        t, x, before = t.copy(), x.copy(), np.full(len(t), 1 << 40, np.int64)
        while len(todo):
            kept = self._step_of(t << 32 | x) >= before
            out[todo[~kept]] = False
            made_t, made_x = self.made[t], self.made[x]
            on = kept & ((made_t >= 0) | (made_x >= 0))
            todo, t, x, made_t, made_x = todo[on], t[on], x[on], made_t[on], made_x[on]
            # A state began like that of its right part, before its own step; an arc came where that of its left part
            # was after the step, so that of three equal tokens the first two merge.
            state = made_t > made_x
            before = np.where(state, made_t, made_x + 1)
            t, x = np.where(state, self.right[t], t), np.where(state, x, self.left[x])
        return out

    def run(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all words data[start:end], one word after another, and how many each has."""
        lengths = ends - starts
        order = np.argsort(-lengths, kind="stable")
        begin, long = starts[order], lengths[order]
        base = np.concatenate(([0], np.cumsum(long)))
        last = np.zeros(base[-1], np.int64)      # token that ends at each byte of each word
        words, froms, nodes = (np.zeros(0, np.int64) for _ in range(3))
        for i in range(int(long[0]) if len(long) else 0):
            n = int(np.searchsorted(-long, -i, "left"))  # words with a byte at i
            alive = words < n
            words = np.concatenate((words[alive], np.arange(n)))
            froms = np.concatenate((froms[alive], np.full(n, i)))
            nodes = np.concatenate((nodes[alive], np.zeros(n, np.int64)))
            nodes = self.next[nodes, data[begin[words] + i]].astype(np.int64)
            alive = nodes > 0
            words, froms, nodes = words[alive], froms[alive], nodes[alive]
            token = self.token[nodes]
            some = np.flatnonzero(token >= 0)
            w, f, token = words[some], froms[some], token[some]
            inner = np.flatnonzero(f > 0)
            fits = np.ones(len(some), bool)
            fits[inner] = self.arcs(last[base[w[inner]] + f[inner] - 1], token[inner])
            last[base[w[fits]] + i] = token[fits]
        # Back from the ends of the words, token by token.
        counts = np.zeros(len(long), np.int64)
        out = []
        at, todo = long.copy(), np.flatnonzero(long > 0)
        while len(todo):
            token = last[base[todo] + at[todo] - 1]
            out.append((todo, token))
            counts[todo] += 1
            at[todo] -= self.label_at[token + 1] - self.label_at[token]
            todo = todo[at[todo] > 0]
        given = np.zeros(len(order), np.int64)
        given[order] = counts
        first = np.concatenate(([0], np.cumsum(given)))
        ids = np.zeros(first[-1], np.int32)
        for step, (which, token) in enumerate(out):
            ids[first[order[which]] + counts[which] - 1 - step] = token
        return ids, given

    # ---- splitting

    def split(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, dict[int, int]]:
        """First bytes of all words, and {first byte: id} of special tokens among them. Words fill the texts."""
        raw = data.tobytes()
        points = np.frombuffer(raw.decode().encode("utf-32-le"), np.uint32).astype(np.int64)
        at = np.flatnonzero((data & 0xC0) != 0x80)
        kind = character_classes()[points]
        n = len(points)
        text_start = np.zeros(n + 1, bool)
        borders = np.searchsorted(at, offsets)
        text_start[borders] = True
        begins = text_start[:-1].copy()
        same = np.zeros(n, bool)
        same[1:] = ~text_start[1:n] & (kind[1:] == kind[:-1])
        begins |= ~same
        after_blank = np.zeros(n, bool)  # a blank before a word belongs to it
        after_blank[1:] = ~text_start[1:n] & (points[:-1] == 32) & (kind[1:] != BLANK)
        begins &= ~after_blank
        # The last blank before something else stands alone or with what follows.
        tail = np.zeros(n, bool)
        tail[:-1] = (kind[:-1] == BLANK) & (kind[1:] != BLANK) & ~text_start[1:n]
        begins |= tail
        # An apostrophe that begins a word takes some endings with it.
        for i in np.flatnonzero((points == 39) & begins):
            for ending in ENDINGS:
                stop = i + 1 + len(ending)
                if stop <= n and not text_start[i + 1: stop].any() and all(points[i + 1 + k] == ord(c) for k, c in enumerate(ending)):
                    begins[i + 1] = False
                    if stop < n and kind[stop] == LETTER and not text_start[stop]:
                        begins[stop] = True
                    break
        special: dict[int, int] = {}
        unsure = {int(i) for i in np.searchsorted(borders, np.flatnonzero(kind == UNSURE), "right") - 1}
        for token in self.special:
            place = raw.find(token.encode())
            while place >= 0:
                unsure.add(int(np.searchsorted(offsets, place, "right")) - 1)
                place = raw.find(token.encode(), place + 1)
        starts = at[begins]
        if unsure:
            own = np.searchsorted(offsets, starts, "right") - 1
            parts = [starts[~np.isin(own, list(unsure))]]
            for i in unsure:
                parts.append(self._library_split(raw[offsets[i]: offsets[i + 1]], int(offsets[i]), special))
            starts = np.sort(np.concatenate(parts))
        return starts, special

    def _library_split(self, raw: bytes, shift: int, special: dict[int, int]) -> np.ndarray:
        """First bytes of the words of a text as the library splits it; each part of the text is decoded once."""
        cuts = []
        for token in self.special:
            place = raw.find(token.encode())
            while place >= 0:
                cuts.append((place, -len(token), token))
                place = raw.find(token.encode(), place + 1)
        starts, done = [], 0
        for place, _, token in [*sorted(cuts), (len(raw), 0, "")]:
            if place < done:
                continue
            if place > done:
                text = raw[done:place].decode()
                # Where each character begins.
                at = np.append(np.flatnonzero((np.frombuffer(raw, np.uint8)[done:place] & 0xC0) != 0x80), place - done)
                starts += [shift + done + int(at[a]) for _, (a, _) in self.library.pre_tokenizer.pre_tokenize_str(text)]
            if token:
                special[shift + place] = self.special[token]
                starts.append(shift + place)
            done = place + len(token.encode())
        return np.array(sorted(set(starts)), np.int64)

    # ---- texts

    def encode(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Per piece of texts: all ids, and where each text's ids begin (one more than texts)."""
        for _, data, offsets in pieces(texts, ENCODED):
            if not len(data):
                yield np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
                continue
            starts, special = self.split(data, offsets)
            ends = np.append(starts[1:], len(data))
            hashes = word_hashes(data, starts, ends)
            if special:  # a special token isn't the word that is spelled the same
                marks = np.searchsorted(starts, sorted(special))
                hashes[marks] ^= np.uint64(0x5851F42D4C957F2D)
            distinct, place, which = np.unique(hashes, return_index=True, return_inverse=True)

            def add(new, first):
                a, b = starts[place[new]], ends[place[new]]
                marked = np.array([special.get(int(s), -1) for s in a]) if special else np.full(len(new), -1)
                ids, counts = self.run(data, a, np.where(marked >= 0, a, b))
                if special:
                    at = (np.cumsum(counts) - counts)[marked >= 0]
                    ids = np.insert(ids, at, marked[marked >= 0]).astype(np.int32)
                    counts = counts + (marked >= 0)
                self.ids = np.concatenate((self.ids[: self.id_at[first]], ids))
                self.id_at = np.concatenate((self.id_at[: first + 1], self.id_at[first] + np.cumsum(counts)))

            rows = self.memo.look_up(distinct, add)[which]
            counts = self.id_at[rows + 1] - self.id_at[rows]
            total = np.concatenate(([0], np.cumsum(counts)))
            ids = self.ids[np.arange(total[-1]) + np.repeat(self.id_at[rows] - total[:-1], counts)]
            yield ids, total[np.searchsorted(starts, offsets)]

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes that the arcs emit, and where each token's bytes begin."""
        ids = ids.astype(np.int64)
        counts = self.label_at[ids + 1] - self.label_at[ids]
        total = np.concatenate(([0], np.cumsum(counts)))
        return self.label_bytes[np.arange(total[-1]) + np.repeat(self.label_at[ids] - total[:-1], counts)], total


@cache
def automaton(source: str) -> Automaton:
    return Automaton(source)


def decode_text(raw: bytes) -> bytes:
    """Bytes that are no UTF-8 become replacement characters."""
    return raw.decode("utf-8", "replace").encode()


def bpe_round_trip(docs: DataFrame, tokenizer_path: str, with_ids: bool = False) -> DataFrame:
    """docs (doc_id, text, ...) → (doc_id, n_tokens, ids_sha256, decoded_sha256[, ids]), one row per row of ``docs``.

    ids are hashed as little-endian unsigned 32-bit numbers. Null and empty texts have no tokens. A null doc_id stays,
    and repeated rows stay. Other columns are ignored. The file at ``tokenizer_path`` is read on the driver.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        held = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(held.value)
        for batch in batches:
            done = 0
            for ids, first in machine.encode(batch.column(1)):
                decoded, byte_at = machine.decode(ids)
                n = len(first) - 1
                ids_hash, text_hash, kept = [], [], []
                for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
                    ids_hash.append(hashlib.sha256(ids[a:b].astype("<u4").tobytes()).hexdigest())
                    text_hash.append(hashlib.sha256(decode_text(decoded[byte_at[a]: byte_at[b]].tobytes())).hexdigest())
                columns = [batch.column(0).slice(done, n), pa.array(np.diff(first), pa.int64()), pa.array(ids_hash, pa.string()),
                           pa.array(text_hash, pa.string())]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(ids, pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)
                done += n

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def token_ids(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """docs (doc_id, text, ...) → (doc_id, ids), one row per row of ``docs``: the encoding half of ``bpe_round_trip``."""
    with open(tokenizer_path, encoding="utf-8") as file:
        held = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(held.value)
        for batch in batches:
            done = 0
            for ids, first in machine.encode(batch.column(1)):
                n = len(first) - 1
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(done, n), pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(ids, pa.int32()))],
                    names=["doc_id", "ids"])
                done += n

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, ids array<int>")
