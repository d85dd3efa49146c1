"""Words of many texts at once: where they stand and a 64-bit hash of each, with numpy over the raw bytes."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa

#: Texts are worked on in pieces of about this many bytes (a longer text is a piece of its own), which bounds memory.
PIECE = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
#: The bytes that separate words.
BLANKS = b" \t\n\x0b\x0c\r"


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x ^ (x >> np.uint64(31))


#: Mixed numbers of each byte at the first 64 places of a word.
NEAR = mix(np.arange(64 << 8))


@cache
def powers(factor: int, bits: int) -> np.ndarray:
    out = np.full(1 << bits, np.uint64(factor), np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def byte_table(members: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(members)] = True
    return out


IS_BLANK = byte_table(BLANKS)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def pieces(texts: pa.Array, size: int = PIECE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Yields (first text, bytes, offsets of the texts in them, one more than texts). A null text is empty."""
    texts = texts.fill_null("") if texts.null_count else texts
    if not len(texts):
        return
    width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    offsets = np.frombuffer(texts.buffers()[1], width)[texts.offset: texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        yield first, data[offsets[first]: offsets[last]], offsets[first: last + 1] - offsets[first]
        first = last


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of True that do not cross the border of a text: (starts, ends, text numbers)."""
    starts, following = inside.copy(), np.append(inside, False)
    starts[1:] &= ~inside[:-1]
    borders = offsets[offsets < len(inside)]
    starts[borders] = inside[borders]
    following[offsets] = False
    starts = np.flatnonzero(starts)
    ends = np.flatnonzero(inside & ~following[1:]) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of data[start:end] for every span, from running sums of byte times power."""
    bits = max(12, int(len(data)).bit_length())
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(int(BASE), bits)[: len(data)], out=total[1:])
    value = (total[ends] - total[starts]) * powers(int(BASE_INVERSE), bits)[starts]
    return mix(value ^ ((ends - starts).astype(np.uint64) << np.uint64(40)))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of data[start:end] for spans that rise and do not overlap: the sum of a mixed number per byte and place.

    Other than a polynomial modulo 2^64, whose terms cancel out for some long words of two letters, every place has numbers of
    its own, so two different words agree with a chance of 2^-64.
    """
    lengths = ends - starts
    first = np.concatenate(([0], np.cumsum(lengths)))
    place = np.arange(first[-1]) - np.repeat(first[:-1], lengths)
    at = (place << 8) | data[np.repeat(starts, lengths) + place]
    value = NEAR[np.minimum(at, len(NEAR) - 1)]
    far = np.flatnonzero(at >= len(NEAR))
    value[far] = mix(at[far])
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(value, dtype=np.uint64)))
    return mix((total[first[1:]] - total[first[:-1]]) ^ (lengths.astype(np.uint64) << np.uint64(40)))


def windows(words: np.ndarray, owner: np.ndarray, n_texts: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of ``width`` words, and their texts; a text with fewer words has one window, all of it."""
    factors = mix(np.arange(1, width + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)
    counts = np.bincount(owner, minlength=n_texts)
    out, owners = [], []
    if len(words) >= width:
        whole = owner[: len(owner) - width + 1] == owner[width - 1:]
        value = np.zeros(len(words) - width + 1, np.uint64)
        for k in range(width):
            value += words[k: len(words) - width + 1 + k] * factors[k]
        out.append(mix(value[whole]))
        owners.append(owner[: len(owner) - width + 1][whole])
    short = (counts > 0) & (counts < width)
    at = short[owner]
    if at.any():
        first = np.concatenate(([0], np.cumsum(counts)))[owner[at]]
        value = words[at] * factors[np.flatnonzero(at) - first]
        texts = np.flatnonzero(short)
        sums = np.zeros(n_texts, np.uint64)
        np.add.at(sums, owner[at], value)
        out.append(mix(sums[texts] + counts[texts].astype(np.uint64) * np.uint64(0xA0761D6478BD642F)))
        owners.append(texts)
    if not out:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(out), np.concatenate(owners)


def shingle_sets(texts: pa.Array, width: int = 5) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Per piece: (first text, number of texts, distinct shingle hashes rising within each text, their texts)."""
    for first, data, offsets in pieces(texts):
        lowered = LOWER[data]
        starts, ends, owner = spans(~IS_BLANK[lowered], offsets)
        values, owner = windows(word_hashes(lowered, starts, ends), owner, len(offsets) - 1, width)
        order = np.lexsort((values, owner))
        values, owner = values[order], owner[order]
        fresh = np.ones(len(values), bool)
        fresh[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
        yield first, len(offsets) - 1, values[fresh], owner[fresh]


class Memo:
    """Remembers a row number for each hash it has seen; starts anew beyond ``most`` hashes, which bounds memory.

    ``grow(rows)`` is told how many rows there are before the new ones, and 0 at a new start.
    """

    def __init__(self, most: int = 1 << 21):
        self.most, self.keys, self.rows = most, np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def look_up(self, hashes: np.ndarray, add) -> np.ndarray:
        """Row of every one of the distinct ``hashes``; ``add(places, first_row)`` makes rows for those not seen yet."""
        if len(self.keys) + len(hashes) > self.most:
            self.__init__(self.most)
        at = np.searchsorted(self.keys, hashes)
        known = np.zeros(len(hashes), bool)
        if len(self.keys):
            known = self.keys[np.minimum(at, len(self.keys) - 1)] == hashes
        out = np.empty(len(hashes), np.int64)
        out[known] = self.rows[at[known]]
        new = np.flatnonzero(~known)
        if len(new):
            first = len(self.keys)
            add(new, first)
            out[new] = first + np.arange(len(new))
            keys = np.concatenate((self.keys, hashes[new]))
            order = np.argsort(keys, kind="stable")
            self.keys, self.rows = keys[order], np.concatenate((self.rows, out[new]))[order]
        return out
