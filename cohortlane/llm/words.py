"""Words of whole texts as numpy arrays: one 64-bit name per word, for many documents at once.

Used inside tasks by the operators on shingles and on repeated passages. Names depend on the bytes
of the word alone, so equal words get equal names in every task and every run.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Words are separated by these bytes.
SPACES = b" \t\n\x0b\x0c\r"
#: Documents are taken together until their texts have this many bytes; a longer one comes alone.
CHUNK_BYTES = 1 << 20

_U64 = np.uint64
_GOLD = _U64(0x9E3779B97F4A7C15)
#: Factor of the hash of word sequences; odd, so that it has an inverse.
_FACTOR = 0xD6E8FEB86659FD93
_POSITIONS = 64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits in which every input bit reaches every output bit."""
    x = x.astype(_U64, copy=True)
    x ^= x >> _U64(30)
    x *= _U64(0xBF58476D1CE4E5B9)
    x ^= x >> _U64(27)
    x *= _U64(0x94D049BB133111EB)
    x ^= x >> _U64(31)
    return x


def _byte_table() -> np.ndarray:
    """A random number for every byte at every of 64 places within a word."""
    return mix(np.arange(1, _POSITIONS * 256 + 1, dtype=_U64) * _GOLD)


_TABLE = _byte_table()
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@dataclass
class Words:
    """names: one per word; first: where each document's words begin, with their number at the end."""

    names: np.ndarray
    first: np.ndarray

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def words_of(data: np.ndarray, offsets: np.ndarray, lower: bool) -> Words:
    """The words of the documents data[offsets[i]:offsets[i + 1]], UTF-8 bytes."""
    base, end = int(offsets[0]), int(offsets[-1])
    data = data[base:end]
    offsets = offsets.astype(np.int64) - base
    if not len(data):
        return Words(np.zeros(0, _U64), np.zeros(len(offsets), np.int64))
    inside = ~_IS_SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    borders = offsets[:-1]
    borders = borders[borders < len(data)]
    begins[borders] = inside[borders]
    starts = np.flatnonzero(begins)
    first = np.searchsorted(starts, offsets)
    if not len(starts):
        return Words(np.zeros(0, _U64), first)
    where = np.flatnonzero(inside)
    word = np.cumsum(begins)[where] - 1
    place = where - starts[word]
    letters = data[where]
    if lower:
        letters = _LOWER[letters]
    values = _TABLE[((place & (_POSITIONS - 1)) << 8) | letters]
    if len(place) and place.max() >= _POSITIONS:
        values *= ((place // _POSITIONS) * 2 + 1).astype(_U64)
    length = np.bincount(word, minlength=len(starts))
    sums = np.add.reduceat(values, np.concatenate(([0], np.cumsum(length)[:-1])))
    return Words(mix(sums + length.astype(_U64) * _GOLD), first)


def chunks(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(from, to, data, offsets) of neighbouring documents; a null text is empty."""
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    _, at, data = texts.buffers()
    offsets = np.frombuffer(at, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    i = 0
    while i < len(texts):
        j = int(np.searchsorted(offsets, offsets[i] + CHUNK_BYTES, "right")) - 1
        j = min(max(j, i + 1), len(texts))
        yield i, j, raw, offsets[i : j + 1]
        i = j


def gram_names(names: np.ndarray, n: int) -> np.ndarray:
    """Names of all runs of n words, whichever documents they lie in; empty if there are fewer."""
    count = len(names) - n + 1
    if count <= 0:
        return np.zeros(0, _U64)
    total = np.zeros(count, _U64)
    for j in range(n):
        total *= _U64(_FACTOR)
        total += names[j : j + count]
    return mix(total)


class Ranges:
    """Names of any runs of words in constant time each, by sums of prefixes."""

    def __init__(self, names: np.ndarray, factor: int = _FACTOR):
        n = len(names)
        inverse = pow(factor, -1, 1 << 64)
        self._back = np.cumprod(np.concatenate(([_U64(1)], np.full(n, inverse, _U64))), dtype=_U64)
        ahead = np.cumprod(np.concatenate(([_U64(1)], np.full(n, factor, _U64))), dtype=_U64)
        self._sums = np.concatenate(([_U64(0)], np.cumsum(names * ahead[:n], dtype=_U64)))

    def name(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Of the words from start up to end, exclusive; the length counts too."""
        raw = (self._sums[end] - self._sums[start]) * self._back[start]
        return mix(raw + (end - start).astype(_U64) * _GOLD)
