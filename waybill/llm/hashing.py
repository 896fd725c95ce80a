"""Words and Rabin-Karp window hashes of whole Arrow batches, vectorised in numpy.

A word is a run of bytes other than ASCII white space; UTF-8 keeps those bytes to
themselves, so bytes and code points give the same words. Hashes are 64 bits wide:
polynomials modulo 2**64 over random byte values, then mixed. Such polynomials fail on long
texts of a certain make (a Thue-Morse word of 1024 letters and its complement are equal), so words
of more than 64 bytes are hashed by xxh3; windows have fewer words than that. Among N
different windows about N * N / 2**65 pairs share a hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash

BLOCK_BYTES = 2_000_000
# Words of more bytes than this are hashed one by one.
_LONG_WORD = 64
_BASE, _WORD_BASE = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95  # odd, so both have inverses


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@cache
def _powers(base: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i below 2**bits."""
    def run(b: int) -> np.ndarray:
        out = np.full(1 << bits, b, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    return run(base), run(pow(base, -1, 1 << 64))


def _polynomials(values: np.ndarray, base: int, starts, ends) -> np.ndarray:
    """Hash of values[start:end] for each pair, independent of where it stands."""
    up, down = _powers(base, max(21, int(len(values)).bit_length()))
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return (sums[ends] - sums[starts]) * down[starts]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column, and where each text starts (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset:][: len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0]: at[-1]], at - at[0]


class Block:
    """Some consecutive documents: ``first`` is the first one's place in the batch,
    ``count`` the words of each, ``start`` the place of each one's first word,
    ``begin`` and ``end`` the byte range of each word, ``hash`` its hash."""

    def __init__(self, first: int, data: np.ndarray, at: np.ndarray, lower: bool):
        self.first, self.size = first, len(at) - 1
        data = _LOWER[data] if lower else data
        word = ~_BLANK[data]
        fresh = np.zeros(len(data) + 1, bool)  # a text starts here
        fresh[at] = True
        before = np.zeros(len(data), bool)
        before[1:] = word[:-1]
        self.begin = np.flatnonzero(word & (~before | fresh[:-1]))
        after = np.zeros(len(data), bool)
        after[:-1] = word[1:]
        self.end = np.flatnonzero(word & (~after | fresh[1:])) + 1
        self.start = np.searchsorted(self.begin, at)
        self.count = np.diff(self.start)
        raw = _polynomials(_VALUES[data], _BASE, self.begin, self.end)
        size = self.end - self.begin
        self.hash = mixed(raw + size.astype(np.uint64))
        for word in np.flatnonzero(size > _LONG_WORD):
            spelled = data[self.begin[word]: self.end[word]].tobytes()
            self.hash[word] = xxhash.xxh3_64_intdigest(spelled)
        self.data, self.at = data, at

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of every window of ``size`` words and the place of its first word."""
        place = np.arange(len(self.hash))
        inside = place + size <= np.repeat(self.start[1:], self.count)
        place = place[inside]
        return self.spans(place, place + size), place

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = _polynomials(self.hash, _WORD_BASE, starts, ends)
        return mixed(raw ^ mixed((ends - starts).astype(np.uint64)))

    def owner(self, places: np.ndarray) -> np.ndarray:
        """Document, counted in the block, of each word place."""
        return np.searchsorted(self.start, places, "right") - 1


def blocks(texts: pa.Array, lower: bool = False, size: int = BLOCK_BYTES) -> Iterator[Block]:
    """The texts in blocks of about ``size`` bytes, one document at least."""
    data, at = utf8(texts)
    first, rows = 0, len(at) - 1
    while first < rows:
        last = max(first + 1, int(np.searchsorted(at, at[first] + size, "right")) - 1)
        yield Block(first, data[at[first]: at[last]], at[first: last + 1] - at[first], lower)
        first = last
