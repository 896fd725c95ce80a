"""Whole Arrow batches as coded words, vectorised in numpy and Arrow.

A word is a run of bytes other than ASCII white space; UTF-8 keeps those bytes to
themselves, so bytes and code points give the same words. Words are coded by their
bytes, never by a hash, so equal codes are equal words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from waybill.llm.hashing import BLOCK_BYTES, utf8

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Words:
    """The words of some consecutive texts.

    ``first``: place of the first text in the batch; ``bounds``: places of each text's first
    word, and the end; ``codes``: word by word, a place in ``dictionary``; ``begin`` and
    ``end``: the bytes of ``data`` that are the word.
    """

    def __init__(self, first: int, data: np.ndarray, at: np.ndarray, lower: bool = False):
        self.first, self.size = first, len(at) - 1
        self.data = _LOWER[data] if lower else data
        inside = ~_BLANK[data]
        fresh = np.zeros(len(data) + 1, bool)  # a text starts here
        fresh[at] = True
        before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        self.begin = np.flatnonzero(inside & (~before | fresh[:-1]))
        self.end = np.flatnonzero(inside & (~after | fresh[1:])) + 1
        self.bounds = np.searchsorted(self.begin, at)
        offsets = np.zeros(len(self.begin) + 1, np.int64)
        np.cumsum(self.end - self.begin, out=offsets[1:])
        spelled = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(self.begin),
            [None, pa.py_buffer(offsets), pa.py_buffer(self.data[inside])],
        ).dictionary_encode()
        self.codes = spelled.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.dictionary = spelled.dictionary

    def joined(self, kept: np.ndarray) -> pa.Array:
        """Each text's words marked by ``kept``, joined by one blank."""
        owner = np.repeat(np.arange(self.size), np.diff(self.bounds))
        begin, end, owner = self.begin[kept], self.end[kept], owner[kept]
        gap = np.zeros(len(owner), np.int64)  # a blank follows, unless the text ends
        gap[:-1] = owner[1:] == owner[:-1]
        width = end - begin + gap
        places = np.zeros(len(owner) + 1, np.int64)
        np.cumsum(width, out=places[1:])
        out = np.full(int(places[-1]), 0x20, np.uint8)
        steps = np.zeros(len(self.data) + 1, np.int8)
        steps[begin] += 1
        np.add.at(steps, end, -1)
        goal = np.zeros(len(out) + 1, np.int8)
        goal[places[:-1]] += 1
        np.add.at(goal, places[:-1] + end - begin, -1)
        out[np.cumsum(goal[:-1]) > 0] = self.data[np.cumsum(steps[:-1]) > 0]
        ends = places[np.searchsorted(owner, np.arange(self.size + 1))]
        return pa.LargeStringArray.from_buffers(
            self.size, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(out)
        )


def worded(texts: pa.Array, lower: bool = False, size: int = BLOCK_BYTES) -> Iterator[Words]:
    """The texts in blocks of about ``size`` bytes, one text at least."""
    data, at = utf8(texts)
    first, rows = 0, len(at) - 1
    while first < rows:
        last = max(first + 1, int(np.searchsorted(at, at[first] + size, "right")) - 1)
        yield Words(first, data[at[first]: at[last]], at[first: last + 1] - at[first], lower)
        first = last
