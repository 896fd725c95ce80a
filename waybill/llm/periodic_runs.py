"""Periodic runs: stretches of words that repeat themselves at once, found per text."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm.frames import text_of
from waybill.llm.hashing import mixed
from waybill.llm.words import Words, worded

SHORTEST = 12
_ROUNDS = 3
_SCHEMA = (
    "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, "
    "collapsed string"
)
_RUN = pa.struct([(name, pa.int64()) for name in ("start", "length", "period")])


class LastOccurrences:
    """Suffix automaton of a growing word sequence whose states know the end of their last
    occurrence.

    The suffix links form a tree, and a prefix is a path from its state to the root. The tree
    is kept as a link-cut tree: all states of a preferred path share one last occurrence, which
    is stored at the root of the path's splay tree. Appending a word makes the new prefix's path
    preferred, piece by piece. States have numbers from 1, the root's; 0 is none.
    """

    def __init__(self) -> None:
        self.arcs: list[dict[int, int]] = [{}, {}]
        self.link, self.length = [0, 0], [0, 0]
        # Splay trees, ordered by depth; ``up`` of a tree's root leads to the path above.
        self.left, self.right, self.up = [0, 0], [0, 0], [0, 0]
        self.last = [0, 0]
        self.whole, self.words = 1, 0

    def _state(self, length: int, arcs: dict[int, int]) -> int:
        self.arcs.append(arcs)
        for column, value in (
            (self.link, 0), (self.length, length), (self.left, 0), (self.right, 0),
            (self.up, 0), (self.last, 0),
        ):
            column.append(value)
        return len(self.arcs) - 1

    def _rotate(self, x: int) -> None:
        left, right, up = self.left, self.right, self.up
        y = up[x]
        z = up[y]
        if left[y] == x:
            inner = left[y] = right[x]
            right[x] = y
        else:
            inner = right[y] = left[x]
            left[x] = y
        if inner:
            up[inner] = y
        up[y], up[x] = x, z
        if z and left[z] == y:
            left[z] = x
        elif z and right[z] == y:
            right[z] = x
        else:
            self.last[x] = self.last[y]

    def _splay(self, x: int) -> None:
        left, right, up = self.left, self.right, self.up
        y = up[x]
        while y and (left[y] == x or right[y] == x):
            z = up[y]
            if z and (left[z] == y or right[z] == y):
                self._rotate(y if (left[z] == y) == (left[y] == x) else x)
            self._rotate(x)
            y = up[x]

    def _split(self, q: int, length: int) -> int:
        """A new state between ``q`` and its link; both have the same last occurrence."""
        clone = self._state(length, self.arcs[q].copy())
        self.link[clone], self.link[q] = self.link[q], clone
        self._splay(q)
        above = self.left[clone] = self.left[q]
        if above:
            self.up[above] = clone
        self.left[q], self.up[clone] = clone, q
        return clone

    def append(self, word: int) -> Iterator[tuple[int, int]]:
        """Add a word. Gives, for each piece of the new prefix's path that had one last
        occurrence, its end and the length of the longest suffix that occurred there."""
        arcs, link, length = self.arcs, self.link, self.length
        self.words += 1
        new = self._state(self.words, {})
        p = self.whole
        while p and word not in arcs[p]:
            arcs[p][word] = new
            p = link[p]
        if not p:
            link[new] = 1
        else:
            q = arcs[p][word]
            if length[p] + 1 < length[q]:
                q, old = self._split(q, length[p] + 1), q
                while p and arcs[p].get(word) == old:
                    arcs[p][word] = q
                    p = link[p]
            link[new] = q
        self.whole = new
        self.up[new] = link[new]

        last, right, up = self.last, self.right, self.up
        y, x = new, link[new]
        while x:
            self._splay(x)
            if last[x]:
                yield last[x], length[x]
            below = right[x]
            if below:
                last[below] = last[x]
            right[x] = y
            y, x = x, up[x]
        last[y] = self.words


def maximal_runs(words: Sequence[int], shortest: int = SHORTEST) -> list[tuple[int, int, int]]:
    """(start, length, period) of every maximal run of ``shortest`` words or more.

    Say the longest suffix of the first i words that ended last at j has L words, and d = i - j.
    If L >= d, the last L + d words have period d: a square ends here. L is maximal, so they
    can't be extended to the left; and d is their smallest period, since a smaller one would
    give the suffix a later occurrence. Inside a run of period d from its second period on,
    each word meets the run again with the same start; the last one that does ends it.
    """
    seen = LastOccurrences()
    ends: dict[tuple[int, int], int] = {}
    for i, word in enumerate(words, 1):
        for end, length in seen.append(word):
            period = i - end
            if length >= period:
                ends[i - length - period, period] = i
    return sorted(
        (start, end - start, period)
        for (start, period), end in ends.items()
        if end - start >= shortest
    )


def _candidates(words: Words, shortest: int) -> list[tuple[int, int]]:
    """Stretches of words, none across two texts, that hold every run of ``shortest`` words.

    In a run of length n and period q, each window of n - q words, and so of half of
    ``shortest``, stands once more q words on or q words back, and these windows cover the run. What
    no such window covers is cut out; this is done again inside the stretches that are left.
    Windows are compared by hash: equal hashes of different windows only add work.
    """
    size = max(1, shortest // 2)
    n = len(words.codes)
    owner = np.repeat(np.arange(words.size), np.diff(words.bounds))
    place = np.arange(max(0, n - size + 1))
    place = place[owner[place] == owner[place + size - 1]]
    with np.errstate(over="ignore"):
        value = mixed(words.codes.astype(np.uint64) + np.uint64(1))
        window = np.zeros(len(place), np.uint64)
        for k in range(size):
            window = window * np.uint64(0x9E3779B97F4A7C15) + value[place + k]
        window = mixed(window)
        stretches: list[tuple[int, int]] = []
        for _ in range(_ROUNDS):
            key = mixed(window ^ mixed(owner[place].astype(np.uint64) + np.uint64(1)))
            order = np.argsort(key)
            key = key[order]
            again = np.zeros(len(key) + 1, bool)
            again[1:-1] = key[1:] == key[:-1]
            kept = np.sort(order[again[1:] | again[:-1]])
            fewer = len(kept) < len(place)
            place, window = place[kept], window[kept]
            covered = np.zeros(n + 1, np.int64)
            np.add.at(covered, place, 1)
            np.add.at(covered, place + size, -1)
            inside = np.cumsum(covered[:-1]) > 0
            text = np.repeat(np.arange(words.size), np.diff(words.bounds))
            fresh = inside & (np.r_[True, ~inside[:-1]] | np.r_[True, text[1:] != text[:-1]])[:n]
            owner = np.cumsum(fresh)  # of windows from now on: their stretch
            starts = np.flatnonzero(fresh)
            final = inside & (np.r_[~inside[1:], True] | np.r_[text[1:] != text[:-1], True])[:n]
            stretches = list(zip(starts.tolist(), (np.flatnonzero(final) + 1).tolist()))
            if not fewer or not len(place):
                break
    return [(a, b) for a, b in stretches if b - a >= shortest]


def _found(words: Words, shortest: int) -> pa.RecordBatch:
    runs: list[list[tuple[int, int, int]]] = [[] for _ in range(words.size)]
    kept = np.ones(len(words.codes), bool)
    for begin, end in _candidates(words, shortest):
        text = int(np.searchsorted(words.bounds, begin, "right")) - 1
        shift = begin - int(words.bounds[text])
        for start, length, period in maximal_runs(words.codes[begin:end].tolist(), shortest):
            runs[text].append((start + shift, length, period))
            kept[begin + start + period: begin + start + length] = False
    listed = [dict(zip(("start", "length", "period"), run)) for own in runs for run in own]
    bounds = np.cumsum([0, *map(len, runs)])
    return pa.record_batch(
        [
            pa.array(np.diff(words.bounds), pa.int64()),
            pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(listed, _RUN)),
            words.joined(kept).cast(pa.string()),
        ],
        names=["n_words", "runs", "collapsed"],
    )


def _find(shortest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in worded(batch.column(1)):
                found = _found(words, shortest)
                ids = batch.column(0).slice(words.first, words.size)
                yield pa.record_batch(
                    [ids, *found.columns], names=["doc_id", *found.schema.names]
                )

    return run


def periodic_runs(docs: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """All periodic runs of each text, and the text with each run cut to its first period.

    Words are runs of anything but ASCII white space, numbered from 0. A run is a stretch of
    words with smallest period q (words q apart are equal) and at least max(``shortest``, 2 * q)
    words that no neighbouring word extends. Runs may overlap; ``collapsed`` lacks every word
    that some run holds after its first q words, and joins the others by one blank.

    Every text is read by a suffix automaton over a link-cut tree (``maximal_runs``), except for
    stretches that can't hold a run, see ``_candidates``. A row is worked on by one task; the
    automaton takes some 700 bytes for each word of a stretch that repeats itself.

    Each row gives one row, also repeated ones. A null or empty text has no words, no
    runs, and an empty ``collapsed``. A null doc_id stays null. Other columns are not read.

    Columns: doc_id, n_words, runs (by start, then period), collapsed.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return texts.mapInArrow(_find(shortest), _SCHEMA)
