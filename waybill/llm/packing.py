"""Bounded-space online best-fit packing of tokenised documents into sequences."""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm.frames import written

LENGTH = 2048
# Bins that a task keeps open.
OPEN_BINS = 256
# What is left in open bins is packed once more, so many pieces a task.
REPACK_PIECES = 500_000
_CACHED_WORDS = 400_000
_UNSAFE = ("<|", "Σ", "\x1c", "\x1d", "\x1e", "\x1f")


# How the tokenizer file parts a lower-case word without white space, for ASCII.
_PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")


def _byte_letters() -> dict[int, int]:
    """The letter that stands for each byte in byte-level files: printable bytes of Latin-1 for
    themselves, the others in order for code points from 256."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in plain]
    return {**{b: b for b in plain}, **{b: 256 + i for i, b in enumerate(others)}}


class WordTokenizer:
    """Token ids of a text from a lower-casing byte-level BPE file with word ends, as 16-bit bytes.

    This tokenizer never looks across white space, so words are tokenised once each, in
    one call for all new ones, and kept in a bounded table: when its newer half is full, the older half
    is dropped, and words still in use come back from it. A text is tokenised whole
    where that could differ: not in NFC, with strings of special tokens, capital sigma,
    or separators that are white space for one library only.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.model = Tokenizer.from_file(path)
        vocabulary = self.model.get_vocab()
        if max(vocabulary.values()) >= 1 << 16:
            raise ValueError("ids must fit 16 bits")
        # The same merges for pieces that are normalised and parted already.
        self.merges = Tokenizer.from_file(path)
        self.merges.normalizer = normalizers.Sequence([])
        self.merges.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.letters = _byte_letters()
        self.ends = np.zeros(1 << 16, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.marks = {mark: self.whole(mark) for mark in ".,;:!?"}

    def whole(self, text: str) -> bytes:
        ids = self.model.encode(text, add_special_tokens=False).ids
        return np.array(ids, np.uint16).tobytes()

    def pieces(self, spelled: list[str]) -> dict[str, bytes]:
        """Ids of pieces that the tokenizer doesn't part any further, in one call."""
        as_bytes = " ".join(spelled).encode().decode("latin-1").translate(
            {**self.letters, 0x20: 0x20}
        )
        (told,) = self.merges.encode_batch_fast([as_bytes], add_special_tokens=False)
        ids = np.array(told.ids, np.uint16)
        cuts = np.flatnonzero(self.ends[ids]) + 1
        if len(cuts) != len(spelled):
            return {piece: self.whole(piece) for piece in spelled}
        data, out, start = ids.tobytes(), {}, 0
        for piece, cut in zip(spelled, (2 * cuts).tolist()):
            out[piece] = data[start:cut]
            start = cut
        return out

    def learn(self, words: Iterable[str]) -> None:
        """Add new words to the table: all pieces they consist of in one call, the rest one by one."""
        needed, parted, marked = set(), [], []
        for word in words:
            if word.isalpha():
                needed.add(word)
            elif word.isascii():
                own = _PIECES.findall(word)
                needed.update(own)
                parted.append((word, own))
            elif word[-1] in self.marks and word[:-1].isalpha():
                marked.append(word)
                needed.add(word[:-1])
            else:
                self.known[word] = self.whole(word)
        ids = self.pieces(sorted(needed)) if needed else {}
        self.known.update(ids)
        self.known.update((word, b"".join([ids[p] for p in own])) for word, own in parted)
        self.known.update((word, ids[word[:-1]] + self.marks[word[-1]]) for word in marked)

    def many(self, texts: list[str]) -> Iterator[bytes]:
        if len(self.known) > _CACHED_WORDS:
            self.known, self.older = {}, self.known
        split: list[list[str] | None] = []
        for text in texts:
            lower = text.lower()
            safe = not any(mark in text for mark in _UNSAFE) and (
                text.isascii()
                or unicodedata.is_normalized("NFC", text) and unicodedata.is_normalized("NFC", lower)
            )
            split.append(lower.split() if safe else None)
        fresh = []
        for word in set().union(*filter(None, split)):
            if word not in self.known:
                if word in self.older:
                    self.known[word] = self.older[word]
                else:
                    fresh.append(word)
        if fresh:
            self.learn(fresh)
        for text, words in zip(texts, split):
            if words is None:
                yield self.whole(text)
            else:
                yield b"".join(map(self.known.__getitem__, words))


@cache
def _tokenizer(path: str) -> WordTokenizer:
    """One tokenizer, and one table of words, per worker process, whatever the number of tasks."""
    return WordTokenizer(path)


class OpenBins:
    """Best fit among a fixed number of open bins; bit s of ``spaces`` is set if some
    open bin has s places free. Rows of a bin are given out when it closes."""

    def __init__(self, length: int, most: int, name: int):
        self.length, self.most, self.name = length, most, name
        self.spaces, self.open = 0, 0
        self.bins: dict[int, list[tuple[int, list]]] = {}

    def _take(self, space: int) -> tuple[int, list]:
        bins = self.bins[space]
        taken = bins.pop()
        if not bins:
            del self.bins[space]
            self.spaces &= ~(1 << space)
        self.open -= 1
        return taken

    def put(self, size: int, row: tuple) -> list:
        """Place a row; the rows of a bin that this closes."""
        closed: list = []
        fitting = self.spaces >> size
        if fitting:
            space = size + (fitting & -fitting).bit_length() - 1
            name, rows = self._take(space)
        else:
            if self.open == self.most and size < self.length:
                fullest = (self.spaces & -self.spaces).bit_length() - 1
                closed = self._take(fullest)[1]
            name, rows, space = self.name, [], self.length
            self.name += 1
        rows.append((*row, name, self.length - space))
        space -= size
        if space == 0:
            return closed + rows
        self.bins.setdefault(space, []).append((name, rows))
        self.spaces |= 1 << space
        self.open += 1
        return closed

    def rest(self) -> list:
        return [row for bins in self.bins.values() for _, rows in bins for row in rows]


_FIELDS = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
_ARROW = pa.schema(
    [(n, pa.int32() if n == "piece" else pa.int64()) for n in _FIELDS] + [("open", pa.bool_())]
)


def _rows(rows: list, is_open: bool) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * len(_FIELDS)
    return pa.record_batch([*columns, [is_open] * len(rows)], schema=_ARROW)


def _tokenise_and_pack(path: str | None, length: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path is None:
            import public_tokenizers

        model = _tokenizer(path or public_tokenizers.path("word_bpe_49k.json"))
        bins = OpenBins(length, most, TaskContext.get().partitionId() << 32)
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            for at in range(0, len(ids), 200):
                closed: list = []
                part = [t or "" for t in texts.slice(at, 200).to_pylist()]
                for doc, tokens in zip(ids[at:], model.many(part)):
                    wide = np.frombuffer(tokens + b"\0\0", np.uint16).astype("<u4")
                    for piece, start in enumerate(range(0, len(wide), length)):
                        own = wide[start: start + length]
                        row = doc, piece, start, len(own), zlib.crc32(own)
                        closed += bins.put(len(own), row)
                yield _rows(closed, False)
        yield _rows(bins.rest(), True)

    return run


def _pack_again(length: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = OpenBins(length, most, (1 << 62) + (TaskContext.get().partitionId() << 32))
        for batch in batches:
            closed: list = []
            for row in zip(*[batch.column(i).to_pylist() for i in range(5)]):
                closed += bins.put(row[3], row)
            yield _rows(closed, False)
        yield _rows(bins.rest(), False)

    return run


def pack_sequences(
    docs: DataFrame, path: str | None = None, length: int = LENGTH, open_bins: int = OPEN_BINS,
    repack_pieces: int = REPACK_PIECES,
) -> DataFrame:
    """Pack every row of ``docs`` (doc_id, text) into sequences of at most ``length`` tokens.

    A document is its ids by the tokenizer file ``path`` and the id 0; a null or empty
    text is that one id. Only longer documents are cut; equal rows are documents of their own.

    Every task packs its documents as they come, best fit among ``open_bins`` open bins;
    if none fits, a new one opens and the fullest closes. No text is shuffled. Pieces in
    bins still open at the end of a task are packed once more, the longest first, in far fewer tasks.
    Both results are written once, so a repeated task can't number sequences differently.

    Columns: doc_id, piece, start, length, ids_crc32, sequence_id, offset.
    """
    schema = f"{_SCHEMA}, open boolean"
    first = written(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .mapInArrow(_tokenise_and_pack(path, length, open_bins), schema),
        "packed",
    )
    rest = first.filter("open")
    tasks = max(1, -(-rest.count() // repack_pieces))
    again = (
        rest.repartition(tasks, "doc_id", "piece", "ids_crc32")
        .sortWithinPartitions(F.col("length").desc(), "doc_id", "piece", "ids_crc32")
        .select(*_FIELDS[:5]).mapInArrow(_pack_again(length, open_bins), schema)
    )
    return first.filter("NOT open").unionByName(written(again, "repacked")).drop("open")
