"""Removal of long word sequences that occur more than once anywhere in the input."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm.frames import row_key, text_of
from waybill.llm.hashing import blocks

WINDOW = 35
# Windows that a task combines before it sends them on.
CHUNK_WINDOWS = 2_000_000
# Bytes of text whose windows one task of the count takes.
COUNT_BYTES = 16_000_000

# Hashes of one chunk for one counting task. ``keys`` and ``counts``: documents and how
# many of the hashes each has; ``known``: bytes, 1 where the chunk itself repeats the hash.
# With ``told``, the windows are known to be repeated and only pass through.
_ASKED = "part int, told boolean, keys binary, counts binary, hashes binary, known binary"
# Rows that meet in the last step, by group of documents (``part``): first what the
# documents were told, one row per group and counting task, then each one's text.
_MEETING = "part int, kind int, key long, doc_id long, packed binary, keys binary, counts binary, hashes binary"


def _runs(sorted_values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of each run of equal values."""
    if not len(sorted_values):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    start = np.flatnonzero(np.r_[True, sorted_values[1:] != sorted_values[:-1]])
    return start, np.diff(np.r_[start, len(sorted_values)])


def _grouped(owners: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owners, their number of hashes, and the hashes owner by owner."""
    order = np.argsort(owners, kind="stable")
    start, count = _runs(owners[order])
    return owners[order][start], count, hashes[order]


def _ask(size: int, parts: int, chunk_windows: int):
    def rows(hashes: np.ndarray, keys: np.ndarray) -> Iterator[tuple]:
        order = np.argsort(hashes)
        hashes, keys = hashes[order], keys[order]
        start, count = _runs(hashes)
        repeated = np.repeat(count > 1, count)
        owners, many, told = _grouped(keys[repeated], hashes[repeated])
        if len(owners):
            yield int(owners[0] % parts), True, owners, many, told, None
        hashes, keys, known = hashes[start], keys[start], count > 1
        part = (hashes % np.uint64(parts)).astype(np.int64)
        order = np.lexsort((keys, part))
        hashes, keys, known, part = hashes[order], keys[order], known[order], part[order]
        bounds = np.searchsorted(part, np.arange(parts + 1))
        for p in np.flatnonzero(np.diff(bounds)):
            own = slice(bounds[p], bounds[p + 1])
            start, many = _runs(keys[own])
            yield int(p), False, keys[own][start], many, hashes[own], known[own]

    def batch(found: Iterator[tuple]) -> pa.RecordBatch:
        columns = list(zip(*[
            (p, t, k.tobytes(), c.astype(np.uint32).tobytes(), h.tobytes(),
             None if n is None else n.astype(np.uint8).tobytes())
            for p, t, k, c, h, n in found
        ])) or [[]] * 6
        kinds = pa.int32(), pa.bool_(), pa.binary(), pa.binary(), pa.binary(), pa.binary()
        names = "part told keys counts hashes known".split()
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, keys, held = [], [], 0
        for arrow in batches:
            ids = arrow.column(0).to_numpy().view(np.uint64)
            for block in blocks(arrow.column(1)):
                found, place = block.windows(size)
                hashes.append(found)
                keys.append(ids[block.first + block.owner(place)])
                held += len(found)
                if held >= chunk_windows:
                    yield batch(rows(np.concatenate(hashes), np.concatenate(keys)))
                    hashes, keys, held = [], [], 0
        if held:
            yield batch(rows(np.concatenate(hashes), np.concatenate(keys)))

    return run


def _count(parts: int):
    """Tell each document which of its hashes occur elsewhere, too."""
    def told(owners: np.ndarray, many: np.ndarray, hashes: np.ndarray) -> pa.RecordBatch:
        group = (owners % np.uint64(parts)).astype(np.int64)
        order = np.argsort(group, kind="stable")
        ends = np.cumsum(many)
        starts = ends - many
        owners, group, many, starts = owners[order], group[order], many[order], starts[order]
        # Hashes follow their owners into the new order.
        first = np.cumsum(many) - many
        hashes = hashes[np.repeat(starts - first, many) + np.arange(len(hashes))]
        at, count = _runs(group)
        rows = []
        for g, n in zip(at, count):
            own, of = slice(g, g + n), slice(first[g], first[g] + many[g: g + n].sum())
            rows.append((int(group[g]), owners[own].tobytes(),
                         many[own].astype(np.uint32).tobytes(), hashes[of].tobytes()))
        part, keys, counts, blobs = zip(*rows) if rows else ((),) * 4
        n = len(rows)
        return _meeting(part, 0, [None] * n, [None] * n, [None] * n, keys, counts, blobs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        all_hashes, all_keys, all_known = [], [], []
        for batch in batches:
            for row in batch.to_pylist():
                owners, many, hashes = _unpacked(row)
                if row["told"]:
                    yield told(owners, many, hashes)
                else:
                    all_hashes.append(hashes)
                    all_keys.append(np.repeat(owners, many))
                    all_known.append(np.frombuffer(row["known"], np.uint8))
        if not all_hashes:
            return
        hashes, keys = np.concatenate(all_hashes), np.concatenate(all_keys)
        known = np.concatenate(all_known)
        order = np.argsort(hashes)
        start, count = _runs(hashes[order])
        # A hash that its chunk repeats has been told there.
        repeated = (count > 1) | (np.maximum.reduceat(known[order], start) > 0)
        news = order[np.repeat(repeated, count)]
        news = news[known[news] == 0]
        yield told(*_grouped(keys[news], hashes[news]))

    return run


def _unpacked(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owners, their number of hashes, and the hashes."""
    return (
        np.frombuffer(row["keys"], np.uint64),
        np.frombuffer(row["counts"], np.uint32).astype(np.int64),
        np.frombuffer(row["hashes"], np.uint64),
    )


def _meeting(part, kind, key, doc_id, packed, keys, counts, hashes) -> pa.RecordBatch:
    kinds = {"part": pa.int32(), "kind": pa.int32(), "key": pa.int64(), "doc_id": pa.int64()}
    names = "part kind key doc_id packed keys counts hashes".split()
    columns = part, [kind] * len(part), key, doc_id, packed, keys, counts, hashes
    return pa.record_batch(
        [pa.array(c, kinds.get(n, pa.binary())) for n, c in zip(names, columns)], names=names
    )


def _compress(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            keys = batch.column(0).to_numpy()
            part = (keys.view(np.uint64) % np.uint64(parts)).astype(np.int32)
            packed = [press.compress((t or "").encode()) for t in batch.column(2).to_pylist()]
            nothing = [None] * len(part)
            yield _meeting(part, 1, keys, batch.column(1), packed, nothing, nothing, nothing)

    return run


def _remove(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        told: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            kinds = batch.column(1).to_numpy()
            texts_from = int(np.searchsorted(kinds, 1))  # sorted: the tellings come first
            for row in batch.slice(0, texts_from).to_pylist():
                owners, many, hashes = _unpacked(row)
                for owner, own in zip(owners.view(np.int64).tolist(), np.split(hashes, np.cumsum(many)[:-1])):
                    told.setdefault(owner, []).append(own)
            for at in range(texts_from, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = [unpack.decompress(t.as_py()) for t in part.column(4)]
                yield _cut(part.column(3), texts, [told.get(k) for k in part.column(2).to_pylist()], size)

    return run


def _cut(ids: pa.Array, texts: list[bytes], told: list, size: int) -> pa.RecordBatch:
    n_words, n_removed, digest, kept_texts = [], [], [], []
    hit = [i for i, parts in enumerate(told) if parts]
    covered: dict[int, np.ndarray] = {}
    column = pa.array([texts[i].decode() for i in hit], pa.large_string())
    for block in blocks(column):
        found, place = block.windows(size)
        owner = block.owner(place)
        bounds = np.searchsorted(owner, np.arange(block.size + 1))
        for k in range(block.size):
            i = hit[block.first + k]
            own = slice(bounds[k], bounds[k + 1])
            starts = place[own][np.isin(found[own], np.concatenate(told[i]))] - block.start[k]
            steps = np.zeros(block.count[k] + 1, np.int32)
            np.add.at(steps, starts, 1)
            np.add.at(steps, starts + size, -1)
            covered[i] = np.cumsum(steps[:-1]) > 0
    for i, text in enumerate(texts):
        words = text.split()
        n_words.append(len(words))
        if i in covered:
            words = [w for w, gone in zip(words, covered[i].tolist()) if not gone]
        kept = b" ".join(words)
        n_removed.append(n_words[-1] - len(words))
        digest.append(hashlib.sha256(kept).hexdigest())
        kept_texts.append(kept.decode())
    return pa.record_batch(
        [ids, pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
         pa.array(digest, pa.string()), pa.array(kept_texts, pa.string())],
        names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"],
    )


def substring_dedup(
    docs: DataFrame, window: int = WINDOW, chunk_windows: int = CHUNK_WINDOWS,
    count_bytes: int = COUNT_BYTES,
) -> DataFrame:
    """Remove every word covered by a window of ``window`` words that starts elsewhere, too,
    in the same text or in another. Windows are judged on the input.

    Words are split by ASCII white space and compared as they are. A null text has no
    words; rows equal in id and text repeat each other's windows and lose all of them.
    Texts shorter than the window stay whole.

    1. Tasks hash every window of their documents and combine chunks of them: windows
       that a chunk repeats are decided there, and every different hash is sent on
       once. A passage found in a third of all rows costs one hash a chunk.
    2. Hashes meet by value. Documents are told which of theirs are repeated, one row
       for each group of documents.
    3. What documents were told meets their (compressed) texts group by group, and
       repeated windows are merged into intervals that are cut out.

    Two different windows count as equal if their 64-bit hashes are; among N
    windows expect N * N / 2**65 such pairs.

    Columns: doc_id, n_words, n_removed, kept_sha256, kept_text.
    """
    texts = docs.select(
        row_key().alias("key"), F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")
    )
    volume = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = max(
        int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-volume // count_bytes)
    )
    asked = texts.select("key", "text").mapInArrow(_ask(window, parts, chunk_windows), _ASKED)
    told = asked.repartitionById(parts, F.col("part")).mapInArrow(_count(parts), _MEETING)
    packed = texts.mapInArrow(_compress(parts), _MEETING)
    return (
        told.unionByName(packed).repartitionById(parts, F.col("part"))
        .sortWithinPartitions("kind")
        .mapInArrow(
            _remove(window),
            "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string",
        )
    )
