"""Scores of whole texts by an n-gram model of the corpus, as a weighted backoff automaton."""

from __future__ import annotations

import secrets
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.llm.frames import text_of, written
from waybill.llm.hashing import mixed
from waybill.llm.words import worded

ORDER = 2
# Bytes of text in a chunk, and of text whose n-grams one task counts.
CHUNK_BYTES = 8_000_000
COUNT_BYTES = 16_000_000

# Words have no blanks, so these are none.
_END, _START = b"\t", b" "
_FACTOR = np.uint64(0x9E3779B97F4A7C15)

_CHUNK = "chunk long, ids array<long>, held array<boolean>, sizes array<long>, packed binary"
_ASKED = "part int, chunk long, level int, grams binary, counts binary"
_ANSWER = "chunk long, part int, level int, counts binary, tokens long, known long, once long"
_MEETING = (
    "chunk long, kind int, level int, part int, counts binary, ids array<long>, "
    "held array<boolean>, sizes array<long>, packed binary"
)
_SCORES = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
)


# --- chunks of documents ---

def _pack(chunk_bytes: int):
    """Documents in chunks, one row each: the unit in which n-grams are combined and scored."""
    def row(held_back: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held_back)
        texts = [(t or "").encode() for t in table.column("text").to_pylist()]
        values = (
            [secrets.randbits(63)], [table.column("doc_id").to_pylist()],
            [table.column("held").to_pylist()], [list(map(len, texts))],
            [zstandard.ZstdCompressor(level=1).compress(b"".join(texts))],
        )
        kinds = (
            pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.binary()
        )
        names = [field.split()[0] for field in _CHUNK.split(", ")]
        return pa.record_batch([pa.array(v, k) for v, k in zip(values, kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0
        for batch in batches:
            ends = np.cumsum(batch.column("bytes").to_numpy())
            at = 0
            while at < batch.num_rows:
                sofar = ends[at - 1] if at else 0
                till = int(np.searchsorted(ends, sofar + chunk_bytes - size, "left")) + 1
                part = batch.slice(at, till - at)
                waiting.append(part)
                at += part.num_rows
                size += int(ends[at - 1] - sofar)
                if size >= chunk_bytes:
                    yield row(waiting)
                    waiting, size = [], 0
        if waiting:
            yield row(waiting)

    return run


class Grams:
    """The n-grams of a chunk's documents, a start before each and an end after it.

    ``tokens``: codes of all documents' words and ends, one document after the other, ``starts`` where
    each begins; ``spelled``: what the codes stand for, the last two being end and start.
    Per level k from 1: ``place[k]`` gives each token the number of the k-gram that ends
    there, or -1 where the document has none; ``before[k]`` and ``shorter[k]`` give each k-gram
    (k > 1) its first k - 1 and last k - 1 tokens; ``key[k]`` its hash, by which level 2 and
    more are counted. ``trained[k]`` counts each in the documents to learn from.
    """

    def __init__(self, sizes: list[int], held: np.ndarray, texts: bytes, order: int):
        at = np.cumsum([0, *sizes]).astype(np.int64)
        column = pa.LargeStringArray.from_buffers(
            len(sizes), pa.py_buffer(at), pa.py_buffer(texts)
        )
        (words,) = worded(column, lower=True, size=len(texts) + 1) if sizes else (None,)
        count = np.diff(words.bounds)
        self.starts = words.bounds[:-1] + np.arange(len(sizes))
        self.lengths = count + 1
        total = int(self.lengths.sum())
        self.end, self.start = len(words.dictionary), len(words.dictionary) + 1
        self.width = self.start + 1
        self.tokens = np.full(total, self.end, np.int64)
        last = self.starts + count
        inner = np.ones(total, bool)
        inner[last] = False
        self.tokens[inner] = words.codes
        self.spelled = [*words.dictionary.to_pylist(), _END, _START]
        first = np.zeros(total, bool)
        first[self.starts] = True
        learn = np.repeat(~held, self.lengths)

        key = np.fromiter(
            (xxhash.xxh3_64_intdigest(w) for w in self.spelled), np.uint64, self.width
        )
        trained = np.bincount(self.tokens, weights=learn, minlength=self.width).astype(np.int64)
        trained[self.start] = int((~held).sum())
        self.place, self.key, self.trained = [None, self.tokens], [None, key], [None, trained]
        self.before, self.shorter = [None, None], [None, None]
        # Number of the history of k - 1 tokens; the first token's is the start alone.
        history = np.full(total, self.start)
        history[1:][~first[1:]] = self.tokens[:-1][~first[1:]]
        for level in range(2, order + 1):
            there = np.flatnonzero(history >= 0)
            with np.errstate(over="ignore"):
                told = mixed(
                    self.key[level - 1][history[there]] * _FACTOR + key[self.tokens[there]]
                )
            known, first_at, number = np.unique(told, return_index=True, return_inverse=True)
            place = np.full(total, -1)
            place[there] = number
            self.place.append(place)
            self.key.append(known)
            self.before.append(history[there[first_at]])
            self.shorter.append(self.place[level - 1][there[first_at]])
            self.trained.append(
                np.bincount(number, weights=learn[there], minlength=len(known)).astype(np.int64)
            )
            history = np.full(total, -1)
            history[1:][~first[1:]] = place[:-1][~first[1:]]

    def asked(self, parts: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Per level: the order in which its n-grams are asked for, and where each part of
        the order, for one counting task, begins. Parts are ranges of the hash."""
        for level in range(1, len(self.key)):
            key = self.key[level]
            order = np.argsort(key) if level == 1 else np.arange(len(key))
            part = _part(key[order], parts)
            yield level, order, np.searchsorted(part, np.arange(parts + 1))


def _part(keys: np.ndarray, parts: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _grams(row: dict, order: int) -> Grams:
    texts = zstandard.ZstdDecompressor().decompress(row["packed"])
    return Grams(row["sizes"], np.array(row["held"], bool), texts, order)


# --- counting ---

def _ask(order: int, parts: int):
    """What each chunk has of each n-gram, one row for each task that counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                grams = _grams(row, order)
                for level, sort, bounds in grams.asked(parts):
                    some = np.flatnonzero(np.diff(bounds))
                    counts = grams.trained[level][sort].astype(np.uint32)
                    edges = bounds[np.r_[some, some[-1] + 1]].astype(np.int32)
                    if level == 1:
                        own = sort.tolist()
                        told = pa.array(
                            [b"\n".join(grams.spelled[i] for i in own[a:b])
                             for a, b in zip(edges[:-1], edges[1:])], pa.binary())
                    else:
                        told = _blobs(grams.key[level], edges * 8)
                    yield pa.record_batch(
                        [pa.array(some, pa.int32()), pa.array([row["chunk"]] * len(some), pa.int64()),
                         pa.array([level] * len(some), pa.int32()), told, _blobs(counts, edges * 4)],
                        names=["part", "chunk", "level", "grams", "counts"],
                    )

    return run


def _blobs(values: np.ndarray, edges: np.ndarray) -> pa.Array:
    """Stretches of an array as binary values, cut at ``edges`` (bytes)."""
    return pa.BinaryArray.from_buffers(
        pa.binary(), len(edges) - 1,
        [None, pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))],
    )


def _count(part_rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tell each chunk how often the whole corpus has its n-grams, in the order it asked."""
    levels: dict[int, list[tuple[int, int, bytes, np.ndarray]]] = {}
    for batch in part_rows:
        for row in batch.to_pylist():
            counts = np.frombuffer(row["counts"], np.uint32)
            levels.setdefault(row["level"], []).append(
                (row["chunk"], row["part"], row["grams"], counts)
            )
    press = zstandard.ZstdCompressor(level=1)
    for level in sorted(levels):
        rows = levels.pop(level)
        if level == 1:
            spelled = [w for _, _, blob, _ in rows for w in blob.split(b"\n")]
            coded = pa.array(spelled, pa.binary()).dictionary_encode()
            number = coded.indices.to_numpy()
            names = coded.dictionary.to_pylist()
        else:
            told = np.concatenate([np.frombuffer(blob, np.uint64) for _, _, blob, _ in rows])
            names, number = np.unique(told, return_inverse=True)
        counts = np.concatenate([c for *_, c in rows])
        sums = np.bincount(number, weights=counts, minlength=len(names)).astype(np.int64)
        real = sums if level > 1 else sums[[w != _START for w in names]]
        totals = int(real.sum()), int((real > 0).sum()), int((real == 1).sum())
        yield _answer(None, None, level, None, *totals)
        at = 0
        for chunk, part, _, own in rows:
            answer = press.compress(sums[number[at: at + len(own)]].tobytes())
            at += len(own)
            yield _answer(chunk, part, level, answer, None, None, None)


def _answer(*values) -> pa.RecordBatch:
    kinds = pa.int64(), pa.int32(), pa.int32(), pa.binary(), *[pa.int64()] * 3
    names = [field.split()[0] for field in _ANSWER.split(", ")]
    return pa.record_batch([pa.array([v], k) for v, k in zip(values, kinds)], names=names)


# --- the automaton ---

class Backoff:
    """The part of the model's automaton that a chunk's documents can reach.

    State 0 is the empty history, the others are n-grams of fewer than ``order`` tokens that
    the corpus has. A state's arcs are the words it has been followed by; an arc has the
    word's log10 probability and leads to the longest state that ends what was read. For any
    other word the failure arc leads to the state without its first token, at the cost of ``backoff``.
    State 0 has an arc for every word, so each search ends there.
    """

    def __init__(self, grams: Grams, counts: list, tokens: int, known: int, new: list[float]):
        top = len(grams.key) - 1
        self.width = grams.width
        share = single = (counts[1] + 1.0) / (tokens + known + 1.0)
        # Number of each n-gram's state; n-grams that the corpus lacks are the state they end in.
        self.states = 1
        state: list = [None]
        fail, backoff = [np.zeros(1, np.int64)], [np.zeros(1)]
        keys, weights, targets = [], [], []
        for level in range(1, top + 1):
            seen = counts[level] > 0
            shorter = 0 if level == 1 else state[level - 1][grams.shorter[level]]
            shorter = np.broadcast_to(shorter, len(seen))
            if level > 1:
                before = counts[level - 1][grams.before[level]]
                below = share[grams.shorter[level]]
                own = counts[level] / np.maximum(before, 1)
                share = np.where(before > 0, (1 - new[level]) * own + new[level] * below, below)
            if level < top:
                own = np.where(seen, self.states - 1 + np.cumsum(seen), shorter)
                self.states += int(seen.sum())
                fail.append(shorter[seen])
                backoff.append(np.full(int(seen.sum()), np.log10(new[level + 1])))
            else:
                own = shorter
            state.append(own)
            if level == 1:
                origin, word, arc = np.zeros(len(seen), np.int64), np.arange(len(seen)), ...
            else:
                at = grams.place[level]
                word = np.zeros(len(seen), np.int64)
                word[at[at >= 0]] = grams.tokens[at >= 0]
                origin, arc = state[level - 1][grams.before[level]], seen
            keys.append((origin * self.width + word)[arc])
            weights.append(np.log10(share)[arc])
            targets.append(own[arc])
        keys = np.concatenate(keys)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.weights = np.concatenate(weights)[order]
        self.targets = np.concatenate(targets)[order]
        self.fail, self.backoff = np.concatenate(fail), np.concatenate(backoff)
        self.first = int(state[1][grams.start]) if top > 1 else 0
        self.single = np.log10(single)

    def traverse(self, grams: Grams) -> np.ndarray:
        """log10 probability of each document. All are read side by side, from left to
        right, each with its own state."""
        longest = np.argsort(-grams.lengths, kind="stable")
        starts, lengths = grams.starts[longest], grams.lengths[longest]
        score = np.zeros(len(longest))
        state = np.full(len(longest), self.first)
        alive = len(longest)
        steps = int(lengths[0]) if alive else 0
        lasting = np.searchsorted(-lengths, -np.arange(steps), "left")
        for t in range(steps):
            alive = lasting[t]
            word = grams.tokens[starts[:alive] + t]
            now = state[:alive]
            key = now * self.width + word
            arc = np.searchsorted(self.keys, key)
            arc[arc == len(self.keys)] = 0
            lost = np.flatnonzero(self.keys[arc] != key)
            while len(lost):
                score[lost] += self.backoff[now[lost]]
                now[lost] = self.fail[now[lost]]
                key = now[lost] * self.width + word[lost]
                found = np.searchsorted(self.keys, key)
                found[found == len(self.keys)] = 0
                arc[lost] = found
                lost = lost[self.keys[found] != key]
            score[:alive] += self.weights[arc]
            state[:alive] = self.targets[arc]
        out = np.zeros(len(longest))
        out[longest] = score
        return out


def _score(order: int, parts: int, tokens: int, known: int, new: list[float]):
    def scored(row: dict, answers: dict[int, list[bytes]]) -> pa.RecordBatch:
        grams = _grams(row, order)
        unpack = zstandard.ZstdDecompressor()
        counts = [None]
        for level, sort, _ in grams.asked(parts):
            told = np.frombuffer(b"".join(map(unpack.decompress, answers[level])), np.int64)
            own = np.zeros(len(sort), np.int64)
            own[sort] = told
            counts.append(own)
        model = Backoff(grams, counts, tokens, known, new)
        seen = (counts[1] > 0)[grams.tokens]
        return pa.record_batch(
            [pa.array(row["ids"], pa.int64()), pa.array(row["held"], pa.bool_()),
             pa.array(grams.lengths, pa.int64()),
             pa.array(np.add.reduceat(seen.astype(np.int64), grams.starts)),
             pa.array(np.add.reduceat(model.single[grams.tokens], grams.starts)),
             pa.array(model.traverse(grams))],
            names=[field.split()[0] for field in _SCORES.split(", ")],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, answers = None, {}
        for batch in batches:  # sorted: a chunk's answers by level and part, then the chunk
            for i in range(batch.num_rows):
                (row,) = batch.slice(i, 1).to_pylist()
                if row["chunk"] != chunk:
                    chunk, answers = row["chunk"], {}
                if row["kind"] == 0:
                    answers.setdefault(row["level"], []).append(row["counts"])
                else:
                    yield scored(row, answers)

    return run


def lm_scores(
    docs: DataFrame, held_out: Column | None = None, order: int = ORDER,
    chunk_bytes: int = CHUNK_BYTES, count_bytes: int = COUNT_BYTES,
) -> DataFrame:
    """log10 probability of every whole text under a model of all texts but the held-out ones.

    Tokens are words (runs of anything but ASCII white space, A-Z in lower case), then one end.
    A word's probability after a history seen is (1 - new) * c(history, word) / c(history) + new * p,
    p being its probability after the history without its first token; without any history it
    is (c + 1) / (N + V + 1), where N and V are all and all different tokens learned from. So
    words never seen have a probability, too, and all add up to 1. ``new`` is, for each length of
    n-gram, the share of places whose n-gram occurs nowhere else: so often it would be new if its
    place were left out. As an automaton: an n-gram seen is an arc, failure arcs weigh ``new``.

    1. Documents are packed into chunks of about ``chunk_bytes`` of text. A chunk sends each of
       its different words and n-grams once, with its own count, to the tasks that count: a word
       in a third of all places is one entry a chunk.
    2. Counts meet by hash ranges and go back to the chunks that asked, in the order asked.
    3. A chunk builds the part of the automaton its documents can reach and reads them from left
       to right. So neither counts nor the model are ever in one place.

    Words are counted by their spelling. Longer n-grams are told apart by 64-bit hashes: of N
    different ones expect N * N / 2**65 pairs to share their counts, which moves ``score``
    alone. Rows where ``held_out`` is null are learned from.

    Each row gives one row, also repeated ones (which are learned from each). A null or empty text
    is an end alone. Null ids stay null. Other columns are not read. Without rows there is no result.

    Columns: doc_id, held_out, n_tokens, n_known (tokens learned from at least once),
    train_tokens (N), base_score (from single tokens' probabilities), score.
    """
    spark = docs.sparkSession
    held = F.coalesce(held_out, F.lit(False)) if held_out is not None else F.lit(False)
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), held.alias("held"),
        F.octet_length(text_of()).cast("long").alias("bytes"), text_of().alias("text"),
    )
    chunks = written(texts.mapInArrow(_pack(chunk_bytes), _CHUNK), "chunks")
    volume = chunks.agg(F.sum(F.expr("aggregate(sizes, 0L, (a, b) -> a + b)"))).first()[0] or 0
    fewest = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(fewest, -(-volume // count_bytes))
    asked = chunks.mapInArrow(_ask(order, parts), _ASKED)
    answers = written(
        asked.repartitionById(parts, F.col("part")).mapInArrow(_count, _ANSWER), "answers"
    )
    totals = {row.level: row for row in answers.filter("chunk IS NULL").groupBy("level").agg(
        *[F.sum(c).alias(c) for c in ("tokens", "known", "once")]
    ).collect()}
    tokens, known = (totals[1].tokens, totals[1].known) if totals else (0, 0)
    new = [(row.once + 1) / (row.tokens + 2) for _, row in sorted(totals.items())]
    told = answers.filter("chunk IS NOT NULL").select(
        "chunk", F.lit(0).alias("kind"), "level", "part", "counts"
    )
    meeting = told.unionByName(
        chunks.withColumn("kind", F.lit(1)), allowMissingColumns=True
    ).select([field.split()[0] for field in _MEETING.split(", ")])
    scores = (
        meeting.repartition(parts, "chunk").sortWithinPartitions("chunk", "kind", "level", "part")
        .mapInArrow(_score(order, parts, tokens, known, [0.0, *new]), _SCORES)
    )
    return scores.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"),
        "base_score", "score",
    )
