"""Periodic runs, whitening and language-model scores against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from waybill.llm.lm_scoring import lm_scores
from waybill.llm.periodic_runs import maximal_runs, periodic_runs
from waybill.llm.queries import (
    QUERIES,
    op11_periodic_runs,
    op12_embedding_whitening,
    op13_lm_scores,
    with_periodic_tails,
)
from waybill.llm.whitening import eigen, whiten

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


# --- 11 ---

def runs_by_hand(own, shortest):
    """Every maximal stretch for every period, if the period is the smallest."""
    codes = {}
    x = np.array([codes.setdefault(w, len(codes)) for w in own], np.int64)
    found = []
    for q in range(1, len(x) // 2 + 1):
        equal = np.r_[False, x[q:] == x[:-q], False].astype(int)
        steps = np.diff(equal)
        for a, b in zip(np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)):
            length = int(b - a + q)
            if length >= max(shortest, 2 * q) and not any(
                (x[a: a + length - p] == x[a + p: a + length]).all() for p in range(1, q)
            ):
                found.append((int(a), length, q))
    return sorted(found)


def collapsed(own, runs):
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(own) if i not in gone)


def test_runs_of_random_words():
    random.seed(5)
    for _ in range(800):
        n, letters = random.randint(0, 50), random.choice([1, 2, 2, 3, 5])
        own = [random.randrange(letters) for _ in range(n)]
        if n and random.random() < 0.5:
            a, p = random.randrange(n), random.randint(1, 9)
            own = [own[i] if i < a else own[a + (i - a) % p] for i in range(n)]
        shortest = random.choice([2, 5, 12])
        assert maximal_runs(own, shortest) == runs_by_hand(own, shortest)


def test_runs_of_fibonacci_and_thue_morse_words():
    a, b = "a", "ab"
    for _ in range(11):
        a, b = b, b + a
    assert maximal_runs(a, 2) == runs_by_hand(a, 2)
    thue = "a"
    for _ in range(8):
        thue += thue.translate(str.maketrans("ab", "ba"))
    assert maximal_runs(thue, 2) == runs_by_hand(thue, 2)
    assert maximal_runs(["x"] * 5000) == [(0, 5000, 1)]


def test_periodic_runs(docs, plain):
    found = Counter(
        (r.doc_id, r.n_words, tuple(tuple(x) for x in r.runs), r.collapsed)
        for r in periodic_runs(docs).collect()
    )
    expected = Counter()
    for doc, text, _ in plain:
        own = words(text)
        runs = runs_by_hand(own, 12)
        expected[doc, len(own), tuple(runs), collapsed(own, runs)] += 1
    assert found == expected


def test_op11(spark, plain):
    expected = {}
    for doc, text in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect():
        own = words(text)
        n, h = len(own), zlib.crc32(str(doc).encode())
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            own = [own[i] if i < a else own[a + (i - a) % p] for i in range(n)]
        runs = runs_by_hand(own, 12)
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
        longest = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
        listed = "".join(f"{a},{length},{q}\n" for a, length, q in runs)
        digests = (hashlib.sha256(t.encode()).hexdigest() for t in (listed, collapsed(own, runs)))
        expected[doc] = (len(runs), *longest, *digests)
    found = {r.doc_id: tuple(r)[1:] for r in op11_periodic_runs(spark, SF).collect()}
    assert found == expected and any(row[0] for row in expected.values())


def test_tails_of_nulls_and_empty_texts(spark):
    rows = spark.createDataFrame([(None, "a b"), (7, None), (None, None)], "doc_id long, text string")
    chosen = next(i for i in range(1000) if zlib.crc32(str(i).encode()) % 10 == 0)
    more = spark.createDataFrame([(chosen, None), (chosen, " "), (chosen, "one")], rows.schema)
    found = with_periodic_tails(rows.unionByName(more)).collect()
    assert Counter(map(tuple, found)) == Counter(
        [(None, "a b"), (7, None), (None, None), (chosen, None), (chosen, " "), (chosen, "one")])


def test_runs_of_an_empty_table(none):
    assert periodic_runs(none).collect() == []


# --- 12 ---

def residuals(a):
    values, x = eigen(a)
    scale = np.abs(a).max()
    wide = x.astype(np.longdouble)
    off = np.abs(np.asarray(a, np.longdouble) @ wide - wide * values).max() / scale
    return float(off), float(np.abs(wide.T @ wide - np.eye(len(a))).max()), values


@pytest.mark.parametrize("spectrum", [
    np.linspace(1, 9, 40), 1 + np.arange(40) * 1e-9, np.r_[np.full(20, 2.0), np.ones(20)],
    np.r_[1e6, 1 + np.arange(19) * 1e-7, np.zeros(20)], np.ones(40),
])
def test_eigenvectors_of_close_eigenvalues(spectrum):
    turn = np.linalg.qr(np.random.default_rng(3).normal(size=(40, 40)))[0]
    a = turn @ np.diag(spectrum) @ turn.T
    off, skew, values = residuals((a + a.T) / 2)
    assert off < 5e-15 and skew < 5e-15
    assert np.allclose(values, np.sort(spectrum)[::-1], rtol=0, atol=1e-13 * spectrum.max())


def test_clustered_eigenvectors_are_turned_right():
    spectrum = np.r_[1 + np.arange(10) * 1e-9, 3.0, 5.0].astype(np.longdouble)
    turn = np.linalg.qr(np.random.default_rng(4).normal(size=(12, 12)))[0].astype(np.longdouble)
    for _ in range(3):
        turn = turn @ (1.5 * np.eye(12) - 0.5 * (turn.T @ turn))
    a = turn @ np.diag(spectrum) @ turn.T
    _, x = eigen(a)
    same = np.abs(x.T @ turn[:, np.argsort(-spectrum)].astype(float))
    assert np.abs(same - np.eye(12)).max() < 1e-8


def whitened_by_hand(vectors):
    x = np.floor(64 * np.array(vectors, float)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, total = len(fit), fit.sum(axis=0)
    near = (total // n).astype(np.int64)
    moved = (fit - near) - (total - n * near) / n
    covariance = moved.T @ moved / n
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1][:16], axes[:, ::-1][:, :16]
    out = ((x - near) - (total - n * near) / n) @ axes / np.sqrt(values)
    deviation = [sum((n * int(v) - int(s)) ** 2 for v, s in zip(row, total)) for row in x]
    return n, deviation, out, values / np.trace(covariance)


def test_op12(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    rows = [r for r in rows if r.embedding is not None]
    n, deviation, out, explained = whitened_by_hand([r.embedding for r in rows])
    found = {(r.vec_id, r.component): r for r in op12_embedding_whitening(spark, SF).collect()}
    assert len(found) == 16 * len(rows)
    got = np.array([[found[r.vec_id, c + 1].whitened for c in range(16)] for r in rows])
    sign = np.sign((got * out).sum(axis=0))
    assert np.abs(got * sign - out).max() < 1e-9
    for i, row in enumerate(rows):
        one = found[row.vec_id, 1]
        assert one.n == n and one.deviation == deviation[i]
    shares = [found[rows[0].vec_id, c + 1].explained for c in range(16)]
    assert np.allclose(shares, explained, rtol=1e-9)
    assert max(r.identity_error for r in found.values()) < 1e-9


def test_whitening_drops_bad_vectors_and_counts_equal_ones_once(spark):
    inf, nan = float("inf"), float("nan")
    good = [[0.5, 1.0, 0.0], [2.0, -1.0, 0.0], [0.0, 3.0, 0.0], [0.5, 1.0, 0.0]]
    bad = [None, [], [1.0, None, 0.0], [inf, 0.0, 0.0], [nan, 0.0, 0.0], [1.0, 2.0], [1e300, 0.0, 0.0]]
    rows = [(i, v, 1) for i, v in enumerate(good)] + [(None, good[0], 1)] + [(9, v, 1) for v in bad[:-1]]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n int")
    found, model = whiten(table)
    found = found.collect()
    assert Counter(r.vec_id for r in found) == Counter([0, 1, 2, 3, None])
    assert {r.n for r in found} == {3}
    assert all(r.whitened[2] is None and r.whitened[0] is not None for r in found)
    assert model.explained[2] == 0 and abs(sum(model.explained) - 1) < 1e-12
    huge = spark.createDataFrame([(1, bad[-1]), (2, good[0])], "vec_id long, embedding array<double>")
    assert {r.vec_id: r.deviation for r in whiten(huge)[0].collect()} == {1: None, 2: None}


def test_whitening_without_variance_or_rows(spark):
    same = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<float>")
    found, model = whiten(same)
    assert {tuple(r.whitened) for r in found.collect()} == {(None, None)}
    assert list(model.explained) == [0, 0]
    assert whiten(same.filter("false"))[0].collect() == []


# --- 13 ---

def scores_by_hand(rows, order):
    """(doc_id, held out, tokens, known, N, base, score) from counts of tuples."""
    texts = [(doc, held, [*words((text or "").translate(ASCII_LOWER)), "\t"]) for doc, text, held in rows]
    counts = [None, *(Counter() for _ in range(order))]
    for _, held, own in texts:
        whole = [" ", *own]
        for k in range(1, order + 1) if not held else ():
            counts[k].update(tuple(whole[i: i + k]) for i in range(len(whole) - k + 1))
    single = Counter({w: c for (w,), c in counts[1].items() if w != " "})
    total, different = sum(single.values()), len(single)
    new = [None, None] + [
        (sum(c == 1 for c in counts[k].values()) + 1) / (sum(counts[k].values()) + 2)
        for k in range(2, order + 1)
    ]

    def share(gram):
        if len(gram) == 1:
            return (single[gram[0]] + 1) / (total + different + 1)
        shorter, before = share(gram[1:]), counts[len(gram) - 1][gram[:-1]]
        own = new[len(gram)]
        return (1 - own) * counts[len(gram)][gram] / before + own * shorter if before else shorter

    for doc, held, own in texts:
        whole = [" ", *own]
        places = range(1, len(whole))
        yield (
            doc, held, len(own), sum(single[w] > 0 for w in own), total,
            sum(math.log10(share((w,))) for w in own),
            sum(math.log10(share(tuple(whole[max(0, i - order + 1): i + 1]))) for i in places),
        )


def near(found, expected):
    key = lambda r: tuple((v is None, v or 0) for v in r[:5])
    found, expected = (
        sorted((key(r), round(r[5], 6), round(r[6], 6)) for r in rows) for rows in (found, expected)
    )
    assert [r[0] for r in found] == [r[0] for r in expected]
    assert np.allclose([r[1:] for r in found], [r[1:] for r in expected], rtol=1e-9, atol=2e-6)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_lm_scores(docs, plain, order):
    held = F.col("doc_id") % 3 == 1
    found = lm_scores(docs, held, order=order, chunk_bytes=40_000, count_bytes=100_000).collect()
    rows = [(doc, text, doc is not None and doc % 3 == 1) for doc, text, _ in plain]
    near(map(tuple, found), scores_by_hand(rows, order))


def test_op13(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    held = [(doc, text, zlib.crc32(str(doc).encode()) % 7 == 2) for doc, text in rows]
    found = [tuple(r) for r in op13_lm_scores(spark, SF).collect()]
    near(found, scores_by_hand(held, 2))
    # Texts it hasn't learned from: histories must help.
    assert sum(r[6] for r in found if r[1]) > sum(r[5] for r in found if r[1])


def test_probabilities_of_next_words_add_up(spark):
    corpus = [(1, "a b a c", False), (2, "b a", False), (3, "c", False)]
    words_known = ["a", "b", "c", "\t"]
    asked = [(10 + i, f"a {w}" if w != "\t" else "a", True) for i, w in enumerate([*words_known, "zz"])]
    table = spark.createDataFrame(corpus + asked, "doc_id long, text string, held boolean")
    found = {r.doc_id: r for r in lm_scores(table, F.col("held")).collect()}
    expected = {r[0]: r for r in scores_by_hand(corpus + asked, 2)}
    assert all(math.isclose(found[d].score, expected[d][6]) for d in found)


def test_scores_of_empty_and_held_out_tables(spark, none):
    assert lm_scores(none).collect() == []
    rows = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    found = sorted(map(tuple, lm_scores(rows, F.lit(True)).collect()))
    assert [r[:5] for r in found] == [(1, True, 3, 0, 0), (2, True, 1, 0, 0)]
    assert all(r[5] == 0 and r[6] == 0 for r in found)


def test_registered():
    assert {"op11_periodic_runs", "op12_embedding_whitening", "op13_lm_scores"} <= set(QUERIES)
