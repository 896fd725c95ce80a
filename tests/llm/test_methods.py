"""The methods inside the operators."""

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from waybill.llm import packing
from waybill.llm.best_fit_decreasing import pack, pack_evenly
from waybill.llm.cube_sampling import flight
from waybill.llm.hashing import blocks
from waybill.llm.minhash import BINS, near_duplicates, one_of_each, shingle_sets, signatures
from waybill.llm.packing import OpenBins, WordTokenizer
from waybill.llm import pii
from waybill.llm.pii import (
    KINDS, Tagger, everywhere, fitted, labelled_examples, personal_data, plausible, tagged_spans,
    trained, training_windows,
)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), min_size=1, max_size=60), st.integers(50, 80))
def test_best_fit_decreasing(sizes, capacity):
    bins, free = [], []
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        fits = [b for b in range(len(free)) if free[b] >= sizes[i]]
        b = min(fits, key=lambda b: (free[b], b)) if fits else len(free)
        if not fits:
            free.append(capacity)
        free[b] -= sizes[i]
        bins.append((i, b))
    assert pack(sizes, capacity) == [b for _, b in sorted(bins)]


def test_pack_evenly():
    sizes = list(range(1, 401))
    loads = np.bincount(pack_evenly(sizes, 8), weights=sizes)
    assert loads.max() - loads.min() <= 2


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 16), max_size=80), st.integers(1, 5))
def test_open_bins(sizes, most):
    bins, rows = OpenBins(16, most, 0), []
    for i, size in enumerate(sizes):
        rows += bins.put(size, (i, size))
        assert bins.open <= most and bin(bins.spaces).count("1") == len(bins.bins)
    rows += bins.rest()
    assert sorted(r[0] for r in rows) == list(range(len(sizes)))
    for name in {r[2] for r in rows}:
        at = 0
        for _, size, _, offset in sorted((r for r in rows if r[2] == name), key=lambda r: r[3]):
            assert offset == at
            at += size
        assert at <= 16


def test_the_fullest_bin_closes_first():
    bins = OpenBins(10, 2, 0)
    assert bins.put(6, ("a",)) == [] and bins.put(7, ("b",)) == []
    assert [r[0] for r in bins.put(8, ("c",))] == ["b"]


def test_flight_keeps_both_totals_and_expectations():
    rng = np.random.default_rng(1)
    words, rows = rng.integers(0, 500, 300), rng.integers(1, 3, 300)
    chance = np.full(300, 0.37)
    runs = []
    for seed in range(200):
        moved = flight(chance, words, rows, [seed])
        assert ((moved > 0) & (moved < 1)).sum() <= 2
        assert moved @ words == pytest.approx(chance @ words) and moved @ rows == pytest.approx(chance @ rows)
        runs.append(moved)
    assert np.abs(np.mean(runs, axis=0) - 0.37).max() < 0.17


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet="ab é\t\n\x0bA", max_size=30), max_size=8), st.integers(1, 4))
def test_blocks_and_windows(texts, size):
    seen = {}
    for block in blocks(pa.array(texts, pa.string()), size=20):
        found, place = block.windows(size)
        starts = [0]
        for k in range(block.size):
            own = texts[block.first + k].encode().split()
            assert block.count[k] == len(own)
            for i in range(len(own) - size + 1):
                at = np.flatnonzero(place == block.start[k] + i)[0]
                assert seen.setdefault(tuple(own[i: i + size]), found[at]) == found[at]
    assert len(set(seen.values())) == len(seen)


def test_signatures_estimate_similarity():
    base = [f"w{i}" for i in range(400)]
    texts = [" ".join(base), " ".join("x" if i % 80 == 0 else w for i, w in enumerate(base)), "a b"]
    (block,) = blocks(pa.array(texts), lower=True)
    table = signatures(*shingle_sets(block, 5), 3)
    assert table.shape == (3, BINS) and len(set(table[2])) == 1
    assert (table[0] == table[1]).mean() == pytest.approx(0.88, abs=0.12)


def test_word_by_word_tokens_are_the_whole_texts_tokens():
    import public_tokenizers

    model = WordTokenizer(public_tokenizers.path("word_bpe_49k.json"))
    texts = ["It's a test, isn't it? 123.45 (x)", "", " ", "ÉÀ ê ß ǅ ﬁ İx", "a b c\u0085d", "Σ ΑΣ",
             "é x", "<|endoftext|>", "a\x1cb", "日本語 テキスト", "...,,, ''s 'S n't"]
    assert list(model.many(texts)) == [model.whole(t) for t in texts]
    assert list(model.many(texts)) == [model.whole(t) for t in texts]


def test_gradients_are_those_of_the_likelihood():
    model = Tagger(embed=3, hidden=2, seed=3)
    model.w = {k: v.astype(np.float64) for k, v in model.w.items()}
    rng = np.random.default_rng(0)
    codes, tags = rng.integers(0, 40, (2, 5)), rng.integers(0, 9, (2, 5))

    def loss():
        scores = model.scores(codes)[0]
        total = 0.0
        for b in range(2):
            own, moves = scores[:, b], model.w["moves"]
            ahead = own[0]
            for t in range(1, 5):
                ahead = own[t] + np.log(np.exp(ahead[:, None] + moves).sum(0))
            gold = own[np.arange(5), tags[b]].sum() + moves[tags[b][:-1], tags[b][1:]].sum()
            total += np.log(np.exp(ahead).sum()) - gold
        return total / 2

    grads = model.gradients(codes, tags)
    for name in model.w:
        flat, grad = model.w[name].reshape(-1), grads[name].reshape(-1)
        for i in rng.integers(0, len(flat), 4):
            old = flat[i]
            flat[i] = old + 1e-5
            up = loss()
            flat[i] = old - 1e-5
            down = loss()
            flat[i] = old
            # States are kept in single precision.
            assert grad[i] == pytest.approx((up - down) / 2e-5, abs=2e-2)


def test_held_out_accuracy():
    examples = labelled_examples(600, seed=99)
    found = tagged_spans(trained(), [text for text, _ in examples])
    right = sum(set(spans) == set(marked) for (_, spans), marked in zip(examples, found))
    wanted = sum(len(spans) for _, spans in examples)
    hit = sum(len(set(spans) & set(marked)) for (_, spans), marked in zip(examples, found))
    print(right, hit, wanted)
    assert hit / wanted > 0.8 and right / len(examples) > 0.75


def test_regions_longer_than_a_window_are_decoded_as_one():
    text = "call " + " or ".join(["+1 (377) 555-0271"] * 12) + " now"
    (spans,) = tagged_spans(trained(), [text])
    assert len([s for s in spans if s[0] == "phone"]) >= 8
    codes, tags = training_windows([(text, [("phone", 5, 22)])])
    assert codes.shape == tags.shape and KINDS[(tags.max() - 1) // 2] == "phone"


def test_recall_of_every_kind_on_held_out_spans():
    examples = labelled_examples(600, seed=5)
    found = tagged_spans(trained(), [text for text, _ in examples])
    wanted, hit = dict.fromkeys(KINDS, 0), dict.fromkeys(KINDS, 0)
    for (text, spans), marked in zip(examples, found):
        marked = {fitted(k, text, a, b) for k, a, b in marked}
        for span in spans:
            wanted[span[0]] += 1
            hit[span[0]] += span in marked
    print(hit, wanted)
    assert all(hit[kind] > 0.9 * wanted[kind] for kind in KINDS)


@pytest.mark.parametrize("mail", [
    "anna.kl (at) hostname (dot) example (dot) com", "anna.kl (at) longhostname (dot) com",
    "verylonglocalpartofanaddress (at) host (dot) com",
    "verylonglocalpartofanaddress (at) verylonghostname (dot) example (dot) com",
])
@pytest.mark.parametrize("around", [("", ""), ("see ", " for more"), ("word " * 400, "\nword" * 400)])
def test_long_written_out_mail_addresses(spark, mail, around):
    text = mail.join(around)
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    (row,) = personal_data(docs).collect()
    at = len(around[0])
    assert row.spans == f"email:{at}:{at + len(mail)}" and row.n_email == 0


def accepted(texts, marked):
    return [
        {s for s in (fitted(k, t, a, b) for k, a, b in spans) if plausible(s[0], t[s[1]: s[2]])}
        for t, spans in zip(texts, marked)
    ]


def test_regions_lose_no_span_of_the_whole_text(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text")
    texts = [r.text or "" for r in rows.filter("text RLIKE '[0-9@]'").orderBy("doc_id").limit(60).collect()]
    texts += [f"{'word ' * 50}{text}{' word' * 50}" for text, _ in labelled_examples(40, seed=8)]
    model = trained()
    near, whole = (accepted(texts, tagged_spans(model, texts, cut)) for cut in (pii.regions, everywhere))
    lost = sum(len(b - a) for a, b in zip(near, whole))
    assert sum(map(len, whole)) > 20 and lost <= 0.02 * sum(map(len, whole))


def test_long_regions_are_decoded_in_pieces(monkeypatch):
    text = "call " + " or ".join(["+1 (377) 555-0271", "10.20.30.40"] * 40) + " now"
    (whole,) = tagged_spans(trained(), [text])
    monkeypatch.setattr(pii, "PIECE", 400)
    monkeypatch.setattr(pii, "OVERLAP", 100)
    monkeypatch.setattr(pii, "AT_ONCE", 700)
    parts = list(pii.pieces(5, 1500))
    assert parts[0][:1] == (5,) and parts[-1][1] == 1500 and all(e - s <= 400 for s, e, _, _ in parts)
    assert [p[3] for p in parts[:-1]] == [p[2] for p in parts[1:]]
    assert tagged_spans(trained(), [text]) == [whole] and len(whole) > 60


# --- words that polynomials modulo 2**64 can't tell apart, rows without their own id ---

def thue_morse(letters):
    word = "a"
    while len(word) < letters:
        word += word.translate(str.maketrans("ab", "ba"))
    return word


def test_long_words_of_the_same_make_have_different_hashes():
    for letters in (64, 128, 1024, 4096):
        one = thue_morse(letters)
        (block,) = blocks(pa.array([one, one.translate(str.maketrans("ab", "ba"))]))
        assert block.hash[0] != block.hash[1]
    one, two = (thue_morse(32).translate(str.maketrans(*w)).replace("y", "y ").replace("x", "x ")
                for w in (("ab", "xy"), ("ab", "yx")))
    (block,) = blocks(pa.array([one, two]))
    found, _ = block.windows(32)
    assert found[0] != found[1]


def test_one_of_each_drops_copies_alone(spark):
    text = "a b c d e f"
    rows = [(None, text), (3, text), (None, "nobody else has this text here"), (1, "x y"),
            (1, "one more text of number one"), (0, "x y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [tuple(r) for r in one_of_each(docs, near_duplicates(docs, keyed=True)).collect()]
    assert sorted(kept, key=str) == sorted([rows[1], rows[2], rows[4], rows[5]], key=str)
    clashing = docs.withColumn("row_key", F.lit(1))
    same = one_of_each(clashing, near_duplicates(clashing, keyed=True))
    assert same.columns == ["doc_id", "text", "row_key"] and same.count() == 4


def test_tokenizer_forgets_the_older_half_of_its_words(monkeypatch):
    monkeypatch.setattr(packing, "_CACHED_WORDS", 5)
    model = packing.WordTokenizer(public_tokenizers.path("word_bpe_49k.json"))
    texts = ["it's 3.5% of the café's menu!", "Über naïve ÇA, x==y 12ab ab12 'tis", "it's the menu"] * 3
    texts += ["don't we'll I'm x's--'s 'S", "日本語 mixed日本 ٣ v٣ a_b-c"]
    for text in texts:
        (told,) = model.many([text])
        assert told == model.whole(text)
    assert len(model.known) < 30
