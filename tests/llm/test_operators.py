"""Every operator against brute force over whole small tables with edge cases."""

import hashlib
import itertools
import math
import re
import textwrap
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from waybill.llm import best_fit_decreasing, cube_sampling, minhash, packing, quality_rules, warc
from waybill.llm.exact_dedup import DigestIndex, exact_dedup, survivors
from waybill.llm.license_scan import PHRASES, TEMPLATES, THRESHOLD_PERCENT, license_scan
from waybill.llm.pii import base_spans, joined, personal_data
from waybill.llm.substring_dedup import substring_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


def multiset(rows):
    return Counter(tuple(r) for r in rows)


@pytest.mark.parametrize("operator", [
    quality_rules.quality_rules, packing.pack_sequences, best_fit_decreasing.shard_evenly,
    substring_dedup, cube_sampling.mix_sources, personal_data, minhash.near_duplicates, license_scan,
])
def test_empty_table(none, operator):
    assert operator(none).collect() == []


# --- 1 ---

def test_exact_dedup(spark, docs, plain):
    index = DigestIndex(spark, "index_all", 3)
    found = exact_dedup(docs, index, "first")
    groups = defaultdict(list)
    for doc, text, _ in plain:
        groups[text or ""].append(doc)
    expected = Counter()
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        for i in ids:
            expected[i, keep, len(ids), i == keep, hashlib.sha256(text.encode()).hexdigest()] += 1
    columns = "doc_id", "keep_id", "group_size", "kept", "text_sha256"
    assert multiset(found.select(*columns).collect()) == expected
    assert survivors(docs, found).count() == len(groups)
    assert survivors(docs, found).columns == docs.columns


def test_digest_index_across_batches(spark):
    index = DigestIndex(spark, "index_batches", 2)
    one = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "doc_id long, text string")
    two = spark.createDataFrame([(9, "a"), (8, "c"), (7, "c")], "doc_id long, text string")
    exact_dedup(one, index, "one").collect()
    for _ in range(2):  # a rerun gives the same and appends nothing
        rows = exact_dedup(two, index, "two").select("doc_id", "keep_id", "kept", "seen").collect()
        assert sorted(map(tuple, rows)) == [
            (7, 8, False, False), (8, 8, True, False), (9, 2, False, True)]
        assert spark.table("index_batches").count() == 3
    assert DigestIndex(spark, "index_batches").buckets == 2


def test_index_is_joined_in_place(spark, plan_of):
    index = DigestIndex(spark, "index_plan", 4)
    fresh = spark.createDataFrame([(b"1",)], "digest binary").repartition(4, "digest")
    plan = plan_of(fresh.join(index.before("x"), "digest", "left_anti"))
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 1


def test_index_runs_are_read_sorted_and_made_one(spark, plan_of):
    index = DigestIndex(spark, "index_runs", 2, max_runs=3)
    for k in range(2):
        rows = [(100 * k + i, f"text {i + 40 * k}") for i in range(60)]
        exact_dedup(spark.createDataFrame(rows, "doc_id long, text string"), index, f"b{k}")
    assert len(index.runs()) == 3
    digests = spark.range(50).select(F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("digest"))
    for join in index.unseen(digests, "x"), index.lookup(digests, "x"):
        plan = plan_of(join)
        assert plan.count("SortMergeJoin") == 3 and plan.count("Sort [") == 1
        assert plan.count("Exchange hashpartitioning") == 1
    rows = [(500 + i, f"text {i}") for i in range(120)]
    found = exact_dedup(spark.createDataFrame(rows, "doc_id long, text string"), index, "b2").collect()
    assert {r.doc_id - 500 for r in found if r.kept} == set(range(100, 120))
    assert {r.keep_id for r in found if r.seen} == {*range(60), *range(120, 160)}
    assert len(index.runs()) == 1 and spark.table("index_runs").count() == 120
    assert plan_of(index.unseen(digests, "x")).count("Sort [") == 1


# --- 2 ---

def test_quality_rules(docs, plain):
    limit = 2
    pages, per_doc = defaultdict(set), []
    for doc, text, source in plain:
        lines = [line.strip(" \t\n\x0b\x0c\r") for line in re.sub("[1-9]", "0", (text or "").lower()).split("\n")]
        lines = [line for line in lines if line]
        for line in lines:
            pages[source, line].add("\n".join(lines))
        per_doc.append(lines)
    expected = Counter()
    for (doc, text, source), lines in zip(plain, per_doc):
        own = words(text)
        n = len(own)
        windows = Counter(tuple(own[i: i + 8]) for i in range(n - 7))
        covered = {j for i in range(n - 7) if windows[tuple(own[i: i + 8])] > 1 for j in range(i, i + 8)}
        with_word = [line for line in (text or "").split("\n") if WORD.search(line)]
        failed = n < 20 or 100 * len(covered) > 30 * n
        removed = sum(len(words(line)) for line in lines if len(pages[source, line]) > limit)
        kept = not failed and 100 * (n - removed) >= 30 * n
        expected[
            doc, n, sum(map(len, own)), len(re.findall(r"[#*$%&|<>]", text or "")),
            len(with_word) - len(set(with_word)), len(covered), failed, kept, removed,
        ] += 1
    found = quality_rules.quality_rules(docs, max_documents=limit).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "n_removed")
    assert multiset(found.collect()) == expected


def test_common_lines_are_removed(docs, plain, none):
    limit, pages = 2, defaultdict(set)

    def normal(line):
        return re.sub("[1-9]", "0", line.lower()).strip(" \t\n\x0b\x0c\r")

    for _, text, source in plain:
        lines = [line for line in map(normal, (text or "").split("\n")) if line]
        for line in lines:
            pages[source, line].add("\n".join(lines))
    expected = Counter()
    for doc, text, source in plain:
        left = [x for x in (text or "").split("\n") if len(pages[source, normal(x)]) <= limit]
        expected[doc, None if text is None else "\n".join(left), source] += 1
    found = quality_rules.without_common_lines(docs, max_documents=limit)
    assert found.columns == docs.columns
    assert multiset(found.select("doc_id", "text", "source").collect()) == expected
    assert expected != Counter(plain)
    assert quality_rules.without_common_lines(none).collect() == []


def test_boilerplate_empties_a_document_but_copies_do_not(spark):
    menu = "home news sport weather travel money culture food music health science jobs"
    rows = [(i, f"{menu}\nstory {' '.join(f'x{i}y{j}' for j in range(40))}", "h") for i in range(9)]
    rows += [(100, f"{menu}\n{menu} again {menu[:40]}\n{menu}", "h")]
    story = " ".join(f"z{j}" for j in range(40))
    rows += [(200 + i, f"{story} " + "." * i + "\nsame short end", "h") for i in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = quality_rules.quality_rules(docs, max_documents=5, min_left_percent=60)
    gone = {r.doc_id for r in kept.filter("NOT kept").collect()}
    assert gone == {100}


def test_boilerplate_may_be_the_longest_line(spark):
    notice = " ".join(f"notice{chr(97 + j)}" for j in range(26))
    rows = [(i, f"{notice}\nshort {chr(97 + i)}", "h") for i in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = quality_rules.quality_rules(docs, max_documents=5).collect()
    assert {r.n_removed for r in found} == {26}
    assert not any(r.kept for r in found)


# --- 3 ---

def test_warc_round_trip(spark, tmp_path):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").unionByName(
        spark.createDataFrame([(None, None, None), (7, "u", ""), (7, "u", "")],
                              "page_id long, url string, html string"))
    responses = warc.responses_of_pages(pages)
    found = warc.derivatives(responses)
    rows = found.collect()
    assert len(rows) == 2 * pages.count()
    sources = {r.record_id: r for r in responses.collect()}
    for r in rows:
        source = sources[r.refers_to]
        assert r.content_length == len(r.block.encode()) and r.block_digest == warc.digest(r.block.encode())
        assert r.source_payload_digest == warc.digest(source.payload.encode())
        if r.warc_type == "metadata":
            assert f"conversion: {r.concurrent_to}" in r.block
            assert all(f"source-header: {line}" in r.block for line in source.http_headers.split("\r\n"))
        else:
            assert "<p" not in r.block and "track(" not in r.block
    folder = str(tmp_path / "warc")
    warc.write_warc(found, folder, compression="none")
    texts = spark.read.text(folder, wholetext=True).collect()
    parsed = Counter()
    for (text,) in texts:
        for part in filter(None, re.split(r"(?:^|\r\n\r\n)(?=WARC/1\.1\r\n)", text)):
            headers, block = warc.parse(part)
            parsed[headers["WARC-Record-ID"], headers["WARC-Refers-To"], block] += 1
    assert parsed == Counter((r.record_id, r.refers_to, r.block) for r in rows)


def test_plain_text():
    page = "<title>T</title><!-- <p>no --><p>a &amp; b<br>c <b>d</b></p><script>x</script>e<style>"
    assert warc.plain_text(page) == "T\na & b\nc d\ne"


# --- 4 ---

def test_packing(docs, plain):
    import public_tokenizers
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = Counter()
    for doc, text, _ in plain:
        ids = model.encode(text or "", add_special_tokens=False).ids + [0]
        for piece, start in enumerate(range(0, len(ids), 512)):
            own = np.array(ids[start: start + 512], "<u4")
            expected[doc, piece, start, len(own), zlib.crc32(own.tobytes())] += 1
    found = packing.pack_sequences(docs, length=512, open_bins=4).collect()
    assert Counter(tuple(r)[:5] for r in found) == expected
    sequences = defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 512
    assert len(sequences) <= 1.05 * -(-sum(r.length for r in found) // 512) + 1


# --- 5 ---

def test_sharding(docs, plain):
    found = best_fit_decreasing.shard_evenly(docs).collect()
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in found) == Counter(
        (d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, _ in plain)
    slots = defaultdict(list)
    for r in found:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len({r.shard for r in found if (r["size"], r.text_crc32) == (6, zlib.crc32(b"a b c"))}) == 1


def test_a_group_larger_than_a_shard_is_cut(spark):
    rows = [(i, "same text") for i in range(600)] + [(1000 + i, f"own text {i}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sizes = [r[1] for r in best_fit_decreasing.shard_evenly(docs).groupBy("shard").sum("size").collect()]
    assert len(sizes) == 8 and max(sizes) < 1.2 * min(sizes)


# --- 6 ---

@pytest.mark.parametrize("window, chunk", [(35, 2_000_000), (3, 500)])
def test_substring_dedup(docs, plain, window, chunk):
    seen = Counter()
    for _, text, _ in plain:
        own = words(text)
        seen.update(tuple(own[i: i + window]) for i in range(len(own) - window + 1))
    expected = Counter()
    for doc, text, _ in plain:
        own, covered = words(text), set()
        for i in range(len(own) - window + 1):
            if seen[tuple(own[i: i + window])] > 1:
                covered.update(range(i, i + window))
        kept = " ".join(w for i, w in enumerate(own) if i not in covered)
        expected[doc, len(own), len(covered), hashlib.sha256(kept.encode()).hexdigest(), kept] += 1
    assert multiset(substring_dedup(docs, window, chunk).collect()) == expected


# --- 7 ---

def test_mix(docs, plain):
    rows = cube_sampling.mix_sources(docs, cell_units=20).collect()
    sizes = Counter()
    for _, text, source in plain:
        sizes[source] += len(words(text))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    free, total = set(order), sum(sizes.values())
    while True:
        left = total - sum(3 * sizes[s] for s in order if s not in free)
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = {s for s in free if share[s] > 3 * sizes[s]}
        if not over:
            break
        free -= over
    goal = {s: share.get(s, 3 * sizes[s]) for s in order}
    taken = Counter()
    for r in rows:
        assert r.taken in (0, r["size"], 2 * r["size"], 3 * r["size"])
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(goal[r.source])
        taken[r.source] += r.taken
    assert Counter((r.doc_id, r["size"]) for r in rows) == Counter((d, len(words(t))) for d, t, _ in plain)
    largest = max(len(words(t)) for _, t, _ in plain)
    assert all(abs(taken[s] - goal[s]) <= largest / 2 for s in order)
    again = cube_sampling.mix_sources(docs.repartition(5), cell_units=20).collect()
    assert Counter((r.doc_id, r.taken) for r in again) == Counter((r.doc_id, r.taken) for r in rows)


def test_mixture_repeats_rows(docs):
    decisions = cube_sampling.mix_sources(docs)
    mixed = cube_sampling.mixture(docs, decisions)
    assert mixed.columns == docs.columns
    assert mixed.count() == decisions.agg(F.sum("copies")).first()[0]


# --- 8 ---

def test_personal_data(docs, plain):
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }

    def passes(kind, text):
        digits = re.findall("[0-9]", text)
        if kind == "ip":
            return all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) < 256 for p in text.split("."))
        doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
        luhn = sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0
        return kind == "email" or (kind == "card" and 16 <= len(digits) <= 19 and luhn) or (
            kind == "phone" and 8 <= len(digits) <= 15)

    expected, texts = Counter(), {}
    for doc, text, _ in plain:
        spans = [(k, *m.span()) for k, p in patterns.items() for m in re.finditer(p, text or "")
                 if passes(k, m.group())]
        assert sorted(base_spans(text or "")) == sorted(spans)
        count = Counter(k for k, _, _ in spans)
        base = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        expected[(doc, *[count[k] for k in patterns], hashlib.sha256(base.encode()).hexdigest())] += 1
        texts[doc] = set(filter(None, base.split(",")))
    found = personal_data(docs).collect()
    assert Counter(tuple(r)[:6] for r in found) == expected
    assert all(texts[r.doc_id] <= set(r.spans.split(",")) for r in found if r.doc_id)


# --- 9 ---

def shingles(text):
    own = words((text or "").translate(ASCII_LOWER))
    if len(own) < 5:
        return {tuple(own)} if own else set()
    return {tuple(own[i: i + 5]) for i in range(len(own) - 4)}


def test_near_duplicates(spark, docs, plain):
    base = [f"t{i}" for i in range(200)]
    # Edited copies that are similar to the original, but not to each other.
    edited = [(7000 + k, " ".join("e" if i % 50 == k else w for i, w in enumerate(base)), "s")
              for k in range(0, 50, 5)]
    extra = spark.createDataFrame(
        [*edited, (6999, " ".join(base), "s")], "doc_id long, text string, source string")
    every = docs.select("doc_id", "text", "source").filter("doc_id IS NOT NULL").unionByName(extra)
    sets = defaultdict(set)
    for doc, text, _ in every.collect():
        sets[doc] |= shingles(text)
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
                high, low = max(find(a), find(b)), min(find(a), find(b))
                parent[high] = low
    found = minhash.near_duplicates(every).collect()
    assert len({find(d) for d, *_ in edited}) == 1
    assert multiset(found) == Counter(
        (d, len(shingles(t)), find(d), find(d) == d) for d, t, _ in every.collect())


@pytest.mark.parametrize("often", [0, 3, 1000])
def test_common_counts(often, monkeypatch):
    monkeypatch.setattr(minhash, "_OFTEN", often)
    rng = np.random.default_rng(often)
    sets = [np.unique(rng.integers(0, 60, k)).astype(np.uint32) for k in rng.integers(0, 40, 30)]
    counts = minhash.common_counts(sets)
    for i, j in itertools.permutations(range(30), 2):
        assert counts[i, j] == len(np.intersect1d(sets[i], sets[j]))


@pytest.mark.parametrize("limits", [(1000, 500_000), (3, 500_000), (1000, 300)])
def test_tiles_find_every_link_of_a_bucket(spark, limits, monkeypatch):
    monkeypatch.setattr(minhash, "TILE_MEMBERS", limits[0])
    monkeypatch.setattr(minhash, "TILE_SHINGLES", limits[1])
    base = [f"t{i}" for i in range(80)]
    rows = []
    for k in range(24):
        # 2k and 2k + 1 differ at two neighbouring places, others at many.
        own = [f"e{i}" if (i + k // 2) % 16 == 0 else w for i, w in enumerate(base)]
        own[k % 80] = f"x{k}"
        rows.append((k, " ".join(own)))
    texts = spark.createDataFrame(rows, "id long, text string")
    members = spark.createDataFrame(
        [(7, k, len(shingles(t)), k if k > 3 else 0) for k, t in rows],
        "bucket long, id long, n long, component long")
    sets = {k: shingles(t) for k, t in rows}
    expected = {
        (a, b) for a, b in itertools.combinations(sets, 2)
        if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]) and not b <= 3}
    found = minhash.pairs_in_tiles(members, texts, 75).collect()
    assert expected and {tuple(r) for r in found} == expected
    few = minhash.pairs_in_tiles(members, texts, 75, spanning=True)
    assert {tuple(r) for r in few.collect()} <= expected
    start = [(0, k) for k in range(1, 4)]
    groups, least = (
        dict(minhash.least_reachable(spark.createDataFrame(start + list(p), "a long, b long")).collect())
        for p in (map(tuple, few.collect()), expected))
    assert groups == least


@pytest.mark.parametrize("gain", [1, 10**9])
def test_groups_do_not_depend_on_when_stars_end(spark, docs, gain, monkeypatch):
    usual = multiset(minhash.near_duplicates(docs).collect())
    monkeypatch.setattr(minhash, "STAR_GAIN", gain)
    assert multiset(minhash.near_duplicates(docs).collect()) == usual


def test_null_ids_get_the_component_of_their_set(spark):
    rows = [(None, "a b"), (3, "a b"), (None, "x y"), (None, None)]
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert multiset(found.collect()) == Counter(
        [(None, 1, 3, False), (3, 1, 3, True), (None, 1, None, True), (None, 0, None, True)])


def test_long_chains_reach_their_least_node(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(50, 60)], "a long, b long")
    found = dict(minhash.least_reachable(links).collect())
    assert found == {**{i: 1 for i in range(1, 41)}, 50: 50, 60: 50}


# --- 10 ---

def test_license_scan(docs, plain):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    expected = {}
    for doc, text, _ in plain:
        own = word.findall((text or "").translate(ASCII_LOWER))
        places = {label: [i for i in range(len(own)) if own[i: i + len(p.split())] == p.split()]
                  for p, label in PHRASES.items()}
        flat = [i for at in places.values() for i in at]
        base = {label for label, at in places.items() if at}
        labels, score = set(base), 1.0 if base else 0.0
        for label, sentence in TEMPLATES:
            wanted, n = set(sentence.split()), len(sentence.split())
            width, stride = math.ceil(n * 1.5), max(1, n // 4)
            for start in range(0, len(own) + stride, stride):
                block = set(own[start: start + width])
                if 100 * len(block & wanted) >= THRESHOLD_PERCENT * len(wanted):
                    labels.add(label)
                    score = max(score, len(block & wanted) / len(wanted))
                if start + width >= len(own):
                    break
        expected.setdefault((
            doc, len(own), len(flat), min(flat, default=None), max(flat, default=None),
            ",".join(sorted(base)), ",".join(sorted(labels))), []).append(score)
    found = defaultdict(list)
    for r in license_scan(docs).collect():
        found[tuple(r)[:7]].append(r.score)
    assert found.keys() == expected.keys()
    for row, scores in expected.items():
        assert sorted(found[row]) == pytest.approx(sorted(scores))
    assert any("apache-2.0" in row[6] for row in found)


def test_license_passages_wrapped_edited_and_absent(spark, plan_of):
    mit = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this"
           " software and associated documentation files (the 'Software')")
    bsd = ("Redistribution and use in source and binary forms, with or without modification, are"
           " permitted provided that the following conditions are met")
    filler = " ".join(f"word{i}" for i in range(500))
    rows = [
        (1, textwrap.fill(mit, 40)), (2, textwrap.fill(bsd, 30)),
        (3, f"{filler}\n{textwrap.fill(bsd, 25)}\n{filler}"),
        (4, f"{filler} {mit.replace('charge', 'cost')} {filler}"),
        (5, "released a film under the bridge with the mit team"),
        (6, f"released {filler} under {filler} the {filler} mit {filler} license"),
        (7, "# Released\n# under the\n# MIT License"), (8, "license " * 3000), (9, None),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = license_scan(docs)
    assert {r.doc_id: r.labels for r in found.collect()} == {
        1: "mit-permission", 2: "bsd", 3: "bsd", 4: "mit-permission", 5: "", 6: "", 7: "mit",
        8: "", 9: ""}
    assert "hashpartitioning(token" not in plan_of(found)  # texts stay where they are


def test_joined_order():
    assert joined([("phone", 1, 2), ("email", 9, 10), ("email", 3, 4)]) == "email:3:4,email:9:10,phone:1:2"
