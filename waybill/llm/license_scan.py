"""License scans by an exact set-similarity join, with built-in functions only."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.llm.frames import let, written

# Phrases found word by word, and their labels.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
# Passages of licenses and notices, by label, in lower case without marks.
TEMPLATES = (
    ("mit", "released under the mit license"),
    ("mit-permission", "permission is hereby granted free of charge to any person obtaining a copy"
     " of this software and associated documentation files"),
    ("mit-permission", "the above copyright notice and this permission notice shall be included in"
     " all copies or substantial portions of the software"),
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain"
     " a copy of the license at"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are"
     " permitted"),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of"
     " conditions and the following disclaimer"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international"
     " license"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    ("gpl-3.0", "this program is free software you can redistribute it and or modify it under the"
     " terms of the gnu general public license as published by the free software foundation"
     " either version 3 of the license or at your option any later version"),
)
THRESHOLD_PERCENT = 80

# ASCII letters and digits, and everything beyond ASCII, make words.
_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """Words of a text with A-Z in lower case."""
    found = F.split(F.translate(text, _UPPER, _LOWER), _GAP)
    return F.filter(found, lambda w: w != "")


def template_rows(
    spark: SparkSession, templates: Sequence[tuple[str, str]], percent: int
) -> DataFrame:
    """label, passage (its number), tokens (distinct), size, need (how many tokens a block must
    share), width and stride (in words) of the blocks that the passage is looked for in.

    Blocks are half as long again as the passage and start every quarter of it, so a copy that
    has up to a quarter more words than the passage lies whole in one.
    """
    rows = []
    for passage, (label, sentence) in enumerate(templates):
        words = sentence.split()
        tokens = sorted(set(words))
        if tokens:
            rows.append((label, passage, tokens, len(tokens), ceil(len(tokens) * percent / 100),
                         ceil(len(words) * 3 / 2), max(1, len(words) // 4)))
    return spark.createDataFrame(
        rows, "label string, passage int, tokens array<string>, size int, need int, width int,"
        " stride int")


def ranked_prefixes(templates: DataFrame, seen: DataFrame) -> DataFrame:
    """The prefix tokens of every passage, one row each, with their ``place`` and the passage's
    tokens in order (``whole``): rarest first by ``seen`` (token, count).

    At most as many rows as the templates have words, so they may be collected and broadcast.
    """
    used = templates.withColumn("token", F.explode("tokens")).drop("tokens")
    passage = [c for c in used.columns if c != "token"]
    ranked = used.join(seen, "token", "left").groupBy(*passage).agg(
        F.sort_array(
            F.collect_list(F.struct(F.coalesce("count", F.lit(0)).alias("n"), "token"))
        )["token"].alias("whole")
    )
    return ranked.select(
        *passage, "whole",
        F.posexplode(F.slice("whole", 1, F.col("size") - F.col("need") + 1)).alias("place", "token"),
    )


def containment_join(
    texts: DataFrame, templates: DataFrame, seen: DataFrame, key: Sequence[str]
) -> DataFrame:
    """Every block of ``texts`` (key, words) and passage of which the block has at least ``need``
    tokens, with their number ``overlap`` and the block's first word ``start``.

    Blocks are overlapping windows of the whole text's words, whatever its lines, as wide as
    the passage asks for. Tokens are ranked by how many texts of the whole input have them
    (``seen``), rarest first. Only the first ``size - need + 1`` tokens of a passage (its prefix)
    are looked up, as a block that lacks all of them lacks too many. Length filter: a block of
    fewer than ``need`` words is out. Positional filter: the first prefix token in a block, at
    place p, stands for the pair; ``size - p`` tokens of equal or higher rank are left, and
    as many of them as ``need`` must be in the block.

    The prefixes are broadcast; texts stay where they are, however often a token occurs.
    """
    ranked = ranked_prefixes(templates, seen)
    rows = ranked.collect()
    prefixes = F.broadcast(ranked.sparkSession.createDataFrame(rows, ranked.schema))
    wanted = F.array(*[F.lit(t) for t in sorted({r.token for r in rows})]).cast("array<string>")
    probes = texts.select(
        *key, "words", F.explode(F.array_intersect("words", wanted)).alias("token")
    )
    n, width, stride = F.size("words"), F.col("width"), F.col("stride")
    none = F.lit(0)

    def quotient(value: Column, by: Column) -> Column:
        return F.floor(value / by).cast("int")

    last = quotient(F.greatest(n - width, none) + stride - 1, stride)
    spots = F.filter(F.sequence(none, n - 1), lambda i: F.get("words", i) == F.col("token"))
    numbers = F.array_distinct(F.flatten(F.transform(spots, lambda i: F.sequence(
        quotient(F.greatest(i - width + stride, none), stride),
        F.least(quotient(i, stride), last),
    ))))

    def counted(number: Column) -> Column:
        def shared(block: Column) -> Column:
            earlier = F.size(F.array_intersect(F.expr("slice(whole, 1, place)"), block))
            rest = F.size(F.array_intersect(F.expr("slice(whole, place + 1, size - place)"), block))
            long_enough = F.size(block) >= F.col("need")
            return F.when(long_enough & (earlier == 0), rest).otherwise(none)

        overlap = let(F.slice("words", number * stride + 1, width), shared)
        return F.struct((number * stride).alias("start"), overlap.alias("overlap"))

    found = probes.join(prefixes, "token").select(
        *key, "label", "passage", "size",
        F.filter(F.transform(numbers, counted), lambda b: b["overlap"] >= F.col("need")).alias("blocks"),
    )
    return found.select(*key, "label", "passage", "size", F.inline("blocks"))


def phrase_places(words: Column, phrase: str) -> Column:
    """Places (from 0) where the words of the phrase stand one after the other."""
    first, *rest = phrase.split()

    def here(place: Column) -> Column:
        found = F.get(words, place) == first
        for i, word in enumerate(rest, 1):
            found &= F.coalesce(F.get(words, place + i) == word, F.lit(False))
        return found

    places = F.when(F.size(words) > 0, F.sequence(F.lit(0), F.size(words) - 1)).otherwise(
        F.array().cast("array<int>")
    )
    return F.filter(places, here)


def phrase_pattern(phrases: Mapping[str, str]) -> str:
    """Matches, in any case, every text that has one of the phrases (and some that don't)."""
    return "(?i)(" + "|".join(_GAP.join(p.split()) for p in phrases) + ")"


def license_scan(
    docs: DataFrame,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    phrases: Mapping[str, str] = PHRASES,
    percent: int = THRESHOLD_PERCENT,
) -> DataFrame:
    """Labels of the licenses named in every whole text of ``docs`` (doc_id, text).

    A text has a label if one of its blocks holds at least ``percent`` of the words of one of its
    passages, or a phrase stands in it word by word. Line breaks don't matter. ``score`` is the
    largest share of a passage's words in one block among those, 1 with a phrase, else 0.
    A null text is empty, an empty table gives an empty result, and only doc_id and text are read.
    Rows equal in id and text get equal results.

    Columns: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.
    """
    spark = docs.sparkSession
    rows = docs.select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("row_key", F.xxhash64("doc_id", "text"))
    wanted = template_rows(spark, templates, percent)
    vocabulary = F.array(*[F.lit(w) for w in sorted({w for _, t in templates for w in t.split()})])
    key = ["doc_id", "row_key"]

    def counted(words: Column) -> Column:
        def placed(at: Column) -> Column:
            flat = F.flatten(at)
            names = [F.when(F.size(at[i]) > 0, F.lit(p)) for i, p in enumerate(phrases.values())]
            return F.struct(
                F.size(flat).cast("long").alias("n_base"),
                F.array_min(flat).cast("long").alias("first_word"),
                F.array_max(flat).cast("long").alias("last_word"),
                F.array_sort(F.array_distinct(F.array_compact(F.array(*names)))).alias("names"),
            )

        none = F.struct(
            F.lit(0).cast("long").alias("n_base"), F.lit(None).cast("long").alias("first_word"),
            F.lit(None).cast("long").alias("last_word"),
            F.array().cast("array<string>").alias("names"),
        )
        # Only texts that may have a phrase are searched place by place.
        base = F.when(
            F.rlike("text", F.lit(phrase_pattern(phrases))),
            let(F.array(*[phrase_places(words, p) for p in phrases]), placed),
        ).otherwise(none)
        return F.struct(
            F.size(words).cast("long").alias("n_words"), base.alias("base"),
            F.array_intersect(words, vocabulary).alias("tokens"),
        )

    scanned = written(
        rows.select(*key, let(words_of(F.col("text")), counted).alias("c")).select(
            *key, "c.n_words", "c.base.*", "c.tokens"
        ),
        "scanned",
    )
    seen = scanned.select(F.explode("tokens").alias("token")).groupBy("token").count()
    hits = (
        containment_join(
            rows.select(*key, words_of(F.col("text")).alias("words")), wanted, written(seen, "seen"), key
        )
        .groupBy(F.col("doc_id").alias("_id"), F.col("row_key").alias("_key"))
        .agg(
            F.collect_set("label").alias("found"),
            F.max(F.col("overlap") / F.col("size")).alias("share"),
        )
    )
    same = (F.col("row_key") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    joined = scanned.join(hits, same, "left")
    labels = F.array_sort(
        F.array_union("names", F.coalesce("found", F.array().cast("array<string>")))
    )
    return joined.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("names", ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )
