"""Quality rules with cross-document line frequency, with built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.llm.frames import (
    BLANKS, let, new_name, row_key, text_of, without, words_of, written,
)

WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
# A line found in more distinct documents of a host than this is boilerplate.
MAX_DOCUMENTS = 50
# A document is depleted if less than this share of its words is left.
MIN_LEFT_PERCENT = 30


def repeated_words(words: Column) -> Column:
    """Number of words covered by windows whose words occur twice or more in the text.

    Window hashes are sorted only where some occur twice. Linear otherwise.
    """
    places = F.sequence(F.lit(1), F.size(words) - (WINDOW - 1))

    def covered(hashes: Column) -> Column:
        pairs = F.sort_array(
            F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        )

        def starts(rows: Column) -> Column:
            def same(row: Column, other: Column) -> Column:
                return F.coalesce(row["h"] == F.get(rows, other)["h"], F.lit(False))

            again = F.filter(rows, lambda r, j: same(r, j - 1) | same(r, j + 1))
            return F.sort_array(F.transform(again, lambda r: r["i"]))

        def spread(at: Column) -> Column:
            own = F.transform(
                at, lambda i, j: F.least(F.lit(WINDOW), F.coalesce(F.get(at, j + 1) - i, F.lit(WINDOW)))
            )
            return F.aggregate(own, F.lit(0), lambda total, n: total + n)

        return let(let(pairs, starts), spread)

    hashed = F.transform(places, lambda i: F.xxhash64(F.slice(words, i, WINDOW)))
    return F.when(F.size(words) < WINDOW, 0).otherwise(
        let(
            hashed,
            lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(covered(h)),
        )
    )


def base_rules(docs: DataFrame, host: str) -> DataFrame:
    """doc_id, row_key, host and the counts of each text; a null text has no words or lines."""
    text = text_of()

    def counts(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.char_length(F.concat_ws("", words)).cast("long").alias("word_chars"),
            repeated_words(words).cast("long").alias("n_repeat_words"),
        )

    def later_copies(lines: Column) -> Column:
        return F.size(lines) - F.size(F.array_distinct(lines))

    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(BLANKS)) != "")
    measured = docs.select(
        "doc_id",
        row_key().alias("row_key"),
        F.col(host).alias("host"),
        let(words_of(text), counts).alias("c"),
        F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        let(lines, later_copies).cast("long").alias("n_dup_lines"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEATED_PERCENT
    )
    return measured.select(
        "doc_id", "row_key", "host", "c.n_words", "c.word_chars", "n_symbols", "n_dup_lines",
        "c.n_repeat_words",
    ).withColumn("base_failed", failed)


def lines_of(docs: DataFrame, host: str) -> DataFrame:
    """One row per line with a word: host, hash of the normalised line, its words, and
    as ``page`` the hash of its document's whole normalised text.

    Normalised: lower case, digits as 0, no outer blanks.
    """
    text = F.regexp_replace(F.lower(text_of()), "[1-9]", "0")
    trimmed = F.transform(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(BLANKS)))
    lines = F.filter(trimmed, lambda line: line != "")

    def with_page(rows: Column) -> Column:
        hashed = F.transform(
            rows,
            lambda line, place: F.struct(
                place.alias("place"), F.xxhash64(line).alias("line"),
                F.size(words_of(line)).alias("words"),
            ),
        )
        return F.struct(F.xxhash64(F.concat_ws("\n", rows)).alias("page"), hashed.alias("lines"))

    found = docs.select(
        F.col("doc_id"), row_key().alias("row_key"), F.col(host).alias("host"),
        let(lines, with_page).alias("p"),
    )
    return found.select(
        "doc_id", "row_key", "host", "p.page", F.inline("p.lines")
    )


def common_lines(lines: DataFrame, max_documents: int = MAX_DOCUMENTS) -> DataFrame:
    """Lines found in more than ``max_documents`` distinct documents of a host.

    Documents are told apart by their whole normalised text: copies of one page count
    once, so a page doesn't make boilerplate of itself by being republished.
    The count spreads a very common line over the documents that have it.
    """
    distinct = lines.select("host", "line", "page").distinct()
    counted = distinct.groupBy("host", "line").agg(F.count("*").alias("documents"))
    return counted.filter(F.col("documents") > max_documents)


def quality_rules(
    docs: DataFrame,
    host: str = "source",
    max_documents: int = MAX_DOCUMENTS,
    min_left_percent: int = MIN_LEFT_PERCENT,
) -> DataFrame:
    """Judge every row of ``docs`` (doc_id, text, host).

    Rows equal in id, text and host are judged alike. A null host is a host of its own; a null
    text has no words and fails. A document is kept if it passes the base rules and
    at least ``min_left_percent`` of its words are left without common lines.

    Columns: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, n_removed (words in common lines), row_key.
    """
    lines = lines_of(docs, host)
    common = written(common_lines(lines, max_documents), "lines").select(
        F.col("host").alias("_host"), F.col("line").alias("_line")
    )
    matched = lines.join(
        common, (F.col("line") == F.col("_line")) & F.col("host").eqNullSafe(F.col("_host"))
    )
    # A repeated row has each of its lines several times.
    removed = (
        matched.dropDuplicates(["doc_id", "row_key", "host", "place"])
        .groupBy("doc_id", "row_key", "host").agg(F.sum("words").alias("n_removed"))
        .select(F.col("doc_id").alias("_id"), F.col("row_key").alias("_key"),
                F.col("host").alias("_at"), "n_removed")
    )
    base = base_rules(docs, host)
    same = (
        (F.col("row_key") == F.col("_key"))
        & F.col("doc_id").eqNullSafe(F.col("_id"))
        & F.col("host").eqNullSafe(F.col("_at"))
    )
    judged = base.join(removed, same, "left")
    left = F.col("n_words") - F.coalesce("n_removed", F.lit(0))
    kept = ~F.col("base_failed") & (left * 100 >= F.col("n_words") * min_left_percent)
    return judged.select(
        *[c for c in base.columns if c not in ("row_key", "host")], kept.alias("kept"),
        F.coalesce("n_removed", F.lit(0)).alias("n_removed"), "row_key",
    )


def quality_survivors(docs: DataFrame, decisions: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    return without(docs, decisions.filter(~F.col("kept")))


def without_common_lines(
    docs: DataFrame, host: str = "source", max_documents: int = MAX_DOCUMENTS
) -> DataFrame:
    """``docs`` (doc_id, text, host and any other columns) without the lines of their texts that
    are common at their host; all other lines, blank ones too, stay as they are, in order.

    Texts without such a line are untouched, null ones too; a text of nothing else becomes empty.
    Rows equal in id, text and host are treated alike. Only the places of common lines are
    gathered, at most as many a document as it has lines.
    """
    lines = lines_of(docs, host)
    common = written(common_lines(lines, max_documents), "lines").select(
        F.col("host").alias("_host"), F.col("line").alias("_line")
    )
    matched = lines.join(
        common, (F.col("line") == F.col("_line")) & F.col("host").eqNullSafe(F.col("_host"))
    )
    key, gone, at = (new_name(docs, stem) for stem in ("_key", "_gone", "_at"))
    places = matched.groupBy("doc_id", "row_key", "host").agg(F.collect_set("place").alias(gone)).select(
        F.col("doc_id").alias(f"{at}_id"), F.col("row_key").alias(f"{at}_key"),
        F.col("host").alias(f"{at}_host"), gone,
    )
    same = (
        (F.col(key) == F.col(f"{at}_key"))
        & F.col("doc_id").eqNullSafe(F.col(f"{at}_id"))
        & F.col(host).eqNullSafe(F.col(f"{at}_host"))
    )
    worded = F.filter(
        F.transform(
            F.split("text", "\n"),
            lambda line, i: F.when(F.btrim(line, F.lit(BLANKS)) != "", i),
        ),
        lambda i: i.isNotNull(),
    )  # places of lines with a word, as ``lines_of`` numbers them

    def rest(split: Column) -> Column:
        removed = let(worded, lambda w: F.transform(F.col(gone), lambda n: F.get(w, n)))
        left = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), removed)
        return F.array_join(F.transform(left, lambda i: F.get(split, i)), "\n")

    text = F.when(F.col(gone).isNull(), F.col("text")).otherwise(let(F.split("text", "\n"), rest))
    joined = docs.withColumn(key, row_key()).join(places, same, "left")
    return joined.withColumn("text", text).select(*docs.columns)
