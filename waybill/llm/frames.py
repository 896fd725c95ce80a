"""Helpers of the operators: shared scratch tables, row keys, decisions applied to documents."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Bits of a sieve for each key, and at most: 16 MB. With more keys it lets more rows through.
SIEVE_BITS, SIEVE_MOST = 32, 1 << 27
_ROW_BITS = 15  # bitmap_construct_agg holds 2 ** 15 bits in a row

# ASCII white space, which alone separates words.
BLANKS = " \t\n\x0b\f\r"
BLANK_CLASS = r"[\x20\x09-\x0D]"


def scratch(spark: SparkSession) -> str:
    """Folder that the driver and all executors share: the one named by
    ``spark.checkpoint.dir``, or else the session's checkpoint folder or warehouse."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (root or f"{spark.conf.get('spark.sql.warehouse.dir')}/scratch").rstrip("/")


def written(df: DataFrame, what: str) -> DataFrame:
    """``df`` as a table in a new scratch folder: computed once, whatever reads it, and
    read again rather than recomputed when an executor is lost."""
    folder = f"{scratch(df.sparkSession)}/{what}-{uuid.uuid4()}"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def words_of(text: Column) -> Column:
    """Words of a text as an array: runs of anything but ASCII white space."""
    inner = F.btrim(text, F.lit(BLANKS))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(
        F.split(inner, BLANK_CLASS + "+")
    )


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, also inside nested lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def row_key() -> Column:
    """64-bit key of a document by its id and text; equal rows have equal keys."""
    return F.xxhash64(F.col("doc_id"), text_of())


def new_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    while stem in taken:
        stem = f"_{stem}"
    return stem


def marked(rows: DataFrame, key: Column, keys: DataFrame, name: str) -> DataFrame:
    """``rows`` with a boolean column ``name``: false if ``key`` is surely not in the one column
    of ``keys``, which should be a written table.

    A sieve, bitmaps with one bit set for the hash of each key, is broadcast instead of the keys. So
    rows that meet no key stay where they are, and only the others need to be shuffled to their keys.
    Some 3 % of the rows without a key are let through; a join with the keys must follow.
    """
    wanted = min(SIEVE_MOST, SIEVE_BITS * keys.count())
    slots = max(1, -(-wanted >> _ROW_BITS)) << _ROW_BITS

    def place(column: Column) -> tuple[Column, Column]:
        slot = F.pmod(F.xxhash64(column), F.lit(slots))
        return F.shiftright(slot, _ROW_BITS), slot.bitwiseAND((1 << _ROW_BITS) - 1)

    own, bits = new_name(rows, "_own"), new_name(rows, "_bits")
    block, at = place(F.col(keys.columns[0]))
    sieve = (
        keys.select(block.alias(own), at.alias("at")).repartition(own)
        .groupBy(own).agg(F.bitmap_construct_agg("at").alias(bits))
    )
    block, at = place(key)
    byte = F.substr(F.col(bits), F.shiftright(at, 3).cast("int") + 1, F.lit(1))
    bit = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), at.bitwiseAND(7).cast("int"))
    return (
        rows.withColumn(own, block).join(F.broadcast(sieve), own, "left")
        .withColumn(name, F.coalesce(bit == 1, F.lit(False))).drop(own, bits)
    )


def among(rows: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """The rows whose ``column`` is in the one column of ``keys``, a written table."""
    maybe = new_name(rows, "_maybe")
    found = marked(rows, F.col(column), keys, maybe).filter(maybe).drop(maybe)
    return found.join(keys.toDF(column), column, "left_semi")


def without(docs: DataFrame, keys: DataFrame, how: str = "left_anti") -> DataFrame:
    """Documents whose (doc_id, row_key) is not in ``keys``; with ``left_semi``, is in it.

    The list is written first, so Spark knows its size: it is broadcast if that is
    below the session's threshold. Else both sides are shuffled, of the documents those that
    may be listed (see ``marked``).
    """
    listed = written(keys.select("doc_id", "row_key").distinct(), "listed").select(
        F.col("doc_id").alias("_listed_id"), F.col("row_key").alias("_listed_key")
    )
    key = new_name(docs, "_key")
    maybe = new_name(docs, "_maybe")
    keyed = docs.withColumn(key, row_key())
    keyed = marked(keyed, F.col(key), listed.select("_listed_key"), maybe)
    match = F.col(key) == listed["_listed_key"]
    found = (
        keyed.filter(maybe)
        .join(listed, match & docs["doc_id"].eqNullSafe(listed["_listed_id"]), how)
        .drop(key, maybe)
    )
    if how == "left_semi":
        return found
    return keyed.filter(~F.col(maybe)).drop(key, maybe).unionByName(found)
