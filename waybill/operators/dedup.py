"""Rows without null keys, and the first row per key in row order."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waybill.schemas import ROW_ORDER


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows in which no key is null; unlike ``na.drop`` the parquet scan sees the filter."""
    return df.filter(reduce(and_, [F.col(key).isNotNull() for key in keys]))


def first_per_key(
    df: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    order: Sequence[str] = ROW_ORDER,
    collapse: bool = False,
    placed: bool = False,
) -> DataFrame:
    """Keep, per key, the values of its first row, even where they are null.

    The rank limit is pushed below the shuffle by Spark, so every map task sends
    at most one row per key and a hot key costs one row per task.

    ``collapse`` suits a few keys that repeat very often with few different values
    (stores): equal rows of a file are first folded into one by a hash aggregate that
    keeps the smallest row number, and only what is left gets sorted. It shuffles
    twice, and first a row per key, values and file of a task: with many keys, or many
    values per key (drivers), that is more than the one row per key of the rank limit.

    ``placed`` gives the position of the row, too.
    """
    *coarse, fine = order
    columns = [*keys, *values]
    rows = df.select(*columns, *order)
    if collapse:
        rows = rows.groupBy(*columns, *coarse).agg(F.min(fine).alias(fine))
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return (
        rows.withColumn("_rank", F.row_number().over(ranked))
        .filter("_rank = 1")
        .select(*columns, *(order if placed else ()))
    )
