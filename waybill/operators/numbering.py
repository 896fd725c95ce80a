"""Running number of a row within its key group."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waybill.schemas import ROW_ORDER

_BUCKETS = 65_536
# From so many rows a group on, the list of hot keys (rows / limit at most) is broadcast: at 10**13
# rows it has 10**7. With smaller limits it is joined by sort-merge: it may have a key for every row,
# and Spark's guess of its size, from compressed files, would let it be broadcast.
_BROADCAST_FROM = 1_000_000


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int) -> DataFrame:
    """The key groups of more than ``hot_rows`` rows, null keys included.

    Counting every key would shuffle about as many rows as there are lines. So hash
    buckets, 65,536 at most, are counted first, and keys only inside the buckets
    that are large enough to hold such a group. There are at most
    rows / ``hot_rows`` such keys.
    """
    bucket = F.pmod(F.xxhash64(*keys), F.lit(_BUCKETS)).cast("int").alias("_bucket")
    rows = df.select(*keys, bucket)
    large = rows.groupBy("_bucket").count().filter(F.col("count") > hot_rows).select("_bucket")
    inside = rows.join(F.broadcast(large), "_bucket", "left_semi")
    counted = inside.groupBy(*keys).agg(F.count("*").alias("_rows"))
    return counted.filter(F.col("_rows") > hot_rows).select(*keys)


def _renamed(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, Column]:
    """``df`` with other names for the keys, and the null-safe match on them."""
    other = df.withColumnsRenamed({key: f"_of_{key}" for key in keys})
    match = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys])
    return other, match


def line_occurrence(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] = ROW_ORDER,
    ties: Sequence[str] = (),
    name: str = "occurrence",
    hot_rows: int = 50_000_000,
    slice_rows: int = 10_000_000,
    before: DataFrame | None = None,
) -> DataFrame:
    """Number the rows of each key group from 0 in row order.

    Ordinary groups take one window. Groups of more than ``hot_rows`` rows are cut into
    slices (file and block of row numbers), numbered per slice, and shifted by the size
    of the group's earlier slices, so no task sorts a whole hot group. Both ways
    give the same numbers. ``ties`` makes reruns agree when ``order`` is not unique.

    ``before`` (keys that aren't null, ``earlier``) tells how many rows of a group have numbers already:
    its rows go on from there. Ordinary rows are shuffled by their keys alone then, once for that join
    and their window; hot ones meet the few counts of their groups by broadcast.
    """
    columns = [*df.columns, name]
    few = hot_rows >= _BROADCAST_FROM
    listed = hot_keys(df, keys, hot_rows)
    block = F.floor(F.col(order[1]) / slice_rows)
    if not few and before is None:  # one join for all rows, as nearly all may be hot
        hot, is_hot = _renamed(listed.withColumn("_hot", F.lit(True)), keys)
        rows = df.join(hot.hint("merge"), is_hot, "left").select(
            *df.columns,
            "_hot",
            F.when(F.col("_hot"), F.col(order[0])).alias("_file"),
            F.when(F.col("_hot"), block).alias("_block"),
        )
        return _by_slices(rows, keys, order, ties, name, few).select(columns)

    hot, is_hot = _renamed(listed, keys)
    hot = F.broadcast(hot) if few else hot.hint("merge")
    ordinary, sliced = df.join(hot, is_hot, "left_anti"), df.join(hot, is_hot, "left_semi")
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(*order, *ties)) - 1
    sliced = _by_slices(
        sliced.select(
            "*", F.lit(True).alias("_hot"), F.col(order[0]).alias("_file"), block.alias("_block")
        ),
        keys, order, ties, name, few,
    )
    if before is None:
        ordinary = ordinary.withColumn(name, number)
    else:
        earlier = F.coalesce("earlier", F.lit(0))
        ordinary = ordinary.join(before.hint("merge"), keys, "left").withColumn(name, number + earlier)
        counts = before.join(hot, is_hot, "left_semi")
        counts = F.broadcast(counts) if few else counts.hint("merge")
        sliced = sliced.join(counts, keys, "left").withColumn(name, F.col(name) + earlier)
    return ordinary.select(columns).unionByName(sliced.select(columns))


def _by_slices(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], ties: Sequence[str], name: str, few: bool
) -> DataFrame:
    """Numbers within keys and slices (``_file``, ``_block``; null but for ``_hot`` rows), shifted by the
    size of the key's earlier slices. ``few``: there are few hot keys."""
    within = Window.partitionBy(*keys, "_file", "_block").orderBy(*order, *ties)
    numbered = rows.withColumn("_number", F.row_number().over(within) - 1)

    earlier = Window.partitionBy(*keys).orderBy("_file", "_block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    shifts = (
        rows.filter("_hot").groupBy(*keys, "_file", "_block").agg(F.count("*").alias("_rows"))
        .withColumn("_shift", F.sum("_rows").over(earlier))
        .filter("_shift > 0")
        .drop("_rows")
    )
    shifts, same_key = _renamed(shifts if few else shifts.hint("merge"), keys)
    shifts = shifts.withColumnsRenamed({"_file": "_of_file", "_block": "_of_block"})
    # Ordinary rows have a null slice and so never match.
    same_slice = (F.col("_file") == F.col("_of_file")) & (F.col("_block") == F.col("_of_block"))
    return numbered.join(shifts, same_key & same_slice, "left").withColumn(
        name, F.col("_number") + F.coalesce("_shift", F.lit(0))
    )
