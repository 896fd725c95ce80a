"""Uniqueness of keys without shuffling them all: ranges from file footers first."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def key_ranges(spark: SparkSession, folder: str, key: str, kind: T.DataType) -> DataFrame:
    """(path, row_group, low, high, known) of every row group, from footers that executors read.

    A row group without statistics, or in a file that Python can't reach, is not known: it may
    hold any key. One whose keys are all null is known and has no bounds.
    """
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow.fs
        import pyarrow.parquet

        for batch in batches:
            rows = []
            for uri in batch["path"]:
                try:
                    system, name = pyarrow.fs.FileSystem.from_uri(uri)
                except (pa.ArrowInvalid, OSError):  # an address for Spark alone
                    rows.append((uri, 0, None, None, False))
                    continue
                with system.open_input_file(name) as file:
                    footer = pyarrow.parquet.ParquetFile(file).metadata
                column = footer.schema.names.index(key)
                for group in range(footer.num_row_groups):
                    told = footer.row_group(group).column(column)
                    bounds = told.statistics
                    if bounds is not None and bounds.has_min_max:
                        rows.append((uri, group, bounds.min, bounds.max, True))
                    else:
                        nulls = None if bounds is None else bounds.null_count
                        all_null = nulls == footer.row_group(group).num_rows
                        rows.append((uri, group, None, None, all_null))
            names = ["path", "row_group", "low", "high", "known"]
            yield pd.DataFrame(rows, columns=names, dtype=object)

    name = kind.simpleString()
    files = spark.read.format("binaryFile").load(folder).select("path")
    return files.mapInPandas(read, f"path string, row_group int, low {name}, high {name}, known boolean")


def contested_files(ranges: DataFrame) -> DataFrame:
    """(path, contested): whether a row group of the file shares keys with any other's range.

    Row groups are compared in the order of their least keys, in one window: there is a row for
    each of them, a million for 100 TB. If any isn't known, all files are contested.
    """
    order = Window.orderBy("low", "high")
    reached = F.max("high").over(order.rowsBetween(Window.unboundedPreceding, -1))
    following = F.lead("low").over(order)
    shares = F.coalesce(F.col("low") <= reached, F.lit(False)) | F.coalesce(
        following <= F.col("high"), F.lit(False)
    )
    told = ranges.select("path", shares.alias("shares"), (~F.col("known")).alias("unknown"))
    files = told.groupBy("path").agg(
        F.bool_or("shares").alias("shares"), F.bool_or("unknown").alias("unknown")
    )
    anywhere = F.bool_or("unknown").over(Window.partitionBy(F.lit(1)))
    return files.select("path", (F.col("shares") | anywhere).alias("contested"))


def _repeated_in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys that a task reads more than once, and null keys."""
    columns = [batch.column(0) for batch in batches]
    if columns:
        counted = pa.chunked_array(columns).value_counts()
        keys, copies = counted.field(0), counted.field(1)
        wanted = pa.compute.or_(pa.compute.greater(copies, 1), pa.compute.is_null(keys))
        yield pa.record_batch(
            [keys.filter(wanted), copies.filter(wanted)], names=["key", "copies"]
        )


def repeated_keys(spark: SparkSession, folder: str, key: str, kind: T.DataType) -> DataFrame:
    """Keys of a stored table that occur more than once, and null keys, with their number of rows.

    Where ranges don't meet, equal keys are in one row group, which one task reads: nothing
    is shuffled for them. Only files whose ranges meet are compared by shuffling their keys. A
    table written by ranges of its key is checked in one scan; one that isn't costs what
    ``audits.duplicate_keys`` costs. The driver holds the paths of files.
    """
    files = contested_files(key_ranges(spark, folder, key, kind)).collect()
    contested = [f.path for f in files if f.contested]
    alone = [f.path for f in files if not f.contested]
    schema = T.StructType([T.StructField(key, kind)])
    found = spark.createDataFrame([], f"key {kind.simpleString()}, copies long")
    if alone:
        keys = spark.read.schema(schema).parquet(*alone)
        found = found.unionByName(
            keys.mapInArrow(_repeated_in_task, f"key {kind.simpleString()}, copies long")
        )
    if contested:
        keys = spark.read.schema(schema).parquet(*contested).select(F.col(key).alias("key"))
        counted = keys.groupBy("key").agg(F.count("*").alias("copies"))
        found = found.unionByName(counted.filter("copies > 1 OR key IS NULL"))
    # A key is in one of both, but nulls may be in many tasks.
    return found.groupBy("key").agg(F.sum("copies").alias("copies")).withColumnRenamed("key", key)
