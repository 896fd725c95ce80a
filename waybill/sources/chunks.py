"""Scan of the denormalised chunk files."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waybill.functions.columns import unfit, to_int, whole_number_text
from waybill.schemas import CHUNK, ROW_ORDER
from waybill.session import fit, pin

PATTERN = "chunk_*.parquet"
# Column of staged rows that lists what their file has and the contract can't take.
REJECTS = "rejects"

# Per application and set of files: how to read each group of files of one physical schema.
_known: dict[tuple, list[tuple[T.StructType, list[str] | None]]] = {}


def read_chunks(
    spark: SparkSession,
    path: str,
    pattern: str = PATTERN,
    strict: bool = True,
    row_order: Sequence[str] | None = None,
    files: Sequence[str] | None = None,
    rejects: bool = False,
) -> DataFrame:
    """All chunk files below ``path`` as one frame: 25 typed columns and the row order.

    Rows are ordered by whole file path, compared as text (chunk_10 before chunk_2),
    and by row number in the file. Files that were rewritten since may keep their
    former file and row number in two columns, named by ``row_order``. A path
    without chunk files is an error, and so is a file that lacks a column. ``files`` names the
    files to read instead of all that match.

    A fraction in an integer column fails the job, or is cut off if not ``strict``. With ``rejects``
    nothing fails: a further column lists the values of the row that don't fit (``staged``).

    Executors read every footer first, once per application unless a file's size or time
    changes. Files written by pandas may store the same column as integers in one file
    and, because of nulls, as floats in another. What Spark's reader can widen is read
    together; only files with 64-bit integers where others have floats are scanned apart.
    The driver holds one row per different set of types, and the paths of files only if
    they must be scanned apart.
    """
    pin(spark)
    places = list(files) if files is not None else f"{path.rstrip('/')}/{pattern}"
    reader = spark.read.option("basePath", path)
    scans = [
        reader.schema(_with_order(schema, row_order)).parquet(
            *(own if own is not None else [places] if files is None else places)
        )
        for schema, own in _groups(spark, places)
    ]
    return reduce(
        DataFrame.unionByName, [conform_chunk(s, strict, row_order, rejects) for s in scans]
    )


def chunk_files(spark: SparkSession, places: str | Sequence[str]) -> DataFrame:
    """(path, modified, bytes) of every file; contents are not read."""
    listed = spark.read.format("binaryFile").load(places)
    return listed.select(
        "path", F.unix_micros("modificationTime").alias("modified"), F.col("length").alias("bytes")
    )


def _groups(
    spark: SparkSession, places: str | Sequence[str]
) -> list[tuple[T.StructType, list[str] | None]]:
    """With which types to read which files; None stands for all of them."""
    told = chunk_files(spark, places).agg(
        F.count("*"), F.sum(F.xxhash64("path", "modified", "bytes").cast("decimal(38, 0)")),
        F.sum("bytes").alias("bytes"),
    ).first()
    fit(spark, told.bytes or 0)
    key = spark.sparkContext.applicationId, str(places), tuple(told)
    if key in _known:
        return _known[key]
    footers = footer_schemas(spark, places)
    first = F.min("path").alias("path")
    schemas = footers.groupBy("schema").agg(first).collect()
    if any(row.schema is None for row in schemas):
        footers = _inferred(spark, footers)
        schemas = footers.groupBy("schema").agg(first).collect()
    found = {row.schema: _physical(row.schema, row.path) for row in schemas}
    plans = _read_schemas(found)
    if len(set(map(str, plans.values()))) == 1:
        groups = [(next(iter(plans.values())), None)]
    else:
        groups = []
        for text in sorted(set(map(str, plans.values()))):
            own = [schema for schema, plan in plans.items() if str(plan) == text]
            paths = footers.filter(F.col("schema").isin(own)).select("path").collect()
            groups.append((plans[own[0]], sorted(row.path for row in paths)))
    _known[key] = groups
    return groups


def conform_chunk(
    df: DataFrame, strict: bool = True, row_order: Sequence[str] | None = None,
    rejects: bool = False,
) -> DataFrame:
    """Cast a raw chunk scan to the contract and add the row order, and with ``rejects`` the
    list of values that don't fit, which are null or cut off in their columns."""
    if row_order:
        file, row = (F.col(name) for name in row_order)
    else:
        file, row = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    have = {f.name: df.schema[f.name].dataType for f in CHUNK}
    bad = {f.name: unfit(F.col(f.name), have[f.name], f.dataType) for f in CHUNK if rejects}
    listed = [
        F.when(wrong, F.struct(F.lit(name).alias("column_name"),
                               F.col(name).cast("string").alias("value")))
        for name, wrong in bad.items() if wrong is not None
    ]

    def fitting(name: str) -> Column:
        return F.col(name) if bad.get(name) is None else F.when(~bad[name], F.col(name))

    kind = "array<struct<column_name: string, value: string>>"
    found = F.array_compact(F.array(*listed)) if listed else F.array()
    return df.select(
        *[_conform(fitting(f.name), have[f.name], f, strict).alias(f.name) for f in CHUNK],
        file.alias(ROW_ORDER[0]),
        row.alias(ROW_ORDER[1]),
        *([found.cast(kind).alias(REJECTS)] if rejects else ()),
    )


def _conform(value: Column, have: T.DataType, field: T.StructField, strict: bool) -> Column:
    if isinstance(field.dataType, T.IntegralType):
        return to_int(value, have, field.dataType, strict)
    if isinstance(field.dataType, T.TimestampType) and isinstance(have, T.LongType):
        return F.timestamp_micros(F.call_function("div", value, F.lit(1000)))
    if isinstance(field.dataType, T.StringType) and isinstance(have, (T.FloatType, T.DoubleType)):
        return whole_number_text(value, strict)
    return value.cast(field.dataType)


def footer_schemas(spark: SparkSession, places: str | Sequence[str]) -> DataFrame:
    """(schema, path) of every file, read by the executors; schema is null where the file
    system can't be reached from Python."""
    files = spark.read.format("binaryFile").load(places)
    return files.select("path").mapInPandas(_open_footers, "schema string, path string")


def _inferred(spark: SparkSession, footers: DataFrame) -> DataFrame:
    """The same with schemas of all files: Spark infers those that Python can't open, one by one."""
    def inferred(path: str) -> tuple[str, str]:
        have = {f.name: f.dataType for f in spark.read.parquet(path).schema}
        own = [T.StructField(f.name, have[f.name]) for f in CHUNK if f.name in have]
        return T.StructType(own).json(), path

    closed = [r.path for r in footers.filter("schema IS NULL").select("path").collect()]
    with ThreadPoolExecutor(16) as pool:
        schemas = list(pool.map(inheritable_thread_target(spark)(inferred), closed))
    told = spark.createDataFrame(schemas, "schema string, path string")
    return footers.filter("schema IS NOT NULL").unionByName(told)


def _schema_text(file) -> str:
    """The contract's columns that an open file has, with their types in Spark."""
    import pyarrow.parquet

    footer = pyarrow.parquet.ParquetFile(file)
    columns = [footer.schema.column(i) for i in range(len(footer.schema))]
    stored = {c.path: c.physical_type for c in columns}
    have = [
        T.StructField(
            f.name,
            # What Spark itself stores as a timestamp looks like nanoseconds elsewhere.
            T.TimestampType() if stored[f.name] == "INT96"
            else _spark_type(footer.schema_arrow.field(f.name).type),
        )
        for f in CHUNK
        if f.name in stored
    ]
    return T.StructType(have).json()


def _open_footers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import pyarrow as pa
    import pyarrow.fs

    for batch in batches:
        schemas = []
        for uri in batch["path"]:
            try:
                system, name = pyarrow.fs.FileSystem.from_uri(uri)
            except (pa.ArrowInvalid, OSError):  # an address for Spark alone
                schemas.append(None)
                continue
            with system.open_input_file(name) as file:
                schemas.append(_schema_text(file))
        yield pd.DataFrame({"schema": schemas, "path": batch["path"]})


def _physical(schema: str, path: str) -> dict[str, T.DataType]:
    types = {f.name: f.dataType for f in T._parse_datatype_json_string(schema)}
    missing = [f.name for f in CHUNK if f.name not in types]
    if missing:
        raise ValueError(f"{path} lacks the columns {', '.join(missing)}")
    return types


def _read_schemas(found: dict[str, dict[str, T.DataType]]) -> dict[str, T.StructType]:
    """With which types to read the files of each physical schema: the widest that all
    files can be read with, else the widest of their own kind."""
    small, floats = (T.ByteType, T.ShortType, T.IntegerType), (T.FloatType, T.DoubleType)

    def read_type(name: str, have: T.DataType) -> T.DataType:
        kinds = [types[name] for types in found.values()]
        if len(set(map(str, kinds))) == 1:
            return have
        if all(isinstance(k, small + floats) for k in kinds):
            return T.DoubleType() if any(isinstance(k, floats) for k in kinds) else T.IntegerType()
        if isinstance(have, small + (T.LongType,)):
            return T.LongType()
        return T.DoubleType() if isinstance(have, floats) else have

    return {
        schema: T.StructType([T.StructField(f.name, read_type(f.name, types[f.name])) for f in CHUNK])
        for schema, types in found.items()
    }


def _with_order(schema: T.StructType, row_order: Sequence[str] | None) -> T.StructType:
    if not row_order:
        return schema
    file, row = row_order
    return T.StructType([*schema, T.StructField(file, T.StringType()), T.StructField(row, T.LongType())])


def _spark_type(arrow) -> T.DataType:
    import pyarrow as pa
    from pyspark.sql.pandas.types import from_arrow_type

    if pa.types.is_null(arrow):  # a column without any value is stored as INT32
        return T.IntegerType()
    if pa.types.is_dictionary(arrow):
        return _spark_type(arrow.value_type)
    if pa.types.is_timestamp(arrow) and arrow.unit == "ns":  # see session.PINNED
        return T.LongType()
    return from_arrow_type(arrow, prefer_timestamp_ntz=True)
