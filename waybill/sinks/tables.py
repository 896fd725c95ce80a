"""Writing core tables and marts: parquet folder, catalog database or JDBC."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waybill.schemas import CORE, MARTS

BATCH_ROWS = 5000
_BY_ORDER = ("orders", "order_items", "order_drivers")


def conform(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Columns of the contract, in its order and types. Overflow fails the job."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in contract])


def write_core(
    tables: Mapping[str, DataFrame],
    path: str | None = None,
    database: str | None = None,
    jdbc: Mapping[str, str] | None = None,
    buckets: int | None = None,
    parallel: int = 4,
) -> None:
    """Full refresh: replace every given core table. Tables are written side by side.

    ``buckets`` (catalog only) stores the three order tables bucketed and sorted
    by order, after which the marts join and aggregate them without a shuffle.
    It is off by default: an order with a large share of all rows would fill one
    bucket, whereas an ordinary shuffle join is split by adaptive execution.
    """
    if sum(place is not None for place in (path, database, jdbc)) != 1:
        raise ValueError("give one of path, database, jdbc")
    if buckets and database is None:
        raise ValueError("buckets need a catalog database")

    def write(table: str) -> None:
        df = conform(tables[table], CORE[table])
        if path is not None:
            df.write.mode("overwrite").parquet(f"{path}/{table}")
        elif jdbc is not None:
            jdbc_writer(df, jdbc, table).save()
        elif buckets and table in _BY_ORDER:
            (
                df.repartition(buckets, "order_id").write.mode("overwrite").format("parquet")
                .bucketBy(buckets, "order_id").sortBy("order_id")
                .saveAsTable(f"{database}.{table}")
            )
        else:
            df.write.mode("overwrite").format("parquet").saveAsTable(f"{database}.{table}")

    with ThreadPoolExecutor(parallel) as pool:
        spark = next(iter(tables.values())).sparkSession
        list(pool.map(inheritable_thread_target(spark)(write), tables))


def ensure_mart(spark: SparkSession, mart: str, table: str | None = None) -> str:
    """Create an empty mart table in the catalog unless it exists; return its name.

    Columns stay nullable: groups without a date or store are kept and reported
    by the null audit.
    """
    table = table or mart
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in MARTS[mart])
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet")
    return table


def write_mart(
    df: DataFrame,
    mart: str,
    table: str | None = None,
    path: str | None = None,
    jdbc: Mapping[str, str] | None = None,
    keep_schema: bool = True,
) -> None:
    """Replace the rows of a mart.

    With ``keep_schema`` the existing table and its types stay and the rows are
    cast to the contract; without, the table is made anew with the types of ``df``.
    """
    if keep_schema:
        df = conform(df, MARTS[mart])
    if path is not None:
        df.write.mode("overwrite").parquet(path)
    elif jdbc is not None:
        jdbc_writer(df, jdbc, table or mart, truncate=keep_schema).save()
    elif keep_schema:
        name = ensure_mart(df.sparkSession, mart, table)
        # Spark inserts by position; the table may have its columns in another order.
        columns = df.sparkSession.table(name).columns
        if set(columns) != set(df.columns):
            raise ValueError(f"{name} has the columns {columns}, not {df.columns}")
        df.select(columns).write.insertInto(name, overwrite=True)
    else:
        df.write.mode("overwrite").format("parquet").saveAsTable(table or mart)


def jdbc_writer(
    df: DataFrame, jdbc: Mapping[str, str], table: str, truncate: bool = True,
    append: bool = False,
) -> DataFrameWriter:
    """Batched replacement of a database table, emptied rather than dropped by default; with
    ``append``, batches are added to its rows. A database can't tell a repeated append: load into
    versioned tables (``plans.incremental``) where that matters."""
    options = {
        "batchsize": str(BATCH_ROWS), **jdbc, "dbtable": table, "truncate": str(truncate).lower()
    }
    mode = "append" if append else "overwrite"
    return df.write.format("jdbc").mode(mode).options(**options)
