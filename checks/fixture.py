"""The delivery chunk, derived from the given tables by one SELECT.

Spark and DuckDB run the same text; ``{name}`` stands for the source of a table.
Row order: chunk (as text), then order and line number. Chunk files, core tables
and marts are written to the shared folder once per application.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.plans.core import core_tables
from waybill.plans.incremental import append_chunks, refresh_marts
from waybill.plans.jobs import build_marts
from waybill.schemas import CORE, MARTS, ROW_ORDER
from waybill.session import fit, pin
from waybill.sinks.tables import write_core
from waybill.sinks.versions import Version, Versions
from waybill.sources.chunks import chunk_files, read_chunks
from waybill.sources.core_tables import read_core

TABLES = ("lineitem", "orders", "customer", "part", "nation", "region")

CHUNK_SQL = """
SELECT concat('chunk_', CAST(l.l_orderkey % 4 AS VARCHAR(10))) AS chunk_file,
 l.l_orderkey * 100 + l.l_linenumber AS chunk_row,
 l.l_orderkey AS order_id, o.o_custkey AS user_id,
 CASE WHEN o.o_custkey % 11 = 0 THEN NULL WHEN o.o_custkey % 7 = 0 THEN 'n/a'
  ELSE concat(CASE WHEN o.o_custkey % 2 = 0 THEN '8' ELSE '+7' END, ' (9',
   lpad(CAST(o.o_custkey % 100 AS VARCHAR(10)), 2, '0'), ') ',
   lpad(CAST(o.o_custkey AS VARCHAR(20)), 7, '0')) END AS user_phone,
 l.l_suppkey AS driver_id,
 CASE WHEN l.l_linenumber = 3 THEN NULL
  ELSE concat('8-90', CAST(l.l_linenumber AS VARCHAR(10)), '-',
   lpad(CAST(l.l_suppkey AS VARCHAR(20)), 7, '0')) END AS driver_phone,
 CAST(c.c_nationkey AS BIGINT) AS store_id,
 CASE WHEN c.c_nationkey % 10 = 9 THEN n.n_name
  ELSE concat('Store ', n.n_name, ' , ', r.r_name, ', st. ',
   CAST(c.c_nationkey AS VARCHAR(10))) END AS store_address,
 l.l_partkey AS item_id, p.p_name AS item_title, p.p_type AS item_category,
 CASE WHEN o.o_orderkey % 13 = 0 THEN c.c_mktsegment
  ELSE concat(c.c_mktsegment, ', ', c.c_name) END AS address_text,
 o.o_orderdate AS created_at,
 CASE WHEN o.o_orderkey % 19 <> 0
  THEN o.o_orderdate + INTERVAL '1' HOUR END AS paid_at,
 CASE WHEN o.o_orderstatus <> 'P'
  THEN o.o_orderdate + INTERVAL '2' HOUR END AS delivery_started_at,
 CASE WHEN o.o_orderstatus = 'F'
  THEN o.o_orderdate + INTERVAL '3' HOUR END AS delivered_at,
 CASE WHEN o.o_orderstatus = 'P' OR o.o_orderkey % 17 = 0
  THEN o.o_orderdate + INTERVAL '4' HOUR END AS canceled_at,
 o.o_orderpriority AS payment_type,
 CAST(o.o_orderkey % 10 AS INT) AS order_discount,
 CASE WHEN o.o_orderstatus = 'P' OR o.o_orderkey % 17 = 0 THEN
  CASE o.o_orderkey % 3 WHEN 0 THEN 'Ошибка приложения'
   WHEN 1 THEN 'Проблемы с оплатой' ELSE 'other' END
  END AS order_cancellation_reason,
 CASE WHEN o.o_orderkey % 23 <> 0
  THEN CAST(o.o_orderkey % 300 AS INT) END AS delivery_cost,
 CAST(l.l_quantity AS INT) AS item_quantity,
 CAST(floor(p.p_retailprice) AS INT) AS item_price,
 CASE WHEN l.l_returnflag = 'R' THEN CAST(l.l_quantity AS INT)
  WHEN l.l_returnflag = 'N' THEN 0 END AS item_canceled_quantity,
 CASE WHEN l.l_returnflag = 'A' THEN p.p_partkey + 1 END AS item_replaced_id,
 CASE WHEN l.l_discount > 0
  THEN CAST(round(l.l_discount * 100) AS INT) END AS item_discount
FROM {lineitem} l
JOIN {orders} o ON l.l_orderkey = o.o_orderkey
JOIN {customer} c ON o.o_custkey = c.c_custkey
JOIN {part} p ON l.l_partkey = p.p_partkey
JOIN {nation} n ON c.c_nationkey = n.n_nationkey
JOIN {region} r ON n.n_regionkey = r.r_regionkey
"""

# How Spark joins the same sources: the narrow ones first, then lines with orders, so that no row is
# shuffled once it has all its columns, and lines of an order are written together. Prices are floored
# before they are shuffled, which shortens them, and of equal keys one is.
_JOINS = CHUNK_SQL[CHUNK_SQL.index("FROM {lineitem}"):]
_SPARK_JOINS = """
FROM ({lineitem} l JOIN (SELECT p_partkey, p_name, p_type, floor(p_retailprice) AS p_retailprice
 FROM {part}) p ON l.l_partkey = p.p_partkey)
JOIN ({orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey
 JOIN {nation} n ON c.c_nationkey = n.n_nationkey
 JOIN {region} r ON n.n_regionkey = r.r_regionkey) ON l.l_orderkey = o.o_orderkey
"""

# The same rows in files that cut through orders, so that loads share orders, items and drivers.
_BY_ORDER, _BY_LINE = "l.l_orderkey % 4", "l.l_linenumber % 4"
SPREAD_SQL = CHUNK_SQL.replace(_BY_ORDER, _BY_LINE)
# One file with quantities and costs that aren't whole, as halves.
REJECTED_SQL = SPREAD_SQL.replace(
    "CAST(l.l_quantity AS INT) AS item_quantity",
    "l.l_quantity + CASE WHEN l.l_orderkey % 50 = 7 THEN 0.5 ELSE 0 END AS item_quantity",
).replace(
    "THEN CAST(o.o_orderkey % 300 AS INT) END AS delivery_cost",
    "THEN o.o_orderkey % 300 + CASE WHEN o.o_orderkey % 70 = 7 THEN 0.25 ELSE 0 END"
    " END AS delivery_cost",
)
LOADS = (0, 1, 2, 3)
OUT_OF_ORDER = (2, 0, 3, 1)

_written: dict[tuple[str, str, str], str] = {}
_writing = threading.RLock()


def derived_chunk(spark: SparkSession, sf_dir: str, sql: str = CHUNK_SQL) -> DataFrame:
    """The chunk as a lazy frame over the given tables."""
    pin(spark)
    paths = {t: f"{sf_dir}/{t}.parquet" for t in TABLES}
    fit(spark, chunk_files(spark, list(paths.values())).agg(F.sum("bytes")).first()[0])
    sources = {t: f"parquet.`{path}`" for t, path in paths.items()}
    rows = sql.replace(_JOINS, "").replace("p.p_partkey", "l.l_partkey")
    return spark.sql((rows + _SPARK_JOINS).format(**sources))


def written_chunks(spark: SparkSession, sf_dir: str) -> str:
    """Folder with the chunk files: the input every job starts from."""
    def write(folder: str) -> None:
        derived_chunk(spark, sf_dir).write.partitionBy(ROW_ORDER[0]).parquet(folder)

    return _once(spark, "chunks", sf_dir, write)


def written_core(spark: SparkSession, sf_dir: str) -> str:
    """Folder with the seven core tables, loaded from the chunk files."""
    def write(folder: str) -> None:
        write_core(core_tables(chunk(spark, sf_dir)), path=folder)

    return _once(spark, "core", sf_dir, write)


def written_marts(spark: SparkSession, sf_dir: str) -> str:
    """Folder with both marts, built from the core tables."""
    core_folder = written_core(spark, sf_dir)
    return _once(spark, "marts", sf_dir, lambda folder: build_marts(spark, core_folder, folder))


def chunk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scan of the chunk files. Parquet written by Spark need not keep the order
    of rows, so the files carry it in two columns."""
    folder = written_chunks(spark, sf_dir)
    return read_chunks(spark, folder, pattern=f"{ROW_ORDER[0]}=*", row_order=ROW_ORDER)


def core(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The seven core tables, read back from where they were written.

    Joins, marts and audits use several of them several times over; written
    tables are computed once, carry exact sizes, and survive lost executors.
    """
    return read_core(spark, path=written_core(spark, sf_dir), tables=CORE)


def stored_marts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Both marts, read back from where they were written."""
    folder = written_marts(spark, sf_dir)
    return {m: spark.read.schema(s).parquet(f"{folder}/{m}") for m, s in MARTS.items()}


def written_spread(spark: SparkSession, sf_dir: str) -> str:
    """Folder with chunk files that cut through orders."""
    def write(folder: str) -> None:
        derived_chunk(spark, sf_dir, SPREAD_SQL).write.partitionBy(ROW_ORDER[0]).parquet(folder)

    return _once(spark, "spread", sf_dir, write)


def written_fractions(spark: SparkSession, sf_dir: str) -> str:
    """Folder with chunk files in which some integers aren't whole."""
    def write(folder: str) -> None:
        rows = derived_chunk(spark, sf_dir, REJECTED_SQL)
        doubles = {c: F.col(c).cast("double") for c in ("item_quantity", "delivery_cost")}
        rows.withColumns(doubles).write.partitionBy(ROW_ORDER[0]).parquet(folder)

    return _once(spark, "fractions", sf_dir, write)


def lake(spark: SparkSession, sf_dir: str, order: tuple[int, ...] = LOADS) -> Version:
    """Tables loaded file by file. The marts are refreshed twice: before and after the last load."""
    spread = written_spread(spark, sf_dir)

    def load(folder: str) -> None:
        for number in order:
            if number == order[-1]:
                refresh_marts(spark, folder, period="year")
            append_chunks(
                spark, spread, folder, pattern=f"{ROW_ORDER[0]}=chunk_{number}",
                row_order=ROW_ORDER, load=f"load {number}",
            )
        refresh_marts(spark, folder)

    return Versions(spark, _once(spark, f"lake {order}", sf_dir, load)).current()


def strict_lake(spark: SparkSession, sf_dir: str) -> Version:
    """Tables loaded at once, with rejected values and orphans put aside."""
    fractions = written_fractions(spark, sf_dir)

    def load(folder: str) -> None:
        append_chunks(
            spark, fractions, folder, pattern=f"{ROW_ORDER[0]}=*", row_order=ROW_ORDER,
            rejects=True, keep_orphans=False,
        )

    return Versions(spark, _once(spark, "strict lake", sf_dir, load)).current()


def written_keys(spark: SparkSession, sf_dir: str) -> str:
    """Folder with order keys written by ranges, and one more file that repeats some of them."""
    def write(folder: str) -> None:
        keys = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderkey").alias("order_id"))
        ranged = keys.repartitionByRange(8, "order_id").sortWithinPartitions("order_id")
        ranged.write.parquet(folder)
        again = keys.filter("order_id % 997 = 5 AND order_id < 20000")
        again.coalesce(1).write.mode("append").parquet(folder)

    return _once(spark, "keys", sf_dir, write)


def shared_folder(spark: SparkSession) -> str:
    """A new folder that the driver and all executors share: below the checkpoint
    folder of the session, or else its warehouse."""
    root = (
        spark.sparkContext.getCheckpointDir()
        or spark.conf.get("spark.checkpoint.dir", None)
        or f"{spark.conf.get('spark.sql.warehouse.dir')}/scratch"
    )
    return f"{root.rstrip('/')}/waybill-{uuid.uuid4()}"


def _once(spark: SparkSession, what: str, sf_dir: str, write: Callable[[str], None]) -> str:
    """Write a data set once per application and given tables; return its folder."""
    key = spark.sparkContext.applicationId, what, sf_dir
    with _writing:
        if key not in _written:
            folder = shared_folder(spark)
            write(folder)
            _written[key] = folder
    return _written[key]
