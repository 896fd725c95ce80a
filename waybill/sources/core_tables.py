"""Reading the core tables back: parquet folder, catalog database or JDBC."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from waybill.schemas import CORE
from waybill.session import pin

MART_INPUTS = ("orders", "stores", "order_items", "order_drivers", "items")


def read_core(
    spark: SparkSession,
    path: str | None = None,
    database: str | None = None,
    jdbc: Mapping[str, str] | None = None,
    partitioning: Mapping[str, Mapping[str, object]] | None = None,
    tables: Iterable[str] = MART_INPUTS,
) -> dict[str, DataFrame]:
    """The named core tables from exactly one of the three places.

    Over JDBC, ``partitioning`` gives per table the ``column``, ``lowerBound``,
    ``upperBound`` and ``numPartitions`` that split the read among executors.
    """
    if sum(place is not None for place in (path, database, jdbc)) != 1:
        raise ValueError("give one of path, database, jdbc")
    pin(spark)
    if path is not None:
        return {t: spark.read.schema(CORE[t]).parquet(f"{path}/{t}") for t in tables}
    if database is not None:
        return {t: spark.table(f"{database}.{t}") for t in tables}
    options = dict(jdbc)
    url = options.pop("url")
    split = partitioning or {}
    return {
        t: spark.read.jdbc(url, t, properties=options, **split.get(t, {})) for t in tables
    }


def register_core(tables: Mapping[str, DataFrame], prefix: str = "") -> None:
    """Make the tables visible to ``spark.sql`` as temporary views."""
    for name, frame in tables.items():
        frame.createOrReplaceTempView(prefix + name)
