"""Run registered queries beside their SQL and compare whole results.

    python -m checks.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from checks.oracle import ORACLE
from checks.queries import QUERIES

GIVEN = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in GIVEN:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')"
        )
    return connection


def difference(found: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs between a Spark result and its SQL; None if they are equal."""
    left, right = found.toArrow(), connection.sql(sql).to_arrow_table()
    if set(left.column_names) != set(right.column_names):
        return f"columns {sorted(left.column_names)} != {sorted(right.column_names)}"
    if left.num_rows != right.num_rows:
        return f"rows {left.num_rows} != {right.num_rows}"
    names = sorted(left.column_names)
    types = [
        (n, str(left.schema.field(n).type), str(right.schema.field(n).type))
        for n in names
        if str(left.schema.field(n).type) != str(right.schema.field(n).type)
    ]
    if types:
        return f"types {types}"
    one, two = (
        t.select(names).to_pandas().astype("object").where(lambda d: d.notna(), None)
        .map(repr).sort_values(names, ignore_index=True)
        for t in (left, right)
    )
    unequal = (one != two).any(axis=1)
    if unequal.any():
        return f"{unequal.sum()} rows:\n{pd.concat([one[unequal], two[unequal]]).head(6)}"
    return None


def main(spark: SparkSession, sf_dir: str, names: list[str]) -> int:
    connection = connect(sf_dir)
    failed = 0
    for name in names or QUERIES:
        start = time.time()
        try:
            result = QUERIES[name](spark, sf_dir)
            problem = difference(result, connection, ORACLE[name])
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{name:26s} {time.time() - start:6.2f}s {problem or 'equal'}", flush=True)
    print(f"{failed} of {len(names or QUERIES)} differ")
    return failed


if __name__ == "__main__":
    from waybill.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    sys.exit(bool(main(local_session(), folder, sys.argv[2:])))
