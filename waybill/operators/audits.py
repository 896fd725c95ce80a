"""Integrity audits: what a relational database would enforce, reported as rows."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.schemas import MARTS, PRIMARY_KEYS, REFERENCES, TEXT_WIDTHS, smallints

_SMALLEST, _LARGEST = -32768, 32767


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, and null keys, with their number of rows."""
    return df.groupBy(key).agg(F.count("*").alias("copies")).filter(
        (F.col("copies") > 1) | F.col(key).isNull()
    )


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Non-null values of ``column`` missing in the parent, with their number of rows.

    Equal values are counted before the join, so a hot value is a single row there.
    """
    used = child.filter(F.col(column).isNotNull()).groupBy(column).agg(
        F.count("*").alias("child_rows")
    )
    known = parent.select(F.col(parent_key).alias(column))
    return used.join(known, column, "left_anti")


def audit_keys(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Per core table: rows, distinct keys, and keys that are repeated or null."""
    def check(table: str, key: str) -> DataFrame:
        copies = F.col("copies")
        return tables[table].groupBy(key).agg(F.count("*").alias("copies")).agg(
            F.lit(table).alias("table_name"),
            F.lit(key).alias("key_name"),
            F.coalesce(F.sum(copies), F.lit(0)).alias("rows_cnt"),
            F.count(key).alias("keys_cnt"),
            F.count_if((copies > 1) | F.col(key).isNull()).alias("violations_cnt"),
        )

    return _stack([check(table, key) for table, key in PRIMARY_KEYS.items()])


def audit_references(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Per reference: values missing in the parent table and the rows that use them."""
    def check(child: str, column: str, parent: str) -> DataFrame:
        missing = orphans(tables[child], column, tables[parent], PRIMARY_KEYS[parent])
        return missing.agg(
            F.lit(child).alias("table_name"),
            F.lit(column).alias("column_name"),
            F.lit(parent).alias("parent_name"),
            F.count("*").alias("orphan_keys_cnt"),
            F.coalesce(F.sum("child_rows"), F.lit(0)).alias("orphan_rows_cnt"),
        )

    return _stack([check(*reference) for reference in REFERENCES])


def audit_nulls(marts: Mapping[str, DataFrame]) -> DataFrame:
    """Per mart column declared NOT NULL: rows, and rows that are null."""
    def rules(mart: str) -> dict[tuple[str, str], Column]:
        required = [f.name for f in MARTS[mart] if not f.nullable]
        return {(column, "not null"): F.col(column).isNull() for column in required}

    return _stack([_count_breaches(mart, df, rules(mart)) for mart, df in marts.items()])


def audit_ranges(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Per limited column: rows, and rows too wide for the text or outside SMALLINT."""
    def rules(table: str) -> dict[tuple[str, str], Column]:
        found = {}
        for column, width in TEXT_WIDTHS.get(table, {}).items():
            found[column, f"length <= {width}"] = F.char_length(F.col(column)) > width
        for column in smallints(table) if table in PRIMARY_KEYS else ():
            found[column, "smallint"] = ~F.col(column).between(_SMALLEST, _LARGEST)
        return found

    checked = {table: rules(table) for table in tables}
    return _stack([_count_breaches(t, tables[t], r) for t, r in checked.items() if r])


def _count_breaches(
    table: str, df: DataFrame, rules: Mapping[tuple[str, str], Column]
) -> DataFrame:
    """One pass over ``df`` for all its rules, then one row per rule."""
    counts = df.agg(
        F.count("*").alias("rows_cnt"),
        *[F.count_if(breach).alias(f"_{i}") for i, breach in enumerate(rules.values())],
    )
    rows = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(column).alias("column_name"),
            F.lit(rule).alias("rule_name"),
            F.col("rows_cnt"),
            F.col(f"_{i}").alias("violations_cnt"),
        )
        for i, (column, rule) in enumerate(rules)
    ]
    return counts.select(F.inline(F.array(*rows)))


def _stack(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
