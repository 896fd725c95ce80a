"""The seven core tables, each a lazy frame over the chunk scan.

Every job names the few columns it needs, so the scan reads only those.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.functions.columns import comma_part, phone_col
from waybill.operators.dedup import drop_null_keys, first_per_key
from waybill.operators.numbering import line_occurrence
from waybill.schemas import CORE, ROW_ORDER

LINE_KEYS = ["order_id", "item_id"]
DRIVER_KEYS = ["order_id", "driver_id"]
MEASURES = ("item_quantity", "item_price", "item_canceled_quantity", "item_discount")


# Key of each table of first rows, and the chunk columns that it keeps of them.
FIRST_ROWS = {
    "users": ("user_id", ("user_phone",)),
    "drivers": ("driver_id", ("driver_phone",)),
    "stores": ("store_id", ("store_address",)),
    "items": ("item_id", ("item_title", "item_category")),
    "orders": ("order_id", tuple(
        c for c in CORE["orders"].names if c not in ("order_id", "delivery_city")
    )),
}


def first_rows(chunk: DataFrame, table: str, placed: bool = False) -> DataFrame:
    """Rows of a core table that has the first row per key; with ``placed``, and its position."""
    key, values = FIRST_ROWS[table]
    # There are few stores. Of the others a task sends less if it keeps one row per key at once.
    first = first_per_key(
        drop_null_keys(chunk, [key]), [key], values, collapse=table == "stores", placed=placed
    )
    store_address, address_text = F.col("store_address"), F.col("address_text")
    derived = {
        "users": lambda: {"user_phone": phone_col(F.col("user_phone"))},
        "drivers": lambda: {"driver_phone": phone_col(F.col("driver_phone"))},
        "stores": lambda: {
            "store_name": comma_part(store_address, 1), "store_city": comma_part(store_address, 2)
        },
        "items": dict,
        "orders": lambda: {"delivery_city": comma_part(address_text, 1)},
    }
    columns = [*CORE[table].names, *(ROW_ORDER if placed else ())]
    return first.withColumns(derived[table]()).select(columns)


def users(chunk: DataFrame) -> DataFrame:
    return first_rows(chunk, "users")


def drivers(chunk: DataFrame) -> DataFrame:
    return first_rows(chunk, "drivers")


def stores(chunk: DataFrame) -> DataFrame:
    return first_rows(chunk, "stores")


def items(chunk: DataFrame) -> DataFrame:
    return first_rows(chunk, "items")


def orders(chunk: DataFrame) -> DataFrame:
    return first_rows(chunk, "orders")


def plain_lines(chunk: DataFrame) -> DataFrame:
    """Lines of known orders and items, with measures instead of nulls."""
    return (
        drop_null_keys(chunk, LINE_KEYS)
        .select(*LINE_KEYS, *MEASURES, "item_replaced_id", *ROW_ORDER)
        .na.fill(0, subset=list(MEASURES))
    )


def order_lines(chunk: DataFrame, **numbering: int | DataFrame | None) -> DataFrame:
    """Lines numbered within their order and item."""
    ties = [*MEASURES, "item_replaced_id"]
    return line_occurrence(plain_lines(chunk), LINE_KEYS, ties=ties, **numbering)


def order_items(chunk: DataFrame, **numbering: int) -> DataFrame:
    return identified(order_lines(chunk, **numbering))


def identified(lines: DataFrame) -> DataFrame:
    """Numbered lines with their text key."""
    return lines.withColumn("id", F.concat_ws("_", *LINE_KEYS, "occurrence")).select(
        CORE["order_items"].names
    )


def driver_pairs(chunk: DataFrame) -> DataFrame:
    """Distinct pairs of order and driver."""
    return drop_null_keys(chunk, DRIVER_KEYS).select(*DRIVER_KEYS).distinct()


def identified_pairs(pairs: DataFrame) -> DataFrame:
    """Pairs with their text key."""
    # The pairs are distinct, so the running number in the id is always 0.
    return (
        pairs.withColumn("id", F.concat_ws("_", *DRIVER_KEYS, F.lit(0)))
        .withColumn("is_final", F.lit(True))
        .select(CORE["order_drivers"].names)
    )


def order_drivers(chunk: DataFrame) -> DataFrame:
    return identified_pairs(driver_pairs(chunk))


def core_tables(chunk: DataFrame) -> dict[str, DataFrame]:
    return {
        "users": users(chunk),
        "drivers": drivers(chunk),
        "stores": stores(chunk),
        "items": items(chunk),
        "orders": orders(chunk),
        "order_items": order_items(chunk),
        "order_drivers": order_drivers(chunk),
    }

