"""Contracts of the chunk files, the core tables and the marts.

Types follow the relational model except where values grow with the volume of
the data: keys and counters are BIGINT instead of INT, amounts and ratios
DECIMAL(38, 2) instead of NUMERIC(15, 2) and NUMERIC(10, 2). 100 TB of order lines
hold more orders than an INT can number. Values that fit the narrow types are the
same in both, and a database table that is refreshed over JDBC keeps its own.
"""

from __future__ import annotations

from pyspark.sql import types as T

_KEY, _TEXT, _TIME = T.LongType(), T.StringType(), T.TimestampType()
_SMALL, _INT, _FLAG = T.ShortType(), T.IntegerType(), T.BooleanType()
_COUNT, _MONEY = T.LongType(), T.DecimalType(38, 2)


def _struct(required: tuple[str, ...] = (), **columns: T.DataType) -> T.StructType:
    return T.StructType(
        [T.StructField(name, kind, name not in required) for name, kind in columns.items()]
    )


# One row per order x item x driver line. Measures are INT here; they narrow to
# SMALLINT only when a table is written, after the range audit.
CHUNK = _struct(
    user_id=_KEY, user_phone=_TEXT,
    driver_id=_KEY, driver_phone=_TEXT,
    store_id=_KEY, store_address=_TEXT,
    item_id=_KEY, item_title=_TEXT, item_category=_TEXT,
    order_id=_KEY, address_text=_TEXT,
    created_at=_TIME, paid_at=_TIME, delivery_started_at=_TIME,
    delivered_at=_TIME, canceled_at=_TIME,
    payment_type=_TEXT, order_discount=_INT, order_cancellation_reason=_TEXT,
    delivery_cost=_INT,
    item_quantity=_INT, item_price=_INT, item_canceled_quantity=_INT,
    item_replaced_id=_KEY, item_discount=_INT,
)

# Position of a chunk row: the file it came from (as text) and its row number.
ROW_ORDER = ("chunk_file", "chunk_row")

CORE = {
    "users": _struct(user_id=_KEY, user_phone=_TEXT),
    "drivers": _struct(driver_id=_KEY, driver_phone=_TEXT),
    "stores": _struct(store_id=_KEY, store_name=_TEXT, store_city=_TEXT, store_address=_TEXT),
    "items": _struct(item_id=_KEY, item_title=_TEXT, item_category=_TEXT),
    "orders": _struct(
        order_id=_KEY, user_id=_KEY, store_id=_KEY, address_text=_TEXT, delivery_city=_TEXT,
        created_at=_TIME, paid_at=_TIME, delivery_started_at=_TIME, delivered_at=_TIME,
        canceled_at=_TIME, payment_type=_TEXT, order_discount=_SMALL,
        order_cancellation_reason=_TEXT, delivery_cost=_INT,
    ),
    "order_items": _struct(
        id=_TEXT, order_id=_KEY, item_id=_KEY, item_quantity=_SMALL, item_price=_INT,
        item_canceled_quantity=_SMALL, item_replaced_id=_KEY, item_discount=_SMALL,
    ),
    "order_drivers": _struct(id=_TEXT, order_id=_KEY, driver_id=_KEY, is_final=_FLAG),
}

MARTS = {
    "mart_orders": _struct(
        required=("year_num", "month_num", "day_num", "city", "store_id"),
        year_num=_INT, month_num=_INT, day_num=_INT, city=_TEXT, store_id=_KEY, store_name=_TEXT,
        turnover=_MONEY, revenue=_MONEY, profit=_MONEY,
        created_orders_cnt=_COUNT, delivered_orders_cnt=_COUNT, canceled_orders_cnt=_COUNT,
        cancel_after_delivery_cnt=_COUNT, service_error_cancel_cnt=_COUNT, buyers_cnt=_COUNT,
        avg_check=_MONEY, orders_per_buyer=_MONEY, revenue_per_buyer=_MONEY,
        driver_changes_cnt=_COUNT, active_drivers_cnt=_COUNT,
    ),
    "mart_items": _struct(
        required=("year_num", "month_num", "day_num", "city", "store_id", "item_category",
                  "item_id"),
        year_num=_INT, month_num=_INT, day_num=_INT, city=_TEXT, store_id=_KEY, store_name=_TEXT,
        item_category=_TEXT, item_id=_KEY, item_title=_TEXT,
        item_turnover=_MONEY, ordered_qty=_COUNT, canceled_qty=_COUNT,
        orders_with_item_cnt=_COUNT, orders_with_item_cancel_cnt=_COUNT,
    ),
}

# Constraints of the relational model, checked by operators.audits.
PRIMARY_KEYS = {
    "users": "user_id", "drivers": "driver_id", "stores": "store_id", "items": "item_id",
    "orders": "order_id", "order_items": "id", "order_drivers": "id",
}

# (child table, child column, parent table)
REFERENCES = (
    ("orders", "user_id", "users"),
    ("orders", "store_id", "stores"),
    ("order_items", "order_id", "orders"),
    ("order_items", "item_id", "items"),
    ("order_items", "item_replaced_id", "items"),
    ("order_drivers", "order_id", "orders"),
    ("order_drivers", "driver_id", "drivers"),
)

TEXT_WIDTHS = {
    "users": {"user_phone": 20},
    "drivers": {"driver_phone": 20},
    "orders": {"payment_type": 50},
    "mart_orders": {"city": 100},
    "mart_items": {"city": 100, "item_category": 100},
}


def smallints(table: str) -> list[str]:
    """Columns of a core table stored as SMALLINT."""
    return [f.name for f in CORE[table] if isinstance(f.dataType, T.ShortType)]
