"""The same results in plain SQL, for DuckDB on the given tables.

The SQL follows the definitions literally - ranks instead of folded groups,
joined-up rows instead of weights - so that it checks the Spark plans from
another side.
"""

from __future__ import annotations

from checks.fixture import CHUNK_SQL, REJECTED_SQL, SPREAD_SQL, TABLES
from waybill.functions.columns import SERVICE_ERRORS

_CHUNK, _SPREAD, _HALVES = (
    sql.format(**{t: t for t in TABLES}) for sql in (CHUNK_SQL, SPREAD_SQL, REJECTED_SQL)
)


def _phone(column: str) -> str:
    digits = rf"regexp_replace({column}, '\P{{Nd}}', '', 'g')"
    return (
        f"CASE WHEN {digits} = '' THEN NULL WHEN {digits} LIKE '8%' "
        f"THEN '+7' || substr({digits}, 2) ELSE '+' || {digits} END"
    )


def _part(column: str, number: int) -> str:
    return (
        f"CASE WHEN {column} LIKE '%,%' "
        f"THEN regexp_replace(split_part({column}, ',', {number}), '^\\s+|\\s+$', '', 'g') END"
    )


def _first(key: str, *values: str) -> str:
    return f"""
SELECT {key}, {', '.join(values)} FROM chunk WHERE {key} IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY chunk_file, chunk_row) = 1"""


_ORDER_VALUES = (
    "user_id", "store_id", "address_text", "created_at", "paid_at", "delivery_started_at",
    "delivered_at", "canceled_at", "payment_type", "order_discount",
    "order_cancellation_reason", "delivery_cost",
)
_TURNOVER = "CAST(item_quantity AS BIGINT) * item_price - coalesce(item_discount, 0)"
_REVENUE = (
    "(CAST(item_quantity AS BIGINT) - coalesce(item_canceled_quantity, 0)) * item_price"
    " - coalesce(item_discount, 0)"
)
_FILLED = """coalesce(item_quantity, 0) AS item_quantity, coalesce(item_price, 0) AS item_price,
 coalesce(item_canceled_quantity, 0) AS item_canceled_quantity"""
_NUMBER = """row_number() OVER (PARTITION BY order_id, item_id
  ORDER BY chunk_file, chunk_row, coalesce(item_quantity, 0), coalesce(item_price, 0),
  coalesce(item_canceled_quantity, 0), coalesce(item_discount, 0),
  item_replaced_id NULLS FIRST) - 1"""
_SERVICE_ERROR = f"order_cancellation_reason IN {SERVICE_ERRORS}"
_DATE = """CAST(year(created_at) AS INTEGER) AS year_num,
 CAST(month(created_at) AS INTEGER) AS month_num, CAST(day(created_at) AS INTEGER) AS day_num"""
_CITY = "coalesce(delivery_city, store_city, 'UNKNOWN')"


def _ratio(above: str, below: str) -> str:
    """Two-place quotient in whole numbers, rounded half away from zero."""
    return (
        f"CAST(sign({above}) * ((200 * CAST(abs({above}) AS HUGEINT) + {below}) "
        f"// (2 * nullif({below}, 0))) AS DOUBLE) / 100"
    )


_CTES = {
    "chunk": _CHUNK,
    "c_users": f"SELECT user_id, {_phone('user_phone')} AS user_phone"
               f" FROM ({_first('user_id', 'user_phone')})",
    "c_drivers": f"SELECT driver_id, {_phone('driver_phone')} AS driver_phone"
                 f" FROM ({_first('driver_id', 'driver_phone')})",
    "c_stores": f"SELECT store_id, {_part('store_address', 1)} AS store_name,"
                f" {_part('store_address', 2)} AS store_city, store_address"
                f" FROM ({_first('store_id', 'store_address')})",
    "c_items": _first("item_id", "item_title", "item_category"),
    "c_orders": f"SELECT *, {_part('address_text', 1)} AS delivery_city"
                f" FROM ({_first('order_id', *_ORDER_VALUES)})",
    "c_order_items": f"""
SELECT concat_ws('_', order_id, item_id, {_NUMBER}) AS id, order_id, item_id, {_FILLED},
 item_replaced_id, coalesce(item_discount, 0) AS item_discount
FROM chunk WHERE order_id IS NOT NULL AND item_id IS NOT NULL""",
    "c_order_drivers": """
SELECT DISTINCT concat(order_id, '_', driver_id, '_0') AS id, order_id, driver_id,
 true AS is_final
FROM chunk WHERE order_id IS NOT NULL AND driver_id IS NOT NULL""",
    "amounts": f"""
SELECT order_id, CAST(sum({_TURNOVER}) AS BIGINT) AS turnover_order,
 CAST(sum({_REVENUE}) AS BIGINT) AS revenue_order
FROM c_order_items GROUP BY order_id""",
    "changes": """
SELECT order_id, CASE WHEN count(DISTINCT driver_id) > 1 THEN 1 ELSE 0 END AS has_driver_change,
 count(DISTINCT driver_id) AS active_drivers_per_order
FROM c_order_drivers GROUP BY order_id""",
    # One row per order and driver, as the definition of the mart has it.
    "fanned": f"""
SELECT {_DATE}, {_CITY} AS city, store_id, store_name, order_id, user_id, driver_id,
 turnover_order, revenue_order, delivery_cost, has_driver_change,
 delivered_at, canceled_at, order_cancellation_reason
FROM c_orders LEFT JOIN c_stores USING (store_id) LEFT JOIN amounts USING (order_id)
LEFT JOIN changes USING (order_id) LEFT JOIN c_order_drivers USING (order_id)""",
    "order_sums": f"""
SELECT year_num, month_num, day_num, city, store_id, store_name,
 CAST(coalesce(sum(turnover_order), 0) AS BIGINT) AS turnover,
 CAST(coalesce(sum(revenue_order), 0) AS BIGINT) AS revenue,
 CAST(coalesce(sum(delivery_cost), 0) AS BIGINT) AS cost,
 count(DISTINCT order_id) AS created_orders_cnt,
 count(DISTINCT order_id) FILTER (delivered_at IS NOT NULL) AS delivered_orders_cnt,
 count(DISTINCT order_id) FILTER (canceled_at IS NOT NULL) AS canceled_orders_cnt,
 count(DISTINCT order_id) FILTER (delivered_at IS NOT NULL AND canceled_at IS NOT NULL)
  AS cancel_after_delivery_cnt,
 count(DISTINCT order_id) FILTER ({_SERVICE_ERROR}) AS service_error_cancel_cnt,
 count(DISTINCT user_id) AS buyers_cnt,
 CAST(coalesce(sum(has_driver_change), 0) AS BIGINT) AS driver_changes_cnt,
 count(DISTINCT driver_id) AS active_drivers_cnt
FROM fanned GROUP BY ALL""",
    "m_orders": f"""
SELECT year_num, month_num, day_num, city, store_id, store_name,
 turnover, revenue, revenue - cost AS profit,
 created_orders_cnt, delivered_orders_cnt, canceled_orders_cnt, cancel_after_delivery_cnt,
 service_error_cancel_cnt, buyers_cnt,
 {_ratio('revenue', 'created_orders_cnt')} AS avg_check,
 {_ratio('created_orders_cnt', 'buyers_cnt')} AS orders_per_buyer,
 {_ratio('revenue', 'buyers_cnt')} AS revenue_per_buyer,
 driver_changes_cnt, active_drivers_cnt
FROM order_sums""",
    "m_items": f"""
SELECT {_DATE}, {_CITY} AS city, o.store_id, store_name, item_category, i.item_id, item_title,
 CAST(sum({_TURNOVER}) AS BIGINT) AS item_turnover,
 CAST(sum(item_quantity) AS BIGINT) AS ordered_qty,
 CAST(sum(coalesce(item_canceled_quantity, 0)) AS BIGINT) AS canceled_qty,
 count(DISTINCT o.order_id) AS orders_with_item_cnt,
 count(DISTINCT o.order_id) FILTER (item_canceled_quantity > 0) AS orders_with_item_cancel_cnt
FROM c_order_items l JOIN c_orders o ON l.order_id = o.order_id
LEFT JOIN c_items i ON l.item_id = i.item_id LEFT JOIN c_stores s ON o.store_id = s.store_id
GROUP BY ALL""",
}

_CORE = tuple(name for name in _CTES if name.startswith("c_"))


def _query(body: str, *ctes: str) -> str:
    """The body behind the named common table expressions, in their own order."""
    wanted = {"chunk", *ctes}
    parts = [f"{name} AS ({sql})" for name, sql in _CTES.items() if name in wanted]
    return "WITH " + ",\n".join(parts) + "\n" + body


_FAN = ("c_orders", "c_stores", "c_order_items", "c_order_drivers", "amounts", "changes",
        "fanned", "order_sums", "m_orders")
_MARTS = (*_CORE, *_FAN, "m_items")


def _key_audit(table: str, key: str) -> str:
    return f"""
SELECT '{table}' AS table_name, '{key}' AS key_name, CAST(count(*) AS BIGINT) AS rows_cnt,
 count(DISTINCT {key}) AS keys_cnt,
 (SELECT count(*) FROM (SELECT {key} FROM c_{table} GROUP BY {key}
   HAVING count(*) > 1 OR {key} IS NULL)) AS violations_cnt
FROM c_{table}"""


def _reference_audit(child: str, column: str, parent: str, key: str) -> str:
    return f"""
SELECT '{child}' AS table_name, '{column}' AS column_name, '{parent}' AS parent_name,
 count(DISTINCT {column}) AS orphan_keys_cnt, count(*) AS orphan_rows_cnt
FROM c_{child} WHERE {column} IS NOT NULL
 AND {column} NOT IN (SELECT {key} FROM c_{parent})"""


def _rule_audit(source: str, table: str, column: str, rule: str, breach: str) -> str:
    return f"""
SELECT '{table}' AS table_name, '{column}' AS column_name, '{rule}' AS rule_name,
 count(*) AS rows_cnt, count(*) FILTER ({breach}) AS violations_cnt FROM {source}"""


def _union(parts: list[str]) -> str:
    return "\nUNION ALL".join(parts)


_NOT_NULL = [
    _rule_audit(source, mart, column, "not null", f"{column} IS NULL")
    for source, mart, columns in (
        ("m_orders", "mart_orders", "year_num month_num day_num city store_id"),
        ("m_items", "mart_items",
         "year_num month_num day_num city store_id item_category item_id"),
    )
    for column in columns.split()
]
_RANGES = [
    _rule_audit(source, table, column, f"length <= {width}", f"length({column}) > {width}")
    for source, table, column, width in (
        ("c_users", "users", "user_phone", 20),
        ("c_drivers", "drivers", "driver_phone", 20),
        ("c_orders", "orders", "payment_type", 50),
        ("m_orders", "mart_orders", "city", 100),
        ("m_items", "mart_items", "city", 100),
        ("m_items", "mart_items", "item_category", 100),
    )
] + [
    _rule_audit(f"c_{table}", table, column, "smallint",
                f"{column} NOT BETWEEN -32768 AND 32767")
    for table, column in (
        ("orders", "order_discount"),
        ("order_items", "item_quantity"),
        ("order_items", "item_canceled_quantity"),
        ("order_items", "item_discount"),
    )
]

_SMALL_ITEMS = """SELECT id, order_id, item_id, CAST(item_quantity AS {0}) AS item_quantity,
 item_price, CAST(item_canceled_quantity AS {0}) AS item_canceled_quantity, item_replaced_id,
 CAST(item_discount AS {0}) AS item_discount FROM c_order_items"""

ORACLE: dict[str, str] = {
    "chunk_scan": _query("SELECT * EXCLUDE (chunk_file, chunk_row) FROM chunk"),
    "drop_null_keys": _query(
        "SELECT order_id, item_replaced_id, item_id FROM chunk"
        " WHERE order_id IS NOT NULL AND item_replaced_id IS NOT NULL"
    ),
    "fill_measures": _query(
        f"SELECT order_id, item_id, {_FILLED},"
        " coalesce(item_discount, 0) AS item_discount FROM chunk"
    ),
    "surrogate_key": _query(
        "SELECT id, order_id, item_id FROM c_order_items", "c_order_items"
    ),
    "line_occurrence": _query(
        f"SELECT order_id, item_id, chunk_row, {_NUMBER} AS occurrence FROM chunk"
    ),
    "line_occurrence_sliced": _query(
        f"SELECT order_id, item_id, chunk_row, {_NUMBER} AS occurrence FROM chunk"
    ),
    "clean_phones": _query(f"""
SELECT 'user' AS party, user_id AS party_id, user_phone AS raw_phone,
 {_phone('user_phone')} AS phone FROM ({_first('user_id', 'user_phone')})
UNION ALL
SELECT 'driver', driver_id, driver_phone, {_phone('driver_phone')}
FROM ({_first('driver_id', 'driver_phone')})"""),
    "store_address_parts": _query(
        f"SELECT DISTINCT store_address, {_part('store_address', 1)} AS store_name,"
        f" {_part('store_address', 2)} AS store_city FROM chunk"
    ),
    "delivery_city": _query(
        f"SELECT DISTINCT order_id, address_text, {_part('address_text', 1)} AS delivery_city"
        " FROM chunk"
    ),
    "distinct_order_drivers": _query("SELECT DISTINCT order_id, driver_id FROM chunk"),
    "first_per_key": _query(_first("driver_id", "driver_phone", "order_id")),
    "core_users": _query("SELECT * FROM c_users", "c_users"),
    "core_drivers": _query("SELECT * FROM c_drivers", "c_drivers"),
    "core_stores": _query("SELECT * FROM c_stores", "c_stores"),
    "core_items": _query("SELECT * FROM c_items", "c_items"),
    "core_orders": _query("SELECT * FROM c_orders", "c_orders"),
    "core_order_items": _query(_SMALL_ITEMS.format("INTEGER"), "c_order_items"),
    "core_order_drivers": _query("SELECT * FROM c_order_drivers", "c_order_drivers"),
    "service_error_orders": _query(
        f"SELECT order_id, user_id, order_cancellation_reason FROM c_orders"
        f" WHERE {_SERVICE_ERROR}",
        "c_orders",
    ),
    "order_city": _query(
        f"SELECT order_id, {_CITY} AS city FROM c_orders LEFT JOIN c_stores USING (store_id)",
        "c_orders", "c_stores",
    ),
    "line_amounts": _query(
        f"SELECT id, {_TURNOVER} AS turnover, {_REVENUE} AS revenue FROM c_order_items",
        "c_order_items",
    ),
    "order_date_parts": _query(f"SELECT order_id, {_DATE} FROM c_orders", "c_orders"),
    "join_items_orders": _query(
        "SELECT id, order_id, item_id, user_id, store_id"
        " FROM c_order_items JOIN c_orders USING (order_id)",
        "c_order_items", "c_orders",
    ),
    "join_orders_stores": _query(
        "SELECT order_id, store_id, store_name, store_city"
        " FROM c_orders LEFT JOIN c_stores USING (store_id)",
        "c_orders", "c_stores",
    ),
    "join_order_aggs": _query(
        "SELECT order_id, turnover_order, revenue_order, has_driver_change"
        " FROM c_orders LEFT JOIN amounts USING (order_id) LEFT JOIN changes USING (order_id)",
        "c_orders", "c_order_items", "c_order_drivers", "amounts", "changes",
    ),
    "driver_fanout": _query(
        "SELECT order_id, delivery_cost, driver_id"
        " FROM c_orders LEFT JOIN c_order_drivers USING (order_id)",
        "c_orders", "c_order_drivers",
    ),
    "order_items_agg": _query("SELECT * FROM amounts", "c_order_items", "amounts"),
    "driver_stats": _query("SELECT * FROM changes", "c_order_drivers", "changes"),
    "order_status_counts": _query(f"""
SELECT store_id, {_DATE}, count(DISTINCT order_id) AS created_orders_cnt,
 count(DISTINCT CASE WHEN delivered_at IS NOT NULL THEN order_id END) AS delivered_orders_cnt,
 count(DISTINCT CASE WHEN canceled_at IS NOT NULL THEN order_id END) AS canceled_orders_cnt,
 count(DISTINCT CASE WHEN delivered_at IS NOT NULL AND canceled_at IS NOT NULL
  THEN order_id END) AS cancel_after_delivery_cnt,
 count(DISTINCT CASE WHEN {_SERVICE_ERROR} THEN order_id END) AS service_error_cancel_cnt,
 count(DISTINCT user_id) AS buyers_cnt
FROM c_orders GROUP BY ALL""", "c_orders"),
    "store_day_ratios": _query(f"""
SELECT store_id, year_num, month_num, day_num, {_ratio('revenue', 'orders_cnt')} AS avg_check,
 {_ratio('orders_cnt', 'buyers_cnt')} AS orders_per_buyer,
 {_ratio('revenue', 'buyers_cnt')} AS revenue_per_buyer
FROM (SELECT store_id, {_DATE}, coalesce(sum(revenue_order), 0) AS revenue,
  count(*) AS orders_cnt, count(DISTINCT user_id) AS buyers_cnt
 FROM c_orders LEFT JOIN amounts USING (order_id) GROUP BY ALL)""",
        "c_orders", "c_order_items", "amounts"),
    "mart_orders": _query(
        "SELECT * REPLACE (CAST(turnover AS DOUBLE) AS turnover, CAST(revenue AS DOUBLE) AS"
        " revenue, CAST(profit AS DOUBLE) AS profit) FROM m_orders", *_FAN),
    "core_views": _query(
        "SELECT s.store_id, s.store_city, count(DISTINCT o.order_id) AS orders_cnt,"
        " count(*) AS lines_cnt FROM c_orders o JOIN c_order_items l USING (order_id)"
        " LEFT JOIN c_stores s ON s.store_id = o.store_id GROUP BY ALL",
        "c_orders", "c_stores", "c_order_items"),
    "mart_items": _query(
        "SELECT * FROM m_items", "c_orders", "c_stores", "c_order_items", "c_items", "m_items"
    ),
    "audit_keys": _query(
        _union([
            _key_audit("users", "user_id"),
            _key_audit("drivers", "driver_id"),
            _key_audit("stores", "store_id"),
            _key_audit("items", "item_id"),
            _key_audit("orders", "order_id"),
            _key_audit("order_items", "id"),
            _key_audit("order_drivers", "id"),
        ]), *_CORE),
    "audit_references": _query(
        _union([
            _reference_audit("orders", "user_id", "users", "user_id"),
            _reference_audit("orders", "store_id", "stores", "store_id"),
            _reference_audit("order_items", "order_id", "orders", "order_id"),
            _reference_audit("order_items", "item_id", "items", "item_id"),
            _reference_audit("order_items", "item_replaced_id", "items", "item_id"),
            _reference_audit("order_drivers", "order_id", "orders", "order_id"),
            _reference_audit("order_drivers", "driver_id", "drivers", "driver_id"),
        ]), *_CORE),
    "audit_nulls": _query(_union(_NOT_NULL), *_MARTS),
    "audit_ranges": _query(_union(_RANGES), *_MARTS),
}

# The sinks must give back the mart as it is.
ORACLE |= {
    name: ORACLE["mart_orders"] for name in ("mart_refresh", "mart_recreate", "mart_versions")
}

# Files loaded one at a time must give what loading them together gives, in the stored types.
_STORED = {
    "users": ORACLE["core_users"],
    "stores": ORACLE["core_stores"],
    "orders": _query("SELECT * REPLACE (CAST(order_discount AS SMALLINT) AS order_discount)"
                     " FROM c_orders", "c_orders"),
    "order_items": _query(_SMALL_ITEMS.format("SMALLINT"), "c_order_items"),
    "order_drivers": ORACLE["core_order_drivers"],
    "mart_orders": ORACLE["mart_orders"],
    "mart_items": ORACLE["mart_items"].replace(
        "SELECT * FROM m_items",
        "SELECT * REPLACE (CAST(item_turnover AS DOUBLE) AS item_turnover) FROM m_items",
    ),
}
ORACLE |= {f"loaded_{table}": sql.replace(_CHUNK, _SPREAD) for table, sql in _STORED.items()}
ORACLE["buyer_rollups"] = _query(f"""
SELECT {_CITY} AS city, CAST(date_trunc('month', created_at) AS DATE) AS month,
 count(DISTINCT user_id) AS buyers_cnt
FROM c_orders LEFT JOIN c_stores USING (store_id) GROUP BY ALL
UNION ALL
SELECT {_CITY} AS city, NULL, count(DISTINCT user_id)
FROM c_orders LEFT JOIN c_stores USING (store_id) GROUP BY ALL""",
    "c_orders", "c_stores").replace(_CHUNK, _SPREAD)

# Rows with values that aren't whole are put aside, and lines of replaced items that nobody has.
_WHOLE = """SELECT * REPLACE (CAST(item_quantity AS INT) AS item_quantity) FROM halves
WHERE coalesce(item_quantity = floor(item_quantity), true)
 AND coalesce(delivery_cost = floor(delivery_cost), true)"""
ORACLE["rejected_values"] = f"""WITH halves AS ({_HALVES})
SELECT chunk_file, chunk_row, 'item_quantity' AS column_name,
 CAST(item_quantity AS DOUBLE) AS value FROM halves WHERE item_quantity <> floor(item_quantity)
UNION ALL
SELECT chunk_file, chunk_row, 'delivery_cost', CAST(delivery_cost AS DOUBLE)
FROM halves WHERE delivery_cost <> floor(delivery_cost)"""


def _strict_lines(known: str) -> str:
    lines = _query(_SMALL_ITEMS.format("SMALLINT"), "c_order_items").replace(_CHUNK, _WHOLE)
    halves = lines.replace("WITH chunk AS", f"WITH halves AS ({_HALVES}),\nchunk AS", 1)
    return f"{halves} WHERE {known}"


_STRAY = "item_replaced_id NOT IN (SELECT item_id FROM c_order_items)"
ORACLE["orphan_lines"] = _strict_lines(f"item_replaced_id IS NOT NULL AND {_STRAY}")
ORACLE["lines_in_force"] = _strict_lines(f"item_replaced_id IS NULL OR NOT ({_STRAY})")
ORACLE["audit_keys_by_range"] = """
SELECT o_orderkey AS order_id, CAST(1 + count(*) AS BIGINT) AS copies FROM orders
WHERE o_orderkey % 997 = 5 AND o_orderkey < 20000 GROUP BY o_orderkey"""
