"""The marts as plain Spark SQL over views ``bench_<table>``.

Everything is joined up front and each counter is its own distinct count: what
one gets by writing the definitions down. Yardstick for the plans in plans.marts,
and a second opinion on their results.
"""

from __future__ import annotations

_DATE = """year(created_at) AS year_num, month(created_at) AS month_num,
 dayofmonth(created_at) AS day_num"""
_TURNOVER = "CAST(item_quantity AS BIGINT) * item_price - coalesce(item_discount, 0)"
_REVENUE = (
    "(CAST(item_quantity AS BIGINT) - coalesce(item_canceled_quantity, 0)) * item_price"
    " - coalesce(item_discount, 0)"
)


def _rounded(above: str, below: str) -> str:
    return f"CAST(round(CAST({above} AS DECIMAL(20,0)) / nullif({below}, 0), 2) AS DOUBLE)"


LITERAL = {
    "mart_orders": f"""
WITH amounts AS (
 SELECT order_id, sum({_TURNOVER}) AS turnover_order, sum({_REVENUE}) AS revenue_order
 FROM bench_order_items GROUP BY order_id),
changes AS (
 SELECT order_id, int(count(DISTINCT driver_id) > 1) AS has_driver_change
 FROM bench_order_drivers GROUP BY order_id),
sums AS (
 SELECT {_DATE}, coalesce(delivery_city, store_city, 'UNKNOWN') AS city, store_id, store_name,
  coalesce(sum(turnover_order), 0) AS turnover, coalesce(sum(revenue_order), 0) AS revenue,
  coalesce(sum(delivery_cost), 0) AS cost,
  count(DISTINCT order_id) AS created_orders_cnt,
  count(DISTINCT if(delivered_at IS NOT NULL, order_id, NULL)) AS delivered_orders_cnt,
  count(DISTINCT if(canceled_at IS NOT NULL, order_id, NULL)) AS canceled_orders_cnt,
  count(DISTINCT if(delivered_at IS NOT NULL AND canceled_at IS NOT NULL, order_id, NULL))
   AS cancel_after_delivery_cnt,
  count(DISTINCT if(order_cancellation_reason IN ('Ошибка приложения', 'Проблемы с оплатой'),
   order_id, NULL)) AS service_error_cancel_cnt,
  count(DISTINCT user_id) AS buyers_cnt,
  coalesce(sum(has_driver_change), 0) AS driver_changes_cnt,
  count(DISTINCT driver_id) AS active_drivers_cnt
 FROM bench_orders LEFT JOIN bench_stores USING (store_id) LEFT JOIN amounts USING (order_id)
 LEFT JOIN changes USING (order_id) LEFT JOIN bench_order_drivers USING (order_id)
 GROUP BY ALL)
SELECT year_num, month_num, day_num, city, store_id, store_name, turnover, revenue,
 revenue - cost AS profit, created_orders_cnt, delivered_orders_cnt, canceled_orders_cnt,
 cancel_after_delivery_cnt, service_error_cancel_cnt, buyers_cnt,
 {_rounded('revenue', 'created_orders_cnt')} AS avg_check,
 {_rounded('created_orders_cnt', 'buyers_cnt')} AS orders_per_buyer,
 {_rounded('revenue', 'buyers_cnt')} AS revenue_per_buyer,
 driver_changes_cnt, active_drivers_cnt
FROM sums""",
    "mart_items": f"""
SELECT {_DATE}, coalesce(delivery_city, store_city, 'UNKNOWN') AS city, o.store_id, store_name,
 item_category, i.item_id, item_title, sum({_TURNOVER}) AS item_turnover,
 sum(item_quantity) AS ordered_qty, sum(coalesce(item_canceled_quantity, 0)) AS canceled_qty,
 count(DISTINCT o.order_id) AS orders_with_item_cnt,
 count(DISTINCT if(item_canceled_quantity > 0, o.order_id, NULL)) AS orders_with_item_cancel_cnt
FROM bench_order_items l JOIN bench_orders o ON l.order_id = o.order_id
LEFT JOIN bench_items i ON l.item_id = i.item_id
LEFT JOIN bench_stores s ON o.store_id = s.store_id
GROUP BY ALL""",
}
