"""Daily marts by city and store.

``tables`` is a mapping of core tables by name. Everything rests on their keys:
an order, store or item occurs once in its own table.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waybill.functions.columns import (
    date_parts,
    is_service_error,
    line_revenue,
    line_turnover,
    order_city,
    ratio,
)
from waybill.schemas import MARTS

# Group key of both marts. Date parts and store name follow from it and are added
# after the aggregation, so that they take no part in any shuffle.
STORE_DAY = ("day", "city", "store_id")

_ORDER_COUNTS = (
    "created_orders_cnt",
    "delivered_orders_cnt",
    "canceled_orders_cnt",
    "cancel_after_delivery_cnt",
    "service_error_cancel_cnt",
)


def order_items_agg(order_items: DataFrame) -> DataFrame:
    """Turnover and revenue of each order."""
    return order_items.groupBy("order_id").agg(
        F.sum(line_turnover()).alias("turnover_order"),
        F.sum(line_revenue()).alias("revenue_order"),
    )


def driver_stats(order_drivers: DataFrame) -> DataFrame:
    """Driver change flag and number of distinct drivers of each order."""
    count = F.count_distinct("driver_id")
    return order_drivers.groupBy("order_id").agg(
        F.when(count > 1, 1).otherwise(0).alias("has_driver_change"),
        count.alias("active_drivers_per_order"),
    )


def driver_weights(order_drivers: DataFrame) -> DataFrame:
    """Per order: number of driver rows, and whether the drivers differ.

    Two drivers differ exactly when the smallest is not the largest, so no
    distinct count, and thus no second shuffle, is needed.
    """
    return order_drivers.groupBy("order_id").agg(
        F.count("*").alias("driver_rows"),
        (F.min("driver_id") < F.max("driver_id")).cast("int").alias("has_driver_change"),
    )


def order_flags() -> dict[str, Column]:
    """What each order counter counts, as conditions on an order row."""
    delivered, canceled = F.col("delivered_at").isNotNull(), F.col("canceled_at").isNotNull()
    conditions = (
        F.lit(True),
        delivered,
        canceled,
        delivered & canceled,
        F.coalesce(is_service_error(F.col("order_cancellation_reason")), F.lit(False)),
    )
    return dict(zip(_ORDER_COUNTS, conditions))


def at_store_day(orders: DataFrame, stores: DataFrame, *extra: str | Column) -> DataFrame:
    """Orders with their group key in front of ``extra``."""
    cities = stores.select("store_id", "store_city")
    return orders.join(cities, "store_id", "left").select(
        F.to_date("created_at").alias("day"),
        order_city(F.col("delivery_city"), F.col("store_city")).alias("city"),
        "store_id",
        *extra,
    )


def named(groups: DataFrame, stores: DataFrame) -> DataFrame:
    """Groups with the date parts and store name in place of the day."""
    names = stores.select("store_id", "store_name")
    return groups.select("*", *date_parts(F.col("day"))).join(names, "store_id", "left")


def mart_orders(tables: Mapping[str, DataFrame], drivers_placed: bool = False) -> DataFrame:
    """Order metrics by store and day.

    By definition an order joined to its drivers counts once per driver row in
    the sums. Instead of multiplying rows, amounts are multiplied by that
    number; order counters become plain sums, since an order is one row here.

    Buyers and drivers are made distinct beforehand, on rows of group and member
    only: that spreads a store holding a third of all orders over its members,
    and no rows are expanded per distinct count. What is left are sums, which
    one last aggregate combines before its shuffle, whatever a group's size.

    Weighted amounts are wide decimals: the turnover of an order with many lines,
    times its number of drivers, may pass 64 bits.

    ``drivers_placed``: they are stored in buckets by order, and needn't be shuffled at all.
    """
    orders, stores = tables["orders"], tables["stores"]
    order_drivers = tables["order_drivers"].select("order_id", "driver_id")
    if not drivers_placed:  # shuffled once, for the weights and for the join
        order_drivers = order_drivers.repartition("order_id")
    weight = F.coalesce("driver_rows", F.lit(1))

    def weighted(amount: str) -> Column:
        return F.col(amount).cast("decimal(19, 0)") * weight.cast("decimal(18, 0)")

    measures = {
        "turnover": weighted("turnover_order"),
        "revenue": weighted("revenue_order"),
        "cost": weighted("delivery_cost"),
        "driver_changes_cnt": F.col("has_driver_change") * weight,
        **{name: flag.cast("int") for name, flag in order_flags().items()},
    }
    whole_orders = orders.join(
        order_items_agg(tables["order_items"]), "order_id", "left"
    ).join(driver_weights(order_drivers), "order_id", "left")
    order_rows = at_store_day(
        whole_orders, stores, *[m.alias(name) for name, m in measures.items()]
    )

    def members(source: DataFrame, column: str, drives: bool) -> DataFrame:
        # Null members are not filtered, but counted as none: a filter would reach below the shuffle
        # of drivers and make it another one than that of the weights.
        columns = F.lit(drives).alias("drives"), F.col(column).alias("member")
        return at_store_day(source, stores, *columns)

    driven = orders.join(order_drivers, "order_id")
    distinct_members = (
        members(orders, "user_id", False).unionByName(members(driven, "driver_id", True))
        .distinct()
    )
    counts = F.col("member").isNotNull()
    member_rows = distinct_members.select(
        *STORE_DAY,
        (counts & ~F.col("drives")).cast("int").alias("buyers_cnt"),
        (counts & F.col("drives")).cast("int").alias("active_drivers_cnt"),
    )

    rows = order_rows.unionByName(member_rows, allowMissingColumns=True)
    summed = [c for c in rows.columns if c not in STORE_DAY]
    totals = rows.groupBy(*STORE_DAY).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in summed]
    )
    created, buyers, revenue = (
        F.col(c) for c in ("created_orders_cnt", "buyers_cnt", "revenue")
    )
    return (
        named(totals, stores)
        .withColumn("profit", revenue - F.col("cost"))
        .withColumn("avg_check", ratio(revenue, created))
        .withColumn("orders_per_buyer", ratio(created, buyers))
        .withColumn("revenue_per_buyer", ratio(revenue, buyers))
        .select(MARTS["mart_orders"].names)
    )


def mart_items(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Item metrics by store and day.

    Lines are folded to one row per order and item where they meet their order, which turns the
    distinct order counts into plain counts. These rows then go to their item, and
    all that follows - groups, titles, categories - stays there: lines are shuffled by order
    and by item, and not again. Lines whose item is unknown share one group with
    a null item, where an order may come with several items; they are few and are
    folded to orders first.
    """
    items = tables["items"]
    canceled = F.coalesce("item_canceled_quantity", F.lit(0))
    lines = tables["order_items"].select(
        "order_id", "item_id", line_turnover().alias("item_turnover"),
        F.col("item_quantity").alias("ordered_qty"), canceled.alias("canceled_qty"),
        (canceled > 0).cast("int").alias("has_cancel"),
    )
    placed = at_store_day(tables["orders"], tables["stores"], "order_id")
    sums = [F.sum(m).alias(m) for m in ("item_turnover", "ordered_qty", "canceled_qty")]
    counts = [
        F.count("*").alias("orders_with_item_cnt"),
        F.sum("has_cancel").alias("orders_with_item_cancel_cnt"),
    ]

    def folded(rows: DataFrame, *keys: str) -> DataFrame:
        """One row per order, or per order and item."""
        return rows.join(placed, "order_id").groupBy("order_id", *keys, *STORE_DAY).agg(
            *sums, F.max("has_cancel").alias("has_cancel")
        )

    known = (
        folded(lines, "item_id").join(items.select("item_id").hint("merge"), "item_id")
        .groupBy("item_id", *STORE_DAY).agg(*sums, *counts)
        .join(items, "item_id")
    )
    strays = folded(lines.join(items, "item_id", "left_anti")).groupBy(*STORE_DAY).agg(*sums, *counts)
    totals = known.unionByName(strays, allowMissingColumns=True)
    return named(totals, tables["stores"]).select(MARTS["mart_items"].names)
