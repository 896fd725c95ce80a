import random
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from checks.literal import LITERAL
from waybill.functions.columns import ratio
from waybill.plans import marts
from waybill.schemas import CORE, MARTS
from waybill.sources.core_tables import register_core

DAY = datetime(2024, 5, 6, 7)


@pytest.fixture
def make_core(spark):
    def make(**rows):
        return {
            table: spark.createDataFrame(
                [[row.get(c) for c in schema.names] for row in rows.get(table, [])], schema
            )
            for table, schema in CORE.items()
        }

    return make


def order(order_id, **columns):
    return {"order_id": order_id, "store_id": 1, "user_id": 1, "created_at": DAY, **columns}


def line(order_id, item_id=1, quantity=0, price=0, canceled=0, discount=0):
    return {
        "id": f"{order_id}_{item_id}", "order_id": order_id, "item_id": item_id,
        "item_quantity": quantity, "item_price": price, "item_canceled_quantity": canceled,
        "item_discount": discount,
    }


def driven(*pairs):
    return [{"id": f"{o}_{d}", "order_id": o, "driver_id": d} for o, d in pairs]


STORE = {"store_id": 1, "store_name": "S", "store_city": "C"}


def test_sums_count_once_per_driver(make_core):
    core = make_core(
        orders=[order(1, delivery_cost=10)], stores=[STORE],
        order_items=[line(1, quantity=10, price=10)], order_drivers=driven((1, 1), (1, 2), (1, 3)),
    )
    mart = marts.mart_orders(core)
    assert mart.columns == MARTS["mart_orders"].names
    row = mart.first()
    assert (row.turnover, row.revenue, row.profit) == (300, 300, 270)
    assert (row.driver_changes_cnt, row.active_drivers_cnt, row.created_orders_cnt) == (3, 3, 1)
    assert (row.year_num, row.month_num, row.day_num) == (2024, 5, 6)
    assert (row.city, row.store_name, row.avg_check) == ("C", "S", 300.0)


def test_order_without_lines_and_drivers(make_core):
    row = marts.mart_orders(make_core(orders=[order(1, delivery_cost=10)])).first()
    assert (row.turnover, row.revenue, row.profit) == (0, 0, -10)
    assert (row.city, row.store_name, row.active_drivers_cnt) == ("UNKNOWN", None, 0)


def test_no_buyers_give_null_ratios(make_core):
    row = marts.mart_orders(make_core(orders=[order(1, user_id=None)])).first()
    assert (row.buyers_cnt, row.orders_per_buyer, row.revenue_per_buyer) == (0, None, None)
    assert row.avg_check == 0


def test_cancellations(make_core):
    reason = "Проблемы с оплатой"
    row = marts.mart_orders(
        make_core(
            orders=[
                order(1, order_cancellation_reason=reason),
                order(2, canceled_at=DAY, delivered_at=DAY, user_id=2),
                order(3, canceled_at=DAY, order_cancellation_reason="other"),
            ]
        )
    ).first()
    assert row.created_orders_cnt == 3 and row.delivered_orders_cnt == 1
    assert row.canceled_orders_cnt == 2 and row.cancel_after_delivery_cnt == 1
    assert row.service_error_cancel_cnt == 1 and row.buyers_cnt == 2
    assert row.orders_per_buyer == 1.5


def test_null_keys_form_a_group(make_core):
    core = make_core(
        orders=[order(1, store_id=None, created_at=None), order(2, store_id=None, created_at=None)],
        order_drivers=driven((1, 4), (2, 4)),
    )
    (row,) = marts.mart_orders(core).collect()
    assert (row.year_num, row.store_id, row.created_orders_cnt) == (None, None, 2)
    assert (row.buyers_cnt, row.active_drivers_cnt) == (1, 1)


def test_orders_of_unknown_items_are_counted_once(make_core):
    core = make_core(
        orders=[order(1), order(2)], items=[{"item_id": 1, "item_title": "t"}],
        order_items=[
            line(1, 1, 2, 5, 1), line(1, 8, 1, 1, 1), line(1, 9, 1, 1, 1), line(2, 8, 3, 1),
        ],
    )
    found = {r.item_id: r for r in marts.mart_items(core).collect()}
    assert found[1].item_turnover == 10 and found[1].orders_with_item_cancel_cnt == 1
    stray = found[None]
    assert (stray.orders_with_item_cnt, stray.orders_with_item_cancel_cnt) == (2, 1)
    assert (stray.item_turnover, stray.ordered_qty, stray.canceled_qty) == (5, 5, 2)


@pytest.fixture
def random_core(make_core):
    """Random tables in which one order, store and item hold a third of the rows."""

    def make(seed):
        rng = random.Random(seed)

        def skewed(high):
            return 0 if rng.random() < 0.33 else rng.randrange(high)

        def maybe(value, share=0.2):
            return None if rng.random() < share else value

        pairs = {(skewed(80), rng.randrange(12)) for _ in range(200)}
        return make_core(
            stores=[
                {"store_id": s, "store_name": f"S{s % 3}", "store_city": maybe("C")}
                for s in range(5)
            ],
            items=[
                {"item_id": i, "item_title": maybe(f"t{i}"), "item_category": f"c{i % 3}"}
                for i in range(8)
            ],
            orders=[
                order(
                    o, user_id=maybe(rng.randrange(10)), store_id=maybe(skewed(7)),
                    created_at=maybe(datetime(2024, 1, rng.randrange(1, 4)), 0.1),
                    delivery_city=rng.choice([None, "", "C", "D"]),
                    delivered_at=maybe(DAY), canceled_at=maybe(DAY, 0.6),
                    delivery_cost=maybe(rng.randrange(50)),
                    order_cancellation_reason=rng.choice(
                        [None, "other", "Ошибка приложения", "Проблемы с оплатой"]
                    ),
                )
                for o in range(80)
            ],
            order_items=[
                {
                    **line(skewed(85), skewed(11), rng.randrange(5), rng.randrange(100),
                           rng.randrange(3), maybe(rng.randrange(4))),
                    "id": str(n),
                }
                for n in range(400)
            ],
            order_drivers=driven(*pairs),
        )

    return make


@pytest.mark.parametrize("mart", ["mart_orders", "mart_items"])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_marts_equal_their_literal_sql(spark, random_core, rows_of, mart, seed):
    core = random_core(seed)
    register_core(core, "bench_")
    found = getattr(marts, mart)(core)
    assert found.count() > 20
    literal = spark.sql(LITERAL[mart]).select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in found.schema]
    )
    assert rows_of(found) == rows_of(literal)


def test_driver_weights_agree_with_driver_stats(random_core, rows_of):
    drivers = random_core(4)["order_drivers"]
    weights = marts.driver_weights(drivers)
    stats = marts.driver_stats(drivers)
    assert rows_of(weights.select("order_id", "has_driver_change")) == rows_of(
        stats.select("order_id", "has_driver_change")
    )
    assert rows_of(weights.select("order_id", "driver_rows")) == rows_of(
        stats.select("order_id", "active_drivers_per_order")
    )


def test_amounts_beyond_64_bits(spark, make_core):
    core = make_core(orders=[order(1, delivery_cost=1)], order_items=[line(1, 1, 30000, 2 * 10**9)])
    core["order_items"] = core["order_items"].crossJoin(spark.range(1000)).drop("id")
    many = spark.range(200_000).select(F.lit(1).alias("order_id"), F.col("id").alias("driver_id"))
    row = marts.mart_orders({**core, "order_drivers": many}).first()
    turnover = 30000 * 2 * 10**9 * 1000 * 200_000
    assert turnover > 2**63
    assert (row.turnover, row.profit) == (turnover, turnover - 200_000)
    assert (row.driver_changes_cnt, row.active_drivers_cnt) == (200_000, 200_000)
    assert row.avg_check == turnover


def test_day_is_taken_in_utc(make_core):
    row = marts.mart_orders(
        make_core(orders=[order(1, created_at=datetime(2023, 12, 31, 23, 59))])
    ).first()
    assert (row.year_num, row.month_num, row.day_num) == (2023, 12, 31)


@pytest.mark.parametrize("above, below, exact", [
    (90071992547409931, 3, "30023997515803310.33"), (10**20 + 1, 4, "25000000000000000000.25"),
    (-1, 200, "-0.01"), (1, 3, "0.33"), (5, 0, None), (0, 7, "0.00"),
])
def test_ratios_are_exact_decimals(spark, above, below, exact):
    numbers = spark.sql(f"SELECT CAST({above} AS DECIMAL(38, 0)) AS a, CAST({below} AS BIGINT) AS b")
    (found,) = numbers.select(ratio(F.col("a"), F.col("b"))).first()
    assert found == (Decimal(exact) if exact else None)
