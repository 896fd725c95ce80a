"""The plans keep the shape that carries them to large data."""

import contextlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from checks import fixture
from checks.queries import QUERIES
from waybill.plans import marts
from waybill.session import PARTITION_BYTES, fit, partitions
from waybill.sinks.versions import Versions

SF = "/root/testdata/sf0.001"


@contextlib.contextmanager
def settings(spark, **values):
    before = {k: spark.conf.get(k) for k in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.fixture(scope="module")
def core(spark):
    return fixture.core(spark, SF)


@pytest.mark.parametrize("name", QUERIES)
def test_no_cross_joins_no_python_no_collected_groups(spark, plan_of, name):
    plan = plan_of(QUERIES[name](spark, SF))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas",
                     "collect_list", "collect_set", "SinglePartition, REPARTITION"):
        assert operator not in plan


@pytest.mark.parametrize("mart", [marts.mart_orders, marts.mart_items])
def test_marts_expand_no_rows_and_hash_all_groups(core, plan_of, mart):
    plan = plan_of(mart(core))
    assert "Expand" not in plan and "SortAggregate" not in plan


def test_marts_read_only_what_they_need(core, plan_of):
    plan = plan_of(marts.mart_orders(core))
    for unused in ("payment_type", "order_discount", "paid_at", "address_text", "item_replaced_id"):
        assert unused not in plan


def test_marts_join_orders_by_one_shuffle_each(spark, core, plan_of):
    with settings(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        amounts = marts.order_items_agg(core["order_items"])
        joined = core["orders"].join(amounts, "order_id", "left").join(
            marts.driver_weights(core["order_drivers"]), "order_id", "left"
        )
        assert plan_of(joined).count("Exchange hashpartitioning(order_id") == 3


def test_small_dimensions_are_broadcast_by_their_size(spark, core, plan_of):
    joined = marts.at_store_day(core["orders"], core["stores"])
    assert "BroadcastHashJoin" in plan_of(joined)
    with settings(spark, **{"spark.sql.autoBroadcastJoinThreshold": "100"}):
        assert "BroadcastHashJoin" not in plan_of(joined.select("*"))


def test_key_filters_reach_the_scan(spark, plan_of):
    plan = plan_of(QUERIES["core_order_drivers"](spark, SF))
    assert "PushedFilters: [IsNotNull(order_id), IsNotNull(driver_id)]" in plan


def test_a_hot_store_is_split(spark):
    """With a store too large to broadcast, its join partition is read in pieces."""
    orders = spark.range(0, 60_000, numPartitions=8).select(
        F.col("id").alias("order_id"),
        F.when(F.col("id") % 3 > 0, F.col("id") % 40).otherwise(F.lit(-1)).alias("store_id"),
        F.lit(None).cast("string").alias("delivery_city"),
        F.timestamp_seconds(F.col("id")).alias("created_at"),
    )
    stores = spark.range(-1, 40).select(
        F.col("id").alias("store_id"), F.concat(F.lit("c"), F.col("id") % 3).alias("store_city")
    )
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    with settings(spark, **conf):
        days = marts.at_store_day(orders, stores).groupBy(*marts.STORE_DAY).count()
        total = sum(r["count"] for r in days.collect())
        final = days._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert total == 60_000
    assert "SortMergeJoin(skew=true)" in final


def test_shuffles_begin_with_partitions_by_the_size_of_the_input(spark, tmp_path):
    own = spark.newSession()
    own.conf.set("spark.sql.shuffle.partitions", "4")
    fit(own, 40 * PARTITION_BYTES)
    assert partitions(own) == 40
    fit(own, PARTITION_BYTES)
    assert partitions(own) == 40
    own.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1b")
    own.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1b")
    groups = own.range(100_000).groupBy((F.col("id") % 5000).alias("g")).count()
    assert groups.rdd.getNumPartitions() == 40


def test_chunk_rows_are_not_shuffled_once_they_are_whole(spark, plan_of):
    own = spark.newSession()
    own.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = plan_of(fixture.derived_chunk(own, SF))
    joins = [line for line in plan.splitlines() if "SortMergeJoin" in line]
    assert "l_orderkey" in joins[0]


def test_lines_go_to_their_item_once(spark, core, plan_of):
    """After the rows of orders and items have met their item, nothing moves them again."""
    with settings(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        plan = plan_of(marts.mart_items(core))
    known = plan[plan.index("Union"):plan.rindex("LeftAnti")]
    moved = [line for line in known.splitlines() if "Exchange hashpartitioning(item_id" in line]
    assert moved and all("day" not in line and "city" not in line for line in moved)


def test_the_load_alone_goes_to_the_buckets(spark, tmp_path):
    """Rows that come from a shuffle by the key are not shuffled again to be stored by it."""
    store = Versions(spark, str(tmp_path))
    change = store.change()
    first = spark.range(100).groupBy("id").agg(F.count("*").alias("n"))
    seen = []
    repartition = DataFrame.repartition
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(type(first), "repartition", lambda *a: seen.append(a) or repartition(*a))
        change.add("t", first, "id", partitions(spark), placed=True)
        assert not seen
        change.add("t", first, "id", partitions(spark) + 1, placed=True)
        assert len(seen) == 1
    parts = change.parts["t"]
    assert spark.read.parquet(f"{tmp_path}/data/t/{parts[0].folder}").count() == 100
    change.parts["t"] = parts[:1]
    plan = change.bucketed("t").groupBy("id").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and change.bucketed("t").count() == 100


def test_a_task_sends_one_row_per_key_of_first_rows(spark, plan_of):
    for name in ("core_users", "core_drivers", "core_items"):
        plan = plan_of(QUERIES[name](spark, SF))
        assert "Partial" in plan and plan.count("Exchange hashpartitioning") == 1


def test_hot_keys_without_a_bound_are_not_broadcast(spark, plan_of):
    plan = plan_of(QUERIES["line_occurrence_sliced"](spark, SF))
    broadcast = [line for line in plan.splitlines() if "BroadcastHashJoin" in line]
    assert broadcast and all("BroadcastHashJoin [_bucket" in line for line in broadcast)


def test_mart_orders_shuffles_drivers_once(spark, core):
    with settings(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        mart = marts.mart_orders(core)
        mart.collect()
        final = mart._jdf.queryExecution().executedPlan().toString().split("== Initial")[0]
    own = [line for line in final.splitlines() if "REPARTITION_BY_COL" in line]
    assert sorted("ReusedExchange" in line for line in own) == [False, True]


def test_tasks_fold_rows_of_small_pieces_of_files(spark):
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "16m"
