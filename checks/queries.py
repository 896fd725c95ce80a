"""One query per operator and job, over the whole given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import fixture
from waybill.functions.columns import (
    comma_part,
    date_parts,
    is_service_error,
    line_revenue,
    line_turnover,
    order_city,
    phone_col,
    ratio,
)
from waybill.operators import audits, dedup
from waybill.operators.dedup import first_per_key
from waybill.operators.key_ranges import repeated_keys
from waybill.operators.member_states import members_in
from waybill.operators.numbering import line_occurrence
from waybill.plans import core as jobs
from waybill.plans import marts
from waybill.plans.incremental import ORPHANS, REJECTED, buyers_of, core_of, marts_of
from waybill.schemas import CHUNK, CORE, MARTS, ROW_ORDER
from waybill.sinks.tables import conform, ensure_mart, write_mart
from waybill.sinks.versions import Versions, refresh
from waybill.sources.core_tables import register_core

Query = Callable[[SparkSession, str], DataFrame]

_MOMENTS = ("created_at", "paid_at", "delivery_started_at", "delivered_at", "canceled_at")


def _plain_times(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as the given tables have them."""
    return df.select(
        *[F.col(c).cast("timestamp_ntz").alias(c) if c in _MOMENTS else c for c in df.columns]
    )


def _on_chunk(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(fixture.chunk(spark, sf_dir))


def _on_core(build: Callable[[dict[str, DataFrame]], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(fixture.core(spark, sf_dir))


# --- scans, projections, scalars ---

def chunk_scan(chunk: DataFrame) -> DataFrame:
    return _plain_times(chunk.select(CHUNK.names))


def drop_null_keys(chunk: DataFrame) -> DataFrame:
    keys = ["order_id", "item_replaced_id"]
    return dedup.drop_null_keys(chunk, keys).select(*keys, "item_id")


def fill_measures(chunk: DataFrame) -> DataFrame:
    measures = list(jobs.MEASURES)
    return chunk.select("order_id", "item_id", *measures).na.fill(0, subset=measures)


def surrogate_key(chunk: DataFrame) -> DataFrame:
    return jobs.order_items(chunk).select("id", "order_id", "item_id")


def line_numbers(chunk: DataFrame, **limits: int) -> DataFrame:
    lines = chunk.select("order_id", "item_id", *jobs.MEASURES, *ROW_ORDER)
    numbered = line_occurrence(lines, ["order_id", "item_id"], ties=jobs.MEASURES, **limits)
    return numbered.select("order_id", "item_id", "chunk_row", F.col("occurrence").cast("long"))


def clean_phones(chunk: DataFrame) -> DataFrame:
    def phones(party: str) -> DataFrame:
        first = first_per_key(chunk, [f"{party}_id"], [f"{party}_phone"], collapse=True)
        raw = F.col(f"{party}_phone")
        return first.select(
            F.lit(party).alias("party"),
            F.col(f"{party}_id").alias("party_id"),
            raw.alias("raw_phone"),
            phone_col(raw).alias("phone"),
        )

    return phones("user").unionByName(phones("driver"))


def store_address_parts(chunk: DataFrame) -> DataFrame:
    address = F.col("store_address")
    return chunk.select("store_address").distinct().select(
        address, comma_part(address, 1).alias("store_name"),
        comma_part(address, 2).alias("store_city"),
    )


def delivery_city(chunk: DataFrame) -> DataFrame:
    text = F.col("address_text")
    return chunk.select("order_id", text, comma_part(text, 1).alias("delivery_city")).distinct()


def service_error_orders(core: dict[str, DataFrame]) -> DataFrame:
    reason = F.col("order_cancellation_reason")
    return core["orders"].filter(is_service_error(reason)).select("order_id", "user_id", reason)


def city_of_orders(core: dict[str, DataFrame]) -> DataFrame:
    joined = core["orders"].join(core["stores"], "store_id", "left")
    city = order_city(F.col("delivery_city"), F.col("store_city"))
    return joined.select("order_id", city.alias("city"))


def line_amounts(core: dict[str, DataFrame]) -> DataFrame:
    return core["order_items"].select(
        "id", line_turnover().alias("turnover"), line_revenue().alias("revenue")
    )


def order_date_parts(core: dict[str, DataFrame]) -> DataFrame:
    return core["orders"].select("order_id", *date_parts(F.col("created_at")))


# --- dedup ---

def distinct_order_drivers(chunk: DataFrame) -> DataFrame:
    return chunk.select("order_id", "driver_id").distinct()


def first_driver_row(chunk: DataFrame) -> DataFrame:
    return first_per_key(chunk, ["driver_id"], ["driver_phone", "order_id"])


# --- joins ---

def join_items_orders(core: dict[str, DataFrame]) -> DataFrame:
    joined = core["order_items"].join(core["orders"], "order_id")
    return joined.select("id", "order_id", "item_id", "user_id", "store_id")


def join_orders_stores(core: dict[str, DataFrame]) -> DataFrame:
    joined = core["orders"].join(core["stores"], "store_id", "left")
    return joined.select("order_id", "store_id", "store_name", "store_city")


def join_order_aggs(core: dict[str, DataFrame]) -> DataFrame:
    amounts = marts.order_items_agg(core["order_items"])
    weights = marts.driver_weights(core["order_drivers"])
    return (
        core["orders"].select("order_id")
        .join(amounts, "order_id", "left").join(weights, "order_id", "left")
        .select("order_id", "turnover_order", "revenue_order", "has_driver_change")
    )


def driver_fanout(core: dict[str, DataFrame]) -> DataFrame:
    drivers = core["order_drivers"].select("order_id", "driver_id")
    return core["orders"].select("order_id", "delivery_cost").join(drivers, "order_id", "left")


# --- aggregations ---

def order_status_counts(core: dict[str, DataFrame]) -> DataFrame:
    flags = marts.order_flags()
    return core["orders"].groupBy("store_id", *date_parts(F.col("created_at"))).agg(
        *[F.count_if(flag).alias(name) for name, flag in flags.items()],
        F.count_distinct("user_id").alias("buyers_cnt"),
    )


def store_day_ratios(core: dict[str, DataFrame]) -> DataFrame:
    amounts = marts.order_items_agg(core["order_items"])
    days = (
        core["orders"].join(amounts, "order_id", "left")
        .groupBy("store_id", *date_parts(F.col("created_at")))
        .agg(
            F.coalesce(F.sum("revenue_order"), F.lit(0)).alias("revenue"),
            F.count("*").alias("orders_cnt"),
            F.count_distinct("user_id").alias("buyers_cnt"),
        )
    )

    def share(above: str, below: str) -> Column:
        return ratio(F.col(above), F.col(below)).cast("double")

    return days.select(
        "store_id", "year_num", "month_num", "day_num",
        share("revenue", "orders_cnt").alias("avg_check"),
        share("orders_cnt", "buyers_cnt").alias("orders_per_buyer"),
        share("revenue", "buyers_cnt").alias("revenue_per_buyer"),
    )


def mart_orders(core: dict[str, DataFrame]) -> DataFrame:
    """Amounts as doubles, since DuckDB and Spark show wide decimals differently."""
    return _double_amounts(marts.mart_orders(core))


def _double_amounts(mart: DataFrame) -> DataFrame:
    wide = [f.name for f in mart.schema if isinstance(f.dataType, T.DecimalType)]
    return mart.withColumns({name: F.col(name).cast("double") for name in wide})


# --- sinks and views ---

def mart_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mart table with its columns in another order, refreshed twice and read back."""
    table = f"refreshed_{uuid.uuid4().hex}"
    mart = marts.mart_orders(fixture.core(spark, sf_dir))
    columns = ", ".join(
        f"{f.name} {f.dataType.simpleString()}" for f in sorted(MARTS["mart_orders"], key=lambda f: f.name)
    )
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet")
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in MARTS["mart_orders"]]
    for rows in (spark.range(10).select(*nothing), mart):
        write_mart(rows, "mart_orders", table=table)
    return _double_amounts(spark.table(table).select(MARTS["mart_orders"].names))


def mart_recreate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mart table made anew with the types of its rows, over one of other types."""
    table = ensure_mart(spark, "mart_orders", f"recreated_{uuid.uuid4().hex}")
    write_mart(mart_orders(fixture.core(spark, sf_dir)), "mart_orders", table=table, keep_schema=False)
    return spark.table(table)


def core_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_core(fixture.core(spark, sf_dir), prefix="core_view_")
    return spark.sql("""
SELECT s.store_id, s.store_city, count(DISTINCT o.order_id) AS orders_cnt, count(*) AS lines_cnt
FROM core_view_orders o JOIN core_view_order_items l ON l.order_id = o.order_id
LEFT JOIN core_view_stores s ON s.store_id = o.store_id GROUP BY s.store_id, s.store_city""")


def mart_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mart refreshed in versions: the second refresh dies half-way, the third replaces the first."""
    store = Versions(spark, fixture.shared_folder(spark))
    mart = conform(marts.mart_orders(fixture.core(spark, sf_dir)), MARTS["mart_orders"])
    first = refresh(store, {"mart_orders": spark.createDataFrame([], mart.schema)})
    broken = mart.withColumn("city", F.raise_error(F.lit("out of order")).cast("string"))
    try:
        refresh(store, {"mart_orders": broken})
    except Exception as error:
        if "out of order" not in str(error):
            raise
    if store.current().number != first.number:
        raise AssertionError("a refresh that died changed the version in force")
    return _double_amounts(refresh(store, {"mart_orders": mart}).read("mart_orders"))


# --- loads ---

def _loaded(table: str, order: tuple[int, ...] = fixture.LOADS) -> Query:
    """A core table after loading its files one at a time."""
    return lambda spark, sf_dir: _plain_times(core_of(fixture.lake(spark, sf_dir, order))[table])


def _loaded_mart(mart: str, order: tuple[int, ...] = fixture.LOADS) -> Query:
    """A mart of which only the days of the last load were rebuilt."""
    return lambda spark, sf_dir: _double_amounts(marts_of(fixture.lake(spark, sf_dir, order))[mart])


def buyer_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Buyers by city and month, and by city, from states of store-days."""
    states = buyers_of(fixture.lake(spark, sf_dir))
    month = F.date_trunc("month", "day").cast("date").alias("month")
    monthly = members_in(states, ["city", month], "buyers_cnt")
    return monthly.unionByName(
        members_in(states, ["city"], "buyers_cnt"), allowMissingColumns=True
    )


def rejected_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixture.strict_lake(spark, sf_dir).read(REJECTED)
    return rows.withColumn("value", F.col("value").cast("double"))


def orphan_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture.strict_lake(spark, sf_dir).read(ORPHANS, CORE["order_items"])


def lines_in_force(spark: SparkSession, sf_dir: str) -> DataFrame:
    return core_of(fixture.strict_lake(spark, sf_dir))["order_items"]


# --- audits ---

def audit_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits.audit_nulls(fixture.stored_marts(spark, sf_dir))


def audit_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """On tables as loaded, before their columns are narrowed, and on the stored marts. Limits
    concern values, so lines are not numbered for them."""
    chunk = fixture.chunk(spark, sf_dir)
    loaded = {t: jobs.first_rows(chunk, t) for t in jobs.FIRST_ROWS}
    lines = {"order_items": jobs.plain_lines(chunk)}
    return audits.audit_ranges({**loaded, **lines, **fixture.stored_marts(spark, sf_dir)})


def audit_keys_by_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated keys of a table written by ranges; only files whose ranges meet are compared."""
    return repeated_keys(spark, fixture.written_keys(spark, sf_dir), "order_id", T.LongType())


QUERIES: dict[str, Query] = {
    "chunk_scan": _on_chunk(chunk_scan),
    "drop_null_keys": _on_chunk(drop_null_keys),
    "fill_measures": _on_chunk(fill_measures),
    "surrogate_key": _on_chunk(surrogate_key),
    "line_occurrence": _on_chunk(line_numbers),
    # Every group is cut into slices, also those that one window could number.
    "line_occurrence_sliced": _on_chunk(lambda chunk: line_numbers(chunk, hot_rows=0, slice_rows=1000)),
    "clean_phones": _on_chunk(clean_phones),
    "store_address_parts": _on_chunk(store_address_parts),
    "delivery_city": _on_chunk(delivery_city),
    "distinct_order_drivers": _on_chunk(distinct_order_drivers),
    "first_per_key": _on_chunk(first_driver_row),
    "core_users": _on_chunk(jobs.users),
    "core_drivers": _on_chunk(jobs.drivers),
    "core_stores": _on_chunk(jobs.stores),
    "core_items": _on_chunk(jobs.items),
    "core_orders": _on_chunk(lambda chunk: _plain_times(jobs.orders(chunk))),
    "core_order_items": _on_chunk(jobs.order_items),
    "core_order_drivers": _on_chunk(jobs.order_drivers),
    "service_error_orders": _on_core(service_error_orders),
    "order_city": _on_core(city_of_orders),
    "line_amounts": _on_core(line_amounts),
    "order_date_parts": _on_core(order_date_parts),
    "join_items_orders": _on_core(join_items_orders),
    "join_orders_stores": _on_core(join_orders_stores),
    "join_order_aggs": _on_core(join_order_aggs),
    "driver_fanout": _on_core(driver_fanout),
    "order_items_agg": _on_core(lambda core: marts.order_items_agg(core["order_items"])),
    "driver_stats": _on_core(lambda core: marts.driver_stats(core["order_drivers"])),
    "order_status_counts": _on_core(order_status_counts),
    "store_day_ratios": _on_core(store_day_ratios),
    "mart_orders": _on_core(mart_orders),
    "mart_items": _on_core(marts.mart_items),
    "audit_keys": _on_core(audits.audit_keys),
    "audit_references": _on_core(audits.audit_references),
    "mart_refresh": mart_refresh,
    "mart_versions": mart_versions,
    "loaded_users": _loaded("users", fixture.OUT_OF_ORDER),
    "loaded_stores": _loaded("stores", fixture.OUT_OF_ORDER),
    "loaded_orders": _loaded("orders", fixture.OUT_OF_ORDER),
    "loaded_order_items": _loaded("order_items"),
    "loaded_order_drivers": _loaded("order_drivers"),
    "loaded_mart_orders": _loaded_mart("mart_orders"),
    "loaded_mart_items": _loaded_mart("mart_items", fixture.OUT_OF_ORDER),
    "buyer_rollups": buyer_rollups,
    "rejected_values": rejected_values,
    "orphan_lines": orphan_lines,
    "lines_in_force": lines_in_force,
    "mart_recreate": mart_recreate,
    "core_views": core_views,
    "audit_keys_by_range": audit_keys_by_range,
    "audit_nulls": audit_nulls,
    "audit_ranges": audit_ranges,
}
