import pytest
from pyspark.sql import types as T

from waybill.plans import core, jobs, marts
from waybill.schemas import CORE, MARTS
from waybill.sinks import tables as sinks
from waybill.sources.core_tables import read_core, register_core


@pytest.fixture
def core_frames(make_chunk):
    rows = [
        {"order_id": o, "item_id": o % 3, "driver_id": o % 2, "user_id": o % 4, "store_id": 1,
         "item_quantity": 2, "item_price": 5, "store_address": "S, C"}
        for o in range(12)
    ]
    return core.core_tables(make_chunk(rows))


def test_core_round_trip_and_full_refresh(spark, tmp_path, core_frames, rows_of):
    for _ in range(2):  # the second run replaces, it does not append
        sinks.write_core(core_frames, path=str(tmp_path))
    back = read_core(spark, path=str(tmp_path), tables=CORE)
    for name, frame in back.items():
        assert [f.dataType for f in frame.schema] == [f.dataType for f in CORE[name]]
        assert rows_of(frame) == rows_of(core_frames[name])


def test_mart_inputs_are_read_by_default(spark, tmp_path, core_frames):
    sinks.write_core(core_frames, path=str(tmp_path))
    assert set(read_core(spark, path=str(tmp_path))) == {
        "orders", "stores", "order_items", "order_drivers", "items"
    }


def test_views(spark, core_frames):
    register_core({"stores": core_frames["stores"]}, prefix="v_")
    assert spark.sql("SELECT store_city FROM v_stores").first()[0] == "C"


@pytest.fixture
def database(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS lake")
    yield "lake"
    spark.sql("DROP DATABASE lake CASCADE")


def test_buckets_spare_the_marts_their_shuffles(spark, core_frames, database, plan_of, rows_of):
    sinks.write_core(core_frames, database=database, buckets=3)
    stored = read_core(spark, database=database)
    joined = stored["orders"].join(
        marts.order_items_agg(stored["order_items"]), "order_id", "left"
    ).join(marts.driver_weights(stored["order_drivers"]), "order_id", "left")
    assert "hashpartitioning" not in plan_of(joined)
    assert rows_of(marts.mart_orders(stored)) == rows_of(marts.mart_orders(core_frames))


def test_catalog_without_buckets(spark, core_frames, database, rows_of):
    sinks.write_core(core_frames, database=database)
    stored = read_core(spark, database=database, tables=["users"])
    assert rows_of(stored["users"]) == rows_of(core_frames["users"])


def test_a_place_must_be_given(spark, core_frames):
    for places in ({}, {"path": "a", "database": "b"}):
        with pytest.raises(ValueError):
            sinks.write_core(core_frames, **places)
        with pytest.raises(ValueError):
            read_core(spark, **places)
    with pytest.raises(ValueError):
        sinks.write_core(core_frames, path="a", buckets=2)


def test_mart_refresh_keeps_the_schema(spark, core_frames, database):
    table = f"{database}.mart_orders"
    for _ in range(2):
        sinks.write_mart(marts.mart_orders(core_frames), "mart_orders", table=table)
    stored = spark.table(table)
    assert [(f.name, f.dataType) for f in stored.schema] == [
        (f.name, f.dataType) for f in MARTS["mart_orders"]
    ]
    assert stored.count() == 1
    assert sinks.ensure_mart(spark, "mart_orders", table) == table
    assert spark.table(table).count() == 1  # creating it again changes nothing


def test_mart_overwrite_takes_the_types_of_the_frame(spark, core_frames, database):
    table = f"{database}.mart_items"
    sinks.ensure_mart(spark, "mart_items", table)
    sinks.write_mart(marts.mart_items(core_frames), "mart_items", table=table, keep_schema=False)
    assert spark.table(table).schema["item_turnover"].dataType == T.LongType()


def test_contract_overflow_fails(spark):
    df = spark.createDataFrame([(10**6,)], "item_quantity int")
    contract = T.StructType([CORE["order_items"]["item_quantity"]])
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        sinks.conform(df, contract).collect()


def test_jdbc_writer_options(spark, monkeypatch):
    seen = {}
    writer = type(spark.range(1).write)
    monkeypatch.setattr(writer, "options", lambda self, **o: seen.update(o) or self)
    sinks.jdbc_writer(spark.range(1), {"url": "jdbc:x", "user": "u"}, "orders")
    assert seen == {"batchsize": "5000", "url": "jdbc:x", "user": "u", "dbtable": "orders",
                    "truncate": "true"}
    sinks.jdbc_writer(spark.range(1), {"url": "jdbc:x", "batchsize": "10"}, "m", truncate=False)
    assert seen["batchsize"] == "10" and seen["truncate"] == "false"
    modes = []
    monkeypatch.setattr(writer, "mode", lambda self, mode: modes.append(mode) or self)
    for append in (False, True):
        sinks.jdbc_writer(spark.range(1), {"url": "jdbc:x"}, "m", append=append)
    assert modes == ["overwrite", "append"]


def test_core_is_read_over_jdbc_in_parts(spark, monkeypatch):
    calls = {}
    monkeypatch.setattr(
        type(spark.read), "jdbc", lambda self, url, table, **rest: calls.update({table: (url, rest)})
    )
    split = {"column": "order_id", "lowerBound": 1, "upperBound": 9, "numPartitions": 4}
    read_core(spark, jdbc={"url": "jdbc:x", "user": "u"}, partitioning={"orders": split},
              tables=["orders", "stores"])
    assert calls == {
        "orders": ("jdbc:x", {"properties": {"user": "u"}, **split}),
        "stores": ("jdbc:x", {"properties": {"user": "u"}}),
    }


def test_a_mart_table_with_narrow_types_keeps_them(spark, core_frames, database):
    table = f"{database}.narrow"
    kinds = {T.LongType(): "int", T.DecimalType(38, 2): "decimal(15, 2)"}
    columns = ", ".join(
        f"{f.name} {kinds.get(f.dataType, f.dataType.simpleString())}"
        for f in MARTS["mart_orders"]
    )
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet")
    sinks.write_mart(marts.mart_orders(core_frames), "mart_orders", table=table)
    row = spark.table(table).first()
    assert spark.table(table).schema["turnover"].dataType == T.DecimalType(15, 2)
    assert spark.table(table).schema["buyers_cnt"].dataType == T.IntegerType()
    assert (row.turnover, row.created_orders_cnt) == (120, 12)


def test_jobs_end_to_end(spark, tmp_path, make_chunk, rows_of):
    chunk = make_chunk(
        [{"order_id": o, "item_id": 1, "driver_id": 1, "user_id": 1, "store_id": 1,
          "item_quantity": 1, "item_price": 5} for o in range(4)]
    ).drop("chunk_file", "chunk_row")
    chunk.coalesce(1).write.parquet(str(tmp_path / "in" / "chunk_1.parquet"))
    jobs.load_core(spark, str(tmp_path / "in"), str(tmp_path / "core"))
    jobs.build_marts(spark, str(tmp_path / "core"), str(tmp_path / "marts"))
    mart = spark.read.parquet(str(tmp_path / "marts" / "mart_orders"))
    assert mart.first().turnover == 20 and mart.first().created_orders_cnt == 4
    assert mart.schema["turnover"].dataType == T.DecimalType(38, 2)
    assert spark.read.parquet(str(tmp_path / "marts" / "mart_items")).count() == 1


def test_a_mart_table_with_other_columns_is_an_error(spark):
    spark.sql("CREATE TABLE narrow_mart (year_num INT, city STRING) USING parquet")
    rows = spark.createDataFrame([], MARTS["mart_orders"])
    with pytest.raises(ValueError, match="narrow_mart has the columns"):
        sinks.write_mart(rows, "mart_orders", table="narrow_mart")
