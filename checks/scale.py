"""Both batch jobs on many shifted copies of the chunk, with or without hot keys.

    python -m checks.scale [copies] [skew] [sf_dir]

With ``skew`` a third of all rows belong to one order, a third of the orders to
one store, city and day, and a third of the lines to one item. The marts are
compared, row for row, with their literal SQL on the same core tables. The same rows are then
loaded as four files, one at a time, and the tables and marts compared with those of one load.
"""

from __future__ import annotations

import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixture
from checks.literal import LITERAL
from waybill.plans import jobs, marts
from waybill.plans.incremental import append_chunks, core_of, marts_of, refresh_marts
from waybill.schemas import CHUNK, CORE, ROW_ORDER
from waybill.sinks.versions import Versions
from waybill.sources.core_tables import read_core, register_core

_SHIFT = 10_000_000


def copies(chunk: DataFrame, count: int, skew: bool) -> DataFrame:
    """``count`` copies with their own orders, users and drivers."""
    keys = ("order_id", "user_id", "driver_id")
    many = chunk.withColumn("copy", F.explode(F.expr(f"sequence(0L, {count - 1}L)")))
    for key in keys:
        many = many.withColumn(key, F.col(key) + F.col("copy") * _SHIFT)
    many = many.withColumn("chunk_row", F.col("chunk_row") + F.col("copy") * _SHIFT * 100)
    if skew:
        hot_row = F.pmod(F.xxhash64("chunk_row"), F.lit(3)) == 0
        hot_order = F.pmod(F.xxhash64("order_id"), F.lit(3)) == 0
        hot_line = F.pmod(F.xxhash64("chunk_row", "item_id"), F.lit(3)) == 0
        many = (
            many.withColumn("store_id", F.when(hot_order, 1).otherwise(F.col("store_id")))
            .withColumn("created_at", F.when(hot_order, F.lit("1997-01-01").cast("timestamp"))
                        .otherwise(F.col("created_at")))
            .withColumn("address_text", F.when(hot_order, F.lit("X, y"))
                        .otherwise(F.col("address_text")))
            .withColumn("order_id", F.when(hot_row, F.lit(1)).otherwise(F.col("order_id")))
            .withColumn("item_id", F.when(hot_line, F.lit(1)).otherwise(F.col("item_id")))
        )
    return many.select(*CHUNK.names, *ROW_ORDER)


def main(spark: SparkSession, count: int, skew: bool, sf_dir: str) -> None:
    folder = fixture.shared_folder(spark)

    def timed(what: str, action) -> None:
        start = time.perf_counter()
        action()
        print(f"{what:24s}{time.perf_counter() - start:8.1f} s", flush=True)

    source = copies(fixture.chunk(spark, sf_dir), count, skew).repartition(16)
    timed("write chunks", lambda: source.write.parquet(f"{folder}/in/chunk_0.parquet"))
    reading = {"row_order": ROW_ORDER}
    timed("load core", lambda: jobs.load_core(spark, f"{folder}/in", f"{folder}/core", **reading))
    timed("build marts", lambda: jobs.build_marts(spark, f"{folder}/core", f"{folder}/marts"))

    core = read_core(spark, path=f"{folder}/core", tables=CORE)
    print({t: df.count() for t, df in core.items()})
    register_core(core, "bench_")
    source.write.partitionBy(ROW_ORDER[0]).parquet(f"{folder}/spread")
    lake = f"{folder}/lake"
    for number in fixture.LOADS:
        timed(f"load file {number}", lambda: append_chunks(
            spark, f"{folder}/spread", lake, pattern=f"{ROW_ORDER[0]}=chunk_{number}", **reading
        ))
        if number >= fixture.LOADS[-2]:
            timed("refresh marts", lambda: refresh_marts(spark, lake, period="year"))
    now = Versions(spark, lake).current()
    for table, df in core_of(now).items():
        print(f"loaded {table}: {df.exceptAll(core[table]).count()} of {df.count()} rows differ")
    for name, df in marts_of(now).items():
        whole = spark.read.schema(df.schema).parquet(f"{folder}/marts/{name}")
        print(f"loaded {name}: {df.exceptAll(whole).count()} of {df.count()} rows differ")
    for name, sql in LITERAL.items():
        ours = getattr(marts, name)(core)
        literal = spark.sql(sql).select(ours.columns)
        for what, df in ((name, ours), (f"literal {name}", literal)):
            timed(what, lambda: df.write.format("noop").mode("overwrite").save())
        print(f"{name}: {ours.exceptAll(literal).count()} rows differ")


if __name__ == "__main__":
    from waybill.session import local_session

    arguments = sys.argv[1:]
    hot = "skew" in arguments
    rest = [a for a in arguments if a != "skew"]
    main(
        local_session(driver_memory="20g"),
        int(rest[0]) if rest else 10,
        hot,
        rest[1] if len(rest) > 1 else "/root/testdata/sf0.1",
    )
