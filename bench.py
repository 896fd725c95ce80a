"""Time the registered queries and the two batch jobs; print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [query ...]

Each result is computed in full and thrown away (``noop`` sink). Queries read the
chunk files, core tables or marts written beforehand. Writing core tables and marts
is ``core_load`` and ``build_marts`` and counts into ``value``, as do the ``*_loads`` of the same rows
file by file with two refreshes of the marts; deriving the chunk files, the input of all
jobs, from the given tables is ``chunk_preparation`` and does not.
``literal_mart_*`` run the marts as written down in SQL (rows multiplied per
driver, one distinct count per metric) on the same tables, as a yardstick; they
do not count into ``value``.
"""

from __future__ import annotations

import json
import os
import sys
import time

from checks import fixture
from checks.literal import LITERAL
from checks.queries import QUERIES
from waybill.session import local_session
from waybill.sources.core_tables import register_core


def seconds(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def main(names: list[str]) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")))

    def drain(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    # Start the JVM's compilers and read the footers before the clock runs.
    drain(fixture.derived_chunk(spark, sf_dir))
    preparation = seconds(lambda: fixture.written_chunks(spark, sf_dir))
    timings = {
        "core_load": seconds(lambda: fixture.written_core(spark, sf_dir)),
        "build_marts": seconds(lambda: fixture.written_marts(spark, sf_dir)),
    }
    if not names:
        fixture.written_spread(spark, sf_dir), fixture.written_fractions(spark, sf_dir)
        timings |= {
            "four_loads": seconds(lambda: fixture.lake(spark, sf_dir)),
            "four_loads_out_of_order": seconds(
                lambda: fixture.lake(spark, sf_dir, fixture.OUT_OF_ORDER)
            ),
            "strict_load": seconds(lambda: fixture.strict_lake(spark, sf_dir)),
        }
    for name in names or QUERIES:
        timings[name] = seconds(lambda: drain(QUERIES[name](spark, sf_dir)))

    register_core(fixture.core(spark, sf_dir), prefix="bench_")
    yardstick = {
        f"literal_{name}": seconds(lambda: drain(spark.sql(sql)))
        for name, sql in LITERAL.items()
        if not names or name in names
    }
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "yardstick": yardstick,
                "chunk_preparation": preparation,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
