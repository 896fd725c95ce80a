import itertools
import random

import pytest
from pyspark.sql import functions as F

from waybill.operators.dedup import drop_null_keys, first_per_key
from waybill.operators.numbering import hot_keys, line_occurrence

SCHEMA = "k bigint, v string, w int, chunk_file string, chunk_row bigint"


def random_rows(seed, size=400, hot=0.35):
    """Keys of which one holds a third of the rows; text order differs from number order."""
    rng = random.Random(seed)
    files = ["chunk_1", "chunk_10", "chunk_2"]
    return [
        (
            7 if rng.random() < hot else rng.randrange(40),
            rng.choice([None, "a", "b", "c"]),
            rng.choice([None, 1, 2]),
            rng.choice(files),
            row,
        )
        for row in range(size)
    ]


@pytest.mark.parametrize("collapse", [False, True])
@pytest.mark.parametrize("seed", [1, 2])
def test_first_per_key_equals_brute_force(spark, rows_of, collapse, seed):
    rows = random_rows(seed)
    expected = {}
    for k, v, w, *_ in sorted(rows, key=lambda r: r[3:]):
        expected.setdefault(k, (k, v, w))
    random.Random(seed).shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    found = first_per_key(df, ["k"], ["v", "w"], collapse=collapse)
    assert sorted(found.collect()) == sorted(expected.values(), key=lambda r: r[0])


@pytest.mark.parametrize("collapse", [False, True])
def test_first_row_wins_even_when_null(spark, collapse):
    df = spark.createDataFrame(
        [(1, "8", 0, "chunk_2", 0), (1, None, 0, "chunk_10", 5)], SCHEMA
    )
    assert [tuple(r) for r in first_per_key(df, ["k"], ["v"], collapse=collapse).collect()] == [
        (1, None)
    ]


def test_drop_null_keys(spark):
    df = spark.createDataFrame([(1, 2), (None, 2), (1, None), (None, None)], "a int, b int")
    assert [tuple(r) for r in drop_null_keys(df, ["a", "b"]).collect()] == [(1, 2)]
    assert drop_null_keys(df, ["a"]).count() == 2


def brute_numbers(rows):
    ordered = sorted(rows, key=lambda r: (r[0], r[3], r[4]))
    return sorted(
        (k, file, row, i)
        for k, group in itertools.groupby(ordered, key=lambda r: r[0])
        for i, (_, _, _, file, row) in enumerate(group)
    )


@pytest.mark.parametrize(
    "limits",
    [
        {},  # no group is hot
        {"hot_rows": 50, "slice_rows": 7},  # only the large group is sliced
        {"hot_rows": 0, "slice_rows": 1},  # every group, one row per slice
        {"hot_rows": 0, "slice_rows": 10_000},  # slices are whole files
    ],
)
@pytest.mark.parametrize("seed", [3, 4])
def test_line_occurrence_equals_brute_force(spark, limits, seed):
    rows = random_rows(seed)
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    found = line_occurrence(df, ["k"], **limits)
    assert found.columns == [*df.columns, "occurrence"]
    numbers = found.select("k", "chunk_file", "chunk_row", "occurrence").collect()
    assert sorted(tuple(r) for r in numbers) == brute_numbers(rows)


def test_hot_keys_are_the_large_groups_alone(spark):
    df = spark.createDataFrame(random_rows(5), SCHEMA)
    assert hot_keys(df, ["k"], 100).count() == 1
    assert hot_keys(df, ["k"], 1000).count() == 0


def test_ties_make_the_numbers_reproducible(spark):
    rows = [(1, None, w, "chunk_1", 0) for w in range(20)]
    df = spark.createDataFrame(rows, SCHEMA)
    for parts in (1, 7):
        found = line_occurrence(df.repartition(parts), ["k"], ties=["w"])
        assert all(r["w"] == r["occurrence"] for r in found.collect())


def test_rank_limit_runs_before_the_shuffle(spark, plan_of):
    df = spark.createDataFrame(random_rows(6), SCHEMA)
    plan = plan_of(first_per_key(df, ["k"], ["v"]))
    assert "Partial" in plan[plan.index("Exchange"):]
    assert plan.count("Exchange") == 1


@pytest.mark.parametrize("limits", [{}, {"hot_rows": 50, "slice_rows": 7}, {"hot_rows": 0, "slice_rows": 1}])
def test_numbers_go_on_from_earlier_loads(spark, limits):
    rows = [r for r in random_rows(8) if r[0] is not None]
    keys = sorted({r[0] for r in rows})
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    before = spark.createDataFrame([(k, 10 * k + 3) for k in keys if k % 2], "k long, earlier long")
    found = line_occurrence(df, ["k"], before=before, **limits)
    assert found.columns == [*df.columns, "occurrence"]
    numbers = found.select("k", "chunk_file", "chunk_row", "occurrence").collect()
    assert sorted(tuple(r) for r in numbers) == [
        (k, f, r, i + (10 * k + 3 if k % 2 else 0)) for k, f, r, i in brute_numbers(rows)]


def test_lines_that_go_on_are_shuffled_once(spark):
    df = spark.createDataFrame(random_rows(9), SCHEMA).filter("k IS NOT NULL")
    before = spark.range(9).select(F.col("id").alias("k"), F.lit(2).alias("earlier"))
    conf = "spark.sql.autoBroadcastJoinThreshold"
    usual = spark.conf.get(conf)
    spark.conf.set(conf, "-1")
    try:
        found = line_occurrence(df, ["k"], before=before)
        assert found.count() == df.count()
        found.collect()
        final = found._jdf.queryExecution().executedPlan().toString().split("== Initial")[0]
    finally:
        spark.conf.set(conf, usual)
    # Of the lines and of what was counted before; no slices where no group is hot.
    assert "_block" not in final and final.count("Exchange hashpartitioning(k") == 2
