import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waybill.operators.audits import duplicate_keys
from waybill.operators.key_ranges import contested_files, key_ranges, repeated_keys


def rows(df):
    return sorted((str(k), n) for k, n in df.collect())


def by_ranges(df, folder, files=4):
    df.repartitionByRange(files, "k").sortWithinPartitions("k").write.mode("append").parquet(folder)


@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_repeated_keys_equal_the_plain_audit(spark, tmp_path, kind):
    folder = str(tmp_path / "t")
    key = F.col("id").cast(kind).alias("k")
    ids = spark.range(1000).unionByName(spark.range(500, 502)).unionByName(spark.range(500, 501))
    by_ranges(ids.select(key), folder)  # equal keys meet in one file
    (spark.range(3).select(F.lit(None).cast(kind).alias("k"))).coalesce(1).write.mode("append").parquet(folder)
    by_ranges(spark.range(990, 1010).select(key), folder, 1)  # and across files
    found = repeated_keys(spark, folder, "k", T._parse_datatype_string(kind))
    expected = duplicate_keys(spark.read.parquet(folder), "k").select("k", "copies")
    assert rows(found) == rows(expected) and len(rows(found)) == 13


def test_tables_written_by_ranges_shuffle_no_key(spark, tmp_path, plan_of):
    folder = str(tmp_path / "t")
    by_ranges(spark.range(1000).withColumnRenamed("id", "k"), folder)
    files = contested_files(key_ranges(spark, folder, "k", T.LongType())).collect()
    assert len(files) == 4 and not any(f.contested for f in files)
    found = repeated_keys(spark, folder, "k", T.LongType())
    plan = plan_of(found)
    # What is shuffled comes out of the tasks' own search: repeated keys alone.
    assert plan.index("Exchange") < plan.index("MapInArrow") and plan.count("FileScan") == 1
    assert found.collect() == []


def test_only_files_that_meet_are_contested(spark, tmp_path):
    folder = str(tmp_path / "t")
    by_ranges(spark.range(1000).withColumnRenamed("id", "k"), folder)
    by_ranges(spark.range(10, 20).withColumnRenamed("id", "k"), folder, 1)
    files = contested_files(key_ranges(spark, folder, "k", T.LongType())).collect()
    assert sum(f.contested for f in files) == 2 and len(files) == 5
    assert rows(repeated_keys(spark, folder, "k", T.LongType())) == [(str(k), 2) for k in range(10, 20)]


def test_an_empty_table(spark, tmp_path):
    spark.range(0).withColumnRenamed("id", "k").write.parquet(str(tmp_path / "t"))
    assert repeated_keys(spark, str(tmp_path / "t"), "k", T.LongType()).collect() == []
