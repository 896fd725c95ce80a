"""The registered queries and the pipeline."""

import __spark_entry__ as entry
import corpus_pipeline
from checks.compare import connect, difference
from waybill.llm.minhash import near_duplicates
from waybill.llm.queries import ORACLE, QUERIES, documents

SF = "/root/testdata/sf0.001"


def test_everything_is_registered():
    assert {*QUERIES, "pipeline"} <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


def test_equals_sql(spark):
    connection = connect(SF)
    for name, sql in ORACLE.items():
        assert difference(QUERIES[name](spark, SF), connection, sql) is None


def test_pipeline(spark):
    docs = documents(spark, SF)
    for name, stage in corpus_pipeline.STAGES:
        out = f"{spark.conf.get('spark.checkpoint.dir')}/pipeline-test-{name}"
        stage(spark, docs, SF).write.parquet(out)
        before, after = docs, spark.read.parquet(out)
        if name != "best_fit_packing":
            assert after.columns == before.columns
            assert set(after.collect()) <= set(before.collect())
        if name == "exact_dedup":
            assert after.count() == before.select("text").distinct().count()
        if name == "near_duplicates":
            groups = near_duplicates(before)
            assert after.count() == groups.select("component_id").distinct().count()
        if name == "best_fit_packing":
            assert after.filter("piece = 0").count() == before.count()
        docs = after
    assert corpus_pipeline.run(spark, SF).count() == docs.count()
