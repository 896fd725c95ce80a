"""What the operators don't shuffle: rows that meet no key, buckets that tell nothing new."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from waybill.llm import frames, minhash


@pytest.fixture
def unlimited(spark):
    """No table is small enough to be broadcast by its size."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def shuffled_rows(df):
    """Rows that the shuffles of a collected ``df`` wrote."""
    def walk(plan):
        kind = plan.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return walk(plan.executedPlan())
        if kind.endswith("QueryStageExec"):
            return walk(plan.plan())
        own = 0
        if kind == "ShuffleExchangeExec":
            own = plan.metrics().apply("shuffleRecordsWritten").value()
        below = plan.children()
        return own + sum(walk(below.apply(i)) for i in range(below.size()))

    return walk(df._jdf.queryExecution().executedPlan())


@pytest.mark.parametrize("most", [1 << 27, 1 << 15, 1])
def test_documents_that_are_not_listed_stay_where_they_are(spark, unlimited, monkeypatch, most):
    monkeypatch.setattr(frames, "SIEVE_MOST", most)
    rows = [(k if k % 7 else None, f"text {k}") for k in range(5000)] + [(1, "text 1"), (1, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {c: F.lit(1) for c in ("_key", "_maybe", "_own", "_bits", "at")})
    keys = docs.select("doc_id", frames.row_key().alias("row_key"), "text")
    listed = keys.filter("text in ('text 1', 'text 7') or text like 'text 49__'")
    gone = [r for r in rows if r[1] in ("text 1", "text 7") or r[1] and r[1][:-2] == "text 49"]
    kept, found = frames.without(docs, listed), frames.without(docs, listed, "left_semi")
    assert kept.columns == found.columns == docs.columns and len(gone) == 103
    plain = lambda df: sorted(((r.doc_id, r.text) for r in df.collect()), key=str)
    assert plain(found) == sorted(gone, key=str)
    assert plain(kept) == sorted((r for r in rows if r not in gone), key=str)
    assert shuffled_rows(kept) < 1000 and shuffled_rows(found) < 1000


def test_no_key_at_all(spark, unlimited):
    docs = spark.createDataFrame([(1, "a"), (None, None)], "doc_id long, text string")
    none = docs.select("doc_id", frames.row_key().alias("row_key")).filter("false")
    assert frames.without(docs, none).count() == 2
    assert frames.without(docs, none, "left_semi").count() == 0


def test_every_key_is_let_through(spark):
    keys = frames.written(spark.range(-3000, 3000).withColumnRenamed("id", "k"), "keys")
    rows = spark.range(-9000, 9000)
    met = {r.id for r in frames.marked(rows, F.col("id"), keys, "met").filter("met").collect()}
    assert met >= set(range(-3000, 3000)) and len(met) < 6000 + 12000 // 10
    assert frames.among(rows, "id", keys).count() == 6000


def test_buckets_that_tell_nothing_new_are_not_compared(spark, monkeypatch):
    def seen(percent, spanning):
        return lambda frame: pd.DataFrame({"a": [frame["bucket"][0]], "b": [len(frame)]})

    monkeypatch.setattr(minhash, "_links_in_tile", seen)
    rows = [(bucket, k, 3, k) for bucket in (7, 8, 9) for k in (1, 2, 3)]
    rows += [(10, 1, 3, 1), (10, 2, 3, 2), (11, 4, 3, 4), (12, 5, 3, 5), (12, 6, 3, 5)]
    members = spark.createDataFrame(rows, "bucket long, id long, n long, component long")
    texts = spark.createDataFrame([(k, "a b c d e f g") for k in range(1, 7)], "id long, text string")
    found = minhash.pairs_in_tiles(members, texts, 75).collect()
    assert sorted(map(tuple, found)) == [(7, 3), (10, 2)]
