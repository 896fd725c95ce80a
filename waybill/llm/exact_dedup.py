"""Exact dedup against a persistent index of digests, with built-in functions only."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.llm.frames import row_key, text_of, without, written


class DigestIndex:
    """Digests of all texts seen so far, in runs: tables bucketed and sorted by digest, with one
    file a bucket, so that a merge join reads them in place, unsorted and unshuffled.

    Every batch is appended as one run under its name. A view of the index's name joins the runs
    and lists them; replacing it is the commit, so a job that dies leaves the index as it
    was. When there are more than ``max_runs``, they are made one. The bucket count is fixed when
    the index is made; choose it so that a bucket of the final index fits a task.
    """

    def __init__(
        self, spark: SparkSession, table: str, buckets: int | None = None, max_runs: int = 4
    ):
        self.spark, self.table, self.max_runs = spark, table, max_runs
        # Without this Spark sorts bucketed tables again, also those of one file a bucket.
        spark.conf.set("spark.sql.legacy.bucketedTableScan.outputOrdering", "true")
        if spark.catalog.tableExists(table):
            self.buckets = int(self._property("buckets"))
        else:
            self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
            empty = spark.createDataFrame([], "digest binary, keep_id bigint, batch string")
            self._commit([self._run(empty)])

    def runs(self) -> list[str]:
        return self._property("runs").split(",")

    def lookup(self, digests: DataFrame, batch: str) -> DataFrame:
        """``digests`` (one row each) with ``old_id``, the row kept by another batch, or null."""
        found = digests.withColumn("old_id", F.lit(None).cast("bigint"))
        for run in self.runs():
            old = self._others(run, batch).withColumnRenamed("old_id", "_old")
            found = found.join(old, "digest", "left").withColumn(
                "old_id", F.coalesce("old_id", "_old")).drop("_old")
        return found

    def unseen(self, digests: DataFrame, batch: str) -> DataFrame:
        """The digests that no other batch has, by a merge anti-join with every run."""
        for run in self.runs():
            digests = digests.join(self._others(run, batch), "digest", "left_anti")
        return digests

    def before(self, batch: str) -> DataFrame:
        """Digests of all other batches."""
        first, *rest = (self._others(run, batch) for run in self.runs())
        for run in rest:
            first = first.unionByName(run)
        return first

    def append(self, digests: DataFrame, batch: str) -> None:
        """Add a batch; one that is in the index already (a rerun) is left as it is."""
        if not self.spark.table(self.table).filter(F.col("batch") == batch).isEmpty():
            return
        runs = [*self.runs(), self._run(digests.withColumn("batch", F.lit(batch)))]
        self._commit(runs)
        if len(runs) > self.max_runs:
            # Plain files: a union of bucketed scans may lose its buckets and keep its place.
            files = [f for run in runs for f in self.spark.table(run).inputFiles()]
            rows = self.spark.table(self.table)
            if files:
                rows = self.spark.read.schema(rows.schema).parquet(*files)
            self._commit([self._run(rows)])
            for run in runs:
                self.spark.sql(f"DROP TABLE IF EXISTS {run}")

    def _others(self, run: str, batch: str) -> DataFrame:
        rows = self.spark.table(run).filter(F.col("batch") != batch)
        return rows.select("digest", F.col("keep_id").alias("old_id")).hint("merge")

    def _run(self, rows: DataFrame) -> str:
        name = f"{self.table}_{uuid.uuid4().hex}"
        (
            rows.select("digest", "keep_id", "batch").repartition(self.buckets, "digest")
            .write.format("parquet").mode("errorifexists")
            .bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(name)
        )
        return name

    def _commit(self, runs: list[str]) -> None:
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self.table}"
            f" TBLPROPERTIES ('runs' = '{','.join(runs)}', 'buckets' = '{self.buckets}') AS "
            + " UNION ALL ".join(f"SELECT digest, keep_id, batch FROM {run}" for run in runs)
        )

    def _property(self, name: str) -> str:
        return self.spark.sql(f"SHOW TBLPROPERTIES {self.table} ('{name}')").first()["value"]


def exact_dedup(docs: DataFrame, index: DigestIndex, batch: str) -> DataFrame:
    """Decide for every row of ``docs`` (doc_id, text) whether it stays, and index the batch.

    Texts are equal when identical; a null text counts as empty. Of equal texts the
    row with the largest doc_id stays, unless an earlier batch had the text: then
    none stays and ``keep_id`` is the earlier row's. Rows with a null doc_id stay only
    if all rows of the text have none. Rows equal in id and text are one document and
    are decided alike. An empty table gives an empty result. Other columns are not read.

    Columns: doc_id, keep_id, group_size (rows of the batch with the text), kept,
    text_sha256, seen (in an earlier batch), row_key.

    Groups are counted before they are shuffled, so a text that fills a third of the
    rows is one row a task; when verdicts are joined back, adaptive execution splits it.
    """
    digests = docs.select(
        "doc_id", row_key().alias("row_key"), F.unhex(F.sha2(text_of(), 256)).alias("digest")
    )
    groups = digests.groupBy("digest").agg(
        F.max("doc_id").alias("new_id"), F.count("*").alias("group_size")
    )
    verdicts = written(
        index.lookup(groups, batch).withColumns(
            {
                "seen": F.col("old_id").isNotNull(),
                "keep_id": F.coalesce("old_id", "new_id"),
            }
        ).drop("old_id", "new_id"),
        "verdicts",
    )
    index.append(index.unseen(verdicts.select("digest", "keep_id"), batch), batch)
    return digests.join(verdicts, "digest").select(
        "doc_id",
        "keep_id",
        "group_size",
        (~F.col("seen") & F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        "seen",
        "row_key",
    )


def survivors(docs: DataFrame, decisions: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns. Of rows equal in id and
    text, which are decided alike, one stays."""
    gone = decisions.filter(~F.col("kept")).select("doc_id", "row_key")
    twice = written(
        decisions.filter("kept").groupBy("doc_id", "row_key").count().filter("count > 1"), "twice"
    ).drop("count")
    if twice.isEmpty():
        return without(docs, gone)
    repeated = without(docs, twice, "left_semi").dropDuplicates(["doc_id", "text"])
    return without(docs, gone.unionByName(twice)).unionByName(repeated)
