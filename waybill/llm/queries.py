"""Registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.llm.best_fit_decreasing import shard_evenly
from waybill.llm.cube_sampling import mix_sources
from waybill.llm.exact_dedup import DigestIndex, exact_dedup
from waybill.llm.frames import text_of, words_of
from waybill.llm.license_scan import license_scan
from waybill.llm.lm_scoring import lm_scores
from waybill.llm.minhash import near_duplicates
from waybill.llm.packing import pack_sequences
from waybill.llm.periodic_runs import periodic_runs
from waybill.llm.pii import personal_data
from waybill.llm.quality_rules import quality_rules
from waybill.llm.substring_dedup import substring_dedup
from waybill.llm.warc import derivatives, responses_of_pages
from waybill.llm.whitening import whiten


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def new_index(spark: SparkSession) -> DigestIndex:
    """An index that has seen nothing."""
    return DigestIndex(spark, f"digests_{uuid.uuid4().hex}")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    decisions = exact_dedup(documents(spark, sf_dir), new_index(spark), "documents")
    return decisions.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir)).drop("row_key")


def op3_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return derivatives(responses_of_pages(pages))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_sequences(documents(spark, sf_dir))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_evenly(documents(spark, sf_dir)).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(documents(spark, sf_dir)).drop("kept_text")


def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(documents(spark, sf_dir))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(documents(spark, sf_dir))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(documents(spark, sf_dir))


def with_periodic_tails(docs: DataFrame) -> DataFrame:
    """Every tenth document, by the hash of its id, with a tail that repeats its first words.

    A null doc_id has no hash; its text stays as it is.
    """
    hashed = F.crc32(F.col("doc_id").cast("string"))
    chosen = docs.select("doc_id", "text").withColumn(
        "_words", F.when(hashed % 10 == 0, words_of(text_of()))
    )
    n = F.size("_words").cast("long")
    told = chosen.withColumn("_g", F.floor(hashed / 10)).withColumn(
        "_start", F.when(n > 0, F.col("_g") % n)
    ).withColumn("_rest", n - F.col("_start")).withColumn(
        "_period", 1 + F.floor(F.col("_rest") / (3 + F.col("_g") % 8))
    )
    times = F.ceil(F.col("_rest") / F.col("_period")).cast("int")
    start, rest, period = (F.col(c).cast("int") for c in ("_start", "_rest", "_period"))
    tail = F.slice(
        F.flatten(F.array_repeat(F.slice("_words", start + 1, period), times)), F.lit(1), rest
    )
    text = F.array_join(F.concat(F.slice("_words", F.lit(1), start), tail), " ")
    return told.select(
        "doc_id", F.when(F.col("_rest").isNotNull(), text).otherwise(F.col("text")).alias("text")
    )


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_periodic_tails(documents(spark, sf_dir)))
    best = F.array_max(F.transform(
        "runs", lambda r: F.struct(r["length"], -r["start"], -r["period"], r["start"], r["period"])
    ))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.withColumn("_best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("_best.start").alias("start"),
        F.col("_best.length").alias("length"),
        F.col("_best.period").alias("period"),
        F.floor(F.col("_best.length") * 1000 / F.col("_best.period")).alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, model = whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    shares = [] if model is None else model.explained.tolist()
    error = 0.0 if model is None else model.identity_error
    explained = F.array(*map(F.lit, shares)).cast("array<double>")
    return rows.select(
        "vec_id", "n", "deviation", F.posexplode("whitened").alias("place", "whitened")
    ).select(
        "vec_id", (F.col("place") + 1).alias("component"), "n", "deviation", "whitened",
        F.get(explained, F.col("place")).alias("explained"), F.lit(error).alias("identity_error"),
    )


def op13_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    return lm_scores(documents(spark, sf_dir), held_out)


QUERIES = {
    f.__name__: f
    for f in (
        op1_exact_dedup, op2_quality_rules, op3_warc_derivatives, op4_best_fit_packing,
        op5_sharding, op6_substring_dedup, op7_source_mix, op8_personal_data, op9_near_duplicates,
        op10_license_scan, op11_periodic_runs, op12_embedding_whitening, op13_lm_scores,
    )
}

ORACLE = {
    "op1_exact_dedup": """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
 doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
}
