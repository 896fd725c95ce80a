"""Corpus pipeline: documents are filtered, deduplicated, mixed and packed.

Every stage is written as Parquet and read again as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from waybill.llm.cube_sampling import mix_sources, mixture
from waybill.llm.exact_dedup import exact_dedup, survivors
from waybill.llm.frames import written
from waybill.llm.minhash import near_duplicates, one_of_each
from waybill.llm.packing import pack_sequences
from waybill.llm.quality_rules import quality_rules, quality_survivors
from waybill.llm.queries import documents, new_index


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality_survivors(docs, quality_rules(docs))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return survivors(docs, exact_dedup(docs, new_index(spark), "documents"))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return one_of_each(docs, near_duplicates(docs, keyed=True))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixture(docs, mix_sources(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all documents in sequences."""
    return pack_sequences(docs)


STAGES = [
    ("quality_rules", quality),
    ("exact_dedup", exact),
    ("near_duplicates", near),
    ("source_mix", mix),
    ("best_fit_packing", pack),
]

# Sampling and near-duplicate detection are not SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
