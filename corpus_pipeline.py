"""From raw documents to training sequences: five stages, each read from and written to Parquet.

Quality rules, exact duplicates, near duplicates, the source mix, packing. A stage gets all rows its predecessor kept;
each but the last returns the columns of ``documents``. When a stage begins, its predecessor's result is written and
the tables it was computed from are dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trellis.llm import exact_dedup, mixing, packing, quality, simhash
from trellis.session import Scratch

_last: dict[str, Scratch] = {}


def own_tables(spark: SparkSession) -> Scratch:
    """The folder for a stage's intermediate tables. The last stage's go: its result has been written by now."""
    key = spark.sparkContext.applicationId
    if key in _last:
        _last[key].drop()
    _last[key] = Scratch(spark)
    return _last[key]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    return quality.keep_good(docs, scratch=own_tables(spark))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the smallest doc_id stays."""
    return exact_dedup.keep_first(docs, scratch=own_tables(spark))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group that links connect the smallest doc_id stays."""
    return simhash.keep_first(docs, scratch=own_tables(spark))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents stand as often, and with as much of their text, as the mix takes of them."""
    return mixing.mixed_rows(docs, scratch=own_tables(spark))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences."""
    own_tables(spark)
    return packing.pack(docs, packing.tokenizer_path())


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_duplicates),
    ("near dedup", near_duplicates),
    ("source mix", source_mix),
    ("packing", packed_sequences),
]
# Seeded mixing and a trained vocabulary's tokens are beyond SQL; tests/llm compares every stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scratch = Scratch(spark)
    for number, (_, stage) in enumerate(STAGES):
        docs = scratch.put(stage(spark, docs, sf_dir), f"stage{number}")
    return docs
