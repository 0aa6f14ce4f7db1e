"""The training-data pipeline: documents judged, deduplicated, cleaned of repeats and packed.

Defined results: null text counts as empty in every stage and stays null where a stage keeps the document; a null
doc_id has no label and ranks behind all others among rows that are otherwise alike; rows that repeat are copies,
of which the exact dedup keeps one; with no usable label nothing is rejected; columns of any name pass through all
stages but the last; an empty table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from wardline.llm import exact_dedup, packing, quality_classifier, simhash, substring_dedup
from wardline.llm.common import written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    model = quality_classifier.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_classifier.keep(docs, model)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.dedup(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints."""
    return simhash.dedup(docs)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that occur elsewhere among them."""
    return substring_dedup.remove(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences for training."""
    return packing.packed_pieces(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", quality), ("exact dedup", exact), ("simhash near-dedup", near),
    ("substring dedup", substrings), ("best-fit packing", packed),
]

#: A trained model and XXH64 have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each one written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
