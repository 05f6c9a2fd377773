"""Training-data pipeline over ``documents``: five stages, each stored and read again.

Quality classifier, line dedup, SimHash near-dedup, substring dedup, packing.
Every stage works on all that its predecessor kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tabloom.llm import (
    line_dedup,
    packing,
    quality_classifier,
    simhash,
    substring_dedup,
)
from tabloom.llm.common import on_workers
from tabloom.session import materialize


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    labels = on_workers(spark).read.parquet(f"{sf_dir}/labels.parquet")
    model = quality_classifier.train(docs, labels)
    return quality_classifier.accepted(docs, model)


def single_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-equal lines one stays, in its earliest document."""
    return line_dedup.deduplicated(docs)


def single_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates."""
    return simhash.deduplicated(docs)


def single_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of passages that an earlier document has are removed."""
    return substring_dedup.deduplicated(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 1,024 tokens."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(docs, path, end_id=0)


STAGES = [
    ("quality_classifier", good_documents),
    ("line_dedup", single_lines),
    ("simhash", single_documents),
    ("substring_dedup", single_passages),
    ("packing", packed),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = on_workers(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
