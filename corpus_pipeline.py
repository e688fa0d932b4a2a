"""From raw documents to packed training sequences, in five stages.

Each stage works on all that its predecessor kept and is written as Parquet to the shared folder before the next
one reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cairn.llm import stages
from cairn.llm.common import durable

STAGES = [
    ("language_id", stages.language),
    ("line_dedup", stages.line_dedup),
    ("ngram_jaccard", stages.near_copies),
    ("substring_dedup", stages.repeated_spans),
    ("packing", stages.pack),
]
#: Code lengths, components of near copies and tokenization are beyond SQL: the operators and all stages in a row are
#: tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = durable(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
