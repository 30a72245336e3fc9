"""A corpus pipeline over documents: each stage works on all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from episodica.llm import stages
from episodica.llm.common import materialize

STAGES = [
    ("language", stages.identify_language),
    ("exact_dedup", stages.drop_copies),
    ("simhash_dedup", stages.drop_near_copies),
    ("mixing", stages.mix_sources),
    ("bpe", stages.encode_tokens),
]

#: Language identification and SimHash have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each written as Parquet in the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
