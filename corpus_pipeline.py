"""Corpus pipeline over ``documents``: a list of stages, each written and reread.

Language ID -> SimHash near-dedup -> benchmark decontamination -> mixing
sources to target weights -> sharding. Every stage takes (spark, docs, sf_dir)
and returns a DataFrame; all but the last return the columns of ``documents``.

ORACLE_SQL is None: the language model, the 64-bit shingle hashes and the
knapsack of the mix have no SQL form. Tests compare the stages with
brute-force versions instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillroll.llm import stages
from tillroll.session import work_path

STAGES = [
    ("language_id", stages.language_id),
    ("simhash_dedup", stages.simhash_dedup),
    ("decontaminate", stages.decontaminate),
    ("mix_sources", stages.mix_sources),
    ("shard", stages.shard),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is a table in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = work_path(spark, "pipeline", name, fresh=True)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
