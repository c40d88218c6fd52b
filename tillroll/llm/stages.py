"""Pipeline stages: each calls one operator and lets its decisions take effect.

All but the last keep the columns of their input, whatever these are besides
doc_id, text, source and lang. A row is known by its id and text together, so
rows without an id, or sharing one, are judged each by their own text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import decontaminate as decontamination
from tillroll.llm import language_id as languages
from tillroll.llm import mixing, sharding, simhash
from tillroll.llm.common import row_key, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language is undetermined; a filter in the scan.

    Without a usable label there is no model to judge by, and only texts
    without a letter go.
    """
    model = languages.fit(spark, docs)
    if not model["langs"]:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    predict = languages.predictor(spark, model)
    return docs.filter(predict(F.col("text"))["lang_pred"] != languages.UNKNOWN)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of every near-duplicate group: the smallest id's, one without an id if there is no other."""
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                        row_key(F.col("doc_id"), F.col("text")).alias(simhash.KEY))
    # repeated rows fall together before the shuffle, so a hot one is never gathered
    return keyed.dropDuplicates([simhash.KEY]).join(simhash.representatives(spark, docs), simhash.KEY, "left_semi") \
        .select("row.*")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the rows that the benchmark contaminates, whatever other rows share their id."""
    found = decontamination.contamination(docs, table(spark, sf_dir, "benchmark"), keyed=True) \
        .filter("contaminated").select(F.col("doc_id").alias("hit_id"), "text_key").distinct()
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col("doc_id").alias("own_id"), decontamination.text_key(F.col("text")).alias("own_key")) \
        .join(found, F.col("own_id").eqNullSafe(F.col("hit_id")) & (F.col("own_key") == F.col("text_key")),
              "left_anti").select("row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it (up to twice)."""
    return mixing.mix(docs, carry=True).filter("copies > 0") \
        .select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select("row.*")


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every kept document with its shard and place in the shard."""
    return sharding.shard(spark, docs)
