"""Uniqueness of a growing table's key from mergeable sketches, one set a version.

An exact distinct count reads the whole history at every run. Here each
version leaves one HyperLogLog sketch per stratum of its keys (strata by hash);
a run sketches its own rows, merges the stored sketches and knows the distinct
count within an interval. Only if the threshold lies inside that interval is
the history counted exactly, so the status is the exact check's.

The strata make the interval narrow enough for the reference threshold of
0.999: the errors of independent sketches partly cancel, and 64 sketches of
2^19 counters know the count to 0.018%, whatever its size. A sketch of few keys
stays small; a full set has 32 MB, held in 64 groups that map tasks fill.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators import dq

STRATA = 64
LG_K = 19
# Relative standard error of merged sketches is this over sqrt(2^LG_K), per stratum.
MERGED_ERROR = math.sqrt(3 * math.log(2) - 1)
# Half the interval in standard errors: the truth lies outside about once in 15,000 checks.
Z = 4.0


def key_sketches(df: DataFrame, key: str, by: list[str | Column] | None = None) -> DataFrame:
    """(*by, stratum, rows, keys, sketch): mergeable; NULL keys count as rows, not as keys."""
    k = F.col(key).cast("string")
    return df.groupBy(*(by or []), F.pmod(F.xxhash64(k), F.lit(STRATA)).cast("int").alias("stratum")).agg(
        F.count(F.lit(1)).alias("rows"), F.count(k).alias("keys"), F.hll_sketch_agg(k, LG_K).alias("sketch"))


def write_sketches(df: DataFrame, key: str, path: str, version: int | str) -> None:
    """Store a version's sketches; written again after a failure, they replace themselves."""
    key_sketches(df, key).write.mode("overwrite").parquet(f"{path.rstrip('/')}/v={version}")


def read_sketches(spark: SparkSession, path: str) -> DataFrame:
    """The sketches of all stored versions."""
    return spark.read.schema("v string, stratum int, rows bigint, keys bigint, sketch binary").parquet(path)


def bounds(sketches: DataFrame) -> DataFrame:
    """One row (rows, estimate, low, high): the distinct keys of all sketched versions together."""
    merged = sketches.groupBy("stratum").agg(
        F.sum("rows").alias("rows"), F.sum("keys").alias("keys"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).cast("double").alias("estimate"))
    error = MERGED_ERROR / math.sqrt(1 << LG_K)
    spread = F.sqrt(F.sum(F.pow(F.col("estimate") * error, F.lit(2.0)))) * Z
    one = merged.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.coalesce(F.sum("keys"), F.lit(0)).alias("keys"),
                     F.coalesce(F.sum("estimate"), F.lit(0.0)).alias("estimate"),
                     F.coalesce(spread, F.lit(0.0)).alias("spread"))
    return one.select("rows", F.least("estimate", "keys").alias("estimate"),
                      F.least(F.greatest(F.col("estimate") - F.col("spread"), F.lit(0.0)), "keys").alias("low"),
                      F.least(F.col("estimate") + F.col("spread"), "keys").alias("high"))


def check_uniqueness(sketches: DataFrame, history: DataFrame, table: str, key: str,
                     threshold: float = 0.999) -> DataFrame:
    """Q2 over all versions; ``history`` is read only if the sketches cannot decide.

    The columns are those of ``dq.check_uniqueness``. Decided by sketches,
    ``metric_value`` is the estimated ratio and ``detail`` says so. An empty
    table fails, as in the exact check.
    """
    b = bounds(sketches).first()
    rows = b["rows"]
    passed, failed = b["low"] >= threshold * rows, b["high"] < threshold * rows
    if rows and not passed and not failed:
        return dq.check_uniqueness(history, table, key, threshold)
    score = b["estimate"] / rows if rows else 0.0
    return sketches.sparkSession.range(1).select(
        F.lit("uniqueness").alias("check_name"), F.lit(table).alias("table"),
        F.lit("PASS" if rows and passed else "FAIL").alias("status"),
        F.round(F.lit(float(score)), 4).alias("metric_value"), F.lit(float(threshold)).alias("threshold"),
        F.lit(f"{b['low']:,.0f} to {b['high']:,.0f} of {rows:,} unique values for {key} (by sketches)").alias("detail"),
        F.current_timestamp().alias("run_ts"))
