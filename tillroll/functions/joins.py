"""Join-side helpers with explicit size checks.

A dimension is broadcast only behind a proven bound on its rows: the row
count of the table it is derived from, read from Parquet footers (no data
pages are read). Cleansing, dedupe and left joins to unique keys can only
keep or drop rows, so the source count bounds the dimension. Above the
limit nothing is hinted and the planner uses a shuffle join, with AQE
splitting skewed partitions (a store with a third of all sales).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# About 1M narrow dimension rows is tens of MB per executor: safe to ship
# to a thousand executors. Larger dimensions take the shuffle join.
BROADCAST_MAX_ROWS = 1_000_000
BROADCAST_MAX_BYTES = 512 << 20
TEXT_BYTES = 200
FEW_PARTITIONS = 4


def source_rows(spark: SparkSession, path: str) -> int:
    """Row count of a Parquet table from its footers (metadata only)."""
    return spark.read.parquet(path).count()


def source_rows_many(spark: SparkSession, paths: dict[str, str]) -> dict[str, int]:
    """Footer row counts of several tables in one job."""
    parts = [spark.read.parquet(p).agg(F.count(F.lit(1)).alias("n")).select(F.lit(k).alias("k"), "n")
             for k, p in paths.items()]
    u = parts[0]
    for x in parts[1:]:
        u = u.unionByName(x)
    return {r["k"]: r["n"] for r in u.collect()}


def row_width(df: DataFrame, text_bytes: int = TEXT_BYTES) -> int:
    """Bytes of a row when text columns are ``text_bytes`` long."""
    width = 8
    for f in df.schema.fields:
        fixed = isinstance(f.dataType, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType,
                                        T.TimestampNTZType))
        width += 16 if fixed else text_bytes
    return width


def bounded_broadcast(df: DataFrame, row_bound: int | None, max_rows: int = BROADCAST_MAX_ROWS,
                      max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Hint a broadcast only when ``row_bound`` is known and rows and bytes are under the limits.

    Bytes are the row bound times the width of the columns that are left, with
    a generous length for text.
    """
    if row_bound is not None and row_bound <= max_rows and row_bound * row_width(df) <= max_bytes:
        return F.broadcast(df)
    return df


def spread(df: DataFrame, spark: SparkSession) -> DataFrame:
    """Deal out a scan of a handful of partitions over the cores.

    A table stored as one file with one row group is read by one task, so all
    work before the first shuffle would run in it. Only a scan of at most
    FEW_PARTITIONS (so at most a few hundred MB) is dealt out: the shuffle
    this adds never grows with the table.
    """
    target = spark.sparkContext.defaultParallelism
    parts = df.rdd.getNumPartitions()
    return df.repartition(target) if parts <= FEW_PARTITIONS and parts < target else df
