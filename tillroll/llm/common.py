"""Helpers shared by the training-data operators."""

from __future__ import annotations

import gc

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ASCII white space of the word rule [^\x20\x09-\x0D]+.
SPACE_CHARS = " \t\n\x0b\f\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: it is not computed twice."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and use it several times in ``body``.

    A lambda variable is bound to a computed value, so no optimizer rule can
    copy the expression into every place that mentions it.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """Words [^\\x20\\x09-\\x0D]+ of a text as an array; NULL or blank: empty."""
    core = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS))
    return F.when(core == "", F.array().cast("array<string>")).otherwise(F.split(core, SPACE_RUN))


def row_key(doc_id: Column, text: Column) -> Column:
    """Digest of a row's id and text; a NULL id is a value of its own, NULL text is the empty text."""
    name = F.when(doc_id.isNull(), "null ").otherwise(F.concat(F.lit("is "), doc_id.cast("string"), F.lit(" ")))
    return F.md5(F.concat(name, F.coalesce(text, F.lit(""))).cast("binary"))


def bounded_arrow_batches(spark: SparkSession, rows: int = 512, size: int = 32 << 20) -> None:
    """Keep Arrow batches small enough for whole texts of any length.

    The default of 10,000 rows a batch can hold gigabytes of long documents;
    batches are cut by rows and by bytes, so a worker holds tens of MB.
    """
    for key, value in (("spark.sql.execution.arrow.maxRecordsPerBatch", rows),
                       ("spark.sql.execution.arrow.maxBytesPerBatch", size)):
        now = spark.conf.get(key).rstrip("b")
        if not now.lstrip("-").isdigit() or not 0 < int(now) <= value:
            spark.conf.set(key, str(value))


BITS = 1 << 27
_BITMAP = 32768  # bits in one value of bitmap_construct_agg


def bit_set(values: DataFrame, col: str, bits: int = BITS) -> np.ndarray:
    """A fixed-size bit set (16 MB) with bit ``col mod bits`` set for every row.

    Built as map-side combined bitmaps; the driver gets at most bits / 32768
    rows of 4 KB whatever the number of rows. It is a filter without false
    negatives: what passes it is checked exactly afterwards.
    """
    slot = F.pmod(F.col(col), F.lit(bits)) + 1
    parts = values.groupBy(F.bitmap_bucket_number(slot).alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bitmap")).toArrow()
    out = np.zeros(bits // 8, np.uint8)
    for part, bitmap in zip(parts.column("part").to_pylist(), parts.column("bitmap").to_pylist()):
        at = (part - 1) * (_BITMAP // 8)
        out[at:at + len(bitmap)] = np.frombuffer(bitmap, np.uint8)
    return out


def in_bit_set(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    slot = values.astype(np.int64) & (len(bits) * 8 - 1)
    return (bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1


def bit_filter(spark: SparkSession, values: DataFrame, col: str):
    """A function of a column of ids: True for every id in ``values.col``, False for nearly all others."""
    marks = spark.sparkContext.broadcast(bit_set(values.select(F.xxhash64(col).alias("h")), "h"))

    @F.pandas_udf("boolean")
    def hit(h: pd.Series) -> pd.Series:
        return pd.Series(in_bit_set(marks.value, h.to_numpy(np.int64)))

    return lambda ids: hit(F.xxhash64(ids))


def release_shuffles(spark: SparkSession) -> None:
    """Let the context cleaner drop the shuffle files of finished steps.

    They go when the driver's references are collected, which a small driver
    heap may put off until long after the disk was needed.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
