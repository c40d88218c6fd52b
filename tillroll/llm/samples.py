"""Bounded samples of labelled rows for fitting the two classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows a class may add to a sample (expected; see ``per_class``) and the most
# bytes a sample takes of one text. Predictions always read whole texts.
CLASS_ROWS = 1500
SAMPLE_TEXT_BYTES = 1 << 16


def id_remainder(id_col: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``."""
    return F.crc32(id_col.cast("string").cast("binary")) % mod


def sample_text(text: Column, id_col: Column, most: int = SAMPLE_TEXT_BYTES) -> Column:
    """The text as a sample takes it: whole up to ``most`` bytes, else a slice at a place drawn by the id.

    A code point has at most four bytes, so a slice of ``most`` / 4 of them stays within the bound.
    """
    text, n = F.coalesce(text, F.lit("")), most // 4
    places = F.greatest(F.char_length(text) - F.lit(n - 1), F.lit(1))
    start = F.coalesce(F.pmod(F.xxhash64(F.lit("slice"), id_col), places), F.lit(0)).cast("int") + 1
    return F.when(F.octet_length(text) <= most, text).otherwise(F.substr(text, start, F.lit(n)))


def per_class(rows: DataFrame, label: str, id_col: str, most: int = CLASS_ROWS) -> DataFrame:
    """Keep about ``most`` rows of every class, chosen by a hash of the id.

    One count per class (a few rows) gives the share to keep, so sampling is a
    filter in the scan: nothing is sorted and a hot class moves no data.
    """
    counts = {r[0]: r[1] for r in rows.groupBy(label).count().collect()}  # one row per class
    keep = F.lit(False)
    for value, n in counts.items():
        cut = min(1 << 20, (most << 20) // n)
        keep = keep | ((F.col(label) == F.lit(value)) & (F.pmod(F.xxhash64(F.lit("sample"), F.col(id_col)), F.lit(1 << 20)) < cut))
    return rows.filter(keep)
