"""Document fingerprints: one-permutation MinHash in DataFrame functions.

Every five-word shingle is hashed once. The top byte of the hash names one of
256 bins, and each bin keeps its smallest hash. An empty bin copies a filled
one chosen by the bin's own fixed random probes (optimal densification): eight
probes first, then the filled bin that comes first in the bin's own random
order. Eight low-order bits per bin are packed into 32 longs and shown as 512
hex digits. The likeness of two fingerprints is the share of equal bins,
corrected for the 1/256 chance of an accidental match.

All work on a text happens inside its row: no shingle is ever shuffled.

Defined cases: NULL text counts as empty; a text of fewer than five words is
one shingle; a text without words has the fingerprint of 512 zeros (likeness
1 to another such text); equal texts have equal fingerprints; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillroll.llm.common import let, words

SHINGLE = 5
BINS = 256
LANES = BINS // 8
PROBES = 8
# Documents per id range, and the most ranges there can be (a broadcast bound).
RANGE_ROWS = 1024
MAX_RANGES = 65536


def shingle_hashes(w: Column) -> Column:
    """One 64-bit hash per shingle (repeats included); no words: empty."""
    n = F.size(w)
    rolled = F.transform(F.sequence(F.lit(0), n - SHINGLE),
                         lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(SHINGLE)]))
    return F.when(n >= SHINGLE, rolled).when(n > 0, F.array(F.xxhash64(w))) \
        .otherwise(F.array().cast("array<bigint>"))


def _bin(h: Column) -> Column:
    """Bin 0..255 from the top byte; keeps the order of the signed hash."""
    return (F.shiftright(h, 56) + F.lit(BINS // 2)).cast("int")


def _low(h: Column) -> Column:
    return h.bitwiseAND(F.lit(255).cast("bigint"))


def _sparse_bins(mins: Column) -> Column:
    """256 low bytes, NULL for empty bins, from the bins' smallest hashes in order."""
    none = F.lit(None).cast("bigint")

    def place(h: Column, i: Column) -> Column:
        before = F.when(i == 0, F.lit(-1)).otherwise(_bin(F.get(mins, i - 1)))
        return F.concat(F.array_repeat(none, _bin(h) - before - 1), F.array(_low(h)))

    tail = F.array_repeat(none, F.lit(BINS - 1) - _bin(F.get(mins, F.size(mins) - 1)))
    return F.flatten(F.concat(F.transform(mins, place), F.array(tail)))


def _densified(mins: Column) -> Column:
    def fill(sparse: Column) -> Column:
        def value(v: Column, b: Column) -> Column:
            probes = [F.get(sparse, F.pmod(F.xxhash64(b, F.lit(a)), F.lit(BINS)).cast("int"))
                      for a in range(PROBES)]
            first = F.array_min(F.transform(mins, lambda h: F.struct(
                F.xxhash64(b, F.lit(PROBES), _bin(h)).alias("order"), _low(h).alias("low"))))["low"]
            return F.coalesce(v, *probes, first)
        return F.transform(sparse, value)

    return let(_sparse_bins(mins), fill)


def _packed(dense: Column) -> Column:
    def lane(k: Column) -> Column:
        parts = [F.shiftleft(F.get(dense, k * 8 + j), 8 * (7 - j)) for j in range(8)]
        return reduce(lambda a, b: a.bitwiseOR(b), parts)

    return F.transform(F.sequence(F.lit(0), F.lit(LANES - 1)), lane)


def fingerprint(text: Column) -> Column:
    """Packed fingerprint of a text as 32 longs."""
    def of_hashes(hashes: Column) -> Column:
        mins = F.filter(hashes, lambda h, i: (i == 0) | (_bin(h) != _bin(F.get(hashes, i - 1))))
        return let(mins, lambda m: _packed_or_zero(m))

    return let(words(text), lambda w: let(F.sort_array(shingle_hashes(w)), of_hashes))


def _packed_or_zero(mins: Column) -> Column:
    empty = F.array_repeat(F.lit(0).cast("bigint"), LANES)
    return F.when(F.size(mins) == 0, empty).otherwise(let(_densified(mins), _packed))


def hex_text(fp: Column) -> Column:
    return F.array_join(F.transform(fp, lambda x: F.lower(F.lpad(F.hex(x), 16, "0"))), "")


def likeness(a: Column, b: Column) -> Column:
    """Estimated shingle likeness of two packed fingerprints, 0 to 1.

    Differing bytes are counted in eight lanes at once: each byte of the xor
    is folded onto its lowest bit.
    """
    def equal_bytes(x: Column, y: Column) -> Column:
        d = x.bitwiseXOR(y)
        for shift, mask in ((4, 0x0F0F0F0F0F0F0F0F), (2, 0x0303030303030303), (1, 0x0101010101010101)):
            d = d.bitwiseOR(F.shiftrightunsigned(d, shift)).bitwiseAND(F.lit(mask).cast("bigint"))
        return F.lit(8) - F.bit_count(d)

    same = F.aggregate(F.zip_with(a, b, equal_bytes), F.lit(0), lambda s, x: s + x)
    chance = 1.0 / 256
    return F.greatest(F.lit(0.0), (same / F.lit(float(BINS)) - chance) / (1 - chance))


def id_ranges(ids: DataFrame, col: str, rows: int = RANGE_ROWS, most: int = MAX_RANGES) -> list[int]:
    """Sorted upper cut points that split ``col`` into ranges of about ``rows`` rows."""
    n = ids.agg(F.count(col)).first()[0]
    parts = min(most, -(-n // rows))
    if parts < 2:
        return []
    cuts = ids.agg(F.percentile_approx(col, [i / parts for i in range(1, parts)],
                                       max(10000, 20 * parts)).alias("q")).first()["q"]
    return sorted(set(cuts))


def _range_of(col: Column, cuts: list[int]) -> Column:
    """Number of cut points <= id, by binary search over a literal array."""
    if not cuts:
        return F.lit(0)
    bounds = F.array(*[F.lit(int(c)).cast("bigint") for c in cuts]) if len(cuts) <= 64 else \
        F.from_json(F.lit("[" + ",".join(map(str, cuts)) + "]"), "array<bigint>")
    steps = [1 << k for k in reversed(range(len(cuts).bit_length()))]
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]), F.lit(0),
        lambda at, step: F.when(F.get(bounds, at + step - 1) <= col, at + step).otherwise(at))


def with_next(docs: DataFrame, id_col: str, columns: list[str], cuts: list[int]) -> DataFrame:
    """Add ``next_<c>`` of the next row in descending id order (last: the first).

    Rows are dealt to id ranges; the first row of each range also goes to the
    end of the range before it, so every range finds its neighbours alone.
    Rows with equal ids follow one another by text; NULL ids come last.
    """
    ranged = docs.withColumn("range_no", _range_of(F.col(id_col), cuts))
    firsts = docs.select(id_col).withColumn("range_no", _range_of(F.col(id_col), cuts)) \
        .groupBy("range_no").agg(F.max(id_col).alias("first_id"))
    down = Window.orderBy(F.col("range_no").desc())
    whole = down.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # one row per range: at most MAX_RANGES rows, so this window and broadcast are bounded
    to = firsts.select("first_id", F.coalesce(F.lag("range_no").over(down),
                                              F.last("range_no").over(whole)).alias("also"))
    dealt = ranged.join(F.broadcast(to), F.col(id_col) == F.col("first_id"), "left").select(
        *docs.columns, F.explode(F.array_compact(F.array(
            F.struct(F.col("range_no").alias("to_range"), F.lit(0).alias("tail")),
            F.when(F.col("also").isNotNull(), F.struct(F.col("also").alias("to_range"), F.lit(1).alias("tail"))))
        )).alias("deal")).select(*docs.columns, "deal.to_range", "deal.tail")
    order = Window.partitionBy("to_range").orderBy("tail", F.col(id_col).desc_nulls_last(), F.col("text"))
    nexts = [F.lead(c).over(order).alias(f"next_{c}") for c in columns]
    return dealt.select(*docs.columns, "tail", *nexts).filter("tail = 0").drop("tail")


def edited_text(text: Column, n_chars: Column, other: Column) -> Column:
    """Second half replaced by the start of ``other`` (as many characters or all)."""
    half = F.floor(n_chars / 2).cast("int")
    return F.concat(F.left(text, n_chars - half), F.left(F.coalesce(other, F.lit("")), half))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint of every text, of its edited text, and their likenesses."""
    base = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    cuts = id_ranges(base, "doc_id")
    rows = with_next(base.withColumn("fp", fingerprint(F.col("text"))), "doc_id", ["text", "fp"], cuts)
    n = F.length("text")
    rows = rows.select("doc_id", n.alias("n_chars"), "fp", "next_fp",
                       edited_text(F.col("text"), n, F.col("next_text")).alias("edited"))
    rows = rows.select("doc_id", "n_chars", "fp", "next_fp", F.sha2("edited", 256).alias("edited_sha256"),
                       fingerprint(F.col("edited")).alias("edited_fp"))
    return rows.select(
        "doc_id", F.col("n_chars").cast("bigint").alias("n_chars"), "edited_sha256",
        hex_text(F.col("fp")).alias("fingerprint"), hex_text(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        F.coalesce(likeness(F.col("fp"), F.col("next_fp")), F.lit(0.0)).alias("near_next"))
