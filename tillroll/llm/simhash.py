"""SimHash near-duplicates with pivot distance tables.

Fingerprint: XXH64 (seed 42) of every three-word shingle; a bit is set if it is
set in over half of the hashes. Copies share a fingerprint, so everything
after that works on distinct fingerprints.

Pivot tables: each distinct fingerprint's Hamming distances to 16 fixed
reference fingerprints are computed once and packed, eight to a long. By the
triangle inequality two fingerprints within 2 bits differ by at most 2 in
every coordinate, so a pair is discarded by its largest coordinate difference
before its real distance is computed.

Pivot tables alone would still meet every pair. Pairs therefore meet in cells:
of four 16-bit blocks at least two are equal if at most two bits differ, so
each fingerprint enters six cells (two blocks each), and a pair counts only in
its first common cell. A fingerprint has at most 64 + 2016 distinct neighbours
within 2 bits, so links grow in proportion to the fingerprints however large
a group of near copies is.

Components: labels over linked fingerprints fall to the smallest by hooking
and pointer jumping; every round is a table in the shared folder.

Defined cases: NULL or blank text has fingerprint 0 and links like any other;
fewer than three words are one shingle; NULL ids belong to components but name
none (NULL if a component has no other); repeated rows give equal rows; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import bounded_arrow_batches, row_key
from tillroll.session import work_path

SHINGLE = 3
MAX_BITS = 2
HASH_SEED = 42
PIVOTS = 16
BLOCK_BITS = 16
KEY = "row_key"
# Shingle hashes held at once while a long text is summed.
CHUNK = 1 << 16


def _pivots(n: int = PIVOTS) -> list[int]:
    """Fixed pseudo-random references, as signed longs."""
    draw = random.Random(64)
    return [draw.getrandbits(64) - (1 << 63) for _ in range(n)]


def text_fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of a whole text."""
    words = (text or "").translate(_LOWER).encode().split()  # bytes.split(): ASCII white space only
    n = len(words) - shingle + 1
    if not words:
        return 0
    if n < 1:
        words, n = [b" ".join(words)], 1
        shingle = 1
    ends = np.cumsum([len(w) + 1 for w in words])
    line = b" ".join(words)
    starts, stops = (ends[:n] - [len(w) + 1 for w in words[:n]]).tolist(), (ends[shingle - 1:] - 1).tolist()
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, CHUNK):
        hashes = np.fromiter((digest(line[a:b], HASH_SEED) for a, b in zip(starts[at:at + CHUNK], stops[at:at + CHUNK])),
                             dtype=">u8", count=min(CHUNK, n - at))
        ones += np.unpackbits(hashes.view(np.uint8)).reshape(-1, 64).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big", signed=True)


_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = [text_fingerprint(t.as_py()) for t in batch.column("text")]
        kept = [c for c in batch.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays([*map(batch.column, kept), pa.array(prints, pa.int64())],
                                         names=[*kept, "fp"])


def fingerprint_rows(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id",
                     text_col: str = "text", key_col: str | None = None) -> DataFrame:
    """(doc_id, fp) of every row, with ``key_col`` (a string) between them if given; no shuffle."""
    bounded_arrow_batches(spark)
    key = [key_col] if key_col else []
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *key) \
        .mapInArrow(_fingerprint_batches, ", ".join(["doc_id bigint", *[f"{k} string" for k in key], "fp bigint"]))


def pivot_table(prints: DataFrame) -> DataFrame:
    """Add the packed pivot distances (columns d0, d1, ... of eight each)."""
    pivots = _pivots()
    packed = []
    for k in range(0, len(pivots), 8):
        lanes = [F.shiftleft(F.bit_count(F.col("fp").bitwiseXOR(F.lit(p))).cast("bigint"), 8 * j)
                 for j, p in enumerate(pivots[k:k + 8])]
        word = lanes[0]
        for lane in lanes[1:]:
            word = word.bitwiseOR(lane)
        packed.append(word.alias(f"d{k // 8}"))
    return prints.select("fp", *packed)


def _lane(word: Column, j: int) -> Column:
    return F.shiftrightunsigned(word, 8 * j).bitwiseAND(F.lit(255).cast("bigint"))


def _complete_up_to(max_bits: int) -> None:
    if max_bits > MAX_BITS:
        raise ValueError(f"the cells find all pairs up to {MAX_BITS} bits only, not {max_bits}")


def links(table: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Linked pairs (a < b) of distinct fingerprints within ``max_bits`` (<= 2)."""
    _complete_up_to(max_bits)
    mask = F.lit((1 << BLOCK_BITS) - 1).cast("bigint")
    pairs_of_blocks = list(combinations(range(4), 2))

    def block(fp: Column, i: int) -> Column:
        return F.shiftrightunsigned(fp, BLOCK_BITS * i).bitwiseAND(mask)

    cells = F.array(*[
        F.struct(F.lit(c).alias("no"), F.shiftleft(block(F.col("fp"), i), BLOCK_BITS).bitwiseOR(
            block(F.col("fp"), j)).alias("bits")) for c, (i, j) in enumerate(pairs_of_blocks)])
    coords = [c for c in table.columns if c.startswith("d")]
    celled = table.select("fp", *coords, F.explode(cells).alias("cell")) \
        .select("fp", *coords, "cell.no", "cell.bits")
    left = celled.select(F.col("fp").alias("a"), *[F.col(c).alias(f"a_{c}") for c in coords], "no", "bits")
    right = celled.select(F.col("fp").alias("b"), *[F.col(c).alias(f"b_{c}") for c in coords],
                          F.col("no").alias("b_no"), F.col("bits").alias("b_bits"))
    diff = F.col("a").bitwiseXOR(F.col("b"))
    # no earlier cell is common: each earlier pair of blocks differs somewhere
    first = F.lit(True)
    for c, (i, j) in enumerate(pairs_of_blocks):
        both = (block(diff, i) == 0) & (block(diff, j) == 0)
        first = first & ((F.col("no") <= c) | ~both)
    near = F.lit(True)
    for c in coords:
        for j in range(8):
            near = near & (F.abs(_lane(F.col(f"a_{c}"), j) - _lane(F.col(f"b_{c}"), j)) <= max_bits)
    on = ((F.col("no") == F.col("b_no")) & (F.col("bits") == F.col("b_bits")) & (F.col("a") < F.col("b"))
          & near & (F.bit_count(diff) <= max_bits) & first)
    return left.join(right, on).select("a", "b")


def components(spark: SparkSession, edges: DataFrame, path: str) -> DataFrame:
    """(node, label): the smallest node reachable, for nodes with an edge.

    Each round every node hands the smallest label among its neighbours to
    itself and to the node it points at, then follows its pointer once. Rounds
    end when no label falls; they are written, so lost executors cost a round
    at most.
    """
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("near")) \
        .union(edges.select(F.col("b"), F.col("a")))
    both.write.parquet(f"{path}/edges")
    both = spark.read.parquet(f"{path}/edges")
    both.groupBy("node").agg(F.least(F.min("near"), F.col("node")).alias("label")) \
        .withColumn("fell", F.lit(True)).write.parquet(f"{path}/round-0")
    k = 0
    while True:
        labels = spark.read.parquet(f"{path}/round-{k}").select("node", "label")
        if not spark.read.parquet(f"{path}/round-{k}").filter("fell").head(1):
            return labels
        k += 1
        offered = both.join(labels.withColumnRenamed("node", "near"), "near") \
            .groupBy("node").agg(F.min("label").alias("offer"))
        held = labels.join(offered, "node")
        offers = held.select("node", "offer").union(held.select("label", "offer")) \
            .groupBy("node").agg(F.min("offer").alias("offer"))
        lower = labels.join(offers, "node").select("node", F.col("label").alias("was"),
                                                   F.least("label", "offer").alias("label"))
        to = lower.select(F.col("node").alias("label"), F.col("label").alias("next"))
        lower.join(to, "label", "left").select("node", F.least("label", F.coalesce("next", "label")).alias("label"), "was") \
            .select("node", "label", (F.col("label") < F.col("was")).alias("fell")) \
            .write.parquet(f"{path}/round-{k}")


def _labelled(spark: SparkSession, rows: DataFrame, first: Column, path: str, max_bits: int) -> DataFrame:
    """(fp, label, first) of every distinct fingerprint; ``first`` is an aggregate of its rows."""
    rows.groupBy("fp").agg(first.alias("first")).write.parquet(f"{path}/prints")
    prints = spark.read.parquet(f"{path}/prints")
    pivot_table(prints).write.parquet(f"{path}/pivots")
    labels = components(spark, links(spark.read.parquet(f"{path}/pivots"), max_bits), f"{path}/components")
    # fingerprints without a link are components of their own
    return prints.join(labels, prints.fp == labels.node, "left") \
        .select("fp", "first", F.coalesce("label", "fp").alias("label"))


def near_duplicates(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint, component_id of every row."""
    _complete_up_to(max_bits)
    path = work_path(spark, "simhash", fresh=True)
    fingerprint_rows(spark, docs, id_col, text_col).write.parquet(f"{path}/rows")
    rows = spark.read.parquet(f"{path}/rows")
    linked = _labelled(spark, rows, F.min("doc_id"), path, max_bits)
    first = linked.groupBy("label").agg(F.min("first").alias("component_id"))
    named = linked.join(first, "label").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                                         "component_id")


def representatives(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    max_bits: int = MAX_BITS) -> DataFrame:
    """row_key of one row of every component: the smallest id, NULL last, and of that the smallest key."""
    _complete_up_to(max_bits)
    path = work_path(spark, "simhash", fresh=True)
    keyed = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                        row_key(F.col(id_col), F.col(text_col)).alias(KEY))
    fingerprint_rows(spark, keyed, key_col=KEY).write.parquet(f"{path}/rows")
    rows = spark.read.parquet(f"{path}/rows")
    smallest = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", KEY))
    return _labelled(spark, rows, smallest, path, max_bits) \
        .groupBy("label").agg(F.min("first").alias("first")).select(f"first.{KEY}")
