"""Mixing sources to target weights by subset-sum budget fitting.

Sizes are word counts. Sources, in code-point order with NULL last, weigh 5,
2, 1, repeating, and share 150 % of all words; a target stops at twice its
source's size and the excess is shared anew by weight (water filling, one
window over one row per source).

A source's target is some whole passes over its documents plus a rest. The
rest is fitted on the histogram of exact lengths (one row per length, counted
in Spark): every length gives its proportional part, rounded down, or up by
one document in a seeded order. A bounded-knapsack dynamic program decides the
last of these roundings, so that the budget is met. Documents of a length are
then picked by seeded hash; ranks are taken inside hash buckets, so a hot
source or length is never one group.

Defined cases: NULL or blank text has size 0 and is never taken in words; a
source of size 0 has target 0; repeated rows are documents of their own (their
picks may swap, the totals do not); an empty table gives no rows; other
columns are not read (``carry`` keeps them untouched in a struct).
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillroll.llm.common import words

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
SEED = 20260101
BUCKET_BITS = 10
# The dynamic program decides the roundings of the last words, less than this many; the
# earlier ones follow the same seeded order without it.
DP_WORDS = 1 << 16


def source_targets(sizes: DataFrame) -> DataFrame:
    """(key, source_size) -> key, source_size, target; one row per source."""
    by_name = Window.orderBy(F.col("key").startswith("null"), "key")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]),
                          ((F.row_number().over(by_name) - 1) % len(WEIGHTS) + 1).cast("int"))
    cap = F.col("source_size") * float(MOST)
    everything = Window.partitionBy(F.lit(0))
    ascending = Window.orderBy(cap / F.col("weight"), "key")
    before = ascending.rowsBetween(Window.unboundedPreceding, -1)
    after = ascending.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = ((F.sum("source_size").over(everything) * SHARE - F.coalesce(F.sum(cap).over(before), F.lit(0.0)))
             / F.sum("weight").over(after))
    # the water level is that of the first source, in this order, that stays below its cap
    below = F.when(F.col("candidate") <= cap / F.col("weight"),
                   F.struct((cap / F.col("weight")).alias("full"), "key", "candidate"))
    return (sizes.withColumn("weight", weight).withColumn("candidate", level)
            .withColumn("level", F.min(below).over(everything)["candidate"])
            .select("key", "source_size",
                    F.least(cap, F.coalesce("level", F.lit(float("inf"))) * F.col("weight")).alias("target")))


def fit_budget(lengths: np.ndarray, counts: np.ndarray, budget: int, seed: int = SEED) -> np.ndarray:
    """How many documents of each length to take so that the words near ``budget``.

    Every length gets its proportional part, rounded down, then up by one
    document in a seeded order that favours large fractions (Pareto sampling:
    the chance of a length is about its fraction). The knapsack decides the
    last roundings in the same order, where they have to meet the budget.
    """
    take, rest = np.zeros_like(counts), max(0, budget)
    draw = np.random.default_rng(seed).random(len(lengths))
    while True:
        left = np.where(lengths <= rest, counts - take, 0)  # a document longer than the rest never fits
        total = int((lengths * left).sum())
        if total <= rest:
            return take + left
        parts = [divmod(int(n) * rest, total) for n in left]
        down = np.array([whole for whole, _ in parts], dtype=np.int64)
        part = np.array([over / total for _, over in parts])
        take = take + down
        rest -= int((down * lengths).sum())
        with np.errstate(divide="ignore"):
            order = np.argsort(np.where(part > 0, draw / (1 - draw) * (1 - part) / part, np.inf), kind="stable")
        for k, i in enumerate(order):
            if rest < DP_WORDS:
                return take + _knapsack(lengths, counts - take, rest, np.roll(order, -k))
            if part[i] > 0 and lengths[i] <= rest:
                take[i] += 1
                rest -= int(lengths[i])


def _knapsack(lengths: np.ndarray, counts: np.ndarray, budget: int, order: np.ndarray | None = None) -> np.ndarray:
    """Bounded knapsack over reachable sums, kept as the bits of one integer.

    One document of every length is tried in ``order`` before any length gets more.
    """
    reach, history = 1, []
    mask = (1 << (budget + 1)) - 1
    order = np.argsort(lengths) if order is None else order
    fits = [(i, int(lengths[i]), min(int(counts[i]), budget // int(lengths[i]))) for i in order]
    for i, length, left in [(i, w, 1) for i, w, n in fits if n > 0] + [(i, w, n - 1) for i, w, n in fits if n > 1]:
        if reach >> budget & 1:
            break
        earlier, part = reach, 1
        while left > 0:
            step = min(part, left)
            reach |= (reach << (length * step)) & mask
            left -= step
            part *= 2
        if reach != earlier:
            history.append((i, length, earlier))
    extra = np.zeros_like(counts)
    at = reach.bit_length() - 1  # the largest reachable sum within the budget
    for i, length, earlier in reversed(history):
        while not earlier >> at & 1:
            at -= length
            extra[i] += 1
    return extra


def _fit_source(seed: int):
    def fit(hist: pd.DataFrame) -> pd.DataFrame:
        hist = hist.sort_values("size", ignore_index=True)
        take = fit_budget(hist["size"].to_numpy(np.int64), hist["n"].to_numpy(np.int64), int(hist["rest"].iloc[0]),
                          zlib.crc32(hist["key"].iloc[0].encode(), seed & 0xFFFFFFFF))
        return pd.DataFrame({"key": hist["key"], "size": hist["size"], "extra": take})
    return fit


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        seed: int = SEED, carry: bool = False) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies of every row.

    With ``carry`` a struct ``row`` holds all columns of ``docs`` as they were.
    """
    kept = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if carry else []
    picked = F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col))
    recs = docs.select(
        F.col(id_col).alias("doc_id"), F.size(words(F.col(text_col))).cast("bigint").alias("size"),
        F.when(F.col(source_col).isNull(), "null").otherwise(F.concat(F.lit("is "), F.col(source_col))).alias("key"),
        picked.alias("pick"), F.shiftrightunsigned(picked, 64 - BUCKET_BITS).alias("bucket"), *kept)
    buckets = recs.groupBy("key", "size", "bucket").agg(F.count(F.lit(1)).alias("n"))
    hist = buckets.groupBy("key", "size").agg(F.sum("n").alias("n"))
    targets = source_targets(hist.groupBy("key").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")))
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = targets.withColumn("passes", passes.cast("bigint")).withColumn(
        "rest", F.round(F.col("target") - F.col("passes") * F.col("source_size")).cast("bigint"))
    extras = hist.filter("size > 0").join(targets.select("key", "rest"), "key") \
        .groupBy("key").applyInPandas(_fit_source(seed), "key string, size bigint, extra bigint")
    earlier = Window.partitionBy("key", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    plan = (buckets.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
            .join(extras, ["key", "size"], "left").join(targets, "key")
            .select("key", "size", "bucket", "before", "extra", "passes", "target", "source_size"))
    rank = F.row_number().over(Window.partitionBy("key", "size", "bucket").orderBy("pick", "doc_id"))
    copies = F.col("passes") + F.when(F.col("before") + F.col("rank") <= F.coalesce("extra", F.lit(0)), 1).otherwise(0)
    return (recs.withColumn("rank", rank).join(plan, ["key", "size", "bucket"])
            .select("doc_id", "size", "source_size", "target", (copies * F.col("size")).cast("bigint").alias("taken"),
                    copies.cast("int").alias("copies"), *(["row"] if carry else [])))
