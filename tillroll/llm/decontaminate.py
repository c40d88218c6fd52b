"""Benchmark decontamination with a broadcast set of normalised n-grams.

Texts are lower-cased (A-Z) and cut into words. A window is 13 consecutive
item words; an item of 1 to 12 words is one window. Every document word inside
an occurrence of a window is hit.

One pass over the documents: any occurrence of an m-word window covers a
(m - s + 1)-gram that starts at a document position divisible by the stride
s = m // 2, so only every s-th position is looked up in the broadcast set of
the windows' grams (hashes). A hit names a few words around it; the windows
that can start there are looked up by hash and verified word by word. Nothing
but those verified hits and one row per document is shuffled.

Defined cases: NULL or wordless texts have no words and are clean; items
without words have no window; repeated document rows give equal result rows;
repeated items hit together; an empty benchmark hits nothing; other columns
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import let

WINDOW = 13
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# The n-gram set is broadcast only while the benchmark's text is below this;
# a larger benchmark is joined by shuffle on the same keys, without the texts.
BROADCAST_MAX_BYTES = 64 << 20


def item_words(text: Column) -> Column:
    """Lower-cased (A-Z only) words; NULL: none."""
    t = F.coalesce(text, F.lit(""))
    # lower() equals the A-Z rule on pure ASCII text and is much faster
    low = F.when(F.octet_length(t) == F.length(t), F.lower(t)).otherwise(
        F.translate(t, UPPER, LOWER))
    return F.filter(F.split(low, NOT_WORD), lambda w: w != "")


def text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _stride(m: int) -> int:
    return max(1, m // 2)


def windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text",
            width: int = WINDOW) -> DataFrame:
    """(item_id, m, win, win_hash): the distinct windows of every item."""
    items = benchmark.select(F.col(id_col).cast("string").alias("item_id"),
                             item_words(F.col(text_col)).alias("words"))
    n = F.size("words")
    m = F.least(n, F.lit(width))
    return (items.filter(n > 0)
            .select("item_id", m.alias("m"),
                    F.explode(F.transform(F.sequence(F.lit(1), n - m + 1),
                                          lambda i: F.slice("words", i, m))).alias("win"))
            .distinct()
            .withColumn("win_hash", F.xxhash64("m", "win")))


def _grams(wins: DataFrame, lengths: list[int]) -> DataFrame:
    """Distinct hashes of all grams that the probes of each window length use."""
    def of_length(k: int) -> Column:
        g = k - _stride(k) + 1
        return F.when(F.col("m") == k, F.transform(
            F.sequence(F.lit(1), F.lit(k - g + 1)), lambda i: F.xxhash64(F.lit(k), F.slice("win", i, g))))

    return wins.select(F.explode(F.coalesce(*map(of_length, lengths))).alias("gram")).distinct()


def _probes(words: Column, lengths: list[int]) -> Column:
    """(p, m, gram) looked up for a document, with one (0, 0, NULL) row for itself."""
    kind = "array<struct<p:int,m:int,gram:bigint>>"
    n = F.size(words)

    def of_length(m: int) -> Column:
        s = _stride(m)
        g = m - s + 1
        probes = F.transform(F.sequence(F.lit(1), n - g + 1, F.lit(s)), lambda p: F.struct(
            p.alias("p"), F.lit(m).alias("m"), F.xxhash64(F.lit(m), F.slice(words, p, g)).alias("gram")))
        return F.when(n >= m, probes.cast(kind)).otherwise(F.array().cast(kind))

    itself = F.array(F.struct(F.lit(0).alias("p"), F.lit(0).alias("m"),
                              F.lit(None).cast("bigint").alias("gram"))).cast(kind)
    return F.concat(itself, *map(of_length, lengths))


def _starts(p: Column, m: Column, n: Column) -> Column:
    """The places at which an m-word window may start that covers the probe at p."""
    stride = F.greatest(F.lit(1), F.floor(m / 2).cast("int"))
    return F.sequence(F.greatest(F.lit(1), p - stride + 1), F.least(p, n - m + 1))


def _places_by_broadcast(base: DataFrame, grams: DataFrame, lengths: list[int]) -> DataFrame:
    """(doc_id, text_key, n, m, start, doc_win) where windows may start; start NULL: the row itself."""
    looked = base.select("doc_id", "text_key", "words", "n", F.explode(_probes(F.col("words"), lengths)).alias("q")) \
        .select("doc_id", "text_key", "words", "n", "q.p", "q.m", "q.gram")
    found = looked.join(F.broadcast(grams.withColumn("known", F.lit(True))), "gram", "left") \
        .filter(F.col("known") | (F.col("p") == 0))
    starts = F.when(F.col("p") > 0, _starts(F.col("p"), F.col("m"), F.col("n")))
    return found.select("doc_id", "text_key", "words", "n", "m", F.explode_outer(starts).alias("start")) \
        .select("doc_id", "text_key", "n", "m", "start",
                F.slice("words", F.coalesce("start", F.lit(1)), F.col("m")).alias("doc_win"))


def _places_by_shuffle(base: DataFrame, grams: DataFrame, lengths: list[int]) -> DataFrame:
    """As ``_places_by_broadcast`` for a set of grams of any size.

    A probe row carries its document's key, not its words; the words meet the
    probes that were found once a document, so the shuffle is linear in the text.
    """
    probes = base.select("doc_id", "text_key", F.explode(_probes(F.col("words"), lengths)).alias("q")) \
        .select("doc_id", "text_key", "q.p", "q.m", "q.gram").filter("p > 0")
    found = probes.join(grams, "gram", "left_semi").groupBy("doc_id", "text_key") \
        .agg(F.collect_set(F.struct("p", "m")).alias("probes"))
    f = found.select(F.col("doc_id").alias("f_id"), F.col("text_key").alias("f_key"), "probes")
    place = "array<struct<m:int,start:int,doc_win:array<string>>>"
    itself = F.array(F.struct(F.lit(0).alias("m"), F.lit(None).cast("int").alias("start"),
                              F.array().cast("array<string>").alias("doc_win"))).cast(place)
    at = F.flatten(F.transform("probes", lambda q: F.transform(
        _starts(q["p"], q["m"], F.col("n")),
        lambda s: F.struct(q["m"].alias("m"), s.alias("start"), F.slice("words", s, q["m"]).alias("doc_win")))))
    return base.join(f, F.col("doc_id").eqNullSafe(F.col("f_id")) & (F.col("text_key") == F.col("f_key")), "left") \
        .select("doc_id", "text_key", "n", F.explode(F.concat(
            itself, F.coalesce(at.cast(place), F.array().cast(place)))).alias("at")) \
        .select("doc_id", "text_key", "n", "at.*")


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", width: int = WINDOW, keyed: bool = False) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, hit_spans.

    With ``keyed`` also ``text_key``, which tells texts of one id (or without one) apart.
    ``hit_spans`` lists the merged hit word ranges as (first, end) from word 0.
    """
    wins = windows(benchmark, width=width)
    lengths = sorted(r["m"] for r in wins.select("m").distinct().collect())  # at most ``width`` rows
    size = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    small = size <= BROADCAST_MAX_BYTES

    base = docs.select(F.col(id_col).alias("doc_id"), text_key(F.col(text_col)).alias("text_key"),
                       item_words(F.col(text_col)).alias("words")).withColumn("n", F.size("words"))
    if lengths:
        find = _places_by_broadcast if small else _places_by_shuffle
        places = find(base, _grams(wins, lengths), lengths).withColumn(
            "win_hash", F.when(F.col("start").isNotNull(), F.xxhash64("m", "doc_win")))
        known = wins.select("item_id", "win", "win_hash")
        hits = places.join(F.broadcast(known) if small else known, "win_hash", "left") \
            .withColumn("hit", F.col("doc_win") == F.col("win")) \
            .filter(F.col("start").isNull() | F.col("hit"))
    else:
        hits = base.select("doc_id", "text_key", "n", F.lit(0).alias("m"), F.lit(None).cast("int").alias("start"),
                           F.lit(None).cast("string").alias("item_id"))
    whole = F.when(F.col("start").isNotNull(), F.struct("start", "m"))
    per_doc = hits.groupBy("doc_id", "text_key").agg(
        F.max("n").alias("n"), F.sum(F.when(F.col("start").isNull(), 1).otherwise(0)).alias("copies"),
        F.array_sort(F.collect_set(whole)).alias("spots"),
        F.array_sort(F.collect_set("item_id")).alias("items"))
    key = ["text_key"] if keyed else []
    return per_doc.withColumn("hit_spans", _merged(F.col("spots"))).select(
        "doc_id", *key, F.col("n").cast("bigint").alias("n_words"),
        F.aggregate("hit_spans", F.lit(0).cast("bigint"), lambda a, s: a + s["end"] - s["first"]).alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "hit_spans", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))).alias("copy"),
    ).select("doc_id", *key, "n_words", "n_hit", "n_items", "items_sha256",
             ((F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words"))).alias("contaminated"),
             "hit_spans")


def _merged(spots: Column) -> Column:
    """Union of sorted (start from 1, length) spots as (first, end) from 0.

    The fold keeps finished ranges and the open one apart, so each step
    appends at most one range.
    """
    kind = "array<struct<first:int,end:int>>"
    zero = F.struct(F.array().cast(kind).alias("done"), F.lit(-1).alias("a"), F.lit(-1).alias("b"))

    def step(acc: Column, s: Column) -> Column:
        first, end = s["start"] - 1, s["start"] - 1 + s["m"]
        joins = (first <= acc["b"]) & (acc["b"] >= 0)
        closed = F.when(joins | (acc["b"] < 0), acc["done"]).otherwise(
            F.concat(acc["done"], F.array(F.struct(acc["a"].alias("first"), acc["b"].alias("end")))))
        return F.struct(closed.cast(kind).alias("done"), F.when(joins, acc["a"]).otherwise(first).alias("a"),
                        F.when(joins, F.greatest(acc["b"], end)).otherwise(end).alias("b"))

    def finish(acc: Column) -> Column:
        return F.when(acc["b"] < 0, acc["done"]).otherwise(F.concat(
            acc["done"], F.array(F.struct(acc["a"].alias("first"), acc["b"].alias("end"))))).cast(kind)

    return F.aggregate(spots, zero, step, finish)


def without_spans(text: Column, spans: Column) -> Column:
    """The normalised words outside ``spans``, joined by one space (span removal)."""
    return let(item_words(text), lambda w: F.array_join(F.filter(
        w, lambda _, i: ~F.exists(spans, lambda s: (i >= s["first"]) & (i < s["end"]))), " "))
