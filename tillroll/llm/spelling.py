"""Spelling variant grouping with a dictionary of trie-node pairs.

Words are near when they differ by exactly one inserted, deleted or replaced
code point. Every node of the trie of all words gets a number, and every node
of the trie of all reversed words; a number stands for one prefix or suffix,
so equal pairs of numbers mean equal strings and the neighbours are exact:

* skipping position i of a word gives the pair (node of the prefix before i,
  node of the suffix after i). Two words with the same pair differ at i only;
* inserting between two positions of a word gives the pair (node of the
  prefix, node of the rest). A longer word that skips to the same pair is this
  word with one code point more. Within a run of equal code points every skip
  gives the same word, so only the first skip of a run counts here.

A pair is shared by words that differ in one code point of the alphabet and by
the one word that lacks it: at most 91 with the default letters, whatever the
number of words.

Numbering the nodes of a trie needs the words in order, not in one place. The
words are cut into ranges at splitters drawn by hash from the vocabulary, and
each range is streamed in order: a word shares the nodes of its common prefix
with the word before and gets new numbers below, taken from its range's own
block. A prefix that reaches over a cut is a prefix of the splitter there, and
the prefixes of the splitters are numbered beforehand, the same in every task.

Word counts are added up by document and batch in the task, then by word in
Spark. Words, forms and neighbours never reach the driver; the splitters do
(16 for each range of ``RANGE_WORDS`` words).

Defined results:
* NULL text has no words; a NULL id counts as the empty text in the hash;
  repeated rows count again;
* ties: the form is the near word of largest n, among those the smallest in
  code-point order;
* form, form_n are NULL where no near word has ``ratio`` times the word's n;
  root is then the word itself;
* words of any length; no words give no rows; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right
from collections import Counter

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import bounded_arrow_batches, stored
from tillroll.session import work_path

LETTERS = "A-Za-zÀ-ÿ"
MIN_CHARS, MIN_COUNT, EVERY, RATIO = 7, 2, 31, 10
RANGE_WORDS = 1 << 14
PER_RANGE = 16
#: Node numbers: 0 is the root, splitters' prefixes count down from -1, range r counts up from r << 40.
BLOCK = 40
KEYS_HELD = 1 << 18


def altered(run: str, seed: int, every: int) -> str:
    """A run with the code point deleted that its document and spelling choose; most stay as they are."""
    h = zlib.crc32(run.encode(), seed)
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def count_words(docs: DataFrame, min_chars: int = MIN_CHARS, every: int = EVERY) -> DataFrame:
    """(word, n) over all texts, before any limit on n."""
    # a run shorter than the limit stays below it when it loses a code point
    runs = re.compile(f"[{LETTERS}]{{{min_chars},}}")

    def counted(batches):
        total: Counter = Counter()

        def rows():
            return pa.RecordBatch.from_arrays(
                [pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for name, text in zip(batch.column("name").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
                seed = zlib.crc32(f"{name}:".encode())
                low = text.lower().decode("utf-8", "replace")  # bytes: only A-Z change
                for run, n in Counter(runs.findall(low)).items():
                    word = altered(run, seed, every)
                    if len(word) >= min_chars:
                        total[word] += n
            if len(total) > KEYS_HELD:
                yield rows()
                total.clear()
        yield rows()

    texts = docs.filter(F.col("text").isNotNull()).select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("name"), "text")
    return texts.mapInArrow(counted, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


class Splitters:
    """Sorted cut words, and the numbers of all their prefixes."""

    def __init__(self, words: list[str]):
        self.words = sorted(set(words))
        self.paths: list[list[int]] = []
        before, path, used = "", [0], 0
        for word in self.words:
            shared = common(before, word)
            fresh = len(word) - shared
            path = path[:shared + 1] + [-1 - used - i for i in range(fresh)]
            used += fresh
            self.paths.append(path)
            before = word

    def range_of(self, word: str) -> int:
        return bisect_right(self.words, word)

    def path(self, part: int, word: str) -> list[int]:
        """Numbers of the word's prefixes that are prefixes of a cut word: of one of the two beside its range."""
        best = [0]
        for i in (part - 1, part):
            if 0 <= i < len(self.words):
                depth = common(self.words[i], word)
                if depth >= len(best):
                    best = self.paths[i][:depth + 1]
        return best


def common(a: str, b: str) -> int:
    """Length of the common prefix."""
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def trie_paths(words: DataFrame, col: str) -> DataFrame:
    """Every word with the node numbers of its prefixes: (col, ..., path array of length + 1).

    ``words`` must be a written table with distinct ``col``.
    """
    spark = words.sparkSession
    ranges = words.count() // RANGE_WORDS + 1
    drawn = [r[0] for r in words.select(col).orderBy(F.xxhash64(col), col).limit(PER_RANGE * ranges).collect()] \
        if ranges > 1 else []
    cuts = spark.sparkContext.broadcast(Splitters(sorted(drawn)[PER_RANGE // 2::PER_RANGE]))
    others = [c for c in words.columns if c != col]
    kinds = {f.name: f.dataType.simpleString() for f in words.schema.fields}

    @F.pandas_udf("int")
    def range_of(values: pd.Series) -> pd.Series:
        return values.map(cuts.value.range_of)

    def numbered(batches):
        part, before, path, used = None, "", [0], 0
        for batch in batches:
            paths = []
            for here, word in zip(batch.column("part").to_pylist(), batch.column(col).to_pylist()):
                if here != part:
                    part, before, path, used = here, "", [0], 0
                shared = common(before, word)
                path = path[:shared + 1]
                if len(path) <= len(word):
                    outer = cuts.value.path(part, word)
                    path += outer[len(path):]
                    fresh = len(word) + 1 - len(path)
                    path += [(part << BLOCK) + used + i + 1 for i in range(fresh)]
                    used += fresh
                paths.append(path)
                before = word
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in (col, *others)],
                                              pa.array(paths, pa.list_(pa.int64()))], [col, *others, "path"])

    return (words.withColumn("part", range_of(col)).repartition(ranges, "part").sortWithinPartitions("part", col)
            .mapInArrow(numbered, ", ".join(f"{c} {kinds[c]}" for c in (col, *others)) + ", path array<bigint>"))


def vocabulary(docs: DataFrame, path: str, min_chars: int = MIN_CHARS,
               min_count: int = MIN_COUNT, every: int = EVERY) -> DataFrame:
    """(word, n, ahead, back): the words of at least ``min_count`` occurrences with both paths, as a table."""
    words = stored(count_words(docs, min_chars, every).filter(F.col("n") >= min_count), f"{path}/words")
    ahead = trie_paths(words, "word").withColumnRenamed("path", "ahead")
    back = trie_paths(words.select(F.reverse("word").alias("drow")), "drow") \
        .select(F.reverse("drow").alias("word"), F.col("path").alias("back"))
    return stored(ahead.join(back, "word"), f"{path}/vocabulary")


def pairs(words: DataFrame) -> DataFrame:
    """(id, n, p, s, skips, first) of every position that a word can skip or insert at.

    skips: False for insertions; first: the code point skipped differs from the one before.
    """
    def paired(batches):
        for batch in batches:
            row, p, s, skips, first = [], [], [], [], []
            for i, (word, ahead, back) in enumerate(zip(*[batch.column(c).to_pylist()
                                                          for c in ("word", "ahead", "back")])):
                size = len(word)
                row += [i] * (2 * size + 1)
                p += ahead[:size] + ahead
                s += back[:size][::-1] + back[::-1]
                skips += [True] * size + [False] * (size + 1)
                first += [a != b for a, b in zip(word, "\0" + word)] + [True] * (size + 1)
            at = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(at), batch.column("n").take(at), pa.array(p, pa.int64()),
                 pa.array(s, pa.int64()), pa.array(skips, pa.bool_()), pa.array(first, pa.bool_())],
                ["id", "n", "p", "s", "skips", "first"])

    return words.select("id", "n", "word", "ahead", "back").mapInArrow(
        paired, "id bigint, n bigint, p bigint, s bigint, skips boolean, first boolean")


def neighbours(words: DataFrame) -> DataFrame:
    """(id, near, near_n): every ordered pair of near words, once.

    ``words`` has id (the last node of a word's forward path), n, word, ahead, back.
    """
    both = pairs(words)
    a, b = both.filter("skips").alias("a"), both.alias("b")
    met = a.join(b, (F.col("a.p") == F.col("b.p")) & (F.col("a.s") == F.col("b.s")) &
                 (F.col("a.id") != F.col("b.id")) & (F.col("b.skips") | F.col("a.first")))
    one = F.struct(F.col("a.id").alias("id"), F.col("b.id").alias("near"), F.col("b.n").alias("near_n"))
    other = F.struct(F.col("b.id").alias("id"), F.col("a.id").alias("near"), F.col("a.n").alias("near_n"))
    # two skips meet from either side; a skip and an insertion only from the longer word's
    return met.select(F.explode(F.when(F.col("b.skips"), F.array(one)).otherwise(F.array(one, other))).alias("e")) \
        .select("e.*")


def roots(forms: DataFrame, path: str, ratio: int = RATIO) -> DataFrame:
    """(id, root): the end of each chain of forms, by pointer doubling.

    ``forms`` is a written table (id, form_id). n grows by ``ratio`` at every
    step, so a chain of bigint counts has at most log(2^63) / log(ratio) steps.
    """
    steps = 1
    while ratio ** steps < 2 ** 63 and steps < 64:
        steps += 1
    at = forms.select("id", F.col("form_id").alias("root"))
    for turn in range(max(1, (steps - 1).bit_length())):
        onward = at.select(F.col("id").alias("root"), F.col("root").alias("further"))
        jumped = at.join(onward, "root", "left")
        now = stored(jumped.select("id", F.coalesce("further", "root").alias("root"),
                                   F.col("further").isNotNull().alias("moved")), f"{path}/roots{turn}")
        at = now.drop("moved")
        if now.filter("moved").isEmpty():
            break
    return at


def variants(spark: SparkSession, docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT,
             every: int = EVERY, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the vocabulary."""
    if ratio < 2:
        raise ValueError("ratio must be at least 2: forms would run in circles")
    bounded_arrow_batches(spark)
    path = work_path(spark, "spelling", fresh=True)
    words = vocabulary(docs, path, min_chars, min_count, every)
    words = words.withColumn("id", F.element_at("ahead", -1))
    named = words.select("id", "word", "n")
    # largest n first, then the smallest word
    near = neighbours(words).join(named.select(F.col("id").alias("near"), F.col("word").alias("near_word")), "near")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near_word", "near"))
    near = near.groupBy("id").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best")).select(
        "id", "n_near", F.col("best.near").alias("near"), F.col("best.near_word").alias("near_word"),
        (-F.col("best.less")).alias("near_n"))
    formed = F.col("near_n") >= F.lit(ratio) * F.col("n")
    found = stored(named.join(near, "id", "left").select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(formed, F.col("near")).alias("form_id"), F.when(formed, F.col("near_word")).alias("form"),
        F.when(formed, F.col("near_n")).alias("form_n")), f"{path}/found")
    ends = roots(found.filter("form_id IS NOT NULL").select("id", "form_id"), path, ratio) \
        .join(named.select(F.col("id").alias("root"), F.col("word").alias("root_word")), "root").drop("root")
    return found.join(ends, "id", "left").select(
        "word", "form", F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n")
