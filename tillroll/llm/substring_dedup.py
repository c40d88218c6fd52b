"""Substring dedup with sharded repeated-phrase automata.

A word goes if a 13-word window that covers it also starts in a document with
a smaller id. The work has three parts.

Recurring passages. The least hash of the nine 5-word grams in a window is its
anchor; equal windows have equal anchors, and a text has about one anchor per
five words. Anchors met in two documents are kept in a fixed-size bit set.
Only windows with such an anchor are hashed and shuffled, to find the smallest
document (owner) of each window; every document is then linked with the
owners of its windows.

Automata. Linked documents are dealt to shards of bounded text, near the owner
that they share most with. A shard also gets the texts of the owners that its
documents are linked with, each once. It keeps the owners' windows that its
documents hold too, once each (smallest owner first), joins consecutive ones
into passages, and compiles an Aho-Corasick automaton over the 7-word grams at
every seventh place of a passage: any 13 words of a passage hold one of them.

Locating. Every linked document streams through its shard's automaton. Each
hit is extended word by word along the passage, so matches are exact; runs of
13 or more words whose owner has a smaller id are removed. A document without
a link has nothing to remove and is finished where it is read.

Hashes are 64 bits wide: a chance collision can only hide an owner, with odds
of about n^2 / 2^65 for n windows that share an anchor with another document.

Defined cases: NULL text counts as empty; texts of fewer than 13 words lose
nothing; repeated rows and equal ids do not remove each other (only a smaller
id does); rows with a NULL id neither lose words nor remove any; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import bit_filter, bit_set, bounded_arrow_batches, in_bit_set, release_shuffles, stored
from tillroll.session import work_path

WINDOW = 13
ANCHOR = 5
SEED = 7  # 2 * SEED - 1 = WINDOW: every window of a passage holds a whole seed
SHARD_BYTES = 4 << 20
BLOCK_WORDS = 50_000
RESULT = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"


def text_words(text: str | None) -> list[bytes]:
    return (text or "").encode().split()  # bytes.split() cuts at ASCII white space only


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hash of every word. A memo of words would cost more than it saves: a corpus has too many."""
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def local_hashes(words: list[bytes]) -> np.ndarray:
    """The same for use inside one task: the interpreter's own hash, which no other process can repeat."""
    return np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)


def rolled(hashes: np.ndarray, width: int) -> np.ndarray:
    """Mixed 64-bit hash of every run of ``width`` values."""
    n = len(hashes) - width + 1
    out = np.zeros(n, np.uint64)
    for j in range(width):
        out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[j:j + n]
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    return out ^ (out >> np.uint64(32))


def anchors(hashes: np.ndarray) -> np.ndarray:
    """Anchor of every window: the least of nine gram hashes, by doubling the span twice and once more."""
    out, span = rolled(hashes, ANCHOR), 1
    while 2 * span <= WINDOW - ANCHOR + 1:
        out, span = np.minimum(out[:-span], out[span:]), 2 * span
    rest = WINDOW - ANCHOR + 1 - span
    return np.minimum(out[:len(out) - rest], out[rest:])


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]


def _mine(pick) -> callable:
    """Rows (key, doc_id): the keys that ``pick`` takes from the word hashes of many texts in a row.

    ``pick`` gets the hashes of a block of texts end to end and returns a key
    and a mark for every place that a window can start at; windows that reach
    over a text's end are left out here. Repeats in a row are handed on once.
    """
    def block(words: list[bytes], ids: list[int], sizes: list[int]) -> pa.RecordBatch:
        keys, good = pick(word_hashes(words))
        ends = np.cumsum(sizes)
        owner = np.repeat(np.arange(len(ids)), sizes)[:len(keys)]
        good &= np.arange(len(keys)) + WINDOW <= ends[owner]
        good[1:] &= ~(good[:-1] & (keys[1:] == keys[:-1]) & (owner[1:] == owner[:-1]))
        return pa.RecordBatch.from_arrays([pa.array(keys[good].view(np.int64)),
                                           pa.array(np.array(ids, np.int64)[owner[good]])], names=["key", "doc_id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, ids, sizes = [], [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), _texts(batch)):
                own = text.split()
                if doc_id is not None and len(own) >= WINDOW:
                    words += own
                    ids.append(doc_id)
                    sizes.append(len(own))
                    if len(words) >= BLOCK_WORDS:
                        yield block(words, ids, sizes)
                        words, ids, sizes = [], [], []
            if ids:
                yield block(words, ids, sizes)
    return run


def _all_anchors(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = anchors(hashes)
    return keys, np.ones(len(keys), bool)


def _windows_with(bits) -> callable:
    def pick(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return rolled(hashes, WINDOW), in_bit_set(bits.value, anchors(hashes).view(np.int64))
    return pick


def finished(doc_id, words: list[bytes], gone: np.ndarray | None) -> tuple:
    kept = words if gone is None else [w for w, g in zip(words, gone) if not g]
    return doc_id, len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()


def _untouched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [finished(i, t.split(), None) for i, t in zip(batch.column("doc_id").to_pylist(), _texts(batch))]
        yield pa.RecordBatch.from_pandas(_frame(rows), preserve_index=False)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=["doc_id", "n_words", "n_removed", "kept_sha256"])
    return out.astype({"doc_id": "Int64", "n_words": "int64", "n_removed": "int64", "kept_sha256": "object"})


class PhraseAutomaton:
    """Aho-Corasick automaton over the passages that a shard's owners share with its documents.

    ``wanted`` are the sorted window hashes (of this process) of the shard's documents. Each is
    kept once, for its smallest owner; runs of kept windows are the passages.
    """

    def __init__(self, owners: list[tuple[int, str]], wanted: np.ndarray):
        self.numbers: dict[bytes, int] = {}
        self.passages: list[tuple[int, list[int]]] = []
        taken = np.zeros(len(wanted), bool)
        seeds: dict[tuple, list[tuple[int, int]]] = {}
        for owner, text in sorted(owners, key=lambda o: o[0]):
            words = text_words(text)
            if len(words) < WINDOW or not len(wanted):
                continue
            windows = rolled(local_hashes(words), WINDOW)
            at = np.minimum(np.searchsorted(wanted, windows), len(wanted) - 1)
            places = np.flatnonzero(wanted[at] == windows)
            which, first = np.unique(at[places], return_index=True)
            own = np.sort(places[first[~taken[which]]])
            taken[which] = True
            if not len(own):
                continue
            for run in np.split(own, np.flatnonzero(np.diff(own) != 1) + 1):
                passage = [self.numbers.setdefault(w, len(self.numbers))
                           for w in words[run[0]:run[-1] + WINDOW]]
                for q in range(0, len(passage) - SEED + 1, SEED):
                    seeds.setdefault(tuple(passage[q:q + SEED]), []).append((len(self.passages), q))
                self.passages.append((owner, passage))
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for seed, found in seeds.items():
            self.automaton.add_word(seed, found)
        if seeds:
            self.automaton.make_automaton()
        self.empty = not seeds

    def covered(self, doc_id: int, words: list[bytes]) -> np.ndarray | None:
        """Words inside windows of owners with a smaller id; None if there are none."""
        if self.empty or len(words) < WINDOW:
            return None
        unknown = len(self.numbers)
        doc = [self.numbers.get(w, unknown) for w in words]
        gone, reached, any_gone = np.zeros(len(doc), bool), {}, False
        for last, places in self.automaton.iter(tuple(doc)):
            first = last - SEED + 1
            for number, q in places:
                owner, passage = self.passages[number]
                diagonal = (number, first - q)
                if owner >= doc_id or reached.get(diagonal, -1) > last:
                    continue
                a, b = first, q
                while a > 0 and b > 0 and doc[a - 1] == passage[b - 1]:
                    a, b = a - 1, b - 1
                end, p = last + 1, q + SEED
                while end < len(doc) and p < len(passage) and doc[end] == passage[p]:
                    end, p = end + 1, p + 1
                reached[diagonal] = end
                if end - a >= WINDOW:
                    gone[a:end] = any_gone = True
        return gone if any_gone else None


def _stream(docs: pd.DataFrame, owners: pd.DataFrame) -> pd.DataFrame:
    """One shard: compile its automaton and stream its documents."""
    windows = [np.zeros(0, np.uint64)]
    for text in docs["text"]:
        words = text_words(text)
        if len(words) >= WINDOW:
            windows.append(rolled(local_hashes(words), WINDOW))
    automaton = PhraseAutomaton(list(zip(owners["owner"].tolist(), owners["owner_text"].tolist())),
                                np.unique(np.concatenate(windows)))
    rows = []
    for doc_id, text in zip(docs["doc_id"].tolist(), docs["text"].tolist()):
        words = text_words(text)
        rows.append(finished(doc_id, words, automaton.covered(doc_id, words)))
    return _frame(rows)


def dealt_to_shards(links: DataFrame, shard_docs: int) -> DataFrame:
    """(doc_id, shard): documents go where the owner they share most with goes.

    So an owner's text travels to few shards. The documents of one owner are
    split over several shards once they are more than a shard should hold.
    """
    most = links.groupBy("doc_id").agg(F.max(F.struct("n", (-F.col("owner")).alias("o"))).alias("most")) \
        .select("doc_id", (-F.col("most.o")).alias("owner"))
    family = most.groupBy("owner").agg(F.ceil(F.count(F.lit(1)) / F.lit(shard_docs)).alias("parts"))
    n_shards = max(1, -(-links.select("doc_id").distinct().count() // shard_docs))
    return most.join(family, "owner").select("doc_id", F.pmod(F.xxhash64(
        "owner", F.pmod(F.xxhash64("doc_id"), F.col("parts"))), F.lit(n_shards)).alias("shard"))


def remove_repeats(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row."""
    bounded_arrow_batches(spark)
    path = work_path(spark, "substring-dedup", fresh=True)
    context = spark.sparkContext
    base = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    total = base.agg(F.sum(F.octet_length("text")).alias("bytes"), F.count(F.lit(1)).alias("n")).first()
    shard_docs = max(1, SHARD_BYTES * total["n"] // max(1, total["bytes"] or 0))
    pair = "key bigint, doc_id bigint"

    # anchors that occur in two documents
    shared = base.mapInArrow(_mine(_all_anchors), pair).groupBy("key") \
        .agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).filter("low < high")
    bits = context.broadcast(bit_set(shared, "key"))
    release_shuffles(spark)

    # windows with such an anchor that occur in two documents, with their owner
    # the windows are written: owners and links are both drawn from them
    windows = stored(base.mapInArrow(_mine(_windows_with(bits)), pair), f"{path}/windows")
    windows.groupBy("key").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("high")) \
        .filter("owner < high").select("key", "owner").write.parquet(f"{path}/owners")
    release_shuffles(spark)

    # links of documents with the owners of their windows
    owners = spark.read.parquet(f"{path}/owners")
    windows.join(owners, "key").filter("doc_id > owner").groupBy("doc_id", "owner") \
        .agg(F.count(F.lit(1)).alias("n")).write.parquet(f"{path}/links")
    release_shuffles(spark)
    links = spark.read.parquet(f"{path}/links")
    dealt_to_shards(links, shard_docs).write.parquet(f"{path}/shards")
    shards = spark.read.parquet(f"{path}/shards")

    # the bit sets keep unlinked texts out of the shuffles; what slips through does no harm
    linked = F.col("doc_id").isNotNull() & bit_filter(spark, links, "doc_id")("doc_id")
    wanted = links.join(shards, "doc_id").select("shard", "owner").distinct()
    sources = base.filter(bit_filter(spark, links, "owner")("doc_id")) \
        .select(F.col("doc_id").alias("owner"), F.col("text").alias("owner_text")).join(wanted, "owner")
    streamed = base.filter(linked).join(shards, "doc_id", "left") \
        .withColumn("shard", F.coalesce("shard", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)))) \
        .groupBy("shard").cogroup(sources.groupBy("shard")).applyInPandas(_stream, RESULT)
    return base.filter(~linked).mapInArrow(_untouched, RESULT).unionByName(streamed)
