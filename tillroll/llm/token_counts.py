"""Token counts through a digest cache.

Every text is reduced to a digest of its normalised content (runs of ASCII
white space become one space, which this tokenizer drops anyway). Digests are
joined with the stored counts of the same tokenizer version; only distinct
texts without a stored count are encoded, and their counts are appended to
the cache. A tokenizer version is the digest of the tokenizer file and the
library version, so a changed file or library never reuses old counts.

The encoder counts white-space separated pieces and keeps a bounded memo of
piece counts per worker process: pieces are independent, since the tokenizer
never joins symbols across white space. New pieces of a batch are settled
together, each once; see ``PieceCounter``.

Defined cases: NULL counts as the empty text (0 tokens); repeated rows and
repeated texts share one encoding and give one result row each; a cache that
holds a digest twice (two runs at once) counts it once; an empty table gives
no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import SPACE_CHARS, SPACE_RUN, bit_filter, bounded_arrow_batches, stored
from tillroll.session import work_path

LIMIT = 2048
MEMO_PIECES = 800_000
BLOCK_PIECES = 100_000
SPECIAL = b"<|"  # special strings are matched before lower-casing
CACHE_SCHEMA = "content_digest binary, tokenizer_digest string, n_tokens bigint"


def tokenizer_version(definition: str) -> str:
    import tokenizers
    return hashlib.sha256(f"{tokenizers.__version__}\n{definition}".encode()).hexdigest()


def content_digest(text: Column) -> Column:
    normal = F.btrim(F.regexp_replace(F.coalesce(text, F.lit("")), SPACE_RUN, " "), F.lit(SPACE_CHARS))
    return F.unhex(F.sha2(normal, 256))


# Fixed value: the rule by which the tokenizer cuts a piece before it encodes it, and
# the same rule for plain pieces: printable ASCII without capitals and the small letters
# of Latin-1, where letters are LETTERS and numbers 0-9.
CUT_RULE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
LETTERS = "a-zß-öø-ÿ"
CUT_PLAIN = rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[^\s{LETTERS}0-9]+"
PLAIN = re.compile(rf"[!-@\[-~{LETTERS}]+")


def cuts_as_known(definition: str) -> bool:
    """Whether a tokenizer leaves plain pieces as they are (composed, in lower case) and cuts them by ``CUT_RULE``."""
    d = json.loads(definition)
    norm, pre = d.get("normalizer") or {}, d.get("pre_tokenizer") or {}
    harmless = ({"type": "NFC"}, {"type": "Lowercase"},
                {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "})
    steps = pre.get("pretokenizers") or []
    return (norm.get("type") == "Sequence" and all(x in harmless for x in norm["normalizers"])
            and pre.get("type") == "Sequence" and [x["type"] for x in steps] == ["Split", "ByteLevel"]
            and steps[0]["pattern"] == {"Regex": CUT_RULE} and steps[0]["behavior"] == "Removed" and steps[0]["invert"]
            and not steps[1]["add_prefix_space"] and not steps[1]["use_regex"]
            and all(SPECIAL.decode() in x["content"] for x in d.get("added_tokens") or []))


class PieceCounter:
    """Tokens of texts as sums over their white-space separated pieces.

    Counts of pieces are kept in a memo; a batch's new pieces are settled
    together, each once. A plain piece is cut by the tokenizer's own rule and
    its parts, kept in a memo too, are given as byte-level symbols to the
    tokenizer's model: that is all the tokenizer does with such a piece.
    Every other piece, or a tokenizer with another rule, takes the whole way.
    """

    def __init__(self, definition: str):
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.memo: dict[bytes, int] = {}
        self.parts: dict[str, int] = {}
        self.cut = re.compile(CUT_PLAIN).findall if cuts_as_known(definition) else None
        self.model = self.tokenizer.model
        self.symbols = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str

    def _plain(self, piece: str) -> int:
        n, parts = 0, self.parts
        for part in self.cut(piece):
            if part not in parts:
                if len(parts) >= MEMO_PIECES:
                    parts.clear()
                symbols = part if part.isascii() else self.symbols(part)[0][0]
                parts[part] = len(self.model.tokenize(symbols))
            n += parts[part]
        return n

    def _settle(self, new: list[bytes]) -> None:
        memo, rest = self.memo, []
        for p in new:
            text = p.decode()
            if self.cut and PLAIN.fullmatch(text) and SPECIAL not in p:
                memo[p] = self._plain(text)
            else:
                rest.append((p, text))
        encoded = self.tokenizer.encode_batch_fast([text for _, text in rest], add_special_tokens=False)
        memo.update((p, len(e)) for (p, _), e in zip(rest, encoded))

    def counts(self, texts: list[bytes]) -> list[int]:
        """Token counts of UTF-8 texts."""
        out = []
        block: list[list[bytes]] = []
        held = 0
        for raw in texts:
            if SPECIAL in raw:
                pieces = raw.split()  # bytes.split() cuts at ASCII white space only
            elif raw.isascii():
                pieces = raw.lower().split()  # as the tokenizer does what is not a special string
            else:  # it composes before it lowers, and some capitals compose only when lowered first
                pieces = [p.lower() if p.isascii() else p for p in raw.split()]
            block.append(pieces)
            held += len(pieces)
            if held >= BLOCK_PIECES:
                out += self._block(block)
                block, held = [], 0
        return out + self._block(block)

    def _block(self, block: list[list[bytes]]) -> list[int]:
        memo = self.memo
        new = list(set().union(*block).difference(memo))
        self._settle(new)
        out = [sum(map(memo.__getitem__, pieces)) for pieces in block]
        if len(memo) > MEMO_PIECES:  # a full memo keeps the early, frequent pieces
            for p in new:
                del memo[p]
        return out

    def count(self, text: str) -> int:
        return self.counts([text.encode()])[0]


def _encode(shared) -> callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value  # one per worker process, so the memo outlives the task
        if "counter" not in own:
            own["counter"] = PieceCounter(own["definition"])
        counter = own["counter"]
        for batch in batches:
            counts = counter.counts([t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column("content_digest"), pa.array(counts, pa.int64())],
                                             names=["content_digest", "n_tokens"])
    return run


def _cache_exists(spark: SparkSession, path: str) -> bool:
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    return root.getFileSystem(spark._jsc.hadoopConfiguration()).exists(root)


def stored_counts(spark: SparkSession, cache_path: str, version: str) -> DataFrame:
    """content_digest, n_tokens known for this tokenizer version (one row each)."""
    if not _cache_exists(spark, cache_path):
        return spark.createDataFrame([], CACHE_SCHEMA).select("content_digest", "n_tokens")
    return (spark.read.schema(CACHE_SCHEMA).parquet(cache_path).filter(F.col("tokenizer_digest") == version)
            .groupBy("content_digest").agg(F.max("n_tokens").alias("n_tokens")))


def digests(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(content_digest, doc_id, n_bytes) of every row, written once: all later steps but the encoding read it."""
    return stored(docs.select(content_digest(F.col(text_col)).alias("content_digest"), F.col(id_col).alias("doc_id"),
                              F.octet_length(F.coalesce(F.col(text_col), F.lit(""))).cast("bigint").alias("n_bytes")),
                  work_path(spark, "token-digests", fresh=True))


def fill_cache(spark: SparkSession, docs: DataFrame, tokenizer_path: str, cache_path: str,
               id_col: str = "doc_id", text_col: str = "text", keyed: DataFrame | None = None) -> str:
    """Encode the distinct texts without a stored count; returns the version.

    ``keyed`` are the rows' digests, where they are known already.
    """
    with open(tokenizer_path, encoding="utf-8") as f:  # a few MB, sent to the executors once
        definition = f.read()
    version = tokenizer_version(definition)
    bounded_arrow_batches(spark)
    texts = docs.select(content_digest(F.col(text_col)).alias("content_digest"), F.col(id_col).alias("doc_id"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    keyed = digests(spark, docs, id_col, text_col) if keyed is None else keyed
    (_sure_misses(spark, texts, keyed.select("content_digest", "doc_id"), cache_path, version)
     .mapInArrow(_encode(spark.sparkContext.broadcast({"definition": definition})),
                 "content_digest binary, n_tokens bigint")
     .withColumn("tokenizer_digest", F.lit(version)).write.mode("append").parquet(cache_path))
    return version


def _sure_misses(spark: SparkSession, texts: DataFrame, ids: DataFrame, cache_path: str, version: str) -> DataFrame:
    """(content_digest, text): one text for every digest without a stored count.

    A digest's text is that of its smallest id. Digests and ids alone are
    shuffled to find those; two bit sets over ids, of the chosen and of all
    others, then settle nearly every document where it is read. Only a
    document that may be in both is joined, so hardly any text moves.
    """
    chosen = ids.groupBy("content_digest").agg(F.min("doc_id").alias("chosen_id"))
    if _cache_exists(spark, cache_path):
        chosen = chosen.join(stored_counts(spark, cache_path, version), "content_digest", "left_anti")
    path = work_path(spark, "token-misses", fresh=True)
    chosen.withColumn("miss", F.lit(True)).write.parquet(path)
    chosen = spark.read.parquet(path)
    others = ids.join(chosen, "content_digest", "left") \
        .filter(F.col("miss").isNull() | ~F.col("doc_id").eqNullSafe(F.col("chosen_id")))
    is_other = bit_filter(spark, others, "doc_id")("doc_id")
    is_chosen = bit_filter(spark, chosen, "chosen_id")("doc_id")
    unsure = texts.filter(is_other & is_chosen).alias("t").join(chosen.alias("c"), (
        F.col("t.content_digest") == F.col("c.content_digest"))
        & F.col("t.doc_id").eqNullSafe(F.col("c.chosen_id")), "left_semi")
    return texts.filter(~is_other).select("content_digest", "text").unionByName(
        unsure.select("content_digest", "text"))


def count_tokens(spark: SparkSession, docs: DataFrame, tokenizer_path: str, cache_path: str,
                 id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row."""
    keyed = digests(spark, docs, id_col, text_col)
    version = fill_cache(spark, docs, tokenizer_path, cache_path, id_col, text_col, keyed)
    return keyed.join(stored_counts(spark, cache_path, version), "content_digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
