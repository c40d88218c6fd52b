"""Line dedup by range-partitioned line hashes, streamed in document order.

A line's key is the line without ASCII white space at its ends and with A-Z in
lower case. A key of at least ``min_chars`` code points that is found in at
least ``min_docs`` documents loses all its lines but those of the largest
doc_id that holds it.

1. Every long line becomes (key digest, document, position), written once.
2. These rows are range-partitioned by digest, then document (largest first),
   then position, and sorted so inside a partition. A range may end in the
   middle of a digest, so a line that half of all documents share is dealt
   over as many partitions as its rows fill.
3. Each partition is streamed once. The first document of a digest owns it;
   later documents' lines are held until the digest has ``min_docs`` documents
   (so at most ``min_docs - 2`` documents' positions are held), then dropped as
   they come. Digests that a partition shares with a neighbour, at most its
   first and last, leave their rows open and hand on their first ``min_docs``
   documents; these few rows, joined over the partitions, settle the open ones.
4. Dropped positions are gathered by document into a compressed keep bitmap.

What is returned are the bitmaps, not the text; ``kept_text`` applies them.

Defined results:
* NULL and empty text are one empty line, which is kept;
* rows of one doc_id count as one document, each row has its own bitmap; rows
  without an id are together one document, smaller than any other; identical
  rows share one bitmap;
* equal digests (128 bits of BLAKE2b) are taken as equal keys;
* a document without dropped lines has no bitmap row;
* an empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.joins import bounded_broadcast
from tillroll.llm.common import bounded_arrow_batches, stored
from tillroll.session import work_path

MIN_CHARS, MIN_DOCS = 40, 5
# what a row of the streamed pass says
DROPPED, OPEN, SEEN = 0, 1, 2
CONTINUATION = bytes(range(0x80, 0xC0))


def line_key(line: bytes) -> bytes:
    """UTF-8 key of a UTF-8 line: both rules concern ASCII bytes alone."""
    return line.strip(b" \t\n\x0b\x0c\r").lower()


def code_points(key: bytes) -> int:
    return len(key) if key.isascii() else len(key.translate(None, CONTINUATION))


def _keyed(docs: DataFrame) -> DataFrame:
    """(k1, k2: a row's key, doc_id, text)."""
    return docs.select(*[F.xxhash64(F.lit(i), "doc_id", "text").alias(f"k{i}") for i in (1, 2)], "doc_id",
                       F.coalesce("text", F.lit("")).alias("text"))


def long_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(k1, k2, doc_id, n_lines, pos, h1, h2) of every line whose key is long enough."""
    keyed = _keyed(docs)
    kinds = {f.name: f.dataType.simpleString() for f in keyed.schema.fields}
    schema = f"k1 bigint, k2 bigint, doc_id {kinds['doc_id']}, n_lines int, pos int, h1 bigint, h2 bigint"

    def hashed(batches):
        for batch in batches:
            row, count, pos, digests = [], [], [], []
            for i, text in enumerate(batch.column("text").cast(pa.binary()).to_pylist()):
                lines = text.split(b"\n")
                for p, line in enumerate(lines):
                    if len(line) >= min_chars and code_points(key := line_key(line)) >= min_chars:
                        row.append(i)
                        count.append(len(lines))
                        pos.append(p)
                        digests.append(hashlib.blake2b(key, digest_size=16).digest())
            at = pa.array(row, pa.int64())
            pair = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c).take(at) for c in ("k1", "k2", "doc_id")], pa.array(count, pa.int32()),
                 pa.array(pos, pa.int32()), pa.array(pair[:, 0]), pa.array(pair[:, 1])],
                ["k1", "k2", "doc_id", "n_lines", "pos", "h1", "h2"])

    return keyed.mapInArrow(hashed, schema)


class _Run:
    """The rows of one digest, as far as they have been streamed."""

    def __init__(self, digest, doc, first: bool):
        self.digest, self.first = digest, first  # first: of its partition, so it may have begun earlier
        self.docs = [doc]  # the first min_docs of them
        self.last = doc
        self.held: list = []


def first_occurrences(batches, min_docs: int, columns: list[str]):
    """Stream sorted rows; yield (what, row) as described above. One partition's rows."""
    run = None
    for batch in batches:
        out: list = []
        for row in zip(*[batch.column(c).to_pylist() for c in columns]):
            doc, digest = row[2], row[5:]
            if run is None or digest != run.digest:
                if run is not None and run.first:
                    out += _seen(run)
                run = _Run(digest, doc, first=run is None)
            elif doc != run.last:
                run.last = doc
                if len(run.docs) < min_docs:
                    run.docs.append(doc)
            if run.first:
                out.append((OPEN, row))
            elif len(run.docs) >= min_docs:
                out += [(DROPPED, held) for held in run.held]
                run.held = []
                out.append((DROPPED, row))
            elif doc != run.docs[0]:
                run.held.append(row)
        yield out
    if run is not None:  # the last digest may go on in the next partition
        yield [(OPEN, held) for held in run.held] + _seen(run)


def _seen(run: _Run) -> list:
    return [(SEEN, (None, None, doc, None, None, *run.digest)) for doc in run.docs]


def keep_bitmaps(spark: SparkSession, docs: DataFrame, min_chars: int = MIN_CHARS,
                 min_docs: int = MIN_DOCS) -> DataFrame:
    """(k1, k2, doc_id, n_lines, n_dropped, keep) of every document that loses lines.

    ``keep`` holds one bit a line, 1 for kept, most significant bit first,
    zlib-compressed. k1 and k2 are the row's key (see ``kept_text``).
    """
    if min_docs < 2:
        raise ValueError("min_docs must be at least 2: a line of one document is no repeat")
    bounded_arrow_batches(spark, rows=4096)
    path = work_path(spark, "line-dedup", fresh=True)
    # written, as the range partitioner reads its input twice
    lines = stored(long_lines(docs, min_chars), f"{path}/lines")
    order = [F.col("h1"), F.col("h2"), F.col("doc_id").desc_nulls_last(), F.col("pos"), F.col("k1"), F.col("k2")]
    columns = lines.columns
    kinds = [f.dataType.simpleString() for f in lines.schema.fields]

    def streamed(batches):
        types = None

        def seen_types(source):
            nonlocal types
            for batch in source:
                types = [batch.schema.field(c).type for c in columns]
                yield batch

        for found in first_occurrences(seen_types(batches), min_docs, columns):
            if found:
                parts = list(zip(*[row for _, row in found]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([what for what, _ in found], pa.int8()), *map(pa.array, parts, types)],
                    ["what", *columns])

    rows = stored(lines.repartitionByRange(*order).sortWithinPartitions(*order)
                  .mapInArrow(streamed, "what tinyint, " + ", ".join(f"{c} {k}" for c, k in zip(columns, kinds))),
                  f"{path}/streamed")
    seen = rows.filter(F.col("what") == SEEN)
    settled = (seen.groupBy("h1", "h2").agg(F.max("doc_id").alias("owner"), (
        F.count_distinct("doc_id") + F.max(F.col("doc_id").isNull().cast("int"))).alias("n_docs"))
        .filter(F.col("n_docs") >= min_docs).drop("n_docs"))
    # at most two digests a partition
    settled = bounded_broadcast(settled, seen.count())
    opened = rows.filter(F.col("what") == OPEN).join(settled, ["h1", "h2"]) \
        .filter(~F.col("doc_id").eqNullSafe(F.col("owner")))
    dropped = rows.filter(F.col("what") == DROPPED)
    name = ["k1", "k2", "doc_id", "n_lines"]

    @F.pandas_udf("binary")
    def packed(gone: pd.Series, n_lines: pd.Series) -> pd.Series:
        out = []
        for positions, n in zip(gone, n_lines):
            keep = np.ones(n, bool)
            keep[positions] = False
            out.append(zlib.compress(np.packbits(keep).tobytes()))
        return pd.Series(out)

    return (dropped.select(*name, "pos").unionByName(opened.select(*name, "pos"))
            .groupBy(*name).agg(F.collect_set("pos").alias("gone"))
            .select(*name, F.size("gone").cast("bigint").alias("n_dropped"), packed("gone", "n_lines").alias("keep")))


def kept_text(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept) of every document: the lines its bitmap keeps, joined by \\n."""
    keyed = _keyed(docs)
    marks = bitmaps.select(F.col("k1").alias("m1"), F.col("k2").alias("m2"), "n_dropped", "keep")
    found = keyed.join(marks, (F.col("k1") == F.col("m1")) & (F.col("k2") == F.col("m2")), "left") \
        .select("doc_id", "text", F.coalesce("n_dropped", F.lit(0).cast("bigint")).alias("n_dropped"), "keep")
    kind = found.schema["doc_id"].dataType.simpleString()

    def applied(batches):
        for batch in batches:
            count, kept = [], []
            for text, keep in zip(batch.column("text").to_pylist(), batch.column("keep").to_pylist()):
                count.append(text.count("\n") + 1)
                if keep is not None:
                    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), count=count[-1])
                    text = "\n".join(line for line, bit in zip(text.split("\n"), bits) if bit)
                kept.append(text)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(count, pa.int64()), batch.column("n_dropped"),
                 pa.array(kept, pa.string())], ["doc_id", "n_lines", "n_dropped", "kept"])

    return found.mapInArrow(applied, f"doc_id {kind}, n_lines bigint, n_dropped bigint, kept string")


def dedup(spark: SparkSession, docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """Bitmaps and the text they keep, in one call."""
    return kept_text(docs, keep_bitmaps(spark, docs, min_chars, min_docs))
