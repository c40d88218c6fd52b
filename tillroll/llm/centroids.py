"""Centroid clustering of integer vectors by a bisector tournament.

Every component x of a vector becomes the integer floor(scale * x). A vector's
nearest centroid is found without a distance: for each pair of centroids a < b
the integer normal 2(b - a) and threshold |b|^2 - |a|^2 are computed once, and
a vector v is nearer to b exactly when normal . v > threshold. The champion
starts as centroid 0 and meets 1, 2, ... in turn, k - 1 linear sign tests; a
test of zero is a tie and favours the smaller number, the champion's. Only the
winner's distance is computed. All arithmetic is on integers and exact.

Each round is one pass over the vectors: a task adds its vectors up by cluster
and hands on at most k rows, which Spark sums. Only the k centroids reach the
driver. The last assignment is a table in the shared folder.

Defined results:
* kept are vectors with exactly ``dim`` components, none null or non-finite;
  others get no row. Components beyond +-2^58 after scaling are not kept
  either: their distances fit no decimal;
* integers up to 2^26 are summed in 64 bits, larger ones as Python integers.
  A distance or inertia beyond a bigint is NULL;
* seeds are the k kept rows with the smallest sha256 of '<seed>:<id>' (a NULL
  id is the empty text), rows of one id in the order of their components. With
  fewer than k kept rows each of them is a centroid; with none the result is
  empty. Repeated rows and ids are vectors of their own;
* other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import bounded_arrow_batches, stored
from tillroll.session import work_path

DIM, SCALE, CLUSTERS, ROUNDS, SEED = 64, 64, 16, 3, "1"
LARGEST = 2.0 ** 58
# (2 * 2^27) * 2^26 * 64 components stays under 2^63
SMALL = 2 ** 26
BLOCK = 4096


@dataclass
class Model:
    """Centroids in their order, as lists of integers."""
    centroids: list[list[int]]
    dim: int = DIM
    scale: int = SCALE

    def digests(self) -> list[str]:
        return [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in self.centroids]


def whole(vectors: pa.Array, dim: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows kept, their components as floats that are whole numbers)."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    fit = vectors.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False) == dim
    rows = np.flatnonzero(fit)
    flat = vectors.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False)
    with np.errstate(over="ignore", invalid="ignore"):
        values = np.floor(flat.astype(np.float64).reshape(len(rows), dim) * scale)
        good = (np.abs(values) <= LARGEST).all(axis=1)  # False for NaN and infinity
    return rows[good], values[good]


def as_integers(values: np.ndarray, small: bool) -> np.ndarray:
    exact = values.astype(np.int64)
    return exact if small else exact.astype(object)


class Bisectors:
    """Normals and thresholds of all centroid pairs."""

    def __init__(self, centroids: list[list[int]]):
        exact = np.array(centroids, dtype=object).reshape(len(centroids), -1)
        norms = (exact * exact).sum(axis=1)
        self.small = bool((np.abs(exact) <= SMALL).all())
        self.exact = {False: (exact, 2 * (exact[None, :, :] - exact[:, None, :]), norms[None, :] - norms[:, None])}
        if self.small:
            self.exact[True] = tuple(part.astype(np.int64) for part in self.exact[False])

    def nearest(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(integer vectors, number of the nearest centroid, squared distance)."""
        small = self.small and bool((np.abs(values) <= SMALL).all())
        v = as_integers(values, small)
        centroids, normals, thresholds = self.exact[small]
        champion = np.zeros(len(v), np.int64)
        for rival in range(1, len(centroids)):
            side = (normals[champion, rival] * v).sum(axis=1)
            champion[side > thresholds[champion, rival]] = rival
        apart = v - centroids[champion]
        return v, champion, (apart * apart).sum(axis=1)


def _blocks(values: np.ndarray):
    for start in range(0, len(values), BLOCK):
        yield start, values[start:start + BLOCK]


def _input(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    return vectors.select(F.col(id_col).alias("id"), F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("name"),
                          F.col(vector_col).cast("array<double>").alias("vector"))


def seeds(rows: DataFrame, k: int, seed: str, dim: int, scale: int) -> list[list[int]]:
    """The first centroids: each task hands on its k smallest, Spark the k smallest of all."""
    def smallest(batches):
        best: list = []
        for batch in batches:
            at, values = whole(batch.column("vector"), dim, scale)
            names = batch.column("name").take(pa.array(at)).to_pylist()
            found = [(hashlib.sha256(f"{seed}:{name}".encode()).hexdigest(), i) for i, name in enumerate(names)]
            # rows of one id must all compete, by their components
            limit = sorted(found)[min(k, len(found)) - 1][0] if found else ""
            best = sorted(best + [(h, values[i].tolist()) for h, i in found if h <= limit])[:k]
        if best:
            yield pa.RecordBatch.from_arrays([pa.array([h for h, _ in best]),
                                              pa.array([v for _, v in best], pa.list_(pa.float64()))], ["h", "v"])

    first = rows.mapInArrow(smallest, "h string, v array<double>").orderBy("h", "v").limit(k)
    return [[int(x) for x in r.v] for r in first.collect()]


def _moved(rows: DataFrame, centroids: list[list[int]], dim: int, scale: int) -> list[list[int]]:
    """One round: every centroid that won vectors becomes floor(their sum / their count)."""
    marks = rows.sparkSession.sparkContext.broadcast(Bisectors(centroids))
    k = len(centroids)

    def totals(batches):
        count, sums = [0] * k, [np.zeros(dim, object) for _ in range(k)]
        for batch in batches:
            for _, values in _blocks(whole(batch.column("vector"), dim, scale)[1]):
                v, won, _ = marks.value.nearest(values)
                for c in np.unique(won):
                    own = v[won == c]
                    count[c] += len(own)
                    sums[c] += own.sum(axis=0).astype(object)
        used = [c for c in range(k) if count[c]]
        yield pa.RecordBatch.from_arrays([
            pa.array(used, pa.int32()), pa.array([count[c] for c in used], pa.int64()),
            pa.array([[Decimal(int(x)) for x in sums[c]] for c in used], pa.list_(pa.decimal128(38, 0)))],
            ["cluster", "n", "sums"])

    found = (rows.mapInArrow(totals, "cluster int, n bigint, sums array<decimal(38,0)>").groupBy("cluster")
             .agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[i]) for i in range(dim)]).alias("sums")))
    moved = list(centroids)
    for r in found.collect():  # one row for each centroid
        moved[r.cluster] = [int(x) // r.n for x in r.sums]
    return moved


def fit(spark: SparkSession, vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
        k: int = CLUSTERS, rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE, seed: str = SEED) -> Model:
    """Centroids after ``rounds`` rounds of assignment and move over all kept vectors."""
    bounded_arrow_batches(spark, rows=8192)
    rows = _input(vectors, id_col, vector_col)
    centroids = seeds(rows, k, seed, dim, scale)
    for _ in range(rounds if centroids else 0):
        centroids = _moved(rows, centroids, dim, scale)
    return Model(centroids, dim, scale)


def assign(spark: SparkSession, vectors: DataFrame, model: Model, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """(id, cluster, distance as decimal) of every kept vector."""
    bounded_arrow_batches(spark, rows=8192)
    rows = _input(vectors, id_col, vector_col).drop("name")
    schema = f"id {rows.schema['id'].dataType.simpleString()}, cluster int, distance decimal(38,0)"
    if not model.centroids:
        return spark.createDataFrame([], schema).withColumnRenamed("id", id_col)
    marks = spark.sparkContext.broadcast(Bisectors(model.centroids))
    dim, scale = model.dim, model.scale

    def nearest(batches):
        for batch in batches:
            at, kept = whole(batch.column("vector"), dim, scale)
            for start, values in _blocks(kept):
                _, won, distance = marks.value.nearest(values)
                yield pa.RecordBatch.from_arrays([
                    batch.column("id").take(pa.array(at[start:start + BLOCK])), pa.array(won.astype(np.int32)),
                    pa.array([Decimal(int(d)) for d in distance], pa.decimal128(38, 0))], ["id", "cluster", "distance"])

    return rows.mapInArrow(nearest, schema).withColumnRenamed("id", id_col)


def cluster(spark: SparkSession, vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
            k: int = CLUSTERS, rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE, seed: str = SEED) -> DataFrame:
    """Fit, assign, and add the inertias and the digest of each final centroid.

    One row for each kept vector: id, cluster int, distance, cluster_inertia
    and inertia bigint, centroid_sha256.
    """
    model = fit(spark, vectors, id_col, vector_col, k, rounds, dim, scale, seed)
    assigned = stored(assign(spark, vectors, model, id_col, vector_col), work_path(spark, "centroids", fresh=True))
    sums = {r.cluster: r.total for r in assigned.groupBy("cluster").agg(F.try_sum("distance").alias("total")).collect()}
    known = [x for x in sums.values() if x is not None]
    whole_sum = sum(known) if len(known) == len(sums) else None

    def as_long(x):
        return int(x) if x is not None and x < 2 ** 63 else None

    about = spark.createDataFrame(  # k rows
        [(c, as_long(sums.get(c, Decimal(0))), as_long(whole_sum), d) for c, d in enumerate(model.digests())],
        "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return (assigned.withColumn("distance", F.col("distance").try_cast("bigint"))
            .join(F.broadcast(about), "cluster")
            .select(id_col, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"))
