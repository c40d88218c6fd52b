"""Registered queries of the training-data operators, with SQL where it exists."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import (
    centroids,
    decontaminate,
    fingerprints,
    language_id,
    line_dedup,
    mixing,
    quality,
    samples,
    secret_scan,
    sharding,
    simhash,
    spelling,
    substring_dedup,
    token_counts,
)
from tillroll.llm.common import table
from tillroll.session import work_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn
    return add


@query("op1_language_id")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(samples.id_remainder(F.col("doc_id"), 4) == 2, F.lit(False))  # a NULL id has no remainder
    model = language_id.fit(spark, docs, train=~held_out)
    return language_id.identify(spark, docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query("op2_token_counts")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a cache of its own, so that every run encodes all distinct texts
    return token_counts.count_tokens(spark, table(spark, sf_dir, "documents"),
                                     public_tokenizers.path("word_bpe_49k.json"),
                                     work_path(spark, "token-cache", fresh=True))


@query("op3_quality")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(samples.id_remainder(F.col("doc_id"), 5) == 0, F.lit(False))
    model = quality.fit(spark, docs, table(spark, sf_dir, "labels"), train=~held_out)
    return quality.score(spark, docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query("op4_fingerprints")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


@query("op5_secrets")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


SUBSTRING_SQL = r"""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
win AS (
  SELECT doc_id, p, array_to_string(ws[p:p + 12], ' ') AS k
  FROM w, unnest(range(1, len(ws) - 11)) AS t(p)),
own AS (SELECT k, min(doc_id) AS o FROM win GROUP BY k),
gone AS (
  SELECT DISTINCT doc_id, p + j AS p
  FROM win JOIN own USING (k), unnest(range(0, 13)) AS t(j) WHERE o < doc_id),
one AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM w),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS body, count(*) AS n
  FROM one ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(body, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

CONTAMINATION_SQL = r"""
WITH letters AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS a, 'abcdefghijklmnopqrstuvwxyz' AS b),
d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), a, b), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents, letters),
i AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id,
         regexp_extract_all(translate(coalesce(text, ''), a, b), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark, letters),
iw AS (
  SELECT DISTINCT item_id, least(len(ws), 13) AS m, array_to_string(ws[p:p + least(len(ws), 13) - 1], ' ') AS k
  FROM i, unnest(range(1, greatest(len(ws) - 12, 1) + 1)) AS t(p) WHERE len(ws) > 0),
dw AS (
  SELECT doc_id, m, p, array_to_string(ws[p:p + m - 1], ' ') AS k
  FROM d, (SELECT DISTINCT m FROM iw), unnest(range(1, len(ws) - m + 2)) AS t(p)),
hit AS (SELECT doc_id, p, m, item_id FROM dw JOIN iw USING (m, k)),
words AS (
  SELECT doc_id, count(DISTINCT p + j) AS n_hit
  FROM (SELECT DISTINCT doc_id, p, m FROM hit), unnest(range(0, m)) AS t(j) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query("op6_substring_dedup", SUBSTRING_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(spark, table(spark, sf_dir, "documents"))


@query("op7_simhash")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(spark, table(spark, sf_dir, "documents"))


@query("op8_sharding")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(spark, table(spark, sf_dir, "documents"))


@query("op9_mixing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "copies")


@query("op10_decontaminate", CONTAMINATION_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")) \
        .drop("hit_spans")


def _centroid_sql(k: int = centroids.CLUSTERS, rounds: int = centroids.ROUNDS, dim: int = centroids.DIM,
                  scale: int = centroids.SCALE, seed: str = centroids.SEED) -> str:
    """One CTE pair a round: assign by distance (ties: smaller number), then move by exact floor division."""
    parts = [f"""kept AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: isfinite(x))) = {dim}),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v AS m
  FROM (SELECT sha256('{seed}:' || vec_id) AS h, v FROM kept ORDER BY h, v LIMIT {k}))"""]
    for r in range(rounds + 1):
        parts.append(f"""a{r} AS MATERIALIZED (
  SELECT vec_id, v, min(struct_pack(d := d, c := c)) AS best
  FROM (SELECT row, vec_id, v, c, list_sum(list_transform(list_zip(v, m), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d
        FROM (SELECT *, row_number() OVER () AS row FROM kept), c{r}) GROUP BY row, vec_id, v)""")
        if r < rounds:
            parts.append(f"""c{r + 1} AS MATERIALIZED (
  SELECT c, coalesce(moved, m) AS m FROM c{r} LEFT JOIN (
    SELECT c, list(q ORDER BY i) AS moved FROM (
      SELECT best.c AS c, i, CAST((sum(x) - (sum(x) % count(*) + count(*)) % count(*)) // count(*) AS BIGINT) AS q
      FROM (SELECT best, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{r}) GROUP BY best.c, i)
    GROUP BY c) USING (c))""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, CAST(best.c AS INTEGER) AS cluster, CAST(best.d AS BIGINT) AS distance,
       CAST(sum(best.d) OVER (PARTITION BY best.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(best.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(m, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} ON c{rounds}.c = best.c"""


LINES_SQL = r"""
WITH letters AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS a, 'abcdefghijklmnopqrstuvwxyz' AS b,
                        ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) AS space),
d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS p FROM d),
k AS (SELECT doc_id, line, p, translate(trim(line, space), a, b) AS key FROM l, letters),
own AS (SELECT key, max(doc_id) AS owner FROM k WHERE length(key) >= 40
        GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
kept AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY p) AS body, count(*) AS n
         FROM k LEFT JOIN own USING (key) WHERE owner IS NULL OR owner = doc_id GROUP BY doc_id)
SELECT doc_id, CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - coalesce(n, 0) AS BIGINT) AS n_dropped,
       sha256(coalesce(body, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


@query("op11_centroids", _centroid_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(spark, table(spark, sf_dir, "embeddings"))


@query("op12_line_dedup", LINES_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup(spark, table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


@query("op13_spelling_variants")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spark, table(spark, sf_dir, "documents"))
