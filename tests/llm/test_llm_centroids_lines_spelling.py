"""Centroids, line dedup and spelling variants against brute force, and their defined odd cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.llm import centroids, line_dedup, spelling
from tillroll.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


# --- centroids ---------------------------------------------------------------


def nearest(v, centers):
    best = min(range(len(centers)), key=lambda c: (sum((a - b) ** 2 for a, b in zip(v, centers[c])), c))
    return best, sum((a - b) ** 2 for a, b in zip(v, centers[best]))


def plain_clusters(rows, k, rounds, dim, scale):
    """Every distance in Python integers; (id, cluster, distance, centroids)."""
    kept = [(i, [math.floor(scale * float(x)) for x in v]) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    centers = [v for _, _, v in sorted((hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest(), tuple(v), v)
                                       for i, v in kept)[:k]]
    for _ in range(rounds):
        won = [nearest(v, centers)[0] for _, v in kept]
        for c in range(len(centers)):
            own = [v for (_, v), w in zip(kept, won) if w == c]
            if own:
                centers[c] = [sum(col) // len(own) for col in zip(*own)]
    return [(i, *nearest(v, centers)) for i, v in kept], centers


def ordered(rows):
    return sorted(rows, key=repr)


def check_clusters(spark, rows, k=16, rounds=3, dim=64, scale=64):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    df = df.select("*", *[F.lit("x").alias(c) for c in ("id", "cluster", "distance", "v", "h", "name", "vector")])
    got = centroids.cluster(spark, df.repartition(3), k=k, rounds=rounds, dim=dim, scale=scale).collect()
    want, centers = plain_clusters(rows, k, rounds, dim, scale)
    assert ordered((r.vec_id, r.cluster, r.distance) for r in got) == ordered(want)
    for r in got:
        assert r.cluster_inertia == sum(d for _, c, d in want if c == r.cluster)
        assert r.inertia == sum(d for _, _, d in want)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, centers[r.cluster])).encode()).hexdigest()
    return got


def test_centroids_query_against_brute_force(spark):
    rows = [(r.vec_id, [float(x) for x in r.embedding])
            for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    want, _ = plain_clusters(rows, 16, 3, 64, 64)
    got = QUERIES["op11_centroids"](spark, SF).collect()
    assert ordered((r.vec_id, r.cluster, r.distance) for r in got) == ordered(want)


def test_centroid_ties_and_odd_vectors(spark):
    rng = random.Random(3)
    rows = [(i, [float(rng.randint(-2, 2)) for _ in range(3)]) for i in range(200)]  # a small grid: many ties
    rows += [(7, [1.0, 1.0, 1.0]), (7, [1.0, 1.0, 1.0]), (None, [0.0, 1.0, -1.0]), (900, None), (901, []),
             (902, [1.0, 2.0]), (903, [1.0, None, 2.0]), (904, [math.nan, 0.0, 0.0]), (905, [math.inf, 0.0, 0.0]),
             (906, [-0.3, 0.7, 1.99]), (907, [1e308, 0.0, 0.0])]
    check_clusters(spark, [r for r in rows if r[0] != 907], k=5, dim=3, scale=1)
    got = check_clusters(spark, [r for r in rows if r[0] != 907], k=5, dim=3, scale=64)
    assert not {r.vec_id for r in got} & {900, 901, 902, 903, 904, 905}
    beyond = centroids.cluster(spark, spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), k=5, dim=3)
    assert 907 not in {r.vec_id for r in beyond.collect()}


def test_large_components_stay_exact(spark):
    rng = random.Random(4)
    rows = [(i, [float(rng.randint(-2**27, 2**27)) for _ in range(4)]) for i in range(60)]
    check_clusters(spark, rows, k=4, dim=4, scale=1)
    huge = [(i, [float(rng.randint(-2**50, 2**50)) for _ in range(4)]) for i in range(20)]
    df = spark.createDataFrame(huge, "vec_id bigint, embedding array<double>")
    got = {r.vec_id: r for r in centroids.cluster(spark, df, k=3, dim=4, scale=1).collect()}
    want, _ = plain_clusters(huge, 3, 3, 4, 1)
    assert {i: r.cluster for i, r in got.items()} == {i: c for i, c, _ in want}
    assert all(got[i].distance == (d if d < 2**63 else None) for i, _, d in want)


def test_few_or_no_vectors(spark):
    check_clusters(spark, [(1, [0.5, 0.25]), (2, [0.75, -1.0])], k=16, dim=2)
    none = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    got = centroids.cluster(spark, none)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert got.count() == 0


def test_sign_tests_decide_without_distances():
    """The tournament uses normals and thresholds alone; zero favours the smaller number."""
    duel = centroids.Bisectors([[0, 0], [2, 0], [0, 0]])
    assert duel.nearest(np.array([[1.0, 5.0]]))[1].tolist() == [0]
    for size in (True, False):
        duel.exact[size][0][:] = 0  # without the centroids the winner is the same
    assert duel.nearest(np.array([[2.0, 1.0], [-1.0, 0.0]]))[1].tolist() == [1, 0]


# --- line dedup --------------------------------------------------------------


SPACE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain_lines(rows, min_chars=40, min_docs=5):
    key = lambda line: line.strip(SPACE).translate(LOWER)
    holders = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            holders.setdefault(key(line), set()).add(i)
    drop = {k: max(x for x in ids if x is not None) for k, ids in holders.items()
            if len(k) >= min_chars and len(ids) >= min_docs}
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in drop or drop[key(x)] == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def line_rows():
    rng = random.Random(5)
    shared = [f"Shared line number {n} that is long enough to be a key é{n}" for n in range(12)]
    rows = [(i, "\n".join(rng.choice([*shared, shared[0], f"  {shared[0].upper()}\t", f"own line {i} {rng.random()}",
                                      "short", ""]) for _ in range(rng.randint(1, 12)))) for i in range(150)]
    rows += [(i, shared[0] + "\n" + shared[0]) for i in range(200, 500)]  # one line in most documents
    four = "only four documents hold this line, so that it stays"
    rows += [(600 + i, four + "\n" + four) for i in range(4)]
    rows += [(700, None), (701, ""), (702, "\n\n"), (None, shared[0] + "\nx"), (None, shared[1]), (703, "\r\n".join(shared)),
             (210, shared[0] + "\n" + shared[0]), (210, "another text of this id\n" + shared[0]),
             (704, "é" * 39), (704, "é" * 40)] + [(710 + i, "É" * 40 + "\n" + "é" * 39) for i in range(5)]
    rows += [(800, "\n".join(f"{shared[n % 12]}" for n in range(20000)))]
    return rows


@pytest.mark.parametrize("partitions", [1, 7, 40])
def test_line_dedup_against_brute_force(spark, partitions):
    rows = line_rows()
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions",
                                             "spark.sql.adaptive.coalescePartitions.enabled")}
    try:  # 40 ranges: the hot line is dealt over many partitions
        spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
        df = df.select("*", *[F.lit("x").alias(c) for c in ("k1", "k2", "pos", "keep", "h1", "owner", "n_lines")])
        got = line_dedup.dedup(spark, df).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert ordered(tuple(r) for r in got) == ordered(plain_lines(rows))


def test_bitmaps_are_small_and_only_for_changed_documents(spark):
    rows = line_rows()
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    bitmaps = line_dedup.keep_bitmaps(spark, df).collect()
    changed = {(i, n) for i, n, gone, _ in plain_lines(rows) if gone}
    assert {(r.doc_id, r.n_lines) for r in bitmaps} == changed
    big = next(r for r in bitmaps if r.n_lines == 20000) if any(i == 800 for i, _ in changed) else None
    assert big is None or len(big.keep) < 20000 // 8
    assert "text" not in line_dedup.keep_bitmaps(spark, df).columns


def test_line_dedup_of_no_documents(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert line_dedup.dedup(spark, none).count() == 0
    with pytest.raises(ValueError):
        line_dedup.keep_bitmaps(spark, none, min_docs=1)


def test_streamed_rows_of_a_cut_digest_stay_open():
    import pyarrow as pa
    cols = ["k1", "k2", "doc_id", "n_lines", "pos", "h1", "h2"]
    rows = [(d, d, d, 1, 0, h, h) for h, ds in ((1, [9, 8]), (2, [9, 8, 7, 6, 5, 4]), (3, [9, 8, 7])) for d in ds]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], cols)
    out = [x for part in line_dedup.first_occurrences([batch], 5, cols) for x in part]
    assert [(r[2], r[5]) for w, r in out if w == line_dedup.DROPPED] == [(d, 2) for d in (8, 7, 6, 5, 4)]
    assert [(r[2], r[5]) for w, r in out if w == line_dedup.OPEN] == [(9, 1), (8, 1), (8, 3), (7, 3)]
    assert [(r[2], r[5]) for w, r in out if w == line_dedup.SEEN] == [(9, 1), (8, 1), (9, 3), (8, 3), (7, 3)]


# --- spelling ----------------------------------------------------------------


def plain_words(rows, min_chars=7, min_count=2):
    total = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= min_chars:
                total[run] += 1
    return {w: n for w, n in total.items() if n >= min_count}


def plain_near(words):
    """Words at distance one, by deleting or masking every position."""
    near = {w: set() for w in words}
    masks = {}
    for w in words:
        for i in range(len(w)):
            masks.setdefault(w[:i] + "\0" + w[i + 1:], []).append(w)
            cut = w[:i] + w[i + 1:]
            if cut in near:
                near[w].add(cut)
                near[cut].add(w)
    for group in masks.values():
        for w in group:
            near[w].update(x for x in group if x != w)
    return near


def plain_variants(rows, ratio=10):
    n = plain_words(rows)
    near = plain_near(n)
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


def test_spelling_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = QUERIES["op13_spelling_variants"](spark, SF).collect()
    assert ordered(tuple(r) for r in got) == ordered(plain_variants(rows))


def word_rows():
    rng = random.Random(6)
    base = ["".join(rng.choice("aabé") for _ in range(rng.randint(7, 9))) for _ in range(60)]
    rows = [(i, " ".join(rng.choice(base) for _ in range(40))) for i in range(60)]
    rows += [(1000 + i, "accommodate Accommodate ACCOMMODATE accomodate acommodate") for i in range(3)]
    rows += [(2000 + i, "thousand " * 12) for i in range(100)]
    rows += [(3000 + i, "thousandd thousanddd thusand thousanddd") for i in range(2)] + [(3100, "thousandd " * 60)]
    rows += [(4000, None), (4001, ""), (4002, "÷÷÷÷÷÷÷ ×××××××× 1234567"), (4002, "÷÷÷÷÷÷÷ ×××××××× 1234567"),
             (None, "nullable nullable"), (4003, "ÉCOLES-ÉCOLIERS écoliers ÉCOLIERS"),
             (4004, "x" * 3000 + " " + "x" * 3000 + " " + "x" * 3001 + " " + "x" * 3001)]
    return rows


@pytest.mark.parametrize("range_words", [1 << 16, 9])
def test_spelling_against_brute_force(spark, monkeypatch, range_words):
    monkeypatch.setattr(spelling, "RANGE_WORDS", range_words)  # 9: some dozens of ranges, cut prefixes everywhere
    rows = word_rows()
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    df = df.select("*", *[F.lit("x").alias(c) for c in ("word", "n", "id", "p", "s", "near", "name", "path")])
    got = ordered(tuple(r) for r in spelling.variants(spark, df).collect())
    want = ordered(plain_variants(rows))
    assert got == want
    assert any(w[1] for w in want) and any(w[1] and w[2] != w[1] for w in want)


def test_node_numbers_stand_for_one_prefix_each(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(spelling, "RANGE_WORDS", 20)
    rng = random.Random(7)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randint(1, 9))) for _ in range(400)})
    df = spark.createDataFrame([(w,) for w in words], "word string")
    number, prefix = {}, {}
    for r in spelling.trie_paths(df, "word").collect():
        assert len(r.path) == len(r.word) + 1
        for depth, node in enumerate(r.path):
            assert number.setdefault(r.word[:depth], node) == node
            assert prefix.setdefault(node, r.word[:depth]) == r.word[:depth]
    assert any(node < 0 for node in prefix) and any(node >> spelling.BLOCK > 3 for node in prefix)


def test_spelling_without_words(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert spelling.variants(spark, none).count() == 0
    assert spelling.variants(spark, spark.createDataFrame([(1, "no long one")], "doc_id bigint, text string")).count() == 0
    with pytest.raises(ValueError):
        spelling.variants(spark, none, ratio=1)
