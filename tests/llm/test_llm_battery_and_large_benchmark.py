"""The randomness battery against a plain version, long texts, and benchmarks too large to broadcast."""

from __future__ import annotations

import math
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from tillroll.llm import decontaminate, secret_scan


def tail(z):
    """P(Z > |z|) by the library's error function, not by the operator's polynomial."""
    return 0.5 * math.erfc(abs(z) / math.sqrt(2))


def plain_battery(token):
    """(p_text, p_random) symbol by symbol."""
    letters, ic = next((a, c) for pattern, a, c in secret_scan.ENCODINGS if not pattern or re.match(pattern, token))
    n, a = len(token), len(letters)
    chi = sum(token.count(c) ** 2 for c in set(token)) * a / n - n
    k = a - 1
    z_chi = ((max(chi, 0) / k) ** (1 / 3) - (1 - 2 / (9 * k))) / math.sqrt(2 / (9 * k))
    shift = n * (a * ic - 1)
    z_text = (chi - k - shift) / math.sqrt(2 * (k + 2 * shift))
    p_text = tail(z_text) if z_text <= 0 else 1 - tail(z_text)
    v = [letters.find(c) + 1 for c in token]
    middle = (a + 1) / 2
    side = [x > middle for x in v]
    high = sum(side)
    runs = 1 + sum(x != y for x, y in zip(side, side[1:]))
    expected = 2 * high * (n - high) / n + 1
    spread = max((expected - 1) * (expected - 2) / (n - 1), 1e-9)
    serial = sum((x - middle) * (y - middle) for x, y in zip(v, v[1:])) / ((a * a - 1) / 12 * math.sqrt(n - 1))
    keep = lambda p: min(max(p, 1e-300), 0.99)
    tests = [keep(tail(z_chi) if z_chi >= 0 else 1 - tail(z_chi)), 1e-300 if high in (0, n) else keep(2 * tail((runs - expected) / math.sqrt(spread))),
             keep(2 * tail(serial))]
    mean = sum(1 / math.tan(math.pi * p) for p in tests) / 3
    return p_text, math.atan2(1, mean) / math.pi


def plain_random_spans(text, base):
    tokens = [m for m in re.finditer(secret_scan.TOKEN, text) if all(b <= m.start() or a >= m.end() for a, b in base)]
    if not tokens:
        return []
    mean = sum(len(m[0]) for m in tokens) / len(tokens)
    rows = sorted((p / r * mean / len(m[0]), m.start(), m.end(), r) for m in tokens for p, r in [plain_battery(m[0])])
    last = max([i for i, (p, *_) in enumerate(rows) if p <= secret_scan.FALSE_DISCOVERY * (i + 1) / len(rows)], default=-1)
    return sorted((s, e) for _, s, e, r in rows[:last + 1] if r >= secret_scan.RANDOM_LEAST)


def drawn_tokens(seed):
    draw = random.Random(seed)
    alphabets = [a for _, a, _ in secret_scan.ENCODINGS]
    made = ["".join(draw.choices(draw.choice(alphabets), k=draw.randrange(20, 90))) for _ in range(250)]
    made += ["".join(draw.choices(["the", "and", "ing", "ion", "er"], k=12)) for _ in range(40)]
    ordered = (secret_scan.LOW * 4, "A" * 60, "ab" * 40, "0123456789abcdef" * 5, "a" * 30 + "z" * 30)
    return made + list(ordered)


def test_battery_against_plain_version(spark):
    tokens = drawn_tokens(5)
    rows = spark.createDataFrame(list(enumerate(tokens)), "i int, t string") \
        .select("i", secret_scan.battery(F.col("t")).alias("r")).select("i", "r.*").collect()
    assert len(rows) == len(tokens)
    for r in rows:
        p_text, p_random = plain_battery(tokens[r.i])
        # the polynomial's error is absolute: compare closely where p-values decide anything
        assert r.p_text == pytest.approx(p_text, rel=0.02, abs=1e-6), tokens[r.i]
        assert r.p_random == pytest.approx(p_random, rel=0.02, abs=1e-6), tokens[r.i]


def test_each_test_of_randomness_counts():
    """The symbols of a random token in another order, or made less even, are refused."""
    letters = secret_scan.DIGITS + "abcdef"
    drawn = random.Random(3).choices(letters, k=64)
    half = sorted(drawn)
    swing = [x for pair in zip(half[:32], half[32:]) for x in pair]
    uneven = random.Random(4).choices(letters, [9, 9, 9] + [1] * 13, k=64)
    least = secret_scan.RANDOM_LEAST
    assert plain_battery("".join(drawn))[1] > 0.05
    assert all(plain_battery("".join(t))[1] < least for t in (half, swing, uneven))


def test_random_spans_against_plain_version(spark):
    draw = random.Random(9)
    tokens = drawn_tokens(6)
    texts = []
    for _ in range(60):
        parts = draw.choices([*tokens, "token=abcdef99", "deadbeef" * 4, "AKIA" + "Z" * 20, "é", "prose of words"],
                             k=draw.randrange(0, 14))
        texts.append("".join(p + draw.choice([" ", "\n", ", ", "."]) for p in parts))
    rows = secret_scan.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")).collect()
    found = 0
    for r in rows:
        spans = [s.split(":") for s in r.spans.split(",") if s]
        base = [(int(a), int(b)) for kind, a, b in spans if kind != "random"]
        want = plain_random_spans(texts[r.doc_id], base)
        assert [(int(a), int(b)) for kind, a, b in spans if kind == "random"] == want, texts[r.doc_id]
        found += len(want)
    assert len(rows) == 60 and found > 60


def test_null_empty_and_repeated_rows(spark):
    rows = [(1, None), (1, None), (None, ""), (2, " ")]
    got = secret_scan.scan(spark.createDataFrame(rows, "doc_id int, text string")).collect()
    assert len(got) == 4 and all(r.spans == "" and r.n_assign == r.n_access == r.n_hex == 0 for r in got)


def test_secrets_of_a_long_text_take_linear_time(spark):
    draw = random.Random(2)
    symbols = secret_scan.UP + secret_scan.LOW + secret_scan.DIGITS

    def seconds(lines):
        text = "\n".join(f"{draw.getrandbits(112):028x} {''.join(draw.choices(symbols, k=32))}" for _ in range(lines))
        df = spark.createDataFrame([(1, text)], "doc_id int, text string")
        begin = time.time()
        row = secret_scan.scan(df).first()
        assert row.n_hex == lines and row.spans.count("random") > 0.8 * lines
        return time.time() - begin

    seconds(100)
    short, long = seconds(2000), seconds(16000)
    assert long < 8 * 2.5 * short + 2, (short, long)


def benchmark_case(spark, passages=40):
    draw = random.Random(17)
    vocabulary = [f"w{i}" for i in range(400)]
    items = [" ".join(draw.choices(vocabulary, k=draw.choice([1, 2, 5, 12, 13, 14, 30, 60]))) for _ in range(passages)]
    docs = []
    for i in range(120):
        words = draw.choices(vocabulary, k=draw.randrange(0, 300))
        for item in draw.choices(items, k=draw.randrange(0, 4)):
            at = draw.randrange(len(words) + 1)
            words[at:at] = item.split()
        docs.append((i, " ".join(words)))
    docs += [(5, docs[5][1]), (6, docs[7][1]), (None, docs[8][1]), (None, docs[8][1]), (None, None), (200, "")]
    bench = spark.createDataFrame([(f"i{k}", t) for k, t in enumerate(items)] + [("none", None), ("i0", items[0])],
                                  "item_id string, text string")
    return spark.createDataFrame(docs, "doc_id int, text string").repartition(5), bench


def test_a_benchmark_too_large_to_broadcast_gives_the_same_rows(spark, monkeypatch):
    docs, bench = benchmark_case(spark)

    def rows():
        return sorted(map(str, decontaminate.contamination(docs, bench, keyed=True).collect()))

    small = rows()
    monkeypatch.setattr(decontaminate, "BROADCAST_MAX_BYTES", -1)
    auto = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    adaptive = spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        assert rows() == small and len(small) == 126
        plan = decontaminate.contamination(docs, bench)._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", auto)
        if adaptive is None:
            spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
        else:
            spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", adaptive)


def test_no_probe_row_carries_its_document(spark):
    """Up to the join with the grams, the plan for large benchmarks hands on keys and numbers only."""
    docs, bench = benchmark_case(spark, 5)
    base = docs.select("doc_id", decontaminate.text_key(F.col("text")).alias("text_key"),
                       decontaminate.item_words(F.col("text")).alias("words")).withColumn("n", F.size("words"))
    wins = decontaminate.windows(bench)
    lengths = sorted(r["m"] for r in wins.select("m").distinct().collect())
    df = decontaminate._places_by_shuffle(base, decontaminate._grams(wins, lengths), lengths)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    semi = plan[plan.index("LeftSemi"):]
    probe_side = next(line for line in semi.splitlines()[1:] if "Project" in line)
    assert "words" not in probe_side.split("[", 1)[1]
