"""Secret scans: base patterns and a randomness test battery, in SQL functions.

Base kinds (fixed patterns of the contract): ``assign``, ``access``, ``hex``.
The battery adds spans of kind ``random``: tokens of 20 or more symbols that
no base span touches and that look like random draws from an encoding.

* The encoding is inferred from the symbols: hex, lower-case letters, base32,
  alphanumeric, base64 or base64url.
* Three tests of randomness: chi-squared uniformity over the alphabet, runs
  above and below the middle of the alphabet, lag-one serial correlation; their
  p-values are combined into one (Cauchy combination).
* Discovered against ordinary text: the p-value that text of this length would
  have so even a symbol count, divided by the combined p-value of randomness.
  Expected unevenness grows with the length, so long tokens need less doubt
  than short ones. P-values are weighted by token length and go through
  Benjamini-Hochberg within the document.

Work is linear in the text apart from sorting its tokens and spans.

Offsets are code points, end exclusive. Defined cases: NULL text counts as
empty (no spans, digest of the empty string); repeated rows give equal rows;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import let

# The base kinds' patterns and least lengths.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24

TOKEN_LEAST = 20
TOKEN = r"[A-Za-z0-9+/_-]{%d,}" % TOKEN_LEAST
FALSE_DISCOVERY = 0.05
RANDOM_LEAST = 0.001  # least combined p-value of the three tests of randomness

DIGITS, LOW, UP = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# (pattern of the encoding, its alphabet, index of coincidence of text in it)
ENCODINGS = [
    ("^[0-9a-f]+$", DIGITS + "abcdef", 0.125),
    ("^[0-9A-F]+$", DIGITS + "ABCDEF", 0.125),
    ("^[a-z]+$", LOW, 0.065),
    ("^[A-Z]+$", UP, 0.065),
    ("^[A-Z2-7]+$", UP + "234567", 0.065),
    ("^[0-9A-Za-z]+$", DIGITS + UP + LOW, 0.05),
    ("^[0-9A-Za-z+/]+$", UP + LOW + DIGITS + "+/", 0.05),
    ("", UP + LOW + DIGITS + "-_", 0.05),
]
SPAN = "array<struct<start:int,kind_no:int,end:int,kind:string>>"
BLOCK = 256


def prefix_fold(a: Column, step) -> Column:
    """``step`` over 0 and all earlier elements, in blocks so that no long fold appends.

    ``step`` must be associative and keep x for (0, x), as sums and largest
    values of non-negative numbers do.
    """
    def running(values: Column, start: Column) -> Column:
        return F.aggregate(values, F.struct(F.array().cast("array<int>").alias("out"), start.alias("state")),
                           lambda acc, x: F.struct(F.concat(acc["out"], F.array(acc["state"])).alias("out"),
                                                   step(acc["state"], x).alias("state")), lambda acc: acc["out"])

    def in_blocks(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), step))
        return let(running(totals, F.lit(0)),
                   lambda starts: F.flatten(F.zip_with(blocks, starts, running)))

    def whole(v: Column) -> Column:
        count = F.ceil(F.size(v) / F.lit(BLOCK)).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), count - 1), lambda b: F.slice(v, b * BLOCK + 1, BLOCK))
        return F.when(F.size(v) == 0, F.array().cast("array<int>")).otherwise(let(blocks, in_blocks))

    return let(a, whole)


def prefix_sums(a: Column) -> Column:
    """Sums of all earlier elements."""
    return prefix_fold(a, lambda s, x: s + x)


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    """(start, value, group value) of all leftmost non-overlapping matches.

    The pieces between the matches give the offsets: a match starts after all
    earlier pieces and matches.
    """
    kind = "array<struct<start:int,value:string,part:string>>"
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    gaps = F.split(text, pattern, -1)

    def placed(hits: Column) -> Column:
        def offsets(gap: Column) -> Column:
            steps = F.transform(hits, lambda v, i: F.length(F.get(gap, i)) + F.length(v))
            return let(prefix_sums(steps), lambda sums: F.zip_with(
                F.zip_with(sums, gap, lambda s, g: s + F.length(g)), F.arrays_zip(
                    hits.alias("value"), parts.alias("part")),
                lambda s, h: F.struct(s.alias("start"), h["value"].alias("value"), h["part"].alias("part"))))
        # gaps has one element more than hits: the rest after the last match
        return let(gaps, lambda g: F.slice(offsets(g), 1, F.size(hits)))

    return F.when(F.rlike(text, F.lit(pattern)), let(found, placed).cast(kind)) \
        .otherwise(F.array().cast(kind))


def _spans(hits: Column, no: int, kind: str, keep) -> Column:
    return F.transform(F.filter(hits, keep), lambda h: F.struct(
        h["start"].alias("start"), F.lit(no).alias("kind_no"),
        (h["start"] + F.length(h["value"])).alias("end"), F.lit(kind).alias("kind"))).cast(SPAN)


def base_spans(text: Column) -> list[Column]:
    """Span arrays of assign, access and hex, in this order."""
    return [
        _spans(matches(text, ASSIGN, 2), 0, "assign", lambda h: F.length(h["part"]) >= ASSIGN_LEAST),
        _spans(matches(text, ACCESS), 1, "access", lambda h: F.length(h["value"]) >= ACCESS_LEAST),
        # a run is matched whole, so asking for its least length up front finds the same runs
        _spans(matches(text, r"[0-9a-f]{%d,}" % HEX_LEAST), 2, "hex", lambda h: F.lit(True)),
    ]


def _lower_tail(z: Column) -> Column:
    """Normal distribution function (Abramowitz and Stegun 7.1.26)."""
    x = F.abs(z) / F.lit(2 ** 0.5)
    t = F.lit(1.0) / (1 + x * 0.3275911)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    half = poly * F.exp(-x * x) / 2
    return F.when(z <= 0, half).otherwise(1 - half)


def _kept_off_bounds(p: Column) -> Column:
    """A p-value that the Cauchy combination can take."""
    return F.least(F.greatest(p, F.lit(1e-300)), F.lit(0.99))


def _two_sided(z: Column) -> Column:
    return _kept_off_bounds(_lower_tail(-F.abs(z)) * 2)


def battery(token: Column) -> Column:
    """(p_text, p_random) of one token of at least TOKEN_LEAST symbols.

    ``p_text``: chance of so even a symbol count in ordinary text of this
    length. ``p_random``: the chi-squared, runs and serial-correlation tests of
    randomness as one p-value (Cauchy combination).
    """
    alphabet = ic = None
    for pattern, letters, coincidence in reversed(ENCODINGS):
        hit = F.rlike(token, F.lit(pattern)) if pattern else F.lit(True)
        a, c = F.lit(letters), F.lit(coincidence)
        alphabet = a if alphabet is None else F.when(hit, a).otherwise(alphabet)
        ic = c if ic is None else F.when(hit, c).otherwise(ic)
    symbols = F.filter(F.split(token, ""), lambda c: c != "")

    def judged(e: Column) -> Column:
        letters, n, a = e["letters"], e["n"], e["a"]
        middle = (a + 1) / 2
        squares = F.aggregate(F.array_distinct(e["chars"]), F.lit(0.0), lambda s, c: s + F.pow(
            n - F.length(F.replace(token, c, F.lit(""))), F.lit(2.0)))
        values = F.transform(e["chars"], lambda c: F.call_function("instr", letters, c).cast("double"))
        # one fold: symbols above the middle, runs, lag-one products; ``last`` is 0 before the first symbol
        zero = F.struct(*[F.lit(0.0).alias(c) for c in ("last", "high", "runs", "product")])
        sums = F.aggregate(values, zero, lambda s, x: F.struct(
            x.alias("last"), (s["high"] + (x > middle).cast("double")).alias("high"),
            (s["runs"] + ((s["last"] == 0) | ((x > middle) != (s["last"] > middle))).cast("double")).alias("runs"),
            (s["product"] + F.when(s["last"] == 0, 0.0).otherwise((s["last"] - middle) * (x - middle))).alias("product")))
        measured = F.struct((squares * a / n - n).alias("chi"), sums.alias("s"))

        def p_values(t: Column) -> Column:
            chi, high, k = t["chi"], t["s"]["high"], a - 1
            # Wilson-Hilferty: the cube root of chi-squared over its degrees is near normal
            z_chi = (F.pow(F.greatest(chi, F.lit(0.0)) / k, F.lit(1 / 3)) - (1 - F.lit(2.0) / (k * 9))) / F.sqrt(F.lit(2.0) / (k * 9))
            shift = n * (a * e["ic"] - 1)
            p_text = _lower_tail((chi - k - shift) / F.sqrt((k + shift * 2) * 2))
            expected = high * (n - high) * 2 / n + 1
            spread = (expected - 1) * (expected - 2) / (n - 1)
            z_runs = (t["s"]["runs"] - expected) / F.sqrt(F.greatest(spread, F.lit(1e-9)))
            # all symbols on one side of the middle: as far from random as runs can tell
            p_runs = F.when((high == 0) | (high == n), F.lit(1e-300)).otherwise(_two_sided(z_runs))
            p_serial = _two_sided(t["s"]["product"] / ((a * a - 1) / 12 * F.sqrt(n - 1)))
            # upper tail: a short key without a repeated symbol is more even than chance, and a secret
            tests = [_kept_off_bounds(_lower_tail(-z_chi)), p_runs, p_serial]
            mean = sum((F.lit(1.0) / F.tan(p * F.pi()) for p in tests), F.lit(0.0)) / len(tests)
            return F.struct(p_text.alias("p_text"), (F.atan2(F.lit(1.0), mean) / F.pi()).alias("p_random"))

        return let(measured, p_values)

    return let(F.struct(alphabet.alias("letters"), ic.alias("ic"), symbols.alias("chars"),
                        F.length(token).cast("double").alias("n"),
                        F.length(alphabet).cast("double").alias("a")), judged)


def _untouched(tokens: Column, base: Column) -> Column:
    """(start, end, value) of the tokens that share no code point with a base span.

    Spans and tokens are sorted together, a token by its end: a span before it
    begins before the token ends, so the largest end of those tells whether one
    reaches into the token. Sorting and one running maximum, however many spans.
    """
    event = "array<struct<at:int,is_base:int,start:int,end:int,value:string>>"
    ends = F.transform(tokens, lambda h: let(h["start"] + F.length(h["value"]), lambda end: F.struct(
        end.alias("at"), F.lit(0).alias("is_base"), h["start"].alias("start"), end.alias("end"),
        h["value"].alias("value")))).cast(event)
    starts = F.transform(base, lambda b: F.struct(
        b["start"].alias("at"), F.lit(1).alias("is_base"), b["start"].alias("start"), b["end"].alias("end"),
        F.lit(None).cast("string").alias("value"))).cast(event)

    def free(events: Column) -> Column:
        reach = prefix_fold(F.transform(events, lambda e: F.when(e["is_base"] == 1, e["end"]).otherwise(0)),
                            lambda s, x: F.greatest(s, x))
        return let(reach, lambda r: F.filter(
            events, lambda e, i: (e["is_base"] == 0) & (F.get(r, i) <= e["start"])))

    return let(F.array_sort(F.concat(ends, starts)), free)


def random_spans(text: Column, base: Column) -> Column:
    """Spans of kind ``random`` that survive the battery and false-discovery control.

    A token's p-value is p_text / p_random: never below p_text, so it keeps its
    rate of false discoveries among ordinary text, and a token that any of the
    three tests finds unlike random needs as much more evidence. Tokens with
    p_random below RANDOM_LEAST are no secrets whatever p_text is.
    """
    def control(tests: Column) -> Column:
        def with_mean(mean: Column) -> Column:
            return F.array_sort(F.transform(tests, lambda t: F.struct(
                (t["p"] * mean / (t["end"] - t["start"])).alias("p"), t["start"].alias("start"),
                t["end"].alias("end"), t["looks_random"].alias("looks_random"))))

        m = F.size(tests).cast("double")
        weighted = let(F.aggregate(tests, F.lit(0.0), lambda s, t: s + (t["end"] - t["start"])) / m, with_mean)

        def cut(w: Column) -> Column:
            last = F.array_max(F.transform(w, lambda t, i: F.when(
                t["p"] <= F.lit(FALSE_DISCOVERY) * (i + 1) / m, i).otherwise(F.lit(-1))))
            return F.transform(F.filter(F.slice(w, 1, last + 1), lambda t: t["looks_random"]),
                               lambda t: F.struct(t["start"].alias("start"), F.lit(3).alias("kind_no"),
                                                  t["end"].alias("end"), F.lit("random").alias("kind"))).cast(SPAN)
        return F.when(m == 0, F.array().cast(SPAN)).otherwise(let(weighted, cut))

    tests = F.transform(_untouched(matches(text, TOKEN), base), lambda h: let(battery(h["value"]), lambda r: F.struct(
        h["start"].alias("start"), h["end"].alias("end"), (r["p_text"] / r["p_random"]).alias("p"),
        (r["p_random"] >= RANDOM_LEAST).alias("looks_random"))))
    return let(tests, control)


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, counts of base spans, their digest, and all spans of every row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    assign, access, hexes = base_spans(F.col("text"))
    found = let(F.struct(assign.alias("assign"), access.alias("access"), hexes.alias("hex")), lambda b: let(
        F.concat(b["assign"], b["access"], b["hex"]), lambda base: F.struct(
            F.size(b["assign"]).cast("bigint").alias("n_assign"), F.size(b["access"]).cast("bigint").alias("n_access"),
            F.size(b["hex"]).cast("bigint").alias("n_hex"), F.sha2(_listed(base), 256).alias("base_sha256"),
            _listed(F.concat(base, random_spans(F.col("text"), base))).alias("spans"))))
    return rows.select("doc_id", found.alias("found")).select("doc_id", "found.*")
