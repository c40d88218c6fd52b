"""Language identification by word-first backoff.

A known word scores by its log frequency in each language. A word that is not
known backs off to its character n-grams (word ends marked): the known
4-grams, else the known 3-grams, then 2-grams, then single characters, scored
by their mean log frequency. A text's score vector is the sum over its words,
divided by the square root of their number before it becomes probabilities.

The model is counted by Spark over a bounded sample of labelled rows
(``samples.CLASS_ROWS`` per language); every whole text is scored in Arrow
batches without a shuffle.

Defined cases: NULL text or text without a letter is ``und`` with score 0;
repeated rows give equal rows; without any labelled row everything is ``und``;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import samples
from tillroll.llm.common import bounded_arrow_batches

UNKNOWN = "und"
LONGEST_GRAM = 4
WORD_LEAST = 3      # times a word must occur in the sample to be known
GRAM_LEAST = 2
SMOOTHING = 0.5
MEMO_WORDS = 200_000
TOTAL = ""
LETTERS = re.compile(r"[^\W\d_]+")


def text_words(text: str) -> list[str]:
    return LETTERS.findall(text.lower())


def grams(word: str, n: int) -> list[str]:
    if n == 1:
        return list(word)
    marked = f"\x02{word}\x03"
    return [marked[i:i + n] for i in range(len(marked) - n + 1)]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, n, gram, count) per batch; n = 0 are whole words, TOTAL counts all of a length."""
    for batch in batches:
        found: Counter = Counter()
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            for word, k in Counter(text_words(text)).items():
                found[lang, 0, word] += k
                found[lang, 0, TOTAL] += k
                for n in range(1, LONGEST_GRAM + 1):
                    parts = grams(word, n)
                    found[lang, n, TOTAL] += k * len(parts)
                    for g in parts:
                        found[lang, n, g] += k
        if found:
            lang, n, gram = map(list, zip(*found))
            yield pa.RecordBatch.from_arrays(
                [pa.array(lang, pa.string()), pa.array(n, pa.int32()), pa.array(gram, pa.string()),
                 pa.array(list(found.values()), pa.int64())], names=["lang", "n", "gram", "k"])


def fit(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        lang_col: str = "lang", train: Column | None = None) -> dict:
    """Model from labelled rows: langs, per length n the rows of its n-grams, their logs.

    ``train`` limits the rows to learn from. The sample is bounded, so the
    table of its words and n-grams is too.
    """
    bounded_arrow_batches(spark)
    rows = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    if train is not None:
        rows = rows.filter(train)
    sample = samples.per_class(rows, lang_col, id_col)
    counted = (sample.select(F.col(lang_col).alias("lang"), samples.sample_text(F.col(text_col), F.col(id_col)).alias("text"))
               .mapInArrow(_count, "lang string, n int, gram string, k bigint")
               .groupBy("n", "gram").agg(F.sum("k").alias("total"),
                                         F.collect_list(F.struct("lang", "k")).alias("by_lang"))
               .filter((F.col("gram") == TOTAL) | (F.col("total") >= F.when(F.col("n") == 0, WORD_LEAST).otherwise(GRAM_LEAST))))
    found = counted.select("n", "gram", F.explode("by_lang").alias("e")).select("n", "gram", "e.lang", "e.k").toArrow()
    langs = sorted(found.column("lang").unique().to_pylist())
    place = {lang: i for i, lang in enumerate(langs)}
    rows: list[dict[str, int]] = [{} for _ in range(LONGEST_GRAM + 1)]
    size, at, lang_at = 0, [], []
    for batch in found.to_batches(max_chunksize=1 << 16):  # flat columns, a slice at a time
        for n, gram, lang in zip(*(batch.column(c).to_pylist() for c in ("n", "gram", "lang"))):
            row = rows[n].setdefault(gram, size)
            size += row == size
            at.append(row)
            lang_at.append(place[lang])
    table = np.zeros((size, len(langs)), np.float32)
    np.add.at(table, (np.array(at, np.int64), np.array(lang_at, np.int64)), found.column("k").to_numpy())
    logs = np.zeros_like(table)
    for known in rows:
        totals = table[known.pop(TOTAL)] if TOTAL in known else np.zeros(len(langs))
        own = np.fromiter(known.values(), np.int64, len(known))
        logs[own] = np.log((table[own] + SMOOTHING) / (totals + SMOOTHING * max(1, len(own))))
    return {"langs": langs, "rows": rows, "logs": logs}


class Scorer:
    """Scores texts by a fitted model; keeps a bounded memo of word vectors."""

    def __init__(self, model: dict):
        self.langs, self.rows, self.logs = model["langs"], model["rows"], model["logs"]
        self._reset()

    def _reset(self) -> None:
        self.place: dict[str, int] = {}
        self.vectors = np.zeros((4096, len(self.langs)), np.float32)

    def known_rows(self, word: str) -> list[int]:
        """Rows of the model that score a word: its own, or its longest known n-grams."""
        own = self.rows[0].get(word)
        if own is not None:
            return [own]
        for n in range(LONGEST_GRAM, 0, -1):
            get = self.rows[n].get
            found = [r for r in map(get, grams(word, n)) if r is not None]
            if found:
                return found
        return []

    def _learn(self, words: list[str]) -> None:
        place = self.place
        new = [w for w in dict.fromkeys(words) if w not in place]
        if len(place) + len(new) > MEMO_WORDS:
            self._reset()
            place, new = self.place, list(dict.fromkeys(words))
        first, need = len(place), len(place) + len(new)
        if need > len(self.vectors):
            grown = np.zeros((max(need, 2 * len(self.vectors)), len(self.langs)), np.float32)
            grown[:first] = self.vectors[:first]
            self.vectors = grown
        flat, ends = [], []
        for w in new:
            place[w] = len(place)
            flat += self.known_rows(w)
            ends.append(len(flat))
        sums = np.concatenate([np.zeros((1, len(self.langs))), np.cumsum(self.logs[flat], axis=0, dtype=np.float64)])
        stops = np.array(ends, np.int64)
        starts = np.concatenate([[0], stops[:-1]])
        self.vectors[first:need] = (sums[stops] - sums[starts]) / np.maximum(stops - starts, 1)[:, None]

    def predict(self, text: str | None) -> tuple[str, float]:
        words = text_words(text) if text else []
        if not words or not self.langs or not any(c.isalpha() for w in words for c in w):
            return UNKNOWN, 0.0
        try:
            at = list(map(self.place.__getitem__, words))
        except KeyError:
            self._learn(words)
            at = list(map(self.place.__getitem__, words))
        total = self.vectors[at].sum(0, dtype=np.float64) / np.sqrt(len(words))
        p = np.exp(total - total.max())
        p /= p.sum()
        best = int(p.argmax())
        return self.langs[best], float(p[best])


def predictor(spark: SparkSession, model: dict):
    """Vectorized UDF text -> struct(lang_pred, score)."""
    shared = spark.sparkContext.broadcast(model)
    bounded_arrow_batches(spark)

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(shared.value)
        for batch in texts:
            yield pd.DataFrame([scorer.predict(t) for t in batch], columns=["lang_pred", "score"])

    return predict


def identify(spark: SparkSession, docs: DataFrame, model: dict, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    predict = predictor(spark, model)
    return docs.select(F.col(id_col).alias("doc_id"), predict(F.col(text_col)).alias("p")) \
        .select("doc_id", "p.lang_pred", "p.score")
