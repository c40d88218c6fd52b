"""Quality classifier: random-indexing word vectors and a two-layer network.

Tokens are words, numbers, punctuation runs and line ends. A token seen often
in the sample is its own type; others fall into a type by shape (lower,
UPPER, Title, mixed, number, punctuation). Every type has a fixed sparse
random index vector drawn from its name; its word vector is the sum of the
index vectors of its neighbours within two places, over the sample, with
logarithmic damping. A document pools its tokens' word vectors and nothing
else: their mean, their second moment, and the mean products of vectors one and
two tokens apart, which see order and repetition. A two-layer numpy network
scores the pooled vectors, and a temperature fitted on a validation part makes
the scores probabilities.

Fitting reads a bounded sample of labelled rows (``samples.CLASS_ROWS`` per
label; of a text above ``samples.SAMPLE_TEXT_BYTES`` a seeded slice); every
whole text is scored in Arrow batches without a shuffle.

Defined cases: NULL text counts as empty and gets the empty text's score;
repeated label rows of a document count once (the larger label); without two
labels to learn from every score is the share of label 1 (0.5 without labels);
an empty table gives no rows; other columns are not read; ids may be of any
type with a text form.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import samples
from tillroll.llm.common import bounded_arrow_batches

TOKENS = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+|\n")
DIMENSIONS = 64
NONZERO = 6
WINDOW = 2
TYPE_LEAST = 20
HIDDEN = 24
EPOCHS = 60
BATCH = 64
CUT = 0.3
MEMO_TOKENS = 200_000
LAGS = (1, 2)
FEATURES = DIMENSIONS * (2 + len(LAGS))
# Tokens whose vectors are held at once while a long text is pooled.
POOL_TOKENS = 1 << 14
# The sampled ids are broadcast up to this many rows, some twenty times what two labels give.
SAMPLE_BROADCAST_ROWS = 1 << 16


def shape(token: str) -> str:
    if token == "\n":
        return "<line>"
    if token[0].isdigit():
        return "<number>"
    if not token[0].isalpha():
        return f"<punct {min(len(token), 4)}>"
    if len(token) > 1 and token.isupper():
        return "<UPPER>"
    if token.islower():
        return "<lower>"
    return "<Title>" if token.istitle() else "<mixed>"


def index_vector(name: str) -> np.ndarray:
    """Sparse ternary vector that depends on the type's name alone."""
    rng = np.random.default_rng(zlib.crc32(name.encode()))
    out = np.zeros(DIMENSIONS)
    at = rng.choice(DIMENSIONS, NONZERO, replace=False)
    out[at] = rng.choice([-1.0, 1.0], NONZERO)
    return out


class Pooler:
    """Types, word vectors and pooled document features."""

    def __init__(self, types: dict[str, int], vectors: np.ndarray):
        self.types, self.vectors = types, vectors
        # the last row is that of tokens without a type
        self.padded = np.vstack([vectors, np.zeros((1, DIMENSIONS))])
        self.memo: dict[str, int] = {}

    @classmethod
    def fit(cls, texts: list[str]) -> Pooler:
        counts: Counter = Counter()
        for t in texts:
            counts.update(TOKENS.findall(t))
        names = sorted({w for w, k in counts.items() if k >= TYPE_LEAST} | {shape(w) for w in counts})
        types = {name: i for i, name in enumerate(names)}
        index = np.array([index_vector(n) for n in names]).reshape(-1, DIMENSIONS)
        context = np.zeros((len(names), DIMENSIONS))
        pooler = cls(types, context)
        for t in texts:
            at = pooler.ids(TOKENS.findall(t))
            for d in range(1, WINDOW + 1):
                np.add.at(context, at[d:], index[at[:-d]])
                np.add.at(context, at[:-d], index[at[d:]])
        context = np.sign(context) * np.log1p(np.abs(context))
        norms = np.linalg.norm(context, axis=1, keepdims=True)
        return cls(types, context / np.where(norms > 0, norms, 1))

    def ids(self, tokens: list[str]) -> np.ndarray:
        memo = self.memo
        try:
            return np.fromiter(map(memo.__getitem__, tokens), np.int64, len(tokens))
        except KeyError:
            if len(memo) > MEMO_TOKENS:
                memo.clear()
            for w in set(tokens):
                if w not in memo:
                    at = self.types.get(w)
                    memo[w] = at if at is not None else self.types.get(shape(w), len(self.vectors))
        return np.fromiter(map(memo.__getitem__, tokens), np.int64, len(tokens))

    def features(self, text: str | None) -> np.ndarray:
        """Mean, second moment and lagged products of the word vectors, pooled over the whole text."""
        at = self.ids(TOKENS.findall(text or ""))
        sums = np.zeros((2 + len(LAGS), DIMENSIONS))
        for start in range(0, len(at), POOL_TOKENS):
            own = min(start, LAGS[-1])  # rows before ``own`` were pooled with the chunk before
            rows = self.padded[at[start - own:start + POOL_TOKENS]]
            sums[0] += rows[own:].sum(0)
            for i, lag in enumerate((0, *LAGS), 1):
                first = max(own, lag)
                if first < len(rows):
                    sums[i] += np.einsum("ij,ij->j", rows[first:], rows[first - lag:len(rows) - lag])
        return sums.ravel() / max(1, len(at))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_network(x: np.ndarray, y: np.ndarray, seed: int = 7) -> dict:
    """Two-layer network trained with Adam, then a temperature on held-back rows."""
    rng = np.random.default_rng(seed)
    mean, std = x.mean(0), x.std(0) + 1e-6
    x = (x - mean) / std
    order = rng.permutation(len(x))
    held = order[: max(1, len(x) // 5)]
    train = order[len(held):] if len(x) > 1 else order
    p = {"w1": rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), "b1": np.zeros(HIDDEN),
         "w2": rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), "b2": np.zeros(1)}
    m, v = ({k: np.zeros_like(a) for k, a in p.items()} for _ in range(2))
    step = 0
    for _ in range(EPOCHS):
        rng.shuffle(train)
        for at in range(0, len(train), BATCH):
            rows = train[at:at + BATCH]
            h = np.tanh(x[rows] @ p["w1"] + p["b1"])
            err = (_sigmoid(h @ p["w2"] + p["b2"]) - y[rows]) / len(rows)
            back = np.outer(err, p["w2"]) * (1 - h * h)
            grads = {"w1": x[rows].T @ back + 1e-4 * p["w1"], "b1": back.sum(0),
                     "w2": h.T @ err + 1e-4 * p["w2"], "b2": err.sum(keepdims=True)}
            step += 1
            for k, g in grads.items():
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                p[k] = p[k] - 0.003 * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
    logit = np.tanh(x[held] @ p["w1"] + p["b1"]) @ p["w2"] + p["b2"]

    # Platt's targets: separable rows must not drive the temperature to zero and the scores to ties
    ones = y[held].sum()
    target = np.where(y[held] > 0, (ones + 1) / (ones + 2), 1 / (len(held) - ones + 2))

    def loss(t: float) -> float:
        q = np.clip(_sigmoid(logit / t), 1e-9, 1 - 1e-9)
        return float(-(target * np.log(q) + (1 - target) * np.log(1 - q)).mean())

    p["temperature"] = min(np.geomspace(0.02, 50, 160), key=loss)
    return p | {"mean": mean, "std": std}


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", train: Column | None = None) -> dict:
    """Fit word vectors and network on a bounded sample of labelled rows."""
    marked = labels.filter(F.col(label_col).isNotNull()).groupBy(id_col).agg(F.max(label_col).alias("label"))
    if train is not None:
        marked = marked.filter(train)
    chosen = samples.per_class(marked, "label", id_col)
    # about CLASS_ROWS ids per label, so the documents need no shuffle while the labels are few
    if chosen.count() <= SAMPLE_BROADCAST_ROWS:
        chosen = F.broadcast(chosen)
    rows = docs.select(id_col, samples.sample_text(F.col(text_col), F.col(id_col)).alias("text")) \
        .join(chosen, id_col).select(id_col, "text", "label")
    found = sorted(rows.toPandas().itertuples(index=False, name=None), key=lambda r: (str(r[0]), r[1]))
    texts = [text for _, text, _ in found]
    y = np.array([label for _, _, label in found], dtype=float)
    pooler = Pooler.fit(texts)
    if len(set(y)) < 2:
        return {"types": pooler.types, "vectors": pooler.vectors, "share": float(y.mean()) if len(y) else 0.5}
    x = np.array([pooler.features(t) for t in texts])
    # classes are sampled evenly; the counts restore their real shares
    counts = {r["label"]: r["count"] for r in marked.groupBy("label").count().collect()}  # one row per label
    real = counts.get(1, 0) / max(1, sum(counts.values()))
    shift = np.log(real / (1 - real)) - np.log(y.mean() / (1 - y.mean())) if 0 < real < 1 else 0.0
    return {"types": pooler.types, "vectors": pooler.vectors, "net": fit_network(x, y), "shift": float(shift)}


def score_texts(model: dict, pooler: Pooler, texts) -> np.ndarray:
    if "net" not in model:
        return np.full(len(texts), model["share"])
    net = model["net"]
    x = (np.array([pooler.features(t) for t in texts]).reshape(-1, FEATURES) - net["mean"]) / net["std"]
    logit = np.tanh(x @ net["w1"] + net["b1"]) @ net["w2"] + net["b2"]
    return _sigmoid(logit / net["temperature"] + model["shift"])


def score(spark: SparkSession, docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text",
          cut: float = CUT) -> DataFrame:
    """doc_id, score, predicted of every row."""
    shared = spark.sparkContext.broadcast(model)
    bounded_arrow_batches(spark)

    @F.pandas_udf("double")
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = shared.value
        pooler = Pooler(own["types"], own["vectors"])
        for batch in texts:
            yield pd.Series(score_texts(own, pooler, batch.tolist()), dtype="float64")

    return docs.select(F.col(id_col).alias("doc_id"), scored(F.col(text_col)).alias("score")) \
        .withColumn("predicted", F.when(F.col("score") >= cut, 1).otherwise(0))
