"""Text quality: random-indexing word vectors pooled per document, then a small calibrated network in numpy."""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.llm.common import free_name, map_texts, text_runs
from tagloom.session import written

# Words share this many vectors by hash, so that the table has a fixed size however large the vocabulary grows.
BUCKETS = 1 << 14
DIMS = 32
# A word's index vector has this many entries of +1 or -1.
ENTRIES = 4
# A word's context: so many words on either side.
WINDOW = 2
# The network is fitted on at most this many labelled documents, those with the smallest hash of their id.
MAX_LABELLED = 8_000
HIDDEN = 24
EPOCHS = 60
BATCH = 64
SEED = 20240601
REMEMBERED = 300_000
WORD = re.compile(r"\w+|[^\w\s]+")


class _Buckets(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        found = self[word] = zlib.crc32(word.encode()) % BUCKETS
        return found


def _word_ids(text: str, buckets: _Buckets) -> Iterator[np.ndarray]:
    for run in text_runs(text):
        yield np.array([buckets[word] for word in WORD.findall(run)], np.int64)


def _index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the entries of each bucket's index vector."""
    random = np.random.RandomState(SEED)
    places = np.argsort(random.random_sample((BUCKETS, DIMS)), axis=1)[:, :ENTRIES]
    return places.astype(np.int64), random.choice(np.array([-1, 1], np.int64), (BUCKETS, ENTRIES))


def word_vectors(docs: DataFrame, text: str = "text") -> np.ndarray:
    """One unit vector for each bucket of words: the sum of the index vectors found beside them in the whole corpus.

    Each task adds up its own table of fixed size in whole numbers and the
    tables are summed by bucket, so the result does not depend on how the
    corpus is split. A word's context ends at the ends of its text and, in a
    text of over a megabyte, where one piece (``text_runs``) ends and at every
    65,536th word of a piece: of the pairs of neighbours there at most
    ``2 * WINDOW - 1`` are not counted.
    """
    names = [f"v{n}" for n in range(DIMS)]
    schema = T.StructType([T.StructField("bucket", T.IntegerType()), *[T.StructField(n, T.LongType()) for n in names]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, signs = _index_vectors()
        table, buckets = np.zeros(BUCKETS * DIMS, np.int64), _Buckets()

        def add(words: np.ndarray) -> None:
            for away in range(1, WINDOW + 1):
                a, b = words[:-away], words[away:]
                for word, beside in ((a, b), (b, a)):
                    np.add.at(table, (word[:, None] * DIMS + places[beside]).ravel(), signs[beside].ravel())

        for batch in batches:
            for value in batch.column(0):
                for words in _word_ids(value.as_py() or "", buckets):
                    for at in range(0, len(words), 1 << 16):
                        add(words[at : at + (1 << 16)])
        table = table.reshape(BUCKETS, DIMS)
        used = np.flatnonzero(table.any(axis=1))
        columns = [pa.array(used, pa.int32()), *[pa.array(table[used, n]) for n in range(DIMS)]]
        yield pa.RecordBatch.from_arrays(columns, ["bucket", *names])

    rows = docs.select(F.col(text).alias("text")).mapInArrow(run, schema)
    summed = rows.groupBy("bucket").agg(*[F.sum(name).alias(name) for name in names])
    table = np.zeros((BUCKETS, DIMS), np.float32)
    for row in summed.collect():  # at most BUCKETS rows
        table[row[0]] = row[1:]
    norms = np.linalg.norm(table, axis=1, keepdims=True)
    return table / np.where(norms > 0, norms, 1)


# Pooled per document: mean, spread, and mean distance from one word's vector to the next, which repetition brings to zero.
FEATURES = 3 * DIMS


def pooled(texts: list[str], vectors: np.ndarray, buckets: _Buckets) -> np.ndarray:
    """Mean, spread and mean step of the word vectors of each whole text; zeros for a text without words."""
    out = np.zeros((len(texts), FEATURES), np.float32)
    for row, text in enumerate(texts):
        total, squares, steps, n, last = np.zeros(DIMS), np.zeros(DIMS), np.zeros(DIMS), 0, np.zeros((0, DIMS), np.float32)
        for words in _word_ids(text, buckets):
            for at in range(0, len(words), 1 << 16):
                found = vectors[words[at : at + (1 << 16)]]
                total += found.sum(axis=0)
                squares += np.einsum("ij,ij->j", found, found)
                steps += np.abs(np.diff(np.concatenate([last, found]), axis=0)).sum(axis=0)
                n, last = n + len(found), found[-1:]
        if n:
            mean = total / n
            out[row, :DIMS] = mean
            out[row, DIMS : 2 * DIMS] = np.sqrt(np.maximum(squares / n - mean * mean, 0))
            out[row, 2 * DIMS :] = steps / max(1, n - 1)
    return out


@dataclass
class Network:
    """Two layers over standardised features; ``temperature`` scales the logit so that scores are probabilities."""

    weights: list[np.ndarray] = field(default_factory=list)
    centre: np.ndarray | None = None
    scale: np.ndarray | None = None
    temperature: float = 1.0
    prior: float = 0.5

    def logits(self, features: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        return np.tanh((features - self.centre) / self.scale @ w1 + b1) @ w2 + b2

    def scores(self, features: np.ndarray) -> np.ndarray:
        if not self.weights:
            return np.full(len(features), self.prior)
        return sigmoid(self.logits(features.astype(np.float64)) / self.temperature)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def fit_network(features: np.ndarray, labels: np.ndarray) -> Network:
    """Adam on the log loss over four fifths of the rows, then the temperature on the rest.

    Without rows of both kinds every score is the share of label 1 (0.5 without rows).
    """
    if len(labels) < 5 or len(set(labels.tolist())) < 2:
        return Network(prior=float(labels.mean()) if len(labels) else 0.5)
    random = np.random.RandomState(SEED)
    order = random.permutation(len(labels))
    x, y = features[order].astype(np.float64), labels[order].astype(np.float64)
    cut = max(1, len(y) // 5)
    network = Network(centre=x[cut:].mean(axis=0), scale=x[cut:].std(axis=0) + 1e-3)
    shapes = [(x.shape[1], HIDDEN), (HIDDEN,), (HIDDEN,), ()]
    network.weights = [random.normal(0, 0.15, shape) if at in (0, 2) else np.zeros(shape) for at, shape in enumerate(shapes)]
    z, target = (x[cut:] - network.centre) / network.scale, y[cut:]
    first, second, step = [np.zeros(s) for s in shapes], [np.zeros(s) for s in shapes], 0
    for _ in range(EPOCHS):
        shuffled = random.permutation(len(target))
        for at in range(0, len(target), BATCH):
            rows = shuffled[at : at + BATCH]
            w1, b1, w2, b2 = network.weights
            hidden = np.tanh(z[rows] @ w1 + b1)
            error = (sigmoid(hidden @ w2 + b2) - target[rows]) / len(rows)
            back = np.outer(error, w2) * (1 - hidden * hidden)
            gradients = [z[rows].T @ back + 1e-4 * w1, back.sum(axis=0), hidden.T @ error + 1e-4 * w2, error.sum()]
            step += 1
            for n, gradient in enumerate(gradients):
                first[n] = 0.9 * first[n] + 0.1 * gradient
                second[n] = 0.999 * second[n] + 0.001 * gradient * gradient
                network.weights[n] = network.weights[n] - 0.004 * (first[n] / (1 - 0.9**step)) / (
                    np.sqrt(second[n] / (1 - 0.999**step)) + 1e-8
                )
    logits = network.logits(x[:cut])
    choices = np.exp(np.linspace(np.log(0.25), np.log(8), 120))
    losses = [-np.mean(np.log(np.abs(sigmoid(logits / t) - (1 - y[:cut])) + 1e-12)) for t in choices]
    network.temperature = float(choices[int(np.argmin(losses))])
    return network


@dataclass
class QualityModel:
    vectors: np.ndarray
    network: Network


def held_out(key: Column) -> Column:
    """Whether a document's label is never learned from: CRC-32 of its id as text is divisible by 5. A NULL id is."""
    return F.coalesce(F.crc32(key.cast("string")) % 5 == 0, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> QualityModel:
    """Word vectors from all of ``docs``; the network from at most ``MAX_LABELLED`` labelled documents that aren't held out.

    Labels other than 0 and 1 are ignored, and the smallest counts if an id has several. If an id has several
    texts, one of them is taken.
    """
    vectors = word_vectors(docs, text)
    chosen = (
        labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label"))
        .filter(F.col("label").isin(0, 1) & ~held_out(F.col("key")))
        .groupBy("key")
        .agg(F.min("label").alias("label"))
        .orderBy(F.xxhash64("key"), "key")
        .limit(MAX_LABELLED)
    )
    chosen = written(chosen, "labelled")
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("_text")).join(F.broadcast(chosen), "key")

    def make() -> Callable[[list[str]], list[tuple]]:
        buckets = _Buckets()
        return lambda texts: [(row.tolist(),) for row in pooled(texts, vectors, buckets)]

    made = T.StructType([T.StructField("features", T.ArrayType(T.FloatType()))])
    features = map_texts(rows, "_text", make, made).groupBy("key", "label").agg(F.min("features").alias("features"))
    found = sorted(features.collect())  # at most MAX_LABELLED rows
    x = np.array([row.features for row in found], np.float64).reshape(len(found), FEATURES)
    return QualityModel(vectors, fit_network(x, np.array([row.label for row in found], np.int64)))


def score(
    docs: DataFrame, model: QualityModel, threshold: float = 0.3, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, held_out, score, predicted) of each whole text.

    A NULL or empty text has no words and gets the network's score of nothing.
    NULL and repeated keys are rows like any other; other columns are ignored.
    Nothing is shuffled; the model has a fixed size.
    """

    rows = docs.select(F.col(key), held_out(F.col(key)).alias("held_out"), F.col(text).alias("_text"))
    scored = map_texts(rows, "_text", _scorer(model), SCORED)
    return scored.select(
        key, "held_out", F.col("_score").alias("score"), (F.col("_score") >= threshold).cast("int").alias("predicted")
    )


def accepted(docs: DataFrame, model: QualityModel, threshold: float = 0.3, text: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text scores at least ``threshold``; see ``score``."""
    name = free_name(docs, "_score")
    made = T.StructType([T.StructField(name, T.DoubleType())])
    return map_texts(docs, text, _scorer(model), made, keep_text=True).filter(F.col(name) >= threshold).drop(name)


SCORED = T.StructType([T.StructField("_score", T.DoubleType())])


def _scorer(model: QualityModel) -> Callable[[], Callable[[list[str]], list[tuple]]]:
    def make() -> Callable[[list[str]], list[tuple]]:
        buckets = _Buckets()
        return lambda texts: [(float(s),) for s in model.network.scores(pooled(texts, model.vectors, buckets))]

    return make
