"""Quality classifier: random-indexing word vectors, pooled, and a two-layer network."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import binary, gram_hashes, id_key, id_value
from tabloom.session import materialize

BUCKETS, WIDTH, REACH = 1 << 14, 64, 2
_SHAPES = 6
FEATURES = WIDTH + _SHAPES + 4
_TOKEN = re.compile(r"[^\W\d_]+|\d+|_+|[^\w\s]+")
_FIT_TASKS = 8
_CACHED_TOKENS = 400_000


class TokenCodes(dict):
    """Token -> bucket of its lower-case form and class of its shape, in one integer."""

    def __missing__(self, token: str) -> int:
        bucket = zlib.crc32(token.lower().encode()) % BUCKETS
        if token[0].isdigit():
            shape = 0
        elif not token[0].isalpha():
            shape = 1 if len(token) == 1 else 2
        elif token.islower():
            shape = 3
        else:
            shape = 5 if len(token) > 1 and token.isupper() else 4
        value = self[token] = bucket * _SHAPES + shape
        return value

    def of(self, text: str) -> np.ndarray:
        if len(self) > _CACHED_TOKENS:
            self.clear()
        tokens = _TOKEN.findall(text)
        return np.fromiter(map(self.__getitem__, tokens), np.int64, len(tokens))


def index_vectors() -> np.ndarray:
    """The sparse random vector of each bucket: four times +1 and four times -1."""
    random = np.random.default_rng(20)
    out = np.zeros((BUCKETS, WIDTH), np.float32)
    places = np.argsort(random.random((BUCKETS, WIDTH)), axis=1)[:, :8]
    rows = np.arange(BUCKETS)[:, None]
    out[rows, places[:, :4]] = 1
    out[rows, places[:, 4:]] = -1
    return out


def add_contexts(sums: np.ndarray, buckets: np.ndarray, index: np.ndarray) -> None:
    """Add to each word's row the index vectors of the words up to REACH beside it."""
    for begin in range(0, len(buckets), 50_000):
        part = buckets[begin : begin + 50_000 + REACH]
        for step in range(1, REACH + 1):
            left, right = part[:-step], part[step:]
            for word, other in ((left, right), (right, left)):
                order = np.argsort(word, kind="stable")
                ordered = word[order]
                if len(ordered):
                    starts = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
                    sums[ordered[starts]] += np.add.reduceat(
                        index[other[order]], starts, axis=0
                    )


def word_vectors(sums: np.ndarray, index: np.ndarray) -> np.ndarray:
    """Unit vectors: the own index vector and the mean direction of the contexts."""
    size = np.linalg.norm(sums, axis=1, keepdims=True)
    out = index / np.sqrt(8) + np.divide(sums, size, out=np.zeros_like(sums), where=size > 0)
    return (out / np.linalg.norm(out, axis=1, keepdims=True)).astype(np.float32)


def pool(codes: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """A document's features: mean word vector, shapes, and how much it repeats."""
    out = np.zeros(FEATURES)
    n = len(codes)
    if not n:
        return out
    buckets, shapes = np.divmod(codes, _SHAPES)
    for begin in range(0, n, 65_536):
        out[:WIDTH] += vectors[buckets[begin : begin + 65_536]].sum(0)
    out[:WIDTH] /= n
    out[WIDTH : WIDTH + _SHAPES] = np.bincount(shapes, minlength=_SHAPES) / n
    runs = gram_hashes(codes.astype(np.uint64), 3) if n >= 3 else codes
    out[-4:] = (
        np.linalg.norm(out[:WIDTH]),
        np.log1p(n) / 10,
        len(np.unique(buckets)) / n,
        len(np.unique(runs)) / len(runs),
    )
    return out


@dataclass
class Network:
    """Two layers; probabilities are the sigmoid of the output over a temperature."""

    mean: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray] = field(default_factory=list)
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        hidden = np.tanh(((x - self.mean) / self.scale) @ w1 + b1)
        return (hidden @ w2 + b2)[:, 0]

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        z = np.clip(self.logits(x) / self.temperature, -30, 30)
        return 1 / (1 + np.exp(-z))


def fit_network(
    x: np.ndarray, y: np.ndarray, hidden: int = 32, epochs: int = 60, seed: int = 3
) -> Network:
    """Adam on the log loss; every fifth row is kept back to set the temperature."""
    back = np.arange(len(x)) % 5 == 4
    xs, ys = x[~back], y[~back].astype(float)
    random = np.random.default_rng(seed)
    net = Network(xs.mean(0), xs.std(0) + 1e-3)
    net.weights = [
        random.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], hidden)),
        np.zeros(hidden),
        random.normal(0, 1 / np.sqrt(hidden), (hidden, 1)),
        np.zeros(1),
    ]
    first = [np.zeros_like(w) for w in net.weights]
    second = [np.zeros_like(w) for w in net.weights]
    inputs = (xs - net.mean) / net.scale
    step = 0
    for _ in range(epochs):
        for rows in np.array_split(random.permutation(len(xs)), -(-len(xs) // 128)):
            step += 1
            w1, b1, w2, b2 = net.weights
            a = inputs[rows]
            h = np.tanh(a @ w1 + b1)
            p = 1 / (1 + np.exp(-np.clip((h @ w2 + b2)[:, 0], -30, 30)))
            error = ((p - ys[rows]) / len(rows))[:, None]
            inner = (error @ w2.T) * (1 - h * h)
            slopes = [
                a.T @ inner + 1e-4 * w1, inner.sum(0),
                h.T @ error + 1e-4 * w2, error.sum(0),
            ]
            for w, g, m, v in zip(net.weights, slopes, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                rate = 3e-3 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                w -= rate * m / (np.sqrt(v) + 1e-8)
    if back.any():
        z, truth = net.logits(x[back]), y[back]
        losses = {
            t: np.mean(np.logaddexp(0, np.where(truth == 1, -z, z) / t))
            for t in np.geomspace(0.25, 8, 61)
        }
        net.temperature = float(min(losses, key=losses.get))
    return net


@dataclass
class Model:
    vectors: np.ndarray
    network: Network | None
    constant: float = 0.5

    def score(self, features: np.ndarray) -> np.ndarray:
        if self.network is None:
            return np.full(len(features), self.constant)
        return self.network.probabilities(features)


def training_ids(
    labels: DataFrame, rows: int, id_column: str, label_column: str
) -> DataFrame:
    """Up to ``rows`` labelled ids that may be learnt from, chosen by a hash of the id.

    Ids whose crc32 leaves 2 modulo 4 are held out. Null ids and null labels
    are left out; an id with several labels gets their rounded mean.
    """
    return (
        labels.where(F.col(id_column).isNotNull() & F.col(label_column).isNotNull())
        .where(~held_out(F.col(id_column)))
        .groupBy(F.col(id_column).cast("long").alias("key"))
        .agg(F.round(F.avg(label_column)).cast("int").alias("label"))
        .orderBy(F.xxhash64("key"), "key")
        .limit(rows)
    )


def held_out(key):
    """Null ids count as held out."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(True))


def train(
    docs: DataFrame,
    labels: DataFrame,
    sample_rows: int = 6000,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
) -> Model:
    """Fit vectors and network on at most ``sample_rows`` labelled documents.

    Word vectors come from the same documents; tasks return sums of fixed
    size. Without labelled rows, or with one label only, the model is constant
    (0.5, or that label). Only texts are inputs.
    """
    chosen = training_ids(labels, sample_rows, id_column, label_column)
    sample = (
        docs.select(
            F.col(id_column).cast("long").alias("key"), F.col(text_column).alias("text")
        )
        .join(F.broadcast(chosen), "key")  # sample_rows bounds it
        .select("key", "label", "text")
    )
    # The table is read by as many tasks as it has parts; the sample by a few.
    picked = materialize(sample, "labelled-sample").repartition(_FIT_TASKS)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, codes = index_vectors(), TokenCodes()
        out = np.zeros((BUCKETS, WIDTH), np.float32)
        for batch in batches:
            for text in batch.column("text").to_pylist():
                add_contexts(out, codes.of(text or "") // _SHAPES, index)
        yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()])], ["sums"])

    total = np.zeros((BUCKETS, WIDTH), np.float32)
    for row in picked.mapInArrow(sums, "sums binary").toLocalIterator():
        total += np.frombuffer(row["sums"], np.float32).reshape(total.shape)
    vectors = word_vectors(total, index_vectors())
    shared = docs.sparkSession.sparkContext.broadcast(vectors)  # a fixed 4 MB

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = TokenCodes()
        for batch in batches:
            rows = [
                pool(codes.of(t or ""), shared.value).tobytes()
                for t in batch.column("text").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("label"), pa.array(rows, pa.binary())],
                ["key", "label", "x"],
            )

    found = picked.mapInArrow(features, "key long, label int, x binary").toPandas()
    found = found.drop_duplicates("key").sort_values("key")
    y = found["label"].to_numpy()
    if len(np.unique(y)) < 2:
        return Model(vectors, None, float(y[0]) if len(y) else 0.5)
    x = np.stack([np.frombuffer(r) for r in found["x"]])
    order = np.random.default_rng(1).permutation(len(x))
    return Model(vectors, fit_network(x[order], y[order]))


def score(
    docs: DataFrame,
    model: Model,
    threshold: float = 0.7,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``id_column``, ``score`` (0 to 1) and ``predicted`` of every whole text.

    A null or empty text is scored as a text without words; rows that repeat
    get equal scores; null ids stay null; an empty table gives an empty table;
    other columns are left out and never influence a score.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a fixed 4 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, own = TokenCodes(), shared.value
        for batch in batches:
            texts = binary(batch.column("text"))
            x = np.zeros((len(texts), FEATURES))
            for i, text in enumerate(texts):
                x[i] = pool(codes.of(text.decode()), own.vectors)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(own.score(x), pa.float64())],
                ["key", "score"],
            )

    rows = docs.select(id_key(id_column).alias("key"), F.col(text_column).alias("text"))
    return rows.mapInArrow(run, "key long, score double").select(
        id_value("key").alias(id_column),
        "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"),
    )


def accepted(
    docs: DataFrame, model: Model, threshold: float = 0.7, text_column: str = "text"
) -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores ``threshold`` or more."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def of_text(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codes = TokenCodes()
        for texts in parts:
            x = [pool(codes.of(t or ""), shared.value.vectors) for t in texts]
            yield pd.Series(shared.value.score(np.stack(x)) if x else [], dtype=float)

    return docs.where(of_text(F.col(f"`{text_column}`")) >= threshold)
