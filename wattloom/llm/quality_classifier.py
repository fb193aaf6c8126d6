"""Document quality from random-indexing word vectors and a small calibrated network.

Words are read as terms: the runs of character classes in a word and its last letters, in a
hashed vocabulary of fixed size. Random indexing gives each term a sparse vector of +1 and
-1 entries by a seeded rule; the vector of a term is the sum of the index vectors of its
neighbours over the whole corpus. Tasks count neighbours in a matrix of fixed size, so the
corpus costs one row per task and term. A document is the mean of its words' vectors and of
their index vectors. A two-layer NumPy network reads these, and a temperature fitted on rows
that the network has not seen calibrates its probabilities.

The network is fitted on at most `max_rows` labelled training rows (the smallest by a hash of
their id); the term vectors cover every document.

Defined results: null and empty text pool to zero and get the network's score for that;
without labels every score is 0.5, with labels of one kind that kind (0.0 or 1.0).
"""

from __future__ import annotations

import re
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.llm.texts import map_arrow, map_rows, raw
from wattloom.llm.toxicity import sample

TERMS, WIDTH = 1024, 48
_CLASS = bytes(ord("x") if 97 <= c <= 122 or c >= 128 else ord("X") if 65 <= c <= 90
               else ord("0") if 48 <= c <= 57 else c for c in range(256))
_RUNS = re.compile(rb"(.)\1+", re.S)


class Terms(dict):
    """Term number of a word, remembered for up to `limit` words."""

    limit = 1_000_000

    def __missing__(self, word: bytes) -> int:
        shape = _RUNS.sub(rb"\1", word.translate(_CLASS))[:12]
        letters = bytes(c for c in word.lower() if c >= 97)[-2:]
        value = crc32(shape + b" " + letters) % TERMS
        if len(self) >= self.limit:
            self.clear()
        self[word] = value
        return value


_TERMS = Terms()


def terms(text: bytes | None) -> np.ndarray:
    words = text.split() if text else []
    return np.fromiter(map(_TERMS.__getitem__, words), np.int64, len(words))


def index_vectors(seed: int = 7, entries: int = 6) -> np.ndarray:
    rng = np.random.default_rng(seed)
    out = np.zeros((TERMS, WIDTH))
    for row in out:
        row[rng.choice(WIDTH, entries, replace=False)] = rng.choice([-1.0, 1.0], entries)
    return out


def word_vectors(docs: DataFrame) -> np.ndarray:
    """TERMS x WIDTH context vectors of unit length, from the neighbours in all documents."""
    def run(batches):
        near = np.zeros(TERMS * TERMS, np.int64)
        for batch in batches:
            for text in raw(batch.column(0)):
                t = terms(text)
                if len(t) > 1:
                    np.add.at(near, t[:-1] * TERMS + t[1:], 1)
        near = near.reshape(TERMS, TERMS)
        near = near + near.T
        summed = near @ index_vectors()
        held = np.flatnonzero(near.any(axis=1))
        yield pa.RecordBatch.from_pydict(
            {"term": held.astype(np.int32),
             "sums": pa.array(list(summed[held]), pa.list_(pa.float64()))})
    sums = map_arrow(docs.select(F.col("text").cast("string").alias("text")), run,
                     "term int, sums array<double>")
    # TERMS rows of WIDTH numbers, whatever the corpus.
    total = sums.groupBy("term").agg(F.array(*[F.sum(F.col("sums")[i]) for i in range(WIDTH)])
                                     .alias("sums")).collect()
    out = np.zeros((TERMS, WIDTH))
    for row in total:
        out[row.term] = row.sums
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def pool(text: bytes | None, table: np.ndarray) -> np.ndarray:
    """The mean of the table's rows over the words of a text."""
    t = terms(text)
    if not len(t):
        return np.zeros(table.shape[1])
    return np.bincount(t, minlength=TERMS) @ table / len(t)


class Network:
    """Input, one hidden layer, one logit; trained by Adam on the whole sample."""

    def __init__(self, x: np.ndarray, y: np.ndarray, hidden: int = 24, steps: int = 400,
                 seed: int = 11):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-3
        self.w = [rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], hidden)), np.zeros(hidden),
                  rng.normal(0, hidden ** -0.5, hidden), np.zeros(1)]
        self.temperature = 1.0
        fold = np.arange(len(x)) % 5 == 4
        fit, calibrate = (~fold, fold) if fold.sum() >= 50 else (np.ones(len(x), bool),) * 2
        z, t = self._scaled(x[fit]), y[fit]
        first, second = [np.zeros_like(w) for w in self.w], [np.zeros_like(w) for w in self.w]
        for step in range(1, steps + 1):
            h = np.tanh(z @ self.w[0] + self.w[1])
            miss = (1 / (1 + np.exp(-np.clip(h @ self.w[2] + self.w[3], -30, 30))) - t) / len(t)
            back = np.outer(miss, self.w[2]) * (1 - h * h)
            grads = [z.T @ back + 1e-4 * self.w[0], back.sum(0), h.T @ miss + 1e-4 * self.w[2],
                     np.array([miss.sum()])]
            for k, g in enumerate(grads):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                self.w[k] = self.w[k] - 0.02 * (first[k] / (1 - 0.9 ** step)) / (
                    np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
        logits, kept = self.logits(x[calibrate]), y[calibrate]
        grid = np.geomspace(0.25, 8, 41)
        losses = [np.mean(np.logaddexp(0, logits / g) - kept * logits / g) for g in grid]
        self.temperature = float(grid[int(np.argmin(losses))])

    def _scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8)

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(self._scaled(x) @ self.w[0] + self.w[1]) @ self.w[2] + self.w[3]

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def in_training(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 != 0


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 12_000):
    """The table of term vectors, and the network or a fixed score."""
    table = np.hstack([word_vectors(docs), index_vectors()])
    rows = sample(docs, labels, "quality", in_training(F.col("doc_id")), max_rows)

    def run(batches):
        for batch in batches:
            yield [(y, pool(t, table).tolist()) for t, y in
                   zip(raw(batch.column(0)), batch.column(1).to_pylist(), strict=True)]
    # At most max_rows short vectors.
    got = sorted(map(tuple, map_rows(rows, "y int, x array<double>", run).collect()))
    if not got:
        return table, 0.5
    y, x = np.array([g[0] for g in got], float), np.array([g[1] for g in got])
    if y.min() == y.max():
        return table, float(y[0])
    mixed = np.random.default_rng(3).permutation(len(y))
    return table, Network(x[mixed], y[mixed])


def score(docs: DataFrame, model) -> DataFrame:
    """The rows and columns of `docs` with `_score`."""
    table, network = model
    schema = docs.withColumn("_score", F.lit(0.0)).schema

    def run(batches):
        for batch in batches:
            texts = raw(batch.column(batch.schema.get_field_index("text")))
            if isinstance(network, float):
                scores = np.full(len(texts), network)
            else:
                scores = network.scores(np.array([pool(t, table) for t in texts])
                                        .reshape(len(texts), table.shape[1]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())],
                                             names=[*batch.schema.names, "_score"])
        _TERMS.clear()  # the worker goes on to other steps
    return map_arrow(docs, run, schema)
