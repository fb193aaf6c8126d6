"""Multi-layer perceptron regression, trained where the data is.

Each round broadcasts the weights, lets every partition run minibatch Adam over
its rows batch by batch, and averages the resulting states by row count on the
cluster (local SGD with parameter averaging). A round is one scan; the driver only
ever holds a state whose size the architecture fixes.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.fixed_values import MLP_EPOCHS, MLP_HOLDOUT, MLP_PATIENCE, SEED

BATCH = 200
L2 = 1e-4
TOL = 1e-4


def _layers(sizes: Sequence[int], flat: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    out, at = [], 0
    for a, b in zip(sizes[:-1], sizes[1:]):
        out.append((flat[at:at + a * b].reshape(a, b), flat[at + a * b:at + a * b + b]))
        at += a * b + b
    return out


def _width(sizes: Sequence[int]) -> int:
    return sum(a * b + b for a, b in zip(sizes[:-1], sizes[1:]))


def _start(sizes: Sequence[int], activation: str, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    factor = 2.0 if activation == "logistic" else 6.0
    parts = []
    for a, b in zip(sizes[:-1], sizes[1:]):
        bound = np.sqrt(factor / (a + b))
        parts += [rng.uniform(-bound, bound, a * b), rng.uniform(-bound, bound, b)]
    return np.concatenate(parts)


def _forward(sizes, flat, x, activation) -> list[np.ndarray]:
    outs = [x]
    layers = _layers(sizes, flat)
    for i, (w, b) in enumerate(layers):
        z = outs[-1] @ w + b
        if i < len(layers) - 1:
            z = np.maximum(z, 0.0) if activation == "relu" else np.tanh(z)
        outs.append(z)
    return outs


def _gradient(sizes, flat, x, y, activation) -> np.ndarray:
    outs = _forward(sizes, flat, x, activation)
    layers = _layers(sizes, flat)
    delta = (outs[-1][:, 0] - y)[:, None] / len(y)
    grads: list[np.ndarray] = []
    for i in range(len(layers) - 1, -1, -1):
        w, _ = layers[i]
        grads[:0] = [(outs[i].T @ delta + L2 * w / len(y)).ravel(), delta.sum(axis=0)]
        if i:
            slope = (outs[i] > 0) if activation == "relu" else 1.0 - outs[i] ** 2
            delta = (delta @ w.T) * slope
    return np.concatenate(grads)


@dataclass
class Network:
    """A fitted network; targets were standardised with (centre, spread)."""
    sizes: list[int]
    activation: str
    weights: list[float]
    centre: float
    spread: float
    rounds: int = 0

    def column(self, features: Sequence[str]) -> Column:
        sizes, act, centre, spread = self.sizes, self.activation, self.centre, self.spread
        flat = np.asarray(self.weights)

        @F.pandas_udf("double")
        def predict(x: pd.DataFrame) -> pd.Series:
            z = _forward(sizes, flat, x.to_numpy(dtype=float), act)[-1][:, 0]
            return pd.Series(z * spread + centre)

        return predict(F.struct(*[F.col(c).cast("double") for c in features]))

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame(
            [(json.dumps(self.sizes), self.activation, [float(w) for w in self.weights],
              self.centre, self.spread, self.rounds)],
            "sizes string, activation string, weights array<double>, centre double, "
            "spread double, rounds int").write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Network:
        r = spark.read.parquet(path).first()
        return cls(json.loads(r["sizes"]), r["activation"], list(r["weights"]), r["centre"],
                   r["spread"], r["rounds"])


def fit(df: DataFrame, features: Sequence[str], y: str, hidden: Sequence[int] = (64, 32),
        activation: str = "relu", learningRate: float = 0.001, epochs: int = MLP_EPOCHS,
        patience: int = MLP_PATIENCE, holdout: float = MLP_HOLDOUT, seed: int = SEED) -> Network:
    """Train until the held-out error stops improving or `epochs` rounds are done."""
    sizes = [len(features), *hidden, 1]
    stats = df.agg(F.avg(y).alias("m"), F.stddev_pop(y).alias("s")).first()
    centre, spread = float(stats["m"]), float(stats["s"] or 1.0) or 1.0
    names = [f"x{i}" for i in range(len(features))]
    pick = F.pmod(F.xxhash64(*[F.col(c) for c in features], F.lit(seed)), F.lit(10000))
    rows = df.select(*[F.col(c).cast("double").alias(n) for c, n in zip(features, names)],
                     ((F.col(y) - centre) / spread).alias("y"),
                     (pick < int(holdout * 10000)).alias("held")).persist()
    width = _width(sizes)
    state = np.concatenate([_start(sizes, activation, seed), np.zeros(2 * width)])
    best, best_error, waited, rounds, steps = state[:width], np.inf, 0, 0, 0
    schema = "n double, held_n double, held_sse double, steps double, state array<double>"
    spark = df.sparkSession
    try:
        for rounds in range(1, epochs + 1):
            sent = spark.sparkContext.broadcast(state)
            start_steps = steps

            def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
                w, m, v = np.array_split(sent.value.copy(), 3)
                base = w.copy()
                n = held_n = held_sse = 0.0
                t = start_steps
                for pdf in batches:
                    x, target = pdf[names].to_numpy(dtype=float), pdf["y"].to_numpy(dtype=float)
                    held = pdf["held"].to_numpy(dtype=bool)
                    if held.any():  # measured with the weights the round began with
                        e = _forward(sizes, base, x[held], activation)[-1][:, 0] - target[held]
                        held_n, held_sse = held_n + held.sum(), held_sse + float(e @ e)
                    x, target = x[~held], target[~held]
                    for i in range(0, len(target), BATCH):
                        g = _gradient(sizes, w, x[i:i + BATCH], target[i:i + BATCH], activation)
                        t += 1
                        m[:] = 0.9 * m + 0.1 * g
                        v[:] = 0.999 * v + 0.001 * g * g
                        w -= (learningRate * (m / (1 - 0.9 ** t))
                              / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8))
                    n += len(target)
                if n or held_n:
                    yield pd.DataFrame({
                        "n": [n], "held_n": [float(held_n)], "held_sse": [held_sse],
                        "steps": [float(t - start_steps)],
                        "state": [np.concatenate([w, m, v])]})

            done = rows.mapInPandas(run, schema).persist()
            sums = done.agg(F.sum("n").alias("n"), F.sum("held_n").alias("hn"),
                            F.sum("held_sse").alias("sse"), F.max("steps").alias("t")).first()
            if not sums["n"]:
                break
            error = (sums["sse"] / sums["hn"]) ** 0.5 if sums["hn"] else 0.0
            if error < best_error - TOL:
                best, best_error, waited = state[:width].copy(), error, 0
            else:
                waited += 1
            mean = (done.select("n", F.posexplode("state").alias("pos", "v")).groupBy("pos")
                    .agg((F.sum(F.col("v") * F.col("n")) / F.sum("n")).alias("v")).toPandas())
            done.unpersist()
            sent.unpersist()
            state = mean.sort_values("pos")["v"].to_numpy()
            steps += int(sums["t"])
            if waited >= patience:
                break
        if not np.isfinite(best_error) or rounds < 2:
            best = state[:width]
    finally:
        rows.unpersist()
    return Network(sizes, activation, [float(w) for w in best], centre, spread, rounds)
