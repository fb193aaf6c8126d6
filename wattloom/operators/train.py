"""Regression models: fitting, tuning, scoring, saving.

Linear fits that differ only in which rows they see (folds, prefixes) share one
scan: the moments of each row segment are aggregated once, and each fit combines
the segments it needs on the driver, where a segment is a few hundred numbers.
"""

from __future__ import annotations

import itertools
import json
import logging
import time
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.regression import (
    LinearRegression, LinearRegressionModel, RandomForestRegressionModel, RandomForestRegressor)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.fixed_values import (
    FOLDS, FOREST_GRID, LEARNING_FRACTIONS, MLP_GRID, SEED, ZERO_COEFFICIENT)
from wattloom.functions.columns import half_even
from wattloom.operators import mlp
from wattloom.operators.evaluate import PREFIX, scores
from wattloom.operators.split import with_vector

log = logging.getLogger(__name__)


# --- one fitted model ----------------------------------------------------------

@dataclass
class Fitted:
    """A model with the name, features and settings it was fitted with."""
    name: str
    features: list[str]
    model: object
    params: dict = field(default_factory=dict)
    cv_rmse: float | None = None
    seconds: float = 0.0
    trials: list[dict] = field(default_factory=list)  # every setting and fold of its grid

    def predict(self, df: DataFrame, column: str | None = None) -> DataFrame:
        column = column or PREFIX + self.name
        if isinstance(self.model, LinearFormula):
            return df.withColumn(column, self.model.column(self.features))
        if isinstance(self.model, mlp.Network):
            return df.withColumn(column, self.model.column(self.features))
        if isinstance(self.model, LinearRegressionModel):  # an expression needs no vectors
            formula = LinearFormula(list(self.model.coefficients), self.model.intercept)
            return df.withColumn(column, formula.column(self.features))
        out = self.model.transform(with_vector(df, self.features, "_features"))
        return out.drop("_features", column).withColumnRenamed("prediction", column)


@dataclass
class LinearFormula:
    """Coefficients as a plain column expression."""
    coefficients: list[float]
    intercept: float

    def column(self, features: Sequence[str]) -> Column:
        terms = [f"({float(b)!r}D * `{c}`)" for b, c in zip(self.coefficients, features)]
        return F.expr(" + ".join([f"{float(self.intercept)!r}D", *terms]))


def fit_linear(df: DataFrame, features: Sequence[str], y: str) -> LinearRegressionModel:
    """Ordinary least squares with an intercept, on the features as they are."""
    learner = LinearRegression(featuresCol="_features", labelCol=y, regParam=0.0,
                               solver="normal", standardization=False)
    return learner.fit(with_vector(df, features, "_features").select("_features", y))


def fit_forest(df: DataFrame, features: Sequence[str], y: str, numTrees: int = 100,
               maxDepth: int = 10, minSplit: int = 5, subsamplingRate: float = 0.5,
               seed: int = SEED) -> RandomForestRegressionModel:
    """A forest over all features per split. A node is split from `minSplit` rows on;
    Spark bounds the children instead, so half of it is the nearest setting."""
    learner = RandomForestRegressor(
        featuresCol="_features", labelCol=y, numTrees=numTrees, maxDepth=maxDepth,
        minInstancesPerNode=max(1, minSplit // 2), subsamplingRate=subsamplingRate,
        featureSubsetStrategy="all", seed=seed)
    return learner.fit(with_vector(df, features, "_features").select("_features", y))


LEARNERS: dict[str, Callable] = {
    "LinearRegression": fit_linear, "RandomForest": fit_forest, "MLPRegressor": mlp.fit}
GRIDS: dict[str, dict] = {
    "LinearRegression": {}, "RandomForest": FOREST_GRID, "MLPRegressor": MLP_GRID}


def combinations_of(grid: dict[str, list]) -> list[dict]:
    """Settings in grid order, names sorted; the first wins ties later on."""
    names = sorted(grid)
    return [dict(zip(names, values)) for values in itertools.product(*(grid[n] for n in names))]


def planned_fits(grid: dict[str, list], folds: int = FOLDS) -> int:
    return len(combinations_of(grid)) * folds


def grid_search(learner: Callable, df: DataFrame, features: Sequence[str], y: str,
                grid: dict[str, list], fold: str = "fold", folds: int = FOLDS,
                parallelism: int = 2) -> list[dict]:
    """RMSE on the training and the held-out rows of every setting and fold.

    `df` holds contiguous fold numbers; it should be persisted by the caller, as
    every fit scans it. Independent fits are submitted side by side.
    """
    def one(task: tuple[int, dict, int]) -> dict:
        i, params, k = task
        model = Fitted("m", list(features),
                       learner(df.where(F.col(fold) != k), features, y, **params))
        side = F.when(F.col(fold) == k, "val").otherwise("train").alias("side")
        got = {r["side"]: r["rmse"] for r in scores(
            model.predict(df.select(*features, y, side)), y, ["side"]).collect()}
        return {"combo": i, "params": json.dumps(params), "fold": k,
                "train_rmse": got.get("train"), "val_rmse": got.get("val")}

    tasks = [(i, p, k) for i, p in enumerate(combinations_of(grid)) for k in range(folds)]
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        return list(pool.map(one, tasks))


def best_setting(results: list[dict]) -> tuple[dict, float]:
    """(settings, mean held-out RMSE) of the best combination; ties go to the first."""
    mean: dict[int, list[float]] = {}
    for r in results:
        mean.setdefault(r["combo"], []).append(r["val_rmse"])
    combo = min(sorted(mean), key=lambda c: sum(mean[c]) / len(mean[c]))
    params = next(r["params"] for r in results if r["combo"] == combo)
    return json.loads(params), sum(mean[combo]) / len(mean[combo])


def train_model(name: str, df: DataFrame, features: Sequence[str], y: str,
                grid: dict[str, list] | None = None, **search) -> Fitted:
    """Tune over the grid if there is one, then fit on all rows."""
    start = time.time()
    learner, params, cv, trials = LEARNERS[name], {}, None, []
    grid = GRIDS[name] if grid is None else grid
    if grid:
        folds = search.get("folds", FOLDS)
        log.info("%s: %d fits", name, planned_fits(grid, folds))
        trials = grid_search(learner, df, features, y, grid, **search)
        params, cv = best_setting(trials)
    model = learner(df, features, y, **params)
    return Fitted(name, list(features), model, params, cv, time.time() - start, trials)


def train_all(df: DataFrame, features: Sequence[str], y: str,
              grids: dict[str, dict] | None = None, **search) -> dict[str, Fitted]:
    """All models in order; one that fails is logged and left out."""
    out = {}
    for name, grid in (GRIDS if grids is None else grids).items():
        try:
            out[name] = train_model(name, df, features, y, grid, **search)
        except Exception as e:
            log.error("training %s failed: %s", name, e)
    return out


def predict_all(models: dict[str, Fitted], df: DataFrame) -> DataFrame:
    for fitted in models.values():
        df = fitted.predict(df)
    return df


# --- saving --------------------------------------------------------------------

def save_models(spark: SparkSession, models: dict[str, Fitted], folder: str) -> None:
    """One model folder each, a table of the runs and one of their grid results."""
    rows = []
    for name, f in models.items():
        path = f"{folder}/{name}"
        if hasattr(f.model, "write"):
            f.model.write().overwrite().save(path)
        else:
            f.model.save(spark, path)
        rows.append((name, type(f.model).__name__, f.features, json.dumps(f.params), f.cv_rmse,
                     float(f.seconds)))
    spark.createDataFrame(
        rows, "model string, kind string, features array<string>, params string, "
        "cv_rmse double, seconds double").write.mode("overwrite").parquet(f"{folder}/model_runs")
    spark.createDataFrame(
        [(name, t["combo"], t["params"], t["fold"], t["train_rmse"], t["val_rmse"])
         for name, f in models.items() for t in f.trials], _TRIALS).write.mode(
        "overwrite").parquet(f"{folder}/grid_results")


_TRIALS = ("model string, combo int, params string, fold int, train_rmse double, "
           "val_rmse double")


def load_models(spark: SparkSession, folder: str) -> dict[str, Fitted]:
    loaders = {"LinearRegressionModel": LinearRegressionModel.load,
               "RandomForestRegressionModel": RandomForestRegressionModel.load,
               "Network": lambda path: mlp.Network.load(spark, path)}
    trials: dict[str, list[dict]] = {}
    for t in spark.read.schema(_TRIALS).parquet(f"{folder}/grid_results").orderBy(
            "model", "combo", "fold").collect():
        trials.setdefault(t["model"], []).append(
            {k: v for k, v in t.asDict().items() if k != "model"})
    return {r["model"]: Fitted(r["model"], list(r["features"]),
                               loaders[r["kind"]](f"{folder}/{r['model']}"),
                               json.loads(r["params"]), r["cv_rmse"], r["seconds"],
                               trials.get(r["model"], []))
            for r in spark.read.parquet(f"{folder}/model_runs").collect()}


# --- linear fits from segment moments ---------------------------------------------

@dataclass
class Moments:
    """Row count, sums and product sums of (features..., target), shifted by `shift`."""
    n: float
    total: np.ndarray
    product: np.ndarray
    shift: np.ndarray

    def __add__(self, other: Moments) -> Moments:
        return Moments(self.n + other.n, self.total + other.total,
                       self.product + other.product, self.shift)

    def _centred(self) -> tuple[np.ndarray, np.ndarray]:
        mean = self.total / self.n
        return mean, self.product - self.n * np.outer(mean, mean)

    def ols(self) -> LinearFormula:
        """Least squares; the smallest coefficients if the design is singular."""
        mean, s = self._centred()
        b = np.linalg.pinv(s[:-1, :-1], rcond=1e-12, hermitian=True) @ s[:-1, -1]
        raw = mean + self.shift
        return LinearFormula(b.tolist(), float(raw[-1] - raw[:-1] @ b))

    def r2(self, fit: LinearFormula) -> float:
        """R2 of a linear fit on these rows."""
        mean, s = self._centred()
        w = np.append(-np.asarray(fit.coefficients), 1.0)
        raw = mean + self.shift
        offset = raw @ w - fit.intercept
        sse = w @ s @ w + self.n * offset * offset
        return float(1.0 - sse / s[-1, -1])


def segment_moments(df: DataFrame, features: Sequence[str], y: str, by: str) -> dict[int, Moments]:
    """Moments per segment: one pass for the shift, one for the sums."""
    cols = [*features, y]
    first = df.agg(*[F.avg(c) for c in cols]).first()
    shift = np.array([v or 0.0 for v in first], dtype=float)
    shifted = df.select(by, *[(F.col(c) - F.lit(float(m))).alias(f"x{i}")
                              for i, (c, m) in enumerate(zip(cols, shift))])
    d = len(cols)
    rows = shifted.groupBy(by).agg(
        F.count(F.lit(1)).alias("n"), *[F.expr(f"sum(x{i}) AS s{i}") for i in range(d)],
        *[F.expr(f"sum(x{i} * x{j}) AS p{i}_{j}") for i in range(d) for j in range(i, d)]).collect()
    out = {}
    for r in rows:  # one row per segment
        product = np.array([[r[f"p{min(i, j)}_{max(i, j)}"] for j in range(d)] for i in range(d)])
        out[r[by]] = Moments(float(r["n"]), np.array([r[f"s{i}"] for i in range(d)]), product, shift)
    return out


def linear_fold_scores(df: DataFrame, features: Sequence[str], y: str, fold: str = "fold",
                       ) -> list[tuple[str, int, float]]:
    """(model, fold, R2) of refits that leave one fold out, from one scan of sums."""
    parts = segment_moments(df, features, y, fold)
    out = []
    for k, held in sorted(parts.items()):
        rest = [m for i, m in parts.items() if i != k]
        fit = sum(rest[1:], rest[0]).ols()
        out.append(("LinearRegression", int(k), held.r2(fit)))
    return out


def fold_scores(learner: Callable, df: DataFrame, features: Sequence[str], y: str, name: str,
                fold: str = "fold", folds: int = FOLDS, **params) -> list[tuple[str, int, float]]:
    """The same for any learner, with one fit per fold."""
    out = []
    for k in range(folds):
        fitted = Fitted(name, list(features),
                        learner(df.where(F.col(fold) != k), features, y, **params))
        got = scores(fitted.predict(df.where(F.col(fold) == k)), y).first()
        out.append((name, k, got["r2"]))
    return out


def linear_learning_curve(tagged: DataFrame, test: DataFrame, features: Sequence[str], y: str,
                          fractions: Sequence[float] = LEARNING_FRACTIONS,
                          prefix: str = "prefix") -> list[tuple[str, float, int, float, float]]:
    """(model, fraction, rows, train R2, test R2) of fits on growing prefixes."""
    parts = segment_moments(tagged, features, y, prefix)
    held = segment_moments(test.withColumn("_all", F.lit(0)), features, y, "_all")[0]
    out, running = [], None
    for i, f in enumerate(fractions):
        if i in parts:
            running = parts[i] if running is None else running + parts[i]
        if running is None:
            continue
        fit = running.ols()
        out.append(("LinearRegression", float(f), int(running.n), running.r2(fit), held.r2(fit)))
    return out


def learning_curve(learner: Callable, tagged: DataFrame, test: DataFrame,
                   features: Sequence[str], y: str, name: str,
                   fractions: Sequence[float] = LEARNING_FRACTIONS, prefix: str = "prefix",
                   **params) -> list[tuple[str, float, int, float, float]]:
    """The same for any learner, with one fit per prefix."""
    out = []
    for i, f in enumerate(fractions):
        rows = tagged.where(F.col(prefix) <= i)
        fitted = Fitted(name, list(features), learner(rows, features, y, **params))
        inside = scores(fitted.predict(rows), y).first()
        outside = scores(fitted.predict(test), y).first()
        out.append((name, float(f), inside["n"], inside["r2"], outside["r2"]))
    return out


def coefficient_table(spark: SparkSession, features: Sequence[str], coefficients: Sequence[float],
                      intercept: float) -> DataFrame:
    """Coefficients with their flags, and the intercept as the last row."""
    rows = [(i, f, float(c)) for i, (f, c) in enumerate(zip(features, coefficients))]
    rows.append((len(rows), "intercept", float(intercept)))
    c, is_intercept = F.col("c"), F.col("feature") == "intercept"
    return spark.createDataFrame(rows, "pos int, feature string, c double").select(
        "pos", "feature", half_even(c, 4).alias("coefficient"),
        half_even(F.abs(c), 4).alias("abs_coefficient"),
        F.col("feature").startswith("power_").alias("is_appliance_feature"),
        (~is_intercept & (F.abs(c) < ZERO_COEFFICIENT)).alias("effectively_zero"))


def only_appliances_matter(coefficients: DataFrame) -> DataFrame:
    """Whether every coefficient outside the appliance features is zero."""
    other = coefficients.where("NOT is_appliance_feature AND feature <> 'intercept'")
    return other.agg(F.coalesce(F.every("effectively_zero"), F.lit(True)).alias("all_zero"))
