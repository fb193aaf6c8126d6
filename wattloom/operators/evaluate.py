"""Evaluation of predictions.

Predictions live as extra columns of the row they belong to (`pred_<model>`), so
truth and predictions need no join, and one aggregation serves all models and all
pairs of models.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.fixed_values import (
    CV_STABLE_PCT, GAP_MILD, GAP_OK, MAE_TARGET, R2_TARGET, RMSE_TARGET, SEED,
    SHAPIRO_SAMPLE, SIGNIFICANCE)
from wattloom.functions.columns import bands, half_even, ratio
from wattloom.functions.pvalues import shapiro_wilk, t_two_sided
from wattloom.operators.distribution import equal_width_histogram

PREFIX = "pred_"


def model_names(df: DataFrame) -> list[str]:
    return [c[len(PREFIX):] for c in df.columns if c.startswith(PREFIX)]


def join_predictions(truth: DataFrame, predictions: DataFrame, key: str = "row_id") -> DataFrame:
    """Long predictions (row, model, y_pred) as columns beside the truth."""
    models = [r["model"] for r in predictions.select("model").distinct().orderBy("model").collect()]
    wide = predictions.groupBy(key).agg(*[
        F.max(F.when(F.col("model") == m, F.col("y_pred"))).alias(PREFIX + m) for m in models])
    return truth.join(wide, key)


def long_predictions(df: DataFrame, ids: Sequence[str]) -> DataFrame:
    """(ids..., model, y_pred) rows; a narrow operation."""
    models = F.explode(F.array(*[
        F.struct(F.lit(m).alias("model"), F.col(PREFIX + m).cast("double").alias("y_pred"))
        for m in model_names(df)]))
    return df.select(*ids, models.alias("_p")).select(*ids, "_p.model", "_p.y_pred")


def _score_columns(y: str) -> list[Column]:
    e = F.col(y) - F.col("y_pred")
    sse = F.sum(e * e)
    spread = F.var_pop(y) * F.count(F.lit(1))
    return [F.count(F.lit(1)).alias("n"),
            # a constant target scores 1 if met exactly, otherwise 0
            F.when(spread > 0, 1.0 - sse / F.nullif(spread, F.lit(0.0)))
            .when(sse == 0, 1.0).otherwise(0.0).alias("r2"),
            F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae")]


def scores(df: DataFrame, y: str = "y", by: Sequence[str] = ()) -> DataFrame:
    """R2, RMSE and MAE per model (and per group), over the rows that have both the target
    and the prediction."""
    pairs = long_predictions(df, [*by, y]).where(
        F.col(y).isNotNull() & F.col("y_pred").isNotNull())
    return pairs.groupBy("model", *by).agg(*_score_columns(y))


def evaluate(df: DataFrame, y: str = "y") -> DataFrame:
    """Scores of each model and whether they meet the targets."""
    return scores(df, y).select(
        "model", "r2", "rmse", "mae",
        (F.col("r2") >= R2_TARGET).alias("meets_r2_target"),
        (F.col("rmse") <= RMSE_TARGET).alias("meets_rmse_target"),
        (F.col("mae") <= MAE_TARGET).alias("meets_mae_target"))


def best_model(evaluated: DataFrame, order: Sequence[str]) -> DataFrame:
    """The model with the highest R2; ties go to the first in `order`."""
    position = F.array_position(F.array(*[F.lit(m) for m in order]), F.col("model"))
    return evaluated.agg(F.max_by("model", F.struct("r2", -position)).alias("best_model"),
                         F.max("r2").alias("best_r2"))


def compare_models(df: DataFrame, y: str = "y", models: Sequence[str] | None = None) -> DataFrame:
    """Paired t-test on absolute errors for each pair of models, in one aggregation."""
    models = list(models or model_names(df))
    errors = df.select(*[F.abs(F.col(y) - F.col(PREFIX + m)).alias(m) for m in models])
    pairs = list(combinations(models, 2))
    aggs = [F.count(F.lit(1)).alias("n")]
    aggs += [F.avg(F.col(f"`{m}`")).alias(f"mae_{i}") for i, m in enumerate(models)]
    for k, (a, b) in enumerate(pairs):
        d = F.col(f"`{a}`") - F.col(f"`{b}`")
        aggs += [F.avg(d).alias(f"d{k}"), F.stddev_samp(d).alias(f"s{k}")]
    rows = F.explode(F.array(*[
        F.struct(F.lit(a).alias("model_a"), F.lit(b).alias("model_b"),
                 F.col(f"mae_{models.index(a)}").alias("mae_a"),
                 F.col(f"mae_{models.index(b)}").alias("mae_b"),
                 (F.col(f"d{k}") / F.nullif(F.col(f"s{k}") / F.sqrt("n"), F.lit(0.0)))
                 .alias("t_statistic"), F.col("n"))
        for k, (a, b) in enumerate(pairs)]))
    p = F.udf(lambda t, n: t_two_sided(t, n - 1), "double")  # one row per pair of models
    return errors.agg(*aggs).select(rows.alias("r")).select("r.*").select(
        "model_a", "model_b", "mae_a", "mae_b", "t_statistic",
        p("t_statistic", "n").alias("p_value")).withColumn(
        "significant", F.coalesce(F.col("p_value") < SIGNIFICANCE, F.lit(False))).withColumn(
        "better_model", F.when(F.col("mae_a") < F.col("mae_b"), F.col("model_a"))
        .otherwise(F.col("model_b")))


def gap_label(gap: str | Column) -> Column:
    return bands(gap, [(GAP_OK, "NO OVERFITTING"), (GAP_MILD, "MILD OVERFITTING")],
                 "OVERFITTING CONCERN")


def train_test_gap(df: DataFrame, y: str = "y", split: str = "split") -> DataFrame:
    """Scores on both sides of the split and the overfitting verdict."""
    sides = scores(df, y, [split])
    wide = sides.groupBy("model").agg(*[
        F.max(F.when(F.col(split) == s, F.col(m))).alias(f"{s}_{m}")
        for m in ("r2", "rmse", "mae") for s in ("train", "test")])
    gap = F.col("train_r2") - F.col("test_r2")
    return wide.select(
        "model", half_even("train_r2", 5).alias("train_r2"), half_even("test_r2", 5).alias("test_r2"),
        half_even(gap, 5).alias("r2_gap"), half_even(gap * 100, 3).alias("r2_gap_pct"),
        *[c for m in ("rmse", "mae") for c in (
            half_even(f"train_{m}", 2).alias(f"train_{m}"),
            half_even(f"test_{m}", 2).alias(f"test_{m}"),
            half_even(F.col(f"test_{m}") - F.col(f"train_{m}"), 2).alias(f"{m}_gap"))],
        gap_label(gap).alias("verdict"))


def cv_stability(fold_scores: DataFrame) -> DataFrame:
    """Spread of the per-fold R2 of each model."""
    m, s = F.avg("r2"), F.stddev_pop("r2")
    out = fold_scores.groupBy("model").agg(
        m.alias("m"), s.alias("s"), F.min("r2").alias("lo"), F.max("r2").alias("hi"))
    coefficient = ratio(F.col("s"), F.abs("m"), 0.0) * 100
    return out.select(
        "model", half_even("m", 5).alias("cv_mean_r2"), half_even("s", 5).alias("cv_std_r2"),
        half_even("lo", 5).alias("cv_min_r2"), half_even("hi", 5).alias("cv_max_r2"),
        half_even(F.col("hi") - F.col("lo"), 5).alias("cv_range"),
        half_even(coefficient, 3).alias("cv_coeff_variation"),
        F.when(coefficient < CV_STABLE_PCT, "STABLE").otherwise("UNSTABLE").alias("verdict"))


def with_failures(stability: DataFrame, failed: Sequence[tuple[str, str]]) -> DataFrame:
    """`cv_stability` with a row for each model whose folds failed: no numbers, and why."""
    rows = stability.sparkSession.createDataFrame(list(failed), "model string, verdict string")
    return stability.unionByName(rows, allowMissingColumns=True)


def residual_moments(df: DataFrame, y: str = "y") -> DataFrame:
    """Mean, population deviation, biased skewness, excess kurtosis of the residuals."""
    e = F.col(y) - F.col("y_pred")
    return long_predictions(df, [y]).groupBy("model").agg(
        F.avg(e).alias("residual_mean"), F.stddev_pop(e).alias("residual_std"),
        F.skewness(e).alias("skewness"), F.kurtosis(e).alias("kurtosis"))


def bounded_sample(df: DataFrame, key: str = "row_id", size: int = SHAPIRO_SAMPLE,
                   seed: int = SEED) -> DataFrame:
    """A fixed-size sample without replacement: the rows with the smallest hashes.
    Planned as a top-n, and the same on any partitioning."""
    return df.orderBy(F.xxhash64(F.col(key), F.lit(seed)), key).limit(size)


def residual_normality(df: DataFrame, y: str = "y", key: str = "row_id",
                       size: int = SHAPIRO_SAMPLE) -> DataFrame:
    """Moments of all residuals, and Shapiro-Wilk on a sample of at most `size` rows."""
    sample = bounded_sample(df.select(key, y, *[PREFIX + m for m in model_names(df)]), key, size)
    e = long_predictions(sample, [y]).select("model", (F.col(y) - F.col("y_pred")).alias("e"))

    def test(pdf: pd.DataFrame) -> pd.DataFrame:  # one bounded group per model
        w, p = shapiro_wilk(pdf["e"].to_numpy())
        return pd.DataFrame({"model": [pdf["model"].iloc[0]], "shapiro_stat": [w], "shapiro_p": [p]})

    tested = e.groupBy("model").applyInPandas(
        test, "model string, shapiro_stat double, shapiro_p double")
    return tested.join(residual_moments(df, y), "model").select(
        "model", half_even("shapiro_stat", 4).alias("shapiro_stat"),
        half_even("shapiro_p", 6).alias("shapiro_p"),
        (F.col("shapiro_p") > 0.05).alias("is_normal"),
        *[half_even(c, 4).alias(c) for c in
          ("residual_mean", "residual_std", "skewness", "kurtosis")])


def residual_histogram(df: DataFrame, y: str = "y", bins: int = 50) -> DataFrame:
    rows = long_predictions(df, [y]).select(
        "model", (F.col(y) - F.col("y_pred")).alias("residual"))
    return equal_width_histogram(rows, ["model"], "residual", bins)


def prediction_extents(df: DataFrame, y: str = "y") -> DataFrame:
    """Joint range of truth and predictions, and residual mean and deviation."""
    e = F.col(y) - F.col("y_pred")
    return long_predictions(df, [y]).groupBy("model").agg(
        F.least(F.min(y), F.min("y_pred")).alias("low"),
        F.greatest(F.max(y), F.max("y_pred")).alias("high"),
        F.avg(e).alias("residual_mean"), F.stddev_pop(e).alias("residual_std"))
