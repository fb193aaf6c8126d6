"""Temporal split, scaling and split statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.fixed_values import TEST_RATIO
from wattloom.operators.ordered import temporal_split


def scaler_params(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(pos, feature, mean, scale) rows: population deviation, 1 for a constant."""
    means = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(features)],
                   *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(features)])
    rows = F.explode(F.array(*[
        F.struct(F.lit(i).alias("pos"), F.lit(c).alias("feature"),
                 F.col(f"m{i}").alias("mean"),
                 F.when(F.col(f"s{i}") == 0, 1.0).otherwise(F.col(f"s{i}")).alias("scale"))
        for i, c in enumerate(features)]))
    return means.select(rows.alias("r")).select("r.*")


def apply_scaler(df: DataFrame, params: DataFrame) -> DataFrame:
    """Standardise the listed columns; the parameters are one row per feature."""
    known = {r["feature"]: (r["mean"], r["scale"]) for r in params.collect()}
    return df.withColumns({
        c: (F.col(c) - F.lit(m)) / F.lit(s) for c, (m, s) in known.items() if m is not None})


def prepare_split(df: DataFrame, features: Sequence[str], target: str, order: Sequence[str],
                  test_ratio: float = TEST_RATIO, test_scaler: str = "train",
                  ) -> tuple[DataFrame, DataFrame]:
    """(rows tagged train/test with scaled features, scaler parameters).

    `test_scaler='train'` scales the test rows with the training statistics, the
    sound choice; 'refit' scales them with their own and returns those parameters.
    """
    if test_scaler not in ("train", "refit"):
        raise ValueError("test_scaler is 'train' or 'refit'")
    tagged = temporal_split(df, order, test_ratio)
    train, test = tagged.where("split = 'train'"), tagged.where("split = 'test'")
    params = scaler_params(train, features)
    if test_scaler == "train":
        return apply_scaler(tagged, params), params
    own = scaler_params(test, features)
    return apply_scaler(train, params).unionByName(apply_scaler(test, own)), own


def with_vector(df: DataFrame, features: Sequence[str], name: str = "features") -> DataFrame:
    return df.withColumn(name, array_to_vector(
        F.array(*[F.col(c).cast("double") for c in features])))


def target_stats(df: DataFrame, target: str) -> DataFrame:
    """Mean, population deviation and range of the target on each side."""
    return df.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.avg(target).alias("mean"),
        F.stddev_pop(target).alias("std"), F.min(target).alias("min"), F.max(target).alias("max"))
