"""Comparison of a data set with an external one, feature by feature."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.fixed_values import KS_SIMILAR, KS_VERY_SIMILAR, SIGNIFICANCE, TOLERANCE
from wattloom.functions.columns import bands, half_even
from wattloom.functions.pvalues import ks_two_sided
from wattloom.operators.clean import pool, union_by_name
from wattloom.operators.distribution import (
    cumulative_counts, ks_distance, quantile_at, value_counts)
from wattloom.session import durable

log = logging.getLogger(__name__)
_SIDES = ("emulated", "real")


def ks_label(d: str | Column) -> Column:
    return bands(d, [(KS_VERY_SIMILAR, "Very Similar distributions"),
                     (KS_SIMILAR, "Moderately Similar distributions")],
                 "Substantially different distributions")


def _mapped(emulated: DataFrame, real: DataFrame, feature_map: dict[str, str],
            dataset: str) -> list[tuple[str, str]]:
    """The pairs of a feature map that both tables have."""
    pairs = []
    for ours, theirs in feature_map.items():
        missing = [c for c, df in ((ours, emulated), (theirs, real)) if c not in df.columns]
        if missing:
            log.warning("%s: no column %s, feature skipped", dataset, missing[0])
        else:
            pairs.append((ours, theirs))
    return pairs


def paired_samples(emulated: DataFrame, real: DataFrame, feature_map: dict[str, str],
                   dataset: str) -> DataFrame | None:
    """Both sides of every mapped feature as (feature, side, value) rows."""
    parts = []
    for ours, theirs in _mapped(emulated, real, feature_map, dataset):
        a = emulated.select(F.col(ours).cast("double").alias("value"))
        b = real.select(F.col(theirs).cast("double").alias("value"))
        parts.append(pool(a, b, "value", _SIDES).select(
            F.lit(f"{ours} vs {theirs}").alias("feature"), F.lit(dataset).alias("dataset"),
            F.lit(ours).alias("emulated_column"), F.lit(theirs).alias("real_column"),
            "side", F.col("value")))
    return union_by_name(*parts) if parts else None


def validate_samples(samples: DataFrame, tolerance: float = TOLERANCE,
                     by: tuple[str, ...] = ("dataset", "feature", "emulated_column",
                                            "real_column")) -> DataFrame:
    """One result row per feature from (feature, side, value) rows.

    The samples are read once, for their value counts; moments, medians and the KS distance
    come from these. A feature with an empty side gives no row. Deviations are of the
    population.
    """
    keys = list(by)
    if keys == ["feature"]:
        samples = samples.select("feature", "side", "value")
    tag = F.concat_ws("\u0001", *[F.col(k) for k in keys])
    tagged = samples.select(tag.alias("_tag"), "side", "value")
    counts = {f"n{i}": (F.col("side") == s).cast("long") for i, s in enumerate(_SIDES)}
    return _validated(value_counts(tagged, ["_tag"], "value", counts), keys, tolerance)


def _validated(counted: DataFrame, keys: list[str], tolerance: float) -> DataFrame:
    """The result rows from (_tag, value, n0, n1), the counts of both sides."""
    table = durable(cumulative_counts(counted, ["_tag"], ["n0", "n1"]))
    value = F.col("value")
    sums, aggs = [], []
    for i, s in enumerate(_SIDES):
        n, all_n, mean = F.col(f"n{i}"), F.col(f"all_n{i}"), F.col(f"{s}_mean")
        sums.append((F.sum(F.when(n > 0, value * n)) / F.nullif(F.sum(n), F.lit(0)))
                    .alias(f"{s}_mean"))
        off = value - mean
        aggs += [F.max(all_n).alias(f"{s}_n"), F.max(mean).alias(f"{s}_mean"),
                 F.sqrt(F.sum(F.when(n > 0, off * off * n)) / F.nullif(F.max(all_n), F.lit(0)))
                 .alias(f"{s}_std"),
                 F.min(F.when(n > 0, value)).alias(f"{s}_min"),
                 F.max(F.when(n > 0, value)).alias(f"{s}_max"),
                 quantile_at(0.5, f"n{i}").alias(f"{s}_median")]
    means = table.groupBy("_tag").agg(*sums)
    rows = (table.join(means, "_tag").groupBy("_tag")
            .agg(*aggs, ks_distance().alias("ks_statistic"))
            .where("emulated_n > 0 AND real_n > 0"))
    e, r = F.col("emulated_mean"), F.col("real_mean")
    pct = F.when(r != 0, F.abs(e - r) / F.nullif(F.abs(r), F.lit(0.0)) * 100.0).when(
        e == 0, 0.0).otherwise(100.0)
    rows = rows.withColumn("pct_difference", pct)
    p = F.udf(lambda d, a, b: ks_two_sided(d, a, b), "double")  # a few report rows, never table rows
    parts = F.split("_tag", "\u0001")
    stats = [f"{s}_{m}" for m in ("mean", "std", "median", "min", "max") for s in _SIDES]
    return rows.withColumn("_p", p("ks_statistic", "emulated_n", "real_n")).select(
        *[parts[i].alias(k) for i, k in enumerate(keys)], "emulated_n", "real_n",
        *[half_even(c, 2).alias(c) for c in stats],
        half_even("pct_difference", 2).alias("pct_difference"),
        (F.col("pct_difference") <= tolerance * 100).alias("within_tolerance"),
        half_even("ks_statistic", 4).alias("ks_statistic"),
        half_even("_p", 6).alias("ks_p_value"),
        (F.col("_p") < SIGNIFICANCE).alias("ks_significant"),
        ks_label("ks_statistic").alias("ks_result"))


def _side_counts(df: DataFrame, columns: list[str], side: int) -> DataFrame:
    """Counts (pos, value, n0, n1) of all columns of one side, in one scan."""
    values = F.array(*[F.struct(F.lit(j).alias("pos"), F.col(c).cast("double").alias("value"))
                       for j, c in enumerate(columns)])
    tall = df.select(F.explode(values).alias("v")).select("v.*")
    return value_counts(tall, ["pos"], "value", {
        f"n{i}": F.lit(int(i == side)).cast("long") for i in range(len(_SIDES))})


def validate_against(emulated: DataFrame, real: DataFrame, feature_map: dict[str, str],
                     dataset: str, tolerance: float = TOLERANCE) -> DataFrame | None:
    """`validate_samples` for the columns of two tables, each of which is read once for all
    features together."""
    pairs = _mapped(emulated, real, feature_map, dataset)
    if not pairs:
        return None
    ours, theirs = (_side_counts(df, [pair[i] for pair in pairs], i)
                    for i, df in enumerate((emulated, real)))
    tags = F.array(*[F.lit("\u0001".join([dataset, f"{a} vs {b}", a, b])) for a, b in pairs])
    counted = ours.unionAll(theirs).groupBy("pos", "value").agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).select(
        F.element_at(tags, F.col("pos") + 1).alias("_tag"), "value", "n0", "n1")
    return _validated(counted, ["dataset", "feature", "emulated_column", "real_column"], tolerance)


def validation_totals(results: DataFrame) -> DataFrame:
    """Features within tolerance and KS-similar, per data set and over all (null)."""
    return results.rollup("dataset").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("within_tolerance").alias("passed"),
        F.count_if(~F.col("ks_significant")).alias("ks_similar"))
