"""Realism checks and rate comparisons against small reference dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.fixed_values import (
    ACTIVE_WATTS, APPLIANCE_EXPECTATIONS, APPLIANCE_LIMITS, APPLIANCE_SCHEDULES,
    DEFAULT_ACTIVATION, DEFAULT_MAX_POWER, PEAK_FACTOR, PHANTOM_SPREAD_WATTS, SAMPLES_PER_DAY,
    STANDBY_WATTS, UNOCCUPIED_LIMIT_PCT)
from wattloom.functions.columns import pass_or
from wattloom.operators.clean import unpivot

CHECKS = ["max_ok", "mean_ok", "activations_ok", "unoccupied_ok", "peak_ok", "standby_ok"]


def expectations(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        APPLIANCE_EXPECTATIONS,
        "appliance string, max_watts double, mean_lo double, mean_hi double, act_lo double, "
        "act_hi double, active_threshold double, zero_lo double, zero_hi double, "
        "peak_hours array<int>")


def limits(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        APPLIANCE_LIMITS, "appliance string, max_power double, phantom_load double")


def schedule(spark: SparkSession) -> DataFrame:
    rows = [(a, w, h, p) for a, w, hours in APPLIANCE_SCHEDULES for h, p in hours.items()]
    return spark.createDataFrame(
        rows, "appliance string, is_weekend int, hour int, probability double")


def _dimension(df: DataFrame, standard, given: DataFrame | None) -> DataFrame:
    """The given table as it is, or the standard one, whose rows are listed in this
    package and may be broadcast. Catalyst sizes a given one by itself."""
    return F.broadcast(standard(df.sparkSession)) if given is None else given


def appliance_rows(df: DataFrame, dimension: DataFrame, keep: list[str]) -> DataFrame:
    """Wide power columns as rows, joined with a per-appliance dimension."""
    cols = [c for c in df.columns if c.startswith("power_")]
    tall = unpivot(df, keep, cols, "appliance", "watts").withColumn(
        "appliance", F.replace("appliance", F.lit("power_"), F.lit("")))
    return tall.join(dimension, "appliance")


def appliance_realism(features: DataFrame, dimension: DataFrame | None = None) -> DataFrame:
    """Six checks per appliance: figures, verdicts and checks passed."""
    dim = _dimension(features, expectations, dimension)
    rows = appliance_rows(features, dim, ["hour", "occupancy_count"])
    watts = F.col("watts")
    active = watts > F.col("active_threshold")
    empty = F.col("occupancy_count") == 0
    peak = F.array_contains("peak_hours", F.col("hour"))
    keys = [c for c in dim.columns if c not in ("appliance", "peak_hours")]
    figures = rows.groupBy("appliance", *keys).agg(
        F.max(watts).alias("max_power"), F.avg(watts).alias("mean_power"),
        (F.count_if(active) / (F.count(F.lit(1)) / F.lit(float(SAMPLES_PER_DAY))))
        .alias("per_day"),
        F.coalesce(F.count_if(empty & active) * 100.0 / F.nullif(F.count_if(empty), F.lit(0)),
                   F.lit(0.0)).alias("unoccupied_pct"),
        F.avg(F.when(peak, watts)).alias("peak_mean"),
        F.avg(F.when(~peak, watts)).alias("off_mean"),
        F.count_if(~peak).alias("_off"),
        (F.count_if(watts < STANDBY_WATTS) * 100.0 / F.count(F.lit(1))).alias("zero_pct"))
    off = F.when(F.col("_off") > 0, F.col("off_mean")).otherwise(0.0)

    def verdict(test):
        return F.coalesce(test, F.lit(False))

    checked = figures.withColumn("off_mean", off).select(
        "appliance", "max_power", "mean_power", "per_day", "unoccupied_pct", "peak_mean",
        "off_mean", "zero_pct",
        verdict(F.col("max_power") <= F.col("max_watts")).alias("max_ok"),
        verdict((F.col("mean_lo") < F.col("mean_power")) & (F.col("mean_power") < F.col("mean_hi")))
        .alias("mean_ok"),
        verdict((F.col("act_lo") < F.col("per_day")) & (F.col("per_day") < F.col("act_hi")))
        .alias("activations_ok"),
        verdict(F.col("unoccupied_pct") < UNOCCUPIED_LIMIT_PCT).alias("unoccupied_ok"),
        verdict(F.col("peak_mean") > F.col("off_mean") * PEAK_FACTOR).alias("peak_ok"),
        verdict(F.col("zero_pct").between(F.col("zero_lo"), F.col("zero_hi"))).alias("standby_ok"))
    passed = sum((F.col(c).cast("int") for c in CHECKS[1:]), F.col(CHECKS[0]).cast("int"))
    return checked.withColumn("passed", passed).withColumn("checks", F.lit(len(CHECKS)))


def realism_verdicts(realism: DataFrame) -> DataFrame:
    """PASS, or FAIL for the hard power limit and WARN for the softer checks."""
    return realism.select("appliance", *[
        pass_or(F.col(c), "FAIL" if c == "max_ok" else "WARN").alias(c) for c in CHECKS])


def realism_totals(realism: DataFrame) -> DataFrame:
    return realism.agg(F.sum("passed").alias("passed"), F.sum("checks").alias("checks"))


def with_expected_activation(df: DataFrame, dimension: DataFrame | None = None,
                             default: float = DEFAULT_ACTIVATION) -> DataFrame:
    """Scheduled activation probability by appliance, hour and weekend flag; the
    default where the schedule has no entry or the appliance none at all."""
    dim = _dimension(df, schedule, dimension)
    return df.join(dim, ["appliance", "is_weekend", "hour"], "left").withColumn(
        "probability", F.coalesce("probability", F.lit(default)))


def classify_readings(rows: DataFrame, dimension: DataFrame | None = None) -> DataFrame:
    """Label appliance readings: over_cap, active, phantom or idle.

    Beyond the appliance's limit it is over_cap; within three spreads of a known
    phantom load, phantom; above the active level, active; otherwise idle.
    """
    dim = _dimension(rows, limits, dimension)
    joined = rows.join(dim, "appliance", "left")
    watts = F.col("value")
    cap = F.coalesce("max_power", F.lit(DEFAULT_MAX_POWER))
    phantom = F.coalesce("phantom_load", F.lit(0.0))
    label = (F.when(watts > cap, "over_cap")
             .when((phantom > 0) & (F.abs(watts - phantom) <= 3 * PHANTOM_SPREAD_WATTS), "phantom")
             .when(watts > ACTIVE_WATTS, "active")
             .otherwise("idle"))
    return joined.withColumn("reading_class", label).drop("max_power", "phantom_load")


def activation_gap(features: DataFrame, dimension: DataFrame | None = None) -> DataFrame:
    """Observed share of active rows by appliance, hour and weekend, against schedule."""
    cols = [c for c in features.columns if c.startswith("power_")]
    rates = unpivot(
        # Means of 0/1 flags are taken before unpivoting: one row per (weekend, hour).
        features.groupBy("is_weekend", "hour").agg(*[
            F.avg((F.col(c) > ACTIVE_WATTS).cast("double")).alias(c) for c in cols]),
        ["is_weekend", "hour"], cols, "appliance", "observed").withColumn(
        "appliance", F.replace("appliance", F.lit("power_"), F.lit("")))
    return with_expected_activation(rates, dimension).withColumn(
        "difference", F.col("observed") - F.col("probability"))


def occupancy_gap(wide: DataFrame, expected: DataFrame) -> DataFrame:
    """Observed occupancy rate by room, hour and weekend against an expected table
    (room, is_weekend, hour, probability)."""
    cols = [c for c in wide.columns if c.startswith("occupancy_") and c != "occupancy_count"]
    rates = unpivot(
        wide.groupBy((F.weekday("timestamp") >= 5).cast("int").alias("is_weekend"),
                     F.hour("timestamp").alias("hour"))
        .agg(*[F.avg(c).alias(c) for c in cols]),
        ["is_weekend", "hour"], cols, "room", "observed").withColumn(
        "room", F.replace("room", F.lit("occupancy_"), F.lit("")))
    return rates.join(expected, ["room", "is_weekend", "hour"], "left").withColumn(
        "difference", F.col("observed") - F.coalesce("probability", F.lit(0.0)))
