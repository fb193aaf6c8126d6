"""Descriptive statistics. Each report is one scan with several aggregates, where a
frame library would filter or group once per column."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.fixed_values import (
    CORR_MODERATE, CORR_STRONG, DAY_NAMES, SAMPLES_PER_DAY, STANDBY_WATTS, WEEKDAY_RANGE_WATTS)
from wattloom.functions.columns import bands, day_kind, half_even, ratio
from wattloom.operators.clean import columns_with_prefix, unpivot
from wattloom.operators.distribution import exact_quantiles, five_numbers
from wattloom.operators.features import CORE_FEATURES


def completeness(df: DataFrame, expected_rows: int | None = None) -> DataFrame:
    """Rows, time range and the share of the expected grid rows that is present.

    Without `expected_rows` the whole days of the covered range are expected.
    """
    out = df.agg(F.count(F.lit(1)).alias("row_count"), F.min("timestamp").alias("first_ts"),
                 F.max("timestamp").alias("last_ts"))
    days = F.date_diff(F.col("last_ts").cast("date"), F.col("first_ts").cast("date")) + 1
    expected = F.lit(expected_rows) if expected_rows else days * F.lit(SAMPLES_PER_DAY)
    return out.withColumn("expected_rows", expected.cast("bigint")).withColumn(
        "completeness_pct", ratio(F.col("row_count") * F.lit(100.0), "expected_rows"))


def sensor_summary(wide: DataFrame) -> DataFrame:
    """Min, max, mean, sample deviation and standby share of every wide column."""
    cols = columns_with_prefix(wide, "temperature_", "humidity_", "occupancy_", "power_")
    cols += [c for c in ("total_power",) if c in wide.columns]
    value = F.col("value")
    return unpivot(wide, [], cols, "sensor").groupBy("sensor").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min(value).alias("min_value"), F.max(value).alias("max_value"),
        F.avg(value).alias("mean_value"), F.stddev_samp(value).alias("std_value"),
        (F.avg(F.when(F.col("sensor").startswith("occupancy_"), value)) * 100.0)
        .alias("occupied_pct"),
        F.when(F.col("sensor").startswith("power_"),
               F.count_if(value < STANDBY_WATTS) * 100.0 / F.count(F.lit(1))).alias("zero_pct"))


def hourly_profile(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Mean of each column by hour of day, as (sensor, hour, mean_value) rows."""
    cols = cols or columns_with_prefix(df, "temperature_", "humidity_", "occupancy_") + [
        c for c in ("total_power",) if c in df.columns]
    by_hour = F.col("hour") if "hour" in df.columns else F.hour("timestamp")
    means = df.groupBy(by_hour.alias("hour")).agg(*[F.avg(c).alias(c) for c in cols])
    return unpivot(means, ["hour"], cols, "sensor", "mean_value")


def weekend_profile(features: DataFrame,
                    cols: tuple[str, ...] = ("occupancy_count", "total_power", "mean_temperature"),
                    ) -> DataFrame:
    """Hourly means of weekdays and weekends, from one grouping."""
    return features.groupBy("is_weekend", "hour").agg(*[F.avg(c).alias(c) for c in cols])


def _corr(a: str, b: str) -> Column:
    """Pearson correlation over the rows that have both values; null if either is constant
    (`corr` divides by zero there, which ANSI mode makes an error)."""
    x, y = F.col(a).cast("double"), F.col(b).cast("double")
    x, y = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    spread = F.stddev_pop(x) * F.stddev_pop(y)
    return F.covar_pop(x, y) / F.nullif(spread, F.lit(0.0))


def correlations(features: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Pearson correlation of every pair of columns; one aggregation, one row per pair."""
    cols = cols or CORE_FEATURES
    pairs = list(combinations(cols, 2))
    # The aggregate has one column per pair, the report one row per pair.
    wide = features.agg(*[_corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    tall = wide.unpivot([], [f"`{a}|{b}`" for a, b in pairs], "pair", "r")
    parts = F.split("pair", r"\|")
    return tall.select(parts[0].alias("feature_a"), parts[1].alias("feature_b"), "r")


def correlation_matrix(features: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Both triangles and the diagonal of the correlation table."""
    pairs = correlations(features, cols)
    mirrored = pairs.select(F.col("feature_b").alias("feature_a"),
                            F.col("feature_a").alias("feature_b"), "r")
    names = F.explode(F.array(*[F.lit(c) for c in cols or CORE_FEATURES]))
    diagonal = pairs.limit(1).select(names.alias("feature_a")).select(
        "feature_a", F.col("feature_a").alias("feature_b"), F.lit(1.0).alias("r"))
    return pairs.unionAll(mirrored).unionAll(diagonal)


def target_correlations(features: DataFrame, target: str = "total_power") -> DataFrame:
    """Correlation of each feature with the target, and how strong it is."""
    cols = [c for c in CORE_FEATURES if c != target and c in features.columns]
    wide = features.agg(*[_corr(c, target).alias(c) for c in cols])
    return unpivot(wide, [], cols, "feature", "r").withColumn(
        "strength", bands(F.abs("r"), [(CORR_STRONG, "strong"), (CORR_MODERATE, "moderate")],
                          "weak", strict_above=True))


def _all_days(spark) -> DataFrame:
    rows = list(enumerate(DAY_NAMES))
    days = spark.createDataFrame(rows, "day_number int, day_name string")
    return days.withColumn("is_weekend", day_kind("day_number"))


def daily_stats(features: DataFrame) -> DataFrame:
    """Statistics of each day of the week; a day without rows is listed with count 0."""
    key = F.col("day_of_week").alias("day_number")
    p = F.col("total_power")
    aggs = [F.count(F.lit(1)).alias("record_count"),
            half_even(F.avg(p), 1).alias("power_mean"),
            half_even(F.stddev_samp(p), 1).alias("power_std"),
            half_even(F.min(p), 1).alias("power_min"),
            half_even(F.max(p), 1).alias("power_max")]
    if "occupancy_count" in features.columns:
        aggs += [half_even(F.avg("occupancy_count"), 2).alias("occupancy_mean"),
                 half_even(F.stddev_samp("occupancy_count"), 2).alias("occupancy_std")]
    if "active_appliances" in features.columns:
        aggs += [half_even(F.avg("active_appliances"), 2).alias("active_appliances_mean")]
    if "mean_temperature" in features.columns:
        aggs += [half_even(F.avg("mean_temperature"), 2).alias("temperature_mean")]
    stats = features.groupBy(key).agg(*aggs)
    medians = exact_quantiles(features.select(key, "total_power"), ["day_number"],
                              "total_power", {"power_median": 0.5})
    out = (_all_days(features.sparkSession).join(stats, "day_number", "left")
           .join(medians, "day_number", "left"))
    return out.withColumn("power_median", half_even("power_median", 1)).withColumn(
        "record_count", F.coalesce("record_count", F.lit(0)))


def weekday_weekend_contrast(daily: DataFrame) -> DataFrame:
    """Second-level summary of `daily_stats`: weekday against weekend power."""
    weekday, weekend = F.col("is_weekend") == "Weekday", F.col("is_weekend") == "Weekend"
    power = F.col("power_mean")
    out = daily.agg(F.avg(F.when(weekday, power)).alias("weekday_mean"),
                    F.avg(F.when(weekend, power)).alias("weekend_mean"),
                    (F.max(F.when(weekday, power)) - F.min(F.when(weekday, power)))
                    .alias("weekday_range"))
    gap = F.abs(F.col("weekday_mean") - F.col("weekend_mean"))
    return out.withColumn("pct_difference", ratio(gap, "weekday_mean") * 100.0).withColumn(
        "minimal_variation", F.col("weekday_range") < WEEKDAY_RANGE_WATTS)


def hourly_by_day(features: DataFrame) -> DataFrame:
    """Mean power by (day, hour) and by (weekend, hour) in one pass."""
    sets = [["day_of_week", "hour"], ["is_weekend", "hour"]]
    return features.groupingSets(
        [[F.col(c) for c in s] for s in sets],
        F.col("day_of_week"), F.col("is_weekend"), F.col("hour"),
    ).agg(F.avg("total_power").alias("mean_power"))


def day_distribution(features: DataFrame) -> DataFrame:
    """Mean, deviation and box-plot numbers of power by day, and mean occupancy."""
    moments = features.groupBy("day_of_week").agg(
        F.avg("total_power").alias("power_mean"),
        F.stddev_samp("total_power").alias("power_std"),
        F.avg("occupancy_count").alias("occupancy_mean"),
        F.stddev_samp("occupancy_count").alias("occupancy_std"))
    return moments.join(five_numbers(features, ["day_of_week"], "total_power"), "day_of_week")


def ingest_counts(long: DataFrame) -> DataFrame:
    """Message counters of a batch: overall, by sensor type and by room."""
    return long.groupingSets(
        [[], [F.col("sensor_type")], [F.col("room")]], F.col("sensor_type"), F.col("room"),
    ).agg(F.count(F.lit(1)).alias("n"),
          F.grouping("sensor_type").alias("_s"), F.grouping("room").alias("_r")).select(
        F.when(F.col("_s") == 0, F.concat(F.lit("sensor_"), F.coalesce("sensor_type", F.lit(""))))
        .when(F.col("_r") == 0, F.concat(F.lit("room_"), F.coalesce("room", F.lit(""))))
        .otherwise("total_messages").alias("counter"), "n")


def message_rate(long: DataFrame) -> DataFrame:
    """Messages per second over the covered time."""
    out = long.agg(F.count(F.lit(1)).alias("total_messages"),
                   F.timestamp_diff("SECOND", F.min("timestamp"), F.max("timestamp"))
                   .alias("elapsed_s"))
    return out.withColumn("rate", F.when(
        F.col("elapsed_s") > 0, F.col("total_messages") / F.col("elapsed_s")).otherwise(0.0))


def weekend_spans(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Weekend days within the covered range as (start, end) rows."""
    one_day = F.expr("INTERVAL 1 DAY")
    days = df.agg(F.min(ts).alias("lo"), F.max(ts).alias("hi")).select(F.explode(
        F.sequence(F.date_trunc("DAY", "lo").cast("timestamp_ntz"),
                   F.date_trunc("DAY", "hi").cast("timestamp_ntz"), one_day)).alias("span_start"))
    return days.where(F.weekday("span_start") >= 5).withColumn(
        "span_end", F.col("span_start") + one_day)
