"""Feature engineering: one narrow projection over the wide grid."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.fixed_values import ACTIVE_WATTS, APPLIANCES
from wattloom.functions.columns import (
    day_of_week, half_even, hour, is_weekend, row_count_above, row_mean, row_sum)
from wattloom.operators.clean import columns_with_prefix

CORE_FEATURES = ["hour", "day_of_week", "is_weekend", "mean_temperature", "mean_humidity",
                 "occupancy_count", "active_appliances", "total_power"]
APPLIANCE_FEATURES = [f"power_{a}" for a in APPLIANCES]
FEATURES = CORE_FEATURES + APPLIANCE_FEATURES


def engineer_features(wide: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The 16 features of each grid row; rows with a missing feature are dropped.

    `keep` names wide columns to carry along, for reports over both.
    """
    temperature = columns_with_prefix(wide, "temperature_")
    humidity = columns_with_prefix(wide, "humidity_")
    occupancy = columns_with_prefix(wide, "occupancy_")
    power = columns_with_prefix(wide, "power_")
    zero = F.lit(0.0)
    # A total delivered with the data wins over the sum of the plugs.
    total = F.col("total_power") if "total_power" in wide.columns else (
        row_sum(power) if power else zero)
    # A feature can only be missing where its inputs are, so incomplete rows are
    # filtered on the plain input columns: the same rows as a null test on every
    # feature, without evaluating the features twice.
    present = [F.coalesce(*group).isNotNull() for group in (temperature, humidity) if group]
    needed = [c for c in APPLIANCE_FEATURES if c in wide.columns]
    needed += [c for c in ("total_power",) if c in wide.columns]
    present += [F.col(c).isNotNull() for c in needed]
    complete = reduce(lambda a, b: a & b, present, F.col("timestamp").isNotNull())
    return wide.where(complete).select(
        "timestamp",
        hour("timestamp").alias("hour"),
        day_of_week("timestamp").alias("day_of_week"),
        is_weekend("timestamp").alias("is_weekend"),
        half_even(row_mean(temperature) if temperature else zero, 2).alias("mean_temperature"),
        half_even(row_mean(humidity) if humidity else zero, 2).alias("mean_humidity"),
        (row_sum(occupancy) if occupancy else zero).alias("occupancy_count"),
        (row_count_above(power, ACTIVE_WATTS) if power else F.lit(0)).alias("active_appliances"),
        half_even(total, 1).alias("total_power"),
        *[(half_even(c, 1) if c in wide.columns else zero).alias(c) for c in APPLIANCE_FEATURES],
        *(keep or []),
    )
