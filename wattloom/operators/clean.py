"""Cleaning and relational basics on reading tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from wattloom.fixed_values import ENVIRONMENT
from wattloom.functions.columns import clip, number, parse_ts

LONG_COLUMNS = ["timestamp", "room", "sensor_type", "appliance", "value"]


def is_environment(sensor_type: str = "sensor_type") -> Column:
    """Environmental sensors by name; everything else, null included, is an appliance."""
    return F.coalesce(F.col(sensor_type).isin(*ENVIRONMENT), F.lit(False))


def reading_key() -> Column:
    """Wide column a reading belongs to; null where the naming part is missing.

    `concat` is used for its null propagation: a missing room or appliance makes
    the key null and the row is left out of the pivot.
    """
    room = F.nullif(F.col("room"), F.lit(""))
    appliance = F.nullif(F.col("appliance"), F.lit(""))
    return F.when(
        is_environment(), F.concat(F.col("sensor_type"), F.lit("_"), room)
    ).otherwise(F.concat(F.lit("power_"), appliance))


def clean_long(df: DataFrame, counted: Observation | None = None) -> DataFrame:
    """Parse time and value, drop rows that lack either.

    `counted` receives the totals in the same pass: rows seen and rows dropped.
    """
    parsed = df.select(
        parse_ts("timestamp").alias("timestamp"),
        *[F.nullif(F.col(c).cast("string"), F.lit("")).alias(c)
          for c in ("room", "sensor_type", "appliance")],
        number("value").alias("value"),
    )
    keep = F.col("timestamp").isNotNull() & F.col("value").isNotNull()
    if counted is not None:
        parsed = parsed.observe(
            counted, F.count(F.lit(1)).alias("rows"), F.count_if(~keep).alias("dropped"))
    return parsed.where(keep)


def split_by_sensor(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(environmental rows, appliance rows)."""
    return df.where(is_environment()), df.where(~is_environment())


def columns_with_prefix(df: DataFrame, *prefixes: str, exclude: tuple[str, ...] = ()) -> list[str]:
    return [c for c in df.columns if c.startswith(prefixes) and c not in exclude]


def with_default(df: DataFrame, name: str, default: float) -> DataFrame:
    """Add a constant column where the table lacks it."""
    return df if name in df.columns else df.withColumn(name, F.lit(default))


def features_and_target(df: DataFrame, target: str = "total_power") -> tuple[list[str], str]:
    return [c for c in df.columns if c != target], target


def drop_incomplete(df: DataFrame, how: str = "any", subset: list[str] | None = None) -> DataFrame:
    return df.dropna(how=how, subset=subset)


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Union-all by column name; columns a table lacks become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def pool(first: DataFrame, second: DataFrame, value: str,
         names: tuple[str, str] = ("emulated", "real")) -> DataFrame:
    """Two samples in one table, tagged by side."""
    return first.select(F.lit(names[0]).alias("side"), F.col(value).alias("value")).unionAll(
        second.select(F.lit(names[1]).alias("side"), F.col(value).alias("value")))


def unpivot(df: DataFrame, ids: list[str], cols: list[str],
            name: str = "feature", value: str = "value") -> DataFrame:
    """Columns to rows; a narrow operation."""
    return df.select(*ids, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        ids, cols, name, value)


def cap_readings(df: DataFrame, limits: DataFrame, default_max: float) -> DataFrame:
    """Clip appliance readings to [0, cap]; other readings pass unchanged."""
    capped = df.join(limits.select("appliance", "max_power"), "appliance", "left")
    cap = F.coalesce(F.col("max_power"), F.lit(default_max))
    return capped.withColumn(
        "value",
        F.when(F.col("appliance").isNotNull(),
               F.greatest(F.least(F.col("value"), cap), F.lit(0.0))).otherwise(F.col("value")),
    ).drop("max_power")


def cap_column(df: DataFrame, name: str, low: float, high: float) -> DataFrame:
    return df.withColumn(name, clip(name, low, high))
