"""External data sets that the household data is validated against."""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.functions.columns import number, parse_ts, row_mean
from wattloom.sources.csv_files import _scan, header_of

log = logging.getLogger(__name__)

# Household column -> external column (fixed values).
APPLIANCES_MAP = {"mean_temperature": "mean_temperature", "mean_humidity": "mean_humidity",
                  "total_power": "total_power", "hour": "hour"}
SMART_HOME_MAP = {"total_power": "total_power_real", "mean_temperature": "mean_temperature_real",
                  "mean_humidity": "mean_humidity_real", "hour": "hour"}


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        names = header_of(spark, path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        names = None
    if names is None:
        log.error("no data set at %s", path)
        return None
    return _scan(spark, [path], names, header=True)


def load_appliances(spark: SparkSession, path: str) -> tuple[DataFrame | None, dict | None]:
    """Ten-minute appliance data: indoor means, total power and hour, with the map."""
    raw = _read(spark, path)
    if raw is None:
        return None, None
    df = raw.select(parse_ts("date").alias("date"), *[
        number(F.col(f"`{c}`")).alias(c) for c in raw.columns if c != "date"])
    indoor_t = [c for c in df.columns if c.startswith("T") and c not in ("T_out", "Tdewpoint")]
    indoor_h = [c for c in df.columns if c.startswith("RH") and c != "RH_out"]
    if indoor_t:
        df = df.withColumn("mean_temperature", row_mean(indoor_t))
    if indoor_h:
        df = df.withColumn("mean_humidity", row_mean(indoor_h))
    lights = F.col("lights") if "lights" in df.columns else F.lit(0.0)
    return df.withColumns({"total_power": F.col("Appliances") + lights,
                           "hour": F.hour("date")}), dict(APPLIANCES_MAP)


def load_smart_home(spark: SparkSession, path: str) -> tuple[DataFrame | None, dict | None]:
    """Smart-home data with weather: every column numeric, kW to W, humidity to percent."""
    raw = _read(spark, path)
    if raw is None:
        return None, None
    values = [c for c in raw.columns if c != "time"]
    present = raw.dropna(how="all", subset=[f"`{c}`" if "." in c else c for c in values])
    df = present.select(parse_ts("time").alias("time"),
                        *[number(F.col(f"`{c}`")).alias(c) for c in values])
    return df.withColumns({
        "total_power_real": F.col("`use [kW]`") * 1000.0,
        "mean_temperature_real": F.col("temperature"),
        "mean_humidity_real": F.col("humidity") * 100.0,
        "hour": F.hour("time")}), dict(SMART_HOME_MAP)
