"""Queries over files: scans, external data sets, sinks."""

from __future__ import annotations

from pyspark.sql import Observation
from pyspark.sql import functions as F

from wattloom.catalog.base import (
    FEATURES_CTE, KEYS, LONG_CTE, TICKS_CTE, feature_table, query, r6, readings, show,
    sql_half_even, sql_r6, table, with_)
from wattloom.operators import compare, features, reshape
from wattloom.session import durable, work_path
from wattloom.sources import csv_files, external, store


def _long_text(spark, sf):
    """Readings as text rows; the values of some seconds are not numbers."""
    return readings(spark, sf).select(
        F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"), "room",
        "sensor_type", "appliance",
        F.when(F.pmod(F.second("timestamp"), F.lit(10)) == 3, "n/a")
        .otherwise(F.col("value").cast("string")).alias("value"))


def _write_csv(df, path, header=True):
    df.write.mode("append").option("header", header).option("emptyValue", "").csv(path)


_KEPT = "second(timestamp)::INT % 10 <> 3"


@query("s01_scan_csv_dir", with_(LONG_CTE, """
SELECT sensor_type, count(*) AS n FROM long GROUP BY sensor_type"""))
def s01(spark, sf):
    folder = work_path(spark, "csv")
    _write_csv(_long_text(spark, sf), folder)
    return csv_files.scan_csv_dir(spark, folder).groupBy("sensor_type").agg(
        F.count(F.lit(1)).alias("n"))


@query("s02_detect_format", with_(LONG_CTE, """
SELECT * FROM (VALUES ('long'), ('wide')) t(layout) WHERE (SELECT count(*) FROM long) > 0"""))
def s02(spark, sf):
    folder = work_path(spark, "csv")
    rows = readings(spark, sf)
    _write_csv(_long_text(spark, sf), folder)
    _write_csv(reshape.pivot_mean(rows, KEYS), folder)
    found = csv_files.headers(spark, csv_files.list_csv(spark, folder))
    kinds = sorted({csv_files.detect_format(names) for names in found.values()})
    return spark.createDataFrame([(k,) for k in kinds], "layout string")


_TICK_SUMS = ", ".join(f"round(sum({k}), 6) + 0 AS {k}" for k in KEYS)


@query("s03_load_wide", with_(TICKS_CTE, f"""
SELECT count(*) AS n, min(timestamp) AS first_ts, max(timestamp) AS last_ts, {_TICK_SUMS}
FROM ticks"""))
def s03(spark, sf):
    folder = work_path(spark, "csv")
    ticks = reshape.pivot_mean(readings(spark, sf), KEYS).withColumn(
        "timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    early = F.col("timestamp") < "2024-01-11"
    # Two shapes: the second has another column order and an unnamed time column.
    _write_csv(ticks.where(early), folder)
    _write_csv(ticks.where(~early).withColumnRenamed("timestamp", "Unnamed: 0")
               .select("Unnamed: 0", *reversed(KEYS)), folder)
    return csv_files.load_wide(spark, folder).agg(
        F.count(F.lit(1)).alias("n"), F.min("timestamp").alias("first_ts"),
        F.max("timestamp").alias("last_ts"), *[r6(F.sum(k), k, 6) for k in KEYS])


@query("s04_load_long", with_(LONG_CTE, f"""
SELECT sensor_type, room, appliance, count(*) AS n, round(sum(value), 6) + 0 AS total,
  (SELECT count(*) FROM long WHERE NOT ({_KEPT})) AS dropped
FROM long WHERE {_KEPT} GROUP BY sensor_type, room, appliance"""))
def s04(spark, sf):
    folder = work_path(spark, "csv")
    _write_csv(_long_text(spark, sf), folder)
    counted = Observation("load")
    rows = durable(csv_files.load_long(spark, folder, counted))
    return rows.groupBy("sensor_type", "room", "appliance").agg(
        F.count(F.lit(1)).alias("n"), r6(F.sum("value"), "total", 6)).withColumn(
        "dropped", F.lit(counted.get["dropped"]).cast("bigint"))


@query("s05_headerless", with_(LONG_CTE, f"""
SELECT room, count(*) AS n, round(sum(value), 6) + 0 AS total FROM long WHERE {_KEPT}
GROUP BY room"""))
def s05(spark, sf):
    folder = work_path(spark, "csv")
    text = _long_text(spark, sf)
    early = F.col("timestamp") < "2024-01-16"
    _write_csv(text.where(early), folder, header=False)
    _write_csv(text.where(~early), folder, header=True)
    return csv_files.load_long(spark, folder).groupBy("room").agg(
        F.count(F.lit(1)).alias("n"), r6(F.sum("value"), "total", 6))


_FEATURE_SUMS = ", ".join(f"round(sum({c})::DOUBLE, 3) + 0 AS {c}" for c in features.FEATURES)


@query("s06_load_features", with_(FEATURES_CTE, f"""
SELECT count(*) AS n, {_FEATURE_SUMS} FROM features"""))
def s06(spark, sf):
    path = work_path(spark, "features") + ".csv"
    store.write_result(feature_table(spark, sf).withColumn(
        "timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss")), path, fmt="csv")
    return csv_files.load_features(spark, path).agg(
        F.count(F.lit(1)).alias("n"), *[r6(F.sum(c), c, 3) for c in features.FEATURES])


def _appliances_csv(spark, sf):
    """Order lines in the shape of the ten-minute appliance data."""
    lines = table(spark, sf, "lineitem")
    path = work_path(spark, "appliances") + ".csv"
    lines.select(
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("date"),
        F.col("l_quantity").alias("Appliances"), (F.col("l_linenumber") * 10).alias("lights"),
        (F.col("l_discount") * 100).alias("T1"),
        F.when(F.col("l_linenumber") > 2, F.col("l_tax") * 100).alias("T2"),
        F.lit(-5.0).alias("T_out"), F.lit(1.0).alias("Tdewpoint"),
        (F.col("l_tax") * 500).alias("RH_1"), F.lit(99.0).alias("RH_out"),
    ).write.option("header", True).csv(path)
    return path


@query("s07_load_appliances", """
SELECT hour(l_shipdate)::INT AS hour, count(*) AS n,
  round(avg((l_discount * 100 + CASE WHEN l_linenumber > 2 THEN l_tax * 100 ELSE 0 END)
    / CASE WHEN l_linenumber > 2 THEN 2.0 ELSE 1.0 END), 6) + 0 AS mean_temperature,
  round(avg(l_tax * 500), 6) + 0 AS mean_humidity,
  round(avg(l_quantity + l_linenumber * 10), 6) + 0 AS total_power
FROM lineitem GROUP BY 1""")
def s07(spark, sf):
    df, _ = external.load_appliances(spark, _appliances_csv(spark, sf))
    return df.groupBy("hour").agg(F.count(F.lit(1)).alias("n"), *[
        r6(F.avg(c), c) for c in ("mean_temperature", "mean_humidity", "total_power")])


def _smart_home_csv(spark, sf):
    """Events in the shape of the smart-home data, some values and rows broken."""
    events = table(spark, sf, "events")
    gone = F.col("event_id") % 17 == 5
    path = work_path(spark, "home") + ".csv"
    events.select(
        F.when(F.col("event_id") % 2 == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .otherwise(F.date_format("ts", "M/d/yyyy H:mm")).alias("time"),
        F.when(~gone, F.col("value").cast("string")).alias("use [kW]"),
        F.when(~gone, F.when(F.col("event_id") % 5 == 0, "cloudy")
               .otherwise((F.col("value") / 2).cast("string"))).alias("temperature"),
        F.when(~gone, (F.col("user_id") / 200).cast("string")).alias("humidity"),
    ).write.option("header", True).csv(path)
    return path


@query("s08_load_smart_home", """
SELECT hour(ts)::INT AS hour, count(*) AS n, round(avg(value * 1000), 6) + 0 AS total_power_real,
  round(avg(CASE WHEN event_id % 5 <> 0 THEN value / 2 END), 6) + 0 AS mean_temperature_real,
  round(avg(user_id / 200 * 100), 6) + 0 AS mean_humidity_real
FROM events WHERE event_id % 17 <> 5 GROUP BY 1""")
def s08(spark, sf):
    df, _ = external.load_smart_home(spark, _smart_home_csv(spark, sf))
    return df.groupBy("hour").agg(F.count(F.lit(1)).alias("n"), *[
        r6(F.avg(c), c) for c in
        ("total_power_real", "mean_temperature_real", "mean_humidity_real")])


_REAL = {
    "total_power": "l_quantity + l_linenumber * 10",
    "mean_temperature": "(l_discount * 100 + CASE WHEN l_linenumber > 2 THEN l_tax * 100 ELSE 0 END)"
                        " / CASE WHEN l_linenumber > 2 THEN 2.0 ELSE 1.0 END",
    "mean_humidity": "l_tax * 500", "hour": "hour(l_shipdate)"}


@query("j04_feature_map", with_(FEATURES_CTE, " UNION ALL ".join(
    f"""SELECT '{c} vs {c}' AS feature,
  {sql_half_even(f"(SELECT avg({c}) FROM features)", 2)} AS emulated_mean,
  {sql_half_even(f"(SELECT avg({x}) FROM lineitem)", 2)} AS real_mean,
  (SELECT count({c}) FROM features) AS emulated_n, (SELECT count(*) FROM lineitem) AS real_n,
  {sql_half_even(f"(SELECT min({x}) FROM lineitem)", 2)} AS real_min,
  {sql_half_even(f"(SELECT max({x}) FROM lineitem)", 2)} AS real_max""" for c, x in _REAL.items())))
def j04(spark, sf):
    real, mapping = external.load_appliances(spark, _appliances_csv(spark, sf))
    pairs = {**mapping, "no_such_column": "total_power"}  # skipped with a warning
    result = compare.validate_against(durable(feature_table(spark, sf)), real, pairs, "Appliances")
    return show(result.select("feature", "emulated_mean", "real_mean", "emulated_n", "real_n",
                              "real_min", "real_max"))


@query("s09_sink_by_date", with_(FEATURES_CTE, """
SELECT timestamp::DATE AS date, count(*) AS n, round(sum(total_power), 3) + 0 AS total
FROM features WHERE timestamp::DATE BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' GROUP BY 1"""))
def s09(spark, sf):
    path = work_path(spark, "features")
    store.write_by_date(feature_table(spark, sf), path)
    return store.read_days(spark, path, "2024-01-05", "2024-01-20").groupBy("date").agg(
        F.count(F.lit(1)).alias("n"), r6(F.sum("total_power"), "total", 3))


@query("s09_sink_all_days", with_(FEATURES_CTE, """
SELECT timestamp::DATE AS date, count(*) AS n, round(sum(total_power), 3) + 0 AS total
FROM features GROUP BY 1"""))
def s09_all(spark, sf):
    path = work_path(spark, "features")
    store.write_by_date(feature_table(spark, sf), path)
    return store.read_days(spark, path).groupBy("date").agg(
        F.count(F.lit(1)).alias("n"), r6(F.sum("total_power"), "total", 3))


@query("s12_result_sink", f"""
SELECT event_type, {sql_half_even("avg(value)", 2)} AS mean_value,
  {sql_half_even("max(value)", 1)} AS max_value FROM events GROUP BY event_type""")
def s12(spark, sf):
    path = work_path(spark, "result")
    means = table(spark, sf, "events").groupBy("event_type").agg(
        F.avg("value").alias("mean_value"), F.max("value").alias("max_value"))
    store.write_result(means, path, {"mean_value": 2, "max_value": 1})
    return spark.read.parquet(path)


@query("k02_build_features", with_(FEATURES_CTE, f"""
SELECT timestamp, {", ".join(features.FEATURES)} FROM features"""))
def k02(spark, sf):
    return feature_table(spark, sf)


@query("k07_quality_report", with_(FEATURES_CTE, f"""
SELECT 'completeness' AS section, 'completeness_pct' AS item, {sql_r6(
    "count(*) * 100.0 / ((max(timestamp)::DATE - min(timestamp)::DATE + 1) * 288)", "value", 9)}
FROM features
UNION ALL SELECT 'power', 'mean', {sql_r6("avg(total_power)", "value", 9)} FROM features
UNION ALL SELECT 'power', 'max', {sql_r6("max(total_power)", "value", 9)} FROM features
UNION ALL SELECT 'power', 'min', {sql_r6("min(total_power)", "value", 9)} FROM features
UNION ALL SELECT 'correlation', 'occupancy_count', {sql_r6(
    "corr(occupancy_count, total_power)", "value", 9)} FROM features"""))
def k07(spark, sf):
    from wattloom.plans.phases import quality_report
    report = quality_report(durable(feature_table(spark, sf)))
    wanted = (F.col("section").isin("completeness", "power")
              | ((F.col("section") == "correlation") & (F.col("item") == "occupancy_count")))
    return report.where(wanted).select("section", "item", r6("value", digits=9))
