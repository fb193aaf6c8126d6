"""Queries over cleaning, reshaping, features, order and descriptive statistics."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from wattloom.catalog.base import (
    FEATURES_CTE, GRID_CTE, KEYS, LONG_CTE, TICKS_CTE, WIDE_CTE, feature_table, query, r6,
    readings, show, sql_half_even, sql_r6, sql_row_mean, sql_row_sum, table, wide_grid,
    wide_with_features, with_)
from wattloom.fixed_values import (
    APPLIANCE_EXPECTATIONS, APPLIANCE_LIMITS, APPLIANCE_SCHEDULES, APPLIANCES, DAY_NAMES,
    LEARNING_FRACTIONS, ROOMS)
from wattloom.functions import columns as fx
from wattloom.operators import clean, features, ordered, profiles, quality, reshape
from wattloom.operators.distribution import equal_width_histogram
from wattloom.session import durable, work_path

_r = lambda cols, digits=6: ", ".join(sql_r6(c, None, digits) for c in cols)
# Averages of one-decimal values can end in a 5 at the seventh digit, a rounding tie
# at six; they never need more than nine digits.
MEAN = 9


# --- projections and filters -------------------------------------------------

@query("p01_sensor_split", with_(LONG_CTE, """
SELECT sensor_type IN ('temperature', 'humidity', 'occupancy') AS environment,
       count(*) AS n, round(sum(value), 6) AS total FROM long GROUP BY 1"""))
def p01(spark, sf):
    rows = readings(spark, sf)
    environment, appliances = clean.split_by_sensor(rows)
    both = environment.withColumn("environment", F.lit(True)).unionAll(
        appliances.withColumn("environment", F.lit(False)))
    return both.groupBy("environment").agg(F.count(F.lit(1)).alias("n"),
                                           r6(F.sum("value"), "total", 6))


@query("p02_pivot_key", with_(LONG_CTE, """
SELECT key, count(*) AS n FROM keyed WHERE key IS NOT NULL GROUP BY key"""))
def p02(spark, sf):
    return (readings(spark, sf).select(clean.reading_key().alias("key")).where("key IS NOT NULL")
            .groupBy("key").agg(F.count(F.lit(1)).alias("n")))


@query("p03_prefix_select", with_(WIDE_CTE, f"""
SELECT timestamp, {_r([k for k in KEYS if k.startswith(("temperature_", "humidity_"))])}
FROM wide"""))
def p03(spark, sf):
    wide = wide_grid(spark, sf)
    return show(wide.select("timestamp", *clean.columns_with_prefix(
        wide, "temperature_", "humidity_")))


@query("p04_feature_target_split", with_(FEATURES_CTE, f"""
SELECT pos::INT AS pos, feature, 'total_power' AS target FROM (VALUES {", ".join(
    f"({i}, '{c}')" for i, c in enumerate(
        c for c in ["timestamp", *features.FEATURES] if c != "total_power"))}) t(pos, feature)
WHERE (SELECT count(*) FROM features) > 0"""))
def p04(spark, sf):
    table_ = feature_table(spark, sf)
    names, target = clean.features_and_target(table_)
    listed = F.posexplode(F.array(*[F.lit(n) for n in names])).alias("pos", "feature")
    return table_.limit(1).select(listed, F.lit(target).alias("target"))


@query("p05_default_fill", with_(TICKS_CTE, """
SELECT timestamp, 0.0::DOUBLE AS mean_humidity, 0.0::DOUBLE AS power_kettle,
       0.0::DOUBLE AS total_power, 0 AS active_appliances FROM ticks
WHERE coalesce(temperature_bedroom, temperature_living_room, temperature_bathroom,
               temperature_kitchen, temperature_studio) IS NOT NULL"""))
def p05(spark, sf):
    ticks = reshape.pivot_mean(readings(spark, sf), KEYS)
    lean = ticks.select("timestamp", *clean.columns_with_prefix(ticks, "temperature_"))
    return features.engineer_features(lean).select(
        "timestamp", "mean_humidity", "power_kettle", "total_power", "active_appliances")


@query("p06_drop_null_rows", with_(WIDE_CTE, f"""
SELECT (SELECT count(*) FROM wide WHERE {" AND ".join(
    f"{k} IS NOT NULL" for k in KEYS)}) AS any_kept,
  (SELECT count(*) FROM ticks WHERE coalesce({", ".join(KEYS)}) IS NOT NULL) AS all_kept"""))
def p06(spark, sf):
    ticks = reshape.pivot_mean(readings(spark, sf), KEYS)
    first = clean.drop_incomplete(wide_grid(spark, sf), "any", KEYS).select(F.lit(1).alias("k"))
    second = clean.drop_incomplete(ticks, "all", KEYS).select(F.lit(2).alias("k"))
    return first.unionAll(second).agg(F.count_if(F.col("k") == 1).alias("any_kept"),
                                      F.count_if(F.col("k") == 2).alias("all_kept"))


@query("p07_weekend_filter", with_(FEATURES_CTE, f"""
SELECT is_weekend, count(*) AS n, {sql_r6("avg(total_power)", "mean_power", MEAN)}
FROM features GROUP BY is_weekend"""))
def p07(spark, sf):
    return feature_table(spark, sf).groupBy("is_weekend").agg(
        F.count(F.lit(1)).alias("n"), r6(F.avg("total_power"), "mean_power", MEAN))


@query("p08_hour_set", with_(FEATURES_CTE, f"""
SELECT hour IN (18, 19, 20, 21, 22) AS peak, {sql_r6("avg(power_television)", "mean_watts", MEAN)},
       count(*) AS n FROM features GROUP BY 1"""))
def p08(spark, sf):
    peak = F.array_contains(F.array(*[F.lit(h) for h in (18, 19, 20, 21, 22)]), F.col("hour"))
    return feature_table(spark, sf).groupBy(peak.alias("peak")).agg(
        r6(F.avg("power_television"), "mean_watts", MEAN), F.count(F.lit(1)).alias("n"))


@query("p09_numeric_coercion", """
SELECT event_type, count(*) AS rows_in, count(x) AS rows_kept, round(sum(x), 4) AS total FROM (
  SELECT event_type, CASE WHEN event_id % 7 = 0 THEN NULL
    WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 13 = 0 THEN NULL ELSE value END AS x
  FROM events) GROUP BY event_type""")
def p09(spark, sf):
    # Some values are replaced by text that is not a number, and by 'nan'.
    dirty = table(spark, sf, "events").withColumn(
        "raw", F.when(F.col("event_id") % 7 == 0, "n/a").when(F.col("event_id") % 11 == 0, "nan")
        .when(F.col("event_id") % 13 == 0, "").otherwise(F.col("value").cast("string")))
    x = fx.number("raw")
    return dirty.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("rows_in"), F.count(x).alias("rows_kept"),
        r6(F.sum(x), "total", 4))


# --- joins -------------------------------------------------------------------

@query("j01_outer_join_pivots", with_(TICKS_CTE, f"""
SELECT timestamp, {_r(KEYS)} FROM ticks"""))
def j01(spark, sf):
    environment, appliances = clean.split_by_sensor(readings(spark, sf))
    joined = reshape.outer_join_pivots(
        reshape.pivot_mean(environment, [k for k in KEYS if not k.startswith("power_")]),
        reshape.pivot_mean(appliances, [k for k in KEYS if k.startswith("power_")]))
    return show(joined)


_SCHEDULE_SQL = ", ".join(f"('{a}', {w}, {h}, {p}::DOUBLE)"
                          for a, w, hours in APPLIANCE_SCHEDULES for h, p in hours.items())


@query("j05_schedule_lookup", with_(LONG_CTE, f"""
SELECT l.appliance, (isodow(timestamp) >= 6)::INT AS is_weekend, hour(timestamp)::INT AS hour,
       coalesce(max(p), 0) AS probability, count(*) AS n
FROM long l LEFT JOIN (VALUES {_SCHEDULE_SQL}) s(appliance, w, h, p)
  ON s.appliance = l.appliance AND s.w = (isodow(timestamp) >= 6)::INT AND s.h = hour(timestamp)
WHERE l.appliance IS NOT NULL GROUP BY 1, 2, 3"""))
def j05(spark, sf):
    rows = readings(spark, sf).where("appliance IS NOT NULL").groupBy(
        "appliance", fx.is_weekend("timestamp").alias("is_weekend"),
        fx.hour("timestamp").alias("hour")).agg(F.count(F.lit(1)).alias("n"))
    return quality.with_expected_activation(rows)


_EXPECT_SQL = ", ".join(
    "('%s', %s, [%s])" % (e[0], ", ".join(f"{v}::DOUBLE" for v in e[1:9]),
                          ", ".join(map(str, e[9]))) for e in APPLIANCE_EXPECTATIONS)
_EXPECT_COLS = ("appliance, max_watts, mean_lo, mean_hi, act_lo, act_hi, active_threshold, "
                "zero_lo, zero_hi, peak_hours")


@query("j06_expectation_lookup", with_(LONG_CTE, f"""
SELECT l.appliance, count(*) AS n, count(*) FILTER (WHERE value > active_threshold) AS active,
       count(*) FILTER (WHERE list_contains(peak_hours, hour(timestamp)::INT)) AS in_peak
FROM long l JOIN (VALUES {_EXPECT_SQL}) e({_EXPECT_COLS}) USING (appliance)
GROUP BY l.appliance"""))
def j06(spark, sf):
    joined = readings(spark, sf).join(F.broadcast(quality.expectations(spark)), "appliance")
    return joined.groupBy("appliance").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("value") > F.col("active_threshold")).alias("active"),
        F.count_if(F.array_contains("peak_hours", F.hour("timestamp"))).alias("in_peak"))


@query("j07_calendar_spine", with_(GRID_CTE, f"""
SELECT timestamp, {_r(KEYS)} FROM grid"""))
def j07(spark, sf):
    rows = readings(spark, sf)
    binned = reshape.pivot_mean(rows, KEYS).groupBy(
        reshape.bin_start("timestamp", "5 minutes").alias("timestamp")).agg(
        *[F.avg(k).alias(k) for k in KEYS])
    return show(reshape.join_spine(binned, reshape.spine(rows.select("timestamp"), "5 minutes")))


# --- aggregations ------------------------------------------------------------

@query("a01_pivot_mean", with_(TICKS_CTE, f"SELECT timestamp, {_r(KEYS)} FROM ticks"))
def a01(spark, sf):
    return show(reshape.pivot_mean(readings(spark, sf), KEYS))


@query("a02_resample_mean", with_(GRID_CTE, f"SELECT timestamp, {_r(KEYS)} FROM grid"))
def a02(spark, sf):
    rows = readings(spark, sf)
    return show(reshape.resample_mean(reshape.pivot_mean(rows, KEYS), bounds=rows))


_T = [k for k in KEYS if k.startswith("temperature_")]
_O = [k for k in KEYS if k.startswith("occupancy_")]
_P = [k for k in KEYS if k.startswith("power_")]


@query("a03_row_mean", with_(TICKS_CTE, f"""
SELECT timestamp, {sql_r6(sql_row_mean(_T), "mean_temperature")} FROM ticks"""))
def a03(spark, sf):
    return reshape.pivot_mean(readings(spark, sf), KEYS).select(
        "timestamp", r6(fx.row_mean(_T), "mean_temperature"))


@query("a04_row_sum", with_(TICKS_CTE, f"""
SELECT timestamp, {sql_r6(sql_row_sum(_O), "occupancy_count")},
       {sql_r6(sql_row_sum(_P), "total_power")} FROM ticks"""))
def a04(spark, sf):
    return reshape.pivot_mean(readings(spark, sf), KEYS).select(
        "timestamp", r6(fx.row_sum(_O), "occupancy_count"), r6(fx.row_sum(_P), "total_power"))


@query("a05_row_conditional_count", with_(TICKS_CTE, f"""
SELECT timestamp, ({" + ".join(f"coalesce({c} > 10, false)::INT" for c in _P)})::INT AS active
FROM ticks"""))
def a05(spark, sf):
    return reshape.pivot_mean(readings(spark, sf), KEYS).select(
        "timestamp", fx.row_count_above(_P, 10.0).alias("active"))


@query("a06_completeness", with_(FEATURES_CTE, f"""
SELECT count(*) AS row_count, min(timestamp) AS first_ts, max(timestamp) AS last_ts,
  ((max(timestamp)::DATE - min(timestamp)::DATE + 1) * 288)::BIGINT AS expected_rows,
  {sql_r6("count(*) * 100.0 / ((max(timestamp)::DATE - min(timestamp)::DATE + 1) * 288)",
          "completeness_pct")} FROM features"""))
def a06(spark, sf):
    return show(profiles.completeness(feature_table(spark, sf)))


_SENSORS = [k for k in KEYS if not k.startswith("power_")]
_SUMMARY_COLS = _SENSORS + ["total_power"] + _P
_JOINED_CTE = FEATURES_CTE + f""",
joined AS (SELECT f.*, {", ".join("w." + k for k in _SENSORS)}
           FROM features f JOIN wide w USING (timestamp)),
tall AS (SELECT sensor, value FROM (SELECT {", ".join(f"{c}::DOUBLE AS {c}" for c in _SUMMARY_COLS)}
         FROM joined) UNPIVOT INCLUDE NULLS (value FOR sensor IN ({", ".join(_SUMMARY_COLS)})))"""


@query("a06_sensor_summary", with_(_JOINED_CTE, f"""
SELECT sensor, count(*) AS row_count, {sql_r6("min(value)", "min_value", MEAN)},
  {sql_r6("max(value)", "max_value", MEAN)}, {sql_r6("avg(value)", "mean_value", MEAN)},
  {sql_r6("stddev_samp(value)", "std_value", MEAN)},
  {sql_r6("CASE WHEN starts_with(sensor, 'occupancy_') THEN avg(value) * 100 END",
          "occupied_pct", MEAN)},
  {sql_r6("CASE WHEN starts_with(sensor, 'power_') THEN count(*) FILTER (WHERE value < 1) * 100.0"
          " / count(*) END", "zero_pct", MEAN)}
FROM tall GROUP BY sensor"""))
def a06_summary(spark, sf):
    return show(profiles.sensor_summary(wide_with_features(spark, sf).drop("occupancy_count")), MEAN)


_PROFILE_COLS = _SENSORS + ["total_power"]


@query("a07_hourly_profile", with_(_JOINED_CTE, f"""
SELECT hour, sensor, round(mean_value, 9) + 0 AS mean_value FROM (
  SELECT hour, {", ".join(f"avg({c}) AS {c}" for c in _PROFILE_COLS)} FROM joined GROUP BY hour)
UNPIVOT (mean_value FOR sensor IN ({", ".join(_PROFILE_COLS)}))"""))
def a07(spark, sf):
    return show(profiles.hourly_profile(wide_with_features(spark, sf), _PROFILE_COLS), MEAN)


@query("a08_weekend_profile", with_(FEATURES_CTE, f"""
SELECT is_weekend, hour, {sql_r6("avg(occupancy_count)", "occupancy_count", MEAN)},
  {sql_r6("avg(total_power)", "total_power", MEAN)}, {sql_r6("avg(mean_temperature)", "mean_temperature", MEAN)}
FROM features GROUP BY is_weekend, hour"""))
def a08(spark, sf):
    return show(profiles.weekend_profile(feature_table(spark, sf)), MEAN)


_REALISM_SQL = f""",
rows AS (SELECT replace(name, 'power_', '') AS appliance, watts, hour, occupancy_count FROM (
  SELECT hour, occupancy_count, {", ".join(_P)} FROM features)
  UNPIVOT (watts FOR name IN ({", ".join(_P)}))),
figures AS (
  SELECT r.appliance, any_value(e) AS e, max(watts) AS max_power, avg(watts) AS mean_power,
    count(*) FILTER (WHERE watts > active_threshold) / (count(*) / 288.0::DOUBLE) AS per_day,
    coalesce(count(*) FILTER (WHERE occupancy_count = 0 AND watts > active_threshold) * 100.0
      / nullif(count(*) FILTER (WHERE occupancy_count = 0), 0), 0) AS unoccupied_pct,
    avg(watts) FILTER (WHERE list_contains(peak_hours, hour)) AS peak_mean,
    CASE WHEN count(*) FILTER (WHERE NOT list_contains(peak_hours, hour)) > 0
      THEN avg(watts) FILTER (WHERE NOT list_contains(peak_hours, hour)) ELSE 0 END AS off_mean,
    count(*) FILTER (WHERE watts < 1) * 100.0 / count(*) AS zero_pct
  FROM rows r JOIN (VALUES {_EXPECT_SQL}) e({_EXPECT_COLS}) ON e.appliance = r.appliance
  GROUP BY r.appliance),
checked AS (
  SELECT *, coalesce(max_power <= e.max_watts, false) AS max_ok,
    coalesce(e.mean_lo < mean_power AND mean_power < e.mean_hi, false) AS mean_ok,
    coalesce(e.act_lo < per_day AND per_day < e.act_hi, false) AS activations_ok,
    coalesce(unoccupied_pct < 3, false) AS unoccupied_ok,
    coalesce(peak_mean > off_mean * 1.5, false) AS peak_ok,
    coalesce(zero_pct BETWEEN e.zero_lo AND e.zero_hi, false) AS standby_ok FROM figures),
scored AS (SELECT *, max_ok::INT + mean_ok::INT + activations_ok::INT + unoccupied_ok::INT
  + peak_ok::INT + standby_ok::INT AS passed FROM checked)"""


@query("a09_appliance_realism", with_(FEATURES_CTE + _REALISM_SQL, f"""
SELECT appliance, {_r(["max_power", "mean_power", "per_day", "unoccupied_pct", "peak_mean",
                       "off_mean", "zero_pct"], MEAN)},
  max_ok, mean_ok, activations_ok, unoccupied_ok, peak_ok, standby_ok, passed::INT AS passed,
  6 AS checks FROM scored"""))
def a09(spark, sf):
    return show(quality.appliance_realism(feature_table(spark, sf)), MEAN)


@query("a09_realism_totals", with_(FEATURES_CTE + _REALISM_SQL, """
SELECT sum(passed)::BIGINT AS passed, (count(*) * 6)::BIGINT AS checks FROM scored"""))
def a09_totals(spark, sf):
    return quality.realism_totals(quality.appliance_realism(feature_table(spark, sf)))


_PAIRS = [(a, b) for i, a in enumerate(features.CORE_FEATURES)
          for b in features.CORE_FEATURES[i + 1:]]


@query("a10_correlations", with_(FEATURES_CTE, " UNION ALL ".join(
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, {sql_r6(f'corr({a}, {b})', 'r')} FROM features"
    for a, b in _PAIRS)))
def a10(spark, sf):
    return show(profiles.correlations(feature_table(spark, sf)))


@query("a10_target_correlations", with_(FEATURES_CTE, "SELECT *, CASE WHEN abs(r) > 0.5 THEN "
       "'strong' WHEN abs(r) > 0.3 THEN 'moderate' ELSE 'weak' END AS strength FROM (" +
       " UNION ALL ".join(
           f"SELECT '{c}' AS feature, {sql_r6(f'corr({c}, total_power)', 'r')} FROM features"
           for c in features.CORE_FEATURES[:-1]) + ")"))
def a10_target(spark, sf):
    return show(profiles.target_correlations(feature_table(spark, sf)))


_DAYS_SQL = ", ".join(f"({i}, '{d}')" for i, d in enumerate(DAY_NAMES))
_DAILY_SQL = f""",
daily AS (
  SELECT d.day_number::INT AS day_number, d.day_name,
    CASE WHEN d.day_number >= 5 THEN 'Weekend' ELSE 'Weekday' END AS is_weekend,
    count(f.timestamp) AS record_count,
    {sql_half_even("avg(total_power)", 1)} AS power_mean,
    {sql_half_even("stddev_samp(total_power)", 1)} AS power_std,
    {sql_half_even("quantile_cont(total_power, 0.5)", 1)} AS power_median,
    min(total_power) AS power_min, max(total_power) AS power_max,
    {sql_half_even("avg(occupancy_count)", 2)} AS occupancy_mean,
    {sql_half_even("stddev_samp(occupancy_count)", 2)} AS occupancy_std,
    {sql_half_even("avg(active_appliances)", 2)} AS active_appliances_mean,
    {sql_half_even("avg(mean_temperature)", 2)} AS temperature_mean
  FROM (VALUES {_DAYS_SQL}) d(day_number, day_name)
  LEFT JOIN features f ON f.day_of_week = d.day_number GROUP BY ALL)"""


@query("a11_daily_stats", with_(FEATURES_CTE + _DAILY_SQL, "SELECT * FROM daily"))
def a11(spark, sf):
    return show(profiles.daily_stats(durable(feature_table(spark, sf))))


@query("a12_weekday_contrast", with_(FEATURES_CTE + _DAILY_SQL, f"""
SELECT {_r(["weekday_mean", "weekend_mean", "weekday_range"])},
  {sql_r6("abs(weekday_mean - weekend_mean) / weekday_mean * 100", "pct_difference")},
  weekday_range < 5 AS minimal_variation FROM (
  SELECT avg(power_mean) FILTER (WHERE is_weekend = 'Weekday') AS weekday_mean,
    avg(power_mean) FILTER (WHERE is_weekend = 'Weekend') AS weekend_mean,
    max(power_mean) FILTER (WHERE is_weekend = 'Weekday')
      - min(power_mean) FILTER (WHERE is_weekend = 'Weekday') AS weekday_range FROM daily)"""))
def a12(spark, sf):
    return show(profiles.weekday_weekend_contrast(profiles.daily_stats(durable(feature_table(spark, sf)))))


@query("a13_hourly_by_day", with_(FEATURES_CTE, f"""
SELECT day_of_week, is_weekend, hour, {sql_r6("avg(total_power)", "mean_power", MEAN)} FROM features
GROUP BY GROUPING SETS ((day_of_week, hour), (is_weekend, hour))"""))
def a13(spark, sf):
    return show(profiles.hourly_by_day(feature_table(spark, sf)), MEAN)


@query("a14_day_distribution", with_(FEATURES_CTE + """,
q AS (SELECT day_of_week, avg(total_power) AS power_mean, stddev_samp(total_power) AS power_std,
    avg(occupancy_count) AS occupancy_mean, stddev_samp(occupancy_count) AS occupancy_std,
    quantile_cont(total_power, 0.25) AS q1, quantile_cont(total_power, 0.5) AS median,
    quantile_cont(total_power, 0.75) AS q3 FROM features GROUP BY day_of_week),
ends AS (SELECT day_of_week, min(total_power) AS whisker_low, max(total_power) AS whisker_high
  FROM features JOIN q USING (day_of_week)
  WHERE total_power >= q1 - (q3 - q1) * 1.5 AND total_power <= q3 + (q3 - q1) * 1.5
  GROUP BY day_of_week)""", f"""
SELECT day_of_week, {_r(["power_mean", "power_std", "occupancy_mean", "occupancy_std", "q1",
                         "median", "q3", "whisker_low", "whisker_high"], MEAN)}
FROM q JOIN ends USING (day_of_week)"""))
def a14(spark, sf):
    return show(profiles.day_distribution(durable(feature_table(spark, sf))), MEAN)


@query("a19_ingest_counts", with_(LONG_CTE, """
SELECT 'total_messages' AS counter, count(*) AS n FROM long
UNION ALL SELECT 'sensor_' || sensor_type, count(*) FROM long GROUP BY sensor_type
UNION ALL SELECT 'room_' || room, count(*) FROM long GROUP BY room"""))
def a19(spark, sf):
    return profiles.ingest_counts(readings(spark, sf))


@query("a19_message_rate", with_(LONG_CTE, f"""
SELECT total_messages, elapsed_s, {sql_r6("total_messages / elapsed_s", "rate")} FROM (
  SELECT count(*) AS total_messages,
    floor(epoch_us(max(timestamp)) / 1e6 - epoch_us(min(timestamp)) / 1e6)::BIGINT AS elapsed_s
  FROM long)"""))
def a19_rate(spark, sf):
    return show(profiles.message_rate(readings(spark, sf)))


@query("a22_weekend_spans", """
SELECT d AS span_start, d + INTERVAL 1 DAY AS span_end FROM (
  SELECT unnest(generate_series(date_trunc('day', min(ts))::TIMESTAMP,
    date_trunc('day', max(ts))::TIMESTAMP, INTERVAL 1 DAY)) AS d FROM events)
WHERE isodow(d) >= 6""")
def a22(spark, sf):
    return profiles.weekend_spans(readings(spark, sf))


# --- ordered operations --------------------------------------------------------

@query("w01_forward_fill", with_(GRID_CTE, "SELECT timestamp, " + ", ".join(
    f"round(last_value({k} IGNORE NULLS) OVER (ORDER BY timestamp ROWS BETWEEN UNBOUNDED "
    f"PRECEDING AND CURRENT ROW), 6) + 0 AS {k}" for k in KEYS) + " FROM grid"))
def w01(spark, sf):
    rows = readings(spark, sf)
    grid = reshape.resample_mean(reshape.pivot_mean(rows, KEYS), bounds=rows)
    return show(reshape.fill_gaps(grid, backward=False))


@query("w02_back_fill", with_(WIDE_CTE, f"SELECT timestamp, {_r(KEYS)} FROM wide"))
def w02(spark, sf):
    return show(wide_grid(spark, sf))


_LINE_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
_INDEXED_CTE = f"""indexed AS (SELECT *, row_number() OVER (ORDER BY {", ".join(_LINE_ORDER)}) - 1
  AS row_id, count(*) OVER () AS n FROM lineitem)"""


def _tag_summary(df, tag):
    return df.groupBy(tag).agg(
        F.count(F.lit(1)).alias("n"), F.min("l_shipdate").alias("first_ts"),
        F.max("l_shipdate").alias("last_ts"), r6(F.sum("l_extendedprice"), "total", 2))


_TAG_SQL = ("count(*) AS n, min(l_shipdate) AS first_ts, max(l_shipdate) AS last_ts, "
            "round(sum(l_extendedprice), 2) + 0 AS total FROM indexed")


@query("w03_temporal_split", with_(_INDEXED_CTE, f"""
SELECT CASE WHEN row_id < floor(n * (1 - 0.2::DOUBLE)) THEN 'train' ELSE 'test' END AS split,
  {_TAG_SQL} GROUP BY 1"""))
def w03(spark, sf):
    return _tag_summary(ordered.temporal_split(table(spark, sf, "lineitem"), _LINE_ORDER), "split")


@query("w03_row_index", with_(_INDEXED_CTE, f"""
SELECT row_id, {", ".join(_LINE_ORDER)} FROM indexed"""))
def w03_index(spark, sf):
    return ordered.row_index(table(spark, sf, "lineitem").select(*_LINE_ORDER), _LINE_ORDER)


@query("w04_contiguous_folds", with_(_INDEXED_CTE, f"""
SELECT (CASE WHEN row_id < (n % 5) * (n // 5 + 1) THEN row_id // (n // 5 + 1)
  ELSE (row_id - (n % 5)) // (n // 5) END)::INT AS fold, {_TAG_SQL} GROUP BY 1"""))
def w04(spark, sf):
    return _tag_summary(ordered.contiguous_folds(table(spark, sf, "lineitem"), _LINE_ORDER), "fold")


@query("w05_prefix_subset", with_(_INDEXED_CTE, " UNION ALL ".join(
    f"SELECT {f}::DOUBLE AS fraction, count(*) AS n, max(l_shipdate) AS last_ts FROM indexed "
    f"WHERE row_id < floor(n * {f}::DOUBLE)" for f in LEARNING_FRACTIONS)))
def w05(spark, sf):
    tagged, _ = ordered.prefix_rank(table(spark, sf, "lineitem"), _LINE_ORDER, LEARNING_FRACTIONS)
    inside = tagged.groupBy("prefix").agg(F.count(F.lit(1)).alias("n"),
                                          F.max("l_shipdate").alias("last_ts"))
    steps = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(f).alias("fraction"))
                      for i, f in enumerate(LEARNING_FRACTIONS)])
    member = inside.select("*", F.explode(F.filter(steps, lambda s: s["i"] >= F.col("prefix")))
                           .alias("step"))
    return member.groupBy(F.col("step.fraction").alias("fraction")).agg(
        F.sum("n").alias("n"), F.max("last_ts").alias("last_ts"))


@query("o01_sort_by_time", with_(LONG_CTE, """
SELECT row_number() OVER (ORDER BY timestamp) - 1 AS place, timestamp, sensor_type FROM long"""))
def o01(spark, sf):
    # The place of each row in the sorted files as they were written.
    path = work_path(spark, "sorted")
    ordered.sorted_rows(readings(spark, sf).select("timestamp", "sensor_type"),
                        "timestamp").write.parquet(path)
    files = spark.read.parquet(path).select("*", F.col("_metadata.file_name").alias("f"),
                                            F.col("_metadata.row_index").alias("i"))
    sizes = files.groupBy("f").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("f").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("f", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return files.join(starts, "f").select((F.col("start") + F.col("i")).alias("place"),
                                          "timestamp", "sensor_type")


@query("o06_head", with_(FEATURES_CTE, f"""
SELECT timestamp, {", ".join(features.FEATURES)} FROM features ORDER BY timestamp LIMIT 5"""))
def o06(spark, sf):
    return ordered.head(feature_table(spark, sf), ["timestamp"], 5)


# --- set operations ------------------------------------------------------------

@query("u01_union_by_name", with_(LONG_CTE, """
SELECT room, appliance, count(*) AS n, round(sum(value), 6) + 0 AS total FROM (
  SELECT room, NULL AS appliance, value FROM long WHERE appliance IS NULL
  UNION ALL SELECT NULL, appliance, value FROM long WHERE appliance IS NOT NULL)
GROUP BY room, appliance"""))
def u01(spark, sf):
    environment, appliances = clean.split_by_sensor(readings(spark, sf))
    merged = clean.union_by_name(environment.select("timestamp", "room", "value"),
                                 appliances.select("value", "appliance", "timestamp"))
    return merged.groupBy("room", "appliance").agg(
        F.count(F.lit(1)).alias("n"), r6(F.sum("value"), "total", 6))


# --- scalar functions ------------------------------------------------------------

@query("f01_calendar_parts", """
SELECT event_id, hour(ts)::INT AS hour, (isodow(ts) - 1)::INT AS day_of_week,
  (isodow(ts) >= 6)::INT AS is_weekend FROM events""")
def f01(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", fx.hour("ts").alias("hour"), fx.day_of_week("ts").alias("day_of_week"),
        fx.is_weekend("ts").alias("is_weekend"))


@query("f02_parse_timestamp", """
SELECT event_id, CASE event_id % 4 WHEN 3 THEN NULL WHEN 2 THEN date_trunc('minute', ts)
  ELSE date_trunc('second', ts) END::TIMESTAMP AS parsed FROM events""")
def f02(spark, sf):
    ts = F.col("ts")
    text = (F.when(F.col("event_id") % 4 == 0, fx.iso_ts(ts))
            .when(F.col("event_id") % 4 == 1, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
            .when(F.col("event_id") % 4 == 2, F.date_format(ts, "M/d/yyyy H:mm"))
            .otherwise("no time"))
    return table(spark, sf, "events").select("event_id", fx.parse_ts(text).alias("parsed"))


@query("f03_format_timestamp", """
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS text FROM events""")
def f03(spark, sf):
    return table(spark, sf, "events").select("event_id", fx.iso_ts("ts").alias("text"))


@query("f04_time_steps", """
SELECT event_id, ts + to_seconds((event_id % 288) * 300) AS moved FROM events""")
def f04(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", fx.plus_steps("ts", F.col("event_id") % 288, 300).alias("moved"))


@query("f05_event_date", """
SELECT CASE WHEN length(t) >= 10 THEN substr(t, 1, 10) ELSE 'unknown' END AS date, count(*) AS n
FROM (SELECT CASE WHEN event_id % 9 = 0 THEN substr(strftime(ts, '%Y-%m-%dT%H:%M:%S'), 1, 7)
      ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS t FROM events) GROUP BY 1""")
def f05(spark, sf):
    text = F.when(F.col("event_id") % 9 == 0, F.substring(fx.iso_ts("ts"), 1, 7)).otherwise(
        fx.iso_ts("ts"))
    return table(spark, sf, "events").groupBy(fx.event_date(text).alias("date")).agg(
        F.count(F.lit(1)).alias("n"))


@query("f06_half_even_round", f"""
SELECT event_id, {sql_half_even("value", 1)} AS one, {sql_half_even("value", 0)} AS whole,
  {sql_half_even("event_id * 0.125::DOUBLE", 2)} AS ties FROM events""")
def f06(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", fx.half_even("value", 1).alias("one"), fx.half_even("value", 0).alias("whole"),
        fx.half_even(F.col("event_id") * F.lit(0.125), 2).alias("ties"))


@query("f07_row_functions", with_(TICKS_CTE, f"""
SELECT timestamp, {sql_r6(sql_row_mean(_P), "mean_w")}, {sql_r6(sql_row_sum(_P), "sum_w")},
  ({" + ".join(f"({c} IS NOT NULL)::INT" for c in _P)})::INT AS present FROM ticks"""))
def f07(spark, sf):
    return reshape.pivot_mean(readings(spark, sf), KEYS).select(
        "timestamp", r6(fx.row_mean(_P), "mean_w"), r6(fx.row_sum(_P), "sum_w"),
        fx.row_count(_P).alias("present"))


_LIMIT_SQL = ", ".join(f"('{a}', {m}::DOUBLE, {p}::DOUBLE)" for a, m, p in APPLIANCE_LIMITS)


@query("f08_clip", with_(LONG_CTE, f"""
SELECT appliance, {sql_r6("max(greatest(least(value * 30, max_power), 0))", "max_watts")},
  {sql_r6("sum(greatest(least(value * 30, max_power), 0))", "total", 6)}
FROM long JOIN (VALUES {_LIMIT_SQL}) m(appliance, max_power, phantom) USING (appliance)
GROUP BY appliance"""))
def f08(spark, sf):
    rows = readings(spark, sf).where("appliance IS NOT NULL").withColumn(
        "value", F.col("value") * 30)
    capped = clean.cap_readings(rows, quality.limits(spark), 3000.0)
    return capped.groupBy("appliance").agg(r6(F.max("value"), "max_watts"),
                                           r6(F.sum("value"), "total", 6))


@query("f09_guarded_ratio", """
SELECT event_id, round(abs(value - 20), 6) AS distance, round(sqrt(value), 6) AS root,
  round(coalesce(value / nullif((event_id % 5)::DOUBLE, 0), 0), 6) + 0 AS guarded,
  round(value / greatest((event_id % 5) * 0.1, 1e-10), 3) + 0 AS floored FROM events""")
def f09(spark, sf):
    divisor = F.col("event_id") % 5
    return table(spark, sf, "events").select(
        "event_id", r6(F.abs(F.col("value") - 20), "distance"), r6(F.sqrt("value"), "root"),
        r6(fx.ratio("value", divisor, 0.0), "guarded"),
        r6(F.col("value") / F.greatest(divisor * F.lit(0.1), F.lit(1e-10)), "floored", 3))


@query("f12_topics", with_(LONG_CTE, """
SELECT CASE WHEN appliance IS NOT NULL THEN 'home/' || room || '/appliance/' || appliance
  ELSE 'home/' || room || '/' || sensor_type END AS topic, 'home' AS prefix, room,
  coalesce(appliance, sensor_type) AS leaf, count(*) AS n FROM long GROUP BY ALL"""))
def f12(spark, sf):
    topics = readings(spark, sf).select(fx.sensor_topic().alias("topic"))
    counted = topics.groupBy("topic").agg(F.count(F.lit(1)).alias("n"))
    return counted.select("topic", fx.topic_parts("topic").alias("p"), "n").select(
        "topic", "p.*", "n")


@query("f13_text", with_(LONG_CTE, """
SELECT appliance, CASE appliance WHEN 'washing_machine' THEN 'Washing Machine'
    ELSE upper(appliance[1]) || appliance[2:] END AS title,
  starts_with('power_' || appliance, 'power_') AS is_power,
  rpad(appliance, 20, ' ') AS padded, count(*) AS n
FROM long WHERE appliance IS NOT NULL GROUP BY appliance"""))
def f13(spark, sf):
    return readings(spark, sf).where("appliance IS NOT NULL").groupBy("appliance").agg(
        F.count(F.lit(1)).alias("n")).select(
        "appliance", fx.title("appliance").alias("title"),
        F.concat(F.lit("power_"), "appliance").startswith("power_").alias("is_power"),
        F.rpad("appliance", 20, " ").alias("padded"), "n")


@query("f14_threshold_labels", """
SELECT event_id, CASE WHEN x < 0.01 THEN 'NO OVERFITTING' WHEN x < 0.05 THEN 'MILD OVERFITTING'
    ELSE 'OVERFITTING CONCERN' END AS gap_label,
  CASE WHEN x < 0.1 THEN 'Very Similar distributions' WHEN x < 0.3
    THEN 'Moderately Similar distributions' ELSE 'Substantially different distributions' END
    AS ks_label, CASE WHEN x > 0.5 THEN 'strong' WHEN x > 0.3 THEN 'moderate' ELSE 'weak' END
    AS strength, CASE WHEN x <= 0.2 THEN 'PASS' ELSE 'FAIL' END AS verdict
FROM (SELECT event_id, value / 100 AS x FROM events)""")
def f14(spark, sf):
    from wattloom.operators.compare import ks_label
    from wattloom.operators.evaluate import gap_label
    x = F.col("value") / 100
    return table(spark, sf, "events").select(
        "event_id", gap_label(x).alias("gap_label"), ks_label(x).alias("ks_label"),
        fx.bands(x, [(0.5, "strong"), (0.3, "moderate")], "weak", True).alias("strength"),
        fx.pass_or(x <= 0.2, "FAIL").alias("verdict"))


@query("f15_day_names", f"""
SELECT event_id, d.day_name, CASE WHEN isodow(ts) >= 6 THEN 'Weekend' ELSE 'Weekday' END AS kind
FROM events JOIN (VALUES {_DAYS_SQL}) d(i, day_name) ON d.i = isodow(ts) - 1""")
def f15(spark, sf):
    dow = fx.day_of_week("ts")
    return table(spark, sf, "events").select(
        "event_id", fx.day_name(dow).alias("day_name"), fx.day_kind(dow).alias("kind"))


# --- calendars, classes and rates ------------------------------------------------

@query("r01_missing_bins", with_(GRID_CTE, """
SELECT date_trunc('day', timestamp)::TIMESTAMP AS day, count(*) AS expected,
  count(*) FILTER (WHERE timestamp NOT IN (
    SELECT time_bucket(INTERVAL 5 MINUTE, timestamp) FROM long)) AS missing
FROM grid GROUP BY 1"""))
def r01(spark, sf):
    rows = readings(spark, sf)
    seen = rows.select(reshape.bin_start("timestamp", "5 minutes").alias("timestamp")).groupBy(
        "timestamp").agg(F.lit(1).alias("seen"))
    calendar = reshape.join_spine(seen, reshape.spine(rows.select("timestamp"), "5 minutes"))
    return calendar.groupBy(
        F.date_trunc("day", "timestamp").cast("timestamp_ntz").alias("day")).agg(
        F.count(F.lit(1)).alias("expected"), F.count_if(F.col("seen").isNull()).alias("missing"))


@query("r02_reading_classes", with_(LONG_CTE, f"""
SELECT appliance, CASE WHEN w > max_power THEN 'over_cap'
    WHEN phantom > 0 AND abs(w - phantom) <= 9 THEN 'phantom' WHEN w > 10 THEN 'active'
    ELSE 'idle' END AS reading_class, count(*) AS n
FROM (SELECT appliance, value * 10 AS w FROM long WHERE appliance IS NOT NULL)
JOIN (VALUES {_LIMIT_SQL}) m(appliance, max_power, phantom) USING (appliance) GROUP BY 1, 2"""))
def r02(spark, sf):
    rows = readings(spark, sf).where("appliance IS NOT NULL").withColumn(
        "value", F.col("value") * 10)
    return quality.classify_readings(rows).groupBy("appliance", "reading_class").agg(
        F.count(F.lit(1)).alias("n"))


@query("r03_activation_gap", with_(FEATURES_CTE, f"""
SELECT appliance, is_weekend, hour, round(observed, 6) + 0 AS observed, probability,
  round(observed - probability, 6) + 0 AS difference FROM (
  SELECT r.appliance, r.is_weekend, r.hour, r.observed, coalesce(p, 0::DOUBLE) AS probability
  FROM (SELECT replace(name, 'power_', '') AS appliance, is_weekend, hour,
          avg((watts > 10)::INT::DOUBLE) AS observed
        FROM (SELECT hour, is_weekend, {", ".join(_P)} FROM features)
        UNPIVOT (watts FOR name IN ({", ".join(_P)})) GROUP BY 1, 2, 3) r
  LEFT JOIN (VALUES {_SCHEDULE_SQL}) s(appliance, w, h, p)
    ON s.appliance = r.appliance AND s.w = r.is_weekend AND s.h = r.hour)"""))
def r03(spark, sf):
    return show(quality.activation_gap(feature_table(spark, sf)))


#: An own table: everyone asleep or at home in the evening, out on workdays, no data at 3 h.
_EXPECTED_OCCUPANCY = [
    (room, weekend, hour, round((0.9 if hour >= 18 or hour < 7 else 0.6 if weekend else 0.1)
                                - 0.05 * k, 2))
    for k, room in enumerate(ROOMS) for weekend in (0, 1) for hour in range(24) if hour != 3]
_OCC_ROOMS = ", ".join(f"avg(occupancy_{r}) AS {r}" for r in ROOMS)


@query("r03_occupancy_gap", with_(WIDE_CTE, f""", hourly AS (
SELECT room, is_weekend, hour, observed FROM (
  SELECT (isodow(timestamp) >= 6)::INT AS is_weekend, hour(timestamp)::INT AS hour, {_OCC_ROOMS}
  FROM wide GROUP BY 1, 2) UNPIVOT (observed FOR room IN ({", ".join(ROOMS)}))),
expected AS (SELECT * FROM (VALUES {", ".join(
    f"('{r}', {w}, {h}, {p}::DOUBLE)" for r, w, h, p in _EXPECTED_OCCUPANCY)})
  e(room, is_weekend, hour, probability))
SELECT room, is_weekend, hour, round(observed, 6) + 0 AS observed,
  round(probability, 6) + 0 AS probability,
  round(observed - coalesce(probability, 0), 6) + 0 AS difference
FROM hourly LEFT JOIN expected USING (room, is_weekend, hour)"""))
def r03_occupancy(spark, sf):
    expected = spark.createDataFrame(
        _EXPECTED_OCCUPANCY, "room string, is_weekend int, hour int, probability double")
    return show(quality.occupancy_gap(wide_grid(spark, sf), expected))


@query("a18_value_histogram", """
WITH r AS (SELECT event_type, min(value) AS lo, max(value) AS hi FROM events GROUP BY event_type),
b AS (SELECT event_type, least(floor((value - lo) / ((hi - lo) / 50)), 49)::INT AS bin,
  count(*) AS n FROM events JOIN r USING (event_type) GROUP BY 1, 2)
SELECT f.event_type, i::INT AS bin, round(lo + (hi - lo) / 50 * i, 6) + 0 AS bin_low,
  round(lo + (hi - lo) / 50 * (i + 1), 6) + 0 AS bin_high, coalesce(n, 0)::BIGINT AS n
FROM (SELECT * FROM r, range(50) g(i)) f
LEFT JOIN b ON b.event_type = f.event_type AND b.bin = f.i""")
def a18_values(spark, sf):
    return show(equal_width_histogram(table(spark, sf, "events"), ["event_type"], "value", 50))
