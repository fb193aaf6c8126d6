"""Queries over the phases: raw folders through the jobs to their stored results."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattloom.catalog.base import (
    FEATURES_CTE, KEYS, OFFSET, feature_table, query, r6, readings, sql_half_even, table,
    wide_grid, with_)
from wattloom.catalog.models_q import _SPLIT_CTE, MODEL_INPUTS
from wattloom.catalog.sources_q import _REAL, _appliances_csv, _write_csv
from wattloom.fixed_values import APPLIANCES, ENVIRONMENT, LEARNING_FRACTIONS
from wattloom.operators import sweep
from wattloom.operators.clean import union_by_name
from wattloom.operators.features import FEATURES
from wattloom.plans import phases
from wattloom.session import work_path
from wattloom.sources import store

_TEXT_TS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

# --- a house of many sensors with any names ---------------------------------------

ROOMS_OF_MANY = 120
#: Names that a column name or SQL text would not take, or that differ in case alone.
ODD = ["1.floor ", "a`b ", "o'neil ", 'the "hall" ', "Kitchen ", "kitchen "]


def many_sensors(spark, sf):
    """`events` as readings of ROOMS_OF_MANY rooms and as many appliances, 8 of them listed."""
    events = table(spark, sf, "events")
    place = F.pmod("user_id", F.lit(ROOMS_OF_MANY)).cast("int")
    room = F.concat(F.element_at(F.array(*[F.lit(n) for n in ODD]), F.pmod(place, F.lit(6)) + 1),
                    (place / 6).cast("int").cast("string"))
    listed = F.element_at(F.array(*[F.lit(a) for a in APPLIANCES]), F.pmod(place, F.lit(8)) + 1)
    kind = F.col("event_type")
    return events.select(
        F.col("ts").alias("timestamp"), room.alias("room"),
        F.when(kind == "click", "temperature").when(kind == "view", "humidity")
        .when(kind == "signup", "occupancy").otherwise("smart_plug").alias("sensor_type"),
        F.when(kind.isin("purchase", "error"), F.when(place < 8, listed).otherwise(room))
        .alias("appliance"), (F.col("value") + F.lit(OFFSET)).alias("value"))


_ODD_SQL = "[" + ", ".join("'" + n.replace("'", "''") + "'" for n in ODD) + "]"
_LISTED_SQL = "[" + ", ".join(f"'{a}'" for a in APPLIANCES) + "]"
_MANY_CTE = f"""long AS (
  SELECT ts AS timestamp, user_id % {ROOMS_OF_MANY} AS place,
    {_ODD_SQL}[user_id % {ROOMS_OF_MANY} % 6 + 1]
      || (user_id % {ROOMS_OF_MANY} // 6)::VARCHAR AS room,
    CASE event_type WHEN 'click' THEN 'temperature' WHEN 'view' THEN 'humidity'
         WHEN 'signup' THEN 'occupancy' ELSE 'power' END AS kind,
    value + {OFFSET}::DOUBLE AS value FROM events),
keyed AS (
  SELECT timestamp, kind, value, CASE WHEN kind = 'power' AND place < 8
    THEN {_LISTED_SQL}[place % 8 + 1] ELSE room END AS sensor FROM long),
ticks AS (SELECT timestamp, kind, sensor, avg(value) AS value FROM keyed GROUP BY ALL),
binned AS (SELECT time_bucket(INTERVAL 5 MINUTE, timestamp) AS timestamp, kind, sensor,
                  avg(value) AS value FROM ticks GROUP BY ALL),
spine AS (
  SELECT unnest(generate_series(min(timestamp), max(timestamp), INTERVAL 5 MINUTE)) AS timestamp
  FROM binned),
grid AS (
  SELECT spine.timestamp, s.kind, s.sensor, value
  FROM spine CROSS JOIN (SELECT DISTINCT kind, sensor FROM binned) s
  LEFT JOIN binned b ON b.timestamp = spine.timestamp AND b.kind = s.kind AND b.sensor = s.sensor),
filled AS (
  SELECT timestamp, kind, sensor, coalesce(
    last_value(value IGNORE NULLS) OVER (PARTITION BY kind, sensor ORDER BY timestamp
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    first_value(value IGNORE NULLS) OVER (PARTITION BY kind, sensor ORDER BY timestamp
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS value FROM grid)"""


def _of(kind, what):
    return f"{what} FILTER (kind = '{kind}')"


_MANY_FEATURES = f"""
SELECT timestamp, hour(timestamp)::INT AS hour, (isodow(timestamp) - 1)::INT AS day_of_week,
  (isodow(timestamp) >= 6)::INT AS is_weekend,
  {sql_half_even(_of("temperature", "avg(value)"), 2)} AS mean_temperature,
  {sql_half_even(_of("humidity", "avg(value)"), 2)} AS mean_humidity,
  round({_of("occupancy", "sum(value)")}, 6) + 0 AS occupancy_count,
  (count(*) FILTER (kind = 'power' AND value > 10))::INT AS active_appliances,
  {sql_half_even(_of("power", "sum(value)"), 1)} AS total_power,
  {", ".join(sql_half_even(f"max(value) FILTER (kind = 'power' AND sensor = '{a}')", 1)
             + f" AS power_{a}" for a in APPLIANCES)}
FROM filled GROUP BY timestamp"""


@query("k02_all_sensors", with_(_MANY_CTE, _MANY_FEATURES))
def k02_all_sensors(spark, sf):
    raw, out = work_path(spark, "raw"), work_path(spark, "out")
    _write_csv(many_sensors(spark, sf).withColumn(
        "timestamp", F.date_format("timestamp", _TEXT_TS)), raw)
    features = phases.run_preprocessing(spark, raw, out)
    return features.withColumn("occupancy_count", F.round("occupancy_count", 6) + F.lit(0.0))


@query("a01_sensors_as_rows", with_(_MANY_CTE, """
SELECT timestamp, kind, CASE kind WHEN 'power' THEN 'power_' || sensor ELSE kind || '_' || sensor
  END AS key, round(value, 6) + 0 AS value FROM ticks"""))
def a01_sensors_as_rows(spark, sf):
    return sweep.tick_means(many_sensors(spark, sf)).withColumn(
        "value", F.round("value", 6) + F.lit(0.0))


_KINDS = [*ENVIRONMENT, "power"]


@query("a03_a04_a05_over_all_sensors", with_(_MANY_CTE, "\nSELECT timestamp, " + ", ".join(
    f"round({_of(k, 'avg(value)')}, 6) + 0 AS mean_{k}, "
    f"round({_of(k, 'sum(value)')}, 6) + 0 AS sum_{k}, "
    f"(count(*) FILTER (kind = '{k}' AND value > 10)) AS above_{k}" for k in _KINDS)
    + " FROM filled GROUP BY timestamp"))
def a03_a04_a05(spark, sf):
    measures = {}
    for k in _KINDS:
        measures |= {
            f"sum_{k}": lambda v, k=k: F.when(F.col("kind") == k, v),
            f"n_{k}": lambda v, k=k: F.when(F.col("kind") == k, 1),
            f"above_{k}": lambda v, k=k: F.when((F.col("kind") == k) & (v > 10), 1)}
    binned = sweep.bin_means(sweep.tick_means(many_sensors(spark, sf)))
    path = work_path(spark, "binned")
    binned.write.parquet(path)
    rows = sweep.sweep(spark.read.parquet(path), measures)
    out = []
    for k in _KINDS:
        total = F.col(f"sum_{k}").cast("double")
        out += [(F.round(total / F.col(f"n_{k}").cast("double"), 6) + F.lit(0.0)).alias(f"mean_{k}"),
                (F.round(total, 6) + F.lit(0.0)).alias(f"sum_{k}"),
                F.col(f"above_{k}").cast("long").alias(f"above_{k}")]
    return rows.select("timestamp", *out)


# --- long and wide files in one folder ---------------------------------------------

_LONG_DAYS = "(day(ts) < 12 OR day(ts) >= 19)"
_MIXED_CTE = f"""of_all AS (WITH {FEATURES_CTE} SELECT * FROM features),
of_long AS (
  WITH {FEATURES_CTE.replace("FROM events", f"FROM (SELECT * FROM events WHERE {_LONG_DAYS})")}
  SELECT * FROM features),
read AS (SELECT DISTINCT time_bucket(INTERVAL 5 MINUTE, ts) AS timestamp FROM events
         WHERE {_LONG_DAYS}),
of_wide AS (SELECT * FROM of_all WHERE day(timestamp) BETWEEN 8 AND 22)"""


@query("k02_mixed_folder", with_(_MIXED_CTE, f"""
SELECT coalesce(l.timestamp, w.timestamp) AS timestamp, {", ".join(
    f"CASE WHEN r.timestamp IS NOT NULL OR w.timestamp IS NULL THEN l.{c} ELSE w.{c} END AS {c}"
    for c in FEATURES)}
FROM of_long l FULL JOIN of_wide w ON w.timestamp = l.timestamp
LEFT JOIN read r ON r.timestamp = l.timestamp"""))
def k02_mixed_folder(spark, sf):
    raw, out = work_path(spark, "raw"), work_path(spark, "out")
    day = F.dayofmonth("timestamp")
    text = F.date_format("timestamp", _TEXT_TS)
    _write_csv(readings(spark, sf).where((day < 12) | (day >= 19)).withColumn("timestamp", text), raw)
    # Two headers: the second has the columns in another order and an unnamed time.
    wide = wide_grid(spark, sf).withColumn("day", day).withColumn("timestamp", text)
    _write_csv(wide.where("day BETWEEN 8 AND 15").drop("day"), raw)
    _write_csv(wide.where("day BETWEEN 16 AND 22").withColumnRenamed("timestamp", "Unnamed: 0")
               .select("Unnamed: 0", *reversed(KEYS)), raw)
    return phases.run_preprocessing(spark, raw, out)


# --- split, models, explanation and validation as jobs ------------------------------

def _with_features(spark, sf):
    """A job folder that holds the feature table."""
    out = work_path(spark, "out")
    store.write_by_date(feature_table(spark, sf), f"{out}/features")
    return out


@query("k03_split_phase", with_(_SPLIT_CTE + f""",
p AS (SELECT {", ".join(f"avg({c}) AS m_{c}, CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE "
                        f"stddev_pop({c}) END AS s_{c}" for c in MODEL_INPUTS)}
  FROM sided WHERE split = 'train')""", f"""
SELECT split, count(*) AS n, round(sum(total_power), 2) + 0 AS total_power, {", ".join(
    f"round(avg(({c} - m_{c}) / s_{c}), 6) + 0 AS {c}, "
    f"round(stddev_pop(({c} - m_{c}) / s_{c}), 6) + 0 AS {c}_std" for c in MODEL_INPUTS)}
FROM sided, p GROUP BY split"""))
def k03_split(spark, sf):
    out = _with_features(spark, sf)
    phases.run_split(spark, out)
    rows, _, inputs = store.load_split(spark, f"{out}/split")
    stats = [c for f in inputs for c in (
        r6(F.avg(f), f), r6(F.stddev_pop(f), f"{f}_std"))]
    return rows.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), r6(F.sum("total_power"), "total_power", 2), *stats)


#: The target is the sum of eight inputs, so what the jobs must find is known beforehand.
_KNOWN = ["a perfect fit on both sides", "coefficients of the plugs are their scales",
          "every other coefficient is zero", "every fold and prefix is scored",
          "plugs are ranked before all other inputs", "no other input matters",
          "power and interaction make up the total", "the report names the plugs"]


@query("k04_k05_model_and_explain_phases", "SELECT * FROM (VALUES " + ", ".join(
    f"('{k}', true)" for k in _KNOWN) + ") t(found, holds) WHERE (SELECT count(*) FROM events) > 0")
def k04_k05(spark, sf):
    out = _with_features(spark, sf)
    phases.run_split(spark, out)
    models = phases.run_models(spark, out, {"LinearRegression": {}})
    explained = phases.run_explain(spark, out, repeats=5)
    plug = F.col("feature").startswith("power_")
    scaler = spark.read.parquet(f"{out}/split/scaler_params")
    coefficients = models["coefficients"].join(scaler, "feature")
    ranked, parts = explained["importance"], explained["decomposition"]
    first = ranked.where(plug).agg(F.max("rank").alias("a")).first()["a"]
    checks = {
        _KNOWN[0]: models["gaps"].where("train_r2 < 0.9999 OR test_r2 < 0.9999").isEmpty(),
        _KNOWN[1]: coefficients.where(plug & (F.abs(F.col("coefficient") - F.col("scale")) > 0.2))
        .isEmpty() and coefficients.where(plug).count() == 8,
        _KNOWN[2]: coefficients.where(~plug & (F.abs("coefficient") > 0.2)).isEmpty(),
        _KNOWN[3]: models["fold_scores"].count() == 5 and models["learning_curves"].count() == len(
            LEARNING_FRACTIONS),
        _KNOWN[4]: first == ranked.where(plug).count() == 8 and ranked.count() == 15,
        _KNOWN[5]: ranked.where(~plug & (F.abs("mean_importance") > 1e-4)).isEmpty(),
        _KNOWN[6]: parts.where("feature_power_mean < 0 OR interaction_power_mean < 0 OR "
                               "total_importance_mean > feature_power_mean + "
                               "interaction_power_mean + 1e-3").isEmpty() and parts.count() == 15,
        _KNOWN[7]: spark.read.parquet(f"{out}/results/summary").where(
            "section = 3 AND line LIKE '%appliance power%'").count() == 1}
    return spark.createDataFrame(list(checks.items()), "found string, holds boolean")


@query("k06_validation_phase", with_(FEATURES_CTE, " UNION ALL ".join(
    f"""SELECT 'validation' AS part, '{c} vs {c}' AS item,
  {sql_half_even(f"(SELECT avg({c}) FROM features)", 2)} AS ours,
  {sql_half_even(f"(SELECT avg({x}) FROM lineitem)", 2)} AS theirs""" for c, x in _REAL.items()) + """
UNION ALL SELECT 'daily', day_of_week::VARCHAR, count(*)::DOUBLE, NULL FROM features
  GROUP BY day_of_week
UNION ALL SELECT 'hourly', concat_ws('/', day_of_week, hour), round(avg(total_power), 6) + 0, NULL
  FROM features GROUP BY day_of_week, hour
UNION ALL SELECT 'total', coalesce(dataset, 'all'), 4.0, NULL
  FROM (VALUES ('Appliances'), (NULL)) t(dataset)"""))
def k06_validation(spark, sf):
    out = _with_features(spark, sf)
    phases.run_validation(spark, out, appliances=_appliances_csv(spark, sf))
    found = {n: spark.read.parquet(f"{out}/results/{n}")
             for n in ("validation", "daily", "hourly_by_day", "totals")}
    none = F.lit(None).cast("double")

    def part(name, df, item, ours, theirs=none):
        return df.select(F.lit(name).alias("part"), item.cast("string").alias("item"),
                         ours.cast("double").alias("ours"), theirs.alias("theirs"))
    by_day = found["hourly_by_day"].where("day_of_week IS NOT NULL")
    return union_by_name(
        part("validation", found["validation"], F.col("feature"), F.col("emulated_mean"),
             F.col("real_mean")),
        part("daily", found["daily"].where("record_count > 0"), F.col("day_number"),
             F.col("record_count")),
        part("hourly", by_day, F.concat_ws("/", "day_of_week", "hour"), r6("mean_power")),
        part("total", found["totals"], F.coalesce("dataset", F.lit("all")), F.col("total")))
