"""Registry of named queries, their check SQL, and the shared inputs of both."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.fixed_values import APPLIANCES, ROOMS
from wattloom.operators.features import APPLIANCE_FEATURES, FEATURES, engineer_features
from wattloom.operators.reshape import standard_keys, to_wide

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CHECK_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir)
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            CHECK_SQL[name] = sql
        return fn
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def r6(c: str | Column, name: str | None = None, digits: int = 6) -> Column:
    """Rounded output column; adding zero turns -0.0 into 0.0."""
    column = F.col(c) if isinstance(c, str) else c
    return (F.round(column.cast("double"), digits) + F.lit(0.0)).alias(name or c)


def show(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every floating column for comparison."""
    return df.select(*[r6(f.name, digits=digits) if f.dataType.simpleString() == "double"
                       else F.col(f.name) for f in df.schema.fields])


# --- the event table seen as sensor readings --------------------------------

# The offset keeps averages of two-decimal values away from rounding ties.
OFFSET = 0.00317


def _choose(c: Column, names: list[str]) -> Column:
    index = F.pmod(c, F.lit(len(names))).cast("int") + 1
    return F.element_at(F.array(*[F.lit(n) for n in names]), index)


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` as long readings: timestamp, room, sensor_type, appliance, value."""
    events = table(spark, sf_dir, "events")
    kind = F.col("event_type")
    plug = kind.isin("purchase", "error")
    return events.select(
        F.col("ts").alias("timestamp"),
        _choose(F.col("user_id"), ROOMS).alias("room"),
        F.when(kind == "click", "temperature").when(kind == "view", "humidity")
        .when(kind == "signup", "occupancy").otherwise("smart_plug").alias("sensor_type"),
        F.when(plug, _choose(F.col("user_id"), APPLIANCES)).alias("appliance"),
        F.when(kind == "signup", F.when(F.col("value") > 35, 1.0).otherwise(0.0))
        .otherwise(F.col("value") + F.lit(OFFSET)).alias("value"))


def wide_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_wide(readings(spark, sf_dir), keys=standard_keys())


def feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return engineer_features(wide_grid(spark, sf_dir))


def wide_with_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide grid together with its features (the batch data set)."""
    wide = wide_grid(spark, sf_dir)
    sensors = [c for c in wide.columns if not c.startswith("power_") and c != "timestamp"]
    return engineer_features(wide, keep=sensors)


# --- the same inputs as SQL --------------------------------------------------

def _sql_choose(names: list[str]) -> str:
    whens = " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(names))
    return f"CASE user_id % {len(names)} {whens} END"


LONG_CTE = f"""long AS (
  SELECT ts AS timestamp, {_sql_choose(ROOMS)} AS room,
    CASE event_type WHEN 'click' THEN 'temperature' WHEN 'view' THEN 'humidity'
         WHEN 'signup' THEN 'occupancy' ELSE 'smart_plug' END AS sensor_type,
    CASE WHEN event_type IN ('purchase', 'error') THEN {_sql_choose(APPLIANCES)} END AS appliance,
    CASE WHEN event_type = 'signup' THEN CASE WHEN value > 35 THEN 1.0 ELSE 0.0 END
         ELSE value + {OFFSET}::DOUBLE END::DOUBLE AS value
  FROM events),
keyed AS (
  SELECT *, CASE WHEN sensor_type IN ('temperature', 'humidity', 'occupancy')
                 THEN sensor_type || '_' || room ELSE 'power_' || appliance END AS key
  FROM long)"""

KEYS = standard_keys()
_pivot = ", ".join(f"avg(CASE WHEN key = '{k}' THEN value END) AS {k}" for k in KEYS)
TICKS_CTE = LONG_CTE + f""",
ticks AS (SELECT timestamp, {_pivot} FROM keyed GROUP BY timestamp)"""
_bins = ", ".join(f"avg({k}) AS {k}" for k in KEYS)
GRID_CTE = TICKS_CTE + f""",
binned AS (
  SELECT time_bucket(INTERVAL 5 MINUTE, timestamp) AS timestamp, {_bins} FROM ticks GROUP BY 1),
spine AS (
  SELECT unnest(generate_series(min(timestamp), max(timestamp), INTERVAL 5 MINUTE)) AS timestamp
  FROM binned),
grid AS (SELECT spine.timestamp, {", ".join(KEYS)} FROM spine LEFT JOIN binned USING (timestamp))"""


def sql_filled(c: str) -> str:
    return (f"coalesce(last_value({c} IGNORE NULLS) OVER (ORDER BY timestamp ROWS BETWEEN "
            f"UNBOUNDED PRECEDING AND CURRENT ROW), first_value({c} IGNORE NULLS) OVER "
            f"(ORDER BY timestamp ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS {c}")


WIDE_CTE = GRID_CTE + f""",
wide AS (SELECT timestamp, {", ".join(sql_filled(k) for k in KEYS)} FROM grid)"""


def sql_half_even(x: str, digits: int) -> str:
    scale = float(10 ** digits)
    return f"(round_even(({x})::DOUBLE * {scale}::DOUBLE, 0)::DOUBLE / {scale}::DOUBLE)"


def sql_row_sum(cols: list[str]) -> str:
    return " + ".join(f"coalesce({c}::DOUBLE, 0::DOUBLE)" for c in cols)


def sql_row_mean(cols: list[str]) -> str:
    present = " + ".join(f"({c} IS NOT NULL)::INT" for c in cols)
    return f"(({sql_row_sum(cols)}) / nullif({present}, 0)::DOUBLE)"


_t = [k for k in KEYS if k.startswith("temperature_")]
_h = [k for k in KEYS if k.startswith("humidity_")]
_o = [k for k in KEYS if k.startswith("occupancy_")]
_p = [k for k in KEYS if k.startswith("power_")]
FEATURE_COLUMNS_SQL = f"""timestamp, hour(timestamp)::INT AS hour,
    (isodow(timestamp) - 1)::INT AS day_of_week,
    (isodow(timestamp) >= 6)::INT AS is_weekend,
    {sql_half_even(sql_row_mean(_t), 2)} AS mean_temperature,
    {sql_half_even(sql_row_mean(_h), 2)} AS mean_humidity,
    {sql_row_sum(_o)} AS occupancy_count,
    ({" + ".join(f"coalesce({c} > 10, false)::INT" for c in _p)})::INT AS active_appliances,
    {sql_half_even(sql_row_sum(_p), 1)} AS total_power,
    {", ".join(f"{sql_half_even(c, 1)} AS {c}" for c in APPLIANCE_FEATURES)}"""
FEATURES_CTE = WIDE_CTE + f""",
features AS (SELECT * FROM (SELECT {FEATURE_COLUMNS_SQL} FROM wide)
             WHERE {" AND ".join(f"{c} IS NOT NULL" for c in FEATURES)})"""


def sql_r6(x: str, name: str | None = None, digits: int = 6) -> str:
    return f"round(({x})::DOUBLE, {digits}) + 0 AS {name or x}"


def with_(cte: str, body: str) -> str:
    return f"WITH {cte}\n{body}"
