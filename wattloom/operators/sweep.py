"""Features of any number of sensors, without a column per sensor.

Readings stay in long form. A binned reading of a sensor holds from its bin to the sensor's
next one, the first one also back to the start of the grid. So a quantity summed over all
sensors changes only where a reading begins: by what the new value adds less what the one
before had added. The changes are summed per bin and then along the grid. No row is made for
a bin in which a sensor says nothing, and no name of a sensor reaches the plan or the driver.

Both ordered steps work in two levels. The value before a reading is looked up inside chunks
of CHUNK bins, and across chunks from one row per sensor and chunk; running sums are taken
inside chunks and carried by one row per chunk. Sums are decimal, so they do not drift and do
not depend on the order of rows. A reading of 1e15 or more in size counts as no reading.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattloom.fixed_values import ACTIVE_WATTS, STEP
from wattloom.functions.columns import day_of_week, half_even, hour, is_weekend, ratio, step_seconds
from wattloom.operators.clean import is_environment, reading_key
from wattloom.operators.features import APPLIANCE_FEATURES
from wattloom.operators.reshape import CHUNK, bin_start, grid_origin, spine
from wattloom.session import durable

_EXACT = "decimal(37,16)"
_LIMIT = 1e15
SENSOR = ["kind", "key"]
Measure = Callable[[Column], Column]


def tick_means(long: DataFrame) -> DataFrame:
    """timestamp, kind, key, value: the mean reading of a sensor at an exact time. This is
    `pivot_mean` with sensors as rows; any text may be part of a name."""
    rows = long.select("timestamp", F.when(is_environment(), F.col("sensor_type"))
                       .otherwise("power").alias("kind"), reading_key().alias("key"), "value")
    return (rows.where("timestamp IS NOT NULL AND key IS NOT NULL AND value IS NOT NULL")
            .groupBy("timestamp", *SENSOR).agg(F.avg("value").alias("value")))


def bin_means(ticks: DataFrame, step: str | int = STEP) -> DataFrame:
    """The mean over the times of each bin, for the bins in which a sensor has any."""
    start = bin_start("timestamp", step, grid_origin(ticks, step))
    return ticks.groupBy(start.alias("timestamp"), *SENSOR).agg(F.avg("value").alias("value"))


def _chunked(df: DataFrame, step: str | int) -> DataFrame:
    width = f"{step_seconds(step) * CHUNK} seconds"
    return df.withColumn("_chunk", F.window("timestamp", width).start)


def with_previous(binned: DataFrame, step: str | int = STEP) -> DataFrame:
    """`binned` with `previous`, the sensor's value before; null for its first."""
    rows = _chunked(binned, step)
    inside = rows.withColumn("previous", F.lag("value").over(
        Window.partitionBy(*SENSOR, "_chunk").orderBy("timestamp")))
    ends = rows.groupBy(*SENSOR, "_chunk").agg(F.max_by("value", "timestamp").alias("_last"))
    carried = ends.select(*SENSOR, "_chunk", F.lag("_last").over(
        Window.partitionBy(*SENSOR).orderBy("_chunk")).alias("_carried"))
    return inside.join(carried, [*SENSOR, "_chunk"]).withColumn(
        "previous", F.coalesce("previous", "_carried")).drop("_chunk", "_carried")


def running_sums(changes: DataFrame, names: list[str], step: str | int) -> DataFrame:
    """Sums of the columns along the grid, up to and with each row."""
    rows = _chunked(changes, step)
    up_to = Window.partitionBy("_chunk").orderBy("timestamp").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    before = Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = rows.groupBy("_chunk").agg(*[F.sum(n).alias(n) for n in names])
    carried = chunks.select("_chunk", *[  # one row per CHUNK grid steps
        F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"_{n}") for n in names])
    others = [c for c in changes.columns if c not in names]
    return rows.select("_chunk", *others, *[F.sum(n).over(up_to).alias(n) for n in names]).join(
        carried, "_chunk").select(*others, *[(F.col(n) + F.col(f"_{n}")).alias(n) for n in names])


def sweep(binned: DataFrame, measures: dict[str, Measure], step: str | int = STEP) -> DataFrame:
    """For every grid step the sum of each measure over all sensors, and `readings`, how many
    sensors had a reading in the step. A measure maps the value of a sensor to what it adds.

    `binned` (timestamp, kind, key, value) is read three times: pass a stored table.
    """
    binned = binned.where(F.abs("value") < _LIMIT)
    first = binned.agg(F.min("timestamp").cast("string")).first()[0]
    start = F.lit(first).cast("timestamp_ntz")
    names = list(measures)
    events = with_previous(binned, step)
    at = F.when(F.col("previous").isNull(), start).otherwise(F.col("timestamp"))

    def added(measure: Measure, value: str) -> Column:
        what = measure(F.col(value).cast(_EXACT)).cast(_EXACT)
        return F.coalesce(F.when(F.col(value).isNotNull(), what), F.lit(0).cast(_EXACT))
    changes = events.select(at.alias("timestamp"), *[
        (added(m, "value") - added(m, "previous")).alias(n) for n, m in measures.items()])
    seen = binned.select("timestamp", F.lit(1).alias("readings"))
    calendar = spine(binned.select("timestamp"), step, origin=grid_origin(binned, step))
    dense = (changes.unionByName(seen, allowMissingColumns=True)
             .unionByName(calendar, allowMissingColumns=True).groupBy("timestamp").agg(
                 F.coalesce(F.sum("readings"), F.lit(0)).alias("readings"),
                 *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names]))
    return running_sums(durable(dense), names, step)


def _of_kind(kind: str, measure: Measure) -> Measure:
    return lambda v: F.when(F.col("kind") == kind, measure(v))


FEATURE_MEASURES: dict[str, Measure] = {
    "temperature": _of_kind("temperature", lambda v: v),
    "temperatures": _of_kind("temperature", lambda v: F.lit(1)),
    "humidity": _of_kind("humidity", lambda v: v),
    "humidities": _of_kind("humidity", lambda v: F.lit(1)),
    "occupancy": _of_kind("occupancy", lambda v: v),
    "active": _of_kind("power", lambda v: F.when(v > ACTIVE_WATTS, 1)),
    "power": _of_kind("power", lambda v: v),
    **{name: (lambda v, name=name: F.when(
        (F.col("kind") == "power") & (F.col("key") == name), v)) for name in APPLIANCE_FEATURES},
}


def swept_features(binned: DataFrame, step: str | int = STEP,
                   mark: str | None = None) -> DataFrame:
    """The features of `engineer_features` over the filled grid of all sensors in `binned`.
    A column `mark` tells the steps that had a reading. No readings give no rows."""
    rows = sweep(binned, FEATURE_MEASURES, step)
    sums = {n: F.col(n).cast("double") for n in FEATURE_MEASURES}
    return rows.select(
        "timestamp", hour("timestamp").alias("hour"),
        day_of_week("timestamp").alias("day_of_week"), is_weekend("timestamp").alias("is_weekend"),
        half_even(ratio(sums["temperature"], sums["temperatures"], 0.0), 2).alias("mean_temperature"),
        half_even(ratio(sums["humidity"], sums["humidities"], 0.0), 2).alias("mean_humidity"),
        sums["occupancy"].alias("occupancy_count"),
        F.col("active").cast("int").alias("active_appliances"),
        half_even(sums["power"], 1).alias("total_power"),
        *[half_even(sums[a], 1).alias(a) for a in APPLIANCE_FEATURES],
        *([(F.col("readings") > 0).alias(mark)] if mark else []))
