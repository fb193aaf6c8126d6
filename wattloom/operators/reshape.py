"""Long readings to a regular wide grid: pivot, resample, spine, fill.

Scale notes. Both aggregations combine on the map side, so a hot timestamp or key
costs one partial row per task. The ordered fill never sorts the whole table: it
works inside chunks of a fixed number of grid steps and carries one summary row
per chunk, so the only ordered pass over everything sees steps / CHUNK rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.fixed_values import APPLIANCES, ENVIRONMENT, ROOMS, STEP
from wattloom.functions.columns import step_seconds
from wattloom.operators.clean import reading_key
from wattloom.session import durable

CHUNK = 4096          # grid steps per chunk; bounds every ordered window below
WIDE_LIMIT = 40       # beyond this many keys the conditional aggregate leaves codegen


def standard_keys() -> list[str]:
    """The wide columns of the standard household."""
    return [f"{s}_{r}" for s in ENVIRONMENT for r in ROOMS] + [f"power_{a}" for a in APPLIANCES]


def discover_keys(long: DataFrame) -> list[str]:
    """The wide columns present in a long table: one name per sensor, an extra pass."""
    rows = (long.select(reading_key().alias("key")).where("key IS NOT NULL")
            .distinct().orderBy("key").collect())
    return [r["key"] for r in rows]


def pivot_mean(long: DataFrame, keys: list[str], extra: list[str] | None = None) -> DataFrame:
    """One row per exact timestamp, one column per key, mean of the readings.

    A single aggregation covers both sensor classes, so no outer join is needed.
    Timestamps whose rows all have a null or unlisted key do not appear.
    """
    rows = long.select("timestamp", reading_key().alias("_key"), "value").where(
        F.col("_key").isin(keys) & F.col("timestamp").isNotNull())
    grouped = rows.groupBy("timestamp")
    if len(keys) > WIDE_LIMIT or not keys:
        return grouped.pivot("_key", keys).agg(F.avg("value"))
    return grouped.agg(*[
        F.avg(F.when(F.col("_key") == F.lit(k), F.col("value"))).alias(k) for k in keys])


def outer_join_pivots(environment: DataFrame, appliances: DataFrame) -> DataFrame:
    """The same relation from two separate pivots joined on time."""
    return environment.join(appliances, "timestamp", "full_outer")


def bin_start(ts: str, step: str | int, origin: str | None = None) -> Column:
    """Start of the grid bin of a timestamp. Bins are anchored at midnight; a step
    that does not divide a day needs `origin`, the offset of the first day's
    midnight from the epoch grid."""
    seconds = step_seconds(step)
    width = f"{seconds} seconds"
    return F.window(ts, width, startTime=origin).start if origin else F.window(ts, width).start


def grid_origin(df: DataFrame, step: str | int, ts: str = "timestamp") -> str | None:
    """Offset of the grid anchor for steps that do not divide a day (one-row read)."""
    seconds = step_seconds(step)
    if 86400 % seconds == 0:
        return None
    first = df.agg(F.date_diff(F.min(ts).cast("date"), F.lit("1970-01-01").cast("date"))
                   .alias("days")).first()["days"]
    if first is None:
        return None
    offset = (first * 86400) % seconds
    return f"{offset} seconds" if offset else None


def spine(source: DataFrame, step: str | int, ts: str = "timestamp",
          origin: str | None = None) -> DataFrame:
    """Every grid point from the first to the last timestamp of `source`.

    Grown in two levels, chunks first and then the points of each chunk, so that
    no single row or task holds the whole calendar.
    """
    seconds = step_seconds(step)
    wide = F.make_dt_interval(secs=F.lit(seconds * CHUNK))
    narrow = F.make_dt_interval(secs=F.lit(seconds))
    bounds = (source.agg(F.min(ts).alias("lo"), F.max(ts).alias("hi"))
              .where("lo IS NOT NULL")
              .select(bin_start("lo", seconds, origin).alias("lo"), "hi")
              .select("lo", bin_start("hi", seconds, origin).alias("hi")))
    chunks = bounds.select("hi", F.explode(F.sequence("lo", "hi", wide)).alias("from"))
    return chunks.repartition("from").select(
        F.explode(F.sequence(
            F.col("from"),
            F.least(F.col("hi"), F.col("from") + wide - narrow),
            narrow)).alias(ts))


def resample_mean(ticks: DataFrame, step: str | int = STEP, bounds: DataFrame | None = None,
                  ts: str = "timestamp") -> DataFrame:
    """Mean of the per-timestamp rows in each bin, with a row for every empty bin.

    The spine enters the aggregation as rows of nulls, which averages ignore, so
    empty bins cost no join. `bounds` is a cheaper table with the same time range
    (the raw readings); without it the ticks themselves are scanned for it.
    """
    value_cols = [c for c in ticks.columns if c != ts]
    source = ticks if bounds is None else bounds
    origin = grid_origin(source, step, ts)
    binned = ticks.select(bin_start(ts, step, origin).alias(ts), *value_cols)
    calendar = spine(source.select(ts), step, ts, origin)
    return binned.unionByName(calendar, allowMissingColumns=True).groupBy(ts).agg(
        *[F.expr(f"avg(`{c}`) AS `{c}`") for c in value_cols])


def join_spine(binned: DataFrame, calendar: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Re-index an aggregated table on a calendar."""
    return calendar.join(binned, ts, "left")


def fill_gaps(grid: DataFrame, step: str | int = STEP, backward: bool = True,
              ts: str = "timestamp") -> DataFrame:
    """Carry the last known value forward; leading gaps take the first known one."""
    cols = [c for c in grid.columns if c != ts]
    chunk = F.window(ts, f"{step_seconds(step) * CHUNK} seconds").start
    chunked = grid.select(chunk.alias("_chunk"), ts, *cols)

    # Written as SQL text: the columns are many and alike.
    local = chunked.selectExpr("_chunk", ts, *[
        f"last(`{c}`, true) OVER (PARTITION BY _chunk ORDER BY `{ts}`) AS `{c}`" for c in cols])

    # One row per chunk: its first and last known value of every column.
    known = [f"`{c}`, CASE WHEN `{c}` IS NOT NULL THEN `{ts}` END" for c in cols]
    ends = chunked.groupBy("_chunk").agg(
        *[F.expr(f"min_by({k}) AS _first_{i}") for i, k in enumerate(known)],
        *[F.expr(f"max_by({k}) AS _last_{i}") for i, k in enumerate(known)])
    before = "(ORDER BY _chunk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    onward = "(ORDER BY _chunk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    carried = []
    for i in range(len(cols)):
        carry = f"last(_last_{i}, true) OVER {before}"
        if backward:  # only reached while nothing is known yet
            carry = f"coalesce({carry}, first(_first_{i}, true) OVER {onward})"
        carried.append(f"{carry} AS _carry_{i}")
    carry = ends.selectExpr("_chunk", *carried)

    return local.join(carry, "_chunk").selectExpr(ts, *[
        f"coalesce(`{c}`, _carry_{i}) AS `{c}`" for i, c in enumerate(cols)])


def to_wide(long: DataFrame, step: str | int = STEP, keys: list[str] | None = None,
            mark: str | None = None) -> DataFrame:
    """Long readings to the filled wide grid: pivot, resample, fill. A column `mark` tells
    the steps that had a reading before the fill.

    The grid is checkpointed before the fill, which reads it twice: it has one row per
    step, while the readings below it, of any size, are then scanned and shuffled once.
    """
    keys = keys or discover_keys(long)
    valid = long.where(reading_key().isin(keys))
    grid = durable(resample_mean(pivot_mean(long, keys), step, bounds=valid))
    filled = fill_gaps(grid, step)
    if mark is None:
        return filled
    known = F.expr(" OR ".join(f"`{k}` IS NOT NULL" for k in keys))
    return filled.join(grid.select("timestamp", known.alias(mark)), "timestamp")
