"""Exact quantiles, empirical distributions and histograms at any size.

Everything starts from a value-count table, (group, value) -> count, which
partial aggregation builds without moving raw rows of a hot group to one task.
Cumulative counts then run in two levels: inside value chunks, and over one
summary row per chunk. Chunks come from quantile sketches that stay in tables; what
they hold is checkpointed, and results do not depend on it and stay exact.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattloom.functions.columns import half_even
from wattloom.session import durable

CHUNK_ROWS = 500_000   # distinct values per chunk at most, one sorted run of a task
FAN = 32               # parts of a chunk that is too large
ACCURACY = 20 * FAN    # of its sketch


def value_counts(df: DataFrame, by: Sequence[str], value: str,
                 counts: dict[str, Column] | None = None) -> DataFrame:
    """Distinct non-null values per group with their counts."""
    counts = counts or {"n": F.lit(1)}
    return (df.where(F.col(value).isNotNull())
            .groupBy(*by, F.col(value).cast("double").alias("value"))
            .agg(*[F.sum(c).alias(name) for name, c in counts.items()]))


def _beside(rows: DataFrame, table: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """A join on keys that may be null; the keys of `table` stay apart as `_<key>`."""
    renamed = table.withColumnsRenamed({k: f"_{k}" for k in keys})
    return rows.join(renamed, reduce(lambda x, y: x & y, [
        F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]), how)


def chunked(counted: DataFrame, by: Sequence[str], most: int | None = None) -> DataFrame:
    """`counted` with `_chunk`: numbers that follow the values of a group, with at most `most`
    rows each.

    A chunk that is too large is divided at the quantiles of its sketch.
    Sketches are merged by partial aggregation and stay in a table beside the values, so
    neither the number of groups nor that of chunks is bounded, and nothing comes to the
    driver. A sketch only places values; what is computed from the chunks is exact.
    """
    most = CHUNK_ROWS if most is None else most
    keys = [*by, "_chunk"]
    rows = counted.withColumn("_chunk", F.lit(0).cast("long"))
    while True:
        large = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).where(
            F.col("_rows") > most)
        if large.isEmpty():
            return rows
        cuts = F.percentile_approx("value", [i / FAN for i in range(1, FAN)], ACCURACY)
        sketches = (_beside(rows.where(~F.isnan("value")), large, keys, "left_semi")
                    .groupBy(*keys).agg(cuts.alias("_cuts")))
        placed = _beside(rows, sketches, keys, "left")
        below = F.size(F.filter("_cuts", lambda c: c < F.col("value")))
        part = F.when(F.col("_cuts").isNull(), 0).otherwise(below)
        rows = durable(placed.withColumn("_chunk", F.col("_chunk") * FAN + part)
                       .select(*rows.columns))


def cumulative_counts(counted: DataFrame, by: Sequence[str], counts: Sequence[str],
                      most: int | None = None) -> DataFrame:
    """Add `cum_<name>` (rows with a value <= this one) and `all_<name>` per group.

    The counts are read several times (chunks, running sums, chunk sums), so they are
    checkpointed first: the aggregation below them runs once.
    """
    rows = chunked(durable(counted), by, most)
    inside = (Window.partitionBy(*by, "_chunk").orderBy("value")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    running = rows.select("*", *[F.sum(c).over(inside).alias(f"cum_{c}") for c in counts])
    totals = rows.groupBy(*by, "_chunk").agg(*[F.sum(c).alias(c) for c in counts])
    earlier = (Window.partitionBy(*by).orderBy("_chunk")
               .rowsBetween(Window.unboundedPreceding, -1))
    whole = Window.partitionBy(*by)
    offsets = totals.select(*by, "_chunk", *[
        F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_before_{c}") for c in counts], *[
        F.sum(c).over(whole).alias(f"all_{c}") for c in counts])
    joined = running.join(offsets, [*by, "_chunk"])
    return joined.select(*by, "value", *counts, *[
        (F.col(f"cum_{c}") + F.col(f"_before_{c}")).alias(f"cum_{c}") for c in counts], *[
        f"all_{c}" for c in counts])


def quantile_at(share: float, count: str = "n") -> Column:
    """Aggregate over a cumulative table: linearly interpolated quantile."""
    position = (F.col(f"all_{count}") - 1) * F.lit(share)
    reached = F.col(count) > 0
    low = F.min(F.when(reached & (F.col(f"cum_{count}") > F.floor(position)), F.col("value")))
    high = F.min(F.when(reached & (F.col(f"cum_{count}") > F.ceil(position)), F.col("value")))
    weight = F.max(position - F.floor(position))
    return low + (high - low) * weight


def exact_quantiles(df: DataFrame, by: Sequence[str], value: str,
                    shares: dict[str, float]) -> DataFrame:
    """Exact interpolated quantiles per group, one column per named share."""
    table = cumulative_counts(value_counts(df, by, value), by, ["n"])
    return table.groupBy(*by).agg(*[quantile_at(s).alias(name) for name, s in shares.items()])


def five_numbers(df: DataFrame, by: Sequence[str], value: str, whisker: float = 1.5) -> DataFrame:
    """Box-plot numbers: quartiles, and the most extreme values within the whiskers."""
    counted = value_counts(df, by, value)
    quartiles = cumulative_counts(counted, by, ["n"]).groupBy(*by).agg(
        quantile_at(0.25).alias("q1"), quantile_at(0.5).alias("median"),
        quantile_at(0.75).alias("q3"))
    reach = (F.col("q3") - F.col("q1")) * F.lit(whisker)
    inside = counted.join(quartiles, list(by)).where(
        (F.col("value") >= F.col("q1") - reach) & (F.col("value") <= F.col("q3") + reach))
    ends = inside.groupBy(*by).agg(F.min("value").alias("whisker_low"),
                                   F.max("value").alias("whisker_high"))
    return quartiles.join(ends, list(by), "left")


def _bin_index(value: Column, low: Column, high: Column, bins: int) -> Column:
    """0-based bin of a value in [low, high]; the last bin holds its right edge."""
    width = (high - low) / F.lit(float(bins))
    raw = F.floor((value - low) / F.nullif(width, F.lit(0.0)))
    return F.least(F.coalesce(raw, F.lit(0)), F.lit(bins - 1)).cast("int")


def equal_width_histogram(df: DataFrame, by: Sequence[str], value: str, bins: int) -> DataFrame:
    """Counts in equal bins over each group's own range; empty bins are listed too."""
    counted = value_counts(df, by, value)
    ranges = counted.groupBy(*by).agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    placed = counted.join(ranges, list(by)).select(
        *by, _bin_index(F.col("value"), F.col("lo"), F.col("hi"), bins).alias("bin"), "n")
    filled = placed.groupBy(*by, "bin").agg(F.sum("n").alias("n"))
    frame = ranges.select(*by, "lo", "hi", F.explode(
        F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    return frame.join(filled, [*by, "bin"], "left").select(
        *by, "bin",
        (F.col("lo") + width * F.col("bin")).alias("bin_low"),
        (F.col("lo") + width * (F.col("bin") + 1)).alias("bin_high"),
        F.coalesce("n", F.lit(0)).alias("n"))


def shared_density(samples: DataFrame, feature: str = "feature", side: str = "side",
                   edges: int = 50, low: float = 0.01, high: float = 0.99) -> DataFrame:
    """Density of each side over bins shared by both sides of a feature.

    The bin range runs between two quantiles of the pooled values; densities are
    normalised over the rows inside that range. Empty bins are listed too.
    """
    bins = edges - 1
    sides = value_counts(samples, [feature, side], "value")
    pooled = sides.groupBy(feature, "value").agg(F.sum("n").alias("n"))
    ranges = cumulative_counts(pooled, [feature], ["n"]).groupBy(feature).agg(
        quantile_at(low).alias("lo"), quantile_at(high).alias("hi"))
    placed = (sides.join(ranges, feature)
              .where(F.col("value").between(F.col("lo"), F.col("hi")))
              .groupBy(feature, side,
                       _bin_index(F.col("value"), F.col("lo"), F.col("hi"), bins).alias("bin"))
              .agg(F.sum("n").alias("n")))
    frame = sides.select(feature, side).distinct().join(ranges, feature).select(
        feature, side, "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    listed = frame.join(placed, [feature, side, "bin"], "left").withColumn(
        "n", F.coalesce("n", F.lit(0)))
    inside = F.sum("n").over(Window.partitionBy(feature, side))  # `bins` rows each
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    # A constant feature has bins of no width and no density.
    return listed.select(
        feature, side, "bin", (F.col("lo") + width * F.col("bin")).alias("bin_low"), "n",
        (F.col("n") / F.nullif(inside * width, F.lit(0.0))).alias("density"))


def ks_table(samples: DataFrame, feature: str = "feature", side: str = "side",
             names: tuple[str, str] = ("emulated", "real")) -> DataFrame:
    """Cumulative counts of both samples at each distinct value of a feature."""
    counts = {f"n{i}": (F.col(side) == name).cast("long") for i, name in enumerate(names)}
    return cumulative_counts(value_counts(samples, [feature], "value", counts),
                             [feature], list(counts))


def ks_distance() -> Column:
    """Aggregate over `ks_table`: the largest gap between the two distributions."""
    return F.max(F.abs(F.col("cum_n0") / F.nullif(F.col("all_n0"), F.lit(0))
                       - F.col("cum_n1") / F.nullif(F.col("all_n1"), F.lit(0))))


def two_sample_ks(samples: DataFrame, feature: str = "feature", side: str = "side",
                  names: tuple[str, str] = ("emulated", "real")) -> DataFrame:
    """KS distance and sample sizes per feature."""
    return ks_table(samples, feature, side, names).groupBy(feature).agg(
        F.max("all_n0").alias("n0"), F.max("all_n1").alias("n1"),
        ks_distance().alias("ks_statistic"))


def rounded(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    """Result rounding per column."""
    return reduce(lambda d, item: d.withColumn(item[0], half_even(*item)), digits.items(), df)
