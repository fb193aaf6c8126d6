"""Global order without a single-task sort.

`row_index` gives every row its position in a total order. Splits by position need only the
rows at a few positions (`selection.cuts_at`) and then tag every row where it is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattloom.fixed_values import FOLDS, TEST_RATIO
from wattloom.operators.selection import count_passed, cuts_at
from wattloom.session import durable

_ROWS_PER_TASK = (1 << 33) - 1  # low bits of monotonically_increasing_id


def row_index(df: DataFrame, order: Sequence[str], name: str = "row_id") -> DataFrame:
    """Dense 0-based position of each row in the given total order.

    Range partitioning on the whole key splits even a run of equal leading values
    as long as later columns tell the rows apart. The placed rows are checkpointed
    before their partition sizes are read, so both passes see the same placement.
    """
    placed = durable(
        df.repartitionByRange(*[F.col(c) for c in order])
        .sortWithinPartitions(*order)
        .withColumn("_slot", F.monotonically_increasing_id()))
    task = F.shiftright("_slot", 33)
    sizes = placed.groupBy(task.alias("_task")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(  # one row per shuffle partition
        "_task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return (placed.withColumn("_task", task).join(F.broadcast(starts), "_task")
            .withColumn(name, F.col("_start") + F.col("_slot").bitwiseAND(F.lit(_ROWS_PER_TASK)))
            .drop("_task", "_start", "_slot"))


def split_position(n: int, test_ratio: float = TEST_RATIO) -> int:
    return int(n * (1 - test_ratio))


def fold_starts(n: int, folds: int = FOLDS) -> list[int]:
    """First position of each contiguous fold; the first n mod k folds get one more."""
    sizes = [n // folds + (1 if i < n % folds else 0) for i in range(folds)]
    return [sum(sizes[:i]) for i in range(folds)]


def temporal_split(df: DataFrame, order: Sequence[str], test_ratio: float = TEST_RATIO,
                   name: str = "split") -> DataFrame:
    """Tag the earliest rows 'train' and the rest 'test'; never a random split. Sizes are
    exact also where rows tie at the cut."""
    n, cuts = cuts_at(df, order, plan=lambda n: [split_position(n, test_ratio)])
    late = count_passed(df, order, [split_position(n, test_ratio)], cuts, "_late")
    return late.withColumn("_late", F.when(F.col("_late") == 0, "train").otherwise(
        "test")).withColumnRenamed("_late", name)


def contiguous_folds(df: DataFrame, order: Sequence[str], folds: int = FOLDS,
                     name: str = "fold") -> DataFrame:
    """Tag unshuffled, contiguous blocks 0..folds-1 of exact sizes."""
    n, cuts = cuts_at(df, order, plan=lambda n: fold_starts(n, folds)[1:])
    return count_passed(df, order, fold_starts(n, folds)[1:], cuts, name)


def prefix_rank(df: DataFrame, order: Sequence[str], fractions: Sequence[float],
                name: str = "prefix") -> tuple[DataFrame, list[int]]:
    """Tag each row with the index of the smallest prefix that holds it.

    A row with tag p belongs to every prefix whose index is at least p; rows outside
    all prefixes get len(fractions). Returns the table and the prefix sizes.
    """
    n, cuts = cuts_at(df, order, plan=lambda n: [int(n * f) for f in fractions])
    sizes = [int(n * f) for f in fractions]
    return count_passed(df, order, sizes, cuts, name), sizes


def prefix_rows(df: DataFrame, order: Sequence[str], fraction: float) -> DataFrame:
    """The first floor(n * fraction) rows of the order."""
    tagged, _ = prefix_rank(df, order, [fraction], "_prefix")
    return tagged.where("_prefix = 0").drop("_prefix")


def sorted_rows(df: DataFrame, *order: str | Column) -> DataFrame:
    """Total order at a sink (range-partitioned sort)."""
    return df.orderBy(*order)


def head(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """First rows of the order; planned as a top-n, not as a full sort."""
    return df.orderBy(*order).limit(n)
