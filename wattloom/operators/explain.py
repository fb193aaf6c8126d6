"""Permutation importance and feature-power decomposition.

A permutation is a bijection of the dense row numbers (`permutation.shuffled`). Values are sent
to the block of row numbers they are shuffled to and meet its rows there, so no row is sorted
and no key is hot; the feature variants are then built inside the row.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattloom.fixed_values import PERMUTATION_REPEATS, SEED, SIGNIFICANCE
from wattloom.functions.columns import half_even
from wattloom.functions.pvalues import t_upper
from wattloom.operators.ordered import row_index
from wattloom.operators.permutation import shuffled

Predictor = Callable[[DataFrame, str], DataFrame]  # adds a prediction column
BLOCK = 64  # rows that exchange values with each other after a shuffle
CHUNK = 1 << 18  # rows whose values a task sorts by destination at a time


def _own_rows(df: DataFrame, features: Sequence[str], y: str, key: str) -> DataFrame:
    own = F.array(*[F.col(c).cast("double") for c in features])
    return df.select(key, F.col(y).alias("y"), "_base", own.alias("own"))


def _block_rows(repeats: int) -> int:
    """Row numbers that one group holds for all repeats: about a million values a feature,
    and a multiple of BLOCK."""
    return max(BLOCK, 1 << max(0, ((1 << 20) // repeats).bit_length() - 1))


def _sender(n: int, repeats: int, seed: int):
    """Batches of (row number, features) to one row per repeat and block of row numbers they
    are shuffled to: the places in the block, and the values of each feature."""
    size = _block_rows(repeats)

    def pieces(table: pa.Table):
        ids = table.column(0).to_numpy()
        values = [c.combine_chunks() for c in table.columns[1:]]
        for r in range(repeats):
            at = shuffled(ids, n, seed, r, inverse=True)
            order = np.argsort(at // size, kind="stable")
            at = at[order]
            blocks, starts = np.unique(at // size, return_index=True)
            ends = pa.array(np.append(starts, len(at)), pa.int32())
            parts = [pa.array((at % size).astype(np.int32))] + [v.take(order) for v in values]
            yield pa.RecordBatch.from_arrays(
                [pa.array(blocks), pa.array(np.full(len(blocks), r, np.int32))]
                + [pa.ListArray.from_arrays(ends, v) for v in parts],
                names=["_block", "repeat", "place"] + [f"v{j}" for j in range(len(values))])

    def send(batches):
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= CHUNK:
                yield from pieces(pa.Table.from_batches(held))
                held, rows = [], 0
        if rows:
            yield from pieces(pa.Table.from_batches(held))
    return send


def _receiver(width: int, key: str, apart: bool):
    """The rows of a block and what was sent there to (row, repeat, other). With `apart`,
    feature j comes from j places further on among BLOCK rows."""
    def receive(own: pa.Table, sent: pa.Table) -> pa.Table:
        own = own.drop_columns(["_block"]).sort_by(key)
        n, here = own.num_rows, np.arange(own.num_rows)
        first = here // BLOCK * BLOCK
        sent = sent.sort_by("repeat")
        repeats = sent.column("repeat").to_numpy()
        wanted = np.arange(width * n).reshape(width, n).T.ravel()  # feature by feature to rows
        out = []
        for r in np.unique(repeats):
            low, high = np.searchsorted(repeats, [r, r + 1])
            part = sent.slice(low, high - low).combine_chunks()
            slot = np.empty(n, np.int64)
            slot[pc.list_flatten(part.column("place")).to_numpy()] = here
            columns = []
            for j in range(width):
                at = first + (here % BLOCK + j) % np.minimum(BLOCK, n - first) if apart else here
                flat = pc.list_flatten(part.column(f"v{j}")).combine_chunks()
                columns.append(flat.take(slot[at]))
            other = pa.ListArray.from_arrays(
                pa.array(np.arange(n + 1) * width, pa.int32()),
                pa.concat_arrays(columns).take(wanted))
            out.append(own.append_column("repeat", pa.array(np.full(n, r, np.int32)))
                       .append_column("other", other))
        return pa.concat_tables(out)
    return receive


def _partners(df: DataFrame, carried: Sequence[str], features: DataFrame, n: int, repeats: int,
              seed: int, key: str, apart: bool) -> DataFrame:
    """(key, carried, repeat, other). `features` has the key and the values to be shuffled.

    The values travel as arrays, one per task's chunk, repeat and block, so a repeat costs a
    few bytes per value and no sort of rows; the rows themselves are moved once for all
    repeats.
    """
    size, width = _block_rows(repeats), len(features.columns) - 1
    arrays = "".join(f", v{j} array<double>" for j in range(width))
    sent = features.mapInArrow(
        _sender(n, repeats, seed), f"_block bigint, repeat int, place array<int>{arrays}")
    own = df.select(F.col(key).cast("long").alias(key), *carried,
                    F.expr(f"`{key}` div {size}").alias("_block"))
    schema = T.StructType([f for f in own.schema.fields if f.name != "_block"]).add(
        "repeat", T.IntegerType()).add("other", T.ArrayType(T.DoubleType()))
    return own.groupBy("_block").cogroup(sent.groupBy("_block")).applyInArrow(
        _receiver(width, key, apart), schema)


def _numbered(df: DataFrame, features: Sequence[str], key: str) -> DataFrame:
    return df.select(F.col(key).cast("long").alias("_id"), *[
        F.col(c).cast("double").alias(f"v{j}") for j, c in enumerate(features)])


def paired_rows(df: DataFrame, features: Sequence[str], y: str, n: int, repeats: int,
                seed: int = SEED, key: str = "row_id") -> DataFrame:
    """(key, y, _base, own, repeat, other): each row beside its partner of each repeat."""
    rows = _own_rows(df, features, y, key)
    return _partners(rows, ["y", "_base", "own"], _numbered(df, features, key), n, repeats, seed,
                     key, False)


def independent_partners(df: DataFrame, features: Sequence[str], n: int, repeats: int,
                         seed: int = SEED, key: str = "row_id",
                         carried: Sequence[str] = ()) -> DataFrame:
    """(key, carried, repeat, other): an array of features, each from another row.

    The rows that are shuffled to the positions of a block of row numbers meet there, and
    feature j of a row comes from j places further on in the block. So each feature is a
    permutation of its own, and the values of a row come from as many random rows as there
    are features (in the last block: as it has rows).
    """
    return _partners(df, carried, _numbered(df, features, key), n, repeats, seed, key, True)


def hashed_partners(df: DataFrame, features: Sequence[str], repeats: int, seed: int = SEED,
                    key: str = "row_id") -> DataFrame:
    """Partners by hash order, a stronger shuffle for periodic data: the row at
    position i takes the values of the row that is i-th in hash order."""
    values = F.array(*[F.col(c).cast("double") for c in features])
    out = None
    for r in range(repeats):
        mixed = df.select(F.xxhash64(F.col(key), F.lit(seed), F.lit(r)).alias("_h"), key,
                          values.alias("other"))
        ranked = row_index(mixed, ["_h", key], "_rank").select(
            F.col("_rank").alias(key), F.lit(r).alias("repeat"), "other")
        out = ranked if out is None else out.unionAll(ranked)
    return out


def _variants(paired: DataFrame, features: Sequence[str], kinds: Sequence[str]) -> DataFrame:
    """Rows of every variant: `without` replaces one feature by the partner's value,
    `only` keeps one feature and replaces all others. The unshuffled prediction
    `_base` travels along, so that errors are compared row by row: a feature that the
    model ignores then scores exactly zero."""
    made = []
    for j in range(len(features)):
        for kind in kinds:
            source = [("other" if (i == j) == (kind == "without") else "own")
                      for i in range(len(features))]
            made.append(F.struct(
                F.lit(j).alias("pos"), F.lit(kind).alias("kind"),
                *[F.col(s)[i].alias(c) for i, (s, c) in enumerate(zip(source, features))]))
    rows = paired.select("y", "_base", "repeat", F.explode(F.array(*made)).alias("v"))
    return rows.select("y", "_base", "repeat", "v.*")


def _feature_name(pos: str, features: Sequence[str]) -> Column:
    return F.element_at(F.array(*[F.lit(c) for c in features]), F.col(pos) + 1)


def permutation_importance(df: DataFrame, features: Sequence[str], y: str, predict: Predictor,
                           model: str, n: int | None = None,
                           repeats: int = PERMUTATION_REPEATS, seed: int = SEED,
                           key: str = "row_id", mode: str = "keyed") -> DataFrame:
    """Drop in R2 per (feature, repeat). `df` holds dense row numbers 0..n-1. In mode `keyed`
    partners come from keyed permutations, in mode `hash` from the order of hashes."""
    n = df.count() if n is None else n
    scored = predict(df, "_base")
    if mode == "keyed":
        paired = paired_rows(scored, features, y, n, repeats, seed, key)
    else:
        paired = _own_rows(scored, features, y, key).join(
            hashed_partners(df, features, repeats, seed, key), key)
    rows = predict(_variants(paired, features, ["without"]), "_pred")
    shuffled, plain = F.col("y") - F.col("_pred"), F.col("y") - F.col("_base")
    spread = F.var_pop("y") * F.count(F.lit(1))  # every group holds all rows
    return rows.groupBy("pos", "repeat").agg(
        F.sum(shuffled * shuffled - plain * plain).alias("_more"), spread.alias("_spread")).select(
        F.lit(model).alias("model"), "pos", _feature_name("pos", features).alias("feature"),
        "repeat", (F.col("_more") / F.nullif(F.col("_spread"), F.lit(0.0))).alias("importance"))


def importance_summary(raw: DataFrame) -> DataFrame:
    """Mean, population deviation, one-sided t-test and rank of each feature."""
    p = F.udf(lambda t, r: t_upper(t, r - 1), "double")  # one row per model and feature
    mean, std = F.col("mean_importance"), F.col("std_importance")
    stats = raw.groupBy("model", "pos", "feature").agg(
        F.avg("importance").alias("mean_importance"),
        F.stddev_pop("importance").alias("std_importance"),
        F.count(F.lit(1)).alias("_r"))
    t = F.when(std > 0, mean / (F.nullif(std, F.lit(0.0)) / F.sqrt("_r"))).otherwise(0.0)
    rows = stats.withColumn("t_stat", t).withColumn(
        "p_value", F.when(std > 0, p("t_stat", "_r")).when(mean <= 0, 1.0).otherwise(0.0))
    order = Window.partitionBy("model").orderBy(F.desc("mean_importance"), "pos")
    return rows.select(
        "model", "feature", "mean_importance", "std_importance", "t_stat", "p_value",
        (F.col("p_value") < SIGNIFICANCE).alias("significant"),
        F.row_number().over(order).alias("rank"))  # one row per feature of a model


def top_feature(summary: DataFrame) -> DataFrame:
    return summary.where("rank = 1").select("model", "feature", "mean_importance")


def importance_matrix(summary: DataFrame, models: Sequence[str]) -> DataFrame:
    """Feature by model; 0 where a model lacks the feature."""
    return summary.groupBy("feature").pivot("model", list(models)).agg(
        F.first("mean_importance")).na.fill(0.0)


def decompose_features(df: DataFrame, features: Sequence[str], y: str, predict: Predictor,
                       model: str, n: int | None = None, repeats: int = PERMUTATION_REPEATS,
                       seed: int = SEED, key: str = "row_id") -> DataFrame:
    """Per feature and repeat: MAE increase without the feature (total), MAE change
    with all others shuffled (power), and what remains (interaction)."""
    n = df.count() if n is None else n
    scored = predict(df, "_base")
    own = F.array(*[F.col(c).cast("double") for c in features])
    paired = independent_partners(scored.withColumn("own", own).withColumn("y", F.col(y)),
                                  features, n, repeats, seed, key, ["y", "_base", "own"])
    rows = predict(_variants(paired, features, ["without", "only"]), "_pred")
    plain = F.abs(F.col("y") - F.col("_base"))
    more = F.abs(F.col("y") - F.col("_pred")) - plain
    without = F.col("kind") == "without"
    maes = rows.groupBy("pos", "repeat").agg(
        F.avg(F.when(without, plain)).alias("base_mae"),
        F.avg(F.when(without, more)).alias("total"),
        F.abs(F.avg(F.when(~without, more))).alias("power"))
    return maes.select(
        F.lit(model).alias("model"), "pos", _feature_name("pos", features).alias("feature"),
        "repeat", "base_mae", "total", "power",
        F.greatest(F.lit(0.0), F.col("total") - F.col("power")).alias("interaction"))


def decomposition_summary(raw: DataFrame) -> DataFrame:
    """Means and population deviations over the repeats, ordered by total importance."""
    aggs = []
    for name, c in (("total_importance", "total"), ("feature_power", "power"),
                    ("interaction_power", "interaction")):
        aggs += [F.avg(c).alias(f"{name}_mean"), F.stddev_pop(c).alias(f"{name}_std")]
    out = raw.groupBy("model", "pos", "feature").agg(F.avg("base_mae").alias("base_mae"), *aggs)
    power, inter = F.col("feature_power_mean"), F.col("interaction_power_mean")
    floor = F.greatest(F.col("total_importance_mean"), F.lit(1e-10))
    whole = power + inter
    return out.select(
        "model", "feature",
        *[half_even(f"{n}_{m}", 6).alias(f"{n}_{m}") for n in
          ("total_importance", "feature_power", "interaction_power") for m in ("mean", "std")],
        half_even(power / floor, 4).alias("feature_power_ratio"),
        F.when(whole > 0, power / F.nullif(whole, F.lit(0.0)) * 100).alias("pct_independent"),
        half_even("base_mae", 4).alias("base_mae"))
