"""The rows at given positions of a total order, without sorting the table.

A position is narrowed down column by column of the order. A quantile sketch of a column gives
a bracket that holds the value at the position but for a small error; one count per side of
the bracket then says exactly how many rows lie below it and inside, so a bracket that misses
is only followed by another one. Rows inside are few after one or two rounds; only these are
ordered. A value that many rows share ends the search in its column, and the next one goes on
among the rows that share it. Each round is one aggregation over the order columns for all
positions together, and no row is moved.

Rows with equal order columns are told apart by a hash of their other columns. Rows that are
equal in all columns need no order among themselves: the cut then says how many of the group
come before it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows that are ordered at the end of a search; the sketches' accuracy.
INSIDE, ACCURACY = 20_000, 10_000
_TEXT_BYTES = 6
_TIMES = (T.TimestampType, T.TimestampNTZType, T.DateType)
REST = "_rest"


@dataclass
class Cut:
    """Rows before a position: those whose order columns (and `rest`, unless it is None) come
    before `values`, and `equal` of those that are the same in both."""

    values: tuple
    rest: int | None
    equal: int


@dataclass
class _Search:
    """A position, and the rows among which it lies: `rows` of them after `below` others."""

    position: int
    rows: int
    below: int = 0
    level: int = 0
    conditions: list[Column] = field(default_factory=list)
    base: int | None = None  # subtracted from long numbers, as sketches hold doubles
    stuck: bool = False

    def inside(self) -> Column:
        out = F.lit(True)
        for c in self.conditions:
            out = out & c
        return out

    def narrow(self, condition: Column, below: int, rows: int) -> None:
        self.conditions.append(condition)
        self.stuck = rows == self.rows
        self.below, self.rows = below, rows


def rest_hash(df: DataFrame, order: Sequence[str]) -> Column:
    """A hash of the columns outside the order (maps, which have no hash, as sorted entries)."""
    others = [F.array_sort(F.map_entries(f.name)) if isinstance(f.dataType, T.MapType)
              else F.col(f"`{f.name}`") for f in df.schema.fields if f.name not in order]
    return F.xxhash64(*others) if others else F.lit(0).cast("long")


def _ordinal_levels(df: DataFrame, order: Sequence[str]) -> tuple[int, list[Column]]:
    """Row count, and expressions whose lexicographic order is that of the columns."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    asked = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(order):
        x = F.col(f"`{c}`")
        odd = x.isNull() | F.isnan(x) if isinstance(kinds[c], (T.DoubleType, T.FloatType)) \
            else x.isNull()
        asked.append(F.count_if(odd).alias(f"odd{i}"))
        if isinstance(kinds[c], (T.StringType, T.BinaryType)):
            asked.append(F.max(F.octet_length(x)).alias(f"size{i}"))
    found = df.agg(*asked).first()
    levels = []
    for i, c in enumerate(order):
        x, kind = F.col(f"`{c}`"), kinds[c]
        if found[f"odd{i}"]:
            special = F.when(x.isNull(), 0)
            if isinstance(kind, (T.DoubleType, T.FloatType)):
                special = special.when(F.isnan(x), 2)
                x = F.when(~F.isnan(x), x)
            levels.append(special.otherwise(1))
        if isinstance(kind, (T.StringType, T.BinaryType)):
            raw = x.cast("binary")
            for at in range(0, found[f"size{i}"] or 0, _TEXT_BYTES):
                part = F.rpad(F.hex(F.substring(raw, at + 1, _TEXT_BYTES)), 2 * _TEXT_BYTES, "0")
                levels.append(F.conv(part, 16, 10).cast("long"))
            levels.append(F.octet_length(x))
        elif isinstance(kind, T.BooleanType):
            levels.append(x.cast("int"))
        elif isinstance(kind, (T.NumericType, *_TIMES)):
            levels.append(x)
        else:
            raise TypeError(f"no order by {c} of type {kind.simpleString()}")
    return found["n"], levels


def _read(x: Column, kind: T.DataType) -> Column:
    return x.cast("string") if isinstance(kind, _TIMES) else x


def _literal(value, kind: T.DataType) -> Column:
    """A value read with `_read` as a literal of its type."""
    return F.lit(value).cast(kind)


def _round(df: DataFrame, active: list[_Search], levels: list[Column],
           kinds: list[T.DataType]) -> None:
    """One sketch and one count, for all searches together."""
    asked = []
    for i, s in enumerate(active):
        x, kind = F.when(s.inside(), levels[s.level]), kinds[s.level]
        rank, slack = s.position - s.below, 2 * s.rows // ACCURACY + 1
        ends = [0.5, 0.5] if s.stuck else [
            max(0.0, (rank - slack) / s.rows), min(1.0, (rank + slack + 1) / s.rows)]
        sketch = F.percentile_approx(x if s.base is None else x - F.lit(s.base), ends, ACCURACY)
        asked += [_read(sketch[k], kind).alias(f"e{k}_{i}") for k in (0, 1)]
        if isinstance(kind, T.LongType):
            asked += [F.min(x).alias(f"min{i}"), F.max(x).alias(f"max{i}")]
    found = df.agg(*asked).first()
    ends, asked = [], []
    for i, s in enumerate(active):
        kind, x = kinds[s.level], levels[s.level]
        low, high = found[f"e0_{i}"], found[f"e1_{i}"]
        if isinstance(kind, T.LongType):
            if s.base is not None:
                low, high = low + s.base, high + s.base
            least, most = found[f"min{i}"], found[f"max{i}"]
            s.base = least if most - least < 1 << 53 else None
            if s.stuck:  # the sketch is too coarse for numbers so far apart
                low = high = (least + most) // 2
        ends.append((low == high, _literal(low, kind), _literal(high, kind)))
        asked += [F.count_if(s.inside() & (x < ends[i][1])).alias(f"b{i}"),
                  F.count_if(s.inside() & (x <= ends[i][2])).alias(f"u{i}")]
    counts = df.agg(*asked).first()
    for i, s in enumerate(active):
        x = levels[s.level]
        one, low, high = ends[i]
        under, upto, rank = counts[f"b{i}"], counts[f"u{i}"], s.position - s.below
        if rank < under:
            s.narrow(x < low, s.below, under)
        elif rank >= upto:
            s.narrow(x > high, s.below + upto, s.rows - upto)
        elif one:
            s.narrow(x == low, s.below + under, upto - under)
            s.level, s.base, s.stuck = s.level + 1, None, False
        else:
            s.narrow((x >= low) & (x <= high), s.below + under, upto - under)


def cuts_at(df: DataFrame, order: Sequence[str],
            positions: Sequence[int] | None = None, plan=None) -> tuple[int, dict[int, Cut]]:
    """(row count, cut before each position inside 0 .. rows - 1). Positions may be a function
    of the row count, `plan`."""
    n, levels = _ordinal_levels(df, order)
    wanted = sorted({p for p in (plan(n) if plan else positions) if 0 <= p < n})
    if not wanted:
        return n, {}
    rest = rest_hash(df, order)
    with_rest = df.withColumn(REST, rest)
    levels = [*levels, F.col(REST)]
    kinds = [f.dataType for f in with_rest.limit(0).select(*levels).schema.fields]
    searches = [_Search(p, n) for p in wanted]
    while True:
        active = [s for s in searches if s.rows > INSIDE and s.level < len(levels)]
        if not active:
            break
        _round(with_rest, active, levels, kinds)
    tags = F.filter(F.array(*[F.when(s.inside(), F.lit(s.position)) for s in searches
                              if s.rows <= INSIDE] or [F.lit(None).cast("int")]),
                    lambda t: t.isNotNull())
    keys = [F.col(f"`{c}`") for c in order]
    sorted_keys = [k.asc_nulls_first() for k in keys]
    few = with_rest.select(*keys, REST, F.explode(tags).alias("_position"))
    by_rest = Window.partitionBy("_position").orderBy(*sorted_keys, REST)
    by_order = Window.partitionBy("_position").orderBy(*sorted_keys)
    ranked = few.select(  # at most INSIDE rows for each position
        "*", F.row_number().over(by_rest).alias("_nth"), F.rank().over(by_rest).alias("_same"),
        F.rank().over(by_order).alias("_tied"))
    types = [f.dataType for f in df.select(*keys).schema.fields]
    shown = [_read(k, t).alias(f"k{i}") for i, (k, t) in enumerate(zip(keys, types, strict=True))]
    offset = F.create_map(*[F.lit(x) for s in searches for x in (s.position, s.position - s.below)])
    cuts = {}
    for r in ranked.where(F.col("_nth") == offset[F.col("_position")] + 1).select(
            "_position", "_nth", "_same", "_tied", REST, *shown).collect():
        values = tuple(r[f"k{i}"] for i in range(len(order)))
        cuts[r["_position"]] = (Cut(values, None, 0) if r["_nth"] == r["_tied"]
                                else Cut(values, r[REST], r["_nth"] - r["_same"]))
    for s in searches:
        if s.rows > INSIDE:  # equal in every column
            r = with_rest.where(s.inside()).select(REST, *shown).first()
            cuts[s.position] = Cut(tuple(r[f"k{i}"] for i in range(len(order))), r[REST],
                                   s.position - s.below)
    return n, cuts


def _keys(df: DataFrame, order: Sequence[str], cut: Cut) -> tuple[Column, Column]:
    """The key of a row and that of the cut, as comparable structs (nulls first)."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    here = [F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(order)]
    there = [_literal(v, kinds[c]).alias(f"k{i}")
             for i, (c, v) in enumerate(zip(order, cut.values, strict=True))]
    if cut.rest is not None:
        here.append(rest_hash(df, order).alias(REST))
        there.append(F.lit(cut.rest).cast("long").alias(REST))
    return F.struct(*here), F.struct(*there)


def count_passed(df: DataFrame, order: Sequence[str], positions: Sequence[int],
                 cuts: dict[int, Cut], name: str) -> DataFrame:
    """`df` with how many of the positions lie at or before each row.

    Where a cut divides rows that are equal in all columns, these are counted and made anew
    from one row, so many on each side; all others are tagged where they are.
    """
    always = F.lit(sum(p <= 0 for p in positions))
    steps, divided = always, []
    for p in positions:
        if p > 0 and p in cuts:
            here, there = _keys(df, order, cuts[p])
            steps = steps + (here >= there).cast("int")
            if cuts[p].equal:
                divided.append((here == there, cuts[p].equal))
    if not divided:
        return df.withColumn(name, steps)
    inside = F.lit(False)
    for same, _ in divided:
        inside = inside | same
    columns = [F.col(f"`{c}`") for c in df.columns]
    groups = df.where(inside).groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies"))
    early = sum(((same & (F.col("_copy") < equal)).cast("int") for same, equal in divided), F.lit(0))
    again = groups.withColumn("_copy", F.explode(F.expr(
        "sequence(0L, _copies - 1)"))).withColumn(name, steps - early)
    return df.where(~inside).withColumn(name, steps).unionByName(again.select(*columns, name))
