"""Column expressions shared by the operators. All stay inside Catalyst."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wattloom.fixed_values import DAY_NAMES, TOPIC_PREFIX


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- numbers ---------------------------------------------------------------

def half_even(c: str | Column, digits: int) -> Column:
    """Round to `digits` decimals with ties to even on the scaled double, as array
    libraries do; cheaper than a decimal round and kept inside codegen."""
    scale = float(10 ** digits)
    return F.rint(col(c).cast("double") * F.lit(scale)) / F.lit(scale)


def number(c: str | Column) -> Column:
    """Numeric coercion: anything that is not a number becomes null."""
    value = col(c).try_cast("double")
    return F.when(~F.isnan(value), value)


def clip(c: str | Column, low: float, high: float) -> Column:
    """Limit to [low, high]; null stays null."""
    x = col(c)
    return F.when(x.isNotNull(), F.greatest(F.least(x, F.lit(high)), F.lit(low)))


def ratio(top: str | Column, bottom: str | Column, default: float | None = None) -> Column:
    """Division that gives `default` where the divisor is zero."""
    out = col(top) / F.nullif(col(bottom).cast("double"), F.lit(0.0))
    return out if default is None else F.coalesce(out, F.lit(default))


# Row functions are built as SQL text, as a wide table has many alike columns.

def row_sum(cols: list[str]) -> Column:
    """Sum across columns of one row, null counting as zero."""
    return F.expr(" + ".join(f"coalesce(CAST(`{c}` AS DOUBLE), 0D)" for c in cols))


def row_count(cols: list[str]) -> Column:
    """How many of the columns are present in one row."""
    return F.expr(" + ".join(f"CAST(`{c}` IS NOT NULL AS INT)" for c in cols))


def row_mean(cols: list[str]) -> Column:
    """Mean across the present columns of one row; null if none is present."""
    return ratio(row_sum(cols), row_count(cols))


def row_count_above(cols: list[str], threshold: float) -> Column:
    """How many of the columns exceed the threshold; null does not."""
    return F.expr(" + ".join(
        f"CAST(coalesce(`{c}` > {float(threshold)}D, false) AS INT)" for c in cols))


# --- time ------------------------------------------------------------------

def hour(ts: str | Column) -> Column:
    return F.hour(col(ts))


def day_of_week(ts: str | Column) -> Column:
    """0 = Monday ... 6 = Sunday."""
    return F.weekday(col(ts))


def is_weekend(ts: str | Column) -> Column:
    return (F.weekday(col(ts)) >= 5).cast("int")


def day_name(dow: str | Column) -> Column:
    names = F.array(*[F.lit(n) for n in DAY_NAMES])
    return F.try_element_at(names, col(dow).cast("int") + 1)


def day_kind(dow: str | Column) -> Column:
    return F.when(col(dow) >= 5, "Weekend").otherwise("Weekday")


# Text forms accepted beside ISO (fixed values).
OTHER_TIMESTAMP_FORMS = ["M/d/yyyy H:mm:ss", "M/d/yyyy H:mm", "M/d/yyyy"]


def parse_ts(c: str | Column) -> Column:
    """Text to a zone-free timestamp: ISO first, then the other forms, else null."""
    text = col(c).cast("string")
    return F.coalesce(
        text.try_cast("timestamp_ntz"),
        *[F.try_to_timestamp(text, F.lit(form)).cast("timestamp_ntz")
          for form in OTHER_TIMESTAMP_FORMS],
    )


def iso_ts(ts: str | Column) -> Column:
    return F.date_format(col(ts), "yyyy-MM-dd'T'HH:mm:ss")


def plus_steps(ts: str | Column, n: str | Column, seconds: int) -> Column:
    """Timestamp moved forward by n grid steps."""
    return col(ts) + F.make_dt_interval(secs=col(n) * F.lit(seconds))


def step_seconds(step: str | int) -> int:
    """'5 minutes', '5min', '1h', '30s', '1 day' or a number of seconds."""
    if isinstance(step, int):
        return step
    text = step.strip().lower()
    digits = ""
    while text and text[0].isdigit():
        digits, text = digits + text[0], text[1:]
    unit = text.strip()
    for names, seconds in (
        (("s", "sec", "second", "seconds"), 1),
        (("min", "minute", "minutes", "t"), 60),
        (("h", "hour", "hours"), 3600),
        (("d", "day", "days"), 86400),
    ):
        if unit in names:
            return int(digits or 1) * seconds
    raise ValueError(f"not a time step: {step!r}")


# --- text ------------------------------------------------------------------

def event_date(ts_text: str | Column) -> Column:
    """The date part that routes a raw record; 'unknown' if the text is too short."""
    text = F.coalesce(col(ts_text), F.lit(""))
    return F.when(F.length(text) >= 10, F.substring(text, 1, 10)).otherwise("unknown")


def title(c: str | Column) -> Column:
    return F.initcap(F.replace(col(c), F.lit("_"), F.lit(" ")))


def sensor_topic(prefix: str = TOPIC_PREFIX) -> Column:
    """home/<room>/<sensor_type>, or home/<room>/appliance/<name> for plugs."""
    return F.when(
        F.nullif(F.col("appliance"), F.lit("")).isNotNull(),
        F.concat_ws("/", F.lit(prefix), F.col("room"), F.lit("appliance"), F.col("appliance")),
    ).otherwise(F.concat_ws("/", F.lit(prefix), F.col("room"), F.col("sensor_type")))


def topic_parts(topic: str | Column) -> Column:
    """(prefix, room, leaf) of a topic; status topics have no leaf."""
    parts = F.split(col(topic), "/")
    return F.struct(
        F.try_element_at(parts, F.lit(1)).alias("prefix"),
        F.try_element_at(parts, F.lit(2)).alias("room"),
        F.try_element_at(parts, F.lit(-1)).alias("leaf"),
    )


# --- labels ----------------------------------------------------------------

def bands(c: str | Column, steps: list[tuple[float, str]], last: str,
          strict_above: bool = False) -> Column:
    """First label whose limit the value stays below (or, with `strict_above`,
    exceeds); `last` otherwise."""
    x = col(c)
    out = None
    for limit, label in steps:
        test = x > F.lit(limit) if strict_above else x < F.lit(limit)
        out = F.when(test, label) if out is None else out.when(test, label)
    return out.otherwise(last)


def pass_or(ok: Column, otherwise: str) -> Column:
    return F.when(ok, "PASS").otherwise(otherwise)
