"""Pivot, resample, spine and fill against pandas on edge tables."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest

from wattloom.operators import reshape
from wattloom.operators.clean import clean_long, reading_key, union_by_name
from wattloom.operators.features import FEATURES, engineer_features

T0 = dt.datetime(2024, 3, 1, 7, 3)
LONG = "timestamp timestamp_ntz, room string, sensor_type string, appliance string, value double"


def long_rows(spark, rows):
    return spark.createDataFrame(rows, LONG)


def at(minutes, seconds=0):
    return T0 + dt.timedelta(minutes=minutes, seconds=seconds)


def as_pandas(df):
    out = df.orderBy("timestamp").toPandas().set_index("timestamp")
    return out.astype(float)


def reference(rows, keys, freq):
    """Brute force with pandas: mean per exact time, mean per bin, fill."""
    df = pd.DataFrame(rows, columns=["timestamp", "room", "sensor_type", "appliance", "value"])
    env = df.sensor_type.isin(["temperature", "humidity", "occupancy"])
    df["key"] = np.where(env, df.sensor_type + "_" + df.room, "power_" + df.appliance)
    wide = df.pivot_table(index="timestamp", columns="key", values="value", aggfunc="mean")
    return wide.resample(freq).mean().ffill().bfill().reindex(columns=keys)


ROWS = [
    (at(0), "kitchen", "temperature", None, 10.0), (at(0), "kitchen", "temperature", None, 20.0),
    (at(1), "kitchen", "temperature", None, 30.0),
    (at(2), "kitchen", "smart_plug", "kettle", 100.0), (at(2), "studio", "power", "kettle", 300.0),
    (at(31), "kitchen", "temperature", None, 40.0), (at(64), "studio", "humidity", None, 55.0),
    (at(200), "kitchen", "smart_plug", "kettle", 7.0),
]
KEYS = ["temperature_kitchen", "humidity_studio", "power_kettle"]


@pytest.mark.parametrize("step,freq,chunk", [
    ("5 minutes", "5min", 4), ("5 minutes", "5min", 4096), ("1h", "1h", 2), (420, "420s", 3)])
def test_to_wide_matches_brute_force(spark, monkeypatch, step, freq, chunk):
    monkeypatch.setattr(reshape, "CHUNK", chunk)  # 4: gaps longer than a chunk
    got = as_pandas(reshape.to_wide(long_rows(spark, ROWS), step, KEYS))[KEYS]
    want = reference(ROWS, KEYS, freq)
    pd.testing.assert_frame_equal(got, want, check_names=False, check_freq=False,
                                  check_index_type=False, check_column_type=False)


def test_two_stage_mean_is_not_a_flat_mean(spark):
    got = as_pandas(reshape.to_wide(long_rows(spark, ROWS), 3600, KEYS))
    assert got["temperature_kitchen"].iloc[0] == pytest.approx((15 + 30 + 40) / 3)


def test_partitioning_does_not_matter(spark):
    one = as_pandas(reshape.to_wide(long_rows(spark, ROWS).coalesce(1), 300, KEYS))
    many = as_pandas(reshape.to_wide(long_rows(spark, ROWS).repartition(13), 300, KEYS))
    pd.testing.assert_frame_equal(one, many)


def test_all_null_column_and_empty_input(spark):
    wide = reshape.to_wide(long_rows(spark, ROWS), 300, [*KEYS, "humidity_bedroom"])
    assert wide.where("humidity_bedroom IS NOT NULL").count() == 0
    empty = reshape.to_wide(long_rows(spark, []), 300, KEYS)
    assert empty.columns == ["timestamp", *KEYS] and empty.count() == 0
    single = reshape.to_wide(long_rows(spark, ROWS[:1]), 300, KEYS).collect()
    assert len(single) == 1 and single[0]["temperature_kitchen"] == 10.0


def test_many_keys_pivot(spark):
    keys = [f"power_a{i}" for i in range(reshape.WIDE_LIMIT + 5)]
    rows = [(at(0), "r", "smart_plug", f"a{i}", float(i)) for i in range(len(keys))]
    got = reshape.pivot_mean(long_rows(spark, rows), keys).collect()
    assert [got[0][k] for k in keys] == [float(i) for i in range(len(keys))]


def test_keys_of_incomplete_rows(spark):
    rows = [(at(0), None, "temperature", None, 1.0), (at(0), "", "humidity", None, 1.0),
            (at(0), "studio", None, "kettle", 1.0), (at(0), "studio", "power", "", 1.0),
            (at(0), "studio", "", None, 1.0)]
    keys = [r["k"] for r in long_rows(spark, rows).select(reading_key().alias("k")).collect()]
    assert keys == [None, None, "power_kettle", None, None]
    assert reshape.discover_keys(long_rows(spark, rows)) == ["power_kettle"]


def test_clean_long(spark):
    raw = spark.createDataFrame(
        [("2024-01-01T00:00:00", "a", "t", "", v) for v in ("1.5", "nan", "x", "", None, "-2")]
        + [("not a time", "a", "t", "", "1")],
        "timestamp string, room string, sensor_type string, appliance string, value string")
    got = clean_long(raw).collect()
    assert sorted(r["value"] for r in got) == [-2.0, 1.5]
    assert {r["appliance"] for r in got} == {None}


def test_features_of_a_full_row(spark):
    wide = spark.createDataFrame(
        [(dt.datetime(2024, 3, 2, 23, 55), 20.123, 21.0, 50.0, 1.0, 0.5, 10.0, 10.1, 500.25)],
        "timestamp timestamp_ntz, temperature_a double, temperature_b double, humidity_a double, "
        "occupancy_a double, occupancy_b double, power_kettle double, power_computer double, "
        "power_other double")
    row = engineer_features(wide).first()
    assert list(row.asDict()) == ["timestamp", *FEATURES]
    assert (row["hour"], row["day_of_week"], row["is_weekend"]) == (23, 5, 1)
    assert row["mean_temperature"] == 20.56 and row["occupancy_count"] == 1.5
    assert row["active_appliances"] == 2  # 10.0 is not above the threshold
    assert row["total_power"] == 520.4 and row["power_lighting"] == 0.0


def test_given_total_wins_and_incomplete_rows_drop(spark):
    wide = spark.createDataFrame(
        [(at(0), 20.0, 5.0, 99.96), (at(5), None, 5.0, 1.0), (at(10), 20.0, None, 1.0)],
        "timestamp timestamp_ntz, temperature_a double, power_kettle double, total_power double")
    rows = engineer_features(wide).collect()
    assert [r["total_power"] for r in rows] == [100.0]


def test_union_by_name(spark):
    a = spark.createDataFrame([(1, 2)], "x int, y int")
    b = spark.createDataFrame([(3, 4)], "z int, x int")
    assert sorted(map(tuple, union_by_name(a, b).collect()), key=str) == sorted(
        [(1, 2, None), (4, None, 3)], key=str)
