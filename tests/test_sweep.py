"""Features of any number of sensors against the wide plan and pandas."""

import datetime as dt
import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wattloom.operators import reshape, sweep
from wattloom.operators.features import FEATURES, engineer_features
from wattloom.plans import phases
from wattloom.session import durable
from wattloom.sources import csv_files

LONG = "timestamp timestamp_ntz, room string, sensor_type string, appliance string, value double"
T0 = dt.datetime(2024, 3, 1, 7, 3)
NAMES = ["kitchen", "Kitchen", "KITCHEN", "1.floor", "a`b", "o'neil", 'the "hall"', "x y", "ü"]


def random_rows(n, seed=3, names=NAMES):
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(n):
        kind = str(rng.choice(["temperature", "humidity", "occupancy", "smart_plug", "power"]))
        name = str(rng.choice(names + ["kettle"]))
        at = T0 + dt.timedelta(minutes=int(rng.integers(0, 3000)), seconds=int(rng.integers(0, 60)))
        plug = kind in ("smart_plug", "power")
        out.append((at, name, kind, name if plug else None, float(rng.uniform(0, 40))))
    return out


def brute(rows, freq="5min"):
    """pandas: mean per exact time, mean per bin, fill, features of the filled columns."""
    df = pd.DataFrame(rows, columns=["timestamp", "room", "sensor_type", "appliance", "value"])
    env = df.sensor_type.isin(["temperature", "humidity", "occupancy"])
    df["key"] = np.where(env, df.sensor_type + "_" + df.room.astype(str),
                         "power_" + df.appliance.astype(str))
    wide = df.pivot_table(index="timestamp", columns="key", values="value", aggfunc="mean")
    wide = wide.resample(freq).mean()
    seen = wide.notna().any(axis=1)
    wide = wide.ffill().bfill()

    def cols(prefix):
        return wide[[c for c in wide.columns if c.startswith(prefix)]]
    return {t: (cols("temperature_").loc[t].mean(), cols("humidity_").loc[t].mean(),
                cols("occupancy_").loc[t].sum(), int((cols("power_").loc[t] > 10).sum()),
                cols("power_").loc[t].sum(), bool(seen[t])) for t in wide.index}


@pytest.mark.parametrize("step,freq,chunk", [
    ("5 minutes", "5min", 3), ("5 minutes", "5min", 4096), ("1h", "1h", 2), (420, "420s", 5)])
def test_sweep_matches_pandas(spark, monkeypatch, step, freq, chunk):
    monkeypatch.setattr(sweep, "CHUNK", chunk)
    monkeypatch.setattr(reshape, "CHUNK", chunk)
    rows = random_rows(300)
    long = spark.createDataFrame(rows, LONG)
    binned = durable(sweep.bin_means(sweep.tick_means(long), step))
    got = sweep.swept_features(binned, step, mark="read").collect()
    want = brute(rows, freq)
    assert {r["timestamp"] for r in got} == {t.to_pydatetime() for t in want}
    for r in got:
        t, h, o, a, p, seen = want[pd.Timestamp(r["timestamp"])]
        assert r["mean_temperature"] == pytest.approx(t, abs=0.0051)
        assert r["mean_humidity"] == pytest.approx(h, abs=0.0051)
        assert r["occupancy_count"] == pytest.approx(o, abs=1e-8)
        assert (r["active_appliances"], r["read"]) == (a, seen)
        assert r["total_power"] == pytest.approx(p, abs=0.051)


def test_sweep_equals_the_wide_plan(spark):
    names = ["kitchen", "studio", "kettle", "oven"]
    long = spark.createDataFrame(random_rows(400, 7, names), LONG)
    keys = reshape.discover_keys(long)
    want = engineer_features(reshape.to_wide(long, "5 minutes", keys))
    got = phases.build_features(long)
    assert got.columns == want.columns == ["timestamp", *FEATURES]
    def rows(df):
        return sorted(map(tuple, df.withColumn(
            "occupancy_count", F.round("occupancy_count", 9)).collect()))
    assert rows(got) == rows(want)


def test_no_readings_repeats_and_sizes_beyond_range(spark):
    empty = spark.createDataFrame([], LONG)
    assert phases.build_features(empty).collect() == []
    row = (T0, "kitchen", "temperature", None, 20.0)
    rows = [row, row, (T0, None, "temperature", None, 1.0), (T0, "kitchen", "humidity", None, None),
            (None, "kitchen", "temperature", None, 5.0), (T0, "k", "humidity", None, 1e300),
            (T0, "k", "occupancy", None, float("inf"))]
    got = phases.build_features(spark.createDataFrame(rows, LONG)).collect()
    assert len(got) == 1 and got[0]["mean_temperature"] == 20.0
    assert got[0]["mean_humidity"] == 0.0 and got[0]["occupancy_count"] == 0.0


def test_fifty_thousand_sensors(spark):
    sensors = spark.range(50_000).select(
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0,0,0,0,0, id % 50, 0)")
        .alias("timestamp"),
        F.concat(F.element_at(F.array(*[F.lit(n) for n in NAMES]),
                              (F.col("id") % 9 + 1).cast("int")),
                 F.lit("."), F.col("id").cast("string")).alias("room"),
        F.lit("temperature").alias("sensor_type"), F.lit(None).cast("string").alias("appliance"),
        (F.col("id") % 100).cast("double").alias("value"))
    got = phases.build_features(sensors).collect()
    assert len(got) == 10 and {r["mean_temperature"] for r in got} == {49.5}


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_folders_without_a_valid_reading(spark, tmp_path):
    header = ",".join(csv_files.LONG_COLUMNS)
    write(f"{tmp_path}/raw/long.csv", f"{header}\n2024-01-01,kitchen,temperature,,bad\n")
    assert phases.run_preprocessing(spark, f"{tmp_path}/raw", f"{tmp_path}/a").collect() == []
    write(f"{tmp_path}/raw/wide.csv", "timestamp,temperature_a,power_kettle\n2024-01-01,1,2\n")
    got = phases.run_preprocessing(spark, f"{tmp_path}/raw", f"{tmp_path}/b").collect()
    assert [(r["mean_temperature"], r["total_power"]) for r in got] == [(1.0, 2.0)]


def test_wide_files_with_unlike_headers_keep_their_rows(spark, tmp_path):
    write(f"{tmp_path}/raw/a.csv", "timestamp,temperature_a,power_kettle,total_power\n"
          "2024-01-01 00:00:00,1,2,7\n2024-01-01 00:05:00,1,2,8\n")
    write(f"{tmp_path}/raw/b.csv", "timestamp,temperature_a,temperature_A,power_a.b,power_c`d\n"
          "2024-01-02 00:00:00,1,3,4,5\n2024-01-02 00:05:00,,,4,5\n2024-01-02 00:10:00,1,,4,5\n")
    got = {r["timestamp"]: r for r in phases.run_preprocessing(
        spark, f"{tmp_path}/raw", f"{tmp_path}/out").collect()}
    assert [(t.day, t.minute, r["mean_temperature"], r["total_power"], r["power_kettle"])
            for t, r in sorted(got.items())] == [
        (1, 0, 1.0, 7.0, 2.0), (1, 5, 1.0, 8.0, 2.0), (2, 0, 2.0, 9.0, 0.0), (2, 10, 1.0, 9.0, 0.0)]


def test_names_that_differ_in_case_alone():
    assert csv_files.unique_names(["Power_a", "power_a", "", "a`b", "a'b"]) == [
        "Power_a__2", "power_a", "_c2", "a'b", "a'b__2"]


def test_headers_take_one_job_for_any_number_of_files(spark, tmp_path):
    def jobs(folder, files):
        for i in range(files):
            write(f"{folder}/{i:04d}.csv", "timestamp,temperature_a,power_b\n2024-01-01,1,2\n")
        group = f"headers-{files}"
        spark.sparkContext.setJobGroup(group, group)
        paths = csv_files.list_csv(spark, str(folder))
        spark.sparkContext.setJobGroup(group + "-read", group)
        assert len(csv_files.headers(spark, paths)) == files
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group + "-read"))
    few = jobs(tmp_path / "few", 2)
    assert jobs(tmp_path / "many", 500) == few
