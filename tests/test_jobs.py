"""Files, streaming edges, reports and the phases end to end."""

import json
import os

import pytest
from pyspark.sql import functions as F

from wattloom.catalog.base import readings
from wattloom.operators import evaluate, profiles, quality
from wattloom.plans import cli, phases
from wattloom.sources import csv_files, external
from wattloom.streaming import ingest

SF = "/root/testdata/sf0.001"


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_mixed_folder(spark, tmp_path):
    d = str(tmp_path)
    write(f"{d}/a.csv", "timestamp,room,sensor_type,appliance,value\n"
                        "2024-01-01T00:00:00,kitchen,temperature,,20\n"
                        "2024-01-01T00:05:00,kitchen,temperature,,bad\n")
    write(f"{d}/b.csv", "timestamp,temperature_kitchen,power_kettle\n2024-01-01 00:00:00,1,2\n")
    write(f"{d}/c.csv", "2024-01-02T00:00:00,studio,power,kettle,5\n")
    write(f"{d}/empty.csv", "")
    long = csv_files.load_long(spark, d).orderBy("timestamp").collect()
    assert [(r["room"], r["appliance"], r["value"]) for r in long] == [
        ("kitchen", None, 20.0), ("studio", "kettle", 5.0)]
    wide = csv_files.load_wide(spark, d).collect()
    assert [(r["temperature_kitchen"], r["power_kettle"]) for r in wide] == [(1.0, 2.0)]


def test_missing_inputs(spark, tmp_path):
    os.makedirs(f"{tmp_path}/none")
    with pytest.raises(FileNotFoundError):
        csv_files.list_csv(spark, f"{tmp_path}/none")
    assert external.load_appliances(spark, f"{tmp_path}/no.csv") == (None, None)
    assert external.load_smart_home(spark, f"{tmp_path}/no.csv") == (None, None)


def test_layouts():
    assert csv_files.detect_format(["temperature_a", "power_b"]) == "wide"
    assert csv_files.detect_format(["timestamp", "room"]) == "long"
    assert csv_files.detect_format(["x"]) == "wide"
    assert csv_files.detect_format(["2024-01-01", "a", "b", "", "1"]) == "headerless"


def test_message_edges(spark, tmp_path):
    good = {"timestamp": "2024-01-01T10:00:00", "room": "studio", "sensor_type": "humidity",
            "value": 40.5}
    late = {**good, "timestamp": "2019-05-05T00:00:00"}
    messages = [("home/studio/humidity", json.dumps(good))] * 2 + [
        ("home/studio/humidity", json.dumps(late)),
        ("home/studio/humidity", json.dumps({"timestamp": "2024", "value": 1})),
        ("home/studio/humidity", json.dumps({"value": "x"})),
        ("home/studio/humidity", '{"timestamp": null}'), ("home/studio/humidity", "12"),
        ("home/status", json.dumps({"status": "complete", "total_messages": 5})),
        ("home/status", "{}")]
    os.makedirs(f"{tmp_path}/in")
    with open(f"{tmp_path}/in/m.json", "w") as f:
        f.writelines(json.dumps({"topic": t, "payload": p}) + "\n" for t, p in messages)
    out = f"{tmp_path}/out"
    ingest.ingest(spark, f"{tmp_path}/in", out)
    days = {r["date"]: r["count"] for r in
            ingest.stored_readings(spark, out).groupBy("date").count().collect()}
    assert days == {"2024-01-01": 2, "2019-05-05": 1, "unknown": 2}  # duplicates are kept
    assert ingest.stored_quarantine(spark, out).count() == 2
    assert sorted(r["status"] for r in ingest.stored_status(spark, out).collect()) == [
        "complete", "unknown"]
    ingest.ingest(spark, f"{tmp_path}/in", out)  # nothing new: nothing is added
    assert ingest.stored_readings(spark, out).count() == 5


def test_daily_stats_list_all_days(spark):
    df = spark.createDataFrame([(0, 10.0), (0, 20.0), (6, 5.0)],
                               "day_of_week int, total_power double")
    rows = profiles.daily_stats(df).orderBy("day_number").collect()
    assert [r["record_count"] for r in rows] == [2, 0, 0, 0, 0, 0, 1]
    assert rows[0]["power_median"] == 15.0 and rows[3]["power_mean"] is None
    assert "occupancy_mean" not in rows[0].asDict()


def test_realism_without_off_peak_or_empty_rows(spark):
    df = spark.createDataFrame([(h, 1.0, 80.0) for h in range(24)],
                               "hour int, occupancy_count double, power_refrigerator double")
    row = quality.appliance_realism(df).first()
    assert (row["unoccupied_pct"], row["off_mean"]) == (0.0, 0.0)
    assert row["max_ok"] and row["peak_ok"] and row["passed"] == 5  # 80 W is not active


def test_phase_choice():
    assert cli.chosen_phases(None, None, True) == [1, 3, 4, 5, 6]
    assert cli.chosen_phases(4, None, False) == [4]
    assert cli.chosen_phases(None, 5, False) == [5, 6]


def test_all_phases(spark, tmp_path):
    raw, out, messages = f"{tmp_path}/raw", f"{tmp_path}/out", f"{tmp_path}/messages"
    rows = readings(spark, SF).withColumn(
        "timestamp", F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss"))
    rows.write.option("header", True).csv(raw)
    ingest.encode(readings(spark, SF)).write.json(messages)
    write(f"{tmp_path}/ext.csv", "date,Appliances,lights,T1,RH_1\n"
          + "".join(f"2016-01-11 {h:02d}:00:00,{50 + h},0,{20 + h / 10},{40 + h}\n"
                    for h in range(24)))
    args = cli.parser().parse_args(
        ["--raw", raw, "--messages", messages, "--out", out, "--step", "2h", "--repeats", "2",
         "--appliances", f"{tmp_path}/ext.csv"])
    done = cli.run(spark, args, {"LinearRegression": {},
                                 "RandomForest": {"numTrees": [2], "maxDepth": [3]}}, folds=2)
    assert done == [2, 3, 1, 4, 5, 6]
    n = spark.read.parquet(f"{out}/features").count()
    assert n == 360
    shape = spark.read.parquet(f"{out}/split/rows").groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in shape} == {"train": 288, "test": 72}
    for name, rows_expected in (("evaluation", 2), ("comparisons", 1), ("gaps", 2),
                                ("stability", 2), ("normality", 2), ("learning_curves", 12),
                                ("coefficients", 16), ("importance", 30), ("decomposition", 30),
                                ("daily", 7), ("validation", 4), ("hourly_by_day", 108),
                                ("contrast", 1), ("totals", 2), ("day_distribution", 7)):
        assert spark.read.parquet(f"{out}/results/{name}").count() == rows_expected, name
    assert spark.read.parquet(f"{out}/results/summary").where("section = 6").count() == 1
    # 1 completeness, 3 power, 12 and 24 hourly, 8 realism and 7 correlation rows
    assert spark.read.parquet(f"{out}/results/quality").count() == 55
    trials = spark.read.parquet(f"{out}/models/grid_results").collect()
    assert sorted((t["model"], t["combo"], t["fold"]) for t in trials) == [
        ("RandomForest", 0, 0), ("RandomForest", 0, 1)]
    assert phases.INPUTS == [c for c in phases.FEATURES if c != "total_power"]


def test_mixed_folder_keeps_every_row_and_sensor(spark, tmp_path):
    """Long files with unlisted and quoted names beside a wide file with its own total."""
    raw = tmp_path / "raw"
    raw.mkdir()
    lines = ["timestamp,room,sensor_type,appliance,values"]
    for i in range(3):
        at = f"2024-01-01 00:{5 * i:02d}:00"
        lines += [f"{at},o'neil,temperature,,{20 + i}", f"{at},garage,temperature,,{30 + i}",
                  f"{at},kitchen,smart_plug,oven,1000", f"{at},kitchen,smart_plug,kettle,10"]
    write(str(raw / "long.csv"), "\n".join(lines).replace("values", csv_files.LONG_COLUMNS[-1]))
    write(str(raw / "wide.csv"), "timestamp,temperature_a,total_power\n"
          "2024-01-01 00:10:00,1,7\n2024-01-01 00:15:00,2,8\n2024-01-01 00:20:00,,9\n")
    got = {r["timestamp"].minute: r for r in phases.run_preprocessing(
        spark, str(raw), str(tmp_path / "out")).collect()}
    assert {m: (r["mean_temperature"], r["total_power"]) for m, r in got.items()} == {
        0: (25.0, 1010.0), 5: (26.0, 1010.0), 10: (27.0, 1010.0), 15: (2.0, 8.0)}


def test_mixed_folder_wide_rows_in_a_gap_of_the_long_files(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    lines = ["timestamp,room,sensor_type,appliance,values"]
    for minute in (0, 25):
        at = f"2024-01-01 00:{minute:02d}:00"
        lines += [f"{at},garage,temperature,,{30 + minute}", f"{at},kitchen,smart_plug,oven,1000"]
    write(str(raw / "long.csv"), "\n".join(lines).replace("values", csv_files.LONG_COLUMNS[-1]))
    write(str(raw / "wide.csv"), "timestamp,temperature_a,total_power\n"
          "2024-01-01 00:00:00,1,7\n2024-01-01 00:10:00,2,8\n2024-01-01 00:12:00,3,9\n"
          "2024-01-01 00:15:00,,9\n")
    got = phases.run_preprocessing(spark, str(raw), str(tmp_path / "out")).collect()
    rows = {r["timestamp"].minute: (r["mean_temperature"], r["total_power"]) for r in got}
    assert len(rows) == len(got) and rows == {
        0: (30.0, 1000.0), 5: (30.0, 1000.0), 10: (2.0, 8.0), 12: (3.0, 9.0),
        15: (30.0, 1000.0), 20: (30.0, 1000.0), 25: (55.0, 1000.0)}


def test_a_model_whose_folds_fail_gets_a_row(spark):
    scores = spark.createDataFrame([("a", 0, 0.9), ("a", 1, 0.8)], "model string, fold int, r2 double")
    got = {r["model"]: r for r in evaluate.with_failures(
        evaluate.cv_stability(scores), [("b", "FAILED: singular")]).collect()}
    assert got["b"]["verdict"] == "FAILED: singular" and got["b"]["cv_mean_r2"] is None
    assert got["a"]["cv_mean_r2"] == 0.85
    none = evaluate.with_failures(evaluate.cv_stability(scores), [])
    assert none.count() == 1


def test_a_batch_run_again_replaces_its_half_written_routes(spark, tmp_path):
    good = json.dumps({"topic": "home/studio/humidity", "payload": json.dumps(
        {"timestamp": "2024-01-01T10:00:00", "sensor_type": "humidity", "value": 1})})
    bad = json.dumps({"topic": "home/studio/humidity", "payload": "{broken"})
    write(f"{tmp_path}/in/a.json", f"{good}\n{bad}\n")
    out = f"{tmp_path}/out"
    assert ingest.stored_totals(spark, out) == {"readings": 0, "quarantine": 0, "status": 0}
    # What a crash in batch 0 may have left: one route there, the others not.
    ingest.routed(ingest.decode(spark.createDataFrame(
        [("home/studio/humidity", bytearray(b"{left over"))], "topic string, payload binary"))).write.partitionBy(
        "route", "date").parquet(f"{out}/messages/batch=0")
    rate = ingest.RunningRate()
    query, = ingest.ingest(spark, f"{tmp_path}/in", out, rate=rate)
    assert sum(p["numInputRows"] for p in query.recentProgress) == 2  # one read of the source
    assert ingest.stored_totals(spark, out) == {"readings": 1, "quarantine": 1, "status": 0}
    assert [bytes(r["payload"]) for r in ingest.stored_quarantine(spark, out).collect()] == [b"{broken"]
    assert rate.totals == ingest.stored_totals(spark, out) and rate.rate > 0


def test_running_rate_is_total_over_elapsed():
    now = [100.0]
    rate = ingest.RunningRate({"readings": 7}, every=30, clock=lambda: now[0])
    assert rate.rate == 0.0
    for seconds, n in ((10, 50), (25, 100), (10, 0), (40, 10)):
        now[0] += seconds
        rate.add({"readings": n, "status": 0})
    assert rate.totals == {"readings": 167, "status": 0} and rate.rate == 160 / 85
    assert rate.reports == [(150, 35.0, 150 / 35), (160, 85.0, 160 / 85)]


def flat(spark):
    """Features in which `occupancy_count` never changes and `hour` has a gap."""
    rows = [(0, 0, 5, 1, 100.0, 1.0, 3.0, 10.0), (1, 0, 5, 0, 200.0, 2.0, 1.0, 20.0),
            (None, 1, 5, 1, 500.0, 3.0, 2.0, 90.0), (3, 1, 5, 0, 400.0, 5.0, 1.0, 40.0)]
    return spark.createDataFrame(rows, "hour int, is_weekend int, occupancy_count int, "
                                 "day_of_week int, total_power double, mean_temperature double, "
                                 "mean_humidity double, active_appliances double")


def test_correlations_of_a_constant_are_null(spark):
    out = {(r["feature_a"], r["feature_b"]): r["r"]
           for r in profiles.correlations(flat(spark)).collect()}
    assert len(out) == 28
    assert all((r is None) == ("occupancy_count" in pair) for pair, r in out.items())
    assert out["hour", "total_power"] == pytest.approx(1.0)  # 0, 1, 3 and 100, 200, 400


def test_target_correlation_of_a_constant_is_weak(spark):
    out = {r["feature"]: r for r in profiles.target_correlations(flat(spark)).collect()}
    assert len(out) == 7 and out["hour"]["strength"] == "strong"
    assert out["occupancy_count"]["r"] is None and out["occupancy_count"]["strength"] == "weak"
    assert all(r["r"] is not None for f, r in out.items() if f != "occupancy_count")


def test_quality_report_of_a_constant_feature(spark):
    names = [c for c in phases.FEATURES if c not in flat(spark).columns]
    df = flat(spark).na.fill(0).select(
        "*", *[F.lit(1.0).alias(c) for c in names],
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, hour)").alias("timestamp"))
    out = {(r["section"], r["item"]): r["value"] for r in phases.quality_report(df).collect()}
    assert out["correlation", "occupancy_count"] is None
    assert out["correlation", "mean_temperature"] > 0 and out["power", "max"] == 500.0
