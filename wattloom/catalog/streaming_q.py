"""Queries over the message stream. The events are re-encoded as message files in the
shared folder, read as a stream until all files are processed, and compared."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattloom.catalog.base import GRID_CTE, KEYS, LONG_CTE, query, r6, readings, with_
from wattloom.operators.clean import clean_long
from wattloom.session import work_path
from wattloom.streaming import ingest

# Every 40th or so message is broken, two messages report the publisher's status.
_BROKEN = "minute(timestamp)::INT % 40 = 7"
_VALUE = ("CASE WHEN appliance IS NOT NULL THEN round_even((value * 100)::DOUBLE, 0) / 100 "
          "ELSE value END")


def _messages(spark, sf):
    rows = readings(spark, sf)
    broken = F.pmod(F.minute("timestamp"), F.lit(40)) == 7
    good = ingest.encode(rows.where(~broken))
    bad = rows.where(broken).select(
        F.concat(F.lit("home/"), "room", F.lit("/temperature")).alias("topic"),
        F.when(F.second("timestamp") % 2 == 0, "{not json").otherwise("[1, 2]").alias("payload"))
    total = rows.where(~broken).agg(F.count(F.lit(1)).alias("n"))
    status = total.select(F.explode(F.array(
        F.struct(F.lit("online").alias("status"), F.lit("2024-01-01T00:00:00").alias("timestamp"),
                 F.lit(None).cast("bigint").alias("total_messages")),
        F.struct(F.lit("complete").alias("status"), F.lit("2024-01-31T00:00:00").alias("timestamp"),
                 F.col("n").alias("total_messages")))).alias("s")).select(
        F.lit("home/status").alias("topic"), F.to_json("s").alias("payload"))
    return good.unionAll(bad).unionAll(status)


def _ingested(spark, sf):
    folder, out = work_path(spark, "messages"), work_path(spark, "ingested")
    _messages(spark, sf).write.json(folder)
    ingest.ingest(spark, folder, out)
    return out


@query("st01_ingest", with_(LONG_CTE, f"""
SELECT room, sensor_type, coalesce(appliance, '') AS appliance, count(*) AS n,
  round(sum({_VALUE}), 6) + 0 AS total FROM long WHERE NOT ({_BROKEN})
GROUP BY room, sensor_type, appliance"""))
def st01(spark, sf):
    rows = ingest.stored_readings(spark, _ingested(spark, sf))
    return rows.groupBy("room", "sensor_type", "appliance").agg(
        F.count(F.lit(1)).alias("n"), r6(F.sum(F.col("value").try_cast("double")), "total", 6))


@query("st02_quarantine", with_(LONG_CTE, f"""
SELECT CASE WHEN second(timestamp)::INT % 2 = 0 THEN '{{not json' ELSE '[1, 2]' END AS payload,
  count(*) AS n FROM long WHERE {_BROKEN} GROUP BY 1"""))
def st02(spark, sf):
    out = _ingested(spark, sf)
    rows = ingest.stored_quarantine(spark, out)
    return rows.groupBy(F.col("payload").cast("string").alias("payload")).agg(
        F.count(F.lit(1)).alias("n"))


@query("st03_status_check", with_(LONG_CTE, f"""
SELECT count(*) AS declared, count(*) AS stored, true AS complete FROM long
WHERE NOT ({_BROKEN})"""))
def st03(spark, sf):
    return ingest.ingest_completeness(spark, _ingested(spark, sf))


@query("st04_running_counters", with_(LONG_CTE, f"""
SELECT CASE WHEN {_BROKEN} THEN 'error' ELSE 'data' END AS kind,
  CASE WHEN NOT ({_BROKEN}) THEN sensor_type END AS sensor_type,
  CASE WHEN NOT ({_BROKEN}) THEN room END AS room, count(*) AS n FROM long GROUP BY 1, 2, 3
UNION ALL SELECT 'status', NULL, NULL, 2"""))
def st04(spark, sf):
    folder = work_path(spark, "messages")
    _messages(spark, sf).repartition(4).write.json(folder)
    counters = ingest.running_counters(ingest.decode(ingest.message_source(spark, folder, 2)))
    # The complete result has one row per sensor type and room, so memory can hold it.
    name = "counters_" + work_path(spark, "c").rsplit("-", 1)[1]
    writer = (counters.writeStream.format("memory").queryName(name).outputMode("complete")
              .trigger(availableNow=True).option("checkpointLocation", work_path(spark, "state")))
    with ingest.state_partitions(spark, spark.sparkContext.defaultParallelism):
        q = writer.start()
    q.awaitTermination()
    return spark.table(name)


@query("st04_totals_after_restart", with_(LONG_CTE, f"""
SELECT CASE WHEN {_BROKEN} THEN 'quarantine' ELSE 'readings' END AS route, count(*) AS n
FROM long GROUP BY 1 UNION ALL SELECT 'status', 2"""))
def st04_totals(spark, sf):
    # Half of the files, then the rest by a new run that starts from the stored totals.
    folder, out = work_path(spark, "messages"), work_path(spark, "ingested")
    messages = _messages(spark, sf).withColumn("_half", F.pmod(F.xxhash64("payload"), F.lit(2)))
    totals = {}
    for half in (0, 1):
        messages.where(F.col("_half") == half).drop("_half").write.mode("append").json(folder)
        rate = ingest.RunningRate(ingest.stored_totals(spark, out))
        ingest.ingest(spark, folder, out, rate=rate)
        totals = rate.totals
    return spark.createDataFrame(sorted(totals.items()), "route string, n long")


@query("st05_event_dates", with_(LONG_CTE, f"""
SELECT strftime(timestamp, '%Y-%m-%d') AS date, count(*) AS n FROM long WHERE NOT ({_BROKEN})
GROUP BY 1"""))
def st05(spark, sf):
    return ingest.stored_readings(spark, _ingested(spark, sf)).groupBy("date").agg(
        F.count(F.lit(1)).alias("n"))


@query("s14_stream_source", with_(LONG_CTE, f"""
SELECT 'home/' || room || CASE WHEN appliance IS NULL THEN '/' || sensor_type
  ELSE '/appliance/' || appliance END AS topic, count(*) AS n FROM long WHERE NOT ({_BROKEN})
GROUP BY 1"""))
def s14(spark, sf):
    folder, out = work_path(spark, "messages"), work_path(spark, "raw")
    _messages(spark, sf).write.json(folder)
    ingest.append_to(ingest.message_source(spark, folder), out, work_path(spark, "state"),
                     ).awaitTermination()
    decoded = ingest.decode(spark.read.schema("topic STRING, payload BINARY").parquet(out))
    return decoded.where(~F.col("bad") & ~ingest.is_status()).groupBy("topic").agg(
        F.count(F.lit(1)).alias("n"))


@query("s15_daily_sink", with_(LONG_CTE, f"""
SELECT strftime(timestamp, '%Y-%m-%d') AS date, sensor_type, count(*) AS n FROM long
WHERE NOT ({_BROKEN}) GROUP BY 1, 2"""))
def s15(spark, sf):
    rows = ingest.stored_readings(spark, _ingested(spark, sf))
    return rows.groupBy("date", "sensor_type").agg(
        F.count(F.lit(1)).alias("n"))


# One message each: good, no fields, not JSON, not an object, null time, bad UTF-8.
_EDGE = "event_id % 6"


@query("f10_json_decode", f"""
SELECT ({_EDGE})::INT AS kind, {_EDGE} > 1 AS bad,
  CASE WHEN {_EDGE} = 0 THEN 'kitchen' ELSE '' END AS room, count(*) AS n
FROM events GROUP BY 1, 2, 3""")
def f10(spark, sf):
    from wattloom.catalog.base import table
    kind = (F.col("event_id") % 6).cast("int")
    payload = (F.when(kind == 0, F.concat(F.lit('{"room": "kitchen", "value": '),
                                          F.col("value").cast("string"), F.lit("}")))
               .when(kind == 1, "{}").when(kind == 2, '{"room":').when(kind == 3, "[1]")
               .when(kind == 4, '{"timestamp": null}'))
    events = table(spark, sf, "events").select(
        F.concat(F.lit("k/"), kind).alias("topic"),
        F.coalesce(payload.cast("binary"), F.unhex(F.lit("7BFF7D"))).alias("payload"))
    return ingest.decode(events).groupBy(
        F.substring("topic", 3, 1).cast("int").alias("kind"), "bad", "room").agg(
        F.count(F.lit(1)).alias("n"))


@query("f11_json_encode", with_(LONG_CTE, f"""
SELECT timestamp, CASE WHEN appliance IS NULL THEN value ELSE {_VALUE} END AS value, room
FROM long""".replace("SELECT timestamp", "SELECT date_trunc('second', timestamp)::TIMESTAMP "
                     "AS timestamp")))
def f11(spark, sf):
    encoded = ingest.encode(readings(spark, sf))
    body = F.from_json("payload", "timestamp STRING, room STRING, value DOUBLE")
    return encoded.select(body.alias("b")).select(
        F.col("b.timestamp").try_cast("timestamp_ntz").alias("timestamp"),
        F.col("b.value").alias("value"), F.col("b.room").alias("room"))


@query("p10_envelope_routing", with_(LONG_CTE, f"""
SELECT CASE WHEN {_BROKEN} THEN 'quarantine' ELSE 'data' END AS route, count(*) AS n
FROM long GROUP BY 1 UNION ALL SELECT 'status', 2"""))
def p10(spark, sf):
    decoded = ingest.decode(_messages(spark, sf).withColumn(
        "payload", F.col("payload").cast("binary")))
    route = F.when(F.col("bad"), "quarantine").when(ingest.is_status(), "status").otherwise("data")
    return decoded.groupBy(route.alias("route")).agg(F.count(F.lit(1)).alias("n"))


def _binned_stream(spark, sf, restarts=1):
    """Message files written in order of event time, then one far-future message that
    moves the watermark past every real bin."""
    folder, out, state = (work_path(spark, n) for n in ("messages", "bins", "state"))
    rows = readings(spark, sf)
    for first, last in (("1970-01-01", "2024-01-16"), ("2024-01-16", "2099-01-01")):
        part = rows.where((F.col("timestamp") >= F.lit(first).cast("timestamp_ntz"))
                          & (F.col("timestamp") < F.lit(last).cast("timestamp_ntz")))
        ingest.encode(part).write.mode("append").json(folder)
        for _ in range(restarts):
            _run_bins(spark, folder, out, state)
    flush = rows.limit(1).withColumn("timestamp", F.lit("2099-01-01").cast("timestamp_ntz"))
    ingest.encode(flush).write.mode("append").json(folder)
    _run_bins(spark, folder, out, state)
    return spark.read.schema("timestamp TIMESTAMP, key STRING, value DOUBLE").parquet(out)


def _run_bins(spark, folder, out, state):
    stream = ingest.decode(ingest.message_source(spark, folder))
    bins = ingest.stream_bins(ingest.typed(ingest.readings_of(stream)))
    stores = spark.sparkContext.defaultParallelism
    ingest.append_to(bins, out, state, stores=stores).awaitTermination()


_BINS_SQL = with_(LONG_CTE, f"""
SELECT time_bucket(INTERVAL 5 MINUTE, timestamp) AS timestamp, key,
  round(avg(value), 9) + 0 AS value FROM (
  SELECT date_trunc('second', timestamp)::TIMESTAMP AS timestamp, key, avg({_VALUE}) AS value
  FROM keyed GROUP BY 1, 2) GROUP BY 1, 2""")


@query("st06_stream_bins", _BINS_SQL)
def st06(spark, sf):
    return _binned_stream(spark, sf).select(
        F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), "key", r6("value", digits=9))


@query("st07_resume", _BINS_SQL)
def st07(spark, sf):
    # The same stream, started again after every run: nothing is lost or repeated.
    return _binned_stream(spark, sf, restarts=2).select(
        F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), "key", r6("value", digits=9))


@query("st01_batch_parity", with_(GRID_CTE.replace(
    "FROM events)", f"FROM events WHERE NOT ({_BROKEN.replace('timestamp', 'ts')}))"), f"""
SELECT {", ".join(f"count({k}) AS {k}" for k in KEYS)} FROM binned"""))
def st01_parity(spark, sf):
    # Stored stream rows feed the batch operators unchanged.
    from wattloom.operators.reshape import bin_start, pivot_mean
    rows = clean_long(ingest.stored_readings(spark, _ingested(spark, sf)).drop("date"))
    ticks = pivot_mean(rows, KEYS)
    return ticks.groupBy(bin_start("timestamp", 300).alias("t")).agg(
        *[F.expr(f"count({k}) AS {k}") for k in KEYS]).agg(
        *[F.expr(f"sum(CAST({k} > 0 AS BIGINT)) AS {k}") for k in KEYS])


