"""Sensor messages as a stream: decode, route, store, count, resample.

All transformations are plain DataFrame functions and work on batch tables too.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wattloom.fixed_values import STEP, TOPIC_PREFIX
from wattloom.functions.columns import event_date, half_even, iso_ts, number, sensor_topic, \
    step_seconds
from wattloom.operators.clean import reading_key

log = logging.getLogger(__name__)
ENVELOPE = "topic STRING, payload BINARY"
_FIELDS = ["timestamp", "room", "sensor_type", "appliance", "value"]
_PAYLOAD = (", ".join(f"{f} STRING" for f in [*_FIELDS, "status", "total_messages"])
            + ", _corrupt STRING")


def message_source(spark: SparkSession, folder: str, files_per_trigger: int | None = None,
                   ) -> DataFrame:
    """Stream of (topic, payload) from a folder of JSON lines, payload as text.

    With the Kafka connector on the classpath, `read_kafka` gives the same columns.
    """
    reader = spark.readStream.schema("topic STRING, payload STRING")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(folder).select("topic", F.col("payload").cast("binary").alias("payload"))


def read_kafka(spark: SparkSession, servers: str, topics: str) -> DataFrame:
    """The same stream from Kafka; the message key holds the sensor topic."""
    return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("subscribe", topics).load()
            .select(F.col("key").cast("string").alias("topic"), F.col("value").alias("payload")))


def encode(readings: DataFrame, prefix: str = TOPIC_PREFIX) -> DataFrame:
    """Readings as (topic, payload) messages; appliance values carry two decimals."""
    plug = F.nullif(F.col("appliance"), F.lit("")).isNotNull()
    value = F.when(plug, half_even("value", 2)).otherwise(F.col("value"))
    return readings.select(
        sensor_topic(prefix).alias("topic"),
        F.to_json(F.struct(iso_ts("timestamp").alias("timestamp"), "room", "sensor_type",
                           F.col("appliance"), value.alias("value"))).alias("payload"))


def decode(messages: DataFrame) -> DataFrame:
    """Add the payload's fields and `bad`: not UTF-8, not JSON, or not an object.

    An absent field becomes '', an explicit null timestamp counts as bad.
    """
    text = F.try_validate_utf8(F.col("payload").cast("string"))
    body = F.from_json(text, _PAYLOAD, {"mode": "PERMISSIVE",
                                        "columnNameOfCorruptRecord": "_corrupt"})
    parsed = messages.select("topic", "payload", text.alias("_text"), body.alias("_b"))
    null_time = F.col("_text").rlike(r'"timestamp"\s*:\s*null')
    bad = (F.col("_text").isNull() | F.col("_b").isNull() | F.col("_b._corrupt").isNotNull()
           | (F.col("_b.timestamp").isNull() & null_time))
    return parsed.select(
        "topic", "payload", *[F.coalesce(F.col(f"_b.{f}"), F.lit("")).alias(f) for f in _FIELDS],
        F.col("_b.status").alias("status"), F.col("_b.total_messages").alias("total_messages"),
        F.coalesce(bad, F.lit(True)).alias("bad"))


def is_status(prefix: str = TOPIC_PREFIX) -> Column:
    return F.coalesce(F.col("topic") == F.lit(f"{prefix}/status"), F.lit(False))


def readings_of(decoded: DataFrame, prefix: str = TOPIC_PREFIX) -> DataFrame:
    """Data messages as raw rows with their event date; late ones keep their own day."""
    return decoded.where(~F.col("bad") & ~is_status(prefix)).select(
        *_FIELDS, event_date("timestamp").alias("date"))


def quarantine_of(decoded: DataFrame) -> DataFrame:
    return decoded.where("bad").select("topic", "payload")


def status_of(decoded: DataFrame, prefix: str = TOPIC_PREFIX) -> DataFrame:
    """Control messages; a status without a name is 'unknown'."""
    return decoded.where(~F.col("bad") & is_status(prefix)).select(
        F.coalesce("status", F.lit("unknown")).alias("status"), "timestamp",
        number("total_messages").cast("bigint").alias("total_messages"))


@contextmanager
def state_partitions(spark: SparkSession, n: int | None) -> Iterator[None]:
    """Start stateful queries inside with n state stores; a checkpoint keeps its number."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    if n:
        spark.conf.set(name, str(n))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def append_to(stream: DataFrame, path: str, checkpoint: str, by: str | None = None,
              once: bool = True, every: str = "30 seconds",
              stores: int | None = None) -> StreamingQuery:
    """Append a stream to a Parquet table, exactly once across restarts. `stores` sets
    the number of state stores of a new checkpoint."""
    writer = (stream.writeStream.format("parquet").outputMode("append")
              .option("path", path).option("checkpointLocation", checkpoint))
    if by:
        writer = writer.partitionBy(by)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)
    with state_partitions(stream.sparkSession, stores):
        return writer.start()


ROUTES = ("readings", "quarantine", "status")
_STORED = (ENVELOPE + ", " + ", ".join(f"{f} STRING" for f in [*_FIELDS, "status", "total_messages"])
           + ", batch BIGINT, route STRING, date STRING")


def routed(decoded: DataFrame, prefix: str = TOPIC_PREFIX) -> DataFrame:
    """Every message with the route it takes; readings also with their event date."""
    route = F.when(F.col("bad"), "quarantine").when(is_status(prefix), "status").otherwise("readings")
    dated = F.when(F.col("route") == "readings", event_date("timestamp")).otherwise("none")
    return decoded.withColumn("route", route).withColumn("date", dated).drop("bad")


@dataclass
class RunningRate:
    """Messages by route, and the rate since the start, logged every `every` seconds.

    The counts come with each batch's own write, so they cost no state and no pass. `totals`
    may start from what is stored; the rate is that of this run."""

    totals: dict[str, int] = field(default_factory=dict)
    every: float = 30.0
    clock: Callable[[], float] = time.monotonic
    seen: int = 0
    reports: list[tuple[int, float, float]] = field(default_factory=list)

    def __post_init__(self):
        self.started = self.reported = self.clock()

    @property
    def rate(self) -> float:
        """Messages a second: all of this run over its whole time."""
        elapsed = self.clock() - self.started
        return self.seen / elapsed if elapsed > 0 else 0.0

    def add(self, counts: dict[str, int]) -> None:
        for route, n in counts.items():
            self.totals[route] = self.totals.get(route, 0) + n
            self.seen += n
        now = self.clock()
        if now - self.reported >= self.every:
            self.reported = now
            self.reports.append((self.seen, now - self.started, self.rate))
            log.info("%d messages in %.0f s, %.1f a second; %s", *self.reports[-1], self.totals)


def ingest(spark: SparkSession, source: str, out: str, once: bool = True,
           files_per_trigger: int | None = None,
           rate: RunningRate | None = None) -> list[StreamingQuery]:
    """One query from a folder of messages to all routes: the source is read and decoded
    once, and a batch is one write under its number. A batch that is run again after a crash
    replaces what it had written, so no route is ahead of another and nothing is doubled."""
    decoded = decode(message_source(spark, source, files_per_trigger))

    def write(batch: DataFrame, number_: int) -> None:
        counted = Observation(f"batch-{number_}")
        rows = routed(batch)
        if rate is not None:
            rows = rows.observe(counted, *[F.count_if(F.col("route") == r).alias(r) for r in ROUTES])
        rows.write.mode("overwrite").partitionBy("route", "date").parquet(
            f"{out}/messages/batch={number_}")
        if rate is not None:
            rate.add(counted.get)
    writer = decoded.writeStream.foreachBatch(write).option(
        "checkpointLocation", f"{out}/_state/messages")
    query = (writer.trigger(availableNow=True) if once
             else writer.trigger(processingTime="30 seconds")).start()
    if once:
        query.awaitTermination()
    return [query]


def stored(spark: SparkSession, out: str, route: str) -> DataFrame:
    """The ingested messages of a route; other routes' files are not read."""
    try:
        rows = spark.read.schema(_STORED).parquet(f"{out}/messages")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], _STORED)
    return rows.where(F.col("route") == route)


def stored_totals(spark: SparkSession, out: str) -> dict[str, int]:
    """How many messages of each route are stored."""
    return {r: stored(spark, out, r).count() for r in ROUTES}


def stored_readings(spark: SparkSession, out: str) -> DataFrame:
    """The ingested readings; the date is read as text, as it may be 'unknown'."""
    return stored(spark, out, "readings").select(*_FIELDS, "date")


def stored_quarantine(spark: SparkSession, out: str) -> DataFrame:
    return stored(spark, out, "quarantine").select("topic", "payload")


def stored_status(spark: SparkSession, out: str) -> DataFrame:
    """Control messages; a status without a name is 'unknown'."""
    return stored(spark, out, "status").select(
        F.coalesce("status", F.lit("unknown")).alias("status"), "timestamp",
        number("total_messages").cast("bigint").alias("total_messages"))


def ingest_completeness(spark: SparkSession, out: str) -> DataFrame:
    """Messages the publisher declared in its last 'complete' status, and those stored."""
    declared = (stored_status(spark, out).where("status = 'complete'")
                .agg(F.max_by("total_messages", "timestamp").alias("declared")))
    kept = stored_readings(spark, out).agg(F.count(F.lit(1)).alias("stored"))
    joined = declared.withColumn("_k", F.lit(1)).join(kept.withColumn("_k", F.lit(1)), "_k")
    return joined.select("declared", "stored",
                         (F.col("declared") == F.col("stored")).alias("complete"))


def running_counters(decoded: DataFrame, prefix: str = TOPIC_PREFIX) -> DataFrame:
    """Message counts by kind, sensor type and room; state grows with the number of
    sensors and rooms only. Use it with the update or complete mode."""
    kind = F.when(F.col("bad"), "error").when(is_status(prefix), "status").otherwise("data")
    data = kind == "data"
    return decoded.groupBy(
        kind.alias("kind"), F.when(data, F.col("sensor_type")).alias("sensor_type"),
        F.when(data, F.col("room")).alias("room")).agg(F.count(F.lit(1)).alias("n"))


def rate_of(query: StreamingQuery) -> float:
    """Rows per second of the latest micro-batch."""
    progress = query.lastProgress
    return float(progress["processedRowsPerSecond"] or 0.0) if progress else 0.0


def typed(raw: DataFrame) -> DataFrame:
    """Raw rows with an event time (an instant, as watermarks need one) and a number."""
    return raw.select(
        F.col("timestamp").try_cast("timestamp").alias("timestamp"), "room", "sensor_type",
        "appliance", number("value").alias("value")).where(
        "timestamp IS NOT NULL AND value IS NOT NULL")


def stream_bins(readings: DataFrame, step: str = STEP, delay: str = "10 minutes") -> DataFrame:
    """Mean of the per-timestamp means by sensor and bin, emitted once the watermark
    has passed the bin. State holds the open bins only."""
    keyed = readings.select("timestamp", reading_key().alias("key"), "value").where(
        "key IS NOT NULL").withWatermark("timestamp", delay)
    width = f"{step_seconds(step)} seconds"
    # The first grouping is by a zero-length step of event time: the exact timestamp.
    exact = keyed.groupBy(F.window("timestamp", "1 second").alias("tick"), "key").agg(
        F.avg("value").alias("value"))
    return exact.groupBy(F.window("tick", width).alias("bin"), "key").agg(
        F.avg("value").alias("value")).select(
        F.col("bin.start").alias("timestamp"), "key", "value")
