"""Streaming jobs, drained to the end; the answer equals the batch answer on the same events."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faremill.functions.events import parse_event
from faremill.functions.times import plus_seconds, to_epoch_ms
from faremill.registry import query
from faremill.session import workspace
from faremill.sources.files import instants
from faremill.sources.tables import load, plain, table_path
from faremill.sources.topics import RIDE_EVENT, file_stream
from faremill.streaming import jobs
from faremill.streaming.late import STATE_STORE, mark_late, mark_late_in_stream


def rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in the shape of ride events, time as epoch milliseconds."""
    return load(spark, sf_dir, "events").select(
        (F.col("user_id") % 265).cast("int").alias("PULocationID"),
        (F.col("event_id") % 265).cast("int").alias("DOLocationID"),
        F.col("value").alias("trip_distance"),
        F.col("value").alias("total_amount"),
        to_epoch_ms("ts").alias("tpep_pickup_datetime"),
        "event_type",
    )


_RIDES_SQL = """
rides AS (
  SELECT CAST(user_id % 265 AS INTEGER) AS PULocationID,
         CAST(event_id % 265 AS INTEGER) AS DOLocationID, value AS trip_distance,
         value AS total_amount, make_timestamp(epoch_us(ts) // 1000 * 1000) AS pickup_datetime
  FROM events
)"""


def _send(rows: DataFrame, topic: str) -> None:
    """Add messages to a landed topic folder."""
    jobs.as_messages(rows, *RIDE_EVENT.fieldNames()).write.mode("append").text(topic)


def _typed(spark: SparkSession, topic: str) -> DataFrame:
    messages = file_stream(spark, topic, max_files=16)  # bounded batches
    return jobs.passthrough(messages, RIDE_EVENT, "tpep_pickup_datetime", "pickup_datetime")


@query("T1 T2 S19", f"WITH {_RIDES_SQL} SELECT * FROM rides")
def stream_passthrough(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = workspace(spark, "passthrough")
    _send(rides(spark, sf_dir), f"{base}/topic")
    stream = _typed(spark, f"{base}/topic")
    jobs.drain(jobs.to_files(stream, f"{base}/out", f"{base}/checkpoint", interval=None))
    return plain(spark.read.parquet(f"{base}/out"))


@query("T3 T5 S20", f"WITH {_RIDES_SQL} SELECT * FROM rides")
def stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs on one checkpoint, with messages added in between: each message arrives once."""
    base = workspace(spark, "resume")
    sent = rides(spark, sf_dir)
    clicks = F.col("event_type") == "click"
    for part in (sent.filter(clicks), sent.filter(~clicks)):
        _send(part, f"{base}/topic")
        stream = _typed(spark, f"{base}/topic")
        jobs.drain(jobs.to_files(stream, f"{base}/out", f"{base}/checkpoint", interval=None))
    return plain(spark.read.parquet(f"{base}/out"))


@query("K15 T7", f"WITH {_RIDES_SQL} SELECT * FROM rides")
def stream_to_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Micro-batches written one by one, each to a place of its own, so a repeat is harmless."""
    base = workspace(spark, "batches")
    _send(rides(spark, sf_dir), f"{base}/topic")
    writer = jobs.batch_folder_writer(f"{base}/out")
    stream = _typed(spark, f"{base}/topic")
    jobs.drain(jobs.to_batches(stream, writer, f"{base}/checkpoint", interval=None))
    return plain(spark.read.parquet(f"{base}/out").drop("batch_id"))


# a fifth of the events happened 3 to 10 seconds before they arrived
_LATE_BY = "CASE WHEN event_id * 7919 % 100 < 20 THEN 3 + event_id * 31 % 8 ELSE 0 END"


@query(
    "T6",
    f"""SELECT event_id, ts AS arrived, ts - to_seconds({_LATE_BY}) AS happened,
               {_LATE_BY} >= 3 AS is_late
        FROM events""",
)
def late_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = F.when(
        F.col("event_id") * 7919 % 100 < 20, 3 + F.col("event_id") * 31 % 8
    ).otherwise(0)
    events = load(spark, sf_dir, "events").select(
        "event_id", F.col("ts").alias("arrived"), plus_seconds("ts", -seconds).alias("happened")
    )
    return plain(jobs.flag_late(events, "arrived", "happened", 3.0))


@query(
    "X20 K17",
    f"""WITH {_RIDES_SQL}
    SELECT PULocationID, DOLocationID, trip_distance, total_amount,
           epoch_us(pickup_datetime) // 1000 AS tpep_pickup_datetime FROM rides""",
)
def event_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = jobs.as_messages(rides(spark, sf_dir), *RIDE_EVENT.fieldNames())
    return messages.select(parse_event("value", RIDE_EVENT).alias("e")).select("e.*")


@query(
    "T8",
    """WITH hours AS (
      SELECT date_trunc('hour', ts) AS window_start, CAST(user_id % 25 AS INTEGER) AS zone,
             count(*) AS number_records,
             CAST(CAST(sum(CAST(value AS DECIMAL(38,9))) AS VARCHAR) AS DOUBLE) AS amount
      FROM events GROUP BY 1, 2)
    SELECT * FROM hours
    WHERE window_start + to_hours(1) <= (SELECT max(ts) - to_seconds(10) FROM events)""",
)
def stream_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly count and sum per zone under a 10-second watermark; open windows are not emitted."""
    base = workspace(spark, "tumbling")
    path = table_path(sf_dir, "events")
    schema = spark.read.parquet(path).schema
    # a pattern, since a stream source refuses the name of a single file
    files = spark.readStream.schema(T.StructType(schema.fields)).parquet(f"{path}*")
    stream = instants(files).select(
        "ts", (F.col("user_id") % 25).cast("int").alias("zone"), "value"
    )
    closed = jobs.windowed(stream, "ts", "10 seconds", "1 hour", ["zone"], "value")
    jobs.drain(jobs.to_files(closed, f"{base}/out", f"{base}/checkpoint", interval=None))
    return plain(spark.read.parquet(f"{base}/out"))


# --- rows that arrive after others that are newer -------------------------------------

# The events arrive in six slices of five days, half an hour past the hour; each fiftieth one
# comes two slices later. A slice is as many files as one micro-batch takes.
SLICES, FIRST_RUN, SLICE_FILES = 6, 3, 4
_SLICE_SQL = f"""
sliced AS (
  SELECT *, least({SLICES - 1}, (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01 00:30:00'))
           // 432000000000 + CASE WHEN event_id % 50 = 7 THEN 2 ELSE 0 END) AS slice
  FROM (SELECT *, ts >= TIMESTAMP '2024-01-01 00:30:00' AS started FROM events) WHERE started
)"""


def _sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.lit("2024-01-01 00:30:00").cast("timestamp")
    days = F.floor((F.unix_micros("ts") - F.unix_micros(start)) / F.lit(432_000_000_000))
    delayed = F.when(F.col("event_id") % 50 == 7, 2).otherwise(0)
    events = load(spark, sf_dir, "events").filter(F.col("ts") >= start)
    return events.withColumn("slice", F.least(F.lit(SLICES - 1), days + delayed))


def _land_slices(rows: DataFrame, topic: str, slices: range) -> None:
    """Messages in order of arrival: a later slice has later files."""
    for n in slices:
        some = rows.filter(F.col("slice") == n).drop("slice").repartition(SLICE_FILES)
        jobs.as_messages(some).write.mode("append").text(topic)


@query(
    "T8",
    f"""WITH {_SLICE_SQL},
    marks AS (
      SELECT slice, max(max(ts)) OVER (ORDER BY slice) - to_seconds(10) AS mark
      FROM sliced GROUP BY slice),
    -- a batch drops by the mark of the batch before it, which knows the slices before that one;
    -- the first batch of the second run by that of the whole first run
    bounds AS (
      SELECT s.slice, m.mark FROM (SELECT DISTINCT slice FROM sliced) s LEFT JOIN marks m
        ON m.slice = CASE WHEN s.slice IN ({FIRST_RUN}, {FIRST_RUN + 1}) THEN {FIRST_RUN - 1}
                          ELSE s.slice - 2 END)
    SELECT date_trunc('hour', ts) AS window_start, CAST(user_id % 25 AS INTEGER) AS zone,
           count(*) AS number_records,
           CAST(CAST(sum(CAST(value AS DECIMAL(38,9))) AS VARCHAR) AS DOUBLE) AS amount
    FROM sliced JOIN bounds USING (slice)
    WHERE (mark IS NULL OR date_trunc('hour', ts) + to_hours(1) > mark)
      AND date_trunc('hour', ts) + to_hours(1) <= (SELECT max(mark) FROM marks)
    GROUP BY 1, 2""",
)
def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly windows over two runs on one checkpoint, several bounded batches each.

    The watermark moves on from batch to batch: rows that arrive behind it are dropped, and
    windows that are open at the end of the first run are continued by the second.
    """
    base = workspace(spark, "late-rows")
    events = _sliced(spark, sf_dir)
    schema = T.StructType([f for f in events.schema.fields if f.name != "slice"])
    for slices in (range(FIRST_RUN), range(FIRST_RUN, SLICES)):
        _land_slices(events, f"{base}/topic", slices)
        messages = file_stream(spark, f"{base}/topic", max_files=SLICE_FILES)
        rows = messages.select(parse_event("value", schema).alias("e")).select("e.*")
        stream = rows.select("ts", (F.col("user_id") % 25).cast("int").alias("zone"), "value")
        closed = jobs.windowed(stream, "ts", "10 seconds", "1 hour", ["zone"], "value")
        jobs.drain(jobs.to_files(closed, f"{base}/out", f"{base}/checkpoint", interval=None))
    return plain(spark.read.parquet(f"{base}/out"))


# events of eight producers; a fifth of them is sent one and a half to five hours after it happened
DELAY = dt.timedelta(hours=1)
_BEHIND_SQL = """
behind AS (
  SELECT event_id, CAST(user_id % 8 AS INTEGER) AS producer,
         ts - to_seconds(CASE WHEN event_id * 7919 % 100 < 20 THEN 1800 * (3 + event_id * 31 % 8)
                              ELSE 0 END) AS happened
  FROM events
)"""
_LATE_SQL = f"""WITH {_BEHIND_SQL}
    SELECT event_id, producer, happened,
           coalesce(happened < max(happened) OVER (PARTITION BY producer ORDER BY event_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - to_hours(1), false) AS is_late
    FROM behind"""


def _behind(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = F.when(
        F.col("event_id") * 7919 % 100 < 20, (3 + F.col("event_id") * 31 % 8) * 1800
    ).otherwise(0)
    return load(spark, sf_dir, "events").select(
        "event_id",
        (F.col("user_id") % 8).cast("int").alias("producer"),
        plus_seconds("ts", -seconds).alias("happened"),
    )


@query("T6", _LATE_SQL)
def late_by_running_maximum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events behind the newest one of their producer by more than an hour, on a table."""
    return plain(mark_late(_behind(spark, sf_dir), "producer", "event_id", "happened", DELAY))


@query("T6", _LATE_SQL)
def stream_late_by_running_maximum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in a stream that keeps the newest time of each producer, over two runs."""
    base = workspace(spark, "late-state")
    events = _behind(spark, sf_dir)
    newest = events.agg(F.max("event_id")).head()[0] or 0
    # JSON times would be cut to milliseconds
    sent = events.withColumn("happened", F.unix_micros("happened"))
    schema = sent.schema
    sent = sent.withColumn("slice", F.floor(F.col("event_id") * SLICES / F.lit(newest + 1)))
    before = {k: spark.conf.get(k, None) for k in STATE_STORE}
    for name, value in STATE_STORE.items():
        spark.conf.set(name, value)
    try:
        for slices in (range(FIRST_RUN), range(FIRST_RUN, SLICES)):
            _land_slices(sent, f"{base}/topic", slices)
            messages = file_stream(spark, f"{base}/topic", max_files=SLICE_FILES)
            rows = messages.select(parse_event("value", schema).alias("e")).select("e.*")
            rows = rows.withColumn("happened", F.timestamp_micros("happened"))
            marked = mark_late_in_stream(rows, "producer", "event_id", "happened", DELAY)
            jobs.drain(jobs.to_files(marked, f"{base}/out", f"{base}/checkpoint", interval=None))
    finally:
        for name, value in before.items():
            spark.conf.set(name, value) if value is not None else spark.conf.unset(name)
    return plain(spark.read.parquet(f"{base}/out"))
