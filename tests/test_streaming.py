from __future__ import annotations

import datetime as dt
import json
import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from faremill.sources.topics import RIDE_EVENT, file_stream, topic_options
from faremill.streaming import jobs
from faremill.streaming.generate import make_events
from tests.conftest import rows, ts


def send(folder, name, *events):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.json", "w") as out:
        out.writelines(json.dumps(e) + "\n" for e in events)


def event(i, ms=1730429702000):
    return {
        "PULocationID": i, "DOLocationID": 79, "trip_distance": 1.72, "total_amount": 17.31,
        "tpep_pickup_datetime": ms,
    }


def typed(spark, folder, **options):
    return jobs.passthrough(
        file_stream(spark, folder, **options), RIDE_EVENT, "tpep_pickup_datetime",
        "pickup_datetime",
    )


def run(spark, base, reader):
    jobs.drain(
        jobs.to_files(typed(spark, base + "/topic"), f"{base}/{reader}", f"{base}/{reader}-mark", None)
    )
    return spark.read.parquet(f"{base}/{reader}")


def test_readers_have_their_own_bookmarks(spark, folder):
    send(folder + "/topic", "one", *[event(i) for i in range(10)])
    assert run(spark, folder, "first").count() == 10
    send(folder + "/topic", "two", *[event(i) for i in range(10, 15)])
    again = run(spark, folder, "first")
    assert {r.PULocationID for r in again.collect()} == set(range(15)) and again.count() == 15
    # nothing new: nothing twice
    assert run(spark, folder, "first").count() == 15
    # a second reader starts from the beginning
    assert run(spark, folder, "second").count() == 15


def test_passthrough_keeps_late_rows(spark, folder):
    send(folder + "/topic", "one", event(1), event(2, 1730429702000 - 12_000))
    got = run(spark, folder, "out")
    assert got.columns == [
        "PULocationID", "DOLocationID", "trip_distance", "total_amount", "pickup_datetime",
    ]
    assert rows(got.select("PULocationID", "pickup_datetime")) == [
        (1, ts("2024-11-01T02:55:02")), (2, ts("2024-11-01T02:54:50")),
    ]


def test_batches_can_be_repeated(spark, folder):
    for i in range(3):
        send(folder + "/topic", f"f{i}", event(i))
    seen = []
    write = jobs.batch_folder_writer(folder + "/out")

    def twice(df, batch_id):
        seen.append(batch_id)
        write(df, batch_id)
        write(df, batch_id)

    stream = typed(spark, folder + "/topic", max_files=1)
    jobs.drain(jobs.to_batches(stream, twice, folder + "/mark", None))
    assert len(seen) == 3
    assert spark.read.parquet(folder + "/out").count() == 3


def test_failures_are_raised(spark, folder):
    send(folder + "/topic", "one", event(1))

    def broken(df, batch_id):
        raise ValueError("no table")

    with pytest.raises(StreamingQueryException, match="no table"):
        jobs.drain(jobs.to_batches(typed(spark, folder + "/topic"), broken, folder + "/mark", None))


def test_interval_trigger_runs_until_stopped(spark, folder):
    send(folder + "/topic", "one", event(1))
    query = jobs.to_files(typed(spark, folder + "/topic"), folder + "/out", folder + "/mark", "1 second")
    query.processAllAvailable()
    assert query.isActive
    query.stop()
    assert spark.read.parquet(folder + "/out").count() == 1


def test_windows_drop_what_is_older_than_the_watermark(spark, folder):
    start = 1_700_000_000_000 // 60_000 * 60_000
    send(folder + "/topic", "a", event(1, start + 1_000), event(1, start + 125_000))
    counted = lambda: jobs.windowed(
        typed(spark, folder + "/topic"), "pickup_datetime", "10 seconds", "1 minute",
        ["PULocationID"], "total_amount",
    )

    def drain():
        jobs.drain(jobs.to_files(counted(), folder + "/out", folder + "/mark", None))
        return spark.read.parquet(folder + "/out")

    assert [r.number_records for r in drain().collect()] == [1]
    # 12 seconds older than the watermark allows: dropped here, kept by the pass-through
    send(folder + "/topic", "b", event(1, start + 3_000), event(1, start + 300_000))
    got = {r.window_start: r.number_records for r in drain().collect()}
    first = dt.datetime.fromtimestamp(start / 1000, dt.timezone.utc).replace(tzinfo=None)
    assert got == {first: 1, first + dt.timedelta(minutes=2): 1}
    assert run(spark, folder, "all").count() == 4


def test_late_flag(spark):
    df = spark.createDataFrame(
        [(ts("2024-01-01T00:00:10"), ts("2024-01-01T00:00:07")), (ts("2024-01-01T00:00:10"),) * 2],
        "arrived timestamp, happened timestamp",
    )
    got = jobs.flag_late(df, "arrived", "happened", 3.0)
    assert [r.is_late for r in got.collect()] == [True, False]


def test_generated_events(spark):
    zones = [4, 7, 9, 23]
    df = make_events(spark, 5000, zones, 1_700_000_000_000, seed=7)
    late = df.withColumn("late", (F.col("sent_ms") - F.col("tpep_pickup_datetime")) / 1000)
    stats = late.agg(
        F.avg((F.col("late") > 0).cast("int")).alias("share"),
        F.min(F.when(F.col("late") > 0, F.col("late"))).alias("low"),
        F.max("late").alias("high"),
        F.min("trip_distance").alias("d0"), F.max("trip_distance").alias("d1"),
        F.count_distinct("PULocationID").alias("zones"),
    ).head()
    assert 0.17 < stats.share < 0.23
    assert (stats.low, stats.high) == (3, 10)
    assert 0.5 <= stats.d0 and stats.d1 <= 20.0
    assert stats.zones == len(zones)
    assert df.filter(~F.col("DOLocationID").isin(zones)).count() == 0
    messages = jobs.as_messages(df, *RIDE_EVENT.fieldNames())
    assert json.loads(messages.head().value).keys() == set(RIDE_EVENT.fieldNames())


def test_topic_options():
    got = topic_options("host:9092", "rides", "earliest", 100)
    assert got["subscribe"] == "rides" and got["startingOffsets"] == "earliest"
    assert got["maxOffsetsPerTrigger"] == "100"
    with pytest.raises(ValueError):
        topic_options("h", "t", "middle")


class RecordingWriter:
    """Stands in for a frame: this container has no database that all processes can see."""

    def __init__(self):
        self.calls = {}

    def withColumn(self, name, value):
        self.calls["column"] = name
        return self

    @property
    def write(self):
        return self

    def format(self, name):
        self.calls["format"] = name
        return self

    def mode(self, name):
        self.calls["mode"] = name
        return self

    def options(self, **options):
        self.calls["options"] = options
        return self

    def save(self):
        self.calls["saved"] = True


def test_jdbc_writer_options(spark):
    frame = RecordingWriter()
    jobs.jdbc_writer({"url": "jdbc:x"}, "processed_events")(frame, 4)
    assert frame.calls == {
        "column": "batch_id", "format": "jdbc", "mode": "append", "saved": True,
        "options": {"url": "jdbc:x", "dbtable": "processed_events"},
    }


def test_console_writer(spark, folder):
    send(folder + "/topic", "one", event(1))
    writer = jobs.to_console(typed(spark, folder + "/topic"), 5)
    query = writer.trigger(availableNow=True).start()
    jobs.drain(query)
