"""Late rows: state in a stream, ranges in batch, and windows that drop what is too old."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from faremill.functions.events import parse_event
from faremill.sources.topics import file_stream
from faremill.streaming import jobs
from faremill.streaming.late import STATE_STORE, mark_late, mark_late_in_stream, split_late
from tests.conftest import final_plan, rows, ts

EVENT = "n long, who string, at timestamp, note int"
HOUR = dt.timedelta(hours=1)


@pytest.fixture
def state_store(spark):
    before = {k: spark.conf.get(k, None) for k in STATE_STORE}
    for name, value in STATE_STORE.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value) if value is not None else spark.conf.unset(name)


def events(spark, n, seed=1):
    """Random lateness; a third of all rows share a key; some have no key, time or note."""
    rng = random.Random(seed)
    start = ts("2024-01-01T00:00:00")
    data = []
    for i in range(n):
        who = "hot" if i % 3 == 0 else rng.choice(["a", "b", "c", None])
        at = start + dt.timedelta(minutes=i * 7 - rng.choice([0, 0, 0, 50, 200]), milliseconds=i)
        data.append((i, who, None if rng.random() < 0.1 else at, rng.choice([None, 1 << 30, 5])))
    return data, spark.createDataFrame(data, EVENT)


def expected(data):
    newest, out = {}, []
    for n, who, at, note in data:
        if at is not None:
            newest[who] = max(newest.get(who, at), at)
        out.append((n, who, at, note, at is not None and at < newest[who] - HOUR))
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_on_a_table(spark, folder):
    data, df = events(spark, 900)
    got = mark_late(df.repartition(5), "who", "n", "at", HOUR, pieces=7)
    assert rows(got) == expected(data)
    assert any(r[-1] for r in expected(data))
    in_time, late = split_late(got)
    assert in_time.count() + late.count() == 900 and in_time.columns == df.columns
    assert mark_late(df.limit(0), "who", "n", "at", HOUR).count() == 0
    assert "SortMergeJoin" not in final_plan(got)


def test_in_a_stream_over_several_runs(spark, folder, state_store):
    """The state is carried from batch to batch, and over restarts, by the checkpoint."""
    data, df = events(spark, 400, seed=2)
    for run, edges in enumerate(((0, 90, 150), (150, 151, 300), (300, 400))):
        for low, high in zip(edges, edges[1:]):
            part = df.filter((F.col("n") >= low) & (F.col("n") < high)).coalesce(1)
            jobs.as_messages(part).write.mode("append").text(folder + "/topic")
        messages = file_stream(spark, folder + "/topic", max_files=1)
        stream = messages.select(parse_event("value", df.schema).alias("e")).select("e.*")
        marked = mark_late_in_stream(stream, "who", "n", "at", HOUR)
        jobs.drain(jobs.to_files(marked, folder + "/out", folder + "/mark", None))
    assert rows(spark.read.parquet(folder + "/out")) == expected(data)


def test_a_batch_may_arrive_in_any_order(spark, folder, state_store):
    """Rows of one batch are taken by their number, in whatever order the files hold them."""
    data, df = events(spark, 120, seed=3)
    jobs.as_messages(df.orderBy(F.col("n").desc())).write.text(folder + "/topic")
    messages = file_stream(spark, folder + "/topic")
    stream = messages.select(parse_event("value", df.schema).alias("e")).select("e.*")
    marked = mark_late_in_stream(stream, "who", "n", "at", HOUR)
    jobs.drain(jobs.to_files(marked, folder + "/out", folder + "/mark", None))
    assert rows(spark.read.parquet(folder + "/out")) == expected(data)


def test_the_watermark_moves_between_bounded_batches(spark, folder):
    """A late row is dropped by the mark of earlier batches; one batch would have kept it."""
    start = ts("2024-01-01T00:00:00")

    def land(*minutes):
        df = spark.createDataFrame(
            [(i, "k", start + dt.timedelta(minutes=m), 1) for i, m in enumerate(minutes)], EVENT
        )
        jobs.as_messages(df.coalesce(1)).write.mode("append").text(folder + "/topic")

    def drain(out, max_files):
        messages = file_stream(spark, folder + "/topic", max_files=max_files)
        stream = messages.select(parse_event("value", df.schema).alias("e")).select("e.*")
        closed = jobs.windowed(stream, "at", "10 seconds", "1 hour", ["who"], "note")
        jobs.drain(jobs.to_files(closed, f"{folder}/{out}", f"{folder}/{out}-mark", None))
        found = spark.read.parquet(f"{folder}/{out}").collect()
        return {(r.window_start - start).seconds // 3600: r.number_records for r in found}

    df = spark.createDataFrame([], EVENT)
    land(5, 10, 70)
    land(130)
    land(15, 200)
    land(20, 400)
    assert drain("bounded", 1) == {0: 2, 1: 1, 2: 1, 3: 1}
    assert drain("whole", 10) == {0: 4, 1: 1, 2: 1, 3: 1}
