"""Reports from parts: equal to the report over all rows, whatever came in and how often."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from faremill import jobs
from faremill.operators import incremental as inc
from faremill.operators import partials as p
from faremill.operators.aggregate import daily_report
from faremill.plans import trips as t
from tests.conftest import rows, ts
from tests.test_jobs import land

TRIP = "service string, at timestamp, fare_amount double, total_amount double, trip_distance double"


def report():
    return p.daily_service_report("service", "at")


def trips(spark, n, start=0):
    data = []
    for i in range(start, start + n):
        at = ts("2024-01-28T00:00:00") + dt.timedelta(hours=5 * i)
        fare = None if i % 7 == 0 else i * 0.1
        data.append((["a", "b", None][i % 3], at, fare, i * 1.07, None if i % 5 == 0 else i / 8))
    return spark.createDataFrame(data, TRIP)


def full(df):
    return rows(daily_report(df, "service", "at").select(report().columns))


def current(spark, path):
    return rows(p.current_report(spark, report(), path).select(report().columns))


def test_increments_add_up(spark, folder):
    path, every = folder + "/parts", trips(spark, 60)
    p.add_increment(report(), trips(spark, 25), path, "one")
    p.add_increment(report(), trips(spark, 35, 25), path, "two")
    assert current(spark, path) == full(every)
    # an increment that comes again replaces itself
    p.add_increment(report(), trips(spark, 35, 25), path, "two")
    assert current(spark, path) == full(every)


def test_only_the_months_of_an_increment_are_written(spark, folder):
    path, target = folder + "/parts", folder + "/report"

    def files():
        return {n: sorted(os.listdir(f"{target}/{n}")) for n in os.listdir(target) if "=" in n}

    months = p.add_increment(report(), trips(spark, 30), path, "one")
    assert months and len(months) == 2
    got = p.refresh_report(spark, report(), path, target, months)
    assert rows(got) == full(trips(spark, 30))
    before = files()
    months = p.add_increment(report(), trips(spark, 4, 30), path, "two")
    assert months == [dt.date(2024, 2, 1)]
    got = p.refresh_report(spark, report(), path, target, months)
    assert rows(got) == full(trips(spark, 34))
    assert {n for n, f in files().items() if before[n] != f} == {"_month=2024-02-01"}


def test_a_repeated_increment_may_lose_a_month(spark, folder):
    path, target = folder + "/parts", folder + "/report"
    months = p.add_increment(report(), trips(spark, 30), path, "one")
    p.refresh_report(spark, report(), path, target, months)
    months = p.add_increment(report(), trips(spark, 3), path, "one")
    got = p.refresh_report(spark, report(), path, target, months)
    assert rows(got) == full(trips(spark, 3))
    months = p.add_increment(report(), trips(spark, 0), path, "one")
    assert rows(p.refresh_report(spark, report(), path, target, months)) == []
    assert current(spark, path) == []


def test_the_report_reads_no_trips(spark, folder):
    every = trips(spark, 60)
    every.write.parquet(folder + "/trips")
    stored = spark.read.parquet(folder + "/trips")
    path = folder + "/parts"
    p.add_increment(report(), stored.filter("at < '2024-02-05'"), path, "one")
    p.add_increment(report(), stored.filter("at >= '2024-02-05'"), path, "two")
    read = p.current_report(spark, report(), path).inputFiles()
    assert read and all("/parts/" in f for f in read)


def test_what_a_failed_increment_left_is_not_counted(spark, folder):
    path = folder + "/parts"
    p.add_increment(report(), trips(spark, 20), path, "one")
    p.add_increment(report(), trips(spark, 20, 20), path, "two")
    os.remove(f"{path}/_increment=two/_SUCCESS")
    assert current(spark, path) == full(trips(spark, 20))
    p.add_increment(report(), trips(spark, 20, 20), path, "two")
    assert current(spark, path) == full(trips(spark, 40))


def test_names_are_folders(spark, folder):
    for name in ("", "a/b", "a=b"):
        with pytest.raises(ValueError):
            p.add_increment(report(), trips(spark, 1), folder, name)


def test_the_marts_job_keeps_parts(spark, sf_dir, folder):
    """Two runs give the mart of one; the second one's parts come from its own trips."""
    land(spark, sf_dir, folder)
    for name, time in (("green", "lpep_pickup_datetime"), ("yellow", "tpep_pickup_datetime")):
        df = spark.read.parquet(f"{folder}/{name}")
        df = df.withColumn("DOLocationID", F.col("DOLocationID") % 25)
        df.filter(F.col(time) < "1996-09-15").write.parquet(f"{folder}/{name}-1")
        df.write.parquet(f"{folder}/{name}-2")

    def build(n, out):
        jobs.main(
            ["build-marts", f"--green={folder}/green-{n}", f"--yellow={folder}/yellow-{n}",
             f"--zones={folder}/zones", "--years=1996,1997", f"--output={folder}/{out}"],
            spark,
        )

    for n in (1, 2, 2):
        build(n, "marts")
    # the third run finds nothing new, and its increment has no parts
    assert len(p.increments(spark, folder + "/marts/monthly_zone_parts")) == 3
    got = spark.read.parquet(folder + "/marts/monthly_zone_revenue")
    want = t.monthly_zone_mart(inc.read_target(spark, folder + "/marts/fact_trips"))
    assert rows(got.select(want.columns)) == rows(want) and got.count() > 0
