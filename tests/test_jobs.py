"""The command-line jobs, end to end on small landed files."""

from __future__ import annotations

import glob

from pyspark.sql import functions as F

from faremill import jobs
from faremill.operators import incremental as inc
from faremill.operators.shape import in_years
from faremill.plans.stand_ins import green_source, yellow_source, zone_source
from tests.conftest import rows


def land(spark, sf_dir, folder):
    green_source(spark, sf_dir).write.parquet(folder + "/green")
    yellow = yellow_source(spark, sf_dir)
    # the marts' relationship checks want known zones
    known = yellow.withColumn("PULocationID", F.col("PULocationID") % 25)
    known = known.withColumn("DOLocationID", F.col("DOLocationID") % 25)
    known.write.parquet(folder + "/yellow")
    zone_source(spark, sf_dir).coalesce(1).write.option("header", True).csv(folder + "/zones")
    return [f"--green={folder}/green", f"--yellow={folder}/yellow"]


def test_monthly_report(spark, sf_dir, folder):
    sources = land(spark, sf_dir, folder)
    jobs.main(["monthly-report", *sources, f"--output={folder}/report"], spark)
    assert len(glob.glob(folder + "/report/*.parquet")) >= 1
    jobs.main(["monthly-report", *sources, f"--output={folder}/report", "--files=3"], spark)
    assert len(glob.glob(folder + "/report/*.parquet")) == 3
    report = spark.read.parquet(folder + "/report")
    assert report.agg(F.sum("revenue_monthly_total_amount")).head()[0] > 0


def test_hourly_report(spark, sf_dir, folder):
    sources = land(spark, sf_dir, folder)
    jobs.main(
        ["hourly-report", *sources, f"--zones={folder}/zones", f"--output={folder}/h",
         "--since=1999-01-01 00:00:00"],
        spark,
    )
    zones = spark.read.parquet(folder + "/h/zones")
    assert {"Borough", "Zone", "green_amount", "yellow_amount"} <= set(zones.columns)
    assert zones.count() == spark.read.parquet(folder + "/h/total").count() > 0


def test_convert_months(spark, sf_dir, folder):
    green_source(spark, sf_dir).write.option("header", True).csv(folder + "/csv")
    jobs.main(
        ["convert-months", "--service=green", f"--csv={folder}/csv", f"--output={folder}/pq"], spark
    )
    back = spark.read.parquet(folder + "/pq")
    assert back.count() == green_source(spark, sf_dir).count()
    assert back.filter("year <> year(lpep_pickup_datetime)").count() == 0


def test_convert_months_past_bad_lines(spark, sf_dir, folder):
    green_source(spark, sf_dir).write.option("header", True).csv(folder + "/csv")
    spark.createDataFrame([("not,a,trip",)], "l string").coalesce(1).write.mode("append").text(folder + "/csv")
    call = ["convert-months", "--service=green", f"--csv={folder}/csv", f"--output={folder}/pq"]
    jobs.main([*call, f"--bad={folder}/bad"], spark)
    assert spark.read.parquet(folder + "/pq").count() == green_source(spark, sf_dir).count()
    assert [r.line for r in spark.read.parquet(folder + "/bad").collect()] == ["not,a,trip"]


def test_a_late_service_loses_no_trips(spark, sf_dir, folder):
    """Yellow trips that come a run later than green ones of the same days are still taken."""
    land(spark, sf_dir, folder)
    green = spark.read.parquet(folder + "/green").withColumn("DOLocationID", F.col("DOLocationID") % 25)
    yellow = spark.read.parquet(folder + "/yellow")
    time, year = "tpep_pickup_datetime", in_years("tpep_pickup_datetime", [1996])
    green.filter(in_years("lpep_pickup_datetime", [1996])).write.parquet(folder + "/g")
    yellow.filter(year & (F.col(time) < "1996-02-01")).write.parquet(folder + "/y1")
    yellow.filter(year).write.parquet(folder + "/y2")
    for out, runs in (("twice", ("y1", "y2")), ("once", ("y2",))):
        for y in runs:
            jobs.main(
                ["build-marts", f"--green={folder}/g", f"--yellow={folder}/{y}",
                 f"--zones={folder}/zones", "--years=1996", f"--output={folder}/{out}"],
                spark,
            )
    twice, once = (inc.read_target(spark, f"{folder}/{o}/fact_trips") for o in ("twice", "once"))
    assert rows(twice.select("trip_id")) == rows(once.select("trip_id"))
    assert twice.filter("service_type = 'Yellow'").count() > 0


def test_build_marts_twice(spark, sf_dir, folder):
    """A second run with later trips adds them; nothing is rebuilt or repeated."""
    land(spark, sf_dir, folder)
    green = spark.read.parquet(folder + "/green").withColumn("DOLocationID", F.col("DOLocationID") % 25)
    yellow = spark.read.parquet(folder + "/yellow")
    green.filter(in_years("lpep_pickup_datetime", [1996])).write.parquet(folder + "/g1")
    green.write.parquet(folder + "/g2")
    yellow.filter(in_years("tpep_pickup_datetime", [1996])).write.parquet(folder + "/y1")
    common = [f"--zones={folder}/zones", "--years=1996,1997"]
    for n, y in (("1", "y1"), ("2", "yellow")):
        jobs.main(
            ["build-marts", f"--green={folder}/g{n}", f"--yellow={folder}/{y}",
             f"--output={folder}/marts", *common],
            spark,
        )
    jobs.main(
        ["build-marts", f"--green={folder}/g2", f"--yellow={folder}/yellow",
         f"--output={folder}/whole", *common],
        spark,
    )
    twice = inc.read_target(spark, folder + "/marts/fact_trips")
    whole = inc.read_target(spark, folder + "/whole/fact_trips")
    assert twice.count() == whole.count() > 0
    assert rows(twice.select("trip_id")) == rows(whole.select("trip_id"))
    assert yellow.count() > 0


def test_refresh_interval(spark, sf_dir, folder):
    for service, source, time in (
        ("green", green_source, "lpep_pickup_datetime"), ("yellow", yellow_source, "tpep_pickup_datetime"),
    ):
        # the files hold zone-less times, as published
        trips = source(spark, sf_dir).withColumn(time, F.col(time).cast("timestamp_ntz"))
        for month in ("1998-03", "1998-04"):
            trips.filter(F.date_format(time, "yyyy-MM") == month).write.parquet(
                f"{folder}/in/{service}_tripdata_{month}.parquet"
            )
    call = [
        "refresh-interval", f"--base={folder}/in", f"--output={folder}/out", "--start=1998-03-10",
        "--end=1998-04-05",
    ]
    counts = []
    for day in ("1998-05-01", "1998-05-02"):
        jobs.main([*call, f"--extracted_at={day}T00:00:00"], spark)
        staged = inc.read_target(spark, folder + "/out/staging")
        report = inc.read_target(spark, folder + "/out/report")
        assert report.agg(F.sum("trip_count")).head()[0] == staged.count()
        counts.append(staged.count())
    # ingested twice, staged once
    assert counts[0] == counts[1] > 0
    assert spark.read.parquet(folder + "/out/ingested").count() > 2 * counts[0]
