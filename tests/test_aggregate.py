from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from faremill.functions.numbers import total
from faremill.operators import aggregate as a
from tests.conftest import plan, rows, ts


def trips(spark):
    return spark.createDataFrame(
        [
            ("Green", "A", ts("2024-01-31T23:00:00"), 10.0, 1, 2.0, "t1"),
            ("Green", None, ts("2024-01-01T00:30:00"), 5.0, 2, 4.0, "t2"),
            ("Green", "Unknown Zone", ts("2024-01-02T00:00:00"), 1.0, None, None, None),
            ("Yellow", "A", ts("2024-02-01T00:00:00"), 7.0, 3, 1.0, "t4"),
        ],
        "service_type string, zone string, t timestamp, fare_amount double, "
        "passenger_count int, trip_distance double, trip_id string",
    )


def test_monthly_revenue_merges_null_and_named_unknown(spark):
    got = a.monthly_revenue(
        trips(spark), "zone", "t", ["fare_amount"], unknown="Unknown Zone", trip_key="trip_id"
    )
    jan, feb = dt.date(2024, 1, 1), dt.date(2024, 2, 1)
    assert rows(got) == [
        ("A", jan, "Green", 10.0, 1, 1.0, 2.0),
        ("A", feb, "Yellow", 7.0, 1, 3.0, 1.0),
        ("Unknown Zone", jan, "Green", 6.0, 1, 2.0, 4.0),
    ]
    assert got.columns == [
        "revenue_zone", "revenue_month", "service_type", "revenue_monthly_fare",
        "total_monthly_trips", "avg_monthly_passenger_count", "avg_monthly_trip_distance",
    ]


def test_monthly_revenue_is_one_shuffle(spark):
    got = a.monthly_revenue(trips(spark), "zone", "t", ["fare_amount"])
    assert plan(got).count("Exchange") == 1
    assert "partial_sum" in plan(got)


def test_hourly_and_daily(spark):
    df = trips(spark)
    hours = a.hourly_revenue(df, "t", "zone", "fare_amount")
    assert (ts("2024-01-01T00:00:00"), None, 5.0, 1) in rows(hours)
    days = a.daily_report(
        df.withColumn("total_amount", F.col("fare_amount")), "service_type", "t"
    )
    assert ("Green", dt.date(2024, 1, 2), 1, 1.0, 1.0, None) in rows(days)
    trend = a.daily_trend(df, "t", "fare_amount").collect()
    assert [r.trip_date.day for r in trend] == [1, 2, 31, 1]


def test_buckets_need_positive_rows(spark):
    df = spark.createDataFrame(
        [(0.5, 10.0), (0.9, 20.0), (1.0, 5.0), (0.0, 9.0), (2.0, -1.0), (None, 1.0)],
        "d double, fare double",
    )
    assert rows(a.bucket_average(df, "d", "fare", "b")) == [(0, 15.0, 2), (1, 5.0, 1)]


def test_counts(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "k int, v string")
    assert rows(a.row_count(df)) == [(3,)]
    assert rows(a.count_by(df, "k")) == [(1, 2), (2, 1)]
    assert rows(a.distinct_count(df, "v", "n")) == [(1,)]
    assert rows(a.duplicate_keys(df, "k", "v")) == [(1, "x", 2)]


def test_top_and_least(spark):
    df = spark.createDataFrame(
        [("a", 1), ("a", 2), ("b", 3), ("c", 3), ("c", 0)], "k string, v int"
    )
    assert rows(a.top_group(df, "k", total("v"), "s")) == [("a", 3.0)]
    assert rows(a.least_frequent(df, "k")) == [("b", 1)]
    tied = df.filter("k <> 'a'").limit(2)
    assert rows(a.least_frequent(df.filter("v = 3"), "k")) == [("b", 1), ("c", 1)]
    assert tied.count() == 2
    top = a.top_n(df, F.col("v") * 10, "ten", 2, "k")
    assert rows(top) == [("b", 3, 30), ("c", 3, 30)]
    assert "TakeOrderedAndProject" in plan(top)


def test_rollup_of_nothing_is_zero(spark):
    report = spark.createDataFrame([("Green", 3)], "s string, n bigint")
    assert a.rollup_report(report, F.col("s") == "Red", "n", "trips").head()[0] == 0
    assert a.rollup_report(report, F.col("s") == "Green", "n", "trips").head()[0] == 3


def test_whole_day_predicate_counts(spark):
    assert rows(a.count_by(trips(spark), F.to_date("t").alias("d")))[0][1] == 1
