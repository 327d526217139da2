from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from faremill.operators import shape as s
from faremill.sources.tables import load
from tests.conftest import plan, rows, ts


def test_common_columns(spark):
    a = spark.createDataFrame([(1, 2, 3)], "a int, B int, c int")
    b = spark.createDataFrame([(1, 2, 3)], "b int, a int, d int")
    assert s.common_columns(a, b) == ["a", "B"]


def test_align_and_union(spark):
    green = spark.createDataFrame([(1, 2, 0.5)], "v int, trip_type int, fee double")
    yellow = s.align(
        spark.createDataFrame([(7, "x")], "v int, other string"),
        {"trip_type": (1, "int"), "fee": (None, "double"), "V": (9, "int")},
    )
    both = s.union_services({"Green": green, "Yellow": yellow})
    assert both.columns == ["v", "trip_type", "fee", "service_type"]
    assert rows(both) == [(1, 2, 0.5, "Green"), (7, 1, None, "Yellow")]


def test_drop_is_exact(spark):
    df = spark.createDataFrame([(1, "Z")], "LocationID int, zone string").withColumnRenamed(
        "zone", "Zone"
    )
    assert s.drop_columns(df, ["zone", "LocationID"]).columns == ["Zone"]


TIMES = [
    ("2023-12-31T23:59:59",), ("2024-01-01T00:00:00",), ("2024-01-02T23:59:59",),
    ("2024-01-03T00:00:00",),
]


def times(spark):
    return spark.createDataFrame([(ts(t),) for (t,) in TIMES] + [(None,)], "t timestamp")


def test_windows(spark):
    df = times(spark)
    assert df.filter(s.in_interval("t", dt.date(2024, 1, 1), dt.date(2024, 1, 3))).count() == 2
    assert df.filter(s.between_dates("t", "2024-01-01", "2024-01-02")).count() == 2
    assert df.filter(s.on_day("t", dt.date(2024, 1, 3))).count() == 1
    assert df.filter(s.in_years("t", [2024])).count() == 3
    assert df.filter(s.in_years("t", [2023, 2024])).count() == 4
    assert df.filter(s.in_years("t", [2019, 2023])).count() == 1
    assert s.sample_window(df, "t", None).count() == 5
    assert s.sample_window(df, "t", ("2024-01-01", "2024-01-02")).count() == 1


def test_years_reach_the_scan(spark, sf_dir):
    orders = load(spark, sf_dir, "orders").filter(s.in_years("o_orderdate", [1996, 1997]))
    pushed = plan(orders.select("o_orderkey"))
    assert "GreaterThanOrEqual(o_orderdate,1996-01-01" in pushed
    assert "LessThan(o_orderdate,1998-01-01" in pushed
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in pushed


def test_null_filters(spark):
    df = spark.createDataFrame([(1, None), (None, 2), (1, 2)], "a int, b int")
    assert s.where_present(df, "a", "b").count() == 1
    assert s.where_any_null(df, "a", "b").count() == 2


def test_cast_as(spark):
    df = spark.createDataFrame([("1", "x")], "a string, b string")
    got = s.cast_as(df, {"a": "int", "b": "int"}, {"b"})
    assert rows(got) == [(1, None)]


def test_unpivot_and_side(spark):
    df = spark.createDataFrame([(2024, 3, 1)], "season int, scored int, conceded int")
    long = s.unpivot(df, ["season"], ["scored", "conceded"], "metric", "goals")
    assert rows(long) == [(2024, "conceded", 1), (2024, "scored", 3)]
    picked = df.select(s.by_side(F.col("season") == 2024, "scored", "conceded"))
    assert picked.head()[0] == 3
