from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faremill.operators import quality as q
from tests.conftest import plan, rows, ts


def table(spark):
    return spark.createDataFrame(
        [(1, "a", 5.0), (2, "b", -1.0), (2, "c", 0.0), (None, None, None)],
        "id int, v string, x double",
    )


def verdicts(df) -> dict:
    return {(r.check_name, r.column_name): (r.failed_rows, r.passed) for r in df.collect()}


def test_every_check(spark):
    parent = spark.createDataFrame([(1,)], "pk int")
    got = verdicts(
        q.run_checks(
            table(spark), "t",
            [
                *q.primary_key("id"),
                q.accepted_values("v", ["a", "b"]),
                q.positive("x"),
                q.non_negative("x"),
                q.unique_combination("id", "v"),
                q.relationships("id", parent, "pk"),
                q.custom("no_big_x", F.col("x") > 100),
                q.expect_no_rows("no_zero", lambda df: df.filter("x = 0")),
                q.expect_value("four_rows", lambda df: df.agg(F.count("*").alias("n")), 4),
                q.expect_value("no_answer", lambda df: df.agg(F.max(F.lit(None).cast("int")))),
            ],
        )
    )
    assert got == {
        ("not_null", "id"): (1, False),
        ("unique", "id"): (1, False),
        ("accepted_values", "v"): (1, False),
        ("positive", "x"): (2, False),
        ("non_negative", "x"): (1, False),
        ("unique_combination", "id+v"): (0, True),
        ("relationships", "id"): (2, False),
        ("no_big_x", ""): (0, True),
        ("no_zero", ""): (1, False),
        ("four_rows", ""): (0, True),
        ("no_answer", ""): (1, False),
    }


def test_accepted_values_options(spark):
    df = table(spark)
    check = lambda **o: verdicts(
        q.run_checks(df, "t", [q.accepted_values("v", ["a"], **o)])
    )[("accepted_values", "v")][0]
    assert check() == 2
    assert check(nulls="fail") == 3
    assert check(where=F.col("x") < 0) == 1
    # a NULL scope is out of scope
    assert check(where=F.col("x") <= 5, nulls="fail") == 2


def test_row_checks_share_one_scan(spark, folder):
    table(spark).write.parquet(folder + "/t")
    stored = spark.read.parquet(folder + "/t")
    checks = [q.not_null("id"), q.positive("x"), q.accepted_values("v", ["a"])]
    assert plan(q.run_checks(stored, "t", checks)).count("FileScan") == 1


def test_freshness(spark):
    df = spark.createDataFrame([(ts("2024-01-01T00:00:00"),)], "t timestamp")

    def status(as_of):
        return q.freshness(df, "t", "t", as_of).head().status

    assert status(dt.datetime(2024, 1, 2)) == "pass"
    assert status(dt.datetime(2024, 1, 2, 0, 0, 1)) == "warn"
    assert status(dt.datetime(2024, 1, 3)) == "warn"
    assert status(dt.datetime(2024, 1, 3, 0, 0, 1)) == "error"
    assert q.freshness(df.limit(0), "t", "t", dt.datetime(2024, 1, 1)).head().status == "error"


def test_contract(spark):
    declared = T.StructType.fromDDL("v string, id int, x double")
    assert q.contract(table(spark), declared) == []
    assert q.enforce(table(spark), declared).columns == ["v", "id", "x"]
    wrong = T.StructType.fromDDL("id bigint, v string, y int")
    with pytest.raises(q.CheckFailed) as error:
        q.enforce(table(spark), wrong)
    for part in ("missing column y", "undeclared column x", "id is int, declared bigint"):
        assert part in str(error.value)


def test_reconcile_empty_report(spark):
    detail = spark.createDataFrame([(1.25,), (2.25,)], "total_amount double")
    report = spark.createDataFrame([], "trip_count bigint, total_amount double")
    got = q.reconcile(detail, report, "trip_count", "total_amount", "total_amount").head()
    assert tuple(got) == (2, 3.5)
    got = q.reconcile(detail.limit(0), report, "trip_count", "total_amount", "total_amount").head()
    assert tuple(got) == (0, 0.0)


def test_sanity_report_shape(spark):
    clean = spark.createDataFrame(
        [
            ("a", "green", ts("2024-01-01T00:00:00"), ts("2024-01-01T01:00:00"), 1.0, 2.0, 3.0),
            ("a", "green", ts("2024-01-01T02:00:00"), ts("2024-01-01T01:00:00"), -1.0, 2.0, 4.0),
        ],
        "trip_id string, taxi_type string, pickup_datetime timestamp, "
        "dropoff_datetime timestamp, trip_distance double, fare_amount double, total_amount double",
    )
    report = spark.createDataFrame(
        [("green", dt.date(2024, 1, 1), 2, 7.0)],
        "taxi_type string, pickup_date date, trip_count bigint, total_amount double",
    )
    got = {r.check_name: r.actual_value for r in q.sanity_report(clean, clean, report).collect()}
    assert len(got) == 14
    assert got["staging.trips duplicate trip_id count (expect 0)"] == 1
    assert got["staging.trips dropoff before pickup count (expect 0)"] == 1
    assert got["staging.trips negative trip_distance count (expect 0)"] == 1
    assert got["staging vs reports total_amount diff (expect ~0)"] == 0
    assert list(got) == sorted(got)


def test_layers_stop_at_the_first_failure(spark):
    built = []

    def layer(name, ids):
        def build():
            built.append(name)
            return spark.createDataFrame([(i,) for i in ids], "id int")

        return (name, build, lambda df: q.primary_key("id"))

    frames, verdict = q.run_layer([layer("one", [1, 2]), layer("two", [3])])
    assert set(frames) == {"one", "two"} and verdict.filter("passed").count() == 4
    built.clear()
    with pytest.raises(q.CheckFailed, match=r"two: unique\(id\) 1 failed"):
        q.run_layer([layer("one", [1]), layer("two", [3, 3]), layer("three", [4])])
    assert built == ["one", "two"]
    assert rows(frames["one"]) == [(1,), (2,)]
