from __future__ import annotations

import datetime as dt
import hashlib
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.errors import ArithmeticException, NumberFormatException
from pyspark.sql import functions as F

from faremill import functions as fn
from faremill.functions.codes import PAYMENT_NAMES, label
from faremill.functions.numbers import average, pct
from faremill.functions.times import plus_seconds
from faremill.sources.topics import RIDE_EVENT
from tests.conftest import plan, ts


CODES = [("B02884",), ("B00003",), ("B00001",), ("",), (None,), ("B",), ("Bx1",), ("B99999",)]


def test_base_code(spark):
    df = spark.createDataFrame(CODES, "b string")
    got = {r.b: r.x for r in df.select("b", fn.base_code("b").alias("x")).collect()}
    assert got["B02884"] == "s/b44"
    assert got["B00003"] == "a/003"
    assert got["B00001"] == "e/001"
    assert got["B99999"] == "a/1869f"
    assert got[""] is got[None] is got["B"] is got["Bx1"] is None


def test_base_code_equals_a_python_version_and_stays_in_the_jvm(spark):
    @F.pandas_udf("string")
    def python_version(s: pd.Series) -> pd.Series:
        def one(b):
            n = int(b[1:])
            return f"{'s' if n % 7 == 0 else 'a' if n % 3 == 0 else 'e'}/{n:03x}"

        return s.map(one)

    df = spark.range(0, 100000, 7).select(F.format_string("B%05d", "id").alias("b"))
    assert df.filter(fn.base_code("b") != python_version("b")).count() == 0
    assert "Python" not in plan(df.select(fn.base_code("b")))


def test_minutes_count_boundaries(spark):
    df = spark.createDataFrame(
        [
            (ts("2024-01-01T00:00:50"), ts("2024-01-01T00:01:10")),
            (ts("2024-01-01T00:00:10"), ts("2024-01-01T00:00:50")),
            (ts("2024-01-01T00:01:10"), ts("2024-01-01T00:00:50")),
            (ts("2024-01-01T00:00:00"), None),
        ],
        "a timestamp, b timestamp",
    )
    assert [r[0] for r in df.select(fn.minutes_between("a", "b")).collect()] == [1, 0, -1, None]


def test_hours(spark):
    df = spark.createDataFrame(
        [(ts("2024-01-01T00:00:00"), ts("2024-01-04T18:36:00"))], "a timestamp, b timestamp"
    )
    assert df.select(fn.hours_between("a", "b")).head()[0] == 90.6


def test_epoch_and_event(spark):
    text = (
        '{"PULocationID":186,"DOLocationID":79,"trip_distance":1.72,"total_amount":17.31,'
        '"tpep_pickup_datetime":1730429702000}'
    )
    df = spark.createDataFrame([(text,)], "value string")
    event = df.select(fn.parse_event("value", RIDE_EVENT).alias("e")).select("e.*")
    assert event.select(fn.to_event(*event.columns)).head()[0] == text
    at = event.select(fn.from_epoch_ms("tpep_pickup_datetime").alias("t"))
    assert at.select(F.date_format("t", "yyyy-MM-dd HH:mm:ss")).head()[0] == "2024-11-01 02:55:02"
    assert at.select(fn.to_epoch_ms("t")).head()[0] == 1730429702000


def test_unreadable_event_gives_nulls(spark):
    df = spark.createDataFrame([("not json",)], "value string")
    event = df.select(fn.parse_event("value", RIDE_EVENT).alias("e")).select("e.*").head()
    assert set(event.asDict().values()) == {None}


def test_keys(spark):
    df = spark.createDataFrame([(1, "a", None), (11, "1", "x")], "i int, s string, n string")
    got = df.select(
        fn.surrogate_key("i", "s", "n").alias("k"), fn.row_id("i", "s", "n").alias("r")
    ).collect()
    assert got[0].k == hashlib.md5(b"1-a-_null_").hexdigest()
    assert got[0].r is None
    assert got[1].r == hashlib.md5(b"111x").hexdigest()


def test_row_id_can_collide_and_surrogate_key_does_not(spark):
    df = spark.createDataFrame([("1", "11"), ("11", "1")], "a string, b string")
    a, b = df.select(fn.row_id("a", "b").alias("r"), fn.surrogate_key("a", "b").alias("k")).collect()
    assert a.r == b.r and a.k != b.k


def test_labels(spark):
    df = spark.createDataFrame([(1,), (3,), (9,), (None,)], "v int")
    assert [r[0] for r in df.select(fn.vendor_label("v")).collect()] == [
        "Creative Mobile Technologies, LLC", None, None, None,
    ]
    assert [r[0] for r in df.select(fn.payment_label("v")).collect()] == [
        "Credit card", "No charge", "Unknown", "Unknown",
    ]
    assert df.select(label("v", PAYMENT_NAMES)).head()[0] == "credit_card"


def test_safe_cast(spark):
    df = spark.createDataFrame([("12",), ("abc",), (None,)], "t string")
    assert [r[0] for r in df.select(fn.safe_cast("t", "int")).collect()] == [12, None, None]
    with pytest.raises(NumberFormatException):
        df.select(F.col("t").cast("int")).collect()


def test_json_field(spark):
    df = spark.createDataFrame([('{"@id":"u1","result":"win"}',)], "j string")
    got = df.select(fn.json_field("j", "@id"), fn.json_field("j", "none")).head()
    assert tuple(got) == ("u1", None)


def test_pct_and_averages(spark):
    df = spark.createDataFrame([(1, 3, None), (0, 0, None)], "part int, whole int, v double")
    assert [r[0] for r in df.select(pct(F.col("part"), F.col("whole"))).collect()] == [33.33, None]
    got = df.agg(average("v"), fn.total("v"), fn.total_or_zero("v")).head()
    assert tuple(got) == (None, None, 0.0)


def test_total_does_not_depend_on_order(spark):
    df = spark.range(1000).select((F.col("id") * 0.1).cast("decimal(18,2)").cast("double").alias("v"))
    sums = {
        df.repartition(n).agg(fn.total("v").alias("s")).head().s for n in (1, 3, 7)
    }
    assert sums == {49950.0}


def test_dates(spark):
    df = spark.createDataFrame([(ts("2024-02-29T23:59:59"),)], "t timestamp")
    got = df.select(
        fn.month_date("t"), fn.to_day("t"), fn.trunc_ts("t", "hour"), fn.naive("t"),
        plus_seconds("t", F.lit(1)),
    ).head()
    assert got[0] == dt.date(2024, 2, 1)
    assert got[1] == dt.date(2024, 2, 29)
    assert got[2] == ts("2024-02-29T23:00:00")
    assert got[3] == ts("2024-02-29T23:59:59")
    assert got[4] == ts("2024-03-01T00:00:00")


def test_totals_keep_what_is_stored(spark):
    small = spark.range(1000).select(F.lit(0.004).alias("v"))
    assert small.agg(fn.total("v"), average("v")).head()[0:2] == (4.0, 0.004)
    mixed = spark.createDataFrame([(1e15 + 0.5,), (-0.125,), (2.000000001,), (None,)], "v double")
    assert mixed.agg(fn.numbers.exact_sum("v")).head()[0] == Decimal("1000000000000002.375000001")
    wide = spark.createDataFrame([(Decimal("9007199254740993.01"),)] * 3, "v decimal(18,2)")
    assert wide.agg(fn.numbers.exact_sum("v")).head()[0] == Decimal("27021597764222979.03")


@pytest.mark.parametrize("bad", [float("nan"), float("inf"), -float("inf"), 1e20])
def test_totals_refuse_what_they_cannot_hold(spark, bad):
    df = spark.createDataFrame([(bad,), (1.0,)], "v double")
    with pytest.raises(ArithmeticException):
        df.agg(fn.total("v")).collect()
    many = spark.range(3).select(F.lit(9e18).alias("v"))
    with pytest.raises(ArithmeticException):
        many.agg(fn.total("v")).collect()


def test_totals_of_decimals_equal_decimal_sums(spark):
    df = spark.range(100_000).select(((F.col("id") * 7919 % 1_000_003) / 100).alias("v"))
    both = df.withColumn("d", F.col("v").cast("decimal(18,2)"))
    got = both.agg(fn.total("v"), fn.total("d"), F.sum("d").cast("double")).head()
    assert got[0] == got[1] == got[2]
