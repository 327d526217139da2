from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from faremill.operators import marks as m
from tests.conftest import plan, rows, ts

ROW = "s string, at timestamp, id int"


def data(spark, *values):
    return spark.createDataFrame([(s, ts(f"2024-01-{d:02}T00:00:00"), i) for s, d, i in values], ROW)


def ids(df):
    return sorted(r.id for r in df.collect())


@pytest.mark.parametrize("filtered", [100, 0])
def test_each_source_goes_on_from_its_own_mark(spark, folder, monkeypatch, filtered):
    monkeypatch.setattr(m, "FILTERED", filtered)
    first = data(spark, ("a", 20, 1), ("a", 5, 2), ("b", 3, 3), (None, 4, 4))
    m.store_marks(m.newest_by_source(first, "s", "at"), folder + "/marks")
    known = m.read_marks(spark, folder + "/marks")
    assert known.count() == 3
    more = data(
        spark, ("a", 20, 10), ("a", 19, 11), ("a", 21, 12), ("b", 4, 13), ("b", 3, 14),
        (None, 4, 15), (None, 5, 16), ("new", 1, 17),
    )
    assert ids(m.newer_than_marks(more, known, "s", "at")) == [12, 13, 16, 17]
    assert ids(m.newer_than_marks(more, known, "s", "at", inclusive=True)) == [10, 12, 13, 14, 15, 16, 17]
    back = m.newer_than_marks(more, known, "s", "at", lookback=dt.timedelta(days=1))
    assert ids(back) == [10, 12, 13, 14, 15, 16, 17]
    assert more.columns == back.columns
    assert ids(m.newer_than_marks(more, None, "s", "at")) == list(range(10, 18))


def test_marks_only_rise(spark, folder):
    path = folder + "/marks"
    m.store_marks(m.newest_by_source(data(spark, ("a", 9, 1), ("b", 9, 1)), "s", "at"), path)
    name = m.name_of(m.read_marks(spark, path))
    m.store_marks(m.newest_by_source(data(spark, ("a", 3, 1)), "s", "at"), path)
    assert m.name_of(m.read_marks(spark, path)) == name != m.name_of(None)
    m.store_marks(m.newest_by_source(data(spark, ("b", 12, 1), ("c", 1, 1)), "s", "at"), path)
    got = {r.source: r.mark.day for r in m.read_marks(spark, path).collect()}
    assert got == {"a": 9, "b": 12, "c": 1}
    assert m.name_of(m.read_marks(spark, path)) != name


def test_marks_reach_the_scan(spark, folder):
    df = data(spark, ("a", 20, 1), ("b", 3, 3))
    df.write.parquet(folder + "/t")
    known = m.newest_by_source(df, "s", "at")
    got = m.newer_than_marks(spark.read.parquet(folder + "/t"), known, "s", "at")
    assert "GreaterThan(at,2024-01-20" in plan(got) and ids(got) == []


@pytest.mark.parametrize("kind", ["date", "int", "decimal(18,2)", "timestamp_ntz"])
def test_other_types(spark, kind):
    values = ["1", "2", "3"] if kind in ("int", "decimal(18,2)") else ["2024-01-01", "2024-01-02", "2024-01-03"]
    df = spark.createDataFrame([(1, v) for v in values], "s int, v string")
    df = df.select("s", F.col("v").cast(kind).alias("v"))
    known = m.newest_by_source(df.limit(2), "s", "v")
    assert m.newer_than_marks(df, known, "s", "v").count() == 1
    assert m.newer_than_marks(df, known.limit(0), "s", "v").count() == 3


def test_empty_tables(spark, folder):
    none = data(spark, ("a", 1, 1)).limit(0)
    assert m.newest_by_source(none, "s", "at").count() == 0
    known = m.store_marks(m.newest_by_source(none, "s", "at"), folder + "/marks")
    assert ids(m.newer_than_marks(data(spark, ("a", 1, 1)), known, "s", "at")) == [1]
    assert rows(m.newer_than_marks(none, known, "s", "at")) == []
