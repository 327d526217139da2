from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from faremill.operators import incremental as inc
from faremill.sources.tables import load
from tests.conftest import plan, rows, ts

DAY = "d date, id int, v string"


def days(spark, *data):
    return spark.createDataFrame([(dt.date(2024, 1, d), i, v) for d, i, v in data], DAY)


def stamped(spark, *data):
    df = spark.createDataFrame([(ts(t), i) for t, i in data], "t timestamp, id int")
    return df.withColumn("d", F.to_date("t"))


@pytest.mark.parametrize("partition", [None, "d"])
def test_merge_updates_and_inserts_and_can_be_repeated(spark, folder, partition):
    path = folder + "/t"
    inc.merge(days(spark, (1, 1, "a"), (1, 2, "b"), (2, 3, "c")), path, ["id"], partition)
    source = days(spark, (1, 2, "B"), (3, 4, "D"))
    for _ in range(2):
        got = inc.merge(source, path, ["id"], partition)
        assert rows(got.select("id", "v")) == [(1, "a"), (2, "B"), (3, "c"), (4, "D")]


def test_merge_touches_only_the_days_of_the_source(spark, folder):
    path = folder + "/t"
    inc.create(days(spark, (1, 1, "a"), (2, 2, "b"), (3, 3, "c")), path, "d")
    before = {p: sorted(os.listdir(f"{path}/{p}")) for p in os.listdir(path) if p.startswith("d=")}
    inc.merge(days(spark, (2, 2, "B")), path, ["id"], "d")
    after = {p: sorted(os.listdir(f"{path}/{p}")) for p in os.listdir(path) if p.startswith("d=")}
    assert before.keys() == after.keys()
    changed = [p for p in before if before[p] != after[p]]
    assert changed == ["d=2024-01-02"]


@pytest.mark.parametrize("partition", [None, "d"])
def test_an_empty_source_changes_nothing(spark, folder, partition):
    path = folder + "/t"
    inc.create(days(spark, (1, 1, "a"), (2, 2, "b")), path, partition)
    got = inc.merge(days(spark), path, ["id"], partition)
    assert rows(got.select("id", "v")) == [(1, "a"), (2, "b")]


@pytest.mark.parametrize("change", [inc.merge, inc.delete_insert])
def test_a_key_moves_to_another_directory(spark, folder, change):
    path = folder + "/t"
    inc.create(days(spark, (1, 1, "a"), (1, 9, "z"), (2, 2, "b"), (3, 3, "c")), path, "d")
    got = change(days(spark, (4, 1, "A"), (2, 3, "C")), path, ["id"], "d")
    want = [("2024-01-01", 9, "z"), ("2024-01-02", 2, "b"), ("2024-01-02", 3, "C"), ("2024-01-04", 1, "A")]
    assert [(str(r.d), r.id, r.v) for r in got.orderBy("d", "id").collect()] == want
    assert not os.path.exists(path + "/d=2024-01-03")


def test_a_failed_first_write_is_no_target(spark, folder):
    os.makedirs(folder + "/t/version-00000001")
    assert not inc.exists(spark, folder + "/t")
    got = inc.merge(days(spark, (1, 1, "a")), folder + "/t", ["id"])
    assert rows(got.select("id", "v")) == [(1, "a")]


def test_a_failed_increment_leaves_no_folder(spark, folder):
    from faremill.session import workspace

    base = os.path.dirname(workspace(spark, "x").removeprefix("file:"))
    before = set(os.listdir(base))
    with pytest.raises(inc.DuplicateKeys):
        inc.merge(days(spark, (1, 1, "a"), (1, 1, "b")), folder + "/t", ["id"])
    assert {n for n in set(os.listdir(base)) - before if n.startswith("increment")} == set()


def test_clustered_directories(spark, folder):
    path = folder + "/t"
    source = spark.range(200).select(
        F.lit(dt.date(2024, 1, 1)).alias("d"), (F.col("id") * 7 % 200).alias("id")
    )
    for write in (
        lambda: inc.create(source, path, "d", cluster_by=["id"]),
        lambda: inc.merge(source, path, ["id"], "d", cluster_by=["id"]),
    ):
        ids = [r.id for r in write().coalesce(1).collect()]
        assert ids == sorted(ids) and len(ids) == 200


def test_increment_folders_do_not_stay(spark, folder):
    shared = spark.conf.get("spark.checkpoint.dir")
    before = {p for p in os.listdir(shared) if p.startswith("increment-")}
    inc.create(days(spark, (1, 1, "a")), folder + "/t")
    inc.merge(days(spark, (1, 1, "b")), folder + "/t", ["id"])
    assert {p for p in os.listdir(shared) if p.startswith("increment-")} == before


def test_merge_refuses_repeated_keys(spark, folder):
    inc.create(days(spark, (1, 1, "a")), folder + "/t")
    with pytest.raises(inc.DuplicateKeys):
        inc.merge(days(spark, (1, 2, "x"), (1, 2, "y")), folder + "/t", ["id"])
    assert rows(inc.read_target(spark, folder + "/t").select("id")) == [(1,)]


@pytest.mark.parametrize("partition", [None, "d"])
def test_new_columns_are_appended(spark, folder, partition):
    path = folder + "/t"
    inc.create(days(spark, (1, 1, "a"), (1, 2, "b"), (2, 3, "c")), path, partition)
    wider = days(spark, (1, 2, "B")).withColumn("extra", F.lit(9))
    got = inc.merge(wider, path, ["id"], partition)
    assert rows(got.select("id", "v", "extra")) == [(1, "a", None), (2, "B", 9), (3, "c", None)]
    # an older source still keeps the column, and the value of untouched keys
    got = inc.merge(days(spark, (1, 1, "A")), path, ["id"], partition)
    assert rows(got.select("id", "v", "extra")) == [(1, "A", None), (2, "B", 9), (3, "c", None)]


@pytest.mark.parametrize("partition", [None, "d"])
def test_delete_insert_keeps_several_rows_per_key(spark, folder, partition):
    path = folder + "/t"
    inc.create(days(spark, (1, 1, "a"), (1, 1, "b"), (1, 2, "c")), path, partition)
    source = days(spark, (1, 1, "x"), (1, 1, "y"), (1, 1, "z"))
    for _ in range(2):
        got = inc.delete_insert(source, path, ["id"], partition)
        assert rows(got.select("id", "v")) == [(1, "x"), (1, "y"), (1, "z"), (2, "c")]


def test_versions(spark, folder):
    path = folder + "/t"
    for n in (1, 2, 3):
        inc.commit(spark.range(n), path)
    assert inc.read_target(spark, path).count() == 3
    # an unfinished version is not read, and its number is not reused
    os.makedirs(f"{path}/version-00000004")
    assert inc.read_target(spark, path).count() == 3
    assert inc.commit(spark.range(5), path).count() == 5
    inc.drop_old_versions(spark, path, keep=1)
    assert inc.read_target(spark, path).count() == 5
    assert not os.path.exists(f"{path}/version-00000001")


@pytest.mark.parametrize("partition", [None, "d"])
def test_interval_without_new_rows_is_emptied(spark, folder, partition):
    path = folder + "/t"
    full = stamped(
        spark, ("2024-01-01T10:00:00", 1), ("2024-01-02T10:00:00", 2), ("2024-01-03T10:00:00", 3),
        ("2024-01-03T23:00:00", 4),
    )
    inc.create(full, path, partition)
    start, end = dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 3, 12)
    for _ in range(2):
        got = inc.replace_interval(full.limit(0), path, "t", start, end, partition=partition)
        assert rows(got.select("id")) == [(1,), (4,)]
    # rows outside the window are not inserted, rows inside are
    late = stamped(spark, ("2024-01-03T12:00:00", 5), ("2024-01-03T11:59:59", 6))
    got = inc.replace_interval(late, path, "t", start, end, partition=partition)
    assert rows(got.select("id")) == [(1,), (4,), (6,)]


def test_interval_by_month_directories(spark, folder):
    path = folder + "/t"
    month = lambda df: df.drop("d").withColumn("m", F.trunc("t", "month"))
    full = month(
        stamped(
            spark, ("2024-01-31T00:00:00", 1), ("2024-02-10T00:00:00", 2), ("2024-03-02T00:00:00", 3)
        )
    )
    inc.create(full, path, "m")
    got = inc.replace_interval(
        month(stamped(spark, ("2024-03-01T00:00:00", 9))), path, "t", dt.datetime(2024, 2, 1),
        dt.datetime(2024, 3, 2), partition="m",
    )
    assert rows(got.select("id")) == [(1,), (3,), (9,)]
    assert not os.path.exists(path + "/m=2024-02-01")


def test_date_keys_need_whole_days(spark, folder):
    with pytest.raises(ValueError):
        inc.replace_interval(
            days(spark), folder + "/t", "d", dt.datetime(2024, 1, 1, 5), dt.datetime(2024, 1, 2),
            granularity="date",
        )


def test_interval_keeps_rows_without_a_time(spark, folder):
    path = folder + "/t"
    df = spark.createDataFrame([(None, 1), (ts("2024-01-01T00:00:00"), 2)], "t timestamp, id int")
    inc.create(df, path)
    got = inc.replace_interval(df.limit(0), path, "t", dt.date(2024, 1, 1), dt.date(2024, 1, 2))
    assert rows(got.select("id")) == [(1,)]


def test_slice(spark, folder):
    df = stamped(spark, ("2024-01-01T00:00:00", 1), ("2024-01-02T00:00:00", 2), ("2024-01-03T00:00:00", 3))
    target = df.filter("id <= 2")
    assert rows(inc.incremental_slice(df, target, "t").select("id")) == [(3,)]
    assert inc.incremental_slice(df, None, "t").count() == 3
    assert inc.incremental_slice(df, target, "t", full_refresh=True).count() == 3
    # an existing but empty target lets nothing pass
    assert inc.incremental_slice(df, df.limit(0), "t").count() == 0
    back = inc.incremental_slice(df, target, "t", lookback=dt.timedelta(hours=36))
    # strictly after 2024-01-02 minus 36 hours
    assert rows(back.select("id")) == [(1,), (2,), (3,)]
    back = inc.incremental_slice(df, target, "t", lookback=dt.timedelta(hours=24))
    assert rows(back.select("id")) == [(2,), (3,)]


def test_slice_reaches_the_scan(spark, sf_dir):
    orders = load(spark, sf_dir, "orders")
    target = orders.filter("o_orderdate < '2000-01-01'")
    got = inc.incremental_slice(orders, target, "o_orderdate")
    assert "GreaterThan(o_orderdate,1999-12-" in plan(got)
    assert got.count() == orders.filter("o_orderdate >= '2000-01-01'").count()


@pytest.mark.parametrize("kind", ["date", "timestamp_ntz", "int", "decimal(18,2)"])
def test_slice_by_other_types(spark, kind):
    values = {"int": ["1", "2", "3"], "decimal(18,2)": ["1.01", "1.02", "1.03"]}.get(
        kind, ["2024-01-01", "2024-01-02", "2024-01-03"]
    )
    df = spark.createDataFrame([(v,) for v in values], "c string").select(F.col("c").cast(kind))
    assert inc.incremental_slice(df, df.limit(2), "c").count() == 1
    assert inc.incremental_slice(df, df.limit(0), "c").count() == 0


def test_a_window_opens_its_directories_only(spark, folder):
    path = folder + "/t"
    inc.create(
        stamped(spark, ("2024-01-01T10:00:00", 1), ("2024-01-02T10:00:00", 2), ("2024-01-03T10:00:00", 3)),
        path, "d",
    )
    got = inc.within(
        inc.read_target(spark, path), "t", dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 3), "d"
    )
    assert rows(got.select("id")) == [(2,)]
    assert "PartitionFilters: [isnotnull(d" in plan(got)


def test_no_row_outside_a_window_goes(spark, folder):
    """Part of a month is replaced in a target laid out by month, quarter and year."""
    every = spark.range(31 * 3).select(
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 86400).alias("t"), "id"
    )
    fresh = spark.createDataFrame([(ts("2024-01-11T05:00:00"), 1000)], "t timestamp, id long")
    for unit in ("month", "quarter", "year", "week"):
        path = f"{folder}/{unit}"
        inc.create(every.withColumn("p", F.trunc("t", unit)), path, "p")
        got = inc.replace_interval(
            fresh.withColumn("p", F.trunc("t", unit)), path, "t", dt.datetime(2024, 1, 10),
            dt.datetime(2024, 1, 20), partition="p",
        )
        want = [i for i in range(93) if not 9 <= i < 19] + [1000]
        assert sorted(r.id for r in got.collect()) == want, unit
        near = inc.within(got, "t", dt.datetime(2024, 1, 8), dt.datetime(2024, 1, 12), "p")
        assert sorted(r.id for r in near.collect()) == [7, 8, 1000]


def test_newest_partition_reads_one_directory(spark, folder):
    path = folder + "/t"
    inc.create(days(spark, (1, 1, "a"), (2, 2, "b")), path, "d")
    newest = inc.newest_partition(spark, path, "d")
    assert rows(newest.select("id")) == [(2,)]
    assert "PartitionFilters: [isnotnull(d" in plan(newest)
