from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from faremill.operators import joins
from faremill.operators import key_register as k
from faremill.operators import quality as q
from tests.conftest import final_plan, plan, rows

ROW = "a int, b string"


def test_a_second_load_is_checked_against_the_first(spark, folder):
    path = folder + "/keys"
    first = spark.createDataFrame([(1, "x"), (2, "x"), (2, "x"), (None, "n")], ROW)
    assert rows(k.repeated_keys(first, path, ["a", "b"])) == [(2, "x", 2, False)]
    k.register(first, path, ["a", "b"], "one", buckets=4)
    second = spark.createDataFrame([(1, "x"), (1, "y"), (3, "z"), (3, "z"), (None, "n"), (None, "m")], ROW)
    want = [(1, "x", 1, True), (3, "z", 2, False), (None, "n", 1, True)]
    assert rows(k.repeated_keys(second, path, ["a", "b"], "two")) == want
    ignored = k.repeated_keys(second, path, ["a", "b"], "two", nulls="ignore")
    assert rows(ignored) == want[:2]
    # registering it, even twice, does not hold the load against itself
    for _ in range(2):
        k.register(second, path, ["a", "b"], "two")
        assert rows(k.repeated_keys(second, path, ["a", "b"], "two")) == want
    third = spark.createDataFrame([(1, "y"), (9, "q")], ROW)
    assert rows(k.repeated_keys(third, path, ["a", "b"], "three")) == [(1, "y", 1, True)]


def test_only_touched_buckets_are_read(spark, folder):
    spark.range(1000).write.parquet(folder + "/table")
    table = spark.read.parquet(folder + "/table")
    path = folder + "/keys"
    k.register(table, path, ["id"], "one", buckets=16)
    more = spark.createDataFrame([(5,), (7000,)], "id long")
    known = k.known_keys(more, path, ["id"], "two")
    text = plan(known)
    assert "PartitionFilters: [" in text and "_bucket_of_16" in text
    read = known.inputFiles()
    assert all("/table/" not in f for f in read)
    touched = {f.split("_bucket_of_16=")[1].split("/")[0] for f in read if "_bucket_of_16" in f}
    assert rows(known) == [(5,)]
    got = {r[0] for r in more.select(k.bucket_of(more, ["id"], 16, more.schema)).collect()}
    assert len(got) <= 2 and {int(t) for t in touched} >= got


def test_runs_are_sorted(spark, folder):
    path = folder + "/keys"
    k.register(spark.range(500).select((F.col("id") * 7919 % 500).alias("id")), path, ["id"], "one", 2)
    for bucket in (0, 1):
        folder_ = f"{path}/_load=one/_bucket_of_2={bucket}"
        for name in os.listdir(folder_):
            if name.endswith(".parquet"):
                ids = [r.id for r in spark.read.parquet(f"{folder_}/{name}").collect()]
                assert ids == sorted(ids) and ids


def test_as_a_check(spark, folder):
    path = folder + "/keys"
    k.register(spark.range(10), path, ["id"], "one")
    good, bad = spark.range(10, 20), spark.range(5, 15)
    for df, failed in ((good, 0), (bad, 5)):
        check = k.unique_in_growing(path, ["id"], "two")
        (verdict,) = q.run_checks(df, "t", [check]).collect()
        assert (verdict.failed_rows, verdict.passed) == (failed, failed == 0)


def test_empty_loads_and_names(spark, folder):
    path = folder + "/keys"
    k.register(spark.range(0), path, ["id"], "none")
    assert rows(k.repeated_keys(spark.range(3), path, ["id"], "one")) == []
    k.register(spark.range(3), path, ["id"], "one", buckets=8)
    assert k.repeated_keys(spark.range(2, 5), path, ["id"], "two").count() == 1
    with pytest.raises(ValueError):
        k.register(spark.range(3), path, ["id"], "a/b")


# --- relationships to a large parent ----------------------------------------------------


def test_orphans_of_a_large_parent(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (3,), (None,), (99,)], "fk int")
    parent = spark.range(0, 50, 2).withColumnRenamed("id", "pk")
    got = joins.orphans_of_large_parent(child, parent, "fk", "pk")
    assert rows(got) == rows(joins.orphans(child, parent, "fk", "pk")) == [(1, 2), (3, 1), (99, 1)]
    check = q.relationships("fk", parent, "pk", large_parent=True)
    (verdict,) = q.run_checks(child, "t", [check]).collect()
    assert verdict.failed_rows == 4
    assert joins.orphans_of_large_parent(child.limit(0), parent, "fk", "pk").count() == 0


def test_the_parent_is_filtered_before_it_is_shuffled(spark, folder):
    spark.range(0, 200_000, 1, 8).withColumnRenamed("id", "pk").write.parquet(folder + "/parent")
    parent = spark.read.parquet(folder + "/parent")
    keys = spark.range(0, 900_000, 3000).select(F.col("id").alias("_fk"), F.lit(1).cast("long").alias("child_rows"))
    keys.write.parquet(folder + "/keys")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with joins.parent_filter(spark):
            found = joins.found_in_parent(spark.read.parquet(folder + "/keys"), parent, "pk")
            text = final_plan(found)
        assert "might_contain" in text and "Broadcast" not in text
        below = text.split("might_contain")[1]
        assert "Scan parquet" in below
        assert found.count() == 67
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
