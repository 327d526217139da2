from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from faremill import jobs
from faremill.operators import buckets as b
from faremill.operators import incremental as inc
from tests.conftest import plan, rows

ROW = "id long, v string"


def table(spark, n):
    return spark.range(n).select("id", F.concat(F.lit("v"), "id").alias("v"))


def files(path):
    found = {}
    for folder, _, names in os.walk(path):
        bucket = os.path.basename(folder)
        if bucket.startswith("_bucket_of"):
            found[bucket] = {(n, os.stat(f"{folder}/{n}").st_mtime_ns) for n in names}
    return found


def changed(before, after):
    return {k for k in before.keys() | after.keys() if before.get(k) != after.get(k)}


@pytest.mark.parametrize("change", [b.merge_bucketed, b.delete_insert_bucketed])
def test_only_touched_buckets_are_written(spark, folder, change):
    path = folder + "/t"
    change(table(spark, 2000), path, ["id"], buckets=32)
    before = files(path)
    assert len(before) == 32
    source = spark.createDataFrame([(5, "new"), (1234, "new"), (5000, "added")], ROW)
    for _ in range(2):
        got = change(source, path, ["id"])
        assert got.count() == 2001
    assert rows(got.filter("id in (4, 5, 1234, 5000)")) == [
        (1234, "new"), (4, "v4"), (5, "new"), (5000, "added"),
    ]
    touched = changed(before, files(path))
    keys = [r[0] for r in source.select(b.bucket_of(source, ["id"], 32, source.schema)).collect()]
    assert touched == {f"_bucket_of_32={k}" for k in keys} and len(touched) <= 3


def test_only_touched_buckets_are_read(spark, folder):
    path = folder + "/t"
    b.create_bucketed(table(spark, 500), path, ["id"], 16)
    wanted = spark.createDataFrame([(7,), (9999,)], "id long")
    found = b.read_keys(spark, path, wanted, ["id"])
    text = plan(found)
    assert "PartitionFilters: [_bucket_of_16" in text
    assert rows(found) == [(7, "v7")]
    files_read = found.select(F.input_file_name()).distinct().collect()
    assert len(files_read) == 1


def test_keys_of_other_number_types_meet(spark, folder):
    path = folder + "/t"
    b.create_bucketed(table(spark, 50), path, ["id"], 8)
    got = b.merge_bucketed(spark.createDataFrame([(7, "x")], "id int, v string"), path, ["id"])
    assert got.count() == 50 and got.filter("id = 7").head().v == "x"
    with pytest.raises(TypeError):
        b.create_bucketed(spark.range(3).selectExpr("double(id) as id"), path, ["id"])


def test_new_columns_are_appended(spark, folder):
    path = folder + "/t"
    b.merge_bucketed(table(spark, 20), path, ["id"], 4)
    before = files(path)
    wider = spark.createDataFrame([(3, "V", 9)], "id long, v string, extra int")
    got = b.merge_bucketed(wider, path, ["id"])
    assert rows(got.filter("id in (3, 4)")) == [(3, "V", 9), (4, "v4", None)]
    assert len(changed(before, files(path))) == 1


def test_several_key_columns_and_nulls(spark, folder):
    path = folder + "/t"
    data = [(1, "a", "x"), (1, "b", "y"), (None, "a", "z")]
    b.create_bucketed(spark.createDataFrame(data, "k int, s string, v string"), path, ["k", "s"], 8)
    source = spark.createDataFrame([(1, "b", "Y"), (2, None, "n")], "k int, s string, v string")
    got = b.merge_bucketed(source, path, ["k", "s"])
    assert rows(got.select("v")) == [("Y",), ("n",), ("x",), ("z",)]


def test_refused(spark, folder):
    path = folder + "/t"
    twice = spark.createDataFrame([(1, "a"), (1, "b")], ROW)
    with pytest.raises(inc.DuplicateKeys):
        b.merge_bucketed(twice, path, ["id"])
    assert not b.exists(spark, path)
    assert b.delete_insert_bucketed(twice, path, ["id"], 4).count() == 2
    b.create_bucketed(table(spark, 200), path, ["id"], 16)
    with pytest.raises(b.OtherKey):
        b.merge_bucketed(table(spark, 2), path, ["v"])
    with pytest.raises(b.OtherKey):
        b.merge_bucketed(table(spark, 2).withColumn("w", F.lit(1)), path, ["w"])
    with pytest.raises(inc.DuplicateKeys):
        b.merge_bucketed(twice, path, ["id"])
    assert b.read_bucketed(spark, path).count() == 200


def test_an_empty_increment_changes_nothing(spark, folder):
    path = folder + "/t"
    b.create_bucketed(table(spark, 20), path, ["id"], 4)
    before = files(path)
    assert b.merge_bucketed(table(spark, 0), path, ["id"]).count() == 20
    assert files(path) == before
    assert b.merge_bucketed(table(spark, 0), folder + "/new", ["id"]).count() == 0


def test_a_hot_key_is_dealt_to_several_files(spark, folder):
    path = folder + "/t"
    hot = spark.range(4000).select(F.lit(1).alias("id"), F.sha2(F.col("id").cast("string"), 512).alias("v"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        got = b.delete_insert_bucketed(hot, path, ["id"], 4)
        assert got.count() == 4000
        assert len(next(iter(files(path).values()))) > 2
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_rebucket(spark, folder):
    path = folder + "/t"
    b.create_bucketed(table(spark, 300), path, ["id"], 4)
    got = b.rebucket(spark, path, ["id"], 32)
    assert got.count() == 300 and len(files(path)) == 32
    assert b.merge_bucketed(table(spark, 301), path, ["id"], buckets=4).count() == 301
    assert len(files(path)) == 32


def test_the_job(spark, folder):
    table(spark, 100).write.parquet(folder + "/one")
    table(spark, 120).withColumn("v", F.lit("n")).filter("id >= 99").write.parquet(folder + "/two")
    for name in ("one", "two"):
        jobs.main(
            ["merge-by-key", f"--source={folder}/{name}", f"--target={folder}/t", "--key=id",
             "--buckets=16"],
            spark,
        )
    got = b.read_bucketed(spark, folder + "/t")
    assert got.count() == 120 and got.filter("v = 'n'").count() == 21


def test_rows_of_an_increment_are_computed_once(spark, folder, monkeypatch):
    """The directories to empty come from the files, not from a second run of the plan."""
    asked = []
    values = inc._values
    monkeypatch.setattr(inc, "_values", lambda df, c: asked.append(plan(df)) or values(df, c))
    path = folder + "/d"
    base = table(spark, 30).withColumn("d", F.col("id") % 3)
    inc.create(base, path, "d")
    got = inc.delete_insert(base.filter("id = 1").withColumn("d", F.lit(5).cast("long")), path, ["id"], "d")
    assert got.count() == 30
    assert not any("Union" in p for p in asked)
