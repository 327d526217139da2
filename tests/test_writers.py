from __future__ import annotations

import glob

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from faremill.operators import writers as w
from tests.conftest import final_plan, plan, rows


def files(path: str) -> list[str]:
    return glob.glob(f"{path}/**/*.parquet", recursive=True)


def test_modes(spark, folder):
    df = spark.range(5)
    w.write(df, folder + "/t")
    with pytest.raises(AnalysisException):
        w.write(df, folder + "/t")
    assert w.write(df.filter("id < 2"), folder + "/t", "overwrite").count() == 2
    assert w.append(df, folder + "/t").count() == 7
    assert w.table_copy(df, folder + "/t").count() == 5


def test_file_counts(spark, folder):
    df = spark.range(0, 1000, 1, 8)
    w.write(df, folder + "/r", repartition=4)
    w.write(df, folder + "/c", coalesce=1)
    assert len(files(folder + "/r")) == 4
    assert len(files(folder + "/c")) == 1
    assert "Exchange" not in plan(df.coalesce(1))


def test_csv_round_trip(spark, folder):
    df = spark.createDataFrame([(1, "a,b"), (2, None)], "id int, v string")
    got = w.write(df, folder + "/csv", fmt="csv", options={"header": "true"})
    assert rows(got) == [(1, "a,b"), (2, None)]


def test_months_layout_and_pruning(spark, folder):
    df = spark.sql(
        "SELECT explode(sequence(timestamp'2023-11-15', timestamp'2024-02-15', interval 1 day)) t"
    )
    stored = w.write_months(df, folder + "/m", "t")
    assert sorted(set(f.split("/m/")[1].rsplit("/", 1)[0] for f in files(folder + "/m"))) == [
        "year=2023/month=11", "year=2023/month=12", "year=2024/month=1", "year=2024/month=2",
    ]
    january = stored.filter("year = 2024 AND month = 1")
    assert january.count() == 31
    assert "PartitionFilters: [isnotnull(year" in plan(january)


def test_clustered_within_directories(spark, folder):
    df = spark.range(1000).select((F.col("id") % 2).alias("d"), (F.col("id") * 7 % 100).alias("c"))
    stored = w.write(df, folder + "/k", partition_by=["d"], cluster_by=["c"])
    for path in files(folder + "/k"):
        values = [r.c for r in spark.read.parquet(path).collect()]
        assert values == sorted(values)
    assert stored.count() == 1000


def test_a_hot_directory_is_split_between_tasks(spark, folder):
    """One day holds most rows; it is written by several tasks, the small days by few."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        df = spark.range(200_000).select(
            F.when(F.col("id") % 10 < 8, 0).otherwise(F.col("id") % 7).alias("day"),
            F.md5(F.col("id").cast("string")).alias("v"),
        )
        stored = w.write(df, folder + "/hot", partition_by=["day"])
        assert len(files(folder + "/hot/day=0")) > 4
        assert stored.count() == 200_000
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_materialize(spark, folder):
    df = spark.range(3)
    w.materialize(df, "view", "numbers_view")
    w.materialize(df, "table", "numbers_table", folder + "/n")
    assert spark.sql("SELECT count(*) FROM numbers_view").head()[0] == 3
    assert "FileScan parquet" in plan(spark.table("numbers_table"))
    with pytest.raises(ValueError):
        w.materialize(df, "table", "x")


def test_connector_options():
    assert w.connector_options("bigquery", "d.t", {"a": "b"}) == {"a": "b", "table": "d.t"}
    assert w.connector_options("jdbc", "t", {"url": "u"}) == {"url": "u", "dbtable": "t"}


def test_connector_write(spark):
    """The no-op connector takes the place of a warehouse."""
    w.write_table(spark.range(3), "noop", "dataset.table", {"a": "b"}, "overwrite")


def test_preview(spark, capsys):
    w.preview(spark.range(3), 2)
    assert "only showing top 2 rows" in capsys.readouterr().out


def test_rebalance_is_planned(spark):
    df = spark.range(10).withColumn("d", F.col("id") % 2)
    assert "REBALANCE_PARTITIONS_BY_COL" in final_plan(w.by_directory(df, ["d"]))
