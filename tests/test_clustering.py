"""Files that hold ranges of the cluster columns, and scans that read fewer row groups for it."""

from __future__ import annotations

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from faremill import jobs
from faremill.operators import incremental as inc
from faremill.operators.writers import write
from tests.conftest import plan, rows
from tests.test_jobs import land

SMALL = {"parquet.block.size": "16384", "parquet.page.size": "4096"}


def groups(path, column):
    """(lowest, highest) of a column in every row group below a folder."""
    out = []
    for name in glob.glob(f"{path}/**/*.parquet", recursive=True):
        file = pq.ParquetFile(name)
        at = file.schema_arrow.names.index(column)
        for i in range(file.metadata.num_row_groups):
            stats = file.metadata.row_group(i).column(at).statistics
            out.append((stats.min, stats.max))
    return out


def scanned_rows(df):
    """How many rows the scan handed on, after it skipped row groups."""
    execution = df._jdf.queryExecution()
    execution.executedPlan().executeCollect()
    leaves = execution.executedPlan().collectLeaves()
    for i in range(leaves.length()):
        metrics = leaves.apply(i).metrics()
        if metrics.contains("numOutputRows"):
            return metrics.apply("numOutputRows").value()
    raise AssertionError("no scan")


@pytest.fixture
def no_aqe(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def rides(spark, n):
    """Two days; a third of the rows are one borough of one day."""
    hot = F.col("id") % 3 == 0
    return spark.range(0, n, 1, 7).select(
        "id",
        F.when(hot, 0).otherwise(F.col("id") % 2).cast("int").alias("day"),
        F.when(hot, "m").otherwise(F.chr((F.col("id") * 7919 % 26 + 97).cast("long"))).alias("borough"),
        F.sha2(F.col("id").cast("string"), 256).alias("note"),
    )


def test_a_borough_filter_reads_few_row_groups(spark, folder, no_aqe):
    df = rides(spark, 20_000)
    path = folder + "/t"
    table = write(df, path, partition_by=["day"], cluster_by=["borough"], options=SMALL)
    bounds = groups(path, "borough")
    assert len(bounds) > 20
    wanted = [b for b in bounds if b[0] <= "c" <= b[1]]
    assert len(wanted) <= len(bounds) / 5
    some = table.filter("borough = 'c'")
    assert "EqualTo(borough,c)" in plan(some)
    count = df.filter("borough = 'c'").count()
    assert count <= scanned_rows(some) < 20_000 / 3
    assert some.count() == count and table.count() == 20_000


def test_without_ranges_every_row_group_is_read(spark, folder, no_aqe):
    """What clustering is measured against: the same table in the order of arrival."""
    path = folder + "/t"
    write(rides(spark, 20_000), path, partition_by=["day"], options=SMALL)
    bounds = groups(path, "borough")
    assert all(b[0] <= "c" <= b[1] for b in bounds)


def test_a_hot_borough_is_dealt_to_several_tasks(spark, folder, no_aqe):
    path = folder + "/t"
    write(rides(spark, 20_000), path, partition_by=["day"], cluster_by=["borough"])
    files = glob.glob(path + "/day=0/*.parquet")
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in files]
    assert max(sizes) < 20_000 / 4 and len(files) >= 4


@pytest.mark.parametrize("partition", [None, "day"])
def test_incremental_targets_are_clustered(spark, folder, no_aqe, partition):
    path = folder + "/t"
    inc.create(rides(spark, 6000), path, partition, cluster_by=["borough"])
    changed = rides(spark, 6300).filter("id % 10 = 0").withColumn("note", F.lit("new"))
    got = inc.merge(changed, path, ["id"], partition, cluster_by=["borough"])
    assert got.count() == 5999 + 31 and got.filter("note = 'new'").count() == 630
    newest = sorted(glob.glob(path + "/version-*"))[-1:] or [path]
    bounds = groups(newest[0], "borough")
    assert sum(b[0] <= "c" <= b[1] for b in bounds) <= len(bounds) / 2


@pytest.mark.parametrize("partition", [None, "day"])
def test_columns_added_after_rows_are_dealt(spark, folder, no_aqe, partition):
    """They are stored and read back, and known to the next merge; no sample computes them."""
    path, seen = folder + "/t", []
    df = rides(spark, 3000).union(rides(spark, 30))

    def finish(dealt):
        seen.append(plan(dealt))
        return dealt.withColumn("key", F.md5(F.col("id").cast("string"))).select("key", *df.columns)

    inc.create(df, path, partition, cluster_by=["borough"], finish=finish)
    assert len(seen) == 1 and "Exchange rangepartitioning" in seen[0] and "md5" not in seen[0]
    whole = df.withColumn("key", F.md5(F.col("id").cast("string")))
    columns = ["key", *df.columns]
    assert rows(inc.read_target(spark, path).select(columns)) == rows(whole.select(columns))
    changed = whole.filter("id = 2000").withColumn("note", F.lit("new"))
    got = inc.merge(changed, path, ["key"], partition, moves=False, cluster_by=["borough"])
    assert got.count() == 3030 and got.filter("note = 'new'").count() == 1


def test_green_fact_by_day(spark, sf_dir, folder):
    """Two runs: the second one takes newer trips only and leaves the older days as they are."""
    land(spark, sf_dir, folder)
    green = spark.read.parquet(folder + "/green")
    time = "lpep_pickup_datetime"
    some = green.filter((F.col(time) >= "1997-01-01") & (F.col(time) < "1997-02-10"))
    some.filter(F.col(time) < "1997-01-25").write.parquet(folder + "/g1")
    some.write.parquet(folder + "/g2")

    def build(n, out):
        call = [f"--green={folder}/g{n}", f"--zones={folder}/zones", f"--output={folder}/{out}"]
        jobs.main(["green-fact", *call], spark)
        return inc.read_target(spark, f"{folder}/{out}")

    def files():
        return set(glob.glob(folder + "/fact/pickup_day=1997-01-1*/*.parquet"))

    build(1, "fact")
    before = files()
    twice = build(2, "fact")
    assert files() == before and before
    whole = build(2, "whole")
    ids = ["unique_row_id", "pickup_day", "pickup_borough"]
    assert rows(twice.select(ids)) == rows(whole.select(ids)) and whole.count() > 0
    day = whole.filter("pickup_day = DATE'1997-01-15' AND pickup_borough = 'ASIA'")
    assert "PartitionFilters: [isnotnull(pickup_day" in plan(day)
    assert "EqualTo(pickup_borough,ASIA)" in plan(day)
