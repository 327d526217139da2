"""Uniqueness of a growing table without reading what was loaded before.

The keys of every load are kept in a register: sorted runs, one a load and bucket of the hashed
key. A new load is checked against itself and against the runs of the buckets its keys fall
into; the table's rows are not read. The number of buckets stands in the directories' names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faremill.operators import incremental as inc
from faremill.operators.buckets import BUCKETS, DIRECTORY, bucket_of
from faremill.operators.quality import TableCheck
from faremill.operators.writers import by_directory

LOAD = "_load"


def loads(spark: SparkSession, path: str) -> list[str]:
    """The loads whose keys are registered."""
    return inc.complete_folders(spark, path, f"{LOAD}=")


def _buckets(spark: SparkSession, path: str) -> int | None:
    for load in loads(spark, path):
        for name in inc._children(spark, f"{path}/{LOAD}={load}"):
            found = DIRECTORY.fullmatch(name)
            if found:
                return int(found[1])
    return None


def register(rows: DataFrame, path: str, key: list[str], load: str, buckets: int = BUCKETS) -> None:
    """Keep the keys of a load; the same load again replaces its keys.

    ``buckets`` counts for the first load only.
    """
    if not load or "/" in load or "=" in load:
        raise ValueError("a load's name is a folder's")
    spark = rows.sparkSession
    count = _buckets(spark, path) or buckets
    column = f"_bucket_of_{count}"
    keys = rows.select(*key).distinct()
    keys = keys.withColumn(column, bucket_of(keys, key, count, rows.schema))
    runs = by_directory(keys, [column]).sortWithinPartitions(column, *key)
    folder = f"{path}/{LOAD}={load}"
    runs.write.mode("overwrite").partitionBy(column).parquet(folder)
    inc._remember_schema(spark, folder, runs.schema)


def known_keys(wanted: DataFrame, path: str, key: list[str], load: str | None = None) -> DataFrame:
    """The keys among ``wanted`` that other loads than ``load`` have, from their buckets only."""
    spark = wanted.sparkSession
    others = [n for n in loads(spark, path) if n != load]
    if not others:
        return wanted.select(*key).limit(0)
    count = _buckets(spark, path) or BUCKETS
    column = f"_bucket_of_{count}"
    schema = inc._known_schema(spark, f"{path}/{LOAD}={others[0]}")
    folders = [f"{path}/{LOAD}={n}" for n in others]
    runs = spark.read.schema(schema).option("basePath", path).parquet(*folders)
    asked = wanted.select(*key).distinct()
    touched = inc._values(asked.select(bucket_of(asked, key, count, schema).alias("b")), "b")
    some = runs.filter(inc._one_of(column, touched)).select(*[F.col(k).alias(f"_{k}") for k in key])
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in key])
    return asked.join(some, same, "left_semi")


def repeated_keys(
    rows: DataFrame, path: str, key: list[str], load: str | None = None, nulls: str = "same"
) -> DataFrame:
    """Keys of a load that are not unique: ``copies`` in the load, and whether they are ``known``
    from another. ``nulls='ignore'`` leaves out keys with a NULL, else NULLs are alike."""
    if nulls == "ignore":
        rows = rows.filter(~reduce(Column.__or__, [F.col(k).isNull() for k in key]))
    copies = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("copies"))
    known = known_keys(rows, path, key, load).select(
        *[F.col(k).alias(f"_{k}") for k in key], F.lit(True).alias("_known")
    )
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in key])
    both = copies.join(known, same, "left")
    both = both.select(*key, "copies", F.coalesce("_known", F.lit(False)).alias("known"))
    return both.filter((F.col("copies") > 1) | F.col("known"))


def unique_in_growing(
    path: str, key: list[str], load: str | None = None, nulls: str = "same"
) -> TableCheck:
    """A check of the rows of one load, for ``quality.run_checks``."""

    def failed(df: DataFrame) -> DataFrame:
        return repeated_keys(df, path, key, load, nulls).agg(
            F.count(F.lit(1)).alias("failed_rows")
        )

    return TableCheck("unique_in_growing", "+".join(key), failed)
