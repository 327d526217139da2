"""Incremental writers for targets without a date column, laid out by buckets of the hashed key.

The rows of a bucket lie in one directory. An increment reads and replaces only
the buckets its keys fall into: the cost follows the increment, not the table, as long as it
has fewer keys than there are buckets; a larger one rewrites all of them. The number of buckets
stands in the directories' names, so a target cannot be read with another one. ``rebucket``
changes it when the table has grown, by a rewrite into a new version.

The replaced buckets appear one after the other: after a failure in between the same call again
completes the write. One writer at a time per target.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faremill.operators import incremental as inc

BUCKETS = 64
DIRECTORY = re.compile(r"_bucket_of_(\d+)(?:=.*)?")


class OtherKey(Exception):
    """The target is laid out by another key."""


def bucket_of(df: DataFrame, key: list[str], buckets: int, types: T.StructType) -> Column:
    """The bucket of a row; ``types`` are the target's, so that an int and a long meet."""
    for k in key:
        if isinstance(types[k].dataType, (T.FloatType, T.DoubleType)):
            raise TypeError(f"{k}: equal floating-point numbers can differ in their bits")
    values = [F.col(k).cast(types[k].dataType) for k in key]
    return F.pmod(F.xxhash64(*values), F.lit(buckets)).cast("int")


def _column(buckets: int) -> str:
    return f"_bucket_of_{buckets}"


def _home(spark: SparkSession, path: str) -> tuple[str, int] | None:
    """The newest version of a target and its number of buckets."""
    for version in reversed(inc._versions(spark, path)):
        home = f"{path}/version-{version:08d}"
        for name in inc._children(spark, home):
            found = DIRECTORY.fullmatch(name)
            if found:
                return home, int(found[1])
    return None


def _next_version(spark: SparkSession, path: str) -> str:
    used = [int(m[1]) for c in inc._children(spark, path) if (m := inc.VERSION.fullmatch(c))]
    return f"{path}/version-{max(used, default=0) + 1:08d}"


def exists(spark: SparkSession, path: str) -> bool:
    return _home(spark, path) is not None


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    home, buckets = _home(spark, path)
    return inc.read_target(spark, home).drop(_column(buckets))


def read_keys(spark: SparkSession, path: str, wanted: DataFrame, key: list[str]) -> DataFrame:
    """Rows of the target whose key is among the ``wanted``, from their buckets only."""
    home, buckets = _home(spark, path)
    target = inc.read_target(spark, home)
    keys = wanted.select(*key).distinct()
    touched = inc._values(
        keys.select(bucket_of(keys, key, buckets, target.schema).alias("b")), "b"
    )
    some = target.filter(inc._one_of(_column(buckets), touched))
    return some.join(keys, key, "left_semi").drop(_column(buckets))


def create_bucketed(
    df: DataFrame, path: str, key: list[str], buckets: int = BUCKETS
) -> DataFrame:
    """First load, or full rebuild into a new version."""
    spark = df.sparkSession
    column = _column(buckets)
    routed = df.withColumn(column, bucket_of(df, key, buckets, df.schema))
    inc.create(routed, _next_version(spark, path), column)
    return read_bucketed(spark, path) if exists(spark, path) else df.limit(0)


def merge_bucketed(
    source: DataFrame, path: str, key: list[str], buckets: int = BUCKETS
) -> DataFrame:
    """Upsert by key: one source row per key; new columns are appended, NULL in old rows.

    ``buckets`` counts for the first load only.
    """
    return _change(inc.merge, source, path, key, buckets)


def delete_insert_bucketed(
    source: DataFrame, path: str, key: list[str], buckets: int = BUCKETS
) -> DataFrame:
    """Delete target rows with a key of the source, then insert all source rows."""
    return _change(inc.delete_insert, source, path, key, buckets)


def _change(change, source: DataFrame, path: str, key: list[str], buckets: int) -> DataFrame:
    spark = source.sparkSession
    home = _home(spark, path)
    if home is None:
        if change is inc.merge:
            inc._require_unique(source, key)
        return create_bucketed(source, path, key, buckets)
    where, count = home
    _require_key(spark, where, key, count)
    types = inc.read_target(spark, where).schema
    column = _column(count)
    routed = source.withColumn(column, bucket_of(source, key, count, types))
    # the key decides the bucket, so no other directory can hold it
    change(routed, where, key, column, moves=False)
    return read_bucketed(spark, path)


def _require_key(spark: SparkSession, home: str, key: list[str], buckets: int) -> None:
    """One row tells whether the layout is by this key."""
    target = inc.read_target(spark, home)
    column = _column(buckets)
    missing = set(key) - set(target.columns)
    if missing:
        raise OtherKey(f"the target has no column {sorted(missing)}")
    right = bucket_of(target, key, buckets, target.schema) == F.col(column)
    some = target.limit(100).select(right.alias("right")).agg(F.min("right")).head()[0]
    if some is False:
        raise OtherKey(f"the target is not laid out by {key}")


def rebucket(spark: SparkSession, path: str, key: list[str], buckets: int) -> DataFrame:
    """Another number of buckets, in a new version; readers see the old one until it is done."""
    found = create_bucketed(read_bucketed(spark, path), path, key, buckets)
    inc.drop_old_versions(spark, path, keep=1)
    return found
