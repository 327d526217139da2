"""Incremental writers on plain Parquet.

Two kinds of target:

* a *partitioned* target (``partition`` names its directory column): only the directories the
  new rows belong to, and those that hold rows to be removed, are read and replaced, by dynamic
  partition overwrite, so the cost follows the increment and not the table. The replaced
  directories appear one after the other: a failure in between leaves some old and some new,
  and the same call again completes it;
* an *unpartitioned* target: each write stores a complete new version in a fresh directory
  below the target, and readers take the newest complete one. Spark cannot overwrite what it
  is reading, and a failed job leaves the previous version in place.

One writer at a time per target.
"""

from __future__ import annotations

import datetime as dt
import json
import re
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faremill.operators.aggregate import duplicate_keys, max_value
from faremill.operators.shape import in_interval
from faremill.operators.writers import by_range, dealt
from faremill.session import workspace

VERSION = re.compile(r"version-(\d{8})")
SCHEMA_FILE = "_schema.json"


class DuplicateKeys(Exception):
    """The source of a merge has several rows for one key."""


# --- target folders -------------------------------------------------------------------


def _fs(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def _children(spark: SparkSession, path: str) -> list[str]:
    fs, where = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Complete versions, oldest first."""
    found = []
    for name in _children(spark, path):
        m = VERSION.fullmatch(name)
        if m:
            fs, done = _fs(spark, f"{path}/{name}/_SUCCESS")
            if fs.exists(done):
                found.append(int(m.group(1)))
    return sorted(found)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a complete version, or a directory of a partitioned target. What a
    failed first write left behind is no target."""
    return bool(_versions(spark, path)) or any("=" in c for c in _children(spark, path))


def read_target(spark: SparkSession, path: str) -> DataFrame:
    """The current rows of a target of either kind."""
    versions = _versions(spark, path)
    if versions:
        return spark.read.parquet(f"{path}/version-{versions[-1]:08d}")
    schema = _known_schema(spark, path)
    return (spark.read if schema is None else spark.read.schema(schema)).parquet(path)


def _remember_schema(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Keep a partitioned target's columns beside its data.

    After a column was appended, old directories lack it; with the schema at hand readers
    need not merge the footers of all files to find it.
    """
    fs, where = _fs(spark, f"{path}/{SCHEMA_FILE}")
    out = fs.create(where, True)
    out.write(bytearray(schema.json().encode()))
    out.close()


def _known_schema(spark: SparkSession, path: str) -> T.StructType | None:
    fs, where = _fs(spark, f"{path}/{SCHEMA_FILE}")
    if not fs.exists(where):
        return None
    io = spark._jvm.java.io
    lines = io.BufferedReader(io.InputStreamReader(fs.open(where), "UTF-8"))
    text = lines.readLine()
    lines.close()
    return T.StructType.fromJson(json.loads(text))


def complete_folders(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """What follows ``prefix`` in the names of partitioned folders that are written to the end."""
    found = []
    for name in _children(spark, path):
        if name.startswith(prefix):
            inside = set(_children(spark, f"{path}/{name}"))
            if {"_SUCCESS", SCHEMA_FILE} <= inside:
                found.append(name.removeprefix(prefix))
    return sorted(found)


def commit(df: DataFrame, path: str) -> DataFrame:
    """Store a complete new version of an unpartitioned target."""
    spark = df.sparkSession
    used = [int(m.group(1)) for c in _children(spark, path) if (m := VERSION.fullmatch(c))]
    df.write.mode("errorifexists").parquet(f"{path}/version-{max(used, default=0) + 1:08d}")
    return read_target(spark, path)


def drop_old_versions(spark: SparkSession, path: str, keep: int = 2) -> None:
    for version in _versions(spark, path)[:-keep]:
        fs, old = _fs(spark, f"{path}/version-{version:08d}")
        fs.delete(old, True)


def _replace_partitions(
    df: DataFrame, path: str, partition: str, cluster_by: list[str] | None = None
) -> None:
    (
        dealt(df, [partition], cluster_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )
    _remember_schema(df.sparkSession, path, df.schema)


def _values(rows: DataFrame, partition: str) -> list:
    """The directories of these rows: calendar values, one per directory, no data."""
    return [r[0] for r in rows.select(partition).distinct().collect()]


def _one_of(partition: str, values: list) -> Column:
    """Filter for some directories, which Spark prunes by."""
    some = [v for v in values if v is not None]
    where = F.col(partition).isin(some) if some else F.lit(False)
    return where | F.col(partition).isNull() if None in values else where


def create(
    df: DataFrame,
    path: str,
    partition: str | None = None,
    cluster_by: list[str] | None = None,
    finish: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """First load, or full rebuild, of a target; ``cluster_by`` deals its rows to files by ranges.

    ``finish`` adds columns that follow from a row, such as a hashed id, after the rows are dealt:
    they are computed once, not for the sample of the ranges too, and are not shuffled.
    """
    finish = finish or (lambda rows: rows)
    if partition is None:
        return commit(finish(by_range(df, [], cluster_by) if cluster_by else df), path)
    rows = finish(dealt(df, [partition], cluster_by))
    rows.write.mode("overwrite").partitionBy(partition).parquet(path)
    _remember_schema(df.sparkSession, path, rows.schema)
    return read_target(df.sparkSession, path)


@contextmanager
def staged(source: DataFrame) -> Iterator[DataFrame]:
    """The increment, stored once: it is read for the key check, the anti join and the write.

    A recomputed source could differ between these reads; stored files cannot.
    """
    spark = source.sparkSession
    path = workspace(spark, "increment")
    try:
        source.write.parquet(path)
        yield spark.read.parquet(path)
    finally:
        fs, where = _fs(spark, path)
        fs.delete(where, True)


# --- strategies -----------------------------------------------------------------------


def _require_unique(source: DataFrame, key: list[str]) -> None:
    bad = duplicate_keys(source, *key).limit(1).collect()
    if bad:
        raise DuplicateKeys(f"several source rows for {bad[0].asDict()}")


def _without_keys(target: DataFrame, source: DataFrame, key: list[str]) -> DataFrame:
    return target.join(source.select(*key).distinct(), key, "left_anti")


def merge(
    source: DataFrame,
    path: str,
    key: list[str],
    partition: str | None = None,
    moves: bool = True,
    cluster_by: list[str] | None = None,
) -> DataFrame:
    """Upsert: rows whose key the source has are replaced, other target rows stay.

    New source columns are appended to the target, with NULL in old rows; the source must
    have one row per key. With ``partition`` a key may move to another directory: the key
    columns of the target are searched for where it was. ``moves=False`` spares that where the
    key decides the directory (a key hashed from the pickup time, say).
    """
    with staged(source) as rows:
        _require_unique(rows, key)
        return _swap_keys(rows, path, key, partition, moves, cluster_by)


def delete_insert(
    source: DataFrame,
    path: str,
    key: list[str],
    partition: str | None = None,
    moves: bool = True,
    cluster_by: list[str] | None = None,
) -> DataFrame:
    """Delete target rows with a key of the source, then insert all source rows.

    Unlike ``merge``, several source rows per key are kept.
    """
    with staged(source) as rows:
        return _swap_keys(rows, path, key, partition, moves, cluster_by)


def _swap_keys(
    source: DataFrame,
    path: str,
    key: list[str],
    partition: str | None,
    moves: bool,
    cluster_by: list[str] | None,
) -> DataFrame:
    spark = source.sparkSession
    if not exists(spark, path):
        return create(source, path, partition, cluster_by)
    target = read_target(spark, path)
    if partition is None:
        kept = _without_keys(target, source, key)
        return create(kept.unionByName(source, allowMissingColumns=True), path, None, cluster_by)
    directories = _values(source, partition)
    if moves:
        columns = target.select(*dict.fromkeys([*key, partition]))
        left = columns.join(source.select(*key).distinct(), key, "left_semi")
        directories = [*directories, *(v for v in _values(left, partition) if v not in directories)]
    kept = _without_keys(target.filter(_one_of(partition, directories)), source, key)
    rows = kept.unionByName(source, allowMissingColumns=True)
    _replace_and_empty(rows, path, partition, directories, cluster_by)
    return read_target(spark, path)


def _replace_and_empty(
    rows: DataFrame, path: str, partition: str, directories: list, cluster_by: list[str] | None
) -> None:
    """Replace these directories by ``rows``; those without any rows left are removed.

    Which of them got rows is told by their files afterwards, so the rows are computed once.
    """
    spark = rows.sparkSession
    names = [_directory(spark, partition, value) for value in directories]
    before = {n: set(_children(spark, f"{path}/{n}")) for n in names}
    _replace_partitions(rows, path, partition, cluster_by)
    for name, files in before.items():
        if files and set(_children(spark, f"{path}/{name}")) == files:
            fs, empty = _fs(spark, f"{path}/{name}")
            fs.delete(empty, True)


def _directory(spark: SparkSession, partition: str, value: object) -> str:
    names = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    text = names.DEFAULT_PARTITION_NAME() if value is None else names.escapePathName(str(value))
    return f"{partition}={text}"


def replace_interval(
    source: DataFrame,
    path: str,
    time: str,
    start: dt.datetime | dt.date,
    end: dt.datetime | dt.date,
    granularity: str = "timestamp",
    partition: str | None = None,
    cluster_by: list[str] | None = None,
) -> DataFrame:
    """Delete target rows with ``time`` in ``[start, end)``, then insert the source's rows of it.

    A window without new rows still empties the target there; source rows outside the window
    are left out, and no target row outside it goes, whatever the layout: the directories that
    are replaced are those of the fresh rows and of the target's rows inside the window, and
    their other rows are written back. A date key needs bounds at midnight: part of a day
    would otherwise replace the whole day. A ``partition`` of dates holds the start of the
    day, week, month, quarter or year of ``time``; see ``_around``.
    """
    if granularity == "date":
        for bound in (start, end):
            if isinstance(bound, dt.datetime) and bound.time() != dt.time(0):
                raise ValueError("a date key needs an interval from midnight to midnight")
    inside = in_interval(time, start, end)
    with staged(source.filter(inside)) as fresh:
        spark = fresh.sparkSession
        if not exists(spark, path):
            return create(fresh, path, partition, cluster_by)
        target = read_target(spark, path)
        outside = ~F.coalesce(inside, F.lit(False))
        if partition is None:
            rows = target.filter(outside).unionByName(fresh, allowMissingColumns=True)
            return create(rows, path, None, cluster_by)
        left = target.filter(_around(target, partition, start, end) & inside)
        directories = list(dict.fromkeys([*_values(fresh, partition), *_values(left, partition)]))
        rest = target.filter(_one_of(partition, directories) & outside)
        rows = rest.unionByName(fresh, allowMissingColumns=True)
        _replace_and_empty(rows, path, partition, directories, cluster_by)
        return read_target(spark, path)


def _around(
    target: DataFrame, partition: str, start: dt.date, end: dt.date, unit: str | None = None
) -> Column:
    """The directories that can hold rows of a window.

    A date that is the start of a row's day, week, month, quarter or year is not after the
    row, and not before the year's start or six days before it. With ``unit`` the start of
    that unit is the lower bound. Other types of directories are all taken.
    """
    if not isinstance(target.schema[partition].dataType, T.DateType):
        return F.lit(True)
    step = dt.datetime.resolution if isinstance(end, dt.datetime) else dt.date.resolution
    first, last = (d.date() if isinstance(d, dt.datetime) else d for d in (start, end - step))
    lower = F.trunc(F.lit(first), unit) if unit else F.date_sub(F.trunc(F.lit(first), "year"), 6)
    if unit == "day":
        lower = F.lit(first)
    return F.col(partition).between(lower, F.lit(last))


def within(
    target: DataFrame,
    time: str,
    start: dt.date,
    end: dt.date,
    partition: str,
    unit: str | None = None,
) -> DataFrame:
    """Rows of a partitioned target with ``time`` in ``[start, end)``, from directories around it.

    A filter on the time alone would open every directory: Spark does not know that the
    directory column comes from it. ``unit`` states what it holds the start of; without it
    the directories since the year began are opened.
    """
    return target.filter(_around(target, partition, start, end, unit) & in_interval(time, start, end))


def incremental_slice(
    df: DataFrame,
    target: DataFrame | None,
    col: str,
    full_refresh: bool = False,
    lookback: dt.timedelta | None = None,
) -> DataFrame:
    """Rows newer than the newest target row; everything without a target or on full refresh.

    The newest value is fetched first, one row, and becomes a constant: so the filter reaches
    the scan, also through the cast of a zone-less column. It is strict: rows equal to the
    newest, and late ones, are left out unless ``lookback`` moves the bound back; an existing
    but empty target lets nothing pass.
    """
    if target is None or full_refresh:
        return df
    newest = max_value(target, col)
    if lookback is not None:
        newest = newest - F.make_dt_interval(secs=F.lit(lookback.total_seconds()))
    return df.filter(F.col(col) > newest)


def newest_partition(spark: SparkSession, path: str, partition: str) -> DataFrame:
    """The latest directory only: enough to find the newest row of a date-partitioned target."""
    prefix = f"{partition}="
    values = sorted(c.removeprefix(prefix) for c in _children(spark, path) if c.startswith(prefix))
    target = read_target(spark, path)
    real = [v for v in values if not v.startswith("__")]
    return target.filter(F.col(partition) == F.lit(real[-1])) if real else target
