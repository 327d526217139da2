"""Plain writes: modes, file counts, directory layout, connector tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write(
    df: DataFrame,
    path: str,
    mode: str = "errorifexists",
    repartition: int | None = None,
    coalesce: int | None = None,
    partition_by: list[str] | None = None,
    cluster_by: list[str] | None = None,
    fmt: str = "parquet",
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Write and return a frame that reads the result.

    ``repartition`` fixes the number of files by a shuffle, which keeps the work before it
    parallel. ``coalesce`` avoids that shuffle, but pulls the preceding stage (an aggregation's
    merge, say) into as few tasks: only for results that are small all the way. With
    ``partition_by`` the rows of one directory are brought together; with ``cluster_by`` too
    each file holds a range of these columns, so that row-group statistics can skip data; see
    ``by_directory`` and ``by_range`` for hot directories. ``cluster_by`` alone sorts the files of
    each task. Only one of ``repartition``, ``coalesce`` and ``partition_by`` can decide how rows
    are dealt; more are an error.
    """
    if sum(map(bool, (repartition, coalesce, partition_by))) > 1:
        raise ValueError("choose one of repartition, coalesce and partition_by")
    if coalesce:
        df = df.coalesce(coalesce)
    elif partition_by:
        df = dealt(df, partition_by, cluster_by)
    elif repartition:
        df = df.repartition(repartition)
    if cluster_by and not partition_by:
        df = df.sortWithinPartitions(*cluster_by)
    writer = df.write.mode(mode).format(fmt).options(**(options or {}))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    reader = df.sparkSession.read.format(fmt).options(**(options or {}))
    # after an append the folder may hold columns this frame lacks: take the files' own schema
    return (reader if mode == "append" else reader.schema(df.schema)).load(path)


def by_directory(df: DataFrame, partition_by: list[str]) -> DataFrame:
    """Bring the rows of a directory together before a partitioned write.

    A rebalance, not a repartition: AQE splits a directory that is larger than the advisory
    partition size over several tasks and packs small ones into one, so neither a hot day
    nor thousands of tiny ones decide the run time.
    """
    return df.hint("rebalance", *partition_by)


def by_range(df: DataFrame, partition_by: list[str], cluster_by: list[str]) -> DataFrame:
    """Deal rows by ranges of (directory, cluster columns), sorted: the files of a directory
    hold ranges of the cluster columns that hardly overlap, and so do their row groups.

    A hash of the whole row comes last, so that rows alike in directory and cluster, be they a
    third of the table, are dealt to several tasks too. AQE packs small ranges together. The
    rows are computed once more for the sample that sets the bounds.
    """
    plain = [f.name for f in df.schema if not isinstance(f.dataType, T.MapType)]
    order = [F.col(c) for c in (*partition_by, *cluster_by)]
    return df.repartitionByRange(*order, F.xxhash64(*plain)).sortWithinPartitions(*order)


def dealt(df: DataFrame, partition_by: list[str], cluster_by: list[str] | None) -> DataFrame:
    """Rows as a partitioned write wants them: ``by_range`` if clustered, else ``by_directory``."""
    if cluster_by:
        return by_range(df, partition_by, cluster_by)
    return by_directory(df, partition_by).sortWithinPartitions(*partition_by)


def materialize(df: DataFrame, kind: str, name: str, path: str | None = None) -> DataFrame:
    """``view``: recomputed by every reader; ``table``: stored, replaced as a whole.

    Either way the result is known to SQL as ``name``.
    """
    if kind == "view":
        df.createOrReplaceTempView(name)
        return df
    if kind != "table" or path is None:
        raise ValueError("kind is 'view', or 'table' with a path")
    stored = write(df, path, "overwrite")
    stored.createOrReplaceTempView(name)
    return stored


def append(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Add rows; repeats are allowed and are removed by the reader's ``dedup``.

    With ``partition_by`` later readers of a window need not scan all that was ever appended.
    """
    return write(df, path, "append", partition_by=partition_by)


def write_months(df: DataFrame, path: str, time: str) -> DataFrame:
    """All months in one job, laid out as ``year=/month=``."""
    dated = df.withColumn("year", F.year(time)).withColumn("month", F.month(time))
    return write(dated, path, "overwrite", partition_by=["year", "month"])


def table_copy(df: DataFrame, path: str) -> DataFrame:
    return write(df, path, "overwrite")


def write_table(df: DataFrame, fmt: str, table: str, options: dict[str, str], mode: str) -> None:
    """Write through a connector (a warehouse or JDBC); the connector is a cluster package."""
    df.write.format(fmt).mode(mode).options(**connector_options(fmt, table, options)).save()


def connector_options(fmt: str, table: str, options: dict[str, str]) -> dict[str, str]:
    key = "dbtable" if fmt == "jdbc" else "table"
    return {**options, key: table}


def preview(df: DataFrame, n: int = 10) -> None:
    df.show(n, truncate=False)
