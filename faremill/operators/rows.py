"""One row per key, and running totals."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faremill.session import remove, workspace


def dedup(
    df: DataFrame,
    keys: list[str],
    order: str | Column,
    keep: str = "first",
    ties: list[str | Column] | None = None,
) -> DataFrame:
    """One row per key: the lowest (``first``) or highest (``last``) in the stated order.

    Rows equal in the order column are settled by ``ties``, by default all other columns,
    so the survivor does not depend on task timing. NULLs of the order column come last
    either way.

    The ``= 1`` filter lets Spark keep one row per key in every map task before the shuffle
    (WindowGroupLimit), so a key with a third of all rows sends one row per task.
    """
    col = F.col(order) if isinstance(order, str) else order
    first = col.asc_nulls_last() if keep == "first" else col.desc_nulls_last()
    if ties is None:
        ties = [c for c in df.columns if c not in keys and c != order]
    rest = [(F.col(t) if isinstance(t, str) else t).asc_nulls_last() for t in ties]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(first, *rest))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def dedup_by_file(df: DataFrame, keys: list[str], ties: list[str]) -> DataFrame:
    """One row per key, from the alphabetically first source file; ``df`` must be a file scan."""
    named = df.withColumn("source_file", F.col("_metadata.file_name"))
    return dedup(named, keys, "source_file", "first", ties)


@contextmanager
def cut_in_ranges(
    df: DataFrame, by: list[str], order: list[str], pieces: int | None = None
) -> Iterator[DataFrame]:
    """The rows cut into ``pieces`` ranges of equal size along (group, order), as ``_piece``.

    ``pieces`` defaults to the session's shuffle partitions. The cut table is stored while it is
    in use: the boundaries come from a sample, and both readers of the pieces must see the same
    ones, also after a task is repeated.
    """
    spark = df.sparkSession
    count = pieces or int(spark.conf.get("spark.sql.shuffle.partitions"))
    along = [F.col(c).asc_nulls_last() for c in order]
    path = workspace(spark, "pieces")
    try:
        (
            df.repartitionByRange(count, *[F.col(c).asc() for c in by], *along)
            .withColumn("_piece", F.spark_partition_id())
            .write.parquet(path)
        )
        yield spark.read.parquet(path)
    finally:
        remove(spark, path)


def running(
    cut: DataFrame, by: list[str], order: list[str], value: str, name: str, kind: str = "sum"
) -> DataFrame:
    """Running ``sum`` or ``max`` of ``value`` per group over rows of ``cut_in_ranges``.

    From the group's first row to the current one. A plain window would sort a whole group in
    one task; here rows are folded inside their piece, and the result of the group's earlier
    pieces, of which there is one row each, is added. NULL values count as 0 in a sum and are
    passed over by a maximum, which is NULL until there is a value.
    """
    fold = {"sum": F.sum, "max": F.max}[kind]
    along = [F.col(c).asc_nulls_last() for c in order]
    parts = [*by, "_piece"]
    earlier = Window.partitionBy(*by).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        cut.groupBy(*parts)
        .agg(fold(value).alias("_folded"))
        .select(
            *[F.col(c).alias(f"_of_{c}") for c in parts],
            fold("_folded").over(earlier).alias("_before"),
        )
    )
    within = (
        Window.partitionBy(*parts)
        .orderBy(*along)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = cut.withColumn("_local", fold(value).over(within))
    # null-safe: a NULL group key is a group like any other
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in parts])
    both = [F.col("_before"), F.col("_local")]
    if kind == "sum":
        result = reduce(Column.__add__, [F.coalesce(c, F.lit(0)) for c in both])
    else:
        result = F.greatest(*both)
    return (
        local.join(offsets, same)
        .withColumn(name, result)
        .drop("_piece", "_local", "_before", *[f"_of_{c}" for c in parts])
    )


def running_total(
    df: DataFrame,
    by: list[str],
    order: list[str],
    value: str,
    name: str,
    pieces: int | None = None,
    path: str | None = None,
) -> DataFrame:
    """Running sum of ``value`` per group, written to ``path`` (by default a new folder)."""
    path = path or workspace(df.sparkSession, "running")
    with cut_in_ranges(df, by, order, pieces) as cut:
        result = running(cut, by, order, value, name)
        result.write.parquet(path)
    return df.sparkSession.read.schema(result.schema).parquet(path)
