"""Lookup, role-playing, outer and either-side joins.

Which side is sent to all tasks is Catalyst's choice by bytes, its threshold the session's.
``if_small`` is for callers with a threshold of their own. AQE splits skewed partitions.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faremill.session import workspace


def estimated_bytes(df: DataFrame) -> int:
    """The planner's own estimate from file sizes and projections; no job is run."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def is_small(df: DataFrame, most_bytes: int | None = None) -> bool:
    """Whether the estimate is within ``most_bytes``, by default the session's threshold."""
    if most_bytes is None:
        jvm = df.sparkSession._jsparkSession
        most_bytes = jvm.sessionState().conf().autoBroadcastJoinThreshold()
    return 0 <= estimated_bytes(df) <= most_bytes


def if_small(dim: DataFrame, most_bytes: int | None = None) -> DataFrame:
    """Hint a broadcast if the frame's estimated size allows it, otherwise leave it as it is."""
    return F.broadcast(dim) if is_small(dim, most_bytes) else dim


def code_table(spark: SparkSession, names: dict[int, str], key: str, value: str) -> DataFrame:
    """An in-code lookup as a frame. Hinted: its size is the literal dictionary's."""
    rows = spark.createDataFrame(list(names.items()), f"{key} int, {value} string")
    return F.broadcast(rows)


def join_lookup(df: DataFrame, dim: DataFrame, fk: str, pk: str, how: str = "inner") -> DataFrame:
    """Equi-join to a dimension. The dimension key takes the fact key's type once, on its side."""
    key_type = df.schema[fk].dataType
    keyed = dim.withColumn("_pk", F.col(pk).try_cast(key_type)).drop(pk)
    return df.join(keyed, df[fk] == keyed["_pk"], how).drop("_pk")


def enrich_roles(
    df: DataFrame, dim: DataFrame, pk: str, roles: dict[str, tuple[str, dict[str, str]]]
) -> DataFrame:
    """Left-join one dimension once per role.

    ``roles`` maps a role name to (foreign key, {dimension column: output column}).
    """
    for role, (fk, columns) in roles.items():
        key = f"_{role}_key"
        picked = dim.select(
            F.col(pk).alias(key), *[F.col(c).alias(out) for c, out in columns.items()]
        )
        df = df.join(picked, F.col(fk) == F.col(key), "left").drop(key)
    return df


def enrich_default(
    df: DataFrame,
    dim: DataFrame,
    fk: str,
    pk: str,
    label: str,
    out: str,
    default_key: int = 0,
    default_label: str = "Unknown",
) -> DataFrame:
    """Left join on a defaulted key; a code the lookup omits stays and gets the default label."""
    small = dim.select(F.col(pk).alias("_pk"), F.col(label).alias("_label"))
    return (
        df.withColumn(fk, F.coalesce(F.col(fk), F.lit(default_key)))
        .join(small, F.col(fk) == F.col("_pk"), "left")
        .withColumn(out, F.coalesce(F.col("_label"), F.lit(default_label)))
        .drop("_pk", "_label")
    )


def outer_compare(
    left: DataFrame, right: DataFrame, keys: list[str], prefixes: tuple[str, str]
) -> DataFrame:
    """Full outer join of two reports that are unique per key; measures are prefixed by side.

    Both sides come out of an aggregation on the same keys, so their partitioning is reused
    and no key holds more than one row per side.
    """

    def prefixed(df: DataFrame, prefix: str) -> DataFrame:
        return df.withColumnsRenamed({c: f"{prefix}{c}" for c in df.columns if c not in keys})

    return prefixed(left, prefixes[0]).join(prefixed(right, prefixes[1]), on=keys, how="full")


def either_side(df: DataFrame, sides: list[str], key: str) -> DataFrame:
    """One row per distinct participant: a row with the same value on both sides counts once."""
    return df.withColumn(key, F.explode(F.array_distinct(F.array(*sides)))).filter(
        F.col(key).isNotNull()
    )


def either_side_join(
    left: DataFrame, right: DataFrame, left_key: str, sides: list[str]
) -> DataFrame:
    """``left LEFT JOIN right ON key IN (side_a, side_b)`` without a nested loop.

    The sides are taken apart once, into a stored table of keyed rows: the join reads it, and
    the search for left rows without any match reads its key column only. Matches go through
    an inner equi-join, where AQE may split a hot key on either side. Both frames keep their
    columns, so a name that both have is an error.
    """
    both = sorted(set(left.columns) & set(right.columns))
    if both:
        raise ValueError(f"columns of both sides: {', '.join(both)}")
    keyed = either_side(right, sides, "_side")
    path = workspace(left.sparkSession, "either-side")
    keyed.write.parquet(path)
    keyed = left.sparkSession.read.schema(keyed.schema).parquet(path)
    matched = left.join(keyed, left[left_key] == keyed["_side"]).drop("_side")
    present = keyed.select("_side").distinct()
    alone = left.join(present, left[left_key] == present["_side"], "left_anti")
    return matched.unionByName(alone, allowMissingColumns=True)


def orphans(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    """Child keys without a parent and how many rows carry them; NULL keys are not judged.

    The child is reduced to its distinct keys first, so a hot key crosses the network once
    per task and not once per row.
    """
    keys = child.filter(F.col(fk).isNotNull()).groupBy(F.col(fk).alias("_fk"))
    counted = keys.agg(F.count(F.lit(1)).alias("child_rows"))
    known = parent.select(F.col(pk).alias("_pk"))
    return counted.join(known, F.col("_fk") == F.col("_pk"), "left_anti").withColumnRenamed(
        "_fk", fk
    )


# a filter of the child's keys is worth its while whatever the size of the parent's scan, and
# while the stored keys stay below this size; beyond it the join alone finds the keys
PARENT_FILTER = {
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "256m",
}


@contextmanager
def parent_filter(spark: SparkSession) -> Iterator[None]:
    """Plans made inside filter a join's large side with a Bloom filter of the other's keys."""
    before = {k: spark.conf.get(k, None) for k in PARENT_FILTER}
    for name, value in PARENT_FILTER.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value) if value is not None else spark.conf.unset(name)


def found_in_parent(keys: DataFrame, parent: DataFrame, pk: str) -> DataFrame:
    """The parent's keys among ``_fk`` of the stored ``keys``, to be planned in ``parent_filter``."""
    # always true for a counted key; Spark makes such a filter only from a side with a condition
    some = keys.filter(F.col("child_rows") >= 1).select("_fk")
    return parent.select(F.col(pk).alias("_pk")).join(some, F.col("_pk") == F.col("_fk"), "left_semi")


def orphans_of_large_parent(
    child: DataFrame, parent: DataFrame, fk: str, pk: str
) -> DataFrame:
    """``orphans`` for a parent that is larger than the child's keys.

    The child's distinct keys are stored; the parent's scan passes a Bloom filter of them, so of
    the parent only the rows wanted, and few others, are shuffled. A key that is too much for the
    filter's bounded size lets more rows pass, and the join removes them.
    """
    spark, base = child.sparkSession, workspace(child.sparkSession, "relationship")
    counted = child.filter(F.col(fk).isNotNull()).groupBy(F.col(fk).alias("_fk"))
    counted.agg(F.count(F.lit(1)).alias("child_rows")).write.parquet(f"{base}/keys")
    keys = spark.read.parquet(f"{base}/keys")
    with parent_filter(spark):
        found_in_parent(keys, parent, pk).distinct().write.parquet(f"{base}/found")
    found = spark.read.parquet(f"{base}/found")
    missing = keys.join(found, F.col("_fk") == F.col("_pk"), "left_anti")
    return missing.withColumnRenamed("_fk", fk)
