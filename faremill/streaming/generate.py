"""Ride events as a Spark job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LATE_SHARE = 0.2
LATE_SECONDS = (3, 10)


def make_events(
    spark: SparkSession,
    n: int,
    zones: list[int],
    start_ms: int,
    every_ms: int = 500,
    late_share: float = LATE_SHARE,
    seed: int = 42,
) -> DataFrame:
    """``n`` ride events between ``zones``, one per ``every_ms``; a share happened some seconds
    before it is sent."""

    def uniform(i: int, low: float, high: float):
        return F.round(F.rand(seed + i) * (high - low) + low, 2)

    def pick(i: int):
        pool = F.array(*[F.lit(z) for z in zones])
        return F.element_at(pool, (F.floor(F.rand(seed + i) * len(zones)) + 1).cast("int"))

    low, high = LATE_SECONDS
    lateness = F.when(
        F.rand(seed) < late_share,
        F.floor(F.rand(seed + 1) * (high - low + 1) + low).cast("long"),
    ).otherwise(F.lit(0))
    sent = F.lit(start_ms) + F.col("id") * every_ms
    return (
        spark.range(n)
        .withColumn("late_seconds", lateness)
        .select(
            pick(2).alias("PULocationID"),
            pick(3).alias("DOLocationID"),
            uniform(4, 0.5, 20.0).alias("trip_distance"),
            uniform(5, 5.0, 100.0).alias("total_amount"),
            (sent - F.col("late_seconds") * 1000).alias("tpep_pickup_datetime"),
            sent.alias("sent_ms"),
        )
    )
