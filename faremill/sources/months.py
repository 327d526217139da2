"""Monthly file sets per service."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faremill.sources.files import read_parquet

# fixed values: source time columns of each service
PICKUP_COLUMN = {"yellow": "tpep_pickup_datetime", "green": "lpep_pickup_datetime"}
DROPOFF_COLUMN = {"yellow": "tpep_dropoff_datetime", "green": "lpep_dropoff_datetime"}


def months_covering(start: dt.date, end: dt.date) -> list[str]:
    """Months ``YYYY-MM`` that overlap ``[start, end)``; the start counts from day 1."""
    first = start.year * 12 + start.month - 1
    # the month of the last day before the end
    last_day = end - dt.timedelta(days=1)
    last = last_day.year * 12 + last_day.month - 1
    return [f"{m // 12:04d}-{m % 12 + 1:02d}" for m in range(first, last + 1)]


# fixed value: file name of one month of one service
MONTH_FILE = "{base}/{service}_tripdata_{month}.parquet"


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """Concatenate by column name; a column missing on one side becomes NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_months(
    spark: SparkSession,
    base: str,
    services: list[str],
    start: dt.date,
    end: dt.date,
    extracted_at: dt.datetime,
    layout: str = MONTH_FILE,
) -> DataFrame:
    """All months of all services in one frame with common time columns.

    Months of one service share a schema, so each service is a single scan over its path
    list. ``extracted_at`` is an argument, so that a rerun writes the same rows.
    """
    frames = []
    for service in services:
        paths = [
            layout.format(base=base.rstrip("/"), service=service, month=m)
            for m in months_covering(start, end)
        ]
        frames.append(
            read_parquet(spark, paths, options={"mergeSchema": "true"})
            .withColumnsRenamed(
                {
                    PICKUP_COLUMN[service]: "pickup_datetime",
                    DROPOFF_COLUMN[service]: "dropoff_datetime",
                }
            )
            .withColumn("taxi_type", F.lit(service))
        )
    return union_by_name(frames).withColumn(
        "extracted_at", F.lit(extracted_at.isoformat()).cast("timestamp")
    )
