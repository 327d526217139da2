"""Grouped reports. All of them are a single groupBy with map-side partial aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faremill.functions.numbers import average, total
from faremill.functions.times import month_date, to_day


def row_count(df: DataFrame, name: str = "row_count") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def max_value(df: DataFrame, col: str) -> Column:
    """The highest value as a constant, NULL for an empty frame.

    One row is fetched, so that comparisons with it reach the scan of another table. Times
    travel as integers, not as local clock times.
    """
    dtype, top = df.schema[col].dataType, F.max(col)
    if isinstance(dtype, T.TimestampType):
        return F.timestamp_micros(F.lit(df.agg(F.unix_micros(top)).head()[0]).cast("long"))
    return F.lit(df.agg(top.cast("string")).head()[0]).cast(dtype)


def count_by(df: DataFrame, *keys: str, name: str = "row_count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def distinct_count(df: DataFrame, col: str, name: str) -> DataFrame:
    """Exact distinct count: de-duplicated per task, then once more after one shuffle."""
    return df.agg(F.count_distinct(F.col(col)).alias(name))


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    return count_by(df, *keys, name="copies").filter(F.col("copies") > 1)


def revenue_name(measure: str) -> str:
    """Report column of a measure; the fare drops its suffix, the others keep their names."""
    return "revenue_monthly_" + ("fare" if measure == "fare_amount" else measure)


def monthly_revenue(
    df: DataFrame,
    zone: str,
    time: str,
    measures: list[str],
    unknown: str | None = None,
    service: str = "service_type",
    trip_key: str | None = None,
    zone_name: str = "revenue_zone",
) -> DataFrame:
    """Sums per zone, month and service, two averages and, with ``trip_key``, a trip count.

    With ``unknown`` the NULL zone is renamed before grouping, so NULLs and a real zone of
    that name form one group.
    """
    place = F.col(zone) if unknown is None else F.coalesce(F.col(zone), F.lit(unknown))
    types = {f.name: f.dataType for f in df.schema}
    sums = [total(m, types[m]).alias(revenue_name(m)) for m in measures]
    counts = [] if trip_key is None else [F.count(F.col(trip_key)).alias("total_monthly_trips")]
    return df.groupBy(
        place.alias(zone_name), month_date(time).alias("revenue_month"), F.col(service)
    ).agg(
        *sums,
        *counts,
        F.avg("passenger_count").alias("avg_monthly_passenger_count"),
        average("trip_distance", types["trip_distance"]).alias("avg_monthly_trip_distance"),
    )


def hourly_revenue(df: DataFrame, time: str, zone: str, amount: str) -> DataFrame:
    return df.groupBy(
        F.date_trunc("hour", F.col(time)).alias("hour"), F.col(zone).alias("zone")
    ).agg(total(amount).alias("amount"), F.count(F.lit(1)).alias("number_records"))


def daily_report(df: DataFrame, service: str, time: str) -> DataFrame:
    return df.groupBy(F.col(service), to_day(time).alias("pickup_date")).agg(
        F.count(F.lit(1)).alias("trip_count"),
        total("fare_amount").alias("total_fare_amount"),
        total("total_amount").alias("total_amount"),
        average("trip_distance").alias("avg_trip_distance"),
    )


def daily_trend(df: DataFrame, time: str, amount: str) -> DataFrame:
    """Revenue and volume per day, in day order (one small row per day)."""
    return (
        df.groupBy(to_day(time).alias("trip_date"))
        .agg(total(amount).alias("daily_revenue"), F.count(F.lit(1)).alias("trip_count"))
        .orderBy("trip_date")
    )


def bucket_average(df: DataFrame, x: str, y: str, bucket: str) -> DataFrame:
    """Mean of ``y`` per whole unit of ``x``, positive rows only, in bucket order."""
    return (
        df.filter((F.col(x) > 0) & (F.col(y) > 0))
        .groupBy(F.floor(F.col(x)).cast("long").alias(bucket))
        .agg(average(y).alias("avg_fare"), F.count(F.lit(1)).alias("trip_count"))
        .orderBy(bucket)
    )


def top_group(df: DataFrame, key: str, measure: Column, name: str) -> DataFrame:
    """The key with the highest value; the smaller key wins a tie."""
    ranked = df.groupBy(key).agg(measure.alias(name))
    return ranked.orderBy(F.col(name).desc_nulls_last(), F.col(key).asc()).limit(1)


def least_frequent(df: DataFrame, key: str, name: str = "pickup_count") -> DataFrame:
    """All keys that share the smallest count."""
    counts = count_by(df, key, name=name)
    return counts.filter(F.col(name) == counts.agg(F.min(name)).scalar())


def top_n(df: DataFrame, value: Column, name: str, n: int, *tie: str) -> DataFrame:
    """Highest ``n`` rows by a computed value; each task keeps ``n`` rows only."""
    order = [F.col(name).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in tie]]
    return df.withColumn(name, value).orderBy(*order).limit(n)


def rollup_report(report: DataFrame, where: Column, measure: str, name: str) -> DataFrame:
    """Re-aggregate an existing report."""
    return report.filter(where).agg(F.coalesce(F.sum(measure), F.lit(0)).cast("long").alias(name))
