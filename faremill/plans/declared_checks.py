"""The checks declared with each model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faremill.operators.quality import (
    Check,
    accepted_values,
    custom,
    expect_no_rows,
    non_negative,
    not_null,
    positive,
    primary_key,
    relationships,
    unique_combination,
)

SERVICES = ["Green", "Yellow"]


def cleaned_trips() -> list[Check]:
    return [
        *primary_key("trip_id"),
        *[not_null(c) for c in ("vendor_id", "service_type", "pickup_datetime", "total_amount")],
        accepted_values("service_type", SERVICES),
    ]


def fact_trips(zones: DataFrame) -> list[Check]:
    return [
        *cleaned_trips(),
        relationships("pickup_location_id", zones, "location_id"),
        relationships("dropoff_location_id", zones, "location_id"),
    ]


def monthly_zone_mart() -> list[Check]:
    return [
        unique_combination("pickup_zone", "revenue_month", "service_type"),
        *[
            not_null(c)
            for c in (
                "pickup_zone", "revenue_month", "service_type", "revenue_monthly_total_amount",
                "total_monthly_trips",
            )
        ],
        accepted_values("service_type", SERVICES),
    ]


def green_fact() -> list[Check]:
    """Codes are judged where recorded; any negative amount is a failure."""
    return [
        *primary_key("unique_row_id"),
        not_null("pickup_borough"),
        not_null("dropoff_borough"),
        accepted_values(
            "payment_type", [1, 2, 3, 4, 5, 6], where=F.col("payment_type").isNotNull()
        ),
        expect_no_rows(
            "positive_amounts",
            lambda df: df.filter((F.col("fare_amount") < 0) | (F.col("total_amount") < 0)),
        ),
    ]


def interval_staging() -> list[Check]:
    return [
        *primary_key("trip_id"),
        *[not_null(c) for c in ("taxi_type", "pickup_datetime", "dropoff_datetime")],
        *[non_negative(c) for c in ("trip_distance", "fare_amount", "total_amount")],
        custom(
            "no_negative_trip_duration", F.col("dropoff_datetime") < F.col("pickup_datetime")
        ),
    ]


def interval_report() -> list[Check]:
    measures = ("trip_count", "total_fare_amount", "total_amount", "avg_trip_distance")
    return [
        unique_combination("taxi_type", "pickup_date"),
        *[non_negative(c) for c in measures],
    ]


def payment_lookup() -> list[Check]:
    return [*primary_key("payment_type_id"), not_null("payment_type_name")]


def player_summary() -> list[Check]:
    return [positive("total_games")]
