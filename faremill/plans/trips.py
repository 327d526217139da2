"""Trip models: staging, union, cleaning, dimensions, fact table, marts.

Plain functions from frames to frames; the caller decides which results are stored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faremill.functions.codes import base_code, payment_label, vendor_label
from faremill.functions.keys import row_id, surrogate_key
from faremill.functions.numbers import DISTANCE, MONEY
from faremill.functions.times import minutes_between
from faremill.operators.aggregate import daily_report, hourly_revenue, monthly_revenue
from faremill.operators.joins import enrich_default, enrich_roles, join_lookup, outer_compare
from faremill.operators.partials import Report, monthly_revenue_report
from faremill.operators.rows import dedup
from faremill.operators.shape import (
    align,
    cast_as,
    drop_columns,
    in_interval,
    in_years,
    sample_window,
    union_services,
    where_present,
)

# fixed values: source column -> common column, per service
GREEN_TIMES = {
    "lpep_pickup_datetime": "pickup_datetime",
    "lpep_dropoff_datetime": "dropoff_datetime",
}
YELLOW_TIMES = {
    "tpep_pickup_datetime": "pickup_datetime",
    "tpep_dropoff_datetime": "dropoff_datetime",
}
COMMON_NAMES = {
    "VendorID": "vendor_id",
    "RatecodeID": "rate_code_id",
    "PULocationID": "pickup_location_id",
    "DOLocationID": "dropoff_location_id",
}

# staged trip: column -> type, in output order
STAGED = {
    "vendor_id": "int",
    "rate_code_id": "int",
    "pickup_location_id": "int",
    "dropoff_location_id": "int",
    "pickup_datetime": "timestamp",
    "dropoff_datetime": "timestamp",
    "store_and_fwd_flag": "string",
    "passenger_count": "int",
    "trip_distance": DISTANCE,
    "trip_type": "int",
    "fare_amount": MONEY,
    "extra": MONEY,
    "mta_tax": MONEY,
    "tip_amount": MONEY,
    "tolls_amount": MONEY,
    "ehail_fee": MONEY,
    "improvement_surcharge": MONEY,
    "total_amount": MONEY,
    "payment_type": "int",
}
READ_SAFELY = {"rate_code_id", "trip_type", "payment_type"}

# summed by the mart over the fact table
MART_MEASURES = [
    "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "ehail_fee",
    "improvement_surcharge", "total_amount",
]
# summed by the report over the unified raw services
ZONE_ID_MEASURES = [
    "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge",
    "total_amount", "congestion_surcharge",
]


# --- staging --------------------------------------------------------------------------


def _stage(
    df: DataFrame, times: dict[str, str], window: tuple | None, columns: dict[str, str] = STAGED
) -> DataFrame:
    named = where_present(df.withColumnsRenamed({**times, **COMMON_NAMES}), "vendor_id")
    typed = cast_as(named, columns, READ_SAFELY).select(*columns)
    return sample_window(typed, "pickup_datetime", window)


def stage_green(df: DataFrame, window: tuple | None = None) -> DataFrame:
    return _stage(df, GREEN_TIMES, window)


def stage_yellow(df: DataFrame, window: tuple | None = None) -> DataFrame:
    """Yellow has neither trip type (all are street hails, 1) nor an e-hail fee (NULL)."""
    aligned = align(df, {"trip_type": (1, "int"), "ehail_fee": (None, MONEY)})
    return _stage(aligned, YELLOW_TIMES, window)


def stage_fhv(df: DataFrame) -> DataFrame:
    """For-hire trips: rows without a dispatching base are dropped, names unified."""
    return where_present(df, "dispatching_base_num").select(
        "dispatching_base_num",
        F.col("Affiliated_base_number").alias("affiliated_base_num"),
        F.col("PUlocationID").try_cast("int").alias("pickup_location_id"),
        F.col("DOlocationID").try_cast("int").alias("dropoff_location_id"),
        "pickup_datetime",
        F.col("dropOff_datetime").alias("dropoff_datetime"),
        F.col("SR_Flag").alias("sr_flag"),
    )


def dispatch_bases(df: DataFrame) -> DataFrame:
    """Class code of the dispatching base and the calendar days of each ride."""
    return df.select(
        base_code("dispatching_base_num").alias("base_id"),
        F.to_date("pickup_datetime").alias("pickup_date"),
        F.to_date("dropoff_datetime").alias("dropoff_date"),
        F.col("PULocationID").alias("PULocationID"),
        F.col("DOLocationID").alias("DOLocationID"),
    )


def union_staged(green: DataFrame, yellow: DataFrame) -> DataFrame:
    return union_services({"Green": green, "Yellow": yellow})


def union_raw(green: DataFrame, yellow: DataFrame) -> DataFrame:
    """Both raw services over their shared columns, time columns renamed first."""
    return union_services(
        {
            "green": green.withColumnsRenamed(GREEN_TIMES),
            "yellow": yellow.withColumnsRenamed(YELLOW_TIMES),
        }
    )


# --- cleaned trips, dimensions, facts -------------------------------------------------

TRIP_KEY = ["vendor_id", "pickup_datetime", "pickup_location_id", "service_type"]
# settles rows that agree in key and dropoff time
TRIP_TIES = [
    "total_amount", "fare_amount", "trip_distance", "dropoff_location_id", "passenger_count",
    "payment_type", "rate_code_id", "trip_type", "store_and_fwd_flag", "extra", "mta_tax",
    "tip_amount", "tolls_amount", "ehail_fee", "improvement_surcharge",
]


def clean_trips(unioned: DataFrame, payments: DataFrame, years: list[int]) -> DataFrame:
    """Trips of the given years, one per key (earliest dropoff), with key and payment label.

    Labels are joined after the dedup, on the rows that remain.
    """
    kept = dedup(
        unioned.filter(in_years("pickup_datetime", years)),
        TRIP_KEY, "dropoff_datetime", "first", TRIP_TIES,
    )
    labelled = enrich_default(
        kept, payments, "payment_type", "payment_type", "description", "payment_type_description"
    )
    return labelled.withColumn("trip_id", surrogate_key(*TRIP_KEY))


def dim_zones(zones: DataFrame) -> DataFrame:
    return zones.select(
        F.col("LocationID").cast("int").alias("location_id"),
        F.col("Borough").alias("borough"),
        F.col("Zone").alias("zone"),
        "service_zone",
    )


def dim_vendors(unioned: DataFrame) -> DataFrame:
    return unioned.select("vendor_id").distinct().withColumn(
        "vendor_name", vendor_label("vendor_id")
    )


ROLES = {
    "pickup": ("pickup_location_id", {"borough": "pickup_borough", "zone": "pickup_zone"}),
    "dropoff": ("dropoff_location_id", {"borough": "dropoff_borough", "zone": "dropoff_zone"}),
}

# fixed values: output contract of the fact table
FACT_TYPES = {
    "trip_id": "string",
    "vendor_id": "int",
    "service_type": "string",
    "rate_code_id": "int",
    "pickup_location_id": "int",
    "pickup_borough": "string",
    "pickup_zone": "string",
    "dropoff_location_id": "int",
    "dropoff_borough": "string",
    "dropoff_zone": "string",
    "pickup_datetime": "timestamp",
    "dropoff_datetime": "timestamp",
    "store_and_fwd_flag": "string",
    "passenger_count": "int",
    "trip_distance": DISTANCE,
    "trip_type": "int",
    "trip_duration_minutes": "bigint",
    "fare_amount": MONEY,
    "extra": MONEY,
    "mta_tax": MONEY,
    "tip_amount": MONEY,
    "tolls_amount": MONEY,
    "ehail_fee": MONEY,
    "improvement_surcharge": MONEY,
    "total_amount": MONEY,
    "payment_type": "int",
    "payment_type_description": "string",
}


def fact_contract() -> T.StructType:
    return T.StructType.fromDDL(", ".join(f"{n} {t}" for n, t in FACT_TYPES.items()))


def fact_trips(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Trips with borough and zone of both ends; an unknown zone keeps the trip."""
    timed = trips.withColumn(
        "trip_duration_minutes", minutes_between("pickup_datetime", "dropoff_datetime")
    )
    return enrich_roles(timed, zones, "location_id", ROLES).select(*FACT_TYPES)


# what identifies a source row of the green-only fact
ROW_KEY = [
    "vendor_id", "pickup_datetime", "dropoff_datetime", "pickup_location_id",
    "dropoff_location_id", "fare_amount", "trip_distance",
]

# fixed values: columns of the green-only fact
GREEN_FACT = [
    "unique_row_id", "vendor_id", "pickup_datetime", "dropoff_datetime", "rate_code_id",
    "trip_type", "pickup_location_id", "pickup_borough", "pickup_zone", "dropoff_location_id",
    "dropoff_borough", "dropoff_zone", "passenger_count", "trip_distance", "fare_amount", "extra",
    "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge", "congestion_surcharge",
    "total_amount", "payment_type", "payment_type_description",
]


def green_rows(df: DataFrame, order: str | None = None) -> DataFrame:
    """Staged green trips, one per row id; repeats are settled by ``order``, e.g. the file name."""
    columns = {**STAGED, "congestion_surcharge": MONEY}
    if order is not None:
        columns[order] = "string"
    ties = [c for c in columns if c not in ROW_KEY]
    # by the id's parts, not by its text: cheaper to sort, and only kept rows are hashed
    kept = dedup(
        _stage(df, GREEN_TIMES, None, columns), ROW_KEY, order or ties[0], "first", ties
    )
    # a missing code is a gap of the records, not an error: it stays NULL
    return with_row_id(kept).withColumn("payment_type_description", payment_label("payment_type"))


def with_row_id(rows: DataFrame) -> DataFrame:
    return rows.withColumn("unique_row_id", surrogate_key(*ROW_KEY))


def green_fact(rows: DataFrame, zones: DataFrame) -> DataFrame:
    """Green-only fact: positive distance and fare, day column for the directory layout."""
    paid = rows.filter((F.col("trip_distance") > 0) & (F.col("fare_amount") > 0))
    return (
        enrich_roles(paid, zones, "location_id", ROLES)
        .select(*GREEN_FACT)
        .withColumn("pickup_day", F.to_date("pickup_datetime"))
    )


# --- marts ----------------------------------------------------------------------------


def monthly_zone_mart(fact: DataFrame) -> DataFrame:
    return monthly_revenue(
        fact, "pickup_zone", "pickup_datetime", MART_MEASURES, unknown="Unknown Zone",
        trip_key="trip_id", zone_name="pickup_zone",
    )


def monthly_zone_mart_report() -> Report:
    """The same mart, to be kept up to date from the parts of increments."""
    return monthly_revenue_report(
        "pickup_zone", "pickup_datetime", MART_MEASURES, unknown="Unknown Zone",
        trip_key="trip_id", zone_name="pickup_zone",
    )


def monthly_zone_id_report(unioned: DataFrame) -> DataFrame:
    return monthly_revenue(unioned, "PULocationID", "pickup_datetime", ZONE_ID_MEASURES)


def hourly_comparison(
    green: DataFrame, yellow: DataFrame, green_time: str, yellow_time: str, since: str
) -> DataFrame:
    """Hourly revenue of both services side by side; each side is aggregated before the join."""

    def report(df: DataFrame, time: str) -> DataFrame:
        recent = df.filter(F.col(time) >= F.lit(since).cast("timestamp"))
        return hourly_revenue(recent, time, "PULocationID", "total_amount")

    return outer_compare(
        report(green, green_time), report(yellow, yellow_time), ["hour", "zone"],
        ("green_", "yellow_"),
    )


def comparison_with_zones(compared: DataFrame, zones: DataFrame) -> DataFrame:
    """Zone id replaced by the lookup's columns; hours of an unknown zone drop out."""
    joined = join_lookup(compared.withColumnRenamed("zone", "_id"), zones, "_id", "LocationID")
    return drop_columns(joined, ["_id"])


# --- interval-refreshed tables --------------------------------------------------------

COPY_KEY = ["taxi_type", "pickup_datetime", "dropoff_datetime", "trip_distance", "fare_amount"]
COPY_TIES = ["total_amount", "passenger_count"]


def interval_staging(ingested: DataFrame, start: object, end: object) -> DataFrame:
    """One window of ingested trips: newest copy of each trip, valid rows only, hashed id."""
    window = ingested.filter(in_interval("pickup_datetime", start, end))
    latest = dedup(window, COPY_KEY, "extracted_at", "last", COPY_TIES)
    valid = latest.filter(
        (F.col("dropoff_datetime") >= F.col("pickup_datetime"))
        & (F.col("trip_distance") >= 0)
        & (F.col("fare_amount") >= 0)
        & (F.col("total_amount") >= 0)
    )
    key = row_id(
        "taxi_type", "pickup_datetime", "dropoff_datetime",
        F.col("trip_distance").cast(DISTANCE), F.col("fare_amount").cast(MONEY),
    )
    return valid.select(
        key.alias("trip_id"), "taxi_type", "pickup_datetime", "dropoff_datetime",
        "passenger_count", "trip_distance", "fare_amount", "total_amount",
    )


def interval_report(staged: DataFrame, start: object, end: object) -> DataFrame:
    window = staged.filter(in_interval("pickup_datetime", start, end))
    return daily_report(window, "taxi_type", "pickup_datetime")
