"""Scalar functions and staging."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faremill.functions.events import json_field
from faremill.functions.keys import row_id, surrogate_key as surrogate_key_of
from faremill.functions.numbers import DISTANCE, MONEY, safe_cast as safe_cast_of
from faremill.functions.times import (
    from_epoch_ms,
    hours_between,
    minutes_between,
    to_epoch_ms,
)
from faremill.operators.shape import in_years
from faremill.plans.stand_ins import FHV_SQL, STAGED_SQL, fhv_source, green_source, yellow_source
from faremill.plans.trips import (
    STAGED,
    dispatch_bases,
    stage_fhv,
    stage_green,
    stage_yellow,
    union_staged,
)
from faremill.registry import query
from faremill.sources.tables import load, plain


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return union_staged(
        stage_green(green_source(spark, sf_dir)), stage_yellow(yellow_source(spark, sf_dir))
    )


def doubles(*names: str) -> str:
    return ", ".join(f"CAST({n} AS DOUBLE) AS {n}" for n in names)


_DECIMALS = [n for n, t in STAGED.items() if t.startswith("decimal")]
STAGED_OUT = ", ".join(
    doubles(n) if n in _DECIMALS else n for n in [*STAGED, "service_type"]
)


@query(
    "F3 F8 F9 X9 P2 P5",
    f"""WITH {STAGED_SQL}
    SELECT {STAGED_OUT} FROM staged
    WHERE vendor_id IS NOT NULL AND year(pickup_datetime) IN (1996, 1997, 1999)
      AND trip_distance > 0 AND fare_amount > 0 AND tip_amount >= 0
      AND dropoff_datetime >= pickup_datetime""",
)
def staging_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid = (
        (F.col("trip_distance") > 0)
        & (F.col("fare_amount") > 0)
        & (F.col("tip_amount") >= 0)
        & (F.col("dropoff_datetime") >= F.col("pickup_datetime"))
    )
    trips = staged(spark, sf_dir).filter(in_years("pickup_datetime", [1996, 1997, 1999]))
    return plain(trips.filter(valid))


@query(
    "F3 P2",
    f"WITH {FHV_SQL} SELECT * FROM fhv WHERE dispatching_base_num IS NOT NULL",
)
def fhv_staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(stage_fhv(fhv_source(spark, sf_dir)))


@query(
    "X8",
    """SELECT o_orderkey, TRY_CAST(o_orderpriority AS INTEGER) AS whole_text,
              TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS first_digit
       FROM orders""",
)
def safe_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "orders").select(
        "o_orderkey",
        safe_cast_of("o_orderpriority", "int").alias("whole_text"),
        safe_cast_of(F.substring("o_orderpriority", 1, 1), "int").alias("first_digit"),
    )


@query(
    "X19 D1 P7",
    f"""WITH {FHV_SQL}, numbered AS (
      SELECT *, CAST(substr(dispatching_base_num, 2) AS BIGINT) AS n FROM fhv)
    SELECT CASE WHEN n IS NOT NULL THEN printf('%s/%03x',
             CASE WHEN n % 7 = 0 THEN 's' WHEN n % 3 = 0 THEN 'a' ELSE 'e' END, n) END AS base_id,
           CAST(pickup_datetime AS DATE) AS pickup_date,
           CAST(dropoff_datetime AS DATE) AS dropoff_date,
           CAST(pickup_location_id AS DOUBLE) AS PULocationID,
           CAST(dropoff_location_id AS DOUBLE) AS DOLocationID
    FROM numbered""",
)
def base_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dispatch_bases(fhv_source(spark, sf_dir))


@query(
    "X7",
    """SELECT event_id, epoch_us(ts) // 1000 AS sent_ms,
              make_timestamp(epoch_us(ts) // 1000 * 1000) AS sent_at
       FROM events""",
)
def epoch_ms(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events").select("event_id", to_epoch_ms("ts").alias("sent_ms"))
    return plain(events.withColumn("sent_at", from_epoch_ms("sent_ms")))


@query(
    "X17",
    """SELECT event_id, props ->> 'k' AS k, CAST(props ->> 'k' AS INTEGER) AS k_number,
              props ->> '@id' AS absent
       FROM events""",
)
def json_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "events").select(
        "event_id",
        json_field("props", "k").alias("k"),
        json_field("props", "k").cast("int").alias("k_number"),
        json_field("props", "@id").alias("absent"),
    )


@query(
    "X5 X6",
    f"""WITH {FHV_SQL}
    SELECT affiliated_base_num, pickup_datetime,
           date_diff('minute', pickup_datetime, dropoff_datetime) AS minutes,
           (floor(epoch(dropoff_datetime)) - floor(epoch(pickup_datetime))) / 3600.0 AS hours
    FROM fhv""",
)
def duration_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rides = fhv_source(spark, sf_dir)
    return plain(
        rides.select(
            F.col("Affiliated_base_number").alias("affiliated_base_num"),
            "pickup_datetime",
            minutes_between("pickup_datetime", "dropOff_datetime").alias("minutes"),
            hours_between("pickup_datetime", "dropOff_datetime").alias("hours"),
        )
    )


@query(
    "X15",
    f"""WITH {STAGED_SQL}
    SELECT md5(concat_ws('-', coalesce(CAST(vendor_id AS VARCHAR), '_null_'),
                 coalesce(CAST(pickup_datetime AS VARCHAR), '_null_'),
                 coalesce(CAST(pickup_location_id AS VARCHAR), '_null_'),
                 coalesce(CAST(ehail_fee AS VARCHAR), '_null_'),
                 coalesce(service_type, '_null_'))) AS trip_key,
           service_type
    FROM staged""",
)
def surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = surrogate_key_of(
        "vendor_id", "pickup_datetime", "pickup_location_id", "ehail_fee", "service_type"
    )
    return staged(spark, sf_dir).select(key.alias("trip_key"), "service_type")


@query(
    "X16",
    f"""WITH {STAGED_SQL}
    SELECT md5(service_type || CAST(pickup_datetime AS VARCHAR) || CAST(trip_distance AS VARCHAR)
               || CAST(fare_amount AS VARCHAR)) AS trip_key,
           md5(service_type || CAST(ehail_fee AS VARCHAR)) AS null_if_no_fee
    FROM staged""",
)
def row_id_md5(spark: SparkSession, sf_dir: str) -> DataFrame:
    distance, fare = F.col("trip_distance").cast(DISTANCE), F.col("fare_amount").cast(MONEY)
    return staged(spark, sf_dir).select(
        row_id("service_type", "pickup_datetime", distance, fare).alias("trip_key"),
        row_id("service_type", "ehail_fee").alias("null_if_no_fee"),
    )
