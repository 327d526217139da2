"""Revenue and volume reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faremill.functions.numbers import total
from faremill.functions.times import hours_between
from faremill.operators.aggregate import (
    bucket_average as bucket_average_of,
    count_by,
    daily_report,
    daily_trend as daily_trend_of,
    hourly_revenue as hourly_revenue_of,
    least_frequent,
    revenue_name,
    rollup_report,
    top_group,
    top_n,
)
from faremill.operators import partials
from faremill.operators.joins import enrich_roles, join_lookup
from faremill.operators.shape import between_dates
from faremill.plans.scalars_queries import staged
from faremill.plans.stand_ins import (
    FHV_SQL,
    GREEN_SQL,
    INGESTED_SQL,
    STAGED_SQL,
    YELLOW_SQL,
    ZONES_SQL,
    fhv_source,
    green_source,
    hour_source,
    ingested_source,
    yellow_source,
    zone_source,
)
from faremill.plans.trips import (
    MART_MEASURES,
    ZONE_ID_MEASURES,
    comparison_with_zones,
    dim_zones,
    hourly_comparison,
    monthly_zone_id_report,
    monthly_zone_mart,
    monthly_zone_mart_report,
    union_raw,
)
from faremill.registry import query
from faremill.session import workspace
from faremill.sources.tables import load, plain


def _money_sums(measures: list[str]) -> str:
    return ", ".join(
        f"CAST(CAST(sum(CAST({m} AS DECIMAL(38,9))) AS VARCHAR) AS DOUBLE) AS {revenue_name(m)}" for m in measures
    )


_AVERAGES = """
  CAST(sum(passenger_count) AS DOUBLE) / count(passenger_count) AS avg_monthly_passenger_count,
  CAST(CAST(sum(CAST(trip_distance AS DECIMAL(38,9))) AS VARCHAR) AS DOUBLE) / count(trip_distance)
    AS avg_monthly_trip_distance"""

_RAW_SQL = f"""{GREEN_SQL}, {YELLOW_SQL},
raw_trips AS (
  SELECT 'green' AS service_type, VendorID, pickup_datetime, dropoff_datetime, store_and_fwd_flag,
         RatecodeID, PULocationID, DOLocationID, passenger_count, trip_distance, fare_amount, extra,
         mta_tax, tip_amount, tolls_amount, improvement_surcharge, total_amount, payment_type,
         congestion_surcharge FROM green_raw
  UNION ALL
  SELECT 'yellow', VendorID, pickup_datetime, dropoff_datetime, store_and_fwd_flag,
         RatecodeID, PULocationID, DOLocationID, passenger_count, trip_distance, fare_amount, extra,
         mta_tax, tip_amount, tolls_amount, improvement_surcharge, total_amount, payment_type,
         congestion_surcharge FROM yellow_raw
)"""


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return union_raw(green_source(spark, sf_dir), yellow_source(spark, sf_dir))


@query("P2 P3 P4 U1", f"WITH {_RAW_SQL} SELECT * FROM raw_trips")
def union_services(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(_raw(spark, sf_dir))


@query(
    "A2 A10",
    f"WITH {_RAW_SQL} SELECT service_type, count(*) AS row_count FROM raw_trips GROUP BY 1",
)
def service_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_by(_raw(spark, sf_dir), "service_type")


@query(
    "A3 A18 X1",
    f"""WITH {_RAW_SQL}
    SELECT PULocationID AS revenue_zone, CAST(date_trunc('month', pickup_datetime) AS DATE)
             AS revenue_month, service_type, {_money_sums(ZONE_ID_MEASURES)}, {_AVERAGES}
    FROM raw_trips GROUP BY 1, 2, 3""",
)
def monthly_zone_revenue_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly_zone_id_report(_raw(spark, sf_dir))


_MART_SQL = f"""{STAGED_SQL}, {ZONES_SQL},
mart AS (
  SELECT coalesce(zone, 'Unknown Zone') AS pickup_zone,
         CAST(date_trunc('month', pickup_datetime) AS DATE) AS revenue_month, service_type,
         {_money_sums(MART_MEASURES)}, count(service_type) AS total_monthly_trips, {_AVERAGES}
  FROM staged LEFT JOIN zones ON pickup_location_id = location_id
  GROUP BY 1, 2, 3
)"""


def _named_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    pickup = {"pickup": ("pickup_location_id", {"zone": "pickup_zone"})}
    zones = dim_zones(zone_source(spark, sf_dir))
    named = enrich_roles(staged(spark, sf_dir), zones, "location_id", pickup)
    return named.withColumn("trip_id", F.col("service_type"))


def _mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly_zone_mart(_named_trips(spark, sf_dir))


@query("A4 A10 X2 J3", f"WITH {_MART_SQL} SELECT * FROM mart")
def monthly_zone_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mart(spark, sf_dir)


@query("A4 A18 K10", f"WITH {_MART_SQL} SELECT * FROM mart")
def monthly_zone_revenue_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart after three increments, one of them repeated; each reads its own trips only, and
    the months it touches are made anew from parts."""
    base = workspace(spark, "mart-parts")
    report, trips = monthly_zone_mart_report(), _named_trips(spark, sf_dir)
    early = F.col("pickup_datetime") < F.lit("1998-03-10").cast("timestamp")
    green = F.col("service_type") == "Green"
    for name, some in (
        ("first", early), ("green", ~early & green), ("rest", ~early & ~green), ("green", ~early & green),
    ):
        months = partials.add_increment(report, trips.filter(some), f"{base}/parts", name)
        mart = partials.refresh_report(spark, report, f"{base}/parts", f"{base}/mart", months)
    return mart


@query(
    "A20",
    f"""WITH {_MART_SQL}
    SELECT CAST(coalesce(sum(total_monthly_trips), 0) AS BIGINT) AS trips FROM mart
    WHERE service_type = 'Green' AND revenue_month = DATE '1999-10-01'""",
)
def report_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    october = F.col("revenue_month") == F.lit("1999-10-01").cast("date")
    green = F.col("service_type") == "Green"
    return rollup_report(_mart(spark, sf_dir), green & october, "total_monthly_trips", "trips")


@query(
    "A19 O2",
    f"""WITH {GREEN_SQL}, {ZONES_SQL}
    SELECT zone, CAST(CAST(sum(CAST(total_amount AS DECIMAL(38,9))) AS VARCHAR) AS DOUBLE) AS revenue
    FROM green_raw JOIN zones ON PULocationID = location_id
    WHERE year(pickup_datetime) = 1998
    GROUP BY zone ORDER BY revenue DESC, zone LIMIT 1""",
)
def top_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    green = green_source(spark, sf_dir).filter(
        between_dates("lpep_pickup_datetime", "1998-01-01", "1998-12-31")
    )
    zones = dim_zones(zone_source(spark, sf_dir)).select("location_id", "zone")
    return top_group(
        join_lookup(green, zones, "PULocationID", "location_id"), "zone",
        total("total_amount"), "revenue",
    )


# two services with real hours: one third of the event kinds each, errors belong to neither
GREEN_KINDS = ["view", "click"]
YELLOW_KINDS = ["signup", "purchase"]
SINCE = "2024-01-02 00:00:00"


def _hours_sql(name: str, kinds: list[str]) -> str:
    quoted = ", ".join(f"'{k}'" for k in kinds)
    return f"""
{name} AS (
  SELECT date_trunc('hour', ts) AS hour, CAST(user_id % 27 AS INTEGER) AS zone,
         CAST(CAST(sum(CAST(value AS DECIMAL(38,9))) AS VARCHAR) AS DOUBLE) AS amount, count(*) AS number_records
  FROM events WHERE event_type IN ({quoted}) AND ts >= TIMESTAMP '{SINCE}'
  GROUP BY 1, 2
)"""


_GREEN_HOURS, _YELLOW_HOURS = _hours_sql("g", GREEN_KINDS), _hours_sql("y", YELLOW_KINDS)
_COMPARED_SQL = f"""{_GREEN_HOURS}, {_YELLOW_HOURS},
compared AS (
  SELECT hour, zone, g.amount AS green_amount, g.number_records AS green_number_records,
         y.amount AS yellow_amount, y.number_records AS yellow_number_records
  FROM g FULL JOIN y USING (hour, zone)
)"""


@query("A5 F6 X1", f"WITH {_GREEN_HOURS} SELECT * FROM g")
def hourly_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    recent = hour_source(spark, sf_dir, GREEN_KINDS).filter(
        F.col("ts") >= F.lit(SINCE).cast("timestamp")
    )
    return plain(hourly_revenue_of(recent, "ts", "PULocationID", "total_amount"))


def _compared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly_comparison(
        hour_source(spark, sf_dir, GREEN_KINDS), hour_source(spark, sf_dir, YELLOW_KINDS),
        "ts", "ts", SINCE,
    )


@query("J2 A5", f"WITH {_COMPARED_SQL} SELECT * FROM compared")
def hourly_revenue_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(_compared(spark, sf_dir))


@query(
    "J1 P6",
    f"""WITH {_COMPARED_SQL}, {ZONES_SQL}
    SELECT hour, green_amount, green_number_records, yellow_amount, yellow_number_records,
           borough AS Borough, zones.zone AS Zone, service_zone
    FROM compared JOIN zones ON compared.zone = location_id""",
)
def revenue_with_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(comparison_with_zones(_compared(spark, sf_dir), zone_source(spark, sf_dir)))


@query(
    "A6 X3",
    f"""WITH {INGESTED_SQL}
    SELECT taxi_type, CAST(pickup_datetime AS DATE) AS pickup_date, count(*) AS trip_count,
           CAST(CAST(sum(CAST(fare_amount AS DECIMAL(38,9))) AS VARCHAR) AS DOUBLE) AS total_fare_amount,
           CAST(CAST(sum(CAST(total_amount AS DECIMAL(38,9))) AS VARCHAR) AS DOUBLE) AS total_amount,
           CAST(CAST(sum(CAST(trip_distance AS DECIMAL(38,9))) AS VARCHAR) AS DOUBLE) / count(trip_distance)
             AS avg_trip_distance
    FROM ingested GROUP BY 1, 2""",
)
def daily_service_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_report(ingested_source(spark, sf_dir), "taxi_type", "pickup_datetime")


@query(
    "A6",
    f"""WITH {INGESTED_SQL}
    SELECT taxi_type, CAST(pickup_datetime AS DATE) AS pickup_date, count(*) AS trip_count,
           CAST(CAST(sum(CAST(fare_amount AS DECIMAL(38,9))) AS VARCHAR) AS DOUBLE) AS total_fare_amount,
           CAST(CAST(sum(CAST(total_amount AS DECIMAL(38,9))) AS VARCHAR) AS DOUBLE) AS total_amount,
           CAST(CAST(sum(CAST(trip_distance AS DECIMAL(38,9))) AS VARCHAR) AS DOUBLE) / count(trip_distance)
             AS avg_trip_distance
    FROM ingested GROUP BY 1, 2""",
)
def daily_service_report_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily report from the parts of two increments."""
    path = workspace(spark, "daily-parts")
    report = partials.daily_service_report("taxi_type", "pickup_datetime")
    trips = ingested_source(spark, sf_dir)
    backwards = F.col("dropoff_datetime") < F.col("pickup_datetime")
    for name, some in (("one", backwards), ("two", ~backwards), ("two", ~backwards)):
        partials.add_increment(report, trips.filter(some), path, name)
    return partials.current_report(spark, report, path)


@query(
    "A7 P7 O1",
    """SELECT CAST(ts AS DATE) AS trip_date,
              CAST(CAST(sum(CAST(value AS DECIMAL(38,9))) AS VARCHAR) AS DOUBLE) AS daily_revenue,
              count(*) AS trip_count
       FROM events GROUP BY 1 ORDER BY 1""",
)
def daily_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_trend_of(load(spark, sf_dir, "events"), "ts", "value")


@query(
    "A8 X14 F9",
    f"""WITH {GREEN_SQL}
    SELECT CAST(floor(tip_amount / 4) AS BIGINT) AS distance_bucket,
           CAST(CAST(sum(CAST(fare_amount AS DECIMAL(38,9))) AS VARCHAR) AS DOUBLE) / count(fare_amount) AS avg_fare,
           count(*) AS trip_count
    FROM green_raw WHERE tip_amount / 4 > 0 AND fare_amount > 0 GROUP BY 1 ORDER BY 1""",
)
def bucket_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    green = green_source(spark, sf_dir).withColumn("quarters", F.col("tip_amount") / 4)
    return bucket_average_of(green, "quarters", "fare_amount", "distance_bucket")


@query(
    "O3 J1",
    f"""WITH {YELLOW_SQL}, {ZONES_SQL}, counts AS (
      SELECT zone, count(*) AS pickup_count FROM yellow_raw JOIN zones ON PULocationID = location_id
      GROUP BY zone)
    SELECT zone, pickup_count FROM counts
    WHERE pickup_count = (SELECT min(pickup_count) FROM counts)""",
)
def least_frequent_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = dim_zones(zone_source(spark, sf_dir)).select("location_id", "zone")
    trips = yellow_source(spark, sf_dir).select("PULocationID")
    return least_frequent(join_lookup(trips, zones, "PULocationID", "location_id"), "zone")


@query(
    "O2 X5",
    f"""WITH {FHV_SQL}
    SELECT affiliated_base_num, pickup_datetime, dropoff_datetime,
           (floor(epoch(dropoff_datetime)) - floor(epoch(pickup_datetime))) / 3600.0 AS trip_hours
    FROM fhv ORDER BY trip_hours DESC, pickup_datetime, affiliated_base_num LIMIT 1""",
)
def longest_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    rides = fhv_source(spark, sf_dir).select(
        F.col("Affiliated_base_number").alias("affiliated_base_num"),
        "pickup_datetime",
        F.col("dropOff_datetime").alias("dropoff_datetime"),
    )
    hours = hours_between("pickup_datetime", "dropoff_datetime")
    return plain(top_n(rides, hours, "trip_hours", 1, "pickup_datetime", "affiliated_base_num"))
