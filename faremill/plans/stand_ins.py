"""The trip vocabulary over the star-schema tables, as frames and as SQL.

Orders act as yellow trips, line items as green trips, events as for-hire rides and games,
nations as zones. Each ``*_SQL`` constant is the SQL form of the frame with the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faremill.functions.times import plus_seconds
from faremill.sources.tables import load


def _int(c: Column) -> Column:
    return c.cast("int")


def green_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw green trips: line items, the supplier's nation is the pickup zone."""
    items = load(spark, sf_dir, "lineitem")
    supplier = load(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    line, price = F.col("l_linenumber"), F.col("l_extendedprice")
    return items.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(
        line.alias("VendorID"),
        F.col("l_shipdate").alias("lpep_pickup_datetime"),
        plus_seconds("l_shipdate", F.col("l_quantity") * 97).alias("lpep_dropoff_datetime"),
        F.col("l_returnflag").alias("store_and_fwd_flag"),
        _int(line % 6 + 1).alias("RatecodeID"),
        F.col("s_nationkey").alias("PULocationID"),
        _int(F.col("l_partkey") % 30).alias("DOLocationID"),
        _int(F.col("l_quantity")).alias("passenger_count"),
        F.col("l_quantity").alias("trip_distance"),
        price.alias("fare_amount"),
        F.col("l_discount").alias("extra"),
        F.col("l_tax").alias("mta_tax"),
        F.col("l_quantity").alias("tip_amount"),
        F.col("l_discount").alias("tolls_amount"),
        F.col("l_tax").alias("ehail_fee"),
        F.col("l_discount").alias("improvement_surcharge"),
        price.alias("total_amount"),
        line.alias("payment_type"),
        _int(line % 2 + 1).alias("trip_type"),
        F.col("l_tax").alias("congestion_surcharge"),
    )


def yellow_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw yellow trips: orders, the customer's nation is the pickup zone, some zones unknown."""
    orders = load(spark, sf_dir, "orders")
    customer = load(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    cust, order = F.col("o_custkey"), F.col("o_orderkey")
    zone = F.when(cust % 11 == 0, 264).otherwise(F.col("c_nationkey"))
    return orders.join(customer, cust == F.col("c_custkey")).select(
        _int(F.substring("o_orderpriority", 1, 1)).alias("VendorID"),
        F.col("o_orderdate").alias("tpep_pickup_datetime"),
        plus_seconds("o_orderdate", order % 7200).alias("tpep_dropoff_datetime"),
        _int(cust % 6).alias("passenger_count"),
        (cust % 1000).cast("double").alias("trip_distance"),
        _int(cust % 7).alias("RatecodeID"),
        F.col("o_orderstatus").alias("store_and_fwd_flag"),
        _int(zone).alias("PULocationID"),
        _int(cust % 30).alias("DOLocationID"),
        _int(order % 9).alias("payment_type"),
        F.col("o_totalprice").alias("fare_amount"),
        F.lit(0.5).alias("extra"),
        F.lit(0.5).alias("mta_tax"),
        F.col("c_acctbal").alias("tip_amount"),
        F.lit(0.0).alias("tolls_amount"),
        F.lit(0.3).alias("improvement_surcharge"),
        F.col("o_totalprice").alias("total_amount"),
        F.lit(2.5).alias("congestion_surcharge"),
    )


def zone_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = load(spark, sf_dir, "nation"), load(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("LocationID"),
        F.col("r_name").alias("Borough"),
        F.col("n_name").alias("Zone"),
        F.concat(F.lit("Area "), F.col("n_regionkey").cast("string")).alias("service_zone"),
    )


def fhv_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For-hire rides from events; errors have no dispatching base."""
    number = F.format_string("B%05d", F.col("event_id") % 100000)
    return load(spark, sf_dir, "events").select(
        F.when(F.col("event_type") != "error", number).alias("dispatching_base_num"),
        F.col("ts").alias("pickup_datetime"),
        plus_seconds("ts", F.floor(F.col("value") * 10)).alias("dropOff_datetime"),
        (F.col("user_id") % 30).cast("double").alias("PUlocationID"),
        (F.col("user_id") % 25).cast("double").alias("DOlocationID"),
        F.lit(None).cast("string").alias("SR_Flag"),
        F.format_string("B%05d", F.col("user_id")).alias("Affiliated_base_number"),
    )


def hour_source(spark: SparkSession, sf_dir: str, kinds: list[str]) -> DataFrame:
    """Trips with real hours: events of some kinds, in 27 zones of which 25 are known."""
    return (
        load(spark, sf_dir, "events")
        .filter(F.col("event_type").isin(kinds))
        .select(
            "ts",
            _int(F.col("user_id") % 27).alias("PULocationID"),
            F.col("value").alias("total_amount"),
        )
    )


def ingested_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Appended trips with pickup (order) and dropoff (shipping) time; about half run backwards."""
    items = load(spark, sf_dir, "lineitem")
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return items.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.when(F.col("l_linestatus") == "O", "yellow").otherwise("green").alias("taxi_type"),
        F.col("o_orderdate").alias("pickup_datetime"),
        F.col("l_shipdate").alias("dropoff_datetime"),
        _int(F.col("l_quantity")).alias("passenger_count"),
        F.col("l_quantity").alias("trip_distance"),
        F.col("l_extendedprice").alias("fare_amount"),
        F.col("l_extendedprice").alias("total_amount"),
        plus_seconds("o_orderdate", F.col("l_linenumber") * 86400).alias("extracted_at"),
    )


def game_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Games between users from events, both sides as JSON text."""

    def side(who: Column, won: str) -> Column:
        result = F.when(F.col("event_type") == won, "win").otherwise("lost")
        return F.to_json(F.struct(who.cast("string").alias("@id"), result.alias("result")))

    return load(spark, sf_dir, "events").select(
        side(F.col("user_id"), "purchase").alias("white"),
        side(F.col("event_id") * 7 % 200, "click").alias("black"),
    )


def profile_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "customer").select(
        F.col("c_name").alias("username"), F.col("c_custkey").cast("string").alias("aid")
    )


TEAM = 66


def match_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches of one team from orders, as the loader lands them: nested records."""
    cust, order = F.col("o_custkey"), F.col("o_orderkey")
    digit = F.substring("o_orderpriority", 1, 1)
    winner = F.when(digit.isin("1", "4"), "HOME_TEAM").when(digit == "2", "AWAY_TEAM")
    return load(spark, sf_dir, "orders").select(
        order.alias("id"),
        F.when(F.col("o_orderstatus") == "O", "SCHEDULED").otherwise("FINISHED").alias("status"),
        F.col("o_orderdate").alias("utcDate"),
        F.struct(F.trunc(F.to_date("o_orderdate"), "year").alias("startDate")).alias("season"),
        F.struct(
            winner.when(digit == "3", "DRAW").alias("winner"),
            F.struct(
                _int(order % 5).alias("home"), _int(cust % 4).alias("away")
            ).alias("fullTime"),
        ).alias("score"),
        F.struct(F.when(cust % 2 == 0, TEAM).otherwise(57).alias("id")).alias("homeTeam"),
        F.struct(F.when(cust % 2 == 0, 57).otherwise(TEAM).alias("id")).alias("awayTeam"),
    )


# --- the same in SQL ------------------------------------------------------------------

GREEN_SQL = """
green_raw AS (
  SELECT l_linenumber AS VendorID, l_shipdate AS pickup_datetime,
         l_shipdate + to_seconds(CAST(l_quantity AS BIGINT) * 97) AS dropoff_datetime,
         l_returnflag AS store_and_fwd_flag,
         CAST(l_linenumber % 6 + 1 AS INTEGER) AS RatecodeID, s_nationkey AS PULocationID,
         CAST(l_partkey % 30 AS INTEGER) AS DOLocationID,
         CAST(l_quantity AS INTEGER) AS passenger_count, l_quantity AS trip_distance,
         l_extendedprice AS fare_amount, l_discount AS extra, l_tax AS mta_tax,
         l_quantity AS tip_amount, l_discount AS tolls_amount, l_tax AS ehail_fee,
         l_discount AS improvement_surcharge, l_extendedprice AS total_amount,
         l_linenumber AS payment_type, CAST(l_linenumber % 2 + 1 AS INTEGER) AS trip_type,
         l_tax AS congestion_surcharge
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
)"""

YELLOW_SQL = """
yellow_raw AS (
  SELECT CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS VendorID,
         o_orderdate AS pickup_datetime,
         o_orderdate + to_seconds(o_orderkey % 7200) AS dropoff_datetime,
         CAST(o_custkey % 6 AS INTEGER) AS passenger_count,
         CAST(o_custkey % 1000 AS DOUBLE) AS trip_distance,
         CAST(o_custkey % 7 AS INTEGER) AS RatecodeID, o_orderstatus AS store_and_fwd_flag,
         CAST(CASE WHEN o_custkey % 11 = 0 THEN 264 ELSE c_nationkey END AS INTEGER)
           AS PULocationID,
         CAST(o_custkey % 30 AS INTEGER) AS DOLocationID,
         CAST(o_orderkey % 9 AS INTEGER) AS payment_type, o_totalprice AS fare_amount,
         CAST(0.5 AS DOUBLE) AS extra, CAST(0.5 AS DOUBLE) AS mta_tax, c_acctbal AS tip_amount,
         CAST(0 AS DOUBLE) AS tolls_amount, CAST(0.3 AS DOUBLE) AS improvement_surcharge,
         o_totalprice AS total_amount, CAST(2.5 AS DOUBLE) AS congestion_surcharge
  FROM orders JOIN customer ON o_custkey = c_custkey
)"""

ZONES_SQL = """
zones AS (
  SELECT n_nationkey AS location_id, r_name AS borough, n_name AS zone,
         'Area ' || CAST(n_regionkey AS VARCHAR) AS service_zone
  FROM nation JOIN region ON n_regionkey = r_regionkey
)"""

FHV_SQL = """
fhv AS (
  SELECT CASE WHEN event_type <> 'error'
              THEN 'B' || lpad(CAST(event_id % 100000 AS VARCHAR), 5, '0') END
           AS dispatching_base_num,
         printf('B%05d', user_id)
           AS affiliated_base_num,
         CAST(user_id % 30 AS INTEGER) AS pickup_location_id,
         CAST(user_id % 25 AS INTEGER) AS dropoff_location_id, ts AS pickup_datetime,
         ts + to_seconds(CAST(floor(value * 10) AS BIGINT)) AS dropoff_datetime,
         CAST(NULL AS VARCHAR) AS sr_flag
  FROM events
)"""

STAGED_FORM = """
    CAST(VendorID AS INTEGER) AS vendor_id, RatecodeID AS rate_code_id,
    PULocationID AS pickup_location_id, DOLocationID AS dropoff_location_id,
    pickup_datetime, dropoff_datetime, store_and_fwd_flag, passenger_count,
    CAST(trip_distance AS DECIMAL(18,3)) AS trip_distance, {trip_type} AS trip_type,
    CAST(fare_amount AS DECIMAL(18,2)) AS fare_amount, CAST(extra AS DECIMAL(18,2)) AS extra,
    CAST(mta_tax AS DECIMAL(18,2)) AS mta_tax, CAST(tip_amount AS DECIMAL(18,2)) AS tip_amount,
    CAST(tolls_amount AS DECIMAL(18,2)) AS tolls_amount,
    CAST({ehail_fee} AS DECIMAL(18,2)) AS ehail_fee,
    CAST(improvement_surcharge AS DECIMAL(18,2)) AS improvement_surcharge,
    CAST(total_amount AS DECIMAL(18,2)) AS total_amount, payment_type"""

STAGED_SQL = f"""{GREEN_SQL}, {YELLOW_SQL},
staged_green AS (
  SELECT {STAGED_FORM.format(trip_type="trip_type", ehail_fee="ehail_fee")} FROM green_raw
),
staged_yellow AS (
  SELECT {STAGED_FORM.format(trip_type="1", ehail_fee="NULL")} FROM yellow_raw
),
staged AS (
  SELECT *, 'Green' AS service_type FROM staged_green
  UNION ALL
  SELECT *, 'Yellow' AS service_type FROM staged_yellow
)"""

PAYMENTS_SQL = """
payments(payment_type, description) AS (
  VALUES (0, 'Unknown'), (1, 'Credit card'), (2, 'Cash'), (3, 'No charge'), (4, 'Dispute'),
         (5, 'Unknown'), (6, 'Voided trip')
)"""

INGESTED_SQL = """
ingested AS (
  SELECT CASE WHEN l_linestatus = 'O' THEN 'yellow' ELSE 'green' END AS taxi_type,
         o_orderdate AS pickup_datetime, l_shipdate AS dropoff_datetime,
         CAST(l_quantity AS INTEGER) AS passenger_count, l_quantity AS trip_distance,
         l_extendedprice AS fare_amount, l_extendedprice AS total_amount,
         o_orderdate + to_days(CAST(l_linenumber AS INTEGER)) AS extracted_at
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""

MATCHES_SQL = """
matches AS (
  SELECT o_orderkey AS id,
         CASE WHEN o_orderstatus = 'O' THEN 'SCHEDULED' ELSE 'FINISHED' END AS status,
         o_orderdate AS utc_date, date_trunc('year', o_orderdate) AS season__start_date,
         CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'HOME_TEAM' WHEN '4' THEN 'HOME_TEAM'
              WHEN '2' THEN 'AWAY_TEAM' WHEN '3' THEN 'DRAW' END AS score__winner,
         CAST(o_orderkey % 5 AS INTEGER) AS score__full_time__home,
         CAST(o_custkey % 4 AS INTEGER) AS score__full_time__away,
         CASE WHEN o_custkey % 2 = 0 THEN 66 ELSE 57 END AS home_team__id,
         CASE WHEN o_custkey % 2 = 0 THEN 57 ELSE 66 END AS away_team__id
  FROM orders
),
finished AS (
  SELECT *, CAST(year(season__start_date) AS INTEGER) AS season, home_team__id = 66 AS is_home,
         CASE WHEN home_team__id = 66 THEN 'HOME_TEAM' ELSE 'AWAY_TEAM' END AS own_side
  FROM matches WHERE status = 'FINISHED'
)"""

GAMES_SQL = """
games AS (
  SELECT CAST(user_id AS VARCHAR) AS white_aid, CAST(event_id * 7 % 200 AS VARCHAR) AS black_aid,
         CASE event_type WHEN 'purchase' THEN CAST(user_id AS VARCHAR)
              WHEN 'click' THEN CAST(event_id * 7 % 200 AS VARCHAR) END AS winner_aid
  FROM events
),
profiles AS (SELECT c_name AS username, CAST(c_custkey AS VARCHAR) AS aid FROM customer)"""
