"""Star schema: dimensions, enrichment, dedup, fact tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faremill.functions.codes import PAYMENT_DESCRIPTIONS
from faremill.operators.aggregate import count_by
from faremill.operators.joins import code_table, either_side_join as either_side_join_of
from faremill.operators.joins import enrich_default, join_lookup
from faremill.operators.rows import dedup, dedup_by_file as dedup_by_file_of
from faremill.operators.shape import in_years
from faremill.operators.writers import append
from faremill.plans.scalars_queries import doubles, staged
from faremill.plans.matches import game_results
from faremill.plans.stand_ins import (
    GAMES_SQL,
    INGESTED_SQL,
    PAYMENTS_SQL,
    STAGED_SQL,
    ZONES_SQL,
    game_source,
    ingested_source,
    profile_source,
    zone_source,
)
from faremill.plans.trips import (
    FACT_TYPES,
    TRIP_KEY,
    TRIP_TIES,
    clean_trips,
    dim_vendors,
    dim_zones as dim_zones_of,
    fact_trips,
)
from faremill.registry import query
from faremill.session import workspace
from faremill.sources.tables import load, plain

YEARS = [1996, 1997]


def payments(spark: SparkSession) -> DataFrame:
    return code_table(spark, PAYMENT_DESCRIPTIONS, "payment_type", "description")


CLEAN_SQL = f"""{STAGED_SQL}, {PAYMENTS_SQL},
ranked AS (
  SELECT *, row_number() OVER (
      PARTITION BY vendor_id, pickup_datetime, pickup_location_id, service_type
      ORDER BY dropoff_datetime ASC NULLS LAST,
               {", ".join(f"{t} ASC NULLS LAST" for t in TRIP_TIES)}) AS rn
  FROM staged WHERE year(pickup_datetime) IN (1996, 1997)
),
cleaned AS (
  SELECT r.* EXCLUDE (rn, payment_type), coalesce(r.payment_type, 0) AS payment_type,
         coalesce(p.description, 'Unknown') AS payment_type_description,
         md5(concat_ws('-', coalesce(CAST(vendor_id AS VARCHAR), '_null_'),
             coalesce(CAST(pickup_datetime AS VARCHAR), '_null_'),
             coalesce(CAST(pickup_location_id AS VARCHAR), '_null_'),
             coalesce(service_type, '_null_'))) AS trip_id
  FROM ranked r LEFT JOIN payments p ON coalesce(r.payment_type, 0) = p.payment_type
  WHERE rn = 1
)"""

FACT_SQL = f"""{CLEAN_SQL}, {ZONES_SQL},
fact AS (
  SELECT c.*, pz.borough AS pickup_borough, pz.zone AS pickup_zone,
         dz.borough AS dropoff_borough, dz.zone AS dropoff_zone,
         date_diff('minute', pickup_datetime, dropoff_datetime) AS trip_duration_minutes
  FROM cleaned c
  LEFT JOIN zones pz ON c.pickup_location_id = pz.location_id
  LEFT JOIN zones dz ON c.dropoff_location_id = dz.location_id
)"""

FACT_OUT = ", ".join(
    doubles(n) if t.startswith("decimal") else n for n, t in FACT_TYPES.items()
)


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_trips(staged(spark, sf_dir), payments(spark), YEARS)


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact_trips(cleaned(spark, sf_dir), dim_zones_of(zone_source(spark, sf_dir)))


@query("J3 X6 X15 W1 J4 F8", f"WITH {FACT_SQL} SELECT {FACT_OUT} FROM fact")
def fct_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(fact(spark, sf_dir))


@query(
    "W1",
    f"""WITH {CLEAN_SQL}
    SELECT vendor_id, pickup_datetime, pickup_location_id, service_type, dropoff_datetime,
           {doubles("fare_amount")}
    FROM ranked WHERE rn = 1""",
)
def dedup_earliest(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = staged(spark, sf_dir).filter(in_years("pickup_datetime", YEARS))
    kept = dedup(trips, TRIP_KEY, "dropoff_datetime", "first", TRIP_TIES)
    return plain(kept.select(*TRIP_KEY, "dropoff_datetime", "fare_amount"))


@query(
    "W2 W4",
    f"""WITH {INGESTED_SQL}, ranked AS (
      SELECT *, row_number() OVER (PARTITION BY taxi_type, pickup_datetime, passenger_count
          ORDER BY extracted_at DESC NULLS LAST, total_amount, dropoff_datetime) AS rn
      FROM ingested)
    SELECT taxi_type, pickup_datetime, passenger_count, extracted_at, total_amount, dropoff_datetime
    FROM ranked WHERE rn = 1""",
)
def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [
        "taxi_type", "pickup_datetime", "passenger_count", "extracted_at", "total_amount",
        "dropoff_datetime",
    ]
    rows = ingested_source(spark, sf_dir).select(*columns)
    return plain(
        dedup(rows, columns[:3], "extracted_at", "last", ["total_amount", "dropoff_datetime"])
    )


@query(
    "W3 K8",
    "SELECT o_orderkey, o_custkey, true AS from_first_file FROM orders",
)
def dedup_by_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order sits in two files with different prices; the copy of the first file remains."""
    path = workspace(spark, "by-file")
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    append(orders, path)
    dearer = orders.withColumn("o_totalprice", F.col("o_totalprice") + 1)
    landed = append(dearer, path)
    found = dedup_by_file_of(landed, ["o_orderkey"], ["o_custkey", "o_totalprice"])
    # the names of files are drawn anew in each run, so the first file is told from all copies
    copies = landed.select("*", F.col("_metadata.file_name").alias("file"))
    names = copies.groupBy("o_orderkey").agg(F.min("file").alias("first_file"))
    right = found.join(names, "o_orderkey").join(
        copies.select("o_orderkey", "file", F.col("o_totalprice").alias("there")), "o_orderkey"
    )
    right = right.filter((F.col("file") == F.col("first_file")) & (F.col("source_file") == F.col("file")))
    return right.select(
        "o_orderkey", "o_custkey", (F.col("there") == F.col("o_totalprice")).alias("from_first_file")
    )


@query(
    "J4 X10",
    f"""WITH {STAGED_SQL}, {PAYMENTS_SQL}
    SELECT s.service_type, coalesce(s.payment_type, 0) AS payment_type,
           coalesce(p.description, 'Unknown') AS payment_type_description, count(*) AS trips
    FROM staged s LEFT JOIN payments p ON coalesce(s.payment_type, 0) = p.payment_type
    GROUP BY 1, 2, 3""",
)
def enrich_payment(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = enrich_default(
        staged(spark, sf_dir), payments(spark), "payment_type", "payment_type", "description",
        "payment_type_description",
    )
    return count_by(
        labelled, "service_type", "payment_type", "payment_type_description", name="trips"
    )


@query(
    "X12 A15",
    f"""WITH {STAGED_SQL}
    SELECT DISTINCT vendor_id,
           CASE vendor_id WHEN 1 THEN 'Creative Mobile Technologies, LLC'
                WHEN 2 THEN 'VeriFone Inc.' WHEN 4 THEN 'Unknown Vendor' END AS vendor_name
    FROM staged""",
)
def dim_vendor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dim_vendors(staged(spark, sf_dir))


@query("P2", f"WITH {ZONES_SQL} SELECT * FROM zones")
def dim_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dim_zones_of(zone_source(spark, sf_dir))


@query(
    "J6 O1",
    """SELECT p_type, p_brand, count(*) AS sales FROM lineitem JOIN part ON l_partkey = p_partkey
       GROUP BY 1, 2 ORDER BY sales DESC, p_type, p_brand""",
)
def star_category_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = load(spark, sf_dir, "lineitem").select("l_partkey")
    part = load(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand")
    counts = count_by(
        join_lookup(items, part, "l_partkey", "p_partkey"), "p_type", "p_brand", name="sales"
    )
    return counts.orderBy(F.col("sales").desc(), "p_type", "p_brand")


@query(
    "J5",
    f"""WITH {GAMES_SQL}
    SELECT username, aid, white_aid, black_aid, winner_aid
    FROM profiles LEFT JOIN games ON aid IN (white_aid, black_aid)""",
)
def either_side_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every player with every game on either side; players without games stay."""
    return either_side_join_of(
        profile_source(spark, sf_dir), game_results(game_source(spark, sf_dir)), "aid",
        ["white_aid", "black_aid"],
    )
