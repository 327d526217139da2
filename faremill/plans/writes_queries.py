"""Incremental writes; each query returns the final table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faremill.operators import buckets, marks
from faremill.operators import incremental as inc
from faremill.operators.rows import dedup
from faremill.operators.writers import append, write
from faremill.plans.scalars_queries import doubles
from faremill.plans.stand_ins import (
    INGESTED_SQL,
    STAGED_FORM,
    STAGED_SQL,
    ZONES_SQL,
    green_source,
    ingested_source,
    zone_source,
)
from faremill.plans.trips import (
    COPY_KEY,
    COPY_TIES,
    GREEN_FACT,
    ROW_KEY,
    STAGED,
    dim_zones,
    green_fact,
    green_rows,
    interval_report,
    interval_staging,
    with_row_id,
)
from faremill.registry import query
from faremill.session import workspace
from faremill.sources.tables import load, plain


def _stamp(text: str):
    return F.lit(text).cast("timestamp")


@query(
    "K8 W2 X22",
    """SELECT o_orderkey, o_custkey, o_totalprice, TIMESTAMP '2024-01-02 00:00:00' AS extracted_at
       FROM orders""",
)
def append_then_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appended extractions; the newer copy of every order stays."""
    path = workspace(spark, "append")
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    older = orders.withColumn("o_totalprice", F.lit(0.0))
    append(older.withColumn("extracted_at", _stamp("2024-01-01")), path)
    both = append(orders.withColumn("extracted_at", _stamp("2024-01-02")), path)
    return plain(dedup(both, ["o_orderkey"], "extracted_at", "last"))


def _status(df: DataFrame, *wanted: str) -> DataFrame:
    return df.filter(F.col("o_orderstatus").isin(*wanted))


@query(
    "K9",
    """SELECT o_orderkey, o_orderstatus,
              CASE WHEN o_orderstatus = 'F' THEN o_orderpriority ELSE 'changed' END
                AS o_orderpriority
       FROM orders""",
)
def merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open orders are inserted, pending ones updated, finished ones kept; a rerun is harmless."""
    path = workspace(spark, "merge")
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    inc.create(_status(orders, "F", "P"), path)
    changed = _status(orders, "O", "P").withColumn("o_orderpriority", F.lit("changed"))
    inc.merge(changed, path, ["o_orderkey"])
    return inc.merge(changed, path, ["o_orderkey"])


@query(
    "K9 K5",
    """SELECT event_id, CASE WHEN ts < TIMESTAMP '2024-01-20' OR event_type = 'view' THEN value
                             ELSE -1 END AS value,
              CAST(ts AS DATE) AS event_day
       FROM events""",
)
def merge_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upsert into a day-partitioned table: only the days of the new rows are rewritten."""
    path = workspace(spark, "merge-days")
    events = load(spark, sf_dir, "events").withColumn("event_day", F.to_date("ts"))
    columns = ["event_id", "value", "event_day"]
    recent = (F.col("ts") >= _stamp("2024-01-20")) & (F.col("event_type") != "view")
    inserted = recent & (F.col("event_type") == "click")
    inc.create(events.filter(~inserted).select(*columns), path, "event_day")
    changed = events.filter(recent).withColumn("value", F.lit(-1.0)).select(*columns)
    return inc.merge(changed, path, ["event_id"], "event_day").select(*columns)


@query(
    "K10 F4",
    """SELECT o_orderkey, o_orderdate, o_orderstatus FROM orders
       WHERE o_orderdate < '1997-03-01' OR o_orderdate >= '1998-06-01' OR o_orderstatus = 'F'""",
)
def interval_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace(spark, "interval")
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus")
    inc.create(orders, path)
    start, end = dt.datetime(1997, 3, 1), dt.datetime(1998, 6, 1)
    for _ in range(2):
        result = inc.replace_interval(_status(orders, "F"), path, "o_orderdate", start, end)
    return plain(result)


@query(
    "K10 K5",
    """SELECT event_id, ts, event_type, CAST(ts AS DATE) AS event_day FROM events
       WHERE ts < TIMESTAMP '2024-01-10 06:00:00' OR ts >= TIMESTAMP '2024-01-13 12:00:00'
          OR (event_type = 'click' AND CAST(ts AS DATE) <> DATE '2024-01-11')""",
)
def interval_replace_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same on a day-partitioned table; a day without new rows loses its directory."""
    path = workspace(spark, "interval-days")
    events = (
        load(spark, sf_dir, "events")
        .select("event_id", "ts", "event_type")
        .withColumn("event_day", F.to_date("ts"))
    )
    inc.create(events, path, "event_day")
    start, end = dt.datetime(2024, 1, 10, 6), dt.datetime(2024, 1, 13, 12)
    quiet_day = F.lit("2024-01-11").cast("date")
    clicks = events.filter((F.col("event_type") == "click") & (F.col("event_day") != quiet_day))
    for _ in range(2):
        result = inc.replace_interval(clicks, path, "ts", start, end, partition="event_day")
    return plain(result)


@query(
    "K11",
    """SELECT o_orderkey, o_custkey, o_orderpriority FROM orders
       WHERE o_orderpriority = '1-URGENT'
          OR o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""",
)
def delete_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with urgent orders keep exactly these; all others stay as they are."""
    path = workspace(spark, "delete-insert")
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    inc.create(orders, path)
    urgent = orders.filter(F.col("o_orderpriority") == "1-URGENT")
    inc.delete_insert(urgent, path, ["o_custkey"])
    return inc.delete_insert(urgent, path, ["o_custkey"])


@query(
    "K13 A16",
    """SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
       WHERE o_orderdate > (SELECT max(o_orderdate) FROM orders WHERE o_orderstatus = 'P'
                            AND o_orderdate < '2000-01-01')""",
)
def incremental_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace(spark, "slice")
    orders = load(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderdate", "o_totalprice", "o_orderstatus"
    )
    loaded = _status(orders, "P").filter(F.col("o_orderdate") < _stamp("2000-01-01"))
    target = inc.create(loaded, path)
    return plain(inc.incremental_slice(orders.drop("o_orderstatus"), target, "o_orderdate"))


@query(
    "K13 S15",
    """WITH loaded AS (
      SELECT * FROM orders WHERE (o_orderstatus = 'F' AND o_orderdate < '1997-05-01')
                              OR (o_orderstatus = 'O' AND o_orderdate < '2000-03-01')),
    marks AS (SELECT o_orderstatus, max(o_orderdate) AS mark FROM loaded GROUP BY 1)
    SELECT o_orderkey, o_orderdate, o_orderstatus FROM orders LEFT JOIN marks USING (o_orderstatus)
    WHERE mark IS NULL OR o_orderdate > mark""",
)
def slice_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sources of a table are loaded up to different days, a third not at all; each goes on
    from its own mark."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus")
    path = workspace(spark, "marks")
    for status, until in (("F", "1997-05-01"), ("O", "2000-03-01")):
        loaded = _status(orders, status).filter(F.col("o_orderdate") < _stamp(until))
        known = marks.store_marks(marks.newest_by_source(loaded, "o_orderstatus", "o_orderdate"), path)
    return plain(marks.newer_than_marks(orders, known, "o_orderstatus", "o_orderdate"))


@query(
    "K14 K9",
    """SELECT c_custkey, c_mktsegment,
              CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal END AS c_acctbal
       FROM customer""",
)
def schema_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source brings a new column: old rows get NULL."""
    path = workspace(spark, "evolve")
    customer = load(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    inc.create(customer.drop("c_acctbal"), path)
    return inc.merge(customer.filter(F.col("c_mktsegment") == "BUILDING"), path, ["c_custkey"])


@query(
    "K9 K14",
    """SELECT c_custkey, CASE WHEN c_custkey % 7 = 3 THEN 'moved' ELSE c_mktsegment END AS c_mktsegment,
              CASE WHEN c_custkey % 7 = 3 THEN c_acctbal END AS c_acctbal
       FROM customer""",
)
def merge_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table without a date: some keys are updated, some added, with a new column; twice."""
    path = workspace(spark, "merge-buckets")
    customer = load(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    known = customer.filter(F.col("c_custkey") % 14 != 3).drop("c_acctbal")
    buckets.merge_bucketed(known, path, ["c_custkey"])
    changed = customer.filter(F.col("c_custkey") % 7 == 3).withColumn(
        "c_mktsegment", F.lit("moved")
    )
    buckets.merge_bucketed(changed, path, ["c_custkey"])
    return buckets.merge_bucketed(changed, path, ["c_custkey"])


@query(
    "K11",
    """SELECT o_orderkey, o_custkey, o_orderpriority FROM orders
       WHERE o_orderpriority = '1-URGENT'
          OR o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""",
)
def delete_insert_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several rows per key, in a table laid out by the key's buckets."""
    path = workspace(spark, "delete-insert-buckets")
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    buckets.create_bucketed(orders, path, ["o_custkey"])
    urgent = orders.filter(F.col("o_orderpriority") == "1-URGENT")
    buckets.delete_insert_bucketed(urgent, path, ["o_custkey"])
    return buckets.delete_insert_bucketed(urgent, path, ["o_custkey"])


_COPY_RANK = f"""row_number() OVER (PARTITION BY {", ".join(COPY_KEY)}
  ORDER BY extracted_at DESC NULLS LAST, {", ".join(f"{t} ASC NULLS LAST" for t in COPY_TIES)})"""


@query(
    "K8 K10 W2 X16 F9 A6",
    f"""WITH {INGESTED_SQL}, ranked AS (SELECT *, {_COPY_RANK} AS rn FROM ingested)
    SELECT taxi_type, CAST(pickup_datetime AS DATE) AS pickup_date, count(*) AS trip_count,
           CAST(CAST(sum(CAST(fare_amount AS DECIMAL(38,9))) AS VARCHAR) AS DOUBLE) AS total_fare_amount,
           CAST(CAST(sum(CAST(total_amount AS DECIMAL(38,9))) AS VARCHAR) AS DOUBLE) AS total_amount,
           CAST(CAST(sum(CAST(trip_distance AS DECIMAL(38,9))) AS VARCHAR) AS DOUBLE) / count(trip_distance)
             AS avg_trip_distance
    FROM ranked WHERE rn = 1 AND dropoff_datetime >= pickup_datetime AND trip_distance >= 0
      AND fare_amount >= 0 AND total_amount >= 0
    GROUP BY 1, 2""",
)
def interval_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append (twice), refresh staging window by window, refresh the report; one window is rerun."""
    base = workspace(spark, "refresh")
    month = "pickup_month"
    trips = ingested_source(spark, sf_dir).withColumn(month, F.trunc("pickup_datetime", "month"))
    append(trips, f"{base}/ingested", [month])
    ingested = append(trips, f"{base}/ingested", [month])
    middle, late = dt.datetime(1998, 7, 1), dt.datetime(2002, 1, 1)
    windows = [(dt.datetime(1995, 1, 1), middle), (middle, late), (middle, late)]
    for start, end in windows:
        arrived = inc.within(ingested, "pickup_datetime", start, end, month, "month")
        clean = interval_staging(arrived, start, end).withColumn(
            month, F.trunc("pickup_datetime", "month")
        )
        staged = inc.replace_interval(
            clean, f"{base}/staging", "pickup_datetime", start, end, partition=month
        )
        current = inc.within(staged, "pickup_datetime", start, end, month, "month")
        fresh = interval_report(current, start, end).withColumn(
            month, F.trunc("pickup_date", "month")
        )
        report = inc.replace_interval(
            fresh, f"{base}/report", "pickup_date", start, end, granularity="date", partition=month
        )
    return report.drop(month)


_ROW_KEY_TEXT = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '_null_')" for c in ROW_KEY)
_GREEN_TIES = [c for c in [*STAGED, "congestion_surcharge"] if c not in ROW_KEY]
_GREEN_MONEY = [
    "trip_distance", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
    "improvement_surcharge", "congestion_surcharge", "total_amount",
]
_GREEN_OUT = [*GREEN_FACT, "pickup_month"]


@query(
    "K13 K9 K5 J3 F9",
    f"""WITH {STAGED_SQL}, {ZONES_SQL}, rows_with_surcharge AS (
      SELECT {STAGED_FORM.format(trip_type="trip_type", ehail_fee="ehail_fee")},
             CAST(congestion_surcharge AS DECIMAL(18,2)) AS congestion_surcharge
      FROM green_raw),
    ranked AS (
      SELECT *, row_number() OVER (PARTITION BY {", ".join(ROW_KEY)}
                 ORDER BY {", ".join(f"{t} ASC NULLS LAST" for t in _GREEN_TIES)}) AS rn
      FROM rows_with_surcharge),
    fact AS (
      SELECT *, md5(concat_ws('-', {_ROW_KEY_TEXT})) AS unique_row_id,
             CASE payment_type WHEN 1 THEN 'Credit card' WHEN 2 THEN 'Cash' WHEN 3 THEN 'No charge'
                  WHEN 4 THEN 'Dispute' WHEN 6 THEN 'Voided trip' ELSE 'Unknown' END
               AS payment_type_description,
             CAST(date_trunc('month', pickup_datetime) AS DATE) AS pickup_month
      FROM ranked WHERE rn = 1 AND trip_distance > 0 AND fare_amount > 0)
    SELECT {", ".join(c for c in _GREEN_OUT
                      if c not in _GREEN_MONEY and not c.endswith(("borough", "zone")))},
           {doubles(*_GREEN_MONEY)}, p.borough AS pickup_borough, p.zone AS pickup_zone,
           d.borough AS dropoff_borough, d.zone AS dropoff_zone
    FROM fact LEFT JOIN zones p ON pickup_location_id = p.location_id
    LEFT JOIN zones d ON dropoff_location_id = d.location_id""",
)
def green_fact_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partitioned fact table in two runs: a first load, then everything newer, merged by row id."""
    path = workspace(spark, "green-fact")
    rows = green_rows(green_source(spark, sf_dir))
    fact = (
        green_fact(rows, dim_zones(zone_source(spark, sf_dir)))
        .withColumn("pickup_month", F.trunc("pickup_day", "month"))
        .select(*_GREEN_OUT)
    )
    first = fact.filter(F.col("pickup_datetime") < _stamp("2000-01-01"))
    inc.create(
        first.drop("unique_row_id"), path, "pickup_month", cluster_by=["pickup_borough"],
        finish=lambda dealt: with_row_id(dealt).select(*_GREEN_OUT),
    )
    newest = inc.newest_partition(spark, path, "pickup_month")
    newer = inc.incremental_slice(fact, newest, "pickup_datetime")
    # the id is hashed from the pickup time too, so it decides the month
    result = inc.merge(
        newer, path, ["unique_row_id"], "pickup_month", moves=False, cluster_by=["pickup_borough"]
    )
    return plain(result.select(*_GREEN_OUT))


@query(
    "K5 K1 J1 F1",
    f"""WITH {ZONES_SQL}
    SELECT event_id, CAST(user_id % 27 AS INTEGER) AS zone_id, zone, borough, value AS total_amount,
           CAST(ts AS DATE) AS pickup_day
    FROM events JOIN zones ON user_id % 27 = location_id
    WHERE borough IN ('ASIA', 'AFRICA') AND CAST(ts AS DATE) <> DATE '2024-01-13'""",
)
def clustered_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rides in a directory per day whose files hold ranges of boroughs; two boroughs are read."""
    zones = dim_zones(zone_source(spark, sf_dir)).select("location_id", "zone", "borough")
    rides = load(spark, sf_dir, "events").select(
        "event_id",
        (F.col("user_id") % 27).cast("int").alias("zone_id"),
        F.col("value").alias("total_amount"),
        F.to_date("ts").alias("pickup_day"),
    )
    named = rides.join(zones, F.col("zone_id") == F.col("location_id")).drop("location_id")
    path = workspace(spark, "clustered-days")
    table = write(named, path, partition_by=["pickup_day"], cluster_by=["borough"])
    other_days = F.col("pickup_day") != F.lit("2024-01-13").cast("date")
    return table.filter(F.col("borough").isin("ASIA", "AFRICA") & other_days)
