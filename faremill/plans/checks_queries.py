"""Data checks, reconciliation, layered build."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faremill.operators import key_register
from faremill.operators import quality as q
from faremill.operators.aggregate import duplicate_keys
from faremill.operators.joins import join_lookup, orphans_of_large_parent
from faremill.operators.writers import write
from faremill.plans import declared_checks as declared
from faremill.plans.revenue_queries import _AVERAGES, _money_sums
from faremill.plans.scalars_queries import staged
from faremill.plans.stand_ins import (
    INGESTED_SQL,
    YELLOW_SQL,
    ZONES_SQL,
    ingested_source,
    yellow_source,
    zone_source,
)
from faremill.plans.star_queries import FACT_SQL, YEARS, fact, payments
from faremill.plans.trips import (
    MART_MEASURES,
    clean_trips,
    dim_zones,
    fact_contract,
    fact_trips,
    interval_report,
    interval_staging,
    monthly_zone_mart,
)
from faremill.plans.writes_queries import _COPY_RANK
from faremill.registry import query
from faremill.session import workspace
from faremill.sources.tables import load


def _check_sql(name: str, table: str, column: str, count: str) -> str:
    return f"""SELECT '{name}' AS check_name, '{table}' AS table_name, '{column}' AS column_name,
      CAST(({count}) AS BIGINT) AS failed_rows, ({count}) = 0 AS passed"""


def _checks_sql(*checks: tuple[str, str, str, str]) -> str:
    return "\nUNION ALL\n".join(_check_sql(*c) for c in checks)


def _repeats(table: str, *cols: str) -> str:
    keys = ", ".join(cols)
    return f"SELECT count(*) FROM (SELECT {keys} FROM {table} GROUP BY {keys} HAVING count(*) > 1)"


@query(
    "Q1 Q14",
    _checks_sql(
        ("not_null", "orders", "o_orderkey",
         "SELECT count(*) FROM orders WHERE o_orderkey IS NULL"),
        ("unique", "orders", "o_orderkey", _repeats("orders", "o_orderkey")),
        ("unique", "orders", "o_custkey", _repeats("orders", "o_custkey")),
        ("unique", "lineitem", "l_orderkey", _repeats("lineitem", "l_orderkey")),
    ),
)
def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = q.run_checks(
        load(spark, sf_dir, "orders"), "orders",
        [*q.primary_key("o_orderkey"), q.unique("o_custkey")],
    )
    items = q.run_checks(load(spark, sf_dir, "lineitem"), "lineitem", [q.unique("l_orderkey")])
    return orders.unionByName(items)


@query(
    "Q2 F11",
    f"""WITH {YELLOW_SQL}, {ZONES_SQL}, named AS (
      SELECT y.*, zone FROM yellow_raw y LEFT JOIN zones ON PULocationID = location_id)
    {_checks_sql(
        ("not_null", "trips", "VendorID", "SELECT count(*) FROM named WHERE VendorID IS NULL"),
        ("not_null", "trips", "zone", "SELECT count(*) FROM named WHERE zone IS NULL"),
    )}""",
)
def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = dim_zones(zone_source(spark, sf_dir)).select("location_id", "zone")
    trips = yellow_source(spark, sf_dir)
    named = join_lookup(trips, zones, "PULocationID", "location_id", "left")
    return q.run_checks(named, "trips", [q.not_null("VendorID"), q.not_null("zone")])


@query(
    "Q3",
    _checks_sql(
        ("accepted_values", "orders", "o_orderstatus",
         "SELECT count(*) FROM orders WHERE o_orderstatus NOT IN ('F', 'O')"),
        ("accepted_values", "orders", "o_orderpriority",
         "SELECT count(*) FROM orders WHERE o_orderstatus = 'P'"
         " AND o_orderpriority NOT IN ('1-URGENT', '2-HIGH')"),
    ),
)
def dq_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    scoped = q.accepted_values(
        "o_orderpriority", ["1-URGENT", "2-HIGH"], where=F.col("o_orderstatus") == "P",
        nulls="fail",
    )
    return q.run_checks(
        load(spark, sf_dir, "orders"), "orders",
        [q.accepted_values("o_orderstatus", ["F", "O"]), scoped],
    )


@query(
    "Q4 J7",
    f"""WITH {YELLOW_SQL}
    {_checks_sql(
        ("relationships", "orders", "o_custkey",
         "SELECT count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)"),
        ("relationships", "trips", "PULocationID",
         "SELECT count(*) FROM yellow_raw WHERE PULocationID NOT IN (SELECT n_nationkey FROM nation)"),
    )}""",
)
def dq_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, nation = load(spark, sf_dir, "customer"), load(spark, sf_dir, "nation")
    orders = q.run_checks(
        load(spark, sf_dir, "orders"), "orders",
        [q.relationships("o_custkey", customer, "c_custkey")],
    )
    trips = q.run_checks(
        yellow_source(spark, sf_dir), "trips",
        [q.relationships("PULocationID", nation, "n_nationkey")],
    )
    return orders.unionByName(trips)


@query(
    "Q4 J7",
    """WITH parents AS (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_linenumber > 1)
    SELECT o_custkey, count(*) AS orders_without_more
    FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM parents) AND o_orderstatus = 'F'
    GROUP BY o_custkey""",
)
def dq_relationships_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finished orders that the larger table of further items does not know, by customer."""
    items = load(spark, sf_dir, "lineitem").filter("l_linenumber > 1").select("l_orderkey")
    orders = load(spark, sf_dir, "orders").filter("o_orderstatus = 'F'")
    missing = orphans_of_large_parent(orders, items, "o_orderkey", "l_orderkey")
    alone = orders.join(missing.select("o_orderkey"), "o_orderkey", "left_semi")
    return alone.groupBy("o_custkey").agg(F.count("*").alias("orders_without_more"))


_EARLY = "l_shipdate < TIMESTAMP '1998-01-01 00:00:00'"


@query(
    "Q1 Q5",
    f"""WITH known AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem WHERE {_EARLY}),
    fresh AS (SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem
              WHERE NOT ({_EARLY}) GROUP BY 1, 2)
    SELECT f.l_orderkey, f.l_linenumber, copies, k.l_orderkey IS NOT NULL AS known
    FROM fresh f LEFT JOIN known k ON f.l_orderkey = k.l_orderkey AND f.l_linenumber = k.l_linenumber
    WHERE copies > 1 OR k.l_orderkey IS NOT NULL""",
)
def dq_unique_growing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of a second load that are not unique, without the first one's rows; the load is
    registered twice, and is not held against itself."""
    path, key = workspace(spark, "keys"), ["l_orderkey", "l_linenumber"]
    items = load(spark, sf_dir, "lineitem")
    key_register.register(items.filter(_EARLY), path, key, "first")
    fresh = items.filter(f"NOT ({_EARLY})")
    for _ in range(2):
        key_register.register(fresh, path, key, "second")
    return key_register.repeated_keys(fresh, path, key, "second")


@query(
    "A14 Q5",
    """SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem
       GROUP BY 1, 2 HAVING count(*) > 1""",
)
def dq_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_keys(load(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")


@query(
    "Q5",
    _checks_sql(
        ("unique_combination", "orders", "o_custkey+o_orderdate",
         _repeats("orders", "o_custkey", "o_orderdate")),
    ),
)
def dq_unique_combination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.run_checks(
        load(spark, sf_dir, "orders"), "orders", [q.unique_combination("o_custkey", "o_orderdate")]
    )


@query(
    "Q6",
    _checks_sql(
        ("positive", "customer", "c_acctbal", "SELECT count(*) FROM customer WHERE c_acctbal <= 0"),
        ("non_negative", "customer", "c_custkey",
         "SELECT count(*) FROM customer WHERE c_custkey < 0"),
        ("positive", "customer", "c_custkey", "SELECT count(*) FROM customer WHERE c_custkey <= 0"),
    ),
)
def dq_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.run_checks(
        load(spark, sf_dir, "customer"), "customer",
        [q.positive("c_acctbal"), q.non_negative("c_custkey"), q.positive("c_custkey")],
    )


@query(
    "Q7 Q8",
    f"""WITH {INGESTED_SQL}
    {_checks_sql(
        ("no_negative_duration", "trips", "",
         "SELECT count(*) FROM ingested WHERE dropoff_datetime < pickup_datetime"),
        ("no_backward_trip_listed", "trips", "",
         "SELECT count(*) FROM ingested WHERE dropoff_datetime < pickup_datetime"),
        ("two_services", "trips", "", "SELECT abs(count(DISTINCT taxi_type) - 2) FROM ingested"),
    )}""",
)
def dq_custom(spark: SparkSession, sf_dir: str) -> DataFrame:
    backwards = F.col("dropoff_datetime") < F.col("pickup_datetime")
    return q.run_checks(
        ingested_source(spark, sf_dir), "trips",
        [
            q.custom("no_negative_duration", backwards),
            q.expect_no_rows("no_backward_trip_listed", lambda df: df.filter(backwards)),
            q.expect_value(
                "two_services", lambda df: df.agg(F.count_distinct("taxi_type").alias("n")), 2
            ),
        ],
    )


def _freshness_sql(table: str, col: str, as_of: str) -> str:
    age = f"date_diff('second', max({col}), TIMESTAMP '{as_of}')"
    return f"""SELECT 'freshness' AS check_name, '{table}' AS table_name, '{col}' AS column_name,
      {age} AS age_seconds,
      CASE WHEN {age} > 48 * 3600 THEN 'error' WHEN {age} > 24 * 3600 THEN 'warn' ELSE 'pass' END
        AS status
    FROM {table}"""


@query(
    "Q9",
    _freshness_sql("events", "ts", "2024-02-01 00:00:00")
    + " UNION ALL " + _freshness_sql("orders", "o_orderdate", "2001-12-31 00:00:00")
    + " UNION ALL " + _freshness_sql("lineitem", "l_shipdate", "2001-11-05 00:00:00"),
)
def dq_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = q.freshness(load(spark, sf_dir, "events"), "events", "ts", dt.datetime(2024, 2, 1))
    orders = q.freshness(
        load(spark, sf_dir, "orders"), "orders", "o_orderdate", dt.datetime(2001, 12, 31)
    )
    items = q.freshness(
        load(spark, sf_dir, "lineitem"), "lineitem", "l_shipdate", dt.datetime(2001, 11, 5)
    )
    return events.unionByName(orders).unionByName(items)


@query(
    "Q10",
    f"WITH {FACT_SQL} SELECT service_type, count(*) AS trips FROM fact GROUP BY service_type",
)
def dq_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact table passes its declared contract before it is counted."""
    checked = q.enforce(fact(spark, sf_dir), fact_contract())
    return checked.groupBy("service_type").agg(F.count("*").alias("trips"))


# --- three layers: ingested, staging, report ------------------------------------------

ALL_TIME = (dt.datetime(1990, 1, 1), dt.datetime(2010, 1, 1))

_LAYERS_SQL = f"""{INGESTED_SQL},
ranked AS (SELECT *, {_COPY_RANK} AS rn FROM ingested),
staging AS (
  SELECT md5(taxi_type || CAST(pickup_datetime AS VARCHAR) || CAST(dropoff_datetime AS VARCHAR)
             || CAST(CAST(trip_distance AS DECIMAL(18,3)) AS VARCHAR)
             || CAST(CAST(fare_amount AS DECIMAL(18,2)) AS VARCHAR)) AS trip_id, *
  FROM ranked WHERE rn = 1 AND dropoff_datetime >= pickup_datetime AND trip_distance >= 0
    AND fare_amount >= 0 AND total_amount >= 0
),
report AS (
  SELECT taxi_type, CAST(pickup_datetime AS DATE) AS pickup_date, count(*) AS trip_count,
         sum(CAST(total_amount AS DECIMAL(38,9))) AS total_amount
  FROM staging GROUP BY 1, 2
)"""


def _layers(spark: SparkSession, sf_dir: str, label: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three layers, staging and report stored: several values are taken from each."""
    base = workspace(spark, label)
    raw = ingested_source(spark, sf_dir)
    clean = write(interval_staging(raw, *ALL_TIME), f"{base}/staging")
    report = write(interval_report(clean, *ALL_TIME), f"{base}/report")
    return raw, clean, report


# report rows in SQL: name -> expression over the one-row facts below
_SANITY = {
    "ingestion.trips row count": "raw_rows",
    "staging.trips row count": "clean_rows",
    "staging.trips duplicate trip_id count (expect 0)": "clean_rows - ids",
    "staging.trips null trip_id count (expect 0)": "clean_rows - with_id",
    "staging.trips null pickup/dropoff count (expect 0)": "clean_rows - with_times",
    "staging.trips dropoff before pickup count (expect 0)": "backwards",
    "staging.trips negative trip_distance count (expect 0)": "below_distance",
    "staging.trips negative fare_amount count (expect 0)": "below_fare",
    "staging.trips negative total_amount count (expect 0)": "below_total",
    "staging.trips distinct taxi_type count": "services",
    "reports.trips_report row count (days x taxi_type)": "report_rows",
    "reports.trips_report duplicate (taxi_type, pickup_date) count (expect 0)": "repeated_days",
    "staging vs reports trip_count diff (expect 0)": "clean_rows - reported_trips",
    "staging vs reports total_amount diff (expect ~0)": "round(clean_total - reported_total, 6)",
}

_SANITY_SQL = f"""{_LAYERS_SQL},
clean_facts AS (
  SELECT count(*) AS clean_rows, count(trip_id) AS with_id, count(DISTINCT trip_id) AS ids,
         count(*) FILTER (WHERE least(pickup_datetime, dropoff_datetime) IS NOT NULL) AS with_times,
         count(*) FILTER (WHERE pickup_datetime > dropoff_datetime) AS backwards,
         count(*) FILTER (WHERE trip_distance < 0) AS below_distance,
         count(*) FILTER (WHERE fare_amount < 0) AS below_fare,
         count(*) FILTER (WHERE total_amount < 0) AS below_total,
         count(DISTINCT taxi_type) AS services,
         sum(CAST(total_amount AS DECIMAL(38,9))) AS clean_total
  FROM staging
),
report_facts AS (
  SELECT count(*) AS report_rows, sum(trip_count) AS reported_trips,
         sum(total_amount) AS reported_total,
         count(*) - count(DISTINCT taxi_type || CAST(pickup_date AS VARCHAR)) AS repeated_days
  FROM report
),
facts AS (
  SELECT * FROM clean_facts, report_facts, (SELECT count(*) AS raw_rows FROM ingested)
)"""


@query(
    "Q11 U2 J8 A17",
    f"WITH {_SANITY_SQL} "
    + " UNION ALL ".join(
        f"SELECT '{name}' AS check_name, CAST({value} AS DOUBLE) AS actual_value FROM facts"
        for name, value in _SANITY.items()
    ),
)
def dq_sanity_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.sanity_report(*_layers(spark, sf_dir, "sanity"))


@query(
    "Q12 A17",
    f"""WITH {_LAYERS_SQL}
    SELECT CAST((SELECT count(*) FROM ingested)
                - (SELECT coalesce(sum(trip_count), 0) FROM report) AS BIGINT) AS trip_count_diff,
           CAST(round((SELECT coalesce(sum(CAST(total_amount AS DECIMAL(38,9))), 0) FROM ingested)
                - (SELECT coalesce(sum(total_amount), 0) FROM report), 6) AS DOUBLE)
             AS total_amount_diff""",
)
def reconcile_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ingested rows against the report: the gap is what staging removed."""
    raw, _, report = _layers(spark, sf_dir, "reconcile")
    return q.reconcile(raw, report, "trip_count", "total_amount", "total_amount")



_BUILT_MART = f"""{FACT_SQL},
mart AS (
  SELECT coalesce(pickup_zone, 'Unknown Zone') AS pickup_zone,
         CAST(date_trunc('month', pickup_datetime) AS DATE) AS revenue_month, service_type,
         {_money_sums(MART_MEASURES)}, count(trip_id) AS total_monthly_trips, {_AVERAGES}
  FROM fact GROUP BY 1, 2, 3
)"""


def _build(spark: SparkSession, sf_dir: str, label: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """Staging, cleaned trips, fact and mart in order, each stored and checked before the next."""
    base = workspace(spark, label)
    zones = dim_zones(zone_source(spark, sf_dir))
    stored: dict[str, DataFrame] = {}

    def store(name: str, df: DataFrame) -> DataFrame:
        stored[name] = write(df, f"{base}/{name}")
        return stored[name]

    return q.run_layer(
        [
            (
                "trips",
                lambda: store("trips", clean_trips(staged(spark, sf_dir), payments(spark), YEARS)),
                lambda df: declared.cleaned_trips(),
            ),
            (
                "fact",
                lambda: store(
                    "fact", q.enforce(fact_trips(stored["trips"], zones), fact_contract())
                ),
                lambda df: declared.fact_trips(_zone_ids(spark, zones)),
            ),
            (
                "mart",
                lambda: store("mart", monthly_zone_mart(stored["fact"])),
                lambda df: declared.monthly_zone_mart(),
            ),
        ]
    )


def _zone_ids(spark: SparkSession, zones: DataFrame) -> DataFrame:
    """All ids the stand-in trips use: the known zones, 25 to 29, and the unknown zone 264."""
    return (
        zones.select(F.col("location_id").cast("long").alias("location_id"))
        .unionByName(spark.range(25, 30).withColumnRenamed("id", "location_id"))
        .unionByName(spark.range(264, 265).withColumnRenamed("id", "location_id"))
    )


@query("Q13 K7 J3 A4", f"WITH {_BUILT_MART} SELECT * FROM mart")
def layered_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart at the end of a checked build."""
    built, _ = _build(spark, sf_dir, "layers")
    return built["mart"]


def _null_sql(table: str, column: str) -> tuple[str, str, str, str]:
    return ("not_null", table, column, f"SELECT count(*) FROM {table} WHERE {column} IS NULL")


def _negative_sql(table: str, column: str) -> tuple[str, str, str, str]:
    return ("non_negative", table, column, f"SELECT count(*) FROM {table} WHERE {column} < 0")


def _unknown_zone_sql(column: str) -> tuple[str, str, str, str]:
    return (
        "relationships", "fact", column,
        f"SELECT count(*) FROM fact WHERE {column} NOT IN (SELECT location_id FROM zones)",
    )


@query(
    "Q1 Q2 Q3 Q4 Q14",
    f"""WITH {FACT_SQL}
    {_checks_sql(
        _null_sql("fact", "trip_id"),
        ("unique", "fact", "trip_id", _repeats("fact", "trip_id")),
        *[_null_sql("fact", c)
          for c in ("vendor_id", "service_type", "pickup_datetime", "total_amount")],
        ("accepted_values", "fact", "service_type",
         "SELECT count(*) FROM fact WHERE service_type NOT IN ('Green', 'Yellow')"),
        _unknown_zone_sql("pickup_location_id"),
        _unknown_zone_sql("dropoff_location_id"),
    )}""",
)
def dq_fact_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All checks declared on the fact table; the stand-in trips fail on unknown zones."""
    zones = dim_zones(zone_source(spark, sf_dir))
    stored = write(fact(spark, sf_dir), workspace(spark, "fact"))
    return q.run_checks(stored, "fact", declared.fact_trips(zones))


@query(
    "Q1 Q2 Q5 Q6 Q7",
    f"""WITH {_LAYERS_SQL}, daily AS (
      SELECT taxi_type, CAST(pickup_datetime AS DATE) AS pickup_date, count(*) AS trip_count,
             sum(fare_amount) AS total_fare_amount, sum(total_amount) AS total_amount,
             avg(trip_distance) AS avg_trip_distance
      FROM staging GROUP BY 1, 2)
    {_checks_sql(
        _null_sql("staging", "trip_id"),
        ("unique", "staging", "trip_id", _repeats("staging", "trip_id")),
        *[_null_sql("staging", c) for c in ("taxi_type", "pickup_datetime", "dropoff_datetime")],
        *[_negative_sql("staging", c) for c in ("trip_distance", "fare_amount", "total_amount")],
        ("no_negative_trip_duration", "staging", "",
         "SELECT count(*) FROM staging WHERE dropoff_datetime < pickup_datetime"),
        ("unique_combination", "daily", "taxi_type+pickup_date",
         _repeats("daily", "taxi_type", "pickup_date")),
        *[_negative_sql("daily", c)
          for c in ("trip_count", "total_fare_amount", "total_amount", "avg_trip_distance")],
    )}""",
)
def dq_interval_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All checks declared on the interval-refreshed tables."""
    _, clean, report = _layers(spark, sf_dir, "interval-checks")
    staging = q.run_checks(clean, "staging", declared.interval_staging())
    return staging.unionByName(q.run_checks(report, "daily", declared.interval_report()))
