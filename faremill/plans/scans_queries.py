"""Scans, filters and counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faremill.functions.numbers import total
from faremill.operators.aggregate import distinct_count, row_count
from faremill.operators.shape import between_dates, on_day
from faremill.operators.writers import table_copy as table_copy_of, write, write_months
from faremill.plans.stand_ins import YELLOW_SQL, yellow_source
from faremill.registry import query
from faremill.session import workspace
from faremill.sources.files import (
    external_csv,
    head_rows,
    read_csv,
    read_parquet,
    read_sampled,
)
from faremill.sources.tables import load, plain, table_path

ORDER_CSV = (
    "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp, o_orderpriority string"
)


@query("S6 A1", "SELECT count(*) AS row_count FROM lineitem")
def scan_parquet_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_count(read_parquet(spark, table_path(sf_dir, "lineitem")))


@query(
    "S8 P1 O4",
    """SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem
       ORDER BY l_orderkey, l_linenumber, l_quantity, l_extendedprice LIMIT 1000""",
)
def scan_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"]
    return head_rows(
        read_parquet(spark, table_path(sf_dir, "lineitem"), columns), 1000, *columns
    )


@query("F2 A1", "SELECT count(*) AS zero_rows FROM lineitem WHERE l_discount = 0")
def zero_amount_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_count(load(spark, sf_dir, "lineitem").filter(F.col("l_discount") == 0), "zero_rows")


@query("A9", f"WITH {YELLOW_SQL} SELECT count(DISTINCT PULocationID) AS zones FROM yellow_raw")
def count_distinct_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_count(yellow_source(spark, sf_dir), "PULocationID", "zones")


@query(
    "F5 A15",
    """SELECT DISTINCT l_suppkey FROM lineitem
       WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '1998-03-01' AND DATE '1998-03-15'""",
)
def distinct_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = load(spark, sf_dir, "lineitem")
    window = items.filter(between_dates("l_shipdate", "1998-03-01", "1998-03-15"))
    return window.select("l_suppkey").distinct()


@query(
    "F7 A2",
    """SELECT CAST(ts AS DATE) AS trip_day, count(*) AS trip_count FROM events
       WHERE CAST(ts AS DATE) = DATE '2024-01-15' GROUP BY 1""",
)
def trips_on_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = load(spark, sf_dir, "events").filter(on_day("ts", "2024-01-15"))
    return day.groupBy(F.to_date("ts").alias("trip_day")).agg(F.count("*").alias("trip_count"))


@query(
    "F1 P1",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'",
)
def status_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F")
    return orders.select("o_orderkey", "o_custkey", "o_totalprice")


def _landed_csv(
    spark: SparkSession, sf_dir: str, label: str, options: dict[str, str] | None = None
) -> str:
    """All orders as CSV files with a header row."""
    path = workspace(spark, label)
    orders = load(spark, sf_dir, "orders")
    orders.write.option("header", True).options(**(options or {})).csv(path)
    return path


_CSV_REPORT = """
SELECT o_orderstatus, count(*) AS row_count, min(CAST(o_orderdate AS DATE)) AS first_day,
       max(o_custkey) AS last_customer,
       CAST(CAST(sum(CAST(o_totalprice AS DECIMAL(38,9))) AS VARCHAR) AS DOUBLE) AS total_price
FROM orders GROUP BY o_orderstatus"""


def _csv_report(orders: DataFrame) -> DataFrame:
    return orders.groupBy("o_orderstatus").agg(
        F.count("*").alias("row_count"),
        F.min(F.to_date("o_orderdate")).alias("first_day"),
        F.max("o_custkey").cast("long").alias("last_customer"),
        total("o_totalprice").alias("total_price"),
    )


@query(
    "S1",
    """SELECT o_orderstatus, count(*) AS row_count, max(CAST(o_orderkey AS VARCHAR)) AS last_key,
              min(o_orderpriority) AS first_priority
       FROM orders GROUP BY o_orderstatus""",
)
def scan_csv_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = read_csv(spark, _landed_csv(spark, sf_dir, "csv-strings"))
    return texts.groupBy("o_orderstatus").agg(
        F.count("*").alias("row_count"),
        F.max("o_orderkey").alias("last_key"),
        F.min("o_orderpriority").alias("first_priority"),
    )


@query("S2", _CSV_REPORT)
def scan_csv_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _csv_report(read_csv(spark, _landed_csv(spark, sf_dir, "csv-typed"), ORDER_CSV))


@query("S3", _CSV_REPORT)
def scan_csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _csv_report(read_csv(spark, _landed_csv(spark, sf_dir, "csv-inferred"), infer=True))


@query("S4", _CSV_REPORT)
def scan_sample_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _landed_csv(spark, sf_dir, "csv-sample")
    return _csv_report(read_sampled(spark, path, 1000))


@query("S5", _CSV_REPORT)
def scan_csv_gz_glob(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _landed_csv(spark, sf_dir, "csv-gz", {"compression": "gzip"})
    external_csv(spark, "orders_external", f"{path}/*.csv.gz", ORDER_CSV)
    return _csv_report(spark.table("orders_external"))


@query(
    "S2 K4",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS year,
              CAST(month(o_orderdate) AS INTEGER) AS month, count(*) AS row_count,
              CAST(CAST(sum(CAST(o_totalprice AS DECIMAL(38,9))) AS VARCHAR) AS DOUBLE) AS total_price
       FROM orders GROUP BY 1, 2""",
)
def csv_to_parquet_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = read_csv(spark, _landed_csv(spark, sf_dir, "csv-months"), ORDER_CSV)
    months = write_months(typed, workspace(spark, "parquet-months"), "o_orderdate")
    return months.groupBy("year", "month").agg(
        F.count("*").alias("row_count"), total("o_totalprice").alias("total_price")
    )


@query(
    "K5 F4",
    """SELECT CAST(o_orderdate AS DATE) AS order_day, o_orderstatus, count(*) AS row_count
       FROM orders WHERE o_orderdate >= '1998-03-01' AND o_orderdate < '1998-04-01'
       GROUP BY 1, 2""",
)
def partitioned_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store by month, clustered by status; the read touches one directory only."""
    orders = load(spark, sf_dir, "orders").withColumn(
        "order_month", F.trunc(F.to_date("o_orderdate"), "month")
    )
    stored = write(
        orders, workspace(spark, "partitioned"), partition_by=["order_month"],
        cluster_by=["o_orderstatus"],
    )
    march = stored.filter(F.col("order_month") == F.lit("1998-03-01").cast("date"))
    return march.groupBy(F.to_date("o_orderdate").alias("order_day"), "o_orderstatus").agg(
        F.count("*").alias("row_count")
    )


@query("K1 K12", "SELECT * FROM customer")
def write_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store a table twice at one place: the second write replaces the first."""
    path = workspace(spark, "overwrite")
    customer = load(spark, sf_dir, "customer")
    write(customer.withColumn("c_acctbal", F.lit(0.0)), path)
    return write(customer, path, "overwrite")


@query(
    "S21",
    "SELECT event_id, ts, user_id, event_type, value, props FROM events",
)
def table_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(table_copy_of(load(spark, sf_dir, "events"), workspace(spark, "copy")))
