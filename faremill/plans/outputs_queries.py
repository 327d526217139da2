"""Jobs, seeds, file counts, named tables, sample windows, incremental loads that move rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faremill import jobs as commands
from faremill.operators import incremental as inc
from faremill.operators.joins import if_small
from faremill.operators.shape import sample_window as sample_window_of
from faremill.operators.writers import materialize, preview, write
from faremill.plans.revenue_queries import _AVERAGES, _RAW_SQL, _money_sums
from faremill.plans.stand_ins import green_source, yellow_source
from faremill.plans.streams_queries import _RIDES_SQL, _send, _typed, rides
from faremill.plans.trips import ZONE_ID_MEASURES
from faremill.registry import query
from faremill.session import workspace
from faremill.sources import landing
from faremill.sources.files import head_rows, seed
from faremill.sources.tables import load, plain
from faremill.streaming import jobs


@query(
    "S10",
    f"""WITH {_RAW_SQL}
    SELECT PULocationID AS revenue_zone, CAST(date_trunc('month', pickup_datetime) AS DATE)
             AS revenue_month, service_type, {_money_sums(ZONE_ID_MEASURES)}, {_AVERAGES}
    FROM raw_trips GROUP BY 1, 2, 3""",
)
def monthly_report_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job as spark-submit starts it: paths in, a report folder out."""
    base = workspace(spark, "report-job")
    green_source(spark, sf_dir).write.parquet(f"{base}/green")
    yellow_source(spark, sf_dir).write.parquet(f"{base}/yellow")
    arguments = ["--green", f"{base}/green", "--yellow", f"{base}/yellow"]
    commands.main(["monthly-report", *arguments, "--output", f"{base}/out"], spark)
    return spark.read.parquet(f"{base}/out")


@query("S11", "SELECT n_nationkey, n_name FROM nation")
def seed_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace(spark, "seed")
    nation = load(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    nation.write.option("header", True).csv(path)
    return seed(spark, path, "n_nationkey int, n_name string", key="n_nationkey")


@query(
    "K2 K3",
    "SELECT 5 AS files, 1 AS single_files, count(*) AS row_count FROM orders",
)
def file_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same orders in a fixed number of files and in a single one."""
    base = workspace(spark, "file-counts")
    orders = load(spark, sf_dir, "orders")
    many = write(orders, f"{base}/many", repartition=5)
    one = write(orders.select("o_orderkey"), f"{base}/one", coalesce=1)
    name = F.col("_metadata.file_path")
    files = many.select(name.alias("f")).agg(
        F.count_distinct("f").alias("files"), F.count("*").alias("row_count")
    )
    single = one.select(name.alias("f")).agg(F.count_distinct("f").alias("single_files"))
    return files.crossJoin(F.broadcast(single)).select(
        F.col("files").cast("int"), F.col("single_files").cast("int"), "row_count"
    )


@query(
    "K7",
    """SELECT o_orderstatus, count(*) AS row_count, count(DISTINCT o_custkey) AS customers
       FROM orders GROUP BY 1""",
)
def named_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A view and a stored table, known to SQL by their names; the table is replaced as a whole."""
    path = workspace(spark, "named")
    orders = load(spark, sf_dir, "orders")
    materialize(orders.select("o_orderstatus", "o_custkey"), "view", "named_orders")
    counts = spark.sql(
        """SELECT o_orderstatus, count(*) AS row_count, count(DISTINCT o_custkey) AS customers
           FROM named_orders GROUP BY 1"""
    )
    materialize(counts.limit(0), "table", "named_counts", path)
    materialize(counts, "table", "named_counts", path)
    return spark.sql("SELECT * FROM named_counts")


@query(
    "F10",
    """SELECT o_orderkey, o_orderdate FROM orders
       WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1997-02-01'""",
)
def development_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixed window of a development run; without one nothing is left out."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    everything = sample_window_of(orders, "o_orderdate", None)
    window = (dt.datetime(1997, 1, 1), dt.datetime(1997, 2, 1))
    return plain(sample_window_of(everything, "o_orderdate", window))


@query(
    "J9",
    """SELECT l_orderkey, l_linenumber, p_brand, s_name FROM lineitem
       JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey""",
)
def broadcast_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two lookups, each hinted only if the planner's estimate is within the threshold."""
    items = load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"
    )
    part = load(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    supplier = load(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), "s_name"
    )
    joined = items.join(if_small(part), "l_partkey").join(if_small(supplier), "l_suppkey")
    return joined.select("l_orderkey", "l_linenumber", "p_brand", "s_name")


@query(
    "T4",
    f"""WITH {_RIDES_SQL}
    SELECT reader, PULocationID, count(*) AS row_count
    FROM rides, (VALUES ('first'), ('second')) AS readers(reader) GROUP BY 1, 2""",
)
def independent_readers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two readers with bookmarks of their own; each gets every message once."""
    base = workspace(spark, "readers")
    _send(rides(spark, sf_dir), f"{base}/topic")
    found = []
    for reader in ("first", "second"):
        stream = _typed(spark, f"{base}/topic")
        out = f"{base}/{reader}"
        jobs.drain(jobs.to_files(stream, out, f"{base}/bookmark-{reader}", interval=None))
        found.append(spark.read.parquet(out).withColumn("reader", F.lit(reader)))
    return found[0].unionByName(found[1]).groupBy("reader", "PULocationID").agg(
        F.count("*").alias("row_count")
    )


@query("P8", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 10")
def first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a look at a table shows."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    first = head_rows(orders, 10, "o_orderkey")
    preview(first)
    return first


@query(
    "K9",
    """SELECT event_id, event_type,
              CASE WHEN event_type = 'click' THEN CAST(ts AS DATE) + 3 ELSE CAST(ts AS DATE) END
                AS event_day
       FROM events""",
)
def merge_moves_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks turn out to belong three days later: their rows move to other directories."""
    path = workspace(spark, "merge-moves")
    events = load(spark, sf_dir, "events").select(
        "event_id", "event_type", F.to_date("ts").alias("event_day")
    )
    inc.create(events, path, "event_day")
    clicks = events.filter(F.col("event_type") == "click").withColumn(
        "event_day", F.date_add("event_day", 3)
    )
    inc.merge(clicks, path, ["event_id"], "event_day")
    return inc.merge(clicks, path, ["event_id"], "event_day")


@query(
    "K10 F4",
    """SELECT o_orderkey, o_orderdate, CAST(date_trunc('month', o_orderdate) AS DATE) AS month
       FROM orders
       WHERE o_orderdate < '1997-03-10' OR o_orderdate >= '1997-05-20' OR o_orderstatus = 'F'""",
)
def interval_replace_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A window that begins and ends inside a month, on a target laid out by month."""
    path = workspace(spark, "interval-months")
    orders = load(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderdate", "o_orderstatus", F.trunc("o_orderdate", "month").alias("month")
    )
    columns = ["o_orderkey", "o_orderdate", "month"]
    inc.create(orders.select(*columns), path, "month")
    fresh = orders.filter(F.col("o_orderstatus") == "F").select(*columns)
    window = (dt.datetime(1997, 3, 10), dt.datetime(1997, 5, 20))
    for _ in range(2):
        result = inc.replace_interval(fresh, path, "o_orderdate", *window, partition="month")
    return plain(result.select(*columns))


@query(
    "S15 K9 A16",
    """SELECT o_orderkey, o_orderstatus,
              CASE WHEN o_orderdate >= (SELECT max(o_orderdate) FROM orders
                                        WHERE o_orderdate < '2000-01-01')
                   THEN 2 ELSE 1 END AS run
       FROM orders""",
)
def cursor_merge_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads from a stored cursor, merged by id: what the inclusive cursor reads twice is
    there once."""
    base = workspace(spark, "cursor-load")
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    known = orders.filter(F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp"))
    state, initial = None, dt.datetime(1990, 1, 1)
    for run, source in enumerate((known, orders), 1):
        fresh = landing.cursor_slice(source, "o_orderdate", state, initial)
        loaded = inc.merge(fresh.withColumn("run", F.lit(run)), f"{base}/orders", ["o_orderkey"])
        state = write(landing.cursor_state(loaded, "o_orderdate"), f"{base}/cursor-{run}")
    return loaded.select("o_orderkey", "o_orderstatus", "run")
