"""Monthly files, landed pages, chunks, cursors, nested records."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faremill.functions.numbers import total
from faremill.operators.writers import by_directory
from faremill.plans.stand_ins import (
    GREEN_SQL,
    MATCHES_SQL,
    YELLOW_SQL,
    green_source,
    match_source,
    yellow_source,
)
from faremill.registry import query
from faremill.session import workspace
from faremill.sources import landing, months, nested, quarantine
from faremill.sources.files import read_parquet
from faremill.sources.tables import load, plain

EXTRACTED = dt.datetime(2024, 2, 1, 12, 0)


@query(
    "S9 U3 X22 P2",
    f"""WITH {GREEN_SQL}, {YELLOW_SQL}, both_services AS (
      SELECT 'green' AS taxi_type, pickup_datetime, total_amount, ehail_fee FROM green_raw
      UNION ALL SELECT 'yellow', pickup_datetime, total_amount, NULL FROM yellow_raw)
    SELECT taxi_type, CAST(date_trunc('month', pickup_datetime) AS DATE) AS pickup_month,
           count(*) AS trips, count(ehail_fee) AS trips_with_fee,
           CAST(CAST(sum(CAST(total_amount AS DECIMAL(38,9))) AS VARCHAR) AS DOUBLE) AS total_amount,
           TIMESTAMP '2024-02-01 12:00:00' AS extracted_at
    FROM both_services GROUP BY 1, 2""",
)
def ingest_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both services land as one folder per month and are read back for their whole range."""
    base = workspace(spark, "months")
    frames = []
    for service, source in (("green", green_source), ("yellow", yellow_source)):
        time = months.PICKUP_COLUMN[service]
        trips = source(spark, sf_dir).withColumn("month", F.date_format(time, "yyyy-MM"))
        by_directory(trips, ["month"]).write.partitionBy("month").parquet(f"{base}/{service}")
        first, last = trips.agg(F.min(F.to_date(time)), F.max(F.to_date(time))).head()
        frames.append(
            months.read_months(
                spark, base, [service], first, last + dt.timedelta(days=1), EXTRACTED,
                layout="{base}/{service}/month={month}",
            )
        )
    ingested = months.union_by_name(frames)
    return plain(
        ingested.groupBy(
            "taxi_type", F.trunc(F.to_date("pickup_datetime"), "month").alias("pickup_month")
        ).agg(
            F.count("*").alias("trips"),
            F.count("ehail_fee").alias("trips_with_fee"),
            total("total_amount").alias("total_amount"),
            F.max("extracted_at").alias("extracted_at"),
        )
    )


@query(
    "S14 U4",
    """SELECT CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-12-31') // 701 AS INTEGER)
                AS chunk,
              greatest(DATE '1995-01-01', DATE '2001-12-31' - CAST(701 * (1 + date_diff('day',
                CAST(o_orderdate AS DATE), DATE '2001-12-31') // 701) - 1 AS INTEGER)) AS low,
              count(*) AS row_count,
              CAST(CAST(sum(CAST(o_totalprice AS DECIMAL(38,9))) AS VARCHAR) AS DOUBLE) AS total_price
       FROM orders GROUP BY 1, 2""",
)
def date_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each date range lands as a resource of its own; together they are the whole table."""
    start, end, days = dt.date(1995, 1, 1), dt.date(2001, 12, 31), 700
    orders = load(spark, sf_dir, "orders").withColumn("day", F.to_date("o_orderdate"))
    base = workspace(spark, "chunks")
    labelled = orders.withColumn("part", landing.chunk_of(F.col("day"), start, end, days))
    by_directory(labelled.filter("part IS NOT NULL"), ["part"]).write.partitionBy("part").parquet(
        base
    )
    loaded = landing.union_chunks(
        [
            read_parquet(spark, f"{base}/part={i}").withColumn("chunk", F.lit(i))
            for i in range(len(landing.date_chunks(start, end, days)))
        ],
        ["o_orderkey"],
    )
    totals = loaded.groupBy("chunk").agg(
        F.count("*").alias("row_count"), total("o_totalprice").alias("total_price")
    )
    bounds = landing.chunk_table(spark, start, end, days).select("chunk", "low")
    return totals.join(bounds, "chunk").select("chunk", "low", "row_count", "total_price")


@query(
    "S15 A16",
    """SELECT o_orderstatus, count(*) AS row_count, min(CAST(o_orderdate AS DATE)) AS first_day
       FROM orders
       WHERE o_orderdate >= (SELECT max(o_orderdate) FROM orders WHERE o_orderdate < '2000-01-01')
       GROUP BY o_orderstatus""",
)
def cursor_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first load stores its cursor; the next one starts there."""
    orders = load(spark, sf_dir, "orders")
    loaded = orders.filter(F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp"))
    where = workspace(spark, "cursor")
    landing.cursor_state(loaded, "o_orderdate").write.parquet(where)
    initial = landing.initial_cursor(dt.datetime(2000, 1, 1))
    fresh = landing.cursor_slice(orders, "o_orderdate", read_parquet(spark, where), initial)
    return fresh.groupBy("o_orderstatus").agg(
        F.count("*").alias("row_count"), F.min(F.to_date("o_orderdate")).alias("first_day")
    )


# --- landed pages ---------------------------------------------------------------------

PAGE_SIZE = 40
RECORD = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("customer", T.LongType()),
        T.StructField("price", T.DoubleType()),
    ]
)
EVERY = 97  # the last of so many page numbers is an empty page
_RECORDS_SQL = f"""
numbered AS (SELECT *, o_orderkey // {PAGE_SIZE} AS n FROM orders),
paged AS (
  SELECT n + n // {EVERY - 1} AS page, o_orderkey AS id, o_custkey AS customer,
         o_totalprice AS price
  FROM numbered
)"""


def _landed_pages(spark: SparkSession, sf_dir: str, label: str) -> DataFrame:
    """All orders as numbered API pages of at most 40 records, and some empty pages between."""
    record = F.struct(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("customer"),
        F.col("o_totalprice").alias("price"),
    )
    path = workspace(spark, label)
    orders = load(spark, sf_dir, "orders").withColumn("n", F.expr(f"o_orderkey div {PAGE_SIZE}"))
    full = orders.groupBy(F.expr(f"n + n div {EVERY - 1}").alias("page")).agg(
        F.collect_list(record).alias("matches")
    )
    empty = (
        orders.select(F.expr(f"n div {EVERY - 1} * {EVERY} + {EVERY - 1}").alias("page"))
        .distinct()
        .withColumn("matches", F.array().cast(full.schema["matches"].dataType))
    )
    bodies = full.unionByName(empty).select(F.to_json(F.struct("page", "matches")).alias("value"))
    bodies.write.text(path)
    pages = landing.read_pages(spark, path)
    return pages.withColumn("page", F.get_json_object("body", "$.page").cast("long"))


@query("S12", f"WITH {_RECORDS_SQL} SELECT page, id, customer, price FROM paged")
def json_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing.json_records(_landed_pages(spark, sf_dir, "records"), "matches", RECORD)


@query(
    "S13",
    f"""WITH {_RECORDS_SQL}
    SELECT page, id, customer, price FROM paged
    WHERE page < {EVERY - 1}""",
)
def pages_until_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _landed_pages(spark, sf_dir, "until-empty")
    size = F.json_array_length(F.get_json_object("body", "$.matches"))
    return landing.json_records(
        landing.pages_until_empty(pages, "page", size), "matches", RECORD
    )


@query(
    "S17",
    f"""WITH {_RECORDS_SQL}
    SELECT page, id, customer, price FROM paged
    WHERE page < (SELECT min(page) FROM paged) + 25""",
)
def limit_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _landed_pages(spark, sf_dir, "limited")
    return landing.json_records(landing.limit_pages(pages, "page", 25), "matches", RECORD)


@query(
    "S16",
    """SELECT l_orderkey, l_linenumber, l_quantity, o_orderkey AS _orders_o_orderkey,
              o_orderstatus AS _orders_o_orderstatus
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def parent_child(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return landing.child_with_parent(
        load(spark, sf_dir, "orders"), items, "o_orderkey", "l_orderkey",
        ["o_orderkey", "o_orderstatus"], "orders",
    )


@query(
    "R3 X21 S12",
    f"""WITH {MATCHES_SQL}
    SELECT id, status, utc_date, CAST(season__start_date AS DATE) AS season__start_date,
           score__winner, score__full_time__home, score__full_time__away, home_team__id,
           away_team__id
    FROM matches""",
)
def json_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = match_source(spark, sf_dir)
    path = workspace(spark, "nested")
    nested.write.json(path)
    return plain(landing.flatten(spark.read.schema(nested.schema).json(path)))


# --- lists below records --------------------------------------------------------------


@query(
    "R3 S12 S16",
    """WITH items AS (
      SELECT l_orderkey, l_linenumber, l_quantity, [l_returnflag, l_linestatus] AS flags,
             row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_quantity,
               l_returnflag, l_linestatus) - 1 AS item
      FROM lineitem)
    SELECT o_orderkey AS id, o_custkey AS customer__id, CAST(item AS INTEGER) AS item,
           l_linenumber AS line, l_quantity AS quantity, CAST(k AS INTEGER) AS place,
           flags[k + 1] AS flag
    FROM items JOIN orders ON l_orderkey = o_orderkey, (SELECT unnest([0, 1]) AS k)""",
)
def nested_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their items, and those with their flags, landed as nested records; they become
    three tables, which are joined back by their keys."""
    items = load(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.sort_array(
            F.collect_list(
                F.struct(
                    F.col("l_linenumber").alias("line"),
                    F.col("l_quantity").alias("quantity"),
                    F.array("l_returnflag", "l_linestatus").alias("lineFlags"),
                )
            )
        ).alias("orderItems")
    )
    orders = load(spark, sf_dir, "orders")
    records = orders.join(items, F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.col("o_orderkey").alias("id"),
        F.struct(F.col("o_custkey").alias("id")).alias("customer"),
        "orderItems",
    )
    base = workspace(spark, "lists")
    # names and punctuation are most of the text
    records.write.json(f"{base}/landed", compression="gzip")
    landed = spark.read.schema(records.schema).json(f"{base}/landed")
    tables = nested.write_lists(landed, "orders", f"{base}/tables", ["id"])
    line = nested.with_parent(tables["orders__order_items"], tables["orders"], ["id", "customer__id"])
    line = line.withColumnRenamed(nested.PLACE, "item")
    columns = ["id", "customer__id", "item", "line", "quantity"]
    flags = nested.with_parent(tables["orders__order_items__line_flags"], line, columns)
    return flags.select(*columns, F.col(nested.PLACE).alias("place"), F.col("value").alias("flag"))


# --- bad lines and pages --------------------------------------------------------------

# one line in 101 has a word for the customer's number, and one a field too many
_WORD, _WIDE = "o_orderkey % 101 = 7", "o_orderkey % 101 = 9"
_LINE = "o_orderkey long, o_custkey long, o_orderstatus string, order_day date"


def _split_lines(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    customer = F.when(F.expr(_WORD), "none").otherwise(F.col("o_custkey").cast("string"))
    status = F.when(F.expr(_WIDE), "a,b").otherwise(F.col("o_orderstatus"))
    day = F.to_date("o_orderdate").cast("string")
    line = F.concat_ws(",", F.col("o_orderkey").cast("string"), customer, status, day)
    base = workspace(spark, "lines")
    load(spark, sf_dir, "orders").select(line).write.text(base)
    return quarantine.split_csv(spark, base, _LINE, header=False)


@query(
    "S4 S2",
    f"""SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_orderdate AS DATE) AS order_day
       FROM orders WHERE NOT ({_WORD}) AND NOT ({_WIDE})""",
)
def lines_past_bad_ones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV lines that fit the schema; the planted bad ones do not stop the reader."""
    return _split_lines(spark, sf_dir)[0]


@query(
    "S4 A2",
    f"""SELECT o_orderkey,
              CASE WHEN {_WORD} THEN 'not of its type: o_custkey' ELSE 'other number of fields' END
                AS reason
       FROM orders WHERE {_WORD} OR {_WIDE}""",
)
def quarantined_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The planted lines with their reason, as they were set aside."""
    good, bad = _split_lines(spark, sf_dir)
    path = workspace(spark, "bad-lines")
    quarantine.set_aside(good, bad, path)
    number = F.substring_index("line", ",", 1).cast("long").alias("o_orderkey")
    return spark.read.parquet(path).select(number, "reason")


# one page in 13 is cut short, and records whose price has a seven before the point are spoilt
_CUT = "page % 13 = 5"


def _split_pages(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    pages = _landed_pages(spark, sf_dir, "bad-pages")
    wrong = F.regexp_replace("body", r'"price":\d+7\.\d+', '"price":"none"')
    cut = F.when(F.expr(_CUT), F.expr("substr(body, 1, length(body) - 3)")).otherwise(wrong)
    return quarantine.split_pages(pages.withColumn("body", cut), "matches", RECORD)


_SPLIT_SQL = f"""{_RECORDS_SQL}, marked AS (
  SELECT *, {_CUT} AS cut, price >= 17 AND CAST(floor(price) AS BIGINT) % 10 = 7 AS wrong FROM paged
)"""


@query(
    "S12 S13",
    f"WITH {_SPLIT_SQL} SELECT page, id, customer, price FROM marked WHERE NOT cut AND NOT wrong",
)
def records_past_bad_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that can be read, from pages of which some are cut short and some hold others."""
    return _split_pages(spark, sf_dir)[0]


@query(
    "S12 S13",
    f"""WITH {_SPLIT_SQL},
    page_numbers AS (
      SELECT page FROM paged
      UNION SELECT o_orderkey // {PAGE_SIZE} // {EVERY - 1} * {EVERY} + {EVERY - 1} FROM orders)
    SELECT page, 'no JSON document' AS reason, 1 AS rows FROM page_numbers WHERE {_CUT}
    UNION ALL
    SELECT page, 'record does not fit', count(*) FROM marked WHERE NOT cut AND wrong GROUP BY page""",
)
def quarantined_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many records of which pages were set aside, and which pages as a whole."""
    good, bad = _split_pages(spark, sf_dir)
    path = workspace(spark, "bad-records")
    quarantine.set_aside(good, bad, path)
    return spark.read.parquet(path).groupBy("page", "reason").agg(F.count("*").alias("rows"))
