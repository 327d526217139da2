"""Command-line jobs for spark-submit. Paths are arguments and may be on any file system.

    spark-submit faremill/jobs.py monthly-report --green G --yellow Y --output O
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faremill.functions.codes import PAYMENT_DESCRIPTIONS
from faremill.operators import incremental as inc
from faremill.operators import marks, partials
from faremill.operators import quality as q
from faremill.operators.buckets import merge_bucketed
from faremill.operators.joins import code_table
from faremill.operators.writers import append, write, write_months, write_table
from faremill.plans import declared_checks as checks
from faremill.plans import trips as t
from faremill.session import build_session, use_utc
from faremill.sources.files import read_csv, read_parquet
from faremill.sources.months import read_months
from faremill.sources.quarantine import set_aside, split_csv
from faremill.sources.topics import RIDE_EVENT, topic_options, topic_stream
from faremill.streaming import jobs as streams

# fixed values: declared CSV schemas of the monthly trip files
GREEN_CSV = (
    "VendorID int, lpep_pickup_datetime timestamp, lpep_dropoff_datetime timestamp, "
    "store_and_fwd_flag string, RatecodeID int, PULocationID int, DOLocationID int, "
    "passenger_count int, trip_distance double, fare_amount double, extra double, "
    "mta_tax double, tip_amount double, tolls_amount double, ehail_fee double, "
    "improvement_surcharge double, total_amount double, payment_type int, trip_type int, "
    "congestion_surcharge double"
)
YELLOW_CSV = (
    "VendorID int, tpep_pickup_datetime timestamp, tpep_dropoff_datetime timestamp, "
    "passenger_count int, trip_distance double, RatecodeID int, store_and_fwd_flag string, "
    "PULocationID int, DOLocationID int, payment_type int, fare_amount double, extra double, "
    "mta_tax double, tip_amount double, tolls_amount double, improvement_surcharge double, "
    "total_amount double, congestion_surcharge double"
)
HIGH_VOLUME_CSV = (
    "hvfhs_license_num string, dispatching_base_num string, pickup_datetime timestamp, "
    "dropoff_datetime timestamp, PULocationID int, DOLocationID int, SR_Flag string"
)
FHV_CSV = (
    "dispatching_base_num string, pickup_datetime timestamp, dropOff_datetime timestamp, "
    "PUlocationID double, DOlocationID double, SR_Flag string, Affiliated_base_number string"
)
ZONE_CSV = "LocationID int, Borough string, Zone string, service_zone string"

CSV_SCHEMAS = {
    "green": (GREEN_CSV, "lpep_pickup_datetime"),
    "yellow": (YELLOW_CSV, "tpep_pickup_datetime"),
    "high-volume": (HIGH_VOLUME_CSV, "pickup_datetime"),
    "fhv": (FHV_CSV, "pickup_datetime"),
}


def monthly_report(
    spark: SparkSession, green: str, yellow: str, output: str, connector: str | None = None,
    files: int | None = None,
) -> None:
    """Monthly revenue by zone id; ``output`` is a path, or a table of ``connector``.

    ``files`` fixes the number of files; by default there are as many as the report fills.
    """
    report = t.monthly_zone_id_report(
        t.union_raw(read_parquet(spark, green), read_parquet(spark, yellow))
    )
    if connector:
        write_table(report, connector, output, {}, "overwrite")
    else:
        # with a fixed number the aggregation before it still stays spread over all tasks
        write(report, output, "overwrite", repartition=files)


def hourly_report(
    spark: SparkSession, green: str, yellow: str, zones: str, output: str, since: str
) -> None:
    """Hourly revenue of both services side by side, with zone names."""
    compared = t.hourly_comparison(
        read_parquet(spark, green), read_parquet(spark, yellow),
        "lpep_pickup_datetime", "tpep_pickup_datetime", since,
    )
    # the zone join and other readers start from the stored comparison
    total = write(compared, f"{output}/total", "overwrite")
    lookup = read_csv(spark, zones, ZONE_CSV)
    write(t.comparison_with_zones(total, lookup), f"{output}/zones", "overwrite")


def convert_months(
    spark: SparkSession, service: str, csv: str, output: str, bad: str | None = None
) -> DataFrame:
    """CSV files of any number of months to Parquet under ``year=/month=``, in one job.

    With a folder ``bad`` lines that do not fit the schema are set aside there.
    """
    schema, time = CSV_SCHEMAS[service]
    if bad is None:
        return write_months(read_csv(spark, csv, schema), output, time)
    rows, _ = set_aside(*split_csv(spark, csv, schema), bad)
    return write_months(rows, output, time)


def build_marts(
    spark: SparkSession, green: str, yellow: str, zones: str, output: str, years: list[int]
) -> dict[str, DataFrame]:
    """Cleaned trips, fact table (merged by trip id, newer trips only) and monthly mart.

    Each service has its own mark, so that one that lags behind loses no trips. The mart is made
    of stored parts, to which a run adds those of its new trips. The marks move last: after a
    failure the same trips are taken again, merged by their id, and replace their parts.
    """
    lookup = t.dim_zones(read_csv(spark, zones, ZONE_CSV))
    payments = code_table(spark, PAYMENT_DESCRIPTIONS, "payment_type", "description")
    unioned = t.union_staged(
        t.stage_green(read_parquet(spark, green)), t.stage_yellow(read_parquet(spark, yellow))
    )
    fact_path, marks_path, month = f"{output}/fact_trips", f"{output}/marks", "pickup_month"
    known = marks.read_marks(spark, marks_path)
    trips = t.clean_trips(unioned, payments, years)
    newer = marks.newer_than_marks(trips, known, "service_type", "pickup_datetime")
    rows = q.enforce(t.fact_trips(newer, lookup), t.fact_contract()).withColumn(
        month, F.trunc("pickup_datetime", "month")
    )

    def mart(new: DataFrame) -> DataFrame:
        report, parts = t.monthly_zone_mart_report(), f"{output}/monthly_zone_parts"
        partials.add_increment(report, new, parts, marks.name_of(known))
        current = partials.current_report(spark, report, parts)
        return write(current, f"{output}/monthly_zone_revenue", "overwrite")

    with inc.staged(rows) as new:
        built, _ = q.run_layer(
            [
                (
                    "fact_trips",
                    # the id is hashed from the pickup time, so it decides the month
                    lambda: inc.merge(new, fact_path, ["trip_id"], month, moves=False),
                    lambda df: checks.fact_trips(lookup),
                ),
                (
                    "monthly_zone_revenue",
                    lambda: mart(new),
                    lambda df: checks.monthly_zone_mart(),
                ),
                (
                    "dim_vendors",
                    lambda: write(t.dim_vendors(unioned), f"{output}/dim_vendors", "overwrite"),
                    lambda df: q.primary_key("vendor_id"),
                ),
                (
                    "dim_zones",
                    lambda: write(lookup, f"{output}/dim_zones", "overwrite"),
                    lambda df: q.primary_key("location_id"),
                ),
            ]
        )
        newest = marks.newest_by_source(new, "service_type", "pickup_datetime")
        marks.store_marks(newest, marks_path)
    return built


def build_green_fact(spark: SparkSession, green: str, zones: str, output: str) -> DataFrame:
    """Green trips newer than the table's newest one, merged by row id into a table with a
    directory per day, whose files hold ranges of boroughs."""
    day = "pickup_day"
    rows = t.green_rows(read_parquet(spark, green))
    lookup = t.dim_zones(read_csv(spark, zones, ZONE_CSV))
    known = inc.newest_partition(spark, output, day) if inc.exists(spark, output) else None
    newer = inc.incremental_slice(rows, known, "pickup_datetime")
    # the id is hashed from the pickup time too, so it decides the day
    return inc.merge(
        t.green_fact(newer, lookup), output, ["unique_row_id"], day, moves=False,
        cluster_by=["pickup_borough"],
    )


def merge_by_key(
    spark: SparkSession, source: str, target: str, key: list[str], buckets: int
) -> DataFrame:
    """An increment into a table without a date column; only the buckets of its keys are touched."""
    return merge_bucketed(read_parquet(spark, source), target, key, buckets)


def refresh_interval(
    spark: SparkSession, base: str, output: str, services: list[str], start: dt.date, end: dt.date,
    extracted_at: dt.datetime,
) -> dict[str, DataFrame]:
    """Ingest the months of a window, refresh staging and the daily report, check each layer."""
    month = "pickup_month"
    window = (dt.datetime.combine(start, dt.time()), dt.datetime.combine(end, dt.time()))

    def staging() -> DataFrame:
        fetched = read_months(spark, base, services, start, end, extracted_at).withColumn(
            month, F.trunc("pickup_datetime", "month")
        )
        ingested = append(fetched, f"{output}/ingested", [month])
        arrived = inc.within(ingested, "pickup_datetime", *window, month, "month")
        rows = t.interval_staging(arrived, *window).withColumn(
            month, F.trunc("pickup_datetime", "month")
        )
        return inc.replace_interval(
            rows, f"{output}/staging", "pickup_datetime", *window, partition=month
        )

    def report() -> DataFrame:
        staged = inc.within(
            inc.read_target(spark, f"{output}/staging"), "pickup_datetime", *window, month, "month"
        )
        fresh = t.interval_report(staged, *window).withColumn(
            month, F.trunc("pickup_date", "month")
        )
        return inc.replace_interval(
            fresh, f"{output}/report", "pickup_date", *window, granularity="date", partition=month
        )

    built, _ = q.run_layer(
        [
            ("staging.trips", staging, lambda df: checks.interval_staging()),
            ("reports.trips_report", report, lambda df: checks.interval_report()),
        ]
    )
    return built


def stream_rides(
    spark: SparkSession, servers: str, topic: str, url: str, table: str, checkpoint: str,
    start: str = "latest",
) -> None:
    """Ride events of a topic into a JDBC table, until the job is stopped or fails."""
    rides = streams.passthrough(
        topic_stream(spark, topic_options(servers, topic, start)), RIDE_EVENT,
        "tpep_pickup_datetime", "pickup_datetime",
    )
    writer = streams.jdbc_writer({"url": url}, table)
    streams.drain(streams.to_batches(rides, writer, checkpoint))


def _arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(description="Trip analytics jobs")
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, *required: str, **optional: str | None) -> None:
        sub = jobs.add_parser(name)
        for option in required:
            sub.add_argument(f"--{option}", required=True)
        for option, default in optional.items():
            sub.add_argument(f"--{option}", default=default)

    job("monthly-report", "green", "yellow", "output", connector=None, files=None)
    job("hourly-report", "green", "yellow", "zones", "output", since="2020-01-01 00:00:00")
    job("convert-months", "service", "csv", "output", bad=None)
    job("build-marts", "green", "yellow", "zones", "output", years="2019,2020")
    job("green-fact", "green", "zones", "output")
    job("merge-by-key", "source", "target", "key", buckets="64")
    job(
        "refresh-interval", "base", "output", "start", "end", "extracted_at",
        services="yellow,green",
    )
    job("stream-rides", "servers", "topic", "url", "table", "checkpoint", start="latest")
    return parser


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    options = vars(_arguments().parse_args(argv))
    name = options.pop("job")
    if "years" in options:
        options["years"] = [int(y) for y in options["years"].split(",")]
    if options.get("files"):
        options["files"] = int(options["files"])
    if name == "merge-by-key":
        options["key"] = options["key"].split(",")
        options["buckets"] = int(options["buckets"])
    if name == "refresh-interval":
        options["services"] = options["services"].split(",")
        options["start"] = dt.date.fromisoformat(options["start"])
        options["end"] = dt.date.fromisoformat(options["end"])
        options["extracted_at"] = dt.datetime.fromisoformat(options["extracted_at"])
    run = {
        "monthly-report": monthly_report,
        "hourly-report": hourly_report,
        "convert-months": convert_months,
        "build-marts": build_marts,
        "green-fact": build_green_fact,
        "merge-by-key": merge_by_key,
        "refresh-interval": refresh_interval,
        "stream-rides": stream_rides,
    }[name]
    run(use_utc(spark or build_session(f"faremill-{name}")), **options)


if __name__ == "__main__":
    main()
