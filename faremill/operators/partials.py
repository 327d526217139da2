"""Reports kept up to date from partial results.

A report's parts are sums, counts and the counts of averages per group: parts of different rows
add up to the parts of all. Each increment of the fact table leaves its parts in a folder of its
own, named after it, so that repeating an increment replaces its parts and counts nothing twice.
The report is made of the parts alone and never reads earlier rows again. Sums are exact
decimals, so the report does not depend on how the rows came in.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faremill.functions.numbers import exact_sum
from faremill.functions.times import month_date, to_day
from faremill.operators import incremental as inc
from faremill.operators.aggregate import revenue_name
from faremill.operators.writers import by_directory


@dataclass(frozen=True)
class Report:
    """Result columns by name: ``keys`` from expressions, the others from columns.

    Parts and report are laid out by ``month``, the month of that key.
    """

    keys: dict[str, Column]
    month: str
    sums: dict[str, str] = field(default_factory=dict)
    counts: dict[str, str | None] = field(default_factory=dict)  # None: all rows
    averages: dict[str, str] = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return [*self.keys, *self.sums, *self.counts, *self.averages]

    def parts(self, df: DataFrame) -> DataFrame:
        """One row per group; an average leaves a sum and a count."""
        types = {f.name: f.dataType for f in df.schema}

        def summed(name: str, col: str) -> Column:
            return exact_sum(col, types[col]).alias(name)

        rows = [
            (F.lit(1) if c is None else F.col(c), n) for n, c in self.counts.items()
        ]
        return df.groupBy(*[c.alias(n) for n, c in self.keys.items()]).agg(
            *[summed(n, c) for n, c in self.sums.items()],
            *[F.count(c).alias(n) for c, n in rows],
            *[summed(f"{n}__sum", c) for n, c in self.averages.items()],
            *[F.count(c).alias(f"{n}__count") for n, c in self.averages.items()],
        )

    def merged(self, parts: DataFrame) -> DataFrame:
        """Parts of several increments as the parts of all their rows."""
        exact = [*self.sums, *(f"{n}__sum" for n in self.averages)]
        counted = [*self.counts, *(f"{n}__count" for n in self.averages)]
        return parts.groupBy(*self.keys).agg(
            *[F.sum(n).cast("decimal(38,9)").alias(n) for n in exact],
            *[F.sum(n).alias(n) for n in counted],
        )

    def finished(self, parts: DataFrame) -> DataFrame:
        """The report of merged parts; its numbers are rounded once, to doubles."""
        whole = [F.col(f"{n}__sum").cast("double") for n in self.averages]
        count = [F.col(f"{n}__count").cast("double") for n in self.averages]
        return parts.select(
            *self.keys,
            *[F.col(n).cast("double").alias(n) for n in self.sums],
            *self.counts,
            *[F.try_divide(w, c).alias(n) for n, w, c in zip(self.averages, whole, count)],
        )


def monthly_revenue_report(
    zone: str,
    time: str,
    measures: list[str],
    unknown: str | None = None,
    service: str = "service_type",
    trip_key: str | None = None,
    zone_name: str = "revenue_zone",
) -> Report:
    """``aggregate.monthly_revenue`` in parts."""
    place = F.col(zone) if unknown is None else F.coalesce(F.col(zone), F.lit(unknown))
    return Report(
        keys={zone_name: place, "revenue_month": month_date(time), service: F.col(service)},
        month="revenue_month",
        sums={revenue_name(m): m for m in measures},
        counts={} if trip_key is None else {"total_monthly_trips": trip_key},
        averages={
            "avg_monthly_passenger_count": "passenger_count",
            "avg_monthly_trip_distance": "trip_distance",
        },
    )


def daily_service_report(service: str, time: str) -> Report:
    """``aggregate.daily_report`` in parts."""
    return Report(
        keys={service: F.col(service), "pickup_date": to_day(time)},
        month="pickup_date",
        sums={"total_fare_amount": "fare_amount", "total_amount": "total_amount"},
        counts={"trip_count": None},
        averages={"avg_trip_distance": "trip_distance"},
    )


# --- the stored parts -------------------------------------------------------------------

INCREMENT = "_increment"
MONTH = "_month"


def _with_month(report: Report, rows: DataFrame) -> DataFrame:
    return rows.withColumn(MONTH, F.trunc(report.month, "month"))


def add_increment(report: Report, rows: DataFrame, path: str, name: str) -> list:
    """Store the parts of an increment's rows; the parts it had before are replaced.

    Returns the months whose report changes: those it has rows in now, or had before.
    """
    if not name or "/" in name or "=" in name:
        raise ValueError("an increment's name is a folder's")
    spark, folder = rows.sparkSession, f"{path}/{INCREMENT}={name}"
    before = _months(spark, folder)
    parts = by_directory(_with_month(report, report.parts(rows)), [MONTH])
    parts.write.mode("overwrite").partitionBy(MONTH).parquet(folder)
    inc._remember_schema(spark, folder, parts.schema)
    return list(dict.fromkeys([*before, *_months(spark, folder)]))


def _months(spark: SparkSession, folder: str) -> list[dt.date | None]:
    """The months an increment has parts of, from its directories."""
    prefix = f"{MONTH}="
    names = [c.removeprefix(prefix) for c in inc._children(spark, folder) if c.startswith(prefix)]
    return [None if n.startswith("__") else dt.date.fromisoformat(n) for n in names]


def increments(spark: SparkSession, path: str) -> list[str]:
    """The names of the increments whose parts are complete."""
    return inc.complete_folders(spark, path, f"{INCREMENT}=")


def stored_parts(spark: SparkSession, path: str) -> DataFrame:
    """The parts of all increments; what a failed one left behind is not read."""
    folders = [f"{path}/{INCREMENT}={name}" for name in increments(spark, path)]
    # an increment without rows has no files
    known = inc._known_schema(spark, folders[0])
    return spark.read.schema(known).option("basePath", path).parquet(*folders)


def current_report(spark: SparkSession, report: Report, path: str) -> DataFrame:
    """The whole report, from the parts alone."""
    return report.finished(report.merged(stored_parts(spark, path)))


def refresh_report(
    spark: SparkSession, report: Report, path: str, target: str, months: list
) -> DataFrame:
    """Replace the given months of the stored report; the others keep their files."""
    some = stored_parts(spark, path).filter(inc._one_of(MONTH, months))
    rows = _with_month(report, report.finished(report.merged(some)))
    if not inc.exists(spark, target):
        return inc.create(rows, target, MONTH).select(report.columns)
    inc._replace_and_empty(rows, target, MONTH, months, None)
    return inc.read_target(spark, target).select(report.columns)
