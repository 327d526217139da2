"""Data checks. Every check yields ``(check_name, table_name, column_name, failed_rows, passed)``.

Row checks (null, range, accepted values, custom predicates) of one table share a single
scan and a single aggregation; only uniqueness and relationships shuffle, and they shuffle
partially aggregated keys.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faremill.functions.numbers import exact_parts, exact_sum, joined_parts
from faremill.operators.aggregate import distinct_count, duplicate_keys
from faremill.operators.joins import orphans, orphans_of_large_parent
from faremill.operators.shape import any_null, moment


class CheckFailed(Exception):
    """A layer's checks did not pass; later layers are not built."""


@dataclass(frozen=True)
class RowCheck:
    """Decided row by row: ``bad`` is true for a violating row."""

    name: str
    column: str
    bad: Column


@dataclass(frozen=True)
class TableCheck:
    """Decided on the whole table: ``failed`` gives one row with a single count."""

    name: str
    column: str
    failed: Callable[[DataFrame], DataFrame]


Check = RowCheck | TableCheck


def not_null(col: str) -> RowCheck:
    return RowCheck("not_null", col, F.col(col).isNull())


def positive(col: str) -> RowCheck:
    return RowCheck("positive", col, F.col(col) <= 0)


def non_negative(col: str) -> RowCheck:
    return RowCheck("non_negative", col, F.col(col) < 0)


def accepted_values(
    col: str, values: list, where: Column | None = None, nulls: str = "ignore"
) -> RowCheck:
    """Values outside a list, on the rows in scope; ``nulls='fail'`` counts NULLs as well."""
    bad = F.coalesce(~F.col(col).isin(values), F.lit(nulls == "fail"))
    return RowCheck("accepted_values", col, bad if where is None else bad & where)


def custom(name: str, bad: Column) -> RowCheck:
    """A predicate that no row may satisfy."""
    return RowCheck(name, "", bad)


def _rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("failed_rows"))


def unique(col: str) -> TableCheck:
    """Counts the values that occur more than once; NULLs are not judged."""
    return TableCheck(
        "unique", col, lambda df: _rows(duplicate_keys(df.filter(F.col(col).isNotNull()), col))
    )


def unique_combination(*cols: str) -> TableCheck:
    return TableCheck(
        "unique_combination", "+".join(cols), lambda df: _rows(duplicate_keys(df, *cols))
    )


def relationships(
    fk: str, parent: DataFrame, pk: str, large_parent: bool = False
) -> TableCheck:
    """Counts child rows whose key the parent lacks; NULL keys are not judged.

    ``large_parent`` filters the parent by the child's keys before it is shuffled.
    """
    search = orphans_of_large_parent if large_parent else orphans
    return TableCheck(
        "relationships",
        fk,
        lambda df: search(df, parent, fk, pk).agg(
            F.coalesce(F.sum("child_rows"), F.lit(0)).alias("failed_rows")
        ),
    )


def expect_no_rows(name: str, query: Callable[[DataFrame], DataFrame]) -> TableCheck:
    """Every row the query returns is a failure."""
    return TableCheck(name, "", lambda df: _rows(query(df)))


def expect_value(name: str, query: Callable[[DataFrame], DataFrame], value: int = 0) -> TableCheck:
    """A one-value query must give ``value``; the distance from it is reported, NULL fails."""

    def failed(df: DataFrame) -> DataFrame:
        one = query(df)
        gap = F.abs(F.col(one.columns[0]) - F.lit(value))
        return one.select(F.coalesce(F.ceil(gap), F.lit(1)).alias("failed_rows"))

    return TableCheck(name, "", failed)


def primary_key(col: str) -> list[Check]:
    return [not_null(col), unique(col)]


def _verdict(df: DataFrame, table: str) -> DataFrame:
    return df.select(
        "check_name",
        F.lit(table).alias("table_name"),
        "column_name",
        F.col("failed_rows").cast("long").alias("failed_rows"),
        (F.col("failed_rows") == 0).alias("passed"),
    )


def check_rows(named_values: DataFrame, names: list[str], name: str, value: str) -> DataFrame:
    """Turn one row of aggregates into one row per aggregate, in one pass over the table."""
    pairs = [F.struct(F.lit(n).alias(name), F.col(f"`{n}`").alias(value)) for n in names]
    return named_values.select(F.inline(F.array(*pairs)))


def run_checks(df: DataFrame, table: str, checks: list[Check]) -> DataFrame:
    """All verdicts on one table."""
    frames = []
    by_row = [c for c in checks if isinstance(c, RowCheck)]
    if by_row:
        counts = df.agg(*[F.count_if(c.bad).alias(f"c{i}") for i, c in enumerate(by_row)])
        facts = [
            F.struct(
                F.lit(c.name).alias("check_name"),
                F.lit(c.column).alias("column_name"),
                F.col(f"c{i}").alias("failed_rows"),
            )
            for i, c in enumerate(by_row)
        ]
        frames.append(counts.select(F.inline(F.array(*facts))))
    for c in checks:
        if isinstance(c, TableCheck):
            frames.append(
                c.failed(df).select(
                    F.lit(c.name).alias("check_name"),
                    F.lit(c.column).alias("column_name"),
                    F.col("failed_rows").cast("long").alias("failed_rows"),
                )
            )
    return _verdict(reduce(DataFrame.unionByName, frames), table)


def freshness(
    df: DataFrame,
    table: str,
    col: str,
    as_of: dt.datetime | str,
    warn_hours: int = 24,
    error_hours: int = 48,
) -> DataFrame:
    """Age of the newest row: ``pass``, ``warn`` or ``error``; an empty table is an error.

    Ages are compared in whole seconds.
    """
    age = F.unix_seconds(moment(as_of)) - F.unix_seconds(F.col("newest"))
    status = (
        F.when(age.isNull() | (age > error_hours * 3600), "error")
        .when(age > warn_hours * 3600, "warn")
        .otherwise("pass")
    )
    return df.agg(F.max(col).alias("newest")).select(
        F.lit("freshness").alias("check_name"),
        F.lit(table).alias("table_name"),
        F.lit(col).alias("column_name"),
        age.alias("age_seconds"),
        status.alias("status"),
    )


def contract(df: DataFrame, schema: T.StructType) -> list[str]:
    """Differences between a frame and its declared output; empty when they agree.

    Names and types count, in any order; a declared non-null column is checked by data
    (``not_null``), since nullability is not known before a run.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    want = {f.name: f.dataType for f in schema.fields}
    missing = [f"missing column {n}" for n in want if n not in have]
    extra = [f"undeclared column {n}" for n in have if n not in want]
    types = [
        f"column {n} is {have[n].simpleString()}, declared {t.simpleString()}"
        for n, t in want.items()
        if n in have and have[n] != t
    ]
    return missing + extra + types


def enforce(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The frame in declared column order, or an error naming every difference."""
    problems = contract(df, schema)
    if problems:
        raise CheckFailed("; ".join(problems))
    return df.select(*[f.name for f in schema.fields])


def reconcile(
    detail: DataFrame, report: DataFrame, count_col: str, amount: str, report_amount: str
) -> DataFrame:
    """Row-count and amount difference between a table and a report built from it.

    Empty inputs count as zero. The two one-row totals meet through a scalar subquery.
    """
    rows = detail.agg(F.count(F.lit(1)).alias("rows"), _or_nothing(amount).alias("amount"))
    return _gaps(rows, report, count_col, report_amount)


def _or_nothing(amount: str) -> Column:
    return F.coalesce(exact_sum(amount), F.lit(0).cast("decimal(38,9)"))


def _gaps(rows: DataFrame, report: DataFrame, count_col: str, report_amount: str) -> DataFrame:
    """``rows`` holds one row with ``rows`` and ``amount``. Report amounts are doubles, so the
    difference is told to six decimals."""
    reported = report.agg(F.coalesce(F.sum(count_col), F.lit(0)).cast("long"))
    reported_amount = report.agg(_or_nothing(report_amount))
    gap = F.round(F.col("amount") - reported_amount.scalar(), 6).cast("double")
    return rows.select(
        (F.col("rows") - reported.scalar()).alias("trip_count_diff"),
        gap.alias("total_amount_diff"),
    )


def sanity_report(
    raw: DataFrame,
    clean: DataFrame,
    report: DataFrame,
    raw_name: str = "ingestion.trips",
    clean_name: str = "staging.trips",
    report_name: str = "reports.trips_report",
) -> DataFrame:
    """Fourteen named values over the three layers, each table read once for its own values."""
    # fixed values: the names of the rows, each with what is expected
    one = F.lit(1)
    raw_facts = raw.agg(F.count(one).cast("double").alias(f"{raw_name} row count"))
    times = ("pickup_datetime", "dropoff_datetime")
    counts = {
        "null pickup/dropoff count (expect 0)": F.count_if(any_null(*times)),
        "dropoff before pickup count (expect 0)": F.count_if(
            F.col("dropoff_datetime") < F.col("pickup_datetime")
        ),
        "negative trip_distance count (expect 0)": F.count_if(F.col("trip_distance") < 0),
        "negative fare_amount count (expect 0)": F.count_if(F.col("fare_amount") < 0),
        "negative total_amount count (expect 0)": F.count_if(F.col("total_amount") < 0),
    }
    whole, behind = exact_parts("total_amount")
    # one scan for all but the distinct ids, which alone are shuffled; one row a service
    services = clean.groupBy("taxi_type").agg(
        F.count(one).alias("rows"),
        F.count_if(F.col("trip_id").isNull()).alias("without"),
        F.sum(whole).alias("whole"),
        F.sum(behind).alias("behind"),
        *[v.alias(f"c{i}") for i, v in enumerate(counts.values())],
    )
    added = ["rows", "without", *(f"c{i}" for i in range(len(counts)))]
    facts = services.agg(
        F.count("taxi_type").alias("services"),
        F.coalesce(joined_parts("whole", "behind"), F.lit(0).cast("decimal(38,9)")).alias(
            "amount"
        ),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in added],
    )
    ids = distinct_count(clean, "trip_id", "ids").scalar()
    named = {
        "row count": F.col("rows"),
        "duplicate trip_id count (expect 0)": F.col("rows") - ids,
        "null trip_id count (expect 0)": F.col("without"),
        **{name: F.col(f"c{i}") for i, name in enumerate(counts)},
        "distinct taxi_type count": F.col("services"),
    }
    reported = report.agg(F.coalesce(F.sum("trip_count"), F.lit(0)).cast("long"))
    reported_amount = report.agg(_or_nothing("total_amount"))
    gap = F.round(F.col("amount") - reported_amount.scalar(), 6)
    clean_facts = facts.select(
        *[v.cast("double").alias(f"{clean_name} {k}") for k, v in named.items()],
        (F.col("rows") - reported.scalar())
        .cast("double")
        .alias("staging vs reports trip_count diff (expect 0)"),
        gap.cast("double").alias("staging vs reports total_amount diff (expect ~0)"),
    )
    report_keys = report.groupBy("taxi_type", "pickup_date").agg(F.count(one).alias("copies"))
    report_facts = report_keys.agg(
        F.coalesce(F.sum("copies"), F.lit(0))
        .cast("double")
        .alias(f"{report_name} row count (days x taxi_type)"),
        F.count_if(F.col("copies") > 1)
        .cast("double")
        .alias(f"{report_name} duplicate (taxi_type, pickup_date) count (expect 0)"),
    )
    frames = [
        check_rows(f, f.columns, "check_name", "actual_value")
        for f in (raw_facts, clean_facts, report_facts)
    ]
    return reduce(DataFrame.unionByName, frames).orderBy("check_name")


def run_layer(
    layers: list[tuple[str, Callable[[], DataFrame], Callable[[DataFrame], list[Check]]]],
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Build layers in the given order; stop at the first whose checks fail.

    Each build function should return a frame that reads stored data, so that checking it
    and building on it do not repeat its work. Only verdict rows reach the driver.
    """
    built: dict[str, DataFrame] = {}
    verdicts: list[DataFrame] = []
    for name, build, checks in layers:
        df = build()
        verdict = run_checks(df, name, checks(df))
        rows = verdict.collect()
        bad = [r for r in rows if not r.passed]
        if bad:
            raise CheckFailed(
                "; ".join(
                    f"{r.table_name}: {r.check_name}({r.column_name}) {r.failed_rows} failed"
                    for r in bad
                )
            )
        built[name] = df
        verdicts.append(df.sparkSession.createDataFrame(rows, verdict.schema))
    return built, reduce(DataFrame.unionByName, verdicts)
