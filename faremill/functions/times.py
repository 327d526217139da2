"""Date and time expressions. All timestamps are UTC instants."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trunc_ts(col: Column | str, unit: str) -> Column:
    return F.date_trunc(unit, _col(col))


def to_day(col: Column | str) -> Column:
    return F.to_date(_col(col))


def month_date(col: Column | str) -> Column:
    """First day of the month, as a DATE on every target."""
    return F.trunc(F.to_date(_col(col)), "month")


def naive(col: Column | str) -> Column:
    """Drop the zone for output, so that readers see the UTC wall clock."""
    return _col(col).cast("timestamp_ntz")


def hours_between(start: Column | str, end: Column | str) -> Column:
    """Whole-second difference in hours, as a double."""
    return (F.unix_seconds(_col(end)) - F.unix_seconds(_col(start))) / F.lit(3600.0)


def minutes_between(start: Column | str, end: Column | str) -> Column:
    """Number of minute boundaries crossed: 00:00:50 to 00:01:10 is 1."""

    def minute(c: Column) -> Column:
        return F.floor(F.unix_seconds(c) / 60)

    return (minute(_col(end)) - minute(_col(start))).cast("long")


def plus_seconds(col: Column | str, seconds: Column) -> Column:
    return F.timestamp_micros(F.unix_micros(_col(col)) + seconds.cast("long") * 1_000_000)


def from_epoch_ms(col: Column | str) -> Column:
    return F.timestamp_millis(_col(col))


def to_epoch_ms(col: Column | str) -> Column:
    return F.unix_millis(_col(col))
