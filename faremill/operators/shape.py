"""Column shape and row predicates."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def common_columns(left: DataFrame, right: DataFrame) -> list[str]:
    """Names both frames have, in the order of the left one (case-insensitive like Spark)."""
    other = {c.lower() for c in right.columns}
    return [c for c in left.columns if c.lower() in other]


def align(df: DataFrame, columns: dict[str, tuple[object, str]]) -> DataFrame:
    """Add the columns the frame lacks as typed constants ``name -> (value, type)``."""
    have = {c.lower() for c in df.columns}
    return df.withColumns(
        {
            name: F.lit(value).cast(dtype)
            for name, (value, dtype) in columns.items()
            if name.lower() not in have
        }
    )


def cast_as(df: DataFrame, types: dict[str, str], safe: set[str] | None = None) -> DataFrame:
    """Cast columns in place; those named in ``safe`` give NULL on unreadable text."""
    safe = safe or set()
    return df.withColumns(
        {
            name: F.col(name).try_cast(t) if name in safe else F.col(name).cast(t)
            for name, t in types.items()
        }
    )


def drop_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Drop by exact spelling: ``zone`` leaves ``Zone`` alone, unlike ``DataFrame.drop``."""
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in set(names)])


def union_services(frames: dict[str, DataFrame], tag: str = "service_type") -> DataFrame:
    """UNION ALL by name over the columns all services share, each row tagged with its service."""
    first, *others = frames.values()
    shared = reduce(
        lambda names, df: [c for c in names if c.lower() in {x.lower() for x in df.columns}],
        others,
        first.columns,
    )
    tagged = [df.select(*shared).withColumn(tag, F.lit(name)) for name, df in frames.items()]
    return reduce(DataFrame.unionByName, tagged)


def where_present(df: DataFrame, *cols: str) -> DataFrame:
    return df.filter(reduce(Column.__and__, [F.col(c).isNotNull() for c in cols]))


def where_any_null(df: DataFrame, *cols: str) -> DataFrame:
    return df.filter(any_null(*cols))


def any_null(*cols: str) -> Column:
    return reduce(Column.__or__, [F.col(c).isNull() for c in cols])


def moment(value: dt.date | dt.datetime | str) -> Column:
    text = value if isinstance(value, str) else value.isoformat()
    return F.lit(text).cast("timestamp")


def in_interval(col: str, start: object, end: object) -> Column:
    """Half-open window ``[start, end)``; plain comparisons, so the scan can prune."""
    return (F.col(col) >= moment(start)) & (F.col(col) < moment(end))


def between_dates(col: str, low: dt.date | str, high: dt.date | str) -> Column:
    """Both days included, judged on the calendar day."""
    low, high = (dt.date.fromisoformat(str(d)) for d in (low, high))
    return in_interval(col, low, high + dt.timedelta(days=1))


def on_day(col: str, day: dt.date | str) -> Column:
    return between_dates(col, day, day)


def in_years(col: str, years: list[int]) -> Column:
    """Year in a set, as timestamp ranges: adjacent years merge, and the scan can prune."""
    spans: list[list[int]] = []
    for year in sorted(set(years)):
        if spans and spans[-1][1] == year - 1:
            spans[-1][1] = year
        else:
            spans.append([year, year])
    ranges = [in_interval(col, dt.date(a, 1, 1), dt.date(b + 1, 1, 1)) for a, b in spans]
    return reduce(Column.__or__, ranges)


def sample_window(df: DataFrame, col: str, window: tuple[object, object] | None) -> DataFrame:
    """Development runs pass a fixed window, production runs pass nothing."""
    return df if window is None else df.filter(in_interval(col, *window))


def unpivot(
    df: DataFrame, ids: list[str], values: list[str], variable: str, value: str
) -> DataFrame:
    return df.unpivot(ids, values, variable, value)


def by_side(is_home: Column, home: Column | str, away: Column | str) -> Column:
    as_col = lambda c: F.col(c) if isinstance(c, str) else c
    return F.when(is_home, as_col(home)).otherwise(as_col(away))
