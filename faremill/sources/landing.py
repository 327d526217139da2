"""Landed API pages: record selection, page and cursor logic, parent-child rows.

The pages are files (one JSON document per line, or one per file); fetching them is not
part of this library.
"""

from __future__ import annotations

import datetime as dt
import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faremill.operators.aggregate import max_value
from faremill.operators.rows import dedup


def read_pages(spark: SparkSession, path: str, one_per_file: bool = False) -> DataFrame:
    """Landed page bodies as text in column ``body``."""
    return spark.read.text(path, wholetext=one_per_file).withColumnRenamed("value", "body")


def page_records(body: Column | str, selector: str, record: T.StructType) -> Column:
    """The record list of a page: ``$`` is the whole body, otherwise a key of the envelope.

    A body that is cut short, or that does not have this form, is an error.
    """
    many, strict = T.ArrayType(record), {"mode": "FAILFAST"}
    if selector == "$":
        return F.from_json(body, many, strict)
    return F.from_json(body, T.StructType([T.StructField(selector, many)]), strict)[selector]


def unreadable_pages(pages: DataFrame, body: str = "body") -> DataFrame:
    """Pages whose body is missing or no JSON document, to look at or to count."""
    return pages.filter(F.try_parse_json(body).isNull())


def json_records(
    pages: DataFrame, selector: str, record: T.StructType, body: str = "body"
) -> DataFrame:
    """One row per record; other page columns (page number, file) stay beside it."""
    rest = [F.col(c) for c in pages.columns if c != body]
    return pages.select(*rest, F.inline(page_records(body, selector, record)))


def limit_pages(pages: DataFrame, number: str, most: int) -> DataFrame:
    """The reader's own page limit: pages are numbered from ``number``'s first value on."""
    first = pages.agg(F.min(number)).scalar()
    return pages.filter(F.col(number) < first + F.lit(most))


def pages_until_empty(pages: DataFrame, number: str, size: Column) -> DataFrame:
    """Pages before the first empty one; all pages when none is empty.

    ``size`` is 0 for an empty page. A page without a size (NULL, as of a body that cannot be
    read) is not taken for an empty one: it stays, for the reader of its records to fail on.
    """
    sized = pages.withColumn("_size", size)
    first_empty = sized.filter(F.col("_size") == 0).agg(F.min(number)).scalar()
    return sized.filter(F.col(number) < F.coalesce(first_empty, F.col(number) + 1)).drop("_size")


def chunk_count(start: dt.date, end: dt.date, days: int) -> int:
    """How many ranges of ``days + 1`` days it takes to cover both ends."""
    return max(0, (end - start).days // (days + 1) + 1)


def chunk_bounds(
    start: dt.date, end: dt.date, days: int, number: int
) -> tuple[dt.date, dt.date]:
    """The inclusive range with this number, counted back from ``end``; the last is cut at
    ``start``. The form of ``chunk_table`` for a caller that names resources by their dates."""
    offset = number * (days + 1)
    return (
        max(start, end - dt.timedelta(days=offset + days)),
        end - dt.timedelta(days=offset),
    )


def date_chunks(start: dt.date, end: dt.date, days: int) -> list[tuple[dt.date, dt.date]]:
    """All ranges, newest first."""
    return [chunk_bounds(start, end, days, n) for n in range(chunk_count(start, end, days))]


def chunk_table(spark: SparkSession, start: dt.date, end: dt.date, days: int) -> DataFrame:
    """The same ranges as rows ``(chunk, low, high)``."""
    steps = f"sequence(0, datediff(date'{end}', date'{start}') div {days + 1})"
    return (
        spark.range(1)
        .select(F.posexplode(F.expr(steps)).alias("chunk", "_step"))
        .withColumn("high", F.expr(f"date_sub(date'{end}', chunk * {days + 1})"))
        .withColumn("low", F.expr(f"greatest(date'{start}', date_sub(high, {days}))"))
        .select("chunk", "low", "high")
    )


def chunk_of(day: Column, start: dt.date, end: dt.date, days: int) -> Column:
    """Number of the range a day falls into, counted from the end; NULL outside all of them."""
    number = F.floor(F.date_diff(F.lit(end), day) / (days + 1)).cast("int")
    return F.when(day.between(F.lit(start), F.lit(end)), number)


def union_chunks(frames: list[DataFrame], key: list[str]) -> DataFrame:
    """Several chunk resources in one table, one row per key: the copy of the first resource
    in the list that has it, among its own copies the lowest in all columns."""
    numbered = [f.withColumn("_resource", F.lit(i)) for i, f in enumerate(frames)]
    return dedup(reduce(DataFrame.unionByName, numbered), key, "_resource").drop("_resource")


def initial_cursor(as_of: dt.datetime, days: int = 30) -> dt.datetime:
    return as_of - dt.timedelta(days=days)


def cursor_slice(
    df: DataFrame, col: str, state: DataFrame | None, initial: dt.datetime
) -> DataFrame:
    """Records from the stored cursor on (inclusive); from ``initial`` on in the first run."""
    begin: Column = F.lit(initial.isoformat()).cast("timestamp")
    if state is not None:
        begin = F.coalesce(max_value(state, "cursor"), begin)
    return df.filter(F.col(col) >= begin)


def cursor_state(df: DataFrame, col: str) -> DataFrame:
    """The one-row state to store after a load."""
    return df.agg(F.max(col).alias("cursor"))


def child_with_parent(
    parent: DataFrame,
    child: DataFrame,
    parent_key: str,
    child_key: str,
    copy: list[str],
    parent_name: str,
) -> DataFrame:
    """Child rows with columns of their parent copied in as ``_<parent>_<column>``."""
    carried = parent.select(
        F.col(parent_key).alias("_parent_key"),
        *[F.col(c).alias(f"_{parent_name}_{c}") for c in copy],
    )
    return child.join(carried, child[child_key] == carried["_parent_key"]).drop("_parent_key")


def snake(name: str) -> str:
    """``utcDate`` -> ``utc_date``, ``@id`` -> ``id``."""
    spaced = re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", name)
    return re.sub(r"[^0-9a-zA-Z]+", "_", spaced).strip("_").lower()


def flatten(df: DataFrame, sep: str = "__") -> DataFrame:
    """Struct leaves become columns ``a__b__c`` with normalised names; arrays stay."""

    def leaves(schema: T.StructType, path: Column | None, prefix: str) -> list[Column]:
        out = []
        for field in schema.fields:
            at = F.col(f"`{field.name}`") if path is None else path.getField(field.name)
            name = prefix + snake(field.name)
            if isinstance(field.dataType, T.StructType):
                out += leaves(field.dataType, at, name + sep)
            else:
                out.append(at.alias(name))
        return out

    return df.select(*leaves(df.schema, None, ""))
