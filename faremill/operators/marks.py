"""High-water marks by source: how far each source of a table has been loaded.

With one mark for all, rows of a source that lags behind the others would never be taken. The
marks are a small table, a row a source, stored beside what they belong to.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faremill.operators import incremental as inc

SOURCE, MARK = "source", "mark"
# up to so many sources the marks become constants of a filter, which reaches the scan
FILTERED = 100


def newest_by_source(df: DataFrame, source: str, time: str) -> DataFrame:
    """The marks of these rows; a NULL source is one like any other."""
    newest = df.groupBy(F.col(source).alias(SOURCE)).agg(F.max(time).alias(MARK))
    return newest.filter(F.col(MARK).isNotNull())


def read_marks(spark: SparkSession, path: str) -> DataFrame | None:
    return inc.read_target(spark, path) if inc.exists(spark, path) else None


def store_marks(marks: DataFrame, path: str) -> DataFrame:
    """Keep the higher mark of each source, the stored or the new one."""
    spark = marks.sparkSession
    known = read_marks(spark, path)
    every = marks if known is None else known.unionByName(marks)
    inc.commit(every.groupBy(SOURCE).agg(F.max(MARK).alias(MARK)), path)
    inc.drop_old_versions(spark, path)
    return inc.read_target(spark, path)


def newer_than_marks(
    df: DataFrame,
    marks: DataFrame | None,
    source: str,
    time: str,
    lookback: dt.timedelta | None = None,
    inclusive: bool = False,
) -> DataFrame:
    """Rows newer than their own source's mark, and all rows of a source without one.

    ``lookback`` moves every mark back; ``inclusive`` takes rows equal to the mark as well.
    """
    if marks is None:
        return df
    at = F.col(MARK)
    if lookback is not None:
        at = at - F.make_dt_interval(secs=F.lit(lookback.total_seconds()))
    kind = marks.schema[MARK].dataType
    bounds = marks.select(SOURCE, at.cast(kind).alias(MARK))
    few = bounds.select(SOURCE, _as_number(MARK, kind)).limit(FILTERED + 1).collect()
    if len(few) <= FILTERED:
        return df.filter(_newer([tuple(r) for r in few], df, source, time, inclusive))
    later = F.col(time) >= F.col("_mark") if inclusive else F.col(time) > F.col("_mark")
    named = bounds.select(F.col(SOURCE).alias("_source"), F.col(MARK).alias("_mark"))
    joined = df.join(named, F.col(source).eqNullSafe(F.col("_source")), "left")
    return joined.filter(F.col("_mark").isNull() | later).drop("_source", "_mark")


def _as_number(column: str, kind: T.DataType) -> Column:
    """Times travel as integers, not as local clock times."""
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column).alias(column)
    return F.col(column).cast("string").alias(column)


def _constant(value: object, kind: T.DataType) -> Column:
    if isinstance(kind, T.TimestampType):
        return F.timestamp_micros(F.lit(value).cast("long"))
    return F.lit(value).cast(kind)


def _newer(bounds: list, df: DataFrame, source: str, time: str, inclusive: bool) -> Column:
    column, at = F.col(source), F.col(time)
    kinds = df.schema[source].dataType, df.schema[time].dataType

    def later(mark: object) -> Column:
        bound = _constant(mark, kinds[1])
        return at >= bound if inclusive else at > bound

    known = [(s, m) for s, m in bounds if s is not None]
    without = [m for s, m in bounds if s is None]
    parts = [(column == F.lit(s).cast(kinds[0])) & later(m) for s, m in known]
    parts.append(~column.isin([s for s, _ in known]) if known else column.isNotNull())
    parts.append(column.isNull() & (later(without[0]) if without else F.lit(True)))
    return reduce(Column.__or__, parts)


def name_of(marks: DataFrame | None) -> str:
    """A name for what comes after these marks: the same until they are moved."""
    if marks is None:
        return "start"
    row = F.concat_ws("=", F.coalesce(F.col(SOURCE).cast("string"), F.lit("")), F.col(MARK).cast("string"))
    texts = F.array_join(F.sort_array(F.collect_list(row)), ",")
    return "after-" + marks.agg(F.md5(texts)).head()[0]
