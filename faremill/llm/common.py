"""Shared helpers of the corpus operators.

Every operator takes the frame and the names of its columns, selects what it needs under
internal names, and returns the key columns and its results only: further input columns, also
ones that are called like a result, cannot clash. A missing column or one that does not fit
is an error when the plan is built.
"""

from __future__ import annotations

import math
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faremill.session import workspace

# Arrow batches hold at most so many rows on the way to Python, as texts may be long
BATCH_ROWS = 512


PACKAGE = Path(__file__).resolve().parents[1]


def prepare(spark: SparkSession) -> SparkSession:
    """Send this package to the Python workers once a session, and bound their batches."""
    context = spark.sparkContext
    if not any(f.endswith(f"/{PACKAGE.name}.zip") for f in context.listFiles):
        folder = tempfile.mkdtemp(prefix=f"{PACKAGE.name}-")
        built = shutil.make_archive(
            f"{folder}/{PACKAGE.name}", "zip", PACKAGE.parent, PACKAGE.name
        )
        context.addPyFile(built)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """The frame as a written table in the shared folder.

    Cuts the lineage, so that a lost executor repeats single tasks, and fixes what a second
    evaluation could deliver in another order (partition numbers, arrival order).
    """
    path = workspace(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# rows below this size are not worth a filter; by default Spark waits for 10 GB
FILTERED = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"


def rows_of(df: DataFrame, column: str, wanted: DataFrame, label: str) -> DataFrame:
    """The rows of ``df`` whose ``column`` is among the ``wanted``, as a stored table.

    ``wanted`` is a stored table of distinct numbers in a column of that name. Spark then drops
    most other rows with a Bloom filter of bounded size before they are shuffled; a filter that
    is too small for its numbers lets more rows pass, and the join removes them.
    """
    spark = df.sparkSession
    before = spark.conf.get(FILTERED)
    spark.conf.set(FILTERED, "0")
    try:
        # always true for a number; Spark makes such a filter only from a side with a condition
        some = wanted.filter(F.col(column) >= F.lit(-(1 << 62) * 2))
        return stored(df.join(some, column, "left_semi"), label)
    finally:
        spark.conf.set(FILTERED, before)


def as_row(df: DataFrame) -> Column:
    """All columns as one struct, beside which any name is free."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def whole(text: str) -> Column:
    """A text column with NULL as the empty text."""
    return F.coalesce(F.col(text), F.lit(""))


def parts_for(amount: float, each: float) -> int:
    """How many partitions hold ``amount``, ``each`` per partition."""
    return max(1, math.ceil(amount / each))


# --- rows that a list of keys may concern -----------------------------------------------

SIEVE_BITS = 1 << 25  # 4 MB, whatever the number of keys
PAGE_BITS = 1 << 15  # of Spark's bitmap functions


def _place(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(SIEVE_BITS)).cast("int")


def sieve(wanted: DataFrame, key: str) -> DataFrame:
    """A bitmap of the keys' hashes, in pages: at most 1,024 rows of 4 KB, to be broadcast."""
    place = _place(F.col(key))
    rows = wanted.select(
        F.floor(place / PAGE_BITS).cast("int").alias("_page"),
        (place % PAGE_BITS).cast("long").alias("_bit"),
    )
    return rows.groupBy("_page").agg(F.bitmap_construct_agg("_bit").alias("_bits"))


def sifted(df: DataFrame, key: str, pages: DataFrame, name: str) -> DataFrame:
    """``df`` with ``name``: whether the key may be in the sieve. No row moves.

    True for every key that is, and for others by chance: rarely, unless the keys are as many as
    the bits.
    """
    place = _place(F.col(key))
    marked = df.withColumn("_page", F.floor(place / PAGE_BITS).cast("int"))
    found = marked.join(F.broadcast(pages), "_page", "left")
    bit = place % PAGE_BITS
    byte = F.substring("_bits", F.floor(bit / 8).cast("int") + 1, F.lit(1))
    value = F.conv(F.hex(byte), 16, 10).cast("int")
    inside = F.expr("getbit(_value, _at)")
    found = found.withColumn("_value", F.coalesce(value, F.lit(0))).withColumn("_at", bit % 8)
    return found.withColumn(name, inside == 1).drop("_page", "_bits", "_value", "_at")
