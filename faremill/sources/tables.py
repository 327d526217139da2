"""The star-schema tables the named queries run on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faremill.sources.files import read_parquet


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, table_path(sf_dir, name))


def plain(df: DataFrame) -> DataFrame:
    """Output form: decimals as doubles, timestamps without a zone."""
    changes = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DecimalType):
            changes[f.name] = F.col(f.name).cast("double")
        elif isinstance(f.dataType, T.TimestampType):
            changes[f.name] = F.col(f.name).cast("timestamp_ntz")
    return df.withColumns(changes) if changes else df
