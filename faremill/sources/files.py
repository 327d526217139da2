"""Readers for CSV and Parquet. Paths may be local, on HDFS or on an object store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str | None = None,
    infer: bool = False,
    header: bool = True,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """CSV with a header row: all strings, a declared schema, or inferred types.

    Inference reads the whole input once more; prefer a schema or ``infer_from_sample``.
    """
    reader = spark.read.option("header", header).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def infer_from_sample(spark: SparkSession, path: str, rows: int = 1000) -> T.StructType:
    """Column types judged on the first ``rows`` data lines; see ``read_sampled``."""
    header, *data = [r.value for r in spark.read.text(path).head(rows + 1)]
    # a short first file is followed by the next one, which brings its header line again
    lines = [header, *[line for line in data if line != header]]
    sample = spark.sparkContext.parallelize(lines, 1)
    return spark.read.option("header", True).option("inferSchema", True).csv(sample).schema


def read_sampled(spark: SparkSession, path: str, rows: int = 1000) -> DataFrame:
    """CSV with the types of its first ``rows`` lines; a later value that does not fit them is
    an error when it is read."""
    schema = infer_from_sample(spark, path, rows)
    return read_csv(spark, path, schema=schema, options={"mode": "FAILFAST"})


def external_csv(
    spark: SparkSession,
    name: str,
    glob: str,
    schema: T.StructType | str,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Name a set of (gzipped) CSV files as a table; the files stay where they are.

    A gzip file cannot be split: one task per file, so land many moderate files.
    """
    df = read_csv(spark, glob, schema=schema, options=options)
    df.createOrReplaceTempView(name)
    return df


def instants(df: DataFrame) -> DataFrame:
    """Zone-less timestamps become UTC instants; filters still reach the scan."""
    zoneless = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in zoneless}) if zoneless else df


def read_parquet(
    spark: SparkSession,
    path: str | list[str],
    columns: list[str] | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Files, folders or globs; times stored without a zone are read as UTC."""
    paths = [path] if isinstance(path, str) else path
    df = instants(spark.read.options(**(options or {})).parquet(*paths))
    return df.select(*columns) if columns else df


def head_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    """First ``n`` rows in a stated order (per-task heaps, no full sort)."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in order]).limit(n)


def object_store_conf(scheme: str, options: dict[str, str]) -> dict[str, str]:
    """Session settings for an object-store connector, e.g. ``fs.gs.*`` or ``fs.s3a.*``."""
    return {f"spark.hadoop.fs.{scheme}.{key}": value for key, value in options.items()}


def seed(
    spark: SparkSession, path: str, schema: T.StructType | str, key: str | None = None
) -> DataFrame:
    """A small lookup CSV with declared types; rows without a key are an error of the file."""
    df = read_csv(spark, path, schema=schema)
    if key is not None and df.filter(F.col(key).isNull()).limit(1).count():
        raise ValueError(f"lookup {path} has rows without {key}")
    return df
