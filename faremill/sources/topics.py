"""Topic source options. The broker connector is a cluster package, not part of this library."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: the ride event as it travels on the topic
RIDE_EVENT = T.StructType(
    [
        T.StructField("PULocationID", T.IntegerType()),
        T.StructField("DOLocationID", T.IntegerType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("tpep_pickup_datetime", T.LongType()),
    ]
)


def topic_options(
    servers: str, topic: str, start: str = "latest", max_per_trigger: int | None = None
) -> dict[str, str]:
    """``start`` counts only for the first run: afterwards the checkpoint is the bookmark."""
    if start not in ("earliest", "latest"):
        raise ValueError("start is 'earliest' or 'latest'")
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": start,
        "failOnDataLoss": "true",
    }
    if max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def topic_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Messages of a topic as text in column ``value``."""
    raw = spark.readStream.format("kafka").options(**options).load()
    return raw.select(F.col("value").cast("string").alias("value"))


def file_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """The same shape from a folder of landed text files, one message per line."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(path)
