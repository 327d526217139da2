"""Structured Streaming jobs. The checkpoint folder is the reader's bookmark: one per reader."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from faremill.functions.events import parse_event
from faremill.functions.numbers import total
from faremill.functions.times import from_epoch_ms


def passthrough(
    messages: DataFrame,
    schema: T.StructType,
    epoch_ms: str,
    out: str,
    value: str = "value",
) -> DataFrame:
    """JSON messages to typed columns; ``epoch_ms`` becomes the timestamp ``out``.

    Stateless: no row is late here, whatever its age.
    """
    rows = messages.select(parse_event(value, schema).alias("e")).select("e.*")
    kept = [F.col(f.name) for f in schema.fields if f.name != epoch_ms]
    return rows.select(*kept, from_epoch_ms(epoch_ms).alias(out))


def late_by(arrived: str, happened: str) -> Column:
    """Seconds between the event and its arrival."""
    return (F.unix_micros(F.col(arrived)) - F.unix_micros(F.col(happened))) / F.lit(1e6)


def flag_late(df: DataFrame, arrived: str, happened: str, seconds: float) -> DataFrame:
    """Mark events that arrived ``seconds`` or more after they happened."""
    return df.withColumn("is_late", late_by(arrived, happened) >= seconds)


def windowed(
    df: DataFrame, time: str, delay: str, width: str, keys: list[str], amount: str
) -> DataFrame:
    """Count and sum per tumbling window and key; rows older than the watermark are dropped.

    State is one small row per open window and key. A window is emitted once it is closed.
    """
    return (
        df.withWatermark(time, delay)
        .groupBy(F.window(time, width).alias("w"), *keys)
        .agg(
            F.count(F.lit(1)).alias("number_records"),
            total(amount).alias("amount"),
        )
        .select(F.col("w.start").alias("window_start"), *keys, "number_records", "amount")
    )


def _trigger(writer: DataStreamWriter, interval: str | None) -> DataStreamWriter:
    # no interval: take everything there is, in bounded batches, and stop
    if interval:
        return writer.trigger(processingTime=interval)
    return writer.trigger(availableNow=True)


def to_files(
    df: DataFrame, path: str, checkpoint: str, interval: str | None = "10 seconds"
) -> StreamingQuery:
    """Append to a Parquet folder; the sink's own log makes each batch count once."""
    writer = df.writeStream.format("parquet").outputMode("append")
    return _trigger(writer.option("checkpointLocation", checkpoint), interval).start(path)


def to_batches(
    df: DataFrame,
    write_batch: Callable[[DataFrame, int], None],
    checkpoint: str,
    interval: str | None = "10 seconds",
) -> StreamingQuery:
    """Hand every micro-batch to ``write_batch``; it must be safe to repeat for one batch id."""
    writer = df.writeStream.foreachBatch(write_batch).outputMode("append")
    return _trigger(writer.option("checkpointLocation", checkpoint), interval).start()


def batch_folder_writer(path: str) -> Callable[[DataFrame, int], None]:
    """Each batch owns a directory, so a repeated batch replaces itself."""

    def write_batch(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write_batch


def jdbc_writer(options: dict[str, str], table: str) -> Callable[[DataFrame, int], None]:
    """Append each batch over JDBC from the executors, tagged with its batch id.

    A batch is repeated after a failure, so read the table through ``dedup`` on its event
    key and ``batch_id``, or let a unique constraint refuse the repeats.
    """

    def write_batch(df: DataFrame, batch_id: int) -> None:
        tagged = df.withColumn("batch_id", F.lit(batch_id).cast("long"))
        tagged.write.format("jdbc").mode("append").options(**options, dbtable=table).save()

    return write_batch


def to_console(df: DataFrame, rows: int = 10) -> DataStreamWriter:
    return df.writeStream.format("console").option("numRows", rows).outputMode("append")


def as_messages(df: DataFrame, *cols: str) -> DataFrame:
    """Rows as JSON text in column ``value``, built by the executors."""
    return df.select(F.to_json(F.struct(*(cols or ("*",)))).alias("value"))


def publish(df: DataFrame, servers: str, topic: str) -> None:
    """Send rows to a topic; partitions are sent in parallel."""
    as_messages(df).write.format("kafka").options(
        **{"kafka.bootstrap.servers": servers, "topic": topic}
    ).save()


def drain(query: StreamingQuery) -> None:
    """Wait for an ``availableNow`` run and raise what it raised."""
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
