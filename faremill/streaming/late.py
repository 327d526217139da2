"""Events behind the newest one of their key: in a stream with state of its own, and in batch.

An event is late if it happened more than ``delay`` before the newest event of its key that
arrived earlier. Both forms give every row, marked; ``split_late`` takes them apart, so that late
rows go to a table of their own and are not lost where a watermark drops them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from faremill.operators.rows import cut_in_ranges, running
from faremill.session import ship_package, workspace

# keyed state of a stream needs this provider
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}
NEWEST = T.StructType([T.StructField("micros", T.LongType())])


NONE = -(1 << 63)  # stands for a missing event time
# rows travel through the state operator as JSON: its frames would turn NULL numbers into floats
ROW_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


class _Newest(StatefulProcessor):
    """Keeps the newest event time of a key, in microseconds."""

    def __init__(self, delay: int) -> None:
        self.delay = delay

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.newest = handle.getValueState("newest", NEWEST)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        # rows of one key in one micro-batch, whose size the source bounds
        batch = pd.concat(list(rows)).sort_values("arrival", kind="stable")
        held = self.newest.get()[0] if self.newest.exists() else NONE
        micros = batch["micros"].to_numpy()
        newest = np.maximum(np.maximum.accumulate(micros), held)
        if newest[-1] > held:
            self.newest.update((int(newest[-1]),))
        late = (micros != NONE) & (micros < newest - self.delay)
        yield pd.DataFrame({"payload": batch["payload"].to_numpy(), "is_late": late})

    def close(self) -> None:
        pass


def mark_late_in_stream(
    df: DataFrame, key: str, arrival: str, happened: str, delay: dt.timedelta
) -> DataFrame:
    """Rows of a stream with ``is_late``; the state is one number a key, kept in the checkpoint.

    Within a micro-batch rows are taken by ``arrival``; the source delivers the batches in that
    order. Rows without an event time are not late. The session needs ``STATE_STORE``.
    """
    ship_package(df.sparkSession)
    rows = df.select(
        F.col(key).alias("of"),
        F.col(arrival).alias("arrival"),
        F.coalesce(F.unix_micros(happened), F.lit(NONE + 1) - 1).alias("micros"),
        F.to_json(F.struct(*df.columns), ROW_OPTIONS).alias("payload"),
    )
    marked = rows.groupBy("of").transformWithStateInPandas(
        _Newest(delay // dt.timedelta(microseconds=1)),
        "payload string, is_late boolean",
        "Append",
        "None",
    )
    row = F.from_json("payload", df.schema, ROW_OPTIONS).alias("row")
    return marked.select(row, "is_late").select("row.*", "is_late")


def mark_late(
    df: DataFrame,
    key: str,
    arrival: str,
    happened: str,
    delay: dt.timedelta,
    path: str | None = None,
    pieces: int | None = None,
) -> DataFrame:
    """The same on a table, written to ``path`` (by default a new folder).

    The running maximum is taken over ranges of (key, arrival), so a hot key has many tasks.
    """
    path = path or workspace(df.sparkSession, "late")
    rows = df.withColumn("_micros", F.unix_micros(happened))
    with cut_in_ranges(rows, [key], [arrival], pieces) as cut:
        newest = running(cut, [key], [arrival], "_micros", "_newest", "max")
        late = F.col("_micros") < F.col("_newest") - delay // dt.timedelta(microseconds=1)
        marked = newest.withColumn("is_late", F.coalesce(late, F.lit(False)))
        marked = marked.drop("_micros", "_newest")
        marked.write.parquet(path)
    return df.sparkSession.read.schema(marked.schema).parquet(path)


def split_late(marked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows in time, and late ones."""
    return marked.filter(~F.col("is_late")).drop("is_late"), marked.filter("is_late").drop("is_late")
