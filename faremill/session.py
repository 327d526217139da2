"""Session settings and the shared scratch area."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession

# Settings the library relies on. Broadcasting is left to Catalyst: a side is sent to
# every executor only while its measured size stays under the threshold, and AQE falls
# back to a (skew-split) shuffle join beyond it.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",  # casts and sums that overflow raise
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
    # call-site capture costs two extra JVM calls for every column expression
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(
    app: str = "faremill",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the library's settings.

    On a cluster leave ``master`` and ``shuffle_partitions`` to spark-submit; AQE
    coalesces a generous initial partition number downwards.
    """
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Fix the session time zone; every timestamp in the library is UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def workspace(spark: SparkSession, label: str) -> str:
    """A new, unused folder below the shared folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own, since all of
    its tasks run on this machine; a cluster session without it is an error.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="faremill-"))
        base = context.getCheckpointDir()
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of this library's making, if it is there."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def ship_package(spark: SparkSession) -> None:
    """Send this package's code to the Python workers, once a session."""
    package, context = Path(__file__).resolve().parent, spark.sparkContext
    if not any(f.endswith(f"/{package.name}.zip") for f in context.listFiles):
        folder = tempfile.mkdtemp(prefix=f"{package.name}-")
        context.addPyFile(
            shutil.make_archive(f"{folder}/{package.name}", "zip", package.parent, package.name)
        )
