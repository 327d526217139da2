"""WARC archives: writing, and reading by verified chains of record boundaries.

Writing: a record is one row of Spark's text writer, which ends every row with the line feed
that also ends a record. So archives appear through Spark's commit protocol, and a lost task
writes its file again.

Reading: the bytes that begin a record may also stand inside a payload. Tasks therefore only
emit candidates: every place that reads as a record's header, with its successor, the offset
just behind the record it describes. From the start of each file, pointer jumping then marks
what the chain of records reaches: after round i the first 2**i records. What a payload holds
is never reached, since the chain steps over it.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faremill.llm.common import stored, whole

MAGIC = b"WARC/1."
FILE_RECORDS = 2000  # records to an archive
DATE = "2024-01-01T00:00:00Z"
# The revisit profile of the WARC standard; the digits of base 32.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
ID = "urn:page:"


class DamagedArchive(Exception):
    """The chain of an archive's records does not end where the file does."""


def payload_digest(text: Column) -> Column:
    """SHA-1 of the text's UTF-8 bytes in upper-case base 32: 20 bits make four digits."""
    digest = F.sha1(text)
    groups = [
        F.lpad(F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)
    ]
    return F.translate(F.concat(*groups), DIGITS, BASE32)


def _revisits(rows: DataFrame, least: int) -> DataFrame:
    """Keys whose payload another record stores: ``_key``, ``_digest``, ``refers``."""
    prints = rows.filter(F.col("bytes") >= least).select("key", "digest")
    groups = prints.groupBy("digest").agg(
        F.max("key").alias("refers"), F.count(F.lit(1)).alias("n")
    )
    groups = groups.filter((F.col("n") > 1) & F.col("refers").isNotNull()).drop("n")
    others = prints.join(groups, "digest").filter(~F.col("key").eqNullSafe(F.col("refers")))
    return others.select(
        F.col("key").alias("_key"), F.col("digest").alias("_digest"), "refers"
    ).distinct()


def write_warc(
    df: DataFrame,
    path: str,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
    least: int = 0,
    file_records: int = FILE_RECORDS,
) -> None:
    """A record per row, the html in UTF-8 as payload (NULL: empty).

    Of records with equal payloads of at least ``least`` bytes the one with the largest key is
    a response and the others revisit it. Keys are integers; a NULL key is stored as none and
    is never referred to. Rows that repeat the largest key and its payload are all responses.
    A NULL url is left out, line ends in one become spaces. An empty table gives no records.
    """
    rows = df.select(
        F.col(key).cast("long").alias("key"),
        F.regexp_replace(F.col(url), "[\r\n]", " ").alias("url"),
        whole(html).alias("html"),
    ).withColumns({"digest": payload_digest(F.col("html")), "bytes": F.octet_length("html")})
    # a stored table: whether it is sent to all tasks or joined by shuffle follows its size
    revisits = stored(_revisits(rows, least), "warc-revisits")
    joined = rows.join(
        revisits, F.col("key").eqNullSafe(F.col("_key")) & (F.col("digest") == F.col("_digest")),
        "left",
    )
    again = F.col("refers").isNotNull()
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("bytes").cast("string"),
        F.lit("\r\n\r\n"),
    )
    block = F.when(again, http).otherwise(F.concat(http, F.col("html")))

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))

    def optional(name: str, value: Column) -> Column:
        return F.coalesce(line(name, value), F.lit(""))

    def urn(value: Column) -> Column:
        return F.concat(F.lit(f"<{ID}"), value.cast("string"), F.lit(">"))

    record = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(again, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", F.coalesce(urn(F.col("key")), F.lit(f"<{ID}none>"))),
        line("WARC-Date", F.lit(DATE)),
        optional("WARC-Target-URI", F.col("url")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(again, line("WARC-Profile", F.lit(PROFILE))).otherwise(F.lit("")),
        F.when(again, line("WARC-Refers-To", urn(F.col("refers")))).otherwise(F.lit("")),
        line("Content-Type", F.lit("application/http;msgtype=response")),
        line("Content-Length", F.octet_length("block").cast("string")),
        F.lit("\r\n"),
        F.col("block"),
        F.lit("\r\n\r"),  # the writer adds the line feed
    )
    records = joined.withColumn("block", block).select(record.alias("value"))
    records.write.mode("errorifexists").option("maxRecordsPerFile", file_records).text(path)


# --- reading --------------------------------------------------------------------------

HEADER = re.compile(rb"WARC/1\.[01]\r\n((?:[A-Za-z-]+:[^\r\n]*\r\n)+)\r\n")
FIELD = re.compile(rb"([A-Za-z-]+):[ \t]*([^\r\n]*)\r\n")
CANDIDATE = (
    "file string, size long, offset long, next long, key long, record_type string, "
    "uri string, payload_bytes long, payload_digest string, refers_to long"
)


def _number(urn: bytes | None) -> int | None:
    found = re.fullmatch(rb"<urn:page:(-?\d+)>", urn or b"")
    return int(found[1]) if found else None


def candidates(content: bytes) -> Iterator[dict]:
    """Every place of a file that reads as a whole record."""
    at = content.find(MAGIC)
    while at >= 0:
        found = HEADER.match(content, at)
        fields = {k.lower(): v for k, v in FIELD.findall(found[1])} if found else {}
        length = fields.get(b"content-length", b"")
        if length.isdigit():
            start, end = found.end(), found.end() + int(length)
            if content[end : end + 4] == b"\r\n\r\n":
                yield {"offset": at, "next": end + 4, **_described(fields, content[start:end])}
        at = content.find(MAGIC, at + 1)


def _described(fields: dict[bytes, bytes], block: bytes) -> dict:
    http, _, payload = block.partition(b"\r\n\r\n")
    kind = fields.get(b"warc-type", b"").decode("latin-1")
    digest = fields.get(b"warc-payload-digest", b"").removeprefix(b"sha1:").decode("latin-1")
    size = len(payload)
    if kind == "revisit":  # the payload is elsewhere; the stored HTTP header has its length
        told = re.search(rb"(?mi)^content-length:[ \t]*(\d+)[ \t]*\r?$", http)
        size = int(told[1]) if told else None
    else:
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    uri = fields.get(b"warc-target-uri")
    return {
        "key": _number(fields.get(b"warc-record-id")),
        "record_type": kind,
        "uri": uri.decode("utf-8", "replace") if uri is not None else None,
        "payload_bytes": size,
        "payload_digest": digest,
        "refers_to": _number(fields.get(b"warc-refers-to")),
        "payload": payload,
    }


def _candidates(spark: SparkSession, path: str, with_payload: bool) -> DataFrame:
    schema = CANDIDATE + ", payload binary" * with_payload
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    arrow = pa.schema([(n, kinds[t]) for n, t in map(str.split, schema.split(", "))])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column(0), batch.column(1), strict=True):
                data = content.as_py()
                rows, held = [], 0
                for c in candidates(data):
                    rows.append({"file": file.as_py(), "size": len(data), **c})
                    held += len(c["payload"])
                    if held > 1 << 24:
                        yield pa.RecordBatch.from_pylist(rows, arrow)
                        rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, arrow)

    files = spark.read.format("binaryFile").load(path).filter(F.col("length") > 0)
    return files.select("path", "content").mapInArrow(emit, schema)


def reachable(links: DataFrame) -> DataFrame:
    """``file`` and ``offset`` of what the chain from offset 0 reaches, by pointer jumping.

    ``links`` holds ``file``, ``offset``, ``next``, one row per candidate, stored.
    """
    longest = links.groupBy("file").count().agg(F.max("count")).first()[0] or 0
    reached = links.filter("offset = 0").select("file", "offset")
    jumps = links.select("file", "offset", F.col("next").alias("to"))
    for round_ in range(max(0, longest - 1).bit_length()):
        on = jumps.withColumnRenamed("to", "_to")
        ahead = reached.join(on, ["file", "offset"]).select("file", F.col("_to").alias("offset"))
        ahead = ahead.join(links.select("file", "offset"), ["file", "offset"], "left_semi")
        reached = stored(reached.unionByName(ahead), f"warc-reached-{round_}")
        onward = jumps.select("file", F.col("offset").alias("to"), F.col("to").alias("_far"))
        jumps = stored(
            jumps.join(onward, ["file", "to"]).select(
                "file", "offset", F.col("_far").alias("to")
            ),
            f"warc-jumps-{round_}",
        )
    return reached


def read_warc(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """The records of all archives below ``path``: ``file``, ``offset``, ``key``,
    ``record_type``, ``uri``, ``payload_bytes``, ``payload_digest``, ``refers_to``, and on
    request ``payload`` (empty for a revisit).

    The digest of a response is taken from the payload that was read. An archive whose chain
    of records does not reach its end is an error.
    """
    found = stored(_candidates(spark, path, with_payload), "warc-candidates")
    marks = reachable(found.select("file", "offset", "next"))
    records = found.join(marks, ["file", "offset"])
    ends = records.groupBy("file").agg(F.max("next").alias("_end"))
    sizes = spark.read.format("binaryFile").load(path).filter(F.col("length") > 0)
    sizes = sizes.select(F.col("path").alias("file"), "length")
    broken = sizes.join(ends, "file", "left").filter(
        F.coalesce(F.col("_end"), F.lit(0)) != F.col("length")
    )
    damaged = [r["file"] for r in broken.select("file").limit(5).collect()]
    if damaged:
        raise DamagedArchive(f"records do not fill {', '.join(damaged)}")
    return records.drop("size", "next")
