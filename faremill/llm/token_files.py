"""Token ids in files of independent zstandard frames with a trailing seek table.

A file is a chain of zstandard frames, so any zstandard tool can read it:

* data frames, each the ids (little-endian unsigned 32-bit) of one or more whole documents in
  order, compressed on its own and with the checksum of the frame format;
* after each of them a skippable frame of one byte, a line feed;
* last a skippable frame with the seek table: an entry per data frame (offset, compressed and
  plain size, CRC-32 of the plain bytes) and per document (key, number of ids, frame), then
  the table's size and a magic that ends in a line feed.

The line feeds let Spark's text writer store the frames: it writes a row's bytes and a line
feed. So the files appear through Spark's commit protocol, a lost task is written again from
its input, and no executor needs a file system of its own. A reader takes the table from the
end and decompresses only the frames that hold a requested document.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from faremill.llm import byte_bpe
from faremill.llm.common import parts_for, whole

TOKENIZER = "byte_bpe_50k.json"
END_ID = 0
FILE_CHARS = 16_000_000  # characters of text to a file
FRAME_BYTES = 1 << 17  # plain bytes after which a frame is closed
LEVEL = 3

# The magics of the zstandard frame format for skippable frames, and our own.
SKIP_FEED = 0x184D2A50
SKIP_TABLE = 0x184D2A5E
MAGIC = b"ids1"
TAIL = struct.Struct("<Q4s3sc")  # table size, magic, padding, line feed
FEED = struct.pack("<II", SKIP_FEED, 1)
HEAD = struct.Struct("<QQQQ")  # file number, frames, documents, all ids

FRAMES = np.dtype([("offset", "<u8"), ("size", "<u8"), ("plain", "<u8"), ("crc", "<u4")])
DOCUMENTS = np.dtype([("key", "<i8"), ("null", "u1"), ("ids", "<u8"), ("frame", "<u8")])


class FileWriter:
    """Turns documents in order into the rows of one file."""

    def __init__(self, number: int, frame_bytes: int = FRAME_BYTES, level: int = LEVEL) -> None:
        self.number = number
        self.frame_bytes = frame_bytes
        self.pack = zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.offset = 0
        self.frames: list[tuple] = []
        self.documents: list[tuple] = []
        self.open: list[bytes] = []
        self.held = 0

    def add(self, key: int | None, ids: bytes) -> Iterator[bytes]:
        self.documents.append((key or 0, key is None, len(ids) // 4, len(self.frames)))
        self.open.append(ids)
        self.held += len(ids)
        if self.held >= self.frame_bytes:
            yield self._close()

    def _close(self) -> bytes:
        plain = b"".join(self.open)
        frame = self.pack.compress(plain)
        self.frames.append((self.offset, len(frame), len(plain), zlib.crc32(plain)))
        self.open, self.held = [], 0
        self.offset += len(frame) + len(FEED) + 1
        return frame + FEED

    def end(self) -> Iterator[bytes]:
        if self.open:
            yield self._close()
        documents = np.array(self.documents, DOCUMENTS)
        table = (
            HEAD.pack(
                self.number, len(self.frames), len(documents), int(documents["ids"].sum())
            )
            + np.array(self.frames, FRAMES).tobytes()
            + documents.tobytes()
        )
        tail = TAIL.pack(len(table), MAGIC, b"\0" * 3, b"\n")
        yield struct.pack("<II", SKIP_TABLE, len(table) + len(tail)) + table + tail[:-1]


class FileReader:
    """The seek table of a file, and the documents of its frames on request."""

    def __init__(self, content: bytes) -> None:
        self.content = memoryview(content)
        size, magic, _, feed = TAIL.unpack(self.content[-TAIL.size :])
        if magic != MAGIC or feed != b"\n":
            raise ValueError("not a file of token ids, or cut short")
        table = self.content[-TAIL.size - size : -TAIL.size]
        self.number, frames, documents, self.total = HEAD.unpack(table[: HEAD.size])
        at = HEAD.size + frames * FRAMES.itemsize
        self.frames = np.frombuffer(table[HEAD.size : at], FRAMES)
        self.documents = np.frombuffer(table[at:], DOCUMENTS, documents)
        self.before = np.cumsum(self.documents["ids"]) - self.documents["ids"]

    def frame(self, number: int) -> bytes:
        f = self.frames[number]
        packed = self.content[int(f["offset"]) : int(f["offset"]) + int(f["size"])]
        plain = zstandard.ZstdDecompressor().decompress(packed)
        if len(plain) != f["plain"] or zlib.crc32(plain) != f["crc"]:
            raise ValueError(f"frame {number} of file {self.number} is damaged")
        return plain

    def read(self, wanted: np.ndarray | None = None) -> Iterator[tuple]:
        """(key, ids before it in the file, ids as bytes) of the wanted documents' positions."""
        at = np.arange(len(self.documents)) if wanted is None else wanted
        frames = self.documents["frame"][at].astype(np.int64)
        for number in np.unique(frames):
            plain = self.frame(int(number))
            first = int(self.before[np.searchsorted(self.documents["frame"], number)])
            for i in at[frames == number]:
                d, before = self.documents[i], int(self.before[i])
                start = 4 * (before - first)
                ids = plain[start : start + 4 * int(d["ids"])]
                yield None if d["null"] else int(d["key"]), before, ids


@dataclass(frozen=True)
class TokenFiles:
    """Files below ``path``; ``key`` names the key in what is read from them."""

    spark: SparkSession
    path: str
    key: str = "doc_id"

    def _contents(self) -> DataFrame:
        files = self.spark.read.format("binaryFile").load(self.path)
        return files.filter(F.col("length") > 0).select("content")

    def totals(self) -> DataFrame:
        """A row per file from its table alone: ``file_no`` (ascending in the keys), ``ids``."""

        def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                read = [FileReader(c.as_buffer()) for c in batch.column(0)]
                rows = [(r.number, r.total) for r in read]
                yield _batch(rows, [("file_no", pa.int64()), ("ids", pa.int64())])

        return self._contents().mapInArrow(tables, "file_no long, ids long")

    def documents(
        self, wanted: list[int] | None = None, with_ids: bool = False
    ) -> DataFrame:
        """A row per document, or per wanted key, in the files: ``file_no``, the key,
        ``before`` (ids of the file before it), ``n_tokens``, ``ids_crc32`` and, on request,
        ``ids`` (array of long)."""
        keys = None if wanted is None else np.unique(np.array(wanted, np.int64))
        fields = [
            ("file_no", pa.int64()), (self.key, pa.int64()), ("before", pa.int64()),
            ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()),
        ]
        schema = f"file_no long, `{self.key}` long, before long, n_tokens long, ids_crc32 long"
        if with_ids:
            fields.append(("ids", pa.list_(pa.int64())))
            schema += ", ids array<long>"

        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for content in batch.column(0):
                    file = FileReader(content.as_buffer())
                    at = None
                    if keys is not None:
                        have = np.isin(file.documents["key"], keys)
                        at = np.flatnonzero(have & (file.documents["null"] == 0))
                    rows = []
                    for key, before, ids in file.read(at):
                        row = (file.number, key, before, len(ids) // 4, zlib.crc32(ids))
                        rows.append((*row, np.frombuffer(ids, "<u4")) if with_ids else row)
                        if len(rows) >= 4096:
                            yield _batch(rows, fields)
                            rows = []
                    yield _batch(rows, fields)

        return self._contents().mapInArrow(read, schema)

    def positions(self) -> DataFrame:
        """A row per document: the key, ``start`` (ids of all documents before it), ``n_tokens``,
        ``ids_crc32``. The running total over files has one row per file."""
        order = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
        bases = self.totals().select(
            "file_no", F.coalesce(F.sum("ids").over(order), F.lit(0)).alias("_base")
        )
        return (
            self.documents()
            .join(bases, "file_no")
            .select(
                F.col(self.key),
                (F.col("_base") + F.col("before")).alias("start"),
                "n_tokens",
                "ids_crc32",
            )
        )


def _batch(rows: list[tuple], fields: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in fields]
    arrays = [pa.array(c, t) for c, (_, t) in zip(columns, fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=[n for n, _ in fields])


def write_tokens(
    df: DataFrame,
    path: str,
    key: str = "doc_id",
    text: str = "text",
    tokenizer: str = TOKENIZER,
    end_id: int = END_ID,
    file_chars: int = FILE_CHARS,
) -> TokenFiles:
    """Encode every whole text, append ``end_id``, and write the ids in ascending key order.

    A NULL text is empty: its document is the end id alone. Keys are integers; NULL comes
    first, rows with equal keys are ordered by their texts' hash and may lie in several files.
    An empty table gives a folder without documents. The texts are dealt by ranges of the key,
    of the texts' hash and of a number of the row, so that neither a key nor a row that repeats
    can fill a file, and encoded once, after that.
    """
    rows = df.select(F.col(key).cast("long").alias("key"), whole(text).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    # rows alike in key and text are interchangeable, so any number may deal them out
    rows = rows.withColumn("copy", F.monotonically_increasing_id())
    chars = rows.agg(F.sum(F.length("text") + 16)).first()[0] or 0
    order: list[Column] = [F.col("key").asc_nulls_first(), F.col("tie").asc(), F.col("copy").asc()]
    spread = rows.repartitionByRange(parts_for(chars, file_chars), *order)
    frames = spread.sortWithinPartitions(*order).select("key", "text")
    stored = frames.mapInArrow(_frames(tokenizer, end_id), "data binary")
    stored.select(F.col("data").cast("string")).write.mode("errorifexists").text(path)
    return TokenFiles(df.sparkSession, path, key)


def _frames(
    tokenizer: str, end_id: int
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe.coder(public_tokenizers.path(tokenizer))
        end = struct.pack("<I", end_id)
        file = None
        for batch in batches:
            file = file or FileWriter(TaskContext.get().partitionId())
            encoded = bpe.encode_batch(batch.column(1).to_pylist())
            for key, ids in zip(batch.column(0).to_pylist(), encoded, strict=True):
                for row in file.add(key, ids + end):
                    yield pa.RecordBatch.from_arrays([pa.array([row], pa.binary())], ["data"])
        if file:
            for row in file.end():
                yield pa.RecordBatch.from_arrays([pa.array([row], pa.binary())], ["data"])

    return frames
