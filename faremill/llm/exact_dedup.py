"""Exact dedup by an exchange of Golomb-coded fingerprints.

1. Every task reduces its rows, a run at a time, to 62-bit fingerprints of the normalised
   texts, sorts the distinct ones and codes their gaps (Golomb-Rice), one code per owner; an
   owner holds an equal range of the fingerprints.
2. Owners read only the codes, find fingerprints that several runs hold or that a run holds
   twice, and answer each code with a bitmap. A text that fills a third of the table is one
   fingerprint in each run's code.
3. Rows whose bit is set are suspects. Only their texts are grouped, by their bytes, with map
   side combine; the fingerprint decides nothing.

The first step is a stored table, so the bitmaps meet the rows they were made for however
often a task is repeated.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faremill.llm.common import as_row, parts_for, rows_of, sieve, sifted, stored, whole

# The characters that are deleted before texts are compared.
DELETED = " \t\n\x0b\f\r"
BITS = 62  # of the 64-bit hash; sums and spans stay within signed integers
OWNER_ROWS = 2_000_000  # fingerprints to an owner
RUN_ROWS = 262_144  # rows after which a task closes a run


def normalised(text: str) -> Column:
    return F.translate(whole(text), DELETED, "")


# --- Golomb-Rice code -----------------------------------------------------------------


def rice_encode(values: np.ndarray, k: int) -> bytes:
    """Sorted distinct non-negative integers as gaps: quotients unary, k low bits."""
    gaps = np.diff(values, prepend=np.int64(0))
    quotients = gaps >> k
    ends = np.cumsum(quotients + 1) - 1  # where each unary part stops with a one
    unary = np.zeros(int(ends[-1]) + 1 if len(ends) else 0, np.uint8)
    unary[ends] = 1
    low = (gaps[:, None] >> np.arange(k - 1, -1, -1, dtype=np.int64)) & 1
    return np.packbits(np.concatenate([unary, low.astype(np.uint8).ravel()])).tobytes()


def rice_decode(code: bytes, count: int, k: int) -> np.ndarray:
    bits = np.unpackbits(np.frombuffer(code, np.uint8))
    if not count:
        return np.empty(0, np.int64)
    ends = np.flatnonzero(bits)[:count]  # the unary part comes first: its ones are the stops
    quotients = np.diff(ends, prepend=-1) - 1
    low = bits[ends[-1] + 1 : ends[-1] + 1 + count * k].reshape(count, k).astype(np.int64)
    remainders = low @ (np.int64(1) << np.arange(k - 1, -1, -1, dtype=np.int64))
    return np.cumsum((quotients.astype(np.int64) << k) | remainders)


def rice_parameter(span: int, count: int) -> int:
    """Low bits for ``count`` values spread over ``span``: about log2 of the mean gap."""
    return max(0, int(math.log2(max(1.0, span / max(1, count)))))


# --- the exchange ---------------------------------------------------------------------

def _runs(rows: DataFrame, owners: int) -> DataFrame:
    """A row per run and owner: the code, and beside it the rows in the code's order."""
    span = -(-(1 << BITS) // owners)
    key_type = rows.schema["key"].dataType.simpleString()

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= RUN_ROWS:
                yield pa.concat_batches(held)
                held = []
        if sum(b.num_rows for b in held):
            yield pa.concat_batches(held)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches):
            print_ = batch.column("fp").to_numpy().astype(np.int64) & np.int64((1 << BITS) - 1)
            order = np.argsort(print_, kind="stable")
            sorted_ = print_[order]
            distinct, first, counts = np.unique(sorted_, return_index=True, return_counts=True)
            bounds = np.searchsorted(distinct // span, np.arange(owners + 1))
            run = uuid.uuid4().hex
            moved = batch.take(pa.array(order))
            out: dict[str, list] = {n: [] for n in ("run", "owner", "n", "k", "code", "counts")}
            slices = []
            for owner in range(owners):
                a, b = int(bounds[owner]), int(bounds[owner + 1])
                if a == b:
                    continue
                k = rice_parameter(span, b - a)
                out["run"].append(run)
                out["owner"].append(owner)
                out["n"].append(b - a)
                out["k"].append(k)
                out["code"].append(rice_encode(distinct[a:b] - owner * span, k))
                out["counts"].append(counts[a:b].astype("<i4").tobytes())
                slices.append((int(first[a]), int(first[b - 1] + counts[b - 1])))
            types = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
            arrays = [pa.array(v, t) for v, t in zip(out.values(), types, strict=True)]
            cuts = pa.array([s[0] for s in slices] + [batch.num_rows], pa.int32())
            for name in ("key", "digest", "chars"):
                arrays.append(pa.ListArray.from_arrays(cuts, moved.column(name)))
            yield pa.RecordBatch.from_arrays(
                arrays, [*out, "keys", "digests", "lengths"]
            )

    schema = (
        f"run string, owner int, n int, k int, code binary, counts binary, "
        f"keys array<{key_type}>, digests array<string>, lengths array<long>"
    )
    return rows.mapInArrow(encode, schema)


def _bitmaps(codes: DataFrame) -> DataFrame:
    """Per run and owner a bit for each fingerprint: whether it occurs again anywhere."""

    def answer(group: pd.DataFrame) -> pd.DataFrame:
        sets = [
            rice_decode(code, n, k)
            for code, n, k in zip(group["code"], group["n"], group["k"], strict=True)
        ]
        values = np.concatenate(sets)
        weights = np.concatenate([np.frombuffer(c, "<i4") for c in group["counts"]])
        distinct, where = np.unique(values, return_inverse=True)
        again = np.bincount(where, weights, len(distinct)) > 1
        bits = np.split(again[where], np.cumsum([len(s) for s in sets])[:-1])
        return pd.DataFrame(
            {
                "run": group["run"],
                "owner": group["owner"],
                "bits": [np.packbits(b).tobytes() for b in bits],
            }
        )

    return codes.groupBy("owner").applyInPandas(answer, "run string, owner int, bits binary")


def _flagged(runs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """The rows again, each with its suspicion."""
    joined = runs.select("run", "owner", "counts", "keys", "digests", "lengths").join(
        bitmaps, ["run", "owner"]
    )

    def unpack(bits: pd.Series, counts: pd.Series) -> pd.Series:
        out = []
        for b, c in zip(bits, counts, strict=True):
            n = np.frombuffer(c, "<i4")
            flags = np.unpackbits(np.frombuffer(b, np.uint8))[: len(n)].astype(bool)
            out.append(np.repeat(flags, n))
        return pd.Series(out)

    flags = F.pandas_udf(unpack, "array<boolean>")("bits", "counts")
    rows = joined.withColumn("flags", flags)
    rows = rows.select(F.explode(F.arrays_zip("keys", "digests", "lengths", "flags")).alias("r"))
    return rows.select(
        F.col("r.keys").alias("key"),
        F.col("r.digests").alias("digest"),
        F.col("r.lengths").alias("chars"),
        F.col("r.flags").alias("suspect"),
    )


def _judged(df: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """The rows that are alone for sure (``key``, ``digest``), and the suspects, judged by their
    bytes (``key``, ``digest``, ``keep_id``, ``group_size``, ``kept``)."""
    rows = df.select(F.col(key).alias("key"), whole(text).alias("text"))
    norm = normalised("text")
    prints = rows.select(
        "key",
        F.xxhash64(norm).alias("fp"),
        F.sha2(norm, 256).alias("digest"),
        F.length("text").cast("long").alias("chars"),
    )
    owners = parts_for(df.count(), OWNER_ROWS)
    runs = stored(_runs(prints, owners), "dedup-runs")
    bitmaps = _bitmaps(runs.select("run", "owner", "n", "k", "code", "counts"))
    flagged = _flagged(runs, bitmaps).withColumn("row", F.monotonically_increasing_id())
    flagged = stored(flagged, "dedup-rows")
    suspects = flagged.filter("suspect")
    # the texts of suspects only; rows without a key cannot be looked up and all come along
    wanted = suspects.filter(F.col("key").isNotNull()).select("key").distinct()
    texts = rows_of(rows, "key", stored(wanted, "dedup-suspects"), "dedup-texts")
    texts = texts.unionByName(rows.filter(F.col("key").isNull()))

    def order(chars: Column) -> list[Column]:
        # the complement turns the order round, without an overflow
        return [chars, F.col("key").isNotNull(), F.bitwise_not("key")]

    groups = (
        texts.withColumn("norm", normalised("text"))
        .groupBy("norm")  # equal bytes, not equal hashes
        .agg(
            F.max_by("key", F.struct(*order(F.length("text")))).alias("keep_id"),
            F.count(F.lit(1)).alias("group_size"),
        )
        .select(F.sha2("norm", 256).alias("digest"), "keep_id", "group_size")
    )
    # of rows alike in key, text and length the first one stays
    first = F.max_by("row", F.struct(*order(F.col("chars")), F.bitwise_not("row")))
    winners = suspects.groupBy("digest").agg(first.alias("first"))
    found = suspects.join(groups.join(winners, "digest"), "digest")
    judged = found.select(
        "key", "digest", "keep_id", "group_size", (F.col("row") == F.col("first")).alias("kept")
    )
    return flagged.filter(~F.col("suspect")).select("key", "digest"), judged


def find_copies(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: the key, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when identical after deleting ASCII white space; a NULL text counts as
    empty. Of a group the row with the most code points in its original text stays, among
    those the smallest key; a NULL key loses such ties. Of rows that repeat the key, the text
    and its length, which cannot be told apart, one is kept. An empty table gives an empty
    result. Keys are integers.
    """
    alone, judged = _judged(df, key, text)
    alone = alone.select(
        "key",
        "digest",
        F.col("key").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
    )
    return alone.unionByName(judged).select(
        F.col("key").alias(key),
        "keep_id",
        "group_size",
        "kept",
        F.col("digest").alias("text_sha256"),
    )


def drop_copies(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df`` that stay, with all their columns; one row per group of equal texts.

    ``df`` must give the same rows each time it is read. Rows stay where they are unless their
    key is one of those of which rows go.
    """
    _, judged = _judged(df, key, text)
    # keys are integers, so the empty text stands for NULL alone
    name = F.coalesce(F.col("key").cast("string"), F.lit(""))
    verdicts = judged.groupBy(name.alias("name"), "digest").agg(
        F.max("kept").alias("one"), F.count(F.lit(1)).alias("n")
    )
    # all rows of a key and text go, or all but one
    verdicts = verdicts.filter(~F.col("one") | (F.col("n") > 1)).select("name", "digest", "one")
    verdicts = stored(verdicts, "dedup-verdicts")
    rows = df.select(
        as_row(df).alias("row"),
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias("name"),
        whole(text).alias("text"),
    )
    marked = sifted(rows, "name", sieve(verdicts, "name"), "concerned")
    untouched = marked.filter(~F.col("concerned")).select("row")
    digest, chars = F.sha2(normalised("text"), 256), F.length("text")
    some = marked.filter("concerned").select(
        "row", "name", digest.alias("digest"), chars.alias("chars")
    )
    some = some.join(verdicts, ["name", "digest"], "left").filter(F.coalesce("one", F.lit(True)))
    # rows with one key and one text: the longest of them, one of equal ones
    longest = Window.partitionBy("name", "digest").orderBy(F.desc("chars"))
    some = some.withColumn("n", F.row_number().over(longest))
    some = some.filter(F.col("one").isNull() | (F.col("n") == 1)).select("row")
    return untouched.unionByName(some).select("row.*")
