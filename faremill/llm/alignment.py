"""Alignment of two tokenizers' tokens, scored by how many documents link the same ids.

Both tokenizers cut a text into spans of bytes. The offsets where tokens of both end cut it into
groups; every token of one is linked with every token of the other in its group. The index is
inverted: for each pair of ids a compressed set of the documents that link it, in bit planes for
how often they do (``pair_bitmaps``). A task reads its documents once and merges the sets of
its batches by OR into chunks. Documents are counted by popcounts: within a chunk by the merged
sets, and over the corpus by adding the counts of the chunks, whose documents are all different.
Then each pair's count goes back to the chunks that hold it, where its postings hand it on to
the documents.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faremill.llm.byte_bpe import ByteBpe, along
from faremill.llm.pair_bitmaps import DOCUMENT_BITS, DOCUMENTS, Postings, runs
from faremill.session import workspace

BYTE_BPE = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
ID_BITS = 20  # a pair is ``a << ID_BITS | b``
# texts of a batch, and tokens of a stretch into which a longer text is cut
BATCH_CHARS = 1 << 19
STRETCH = 1 << 20
# a chunk ends with the batch in which it reaches so many postings
CHUNK_POSTINGS = 1 << 20
# groups with more links are counted by distinct ids instead of link by link
MANY_LINKS = 1 << 12


# --- tokens and their bytes -------------------------------------------------------------


class Vocabulary:
    """The bytes of each id, one after the other."""

    def __init__(self, entries: list[bytes]) -> None:
        if len(entries) > 1 << ID_BITS:
            raise ValueError("more ids than a pair has room for")
        self.sizes = np.array([len(e) for e in entries], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(entries), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        return self.data[along(self.starts[ids], self.sizes[ids])]


def byte_characters() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Printable Latin-1 characters are themselves; the other bytes, in order, are the
    characters from 256 on.
    """
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


class First:
    """The byte-level tokenizer, which takes special strings in a text as plain text."""

    def __init__(self, path: str) -> None:
        self.bpe = ByteBpe(path)
        self.bpe.library.encode_special_tokens = True
        self.bpe.added = None
        known = self.bpe.library.get_vocab(with_added_tokens=True)
        byte_of = byte_characters()
        entries = [b""] * (max(known.values()) + 1)
        for token, i in known.items():
            # an added token that is no byte-level text never comes out of plain text
            entries[i] = bytes(byte_of.get(c, 0) for c in token)
        self.vocabulary = Vocabulary(entries)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.frombuffer(ids, "<u4") for ids in self.bpe.encode_batch(texts)]


class Second:
    """The SentencePiece model."""

    def __init__(self, path: str) -> None:
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.vocabulary = Vocabulary([self._bytes(i) for i in range(len(self.model))])

    def _bytes(self, i: int) -> bytes:
        piece = self.model.id_to_piece(i)
        if self.model.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, np.uint32) for ids in self.model.encode(texts, num_threads=1)]


# --- alignment of a batch ---------------------------------------------------------------


@dataclass
class Stretch:
    """Tokens of one document between two offsets where tokens of both end."""

    document: int
    a: np.ndarray
    b: np.ndarray


class Aligner:
    def __init__(self, byte_bpe: str, pieces: str) -> None:
        self.first, self.second = First(byte_bpe), Second(pieces)
        ids = max(len(self.first.vocabulary.sizes), len(self.second.vocabulary.sizes))
        # an id in decimal and a sign behind it, in eight bytes
        texts = [f"{i}{sign}".encode().ljust(8, b"\0") for sign in ",|;" for i in range(ids)]
        self.decimals = np.frombuffer(b"".join(texts), np.uint64).reshape(3, ids)

    def batch(self, texts: list[str]) -> Batch:
        """All documents of a batch; empty texts have no tokens."""
        out = Batch(len(texts))
        some = [i for i, t in enumerate(texts) if t]
        spaced = [f" {texts[i]}" for i in some]
        a, b = self.first.encode(spaced), self.second.encode([texts[i] for i in some])
        whole = [
            i for i in range(len(some)) if self._covers(spaced[i].encode(), a[i], b[i])
        ]
        held: list[Stretch] = []
        tokens = 0
        for i in whole:
            for stretch in self._stretches(some[i], a[i], b[i]):
                held.append(stretch)
                tokens += len(stretch.a) + len(stretch.b)
                if tokens >= STRETCH:
                    self._align(held, out)
                    held, tokens = [], 0
        if held:
            self._align(held, out)
        return out

    def _covers(self, content: bytes, a: np.ndarray, b: np.ndarray) -> bool:
        """Whether the bytes of both tokens' ids are the text's."""
        first, second = self.first.vocabulary, self.second.vocabulary
        return first.joined(a).tobytes() == content and second.joined(b).tobytes() == content

    def _stretches(self, document: int, a: np.ndarray, b: np.ndarray) -> Iterator[Stretch]:
        if len(a) + len(b) <= STRETCH:
            yield Stretch(document, a, b)
            return
        ends_a = np.cumsum(self.first.vocabulary.sizes[a])
        ends_b = np.cumsum(self.second.vocabulary.sizes[b])
        common = np.intersect1d(ends_a, ends_b, assume_unique=True)
        behind_a = np.searchsorted(ends_a, common) + 1
        behind_b = np.searchsorted(ends_b, common) + 1
        done_a = done_b = at = 0
        while at < len(common):
            # as many groups as fit, one at least
            tokens = behind_a[at:] + behind_b[at:] - done_a - done_b
            at += max(1, int(np.searchsorted(tokens, STRETCH, "right")))
            next_a, next_b = int(behind_a[at - 1]), int(behind_b[at - 1])
            yield Stretch(document, a[done_a:next_a], b[done_b:next_b])
            done_a, done_b = next_a, next_b

    def _align(self, held: list[Stretch], out: Batch) -> None:
        a, b = np.concatenate([s.a for s in held]), np.concatenate([s.b for s in held])
        owner = np.array([s.document for s in held])
        own_a = np.repeat(owner, [len(s.a) for s in held])
        own_b = np.repeat(owner, [len(s.b) for s in held])
        ends_a = np.cumsum(self.first.vocabulary.sizes[a])
        ends_b = np.cumsum(self.second.vocabulary.sizes[b])
        ended = np.zeros(ends_a[-1] + 1, np.uint8)
        ended[ends_a] += 1
        ended[ends_b] += 1
        last_a, last_b = ended[ends_a] == 2, ended[ends_b] == 2  # of their groups
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        in_a, in_b = np.bincount(group_a), np.bincount(group_b)
        first_a, first_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
        links = in_a * in_b

        out.n_a += np.bincount(own_a, minlength=out.documents)
        out.n_b += np.bincount(own_b, minlength=out.documents)
        out.n_groups += np.bincount(own_a[last_a], minlength=out.documents)
        np.add.at(out.n_links, own_a[last_a], links)

        # the tokens' decimals in the order of groups, those of a before those of b
        place_a = np.arange(len(a)) + first_b[group_a]
        place_b = np.arange(len(b)) + (first_a + in_a)[group_b]
        written = np.empty(len(a) + len(b), np.uint64)
        written[place_a] = self.decimals[np.where(last_a, 1, 0), a]
        written[place_b] = self.decimals[np.where(last_b, 2, 0), b]
        signs = written.view(np.uint8)
        sizes = (signs.reshape(-1, 8) != 0).sum(axis=1)
        text = signs[signs != 0].tobytes()
        tokens = np.cumsum([len(s.a) + len(s.b) for s in held])
        cuts = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], tokens])]
        for s, start, end in zip(held, cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            out.write(s.document, text[start:end])

        # pairs of groups with few links one by one, of the others by distinct ids
        few = links[group_a] <= MANY_LINKS
        times = in_b[group_a][few]
        left = np.repeat(a[few], times).astype(np.int64)
        right = b[along(first_b[group_a][few], times)]
        out.add(left, right, np.repeat(own_a[few], times), None)
        for g in np.flatnonzero(links > MANY_LINKS):
            some, n = np.unique(a[first_a[g] : first_a[g] + in_a[g]], return_counts=True)
            others, m = np.unique(b[first_b[g] : first_b[g] + in_b[g]], return_counts=True)
            left = np.repeat(some, len(others)).astype(np.int64)
            owners = np.full(len(left), own_a[first_a[g]])
            out.add(left, np.tile(others, len(some)), owners, np.outer(n, m).ravel())


class Batch:
    """What alignment finds in some documents, and their links by (pair, document)."""

    def __init__(self, documents: int) -> None:
        self.documents = documents
        self.n_a, self.n_b, self.n_groups, self.n_links = np.zeros((4, documents), np.int64)
        self.digests: list[hashlib._Hash | None] = [None] * documents
        self.keys: list[np.ndarray] = []
        self.times: list[np.ndarray] = []

    def write(self, document: int, text: bytes) -> None:
        """The next part of a document's groups, with a sign at the end."""
        if self.digests[document] is None:
            self.digests[document] = hashlib.sha256()
        else:
            self.digests[document].update(b";")
        self.digests[document].update(text[:-1])

    def add(
        self, a: np.ndarray, b: np.ndarray, owners: np.ndarray, times: np.ndarray | None
    ) -> None:
        keys = (a << ID_BITS | b) << DOCUMENT_BITS | owners
        if times is None:
            keys, times = runs(np.sort(keys))
        self.keys.append(keys)
        self.times.append(times)

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct keys, ascending, and how often each is linked."""
        if not self.keys:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        if len(self.keys) == 1:
            return self.keys[0], self.times[0]
        keys, times = np.concatenate(self.keys), np.concatenate(self.times)
        order = np.argsort(keys)
        found, sizes = runs(keys[order])
        first = np.cumsum(sizes) - sizes
        return found, np.add.reduceat(times[order], first) if len(found) else times

    def hexdigests(self) -> list[str]:
        return [d.hexdigest() if d else "" for d in self.digests]


@functools.cache
def aligner(byte_bpe: str, pieces: str) -> Aligner:
    """One per worker process."""
    return Aligner(public_tokenizers.path(byte_bpe), public_tokenizers.path(pieces))


# --- the index --------------------------------------------------------------------------

COUNTS = ("n_a", "n_b", "n_groups", "n_links")
_LONGS = T.ArrayType(T.LongType())


def _chunk_schema(key: T.DataType) -> T.StructType:
    fields = [
        ("chunk", T.LongType()),
        ("keys", T.ArrayType(key)),
        *((c, _LONGS) for c in COUNTS),
        ("groups", T.ArrayType(T.StringType())),
        ("pairs", _LONGS),
        ("held", _LONGS),
        ("times", _LONGS),
        ("planes", T.BinaryType()),
    ]
    return T.StructType([T.StructField(*f) for f in fields])


class Chunk:
    """Documents of a task until their postings are enough for a row of the index."""

    def __init__(self) -> None:
        self.keys: list[pa.Array] = []
        self.found: list[Batch] = []
        self.parts: list[Postings] = []
        self.documents = self.postings = 0

    def add(self, keys: pa.Array, batch: Batch) -> None:
        links, times = batch.links()
        # numbers in the chunk; those of pairs stay above them
        shifted = links + self.documents
        self.keys.append(keys)
        self.found.append(batch)
        self.documents += batch.documents
        self.parts.append(Postings.of(shifted, times, self.documents))
        self.postings += len(links)
        batch.keys = batch.times = []

    def row(self, number: int) -> pa.RecordBatch:
        merged = Postings.merged(self.parts, self.documents)
        pairs, held, times = merged.counts(self.documents)

        def one(values: pa.Array) -> pa.Array:
            return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

        counts = (np.concatenate([getattr(f, c) for f in self.found]) for c in COUNTS)
        groups = [d for f in self.found for d in f.hexdigests()]
        columns = {
            "chunk": pa.array([number], pa.int64()),
            "keys": one(pa.concat_arrays(self.keys)),
            **{c: one(pa.array(v)) for c, v in zip(COUNTS, counts)},
            "groups": one(pa.array(groups, pa.string())),
            **{n: one(pa.array(v)) for n, v in (("pairs", pairs), ("held", held), ("times", times))},
            "planes": pa.array([merged.encode(pairs)], pa.binary()),
        }
        return pa.record_batch(columns)


def _indexed(byte_bpe: str, pieces: str):
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = aligner(byte_bpe, pieces)
        task, number = TaskContext.get().partitionId() << 32, 0
        chunk = Chunk()
        for batch in batches:
            texts = batch.column(1).to_pylist()
            start = size = 0
            for i, text in enumerate(texts):
                size += len(text)
                if size < BATCH_CHARS and i + 1 < len(texts):
                    continue
                chunk.add(batch.column(0)[start : i + 1], found.batch(texts[start : i + 1]))
                start, size = i + 1, 0
                # room for another batch
                full = chunk.documents > DOCUMENTS - batch.num_rows
                if full or chunk.postings >= CHUNK_POSTINGS:
                    yield chunk.row(task + number)
                    chunk, number = Chunk(), number + 1
        if chunk.documents:
            yield chunk.row(task + number)

    return index


@dataclass
class PairIndex:
    """A written index: a row a chunk of documents."""

    spark: SparkSession
    path: str
    key: str
    key_type: T.DataType

    def chunks(self) -> DataFrame:
        return self.spark.read.schema(_chunk_schema(self.key_type)).parquet(self.path)

    def pairs(self) -> DataFrame:
        """Per pair of ids ``a``, ``b``: ``documents`` that link it, ``links``, and whether no
        other pair of the same ``a`` is in more documents (``best``, ties included)."""
        each = self.chunks().select(F.inline(F.arrays_zip("pairs", "held", "times")))
        counted = each.groupBy("pairs").agg(
            F.sum("held").alias("documents"), F.sum("times").alias("links")
        )
        counted = counted.withColumn("a", F.shiftright("pairs", ID_BITS).cast("int"))
        # an id of one vocabulary meets at most all ids of the other
        most = F.max("documents").over(Window.partitionBy("a"))
        return counted.select(
            F.col("pairs").alias("pair"),
            "a",
            F.col("pairs").bitwiseAND((1 << ID_BITS) - 1).cast("int").alias("b"),
            "documents",
            "links",
            (F.col("documents") == most).alias("best"),
        )

    def scores(self) -> DataFrame:
        """One row per document; see ``align_documents``."""
        needed = self.chunks().select("chunk", F.explode("pairs").alias("pair"))
        counts = needed.join(self.pairs().select("pair", "documents", "best"), "pair")
        longs = [*COUNTS, "n_best", "count_sum"]
        fields = [T.StructField("_key", self.key_type)]
        fields += [T.StructField(c, T.LongType()) for c in longs]
        fields += [T.StructField("groups_sha256", T.StringType())]
        chunks = self.chunks().drop("held", "times")
        rows = chunks.groupBy("chunk").cogroup(counts.groupBy("chunk"))
        return rows.applyInArrow(_scored, T.StructType(fields)).withColumnRenamed("_key", self.key)


def _scored(chunk: pa.Table, counts: pa.Table) -> pa.Table:
    """A chunk's documents, with the counts that come back by their postings."""
    row = {name: chunk[name].combine_chunks() for name in chunk.column_names}
    pairs, keys = row["pairs"].values.to_numpy(), row["keys"].values
    documents = best = np.empty(0, np.int64)
    if len(pairs):
        order = np.argsort(counts["pair"].to_numpy())
        documents = counts["documents"].to_numpy()[order]
        best = counts["best"].to_numpy()[order].astype(np.int64)
    postings = Postings.decode(row["planes"][0].as_py(), pairs)
    return pa.table(
        {
            "_key": keys,
            **{c: row[c].values for c in COUNTS},
            "n_best": postings.sums(pairs, best, len(keys)),
            "count_sum": postings.sums(pairs, documents, len(keys)),
            "groups_sha256": row["groups"].values,
        }
    )


def write_pair_index(
    df: DataFrame,
    path: str,
    key: str = "doc_id",
    text: str = "text",
    byte_bpe: str = BYTE_BPE,
    pieces: str = PIECES,
) -> PairIndex:
    """Align every text of ``df`` and write the index below the shared folder ``path``.

    The tokenizers' names are those of files that every executor has. A task holds one batch of
    texts and one chunk of postings; a longer text is aligned stretch by stretch.
    """
    rows = df.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    schema = _chunk_schema(rows.schema["_key"].dataType)
    found = rows.mapInArrow(_indexed(byte_bpe, pieces), schema)
    # rows are large: a row group, which writers and readers hold, has a few of them
    writer = found.write.option("compression", "zstd").option("parquet.block.row.count.limit", "8")
    writer.parquet(path)
    return PairIndex(df.sparkSession, path, key, rows.schema["_key"].dataType)


def align_documents(df: DataFrame, key: str = "doc_id", text: str = "text", **files: str) -> DataFrame:
    """One row per input row: how the tokens of two tokenizers align in the text.

    ``n_a`` tokens of the byte-level tokenizer for a space and the text, ``n_b`` pieces of the
    SentencePiece model, ``n_groups``, ``n_links``; over the links, an id pair counting the
    documents that link it, ``n_best`` links whose count is the highest of their first id (ties
    included) and ``count_sum``; ``groups_sha256`` is the SHA-256 of the groups as
    ``a1,a2|b1;a3|b2,b3``.

    A NULL or empty text has no tokens: zeros and an empty ``groups_sha256``. So has a text whose
    tokens' bytes are not its own, one that holds U+2581, say. A NULL key stays NULL, equal rows
    count as documents of their own, an empty table gives an empty one.
    """
    path = workspace(df.sparkSession, "pair-index")
    return write_pair_index(df, path, key, text, **files).scores()
