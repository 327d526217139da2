"""Cross-tokenizer alignment against a plain loop over tokens, and the compressed sets."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from faremill.llm import alignment, pair_bitmaps
from faremill.llm.common import prepare, table
from tests.llm.helpers import edge_documents, empty_documents

LATIN = [*range(33, 127), *range(161, 173), *range(174, 256)]


@pytest.fixture(scope="module", autouse=True)
def ready(spark):
    prepare(spark)


@pytest.fixture(scope="module")
def libraries():
    first = Tokenizer.from_file(public_tokenizers.path(alignment.BYTE_BPE))
    first.encode_special_tokens = True
    path = public_tokenizers.path(alignment.PIECES)
    return first, sentencepiece.SentencePieceProcessor(model_file=path)


def plain_groups(text, libraries):
    """Groups of (ids of A, ids of B); none if a text has no tokens."""
    if not text:
        return []
    first, second = libraries
    byte_of = {chr(b): b for b in LATIN}
    byte_of |= {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in LATIN)}
    whole = (" " + text).encode()
    a = [
        (i, bytes(byte_of[c] for c in first.id_to_token(i)))
        for i in first.encode(" " + text, add_special_tokens=False).ids
    ]
    b = []
    for i in second.encode(text):
        piece = second.id_to_piece(i)
        own = bytes([int(piece[3:5], 16)]) if second.is_byte(i) else piece.replace("▁", " ").encode()
        b.append((i, own))
    if b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
        return []
    out, left, right, size_a, size_b = [], [], [], 0, 0
    a, b = a[::-1], b[::-1]
    while a or b:
        if size_a <= size_b:
            i, own = a.pop()
            left.append(i)
            size_a += len(own)
        else:
            i, own = b.pop()
            right.append(i)
            size_b += len(own)
        if size_a == size_b and left and right:
            out.append((left, right))
            left, right = [], []
    return out


def expected(rows, libraries):
    """Result rows for (key, text)."""
    groups = [plain_groups(t, libraries) for _, t in rows]
    linked = [Counter((x, y) for a, b in g for x in a for y in b) for g in groups]
    documents = Counter(p for links in linked for p in links)
    most = defaultdict(int)
    for (a, _), n in documents.items():
        most[a] = max(most[a], n)
    out = []
    for (key, _), g, links in zip(rows, groups, linked):
        text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in g)
        out.append(
            (
                key,
                sum(len(a) for a, _ in g),
                sum(len(b) for _, b in g),
                len(g),
                sum(links.values()),
                sum(n for (a, b), n in links.items() if documents[a, b] == most[a]),
                sum(n * documents[p] for p, n in links.items()),
                hashlib.sha256(text.encode()).hexdigest() if g else "",
            )
        )
    return out


def result(df, **files):
    columns = ["doc_id", *alignment.COUNTS, "n_best", "count_sum", "groups_sha256"]
    return Counter(tuple(r) for r in alignment.align_documents(df, **files).select(columns).collect())


ODD = [
    "a▁b", "▁", " ", "  two  spaces\n\n\ttab ", "<s> </s> <unk> <|endoftext|> <0x0A>", "ﬁ ① é é",
    "日本語のテキスト🙂🙂", "\x00\x01", "a\xa0b　c", "1234567890123 99", "aaaaaaaaaaaaaaaaaaaa" * 9,
    "don't we'll", "﻿bom", "ÀÉÎ" * 40, "x" * 3 + "‍" + "y",
]


def test_edge_documents(spark, libraries):
    df = edge_documents(spark)
    odd = [(1000 + n, t, "x", "y", "z", "k", 1) for n, t in enumerate(ODD)]
    df = df.unionByName(spark.createDataFrame(odd, df.schema))
    rows = [(r.doc_id, r.text) for r in df.collect()]
    assert result(df) == Counter(expected(rows, libraries))


def test_the_table_over_many_chunks(spark, sf_dir, libraries, monkeypatch):
    """Small batches, stretches and chunks; pairs are counted over all of them."""
    for name, value in (("BATCH_CHARS", 4000), ("STRETCH", 300), ("CHUNK_POSTINGS", 5000)):
        monkeypatch.setattr(alignment, name, value)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").repartition(3)
    index = alignment._indexed(alignment.BYTE_BPE, alignment.PIECES)
    batches = [pa.RecordBatch.from_pandas(docs.toPandas())]
    found = aligned_here(index, batches)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert found == Counter(expected(rows, libraries))


def aligned_here(index, batches):
    """The index of this process and the counts that a query brings back, without Spark."""

    class Task:
        @staticmethod
        def get():
            return Task

        partitionId = staticmethod(lambda: 5)  # noqa: N815

    held, alignment.TaskContext = alignment.TaskContext, Task
    try:
        chunks = pa.Table.from_batches(list(index(iter(batches))))
    finally:
        alignment.TaskContext = held
    assert len(chunks) > 3
    documents = Counter()
    for r in chunks.to_pylist():
        documents.update(dict(zip(r["pairs"], r["held"])))
    most = defaultdict(int)
    for p, n in documents.items():
        most[p >> 20] = max(most[p >> 20], n)
    out = Counter()
    for i in range(len(chunks)):
        one = chunks.slice(i, 1)
        pairs = one["pairs"][0].as_py()
        random.Random(i).shuffle(pairs)
        counts = pa.table(
            {
                "pair": pa.array(pairs, pa.int64()),
                "documents": pa.array([documents[p] for p in pairs], pa.int64()),
                "best": pa.array([documents[p] == most[p >> 20] for p in pairs], pa.bool_()),
            }
        )
        out.update(tuple(r.values()) for r in alignment._scored(one, counts).to_pylist())
    return out


def test_queries_over_many_partitions(spark, sf_dir, libraries):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").repartition(7)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert result(docs) == Counter(expected(rows, libraries))


def test_pairs_of_the_corpus(spark, folder, libraries):
    texts = ["the cat", "the cat", "the dog", None, "cat cat cat"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    index = alignment.write_pair_index(df, f"{folder}/index")
    links = [
        Counter((x, y) for a, b in plain_groups(t, libraries) for x in a for y in b) for t in texts
    ]
    want = {
        p: (sum(p in one for one in links), sum(one[p] for one in links))
        for p in set().union(*links)
    }
    got = {(r.a, r.b): (r.documents, r.links) for r in index.pairs().collect()}
    assert got == want


def test_documents_without_tokens_and_without_rows(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "▁")], "doc_id long, text string")
    want = Counter((i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2, 3))
    assert result(df) == want
    assert result(empty_documents(spark)) == Counter()
    text = df.select(F.concat(F.lit("k"), "doc_id").alias("doc_id"), "text")
    assert {r[0] for r in result(text)} == {"k1", "k2", "k3"}


def test_groups_with_many_links(libraries, monkeypatch):
    """Counting by distinct ids gives the same as link by link."""
    found = alignment.aligner(alignment.BYTE_BPE, alignment.PIECES)
    texts = [t for t in ODD if t] + ["日本語" * 30]
    batch = found.batch(texts)
    monkeypatch.setattr(alignment, "MANY_LINKS", 1)
    other = found.batch(texts)
    for one, two in zip(batch.links(), other.links()):
        assert one.tolist() == two.tolist()


def test_stretches_give_the_same(monkeypatch):
    rng = random.Random(8)
    words = ["alpha", "  ", "\n", "日本", "ß", "12", "don't", "Wort"]
    texts = [" ".join(rng.choices(words, k=400)) for _ in range(5)]
    found = alignment.aligner(alignment.BYTE_BPE, alignment.PIECES)
    whole = found.batch(texts)
    monkeypatch.setattr(alignment, "STRETCH", 37)
    cut = found.batch(texts)
    assert whole.hexdigests() == cut.hexdigests()
    assert whole.n_groups.tolist() == cut.n_groups.tolist()
    for one, two in zip(whole.links(), cut.links()):
        assert one.tolist() == two.tolist()


@pytest.mark.parametrize("documents", [1, 9, 300, 65_536])
def test_sets_keep_their_documents(documents):
    rng = np.random.default_rng(documents)
    pairs = rng.integers(0, 1 << 40, 40)
    keys = np.unique(rng.choice(pairs, 3000) << 16 | rng.integers(0, documents, 3000))
    times = rng.integers(1, 9, len(keys))
    half = rng.random(len(keys)) < 0.5
    parts = [pair_bitmaps.Postings.of(keys[h], times[h], documents) for h in (half, ~half)]
    merged = pair_bitmaps.Postings.merged(parts, documents)
    found, held, total = merged.counts(documents)
    want = defaultdict(list)
    for k, t in zip(keys.tolist(), times.tolist()):
        want[k >> 16].append(t)
    assert found.tolist() == sorted(want)
    assert held.tolist() == [len(want[p]) for p in found.tolist()]
    assert total.tolist() == [sum(want[p]) for p in found.tolist()]
    again = pair_bitmaps.Postings.decode(merged.encode(found), found)
    sums = again.sums(found, held, documents)
    plain = np.zeros(documents, np.int64)
    for k, t in zip(keys.tolist(), times.tolist()):
        plain[k & 0xFFFF] += t * len(want[k >> 16])
    assert sums.tolist() == plain.tolist()
    assert (len(merged.planes[0].dense) > 0) == (documents < 2000)
