"""The registered queries, and the pipeline against a version in plain Python."""

from __future__ import annotations

import itertools
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from faremill.llm import queries, toxicity
from faremill.llm.common import prepare, table
from tests import oracle
from tests.llm.helpers import LONG, edge_documents
from tests.llm.test_dedup import classes


@pytest.mark.parametrize("name", queries.SQL)
def test_same_answer(spark, sf_dir, name):
    con = oracle.connect(sf_dir)
    assert oracle.difference(queries.QUERIES[name](spark, sf_dir), con, queries.SQL[name]) is None


def test_every_operator_is_registered():
    names = set(contract.queries())
    numbers = {int(m[1]) for n in names if (m := re.match(r"op(\d+)_", n))}
    assert numbers == set(range(1, 14)) and "pipeline" in names
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "exact dedup", "MinHash near-dedup", "best-fit packing",
    ]


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_whole_tables_are_answered(spark, sf_dir, name):
    got = queries.QUERIES[name](spark, sf_dir)
    ids = {r[0] for r in got.select("doc_id").collect()}
    assert ids == {r[0] for r in table(spark, sf_dir, "documents").select("doc_id").collect()}


def test_stages_equal_plain_python(spark, sf_dir, folder):
    docs = table(spark, sf_dir, "documents")
    kept = docs
    rows = {r.doc_id: r for r in docs.collect()}
    model = toxicity.train_model(docs, table(spark, sf_dir, "labels"))
    model.build_table()
    cut = model.thresholds
    want = {
        i for i, r in rows.items() if model.score(r.text or "") < cut.get(r.lang, cut[""])
    }
    expected = [want]
    groups = {}
    for i in sorted(want):
        groups.setdefault(re.sub("[\x20\x09-\x0d]", "", rows[i].text or ""), []).append(i)
    want = {min(g, key=lambda i: (-len(rows[i].text or ""), i)) for g in groups.values()}
    expected.append(want)
    texts = sorted((i, rows[i].text or "") for i in want)
    pairs = [
        (a, b) for (a, x), (b, y) in itertools.combinations(texts, 2) if jaccard_(x, y) >= 0.8
    ]
    expected.append(set(classes(pairs, want).values()))
    for n, ((name, stage), ids) in enumerate(zip(corpus_pipeline.STAGES, expected)):
        path = f"{folder}/{n}"
        stage(spark, kept, sf_dir).write.parquet(path)
        kept = spark.read.parquet(path)
        assert kept.columns == docs.columns, name
        assert sorted(r.doc_id for r in kept.collect()) == sorted(ids), name
        assert {r.doc_id: r.text for r in kept.collect()} == {i: rows[i].text for i in ids}
    packed = corpus_pipeline.STAGES[-1][1](spark, kept, sf_dir)
    assert {r.doc_id for r in packed.collect()} == expected[-1]


def jaccard_(a: str, b: str) -> float:
    def grams(t):
        # letters and digits of any script, as the documents' four languages have them
        w = re.findall(r"[^\W_]+", t.lower())
        out = {}
        for i in range(max(1, len(w) - 4) if w else 0):
            out[tuple(w[i : i + 5])] = out.get(tuple(w[i : i + 5]), 0) + 1
        return out

    x, y = grams(a), grams(b)
    common = sum(min(n, y.get(g, 0)) for g, n in x.items())
    return common / max(1, sum(x.values()) + sum(y.values()) - common)


def test_stages_take_edge_documents(spark, sf_dir, folder):
    """NULL keys and texts, repeats, a very long text and clashing columns, stage by stage."""
    prepare(spark)
    edge = edge_documents(spark).select("doc_id", "text")
    extra = [(20, "alpha beta gamma delta epsilon zeta eta"), (21, None), (21, None), (22, "You idiot!")]
    edge = edge.unionByName(spark.createDataFrame(extra, edge.schema))
    # keys without labels: nothing is learned, and nothing rejected
    edge = edge.withColumn("doc_id", F.col("doc_id") + 10**9)
    names = ["row", "score", "limit", "uid", "kept", "digest", "name", "label", "_key"]
    docs = edge.selectExpr(
        "doc_id", "text", "CAST(NULL AS STRING) AS lang", "'s' AS source", "length(text) AS n_chars",
        *[f"'{n}!' AS {n}" for n in names],
    )
    kept = docs
    counts = []
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, kept, sf_dir).write.parquet(f"{folder}/{n}")
        before, kept = kept, spark.read.parquet(f"{folder}/{n}")
        assert kept.columns == docs.columns, name
        rows = kept.collect()
        assert all(r[c] == f"{c}!" for r in rows for c in names), name
        texts = Counter((r.doc_id, r.text) for r in rows)
        assert texts <= Counter((r.doc_id, r.text) for r in before.collect()), name
        counts.append((before, rows))
    assert len(counts[0][1]) == docs.count()
    before, rows = counts[1]
    bare = lambda t: re.sub("[\x20\x09-\x0d]", "", t or "")
    assert sorted(bare(r.text) for r in rows) == sorted({bare(r.text) for r in before.collect()})
    before, rows = counts[2]
    texts = [(i, r.text or "") for i, r in enumerate(before.collect())]
    pairs = [
        (a, b) for (a, x), (b, y) in itertools.combinations(texts, 2) if jaccard_(x, y) >= 0.8
    ]
    want = classes(pairs, range(len(texts)))
    assert len(rows) == len(set(want.values()))
    assert max(len(r.text or "") for r in rows) == len(LONG)
    packed = corpus_pipeline.STAGES[-1][1](spark, kept, sf_dir).collect()
    assert Counter(r.doc_id for r in packed if r.piece == 0) == Counter(r.doc_id for r in rows)


def test_run_gives_the_last_stage(spark, sf_dir):
    got = corpus_pipeline.run(spark, sf_dir)
    assert {"doc_id", "sequence_id", "offset"} <= set(got.columns) and got.count() > 0


def test_stages_take_an_empty_table(spark, sf_dir):
    none = table(spark, sf_dir, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, sf_dir).count() == 0
