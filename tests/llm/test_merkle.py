"""Merkle manifests against trees built level by level, and the layout's addresses."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from faremill.llm import merkle
from faremill.llm.common import prepare
from tests.llm.helpers import edge_documents, empty_documents


@pytest.fixture(scope="module", autouse=True)
def ready(spark):
    prepare(spark)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(*values):
    parts = ("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)
    return sha("".join(parts))


def levels_over(nodes):
    """All levels of a tree, the leaves first."""
    out = [nodes]
    while len(nodes) > 1:
        nodes = [sha("".join(nodes[i : i + 8])) for i in range(0, len(nodes), 8)]
        out.append(nodes)
    return out


def siblings(levels, at):
    out = []
    for row in levels[:-1]:
        first = at // 8 * 8
        out += [h for i, h in enumerate(row[first : first + 8], first) if i != at]
        at //= 8
    return out


def refolded(levels, at, h):
    for row in levels[:-1]:
        first = at // 8 * 8
        run = row[first : first + 8]
        run[at - first] = h
        h = sha("".join(run))
        at //= 8
    return h


def expected(rows, fields, key, group, changed):
    """Result rows, for rows as dictionaries; ``changed`` gives the leaf as read, or None."""
    groups = {}
    for r in rows:
        groups.setdefault(r[group], []).append((r[key], leaf_of(*(r[f] for f in fields)), r))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[g] = levels_over([x[1] for x in groups[g]])
    top = levels_over([trees[g][-1][0] for g in order])
    out = []
    for n, g in enumerate(order):
        for at, (k, leaf, r) in enumerate(groups[g]):
            proof = sha("".join(siblings(trees[g], at) + siblings(top, n)))
            folded = refolded(top, n, refolded(trees[g], at, changed(r) or leaf))
            root = top[-1][0]
            out.append((k, leaf, trees[g][-1][0], root, proof, folded, folded == root))
    return out


def result(manifest, key="doc_id"):
    columns = [key, "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return [tuple(r) for r in manifest.proofs().select(columns).collect()]


@pytest.mark.parametrize("levels", [1, 2, 3, 4, 5])
def test_every_node_has_a_place_of_its_own(levels):
    places = np.concatenate(
        [merkle.address(d, np.arange(8**d), levels) for d in range(levels)]
    )
    assert sorted(places) == list(range(merkle.node_count(levels)))
    assert merkle.address(0, np.arange(1), levels)[0] == 0


def test_trees_below_the_top_one_lie_together():
    """Of five levels the upper two lie first, then each tree of the lower three."""
    first = merkle.node_count(2)
    for tree in range(64):
        for depth in (2, 3, 4):
            width = 8 ** (depth - 2)
            own = merkle.address(depth, np.arange(tree * width, (tree + 1) * width), 5)
            begin = first + tree * merkle.node_count(3)
            assert begin <= own.min() and own.max() < begin + merkle.node_count(3)


@pytest.mark.parametrize("leaves", [1, 2, 7, 8, 9, 64, 65, 100, 513])
def test_paths_of_a_block_lead_to_its_root(leaves):
    digests = [hashlib.sha256(bytes([i % 256, i // 256])).digest() for i in range(leaves)]
    levels = levels_over([d.hex() for d in digests])
    block = merkle.Block.build(digests, merkle.height_over(leaves))
    assert block.root.hex() == levels[-1][0]
    for i, path in enumerate(block.paths(b"")):
        assert merkle.fold(digests[i], path) == block.root
        assert merkle.siblings_of(path).hex() == "".join(siblings(levels, i))


@pytest.mark.parametrize("block_height", [1, 2, 4])
def test_edge_documents_over_several_tiers(spark, folder, monkeypatch, block_height):
    """NULLs, repeated rows and one large group, with blocks small enough for several tiers."""
    prepare(spark)
    monkeypatch.setattr(merkle, "HEIGHT", block_height)
    monkeypatch.setattr(merkle, "BLOCK", 8**block_height)
    # the functions that tasks run are sent by value, with the constants of this test
    fields = ("doc_id", "text", "kept", "id")
    docs = edge_documents(spark).withColumn(
        "lang", F.when(F.col("doc_id") > 5, F.lit("ü")).when(F.col("doc_id") > 2, F.lit("z"))
    )
    many = spark.range(700).select(
        (F.col("id") % 650).alias("doc_id"),
        F.concat(F.lit("Text "), (F.col("id") % 650).cast("string")).alias("text"),
        *(F.lit(v).alias(c) for c, v in zip(docs.columns[2:-2], ("x", "y", "z", "k"))),
        F.lit(1).alias("id"),
        F.lit("en").alias("lang"),
    )
    docs = docs.unionByName(many)
    rows = [r.asDict() for r in docs.collect()]
    where = F.col("doc_id") % 3 == 0
    manifest = merkle.write_manifest(
        docs, f"{folder}/m", fields=fields, altered={"text": F.lower("text")}, where=where
    )

    def changed(r):
        if r["doc_id"] is None or r["doc_id"] % 3:
            return None
        return leaf_of(*((r[f] and r[f].lower()) if f == "text" else r[f] for f in fields))

    want = expected(rows, fields, "doc_id", "lang", changed)
    assert Counter(result(manifest)) == Counter(want)
    assert manifest.root() == want[0][3]
    assert any(r[-1] for r in want) and not all(r[-1] for r in want)


def test_equal_rows_over_several_ranges(spark, folder):
    """One row that is most of the table is dealt to all ranges."""
    docs = spark.range(6000).select(
        F.when(F.col("id") < 5000, 7).otherwise(F.col("id")).alias("doc_id"),
        F.lit("en").alias("lang"),
        F.lit("same").alias("text"),
    )
    manifest = merkle.write_manifest(docs, f"{folder}/m", fields=("doc_id", "text"))
    rows = [r.asDict() for r in docs.collect()]
    want = expected(rows, ("doc_id", "text"), "doc_id", "lang", lambda r: None)
    assert Counter(result(manifest)) == Counter(want)


def test_one_row_and_no_row(spark, folder):
    one = edge_documents(spark).limit(1).withColumn("lang", F.lit(None).cast("string"))
    manifest = merkle.write_manifest(one, f"{folder}/one", fields=("doc_id",))
    (row,) = result(manifest)
    assert row == (1, leaf_of(1), leaf_of(1), leaf_of(1), sha(""), leaf_of(1), True)
    none = empty_documents(spark).withColumn("lang", F.lit("x"))
    manifest = merkle.write_manifest(none, f"{folder}/none", fields=("doc_id",))
    assert result(manifest) == [] and manifest.root() is None


def test_proofs_are_the_siblings(spark, folder):
    docs = spark.range(20).select(F.col("id").alias("doc_id"), F.lit("a").alias("lang"))
    manifest = merkle.write_manifest(docs, f"{folder}/m", fields=("doc_id",))
    levels = levels_over([leaf_of(i) for i in range(20)])
    for r in manifest.proofs(with_proof=True).collect():
        assert r.proof == "".join(siblings(levels, r.doc_id))
        assert r.proof_sha256 == sha(r.proof) and r.verified
