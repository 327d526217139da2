"""Merkle manifest of a dataset: digests of rows, of groups and of the whole, with proofs.

Every row is a leaf. The leaves of a group, in the order of the key, form a tree in which eight
consecutive nodes become one; the groups' roots, in the order of the groups, form the tree above.

A tree is stored in aligned blocks: subtrees of height 4 over 4,096 leaves at most, each in van
Emde Boas layout. There a tree is split at half its height into a top tree and the trees below
it, which lie one after the other and are split in turn, so that any path touches few
neighbourhoods whatever the size of a cache line or page. A node's place follows from its depth
and number alone. The roots of the blocks are the leaves of the next tier of blocks, until one
block holds a tree's root. A task holds one block at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faremill.llm.common import stored

ARITY = 8
HEIGHT = 4
BLOCK = ARITY**HEIGHT
DIGEST = 32
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def H(raw: bytes) -> bytes:
    """Digest of digests, which are taken as hexadecimal text."""
    return hashlib.sha256(raw.hex().encode()).digest()


# --- van Emde Boas layout ---------------------------------------------------------------


def node_count(levels: int) -> int:
    return (ARITY**levels - 1) // (ARITY - 1)


def address(depth: int, index: np.ndarray, levels: int) -> np.ndarray:
    """Places of the nodes ``index`` at ``depth`` (the root's is 0) of a tree of ``levels``."""
    if levels == 1:
        return np.zeros_like(index)
    top = levels // 2
    if depth < top:
        return address(depth, index, top)
    width = ARITY ** (depth - top)  # nodes at this depth in each tree below the top one
    inner = address(depth - top, index % width, levels - top)
    return node_count(top) + index // width * node_count(levels - top) + inner


def height_over(leaves: int) -> int:
    height = 0
    while ARITY**height < leaves:
        height += 1
    return height


@dataclass
class Block:
    """A subtree of ``height`` over ``leaves`` leaves; its root lies first."""

    height: int
    leaves: int
    nodes: bytes

    @classmethod
    def build(cls, digests: list[bytes], height: int) -> Block:
        levels = height + 1
        places, rows = [], []
        row = b"".join(digests)
        for depth in range(height, -1, -1):
            places.append(address(depth, np.arange(len(row) // DIGEST), levels))
            rows.append(np.frombuffer(row, np.uint8).reshape(-1, DIGEST))
            run = ARITY * DIGEST
            row = b"".join(H(row[i : i + run]) for i in range(0, len(row), run))
        at = np.concatenate(places)
        nodes = np.zeros((at.max() + 1, DIGEST), np.uint8)
        nodes[at] = np.concatenate(rows)
        return cls(height, len(digests), nodes.tobytes())

    @property
    def root(self) -> bytes:
        return self.nodes[:DIGEST]

    def row(self, depth: int) -> bytes:
        """The digests at a depth, in order."""
        count = -(-self.leaves // ARITY ** (self.height - depth))
        nodes = np.frombuffer(self.nodes, np.uint8).reshape(-1, DIGEST)
        return nodes[address(depth, np.arange(count), self.height + 1)].tobytes()

    def paths(self, above: bytes) -> list[bytes]:
        """For each leaf its way to the root, followed by the way ``above``.

        A step is the place in the run, the run's length, and the siblings' digests.
        """
        found = [above]
        for depth in range(1, self.height + 1):
            row = self.row(depth)
            steps = []
            for i in range(len(row) // DIGEST):
                first, own = i - i % ARITY, i % ARITY
                run = row[first * DIGEST : (first + ARITY) * DIGEST]
                siblings = run[: own * DIGEST] + run[(own + 1) * DIGEST :]
                steps.append(bytes([own, len(run) // DIGEST]) + siblings + found[i // ARITY])
            found = steps
        return found


def steps_of(path: bytes) -> Iterator[tuple[int, bytes]]:
    """Place in the run and siblings, step by step."""
    at = 0
    while at < len(path):
        own, end = path[at], at + 2 + (path[at + 1] - 1) * DIGEST
        yield own, path[at + 2 : end]
        at = end


def fold(leaf: bytes, path: bytes) -> bytes:
    """The root that follows from a leaf and its siblings."""
    for own, siblings in steps_of(path):
        leaf = H(siblings[: own * DIGEST] + leaf + siblings[own * DIGEST :])
    return leaf


def siblings_of(path: bytes) -> bytes:
    return b"".join(siblings for _, siblings in steps_of(path))


# --- trees as tables --------------------------------------------------------------------


def _positions(rows: DataFrame, label: str, *order: str) -> DataFrame:
    """Stored ``rows`` with ``pos``, their number within ``tree`` in this order, and ``total``.

    The rows are dealt by ranges and numbered in each; only the counts by tree and range go
    through a window.
    """
    dealt = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    placed = stored(dealt.withColumn("_at", F.monotonically_increasing_id()), label)
    placed = placed.withColumn("_part", F.shiftright("_at", 33))
    runs = placed.groupBy("tree", "_part").agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    tree = Window.partitionBy("tree")
    before = tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        "tree",
        "_part",
        (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_rows").over(tree).alias("total"),
    )
    found = placed.join(runs, ["tree", "_part"])
    return found.withColumn("pos", F.col("_at") + F.col("_shift")).drop("_at", "_part", "_shift")


# trees and their blocks, the nodes in layout
TIER = "tree string, block long, total long, height int, leaves int, nodes binary"


def _blocks(leaves: DataFrame) -> DataFrame:
    """A tier: the blocks over ``leaves`` (tree, pos, total, digest)."""

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        total = int(rows["total"].iloc[0])
        height = HEIGHT if total > BLOCK else height_over(total)
        made = Block.build(rows["digest"].to_list(), height)
        first = rows[["tree", "block", "total"]].head(1)
        return first.assign(height=height, leaves=made.leaves, nodes=made.nodes)

    leaves = leaves.select("tree", "pos", "total", "digest", _block_of("pos"))
    return leaves.groupBy("tree", "block").applyInPandas(build, TIER)


def _block_of(pos: str) -> Column:
    return F.floor(F.col(pos) / BLOCK).alias("block")


def _root_of(nodes: str) -> Column:
    return F.substring(nodes, 1, DIGEST)


def _tiers(leaves: DataFrame, path: str) -> list[str]:
    """Write the tiers over ``leaves`` and return their folders, the lowest first."""
    spark = leaves.sparkSession
    folders: list[str] = []
    while True:
        folders.append(f"{path}-{len(folders)}")
        _blocks(leaves).write.parquet(folders[-1])
        tier = spark.read.schema(TIER).parquet(folders[-1])
        above = tier.filter(F.col("total") > BLOCK)
        if above.isEmpty():
            return folders
        leaves = above.select(
            "tree",
            F.col("block").alias("pos"),
            F.ceil(F.col("total") / BLOCK).alias("total"),
            _root_of("nodes").alias("digest"),
        )


WAY = "tree string, block long, path binary, subroot binary, root binary"


def _ways(spark: SparkSession, folders: list[str], tops: DataFrame) -> DataFrame:
    """For each block of the lowest tier the way from its root to the end.

    ``tops`` (as ``WAY``, without ``block``) has the way from each tree's root.
    """

    def down(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                paths = Block(r.height, r.leaves, r.nodes).paths(r.path)
                below = np.arange(len(paths)) + r.block * BLOCK
                yield pd.DataFrame(
                    {"tree": r.tree, "block": below, "path": paths, "subroot": r.subroot,
                     "root": r.root}
                )

    ways = above = None
    for folder in reversed(folders):
        tier = spark.read.schema(TIER).parquet(folder)
        last = tier.filter(F.col("total") <= BLOCK).select("tree", "block")
        own = last.join(tops, "tree").select("tree", "block", "path", "subroot", "root")
        if above is not None:
            own = own.unionByName(above.join(ways, ["tree", "block"]).mapInPandas(down, WAY))
        ways, above = own, tier
    return ways


def _roots(spark: SparkSession, folders: list[str]) -> DataFrame:
    """The root of every tree."""
    tiers = (spark.read.schema(TIER).parquet(f) for f in folders)
    found = [t.filter(F.col("total") <= BLOCK).select("tree", _root_of("nodes").alias("digest")) for t in tiers]
    out = found[0]
    for one in found[1:]:
        out = out.unionByName(one)
    return out


# --- the manifest -----------------------------------------------------------------------


def digest_of(values: list[Column]) -> Column:
    """H of values: ``-`` for NULL, else the UTF-8 byte count, ``:`` and the value."""
    parts = []
    for value in values:
        text = value.cast("string")
        parts.append(
            F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
        )
    return F.unhex(F.sha2(F.concat(*parts), 256))


@dataclass
class Manifest:
    """A written manifest: the leaves in order, and the tiers of blocks over them."""

    spark: SparkSession
    leaves: DataFrame
    tiers: list[str]
    group_order: DataFrame
    top_tiers: list[str]
    key: str

    def root(self) -> str | None:
        """The digest of the whole dataset; None for an empty one."""
        row = _roots(self.spark, self.top_tiers).first()
        return bytes(row.digest).hex() if row else None

    def proofs(self, with_proof: bool = False) -> DataFrame:
        """One row per row of the dataset; see ``write_manifest``."""
        # one row, as the groups' roots form one tree
        top = _roots(self.spark, self.top_tiers).select(
            "tree",
            F.lit(b"").alias("path"),
            F.lit(b"").alias("subroot"),
            F.col("digest").alias("root"),
        )
        upper = _ways(self.spark, self.top_tiers, top)
        groups = self.group_order.select("tree", "group", "digest", "pos", _block_of("pos"))
        tops = _along(groups, self.spark.read.schema(TIER).parquet(self.top_tiers[0]), upper)
        ways = _ways(self.spark, self.tiers, stored(tops, "merkle-tops"))
        blocks = self.spark.read.schema(TIER).parquet(self.tiers[0])
        rows = self.leaves.select("*", _block_of("pos"))
        return _proven(rows, blocks.join(ways, ["tree", "block"]), self.key, with_proof)


def _text_fields(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


def _block_and_paths(right: pa.Table) -> tuple[dict, list[bytes]]:
    """The one row of a block, and the ways of its leaves."""
    (r,) = right.to_pylist()
    return r, Block(r["height"], r["leaves"], r["nodes"]).paths(r["path"])


def _along(groups: DataFrame, blocks: DataFrame, ways: DataFrame) -> DataFrame:
    """The groups with the way of each root to the end, as ``tops``."""

    def find(left: pa.Table, right: pa.Table) -> pa.Table:
        r, paths = _block_and_paths(right)
        own = pa.array([paths[i % BLOCK] for i in left["pos"].to_pylist()], pa.binary())
        root = pa.array([r["root"]] * len(left), pa.binary())
        return pa.table([left["group"], own, left["digest"], root], TOPS)

    at = ["tree", "block"]
    right = blocks.join(ways, at).groupBy(*at)
    schema = "tree string, path binary, subroot binary, root binary"
    return groups.groupBy(*at).cogroup(right).applyInArrow(find, schema)


TOPS = ["tree", "path", "subroot", "root"]
PROOF = ["leaf", "subroot", "root", "proof_sha256", "folded_root"]


def _proven(rows: DataFrame, blocks: DataFrame, key: str, with_proof: bool) -> DataFrame:
    names = [*PROOF, *(["proof"] if with_proof else [])]

    def prove(left: pa.Table, right: pa.Table) -> pa.Table:
        r, paths = _block_and_paths(right)
        subroot, root = r["subroot"].hex(), r["root"].hex()
        out: list[list[str]] = [[] for _ in names]
        some = (left[c].to_pylist() for c in ("pos", "digest", "changed"))
        for pos, leaf, changed in zip(*some, strict=True):
            path = paths[pos % BLOCK]
            proof = siblings_of(path)
            folded = fold(leaf if changed is None else changed, path)
            row = [leaf.hex(), subroot, root, H(proof).hex(), folded.hex(), proof.hex()]
            for column, value in zip(out, row):
                column.append(value)
        return pa.table([left["_key"], *(pa.array(c, pa.string()) for c in out)], ["_key", *names])

    at = ["tree", "block"]
    schema = T.StructType([rows.schema["_key"], *_text_fields(*names)])
    found = rows.groupBy(*at).cogroup(blocks.groupBy(*at)).applyInArrow(prove, schema)
    found = found.withColumn("verified", F.col("folded_root") == F.col("root"))
    return found.withColumnRenamed("_key", key)


def write_manifest(
    df: DataFrame,
    path: str,
    key: str = "doc_id",
    group: str = "lang",
    fields: tuple[str, ...] = FIELDS,
    altered: dict[str, Column] | None = None,
    where: Column | None = None,
) -> Manifest:
    """Write the manifest of ``df`` below the shared folder ``path``.

    A row's leaf is the digest of its ``fields``. Groups are ordered by their UTF-8 bytes, NULL
    first; the rows of a group ascend by ``key``, NULL first, then by their leaf. Equal rows are
    leaves of their own, as often as they occur, dealt to ranges by a number each has. An empty
    table has no root. Texts leave no task: only digests, keys and groups are shuffled.

    ``altered`` holds other values for some fields, as if read from a damaged copy, of the rows
    for which ``where`` is true; ``Manifest.proofs`` folds these instead of the rows' own.

    ``proofs`` returns per row the key, ``leaf``, the group's ``subroot``, the ``root``,
    ``proof_sha256`` (digest of all siblings from the leaf up, left to right; that of the empty
    text if there are none), ``folded_root`` (from the row as read and the stored siblings),
    ``verified`` (whether that is the root) and, if wanted, ``proof`` (the siblings in hex).
    """
    columns = {f: F.col(f) for f in fields}
    leaf = digest_of(list(columns.values()))
    changed = F.lit(None).cast("binary")
    if altered:
        changed = F.when(where, digest_of(list((columns | altered).values())))
    # a NULL group is the empty text, any other begins with a dot: the same order
    tree = F.coalesce(F.concat(F.lit("."), F.col(group).cast("string")), F.lit(""))
    leaves = stored(
        df.select(
            tree.alias("tree"),
            F.col(key).alias("_key"),
            leaf.alias("digest"),
            changed.alias("changed"),
            F.monotonically_increasing_id().alias("_copy"),
        ),
        "merkle-leaves",
    )
    placed = _positions(leaves, "merkle-order", "_key", "digest", "_copy").drop("_copy")
    spark = df.sparkSession
    placed.write.parquet(f"{path}/leaves")
    placed = spark.read.schema(placed.schema).parquet(f"{path}/leaves")
    tiers = _tiers(placed, f"{path}/tier")
    groups = _roots(spark, tiers).select(
        F.lit("").alias("tree"), F.col("tree").alias("group"), "digest"
    )
    order = _positions(stored(groups, "merkle-groups"), "merkle-group-order", "group")
    top_tiers = _tiers(order, f"{path}/top")
    return Manifest(spark, placed, tiers, order, top_tiers, key)
