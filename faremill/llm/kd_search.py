"""Exact top-k search by inner product over KD-trees, one per shard.

Vectors become integers, floor(scale * x), so scores are exact. Rows are dealt to shards by
hash; each shard is a KD-tree: median splits on the widest coordinate, and for every node the
tight box around its rows. For a query, the largest inner product that a box allows bounds
all rows in it; nodes are visited best bound first, and a search ends when no open node can
reach the kth score found so far.

Queries travel in blocks. A block searches one shard first; the kth scores found there go
along to the other shards, where they close most boxes before any row is read.
"""

from __future__ import annotations

import heapq
import pickle
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faremill.llm.common import parts_for, stored

SCALE = 256
SHARD_ROWS = 8192
BLOCK_QUERIES = 512
LEAF_ROWS = 128
EXACT = float(1 << 53)  # sums of doubles below this are exact integers
LONG = float(1 << 63)  # scaled components and scores are below this


@dataclass
class Tree:
    """Rows in leaf order; nodes as arrays, the root first."""

    ids: np.ndarray
    numbers: np.ndarray
    rows: np.ndarray
    low: np.ndarray
    high: np.ndarray
    span: list[tuple[int, int]]
    children: list[tuple[int, int] | None]


def build(
    ids: np.ndarray,
    rows: np.ndarray,
    leaf_rows: int = LEAF_ROWS,
    numbers: np.ndarray | None = None,
) -> Tree:
    """``numbers`` tell rows apart, by default their ids do."""
    numbers = ids if numbers is None else numbers
    order = np.arange(len(rows))
    low, high, span, children = [], [], [], []
    open_ = [(0, len(rows), -1, 0)]
    while open_:
        a, b, parent, side = open_.pop()
        node = len(span)
        part = rows[order[a:b]]
        low.append(part.min(axis=0))
        high.append(part.max(axis=0))
        span.append((a, b))
        children.append(None)
        if parent >= 0:
            both = list(children[parent] or (0, 0))
            both[side] = node
            children[parent] = (both[0], both[1])
        width = high[-1] - low[-1]
        if b - a <= leaf_rows or not len(width) or not width.max():
            continue
        middle = (b - a) // 2
        order[a:b] = order[a:b][np.argpartition(part[:, int(width.argmax())], middle)]
        open_.append((a + middle, b, node, 1))
        open_.append((a, a + middle, node, 0))
    return Tree(ids[order], numbers[order], rows[order], np.array(low), np.array(high), span, children)


def search(
    tree: Tree, own_numbers: np.ndarray, queries: np.ndarray, k: int, kth: np.ndarray | None = None
) -> list[list[tuple[int, int]]]:
    """Per query its best (score, id) of the tree, at most ``k``, that can still count.

    Equal scores go to smaller ids. ``kth`` are scores that ``k`` rows elsewhere reach already;
    rows below them are left out. A row with the query's own number is never returned.
    """
    rows, queries = _number_type(tree.rows, queries)
    low, high = tree.low.astype(rows.dtype), tree.high.astype(rows.dtype)
    zero = np.zeros(1, rows.dtype)[0]
    bounds = np.maximum(queries, zero) @ high.T + np.minimum(queries, zero) @ low.T
    found = []
    for i, own in enumerate(own_numbers.tolist()):
        least = None if kth is None or kth[i] is None else int(kth[i])
        best: list[tuple[int, int]] = []
        open_ = [(-bounds[i, 0], 0)]
        while open_:
            bound, node = heapq.heappop(open_)
            if least is not None and -bound < least:
                break  # a tie may still win by its smaller id
            if tree.children[node]:
                for child in tree.children[node]:
                    if least is None or bounds[i, child] >= least:
                        heapq.heappush(open_, (-bounds[i, child], child))
                continue
            a, b = tree.span[node]
            scores = rows[a:b] @ queries[i]
            keep = tree.numbers[a:b] != own
            if least is not None:
                keep &= scores >= least
            if not keep.any():
                continue
            best += zip((-int(s) for s in scores[keep]), tree.ids[a:b][keep].tolist())
            best = heapq.nsmallest(k, best)
            if len(best) == k:
                least = max(-best[-1][0], least) if least is not None else -best[-1][0]
        found.append([(-s, v) for s, v in best])
    return found


def _number_type(rows: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Doubles where all sums are exact integers below 2**53, else Python's integers."""
    most = max(1, rows.shape[1]) * float(np.abs(rows).max(initial=0)) * float(
        np.abs(queries).max(initial=0)
    )
    kind = np.float64 if most < EXACT else object
    return rows.astype(kind), queries.astype(kind)


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_list()).astype(np.int64)


def top_k(
    df: DataFrame,
    queries: DataFrame | None = None,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = 5,
    every: int = 50,
    scale: int = SCALE,
    shard_rows: int = SHARD_ROWS,
    block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """Each query's ``k`` best rows: ``query_id``, ``rank`` (from 1), the key, ``score``.

    Queries are the rows whose key is divisible by ``every``, and candidates all rows but the
    query's own; rows that repeat a key are queries and candidates of their own. Or queries are
    ``queries`` (same columns), and candidates all rows with another key than the query's.
    Scores are integer inner products; ties go to the smaller key; fewer than ``k`` candidates
    give fewer rows. A NULL key, a NULL vector and one that holds NULL or a non-finite number
    take no part. Vectors of different lengths are not compared. A scaled component, or a score
    among the best, that 64 bits cannot hold is an error. An empty table gives an empty result.
    """
    base = stored(_clean(df, key, vector, scale), "kd-rows")
    if queries is None:
        asked = base.filter(F.col("id") % every == 0).withColumn("query", F.col("number"))
    else:
        # no query is a row: what it must not meet are rows of its key
        base = base.withColumn("number", F.col("id"))
        asked = _clean(queries, key, vector, scale).withColumn("query", F.col("number"))
        asked = asked.withColumn("number", F.col("id"))
    asked = stored(asked, "kd-queries")
    shards = parts_for(base.count(), shard_rows)
    blocks = parts_for(asked.count(), block_queries)
    trees = stored(_trees(base, shards), "kd-trees")
    held = asked.withColumn("block", F.pmod(F.xxhash64("query", "v"), F.lit(blocks)))
    packed = held.groupBy("dim", "block").applyInPandas(
        _pack, "dim int, block long, queries binary"
    )
    packed = stored(packed, "kd-blocks")

    result = "dim int, block long, query long, query_id long, vec long, score long"

    def visit(pairs: DataFrame) -> DataFrame:
        def look(group: pd.DataFrame) -> pd.DataFrame:
            rows = []
            for r in group.itertuples():
                queries, ids, numbers, vectors = pickle.loads(r.queries)
                kth = pickle.loads(r.kth) if r.kth is not None else {}
                least = np.array([kth.get(i) for i in queries.tolist()], object)
                best = search(pickle.loads(r.tree), numbers, vectors, k, least)
                for query, i, hits in zip(queries.tolist(), ids.tolist(), best, strict=True):
                    for score, v in hits:
                        if not -LONG <= score < LONG:
                            raise OverflowError(f"the score {score} is beyond 64 bits")
                        rows.append((r.dim, r.block, query, i, v, score))
            columns = ["dim", "block", "query", "query_id", "vec", "score"]
            return pd.DataFrame(rows, columns=columns)

        return pairs.groupBy("dim", "shard", "block").applyInPandas(look, result)

    home = F.pmod(F.col("block"), F.lit(shards)).alias("shard")
    none = F.lit(None).cast("binary").alias("kth")
    first = packed.select("dim", "block", "queries", home, none).join(trees, ["dim", "shard"])
    seeds = stored(visit(first), "kd-seeds")
    reached = seeds.groupBy("dim", "block").applyInPandas(
        lambda g: _kth(g, k), "dim int, block long, kth binary"
    )
    others = (
        packed.join(reached, ["dim", "block"], "left")
        .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
        .withColumn("shard", F.col("shard").cast("long"))
        .filter(F.col("shard") != F.pmod(F.col("block"), F.lit(shards)))
        .join(trees, ["dim", "shard"])
    )
    hits = seeds.unionByName(visit(others))
    order = Window.partitionBy("query", "dim").orderBy(F.desc("score"), "vec")
    ranked = hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("vec").alias(key), "score")


def _clean(df: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """``id``, ``number``, ``dim``, ``v``: rows with usable vectors, numbered."""
    usable = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")),
    )

    def whole(x: Column) -> Column:
        scaled = F.floor(x.cast("double") * F.lit(float(scale)))
        error = F.raise_error(F.lit("a scaled component is beyond 64 bits")).cast("long")
        return F.when(F.abs(x.cast("double")) * scale < LONG, scaled.cast("long")).otherwise(error)

    return (
        df.filter(F.col(key).isNotNull() & F.col(vector).isNotNull() & usable)
        .select(F.col(key).cast("long").alias("id"), F.transform(vector, whole).alias("v"))
        .withColumn("number", F.monotonically_increasing_id())
        .withColumn("dim", F.size("v"))
    )


def _trees(base: DataFrame, shards: int) -> DataFrame:
    def one(group: pd.DataFrame) -> pd.DataFrame:
        tree = build(
            group["id"].to_numpy(), _matrix(group["v"]), numbers=group["number"].to_numpy()
        )
        head = group.iloc[0]
        return pd.DataFrame(
            {"dim": [head["dim"]], "shard": [head["shard"]], "tree": [pickle.dumps(tree)]}
        )

    dealt = base.withColumn("shard", F.pmod(F.xxhash64("number", "v"), F.lit(shards)))
    return dealt.groupBy("dim", "shard").applyInPandas(one, "dim int, shard long, tree binary")


def _pack(group: pd.DataFrame) -> pd.DataFrame:
    head = group.iloc[0]
    columns = [group[c].to_numpy() for c in ("query", "id", "number")]
    return pd.DataFrame(
        {
            "dim": [head["dim"]],
            "block": [head["block"]],
            "queries": [pickle.dumps((*columns, _matrix(group["v"])))],
        }
    )


def _kth(group: pd.DataFrame, k: int) -> pd.DataFrame:
    """The kth scores of a block's queries, where the first shard gave ``k`` rows."""
    scores = group.groupby("query")["score"]
    full = scores.min()[scores.size() >= k]
    head = group.iloc[0]
    return pd.DataFrame(
        {
            "dim": [head["dim"]],
            "block": [head["block"]],
            "kth": [pickle.dumps({int(i): int(s) for i, s in full.items()})],
        }
    )
