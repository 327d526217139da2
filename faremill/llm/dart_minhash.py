"""Near-duplicates by DartMinHash over weighted word shingles.

A text is a weighted set: its shingles of five words, each with its count. Darts are thrown at
the plane of (shingle, weight) and rank: the darts in a cell are a Poisson number drawn from
the cell's hash, so the same cell holds the same darts in every text. A text keeps the darts
below its shingles' weights; each dart also names one coordinate of the signature, and a
coordinate keeps its earliest dart. Ranks are looked at in slices, from the first on, until
every coordinate has a dart: about ``k log k`` darts for a text of any size. Two texts agree
in a coordinate with the probability of their weighted Jaccard similarity.

Coordinates are banded; texts with a band in common are candidates, and their similarity is
computed exactly from the shingles. Links are then found in two steps:

1. Each text is compared with one of those that have its largest band, and then, in its other
   bands, with one that is still in another component; it is another one in each band. That
   is linear in the size of a group, and joins most groups to one component.
2. In bands whose texts are still in several components, texts of different components are
   compared with each other, block by block, each pair in the first band it shares. Texts
   that are joined already are not compared, and those of a band's largest component meet only
   the others in the band, so a large group of copies costs little.

Texts with the same words are one text in all of this.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faremill.llm.common import as_row, rows_of, sieve, sifted, stored, whole
from faremill.llm.components import components, joined
from faremill.llm.word_hash import mix, word_hashes

WORDS = 5
SIMILARITY = 0.8
ROWS = 5  # coordinates to a band
BANDS = 26  # at similarity 0.8 a pair is missed with probability (1 - 0.8**5)**26 = 3e-5
BLOCK = 1024  # texts of a band that are compared in one task, with as many others
SLICE = 2.0**-4  # height of the first slice of ranks; each next one doubles what is covered
_UNIT = 2.0**-64

_SEED = {
    name: np.uint64(int.from_bytes(hashlib.blake2b(name.encode(), digest_size=8).digest()))
    for name in ("copy", "slice", "dart", "rank", "weight", "band")
}


def shingles(text: str, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes (sorted) and their counts; a shorter text is one shingle."""
    h = word_hashes(text)
    if not len(h):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    n = max(1, len(h) - words + 1)
    rolled = np.zeros(n, np.uint64)
    for j in range(min(words, len(h))):
        rolled = mix(rolled + h[j : j + n] + np.uint64(j + 1))
    return np.unique(rolled, return_counts=True)


@functools.cache
def _poisson(area: float) -> np.ndarray:
    """Cumulative probabilities of 0, 1, 2, ... darts in a cell."""
    most = int(area + 12 * math.sqrt(area) + 24)
    n = np.arange(most)
    logs = n * math.log(area) - area - np.array([math.lgamma(i + 1) for i in n])
    return np.cumsum(np.exp(logs))


def signature(
    elements: np.ndarray, weights: np.ndarray, k: int = ROWS * BANDS
) -> np.ndarray:
    """The earliest dart of each of ``k`` coordinates, as 64-bit numbers.

    Weights are positive; a fractional one keeps the darts below it in its last cell.
    """
    cells = np.ceil(weights).astype(np.int64)
    element = np.repeat(elements, cells)
    copy = np.arange(len(element)) - np.repeat(np.cumsum(cells) - cells, cells)
    fractional = bool((cells != weights).any())
    room = np.repeat(weights, cells) - copy  # above 1: the whole cell
    cell = mix(element + _SEED["copy"] * copy.astype(np.uint64))
    found, best = np.zeros(k, np.uint64), np.full(k, np.inf)
    wanted = (k * math.log(k) + 2 * k) / float(np.sum(weights))
    low, height, number = 0.0, SLICE, 0
    darts, ranks = [], []
    while True:
        slice_ = mix(cell ^ _slice_seed(number))
        counts = np.searchsorted(_poisson(height), slice_ * _UNIT, "right")
        hit = np.flatnonzero(counts)
        if len(hit):
            counts = counts[hit]
            ends = np.cumsum(counts)
            within = np.arange(1, ends[-1] + 1) - np.repeat(ends - counts, counts)
            dart = mix(np.repeat(slice_[hit], counts) + _SEED["dart"] * within.astype(np.uint64))
            rank = low + height * _UNIT * mix(dart ^ _SEED["rank"])
            if fractional:
                inside = mix(dart ^ _SEED["weight"]) * _UNIT < np.repeat(room[hit], counts)
                dart, rank = dart[inside], rank[inside]
            darts.append(dart)
            ranks.append(rank)
        low += height
        height = low
        number += 1
        if low < wanted or not darts:
            continue
        dart, rank = np.concatenate(darts), np.concatenate(ranks)
        at = (dart % np.uint64(k)).astype(np.int64)
        np.minimum.at(best, at, rank)  # later slices only fill what is still empty
        first = rank == best[at]
        found[at[first]] = dart[first]
        if np.isfinite(best).all():
            return found
        darts, ranks = [], []


@functools.cache
def _slice_seed(number: int) -> np.uint64:
    return mix(np.array([_SEED["slice"]]) + np.uint64(number))[0]


def band_keys(found: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One signed 64-bit key per band of consecutive coordinates."""
    rows = found.reshape(bands, -1)
    key = mix(np.arange(bands, dtype=np.uint64) + _SEED["band"])
    for j in range(rows.shape[1]):
        key = mix(key + rows[:, j])
    return key.view(np.int64)


def similarity(
    a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]
) -> float:
    """Weighted Jaccard similarity of two sets of shingles with counts."""
    total = int(a[1].sum() + b[1].sum())
    if not total:
        return 0.0
    _, at_a, at_b = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    common = int(np.minimum(a[1][at_a], b[1][at_b]).sum())
    return common / (total - common)


# --- Spark ----------------------------------------------------------------------------


def _prints(words: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[bytes, list | None] = (b"", None)
        for batch in batches:
            digests, bands = [], []
            for value in batch.column("text"):
                text = value.as_py()
                h = word_hashes(text)
                content = h.tobytes() if len(h) else b"text" + text.encode("utf-8", "replace")
                digest = hashlib.blake2b(content, digest_size=16).digest()
                if digest != last[0] or last[1] is None:
                    own = shingles(text, words)
                    last = (digest, band_keys(signature(*own)).tolist() if len(h) else [])
                digests.append(digest)
                bands.append(last[1])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(digests, pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                ],
                ["id", "digest", "bands"],
            )

    return prints


def _verified(pairs: DataFrame, texts: DataFrame, least: float, words: int) -> DataFrame:
    """The pairs (``a``, ``b``) whose texts are similar enough."""

    @F.pandas_udf("double")
    def similar(left: pd.Series, right: pd.Series) -> pd.Series:
        known = functools.lru_cache(maxsize=64)(lambda t: shingles(t, words))
        return pd.Series(
            [similarity(known(x), known(y)) for x, y in zip(left, right, strict=True)],
            dtype="float64",
        )

    one = texts.select(F.col("id").alias("a"), F.col("text").alias("_left"))
    two = texts.select(F.col("id").alias("b"), F.col("text").alias("_right"))
    judged = pairs.join(one, "a").join(two, "b")
    judged = judged.withColumn("_s", similar("_left", "_right"))
    return judged.filter(F.col("_s") >= least).select("a", "b")


def _based(df: DataFrame) -> DataFrame:
    """The rows, as one column, with a number of their own, stored: keys may repeat or be NULL."""
    numbered = df.select(as_row(df).alias("row"), F.monotonically_increasing_id().alias("uid"))
    return stored(numbered, "near-rows")


def _representatives(texts: DataFrame, words: int) -> tuple[DataFrame, DataFrame]:
    """(id, rep) of all rows, and (id, bands) of one row of each run of words."""
    prints = stored(
        texts.mapInArrow(_prints(words), "id long, digest binary, bands array<long>"),
        "near-prints",
    )
    firsts = stored(prints.groupBy("digest").agg(F.min("id").alias("rep")), "near-firsts")
    owners = prints.select("digest", "id").join(firsts, "digest").select("id", "rep")
    bands = prints.select("id", "bands").join(
        firsts.select(F.col("rep").alias("id")), "id", "left_semi"
    )
    return stored(owners, "near-owners"), stored(bands, "near-bands")


def _groups(bands: DataFrame) -> DataFrame:
    """Bands of several texts, their number and a lead: the smallest id after an exclusive or
    with the band, which is another one in each band."""
    turned = F.col("id").bitwiseXOR(F.col("band"))
    groups = bands.groupBy("band").agg(
        F.min(turned).alias("_lead"), F.count(F.lit(1)).alias("n")
    )
    lead = F.col("_lead").bitwiseXOR(F.col("band")).alias("lead")
    return groups.filter("n > 1").select("band", lead, "n")


def _crossing(shared: DataFrame, labels: DataFrame, block: int) -> DataFrame:
    """Members of bands that several components share, dealt to pairs of blocks.

    Members outside the largest component of their band (``out`` of ``n``) are dealt to blocks
    of their own, the first ones; each pair of blocks has one of these. So a member of the
    largest component comes ``out / block`` times, another one ``n / block`` times, rounded up.
    """
    large = shared.filter("n > 2").drop("lead")
    members = large.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    members = stored(members, "near-members")
    sizes = members.groupBy("band", "label").agg(F.count(F.lit(1)).alias("size"))
    largest = F.max(F.struct("size", "label"))
    open_ = sizes.groupBy("band").agg(largest.alias("_largest")).select(
        "band", F.col("_largest.label").alias("main"), F.col("_largest.size").alias("size")
    )
    dealt = members.join(open_, "band").filter("size < n").withColumns(
        {
            "outer": F.ceil((F.col("n") - F.col("size")) / block).cast("long"),
            "inner": F.ceil(F.col("size") / block).cast("long"),
            "hash": F.xxhash64("id"),
        }
    )
    inside = F.col("label") == F.col("main")
    own = F.when(inside, F.col("outer") + F.pmod("hash", "inner")).otherwise(
        F.pmod("hash", "outer")
    )
    last = F.col("outer") + F.when(inside, F.lit(0)).otherwise(F.col("inner")) - 1
    other = F.explode(F.sequence(F.lit(0).cast("long"), last))
    return dealt.withColumn("own", own).withColumn("other", other).select(
        "band",
        F.least("own", "other").alias("i"),
        F.greatest("own", "other").alias("j"),
        "own",
        "id",
        "label",
    )


def _compare(group: pd.DataFrame, least: float, words: int) -> list[tuple[int, int]]:
    """Links between texts of different components, each pair in the first band it shares."""
    group = group.sort_values("id", kind="stable")
    ids, labels = group["id"].tolist(), group["label"].tolist()
    keys = np.stack(group["bands"].to_list())
    at = int(np.flatnonzero(keys[0] == group["band"].iloc[0])[0])
    own, first = group["own"].to_numpy(), group["i"].iloc[0]
    same = first == group["j"].iloc[0]
    left = np.flatnonzero(own == first)
    right = left if same else np.flatnonzero(own != first)
    roots = {x: x for x in labels}

    def root(x: int) -> int:
        while roots[x] != x:
            roots[x] = roots[roots[x]]
            x = roots[x]
        return x

    sets = [shingles(t, words) for t in group["text"]]
    totals = np.array([int(s[1].sum()) for s in sets])
    links = []
    for x in left.tolist():
        others = right[right > x] if same else right
        here = np.array([root(labels[y]) != root(labels[x]) for y in others.tolist()], bool)
        others = others[here]
        fits = np.minimum(totals[others], totals[x]) >= least * np.maximum(
            totals[others], totals[x]
        )
        others = others[fits]
        others = others[~(keys[others, :at] == keys[x, :at]).any(axis=1)]
        if not len(others) or not totals[x]:
            continue
        scores = _similarities(sets[x], [sets[y] for y in others])
        for y in others[scores >= least].tolist():
            a, b = root(labels[x]), root(labels[y])
            if a != b:
                roots[b] = a
                links.append((ids[x], ids[y]))
    return links


def _similarities(
    one: tuple[np.ndarray, np.ndarray], others: list[tuple[np.ndarray, np.ndarray]]
) -> np.ndarray:
    """``similarity`` of one set to several sets that are not empty, at once."""
    sizes = np.array([len(o[0]) for o in others])
    hashes = np.concatenate([o[0] for o in others])
    counts = np.concatenate([o[1] for o in others])
    at = np.minimum(np.searchsorted(one[0], hashes), len(one[0]) - 1)
    common = np.where(one[0][at] == hashes, np.minimum(one[1][at], counts), 0)
    starts = np.cumsum(sizes) - sizes
    shared = np.add.reduceat(common, starts)
    return shared / (one[1].sum() + np.add.reduceat(counts, starts) - shared)


def _judged(pairs: DataFrame, texts: DataFrame, least: float, words: int, name: str) -> DataFrame:
    """Links among pairs (``id``, ``lead``), stored."""
    ordered = pairs.select(F.least("id", "lead").alias("a"), F.greatest("id", "lead").alias("b"))
    return stored(_verified(ordered.distinct(), texts, least, words), name)


def _labels(
    texts: DataFrame, bands_of: DataFrame, least: float, words: int, block: int
) -> DataFrame:
    """``id`` and ``label`` of the representatives that are linked to another one.

    Links are found in three rounds, and after each the components found so far count as one:
    each text with the lead of its largest band, then with the leads of its other bands that
    have another label, then the members of bands that several components share. So a round
    has about one pair a text, and what joins components is a link of labels, not of texts.
    """
    bands = bands_of.select("id", F.explode("bands").alias("band"))
    # most bands hold one text; what follows reads the others only
    shared = stored(bands.join(_groups(bands), "band"), "near-shared")
    ends = stored(shared.select("id").distinct(), "near-ends")
    texts = rows_of(texts, "id", ends, "near-texts")

    first = shared.groupBy("id").agg(F.max_by("lead", F.struct("n", "band")).alias("lead"))
    pairs = first.filter("id <> lead")
    labels = components(_judged(pairs, texts, least, words, "near-first"))

    named = shared.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    named = stored(named, "near-named")
    leads = named.filter("id = lead").select("band", F.col("label").alias("lead_label"))
    apart = named.join(leads, "band").filter("label <> lead_label").select("id", "lead")
    labels = joined(labels, _judged(apart, texts, least, words, "near-second"))

    dealt = _crossing(shared, labels, block)
    rows = dealt.join(texts, "id").join(bands_of, "id")

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(_compare(group, least, words), columns=["a", "b"], dtype="int64")

    more = rows.groupBy("band", "i", "j").applyInPandas(compare, "a long, b long")
    return joined(labels, stored(more, "near-more"))


def _classes(
    base: DataFrame, key: str, text: str, least: float, words: int, block: int
) -> DataFrame:
    """Per row of a based frame: ``id``, ``class_id``, ``class_size``, ``kept``."""
    texts = base.select(F.col("uid").alias("id"), whole(f"row.`{text}`").alias("text"))
    owners, bands = _representatives(texts, words)
    labels = _labels(texts, bands, least, words, block)
    rows = base.select(F.col("uid").alias("id"), F.col(f"row.`{key}`").alias("key"))
    rows = rows.join(owners, "id")
    rows = rows.join(labels.withColumnRenamed("id", "rep"), "rep", "left").select(
        "id", "key", F.coalesce("label", "rep").alias("label")
    )
    rows = stored(rows, "near-classes")
    first = F.min(F.struct(F.col("key").isNull().alias("none"), "key", "id"))
    found = rows.groupBy("label").agg(
        first.alias("first"), F.count(F.lit(1)).alias("class_size")
    )
    return rows.join(found, "label").select(
        "id",
        "key",
        F.col("first.key").alias("class_id"),
        "class_size",
        (F.col("id") == F.col("first.id")).alias("kept"),
    )


def near_duplicates(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    least: float = SIMILARITY,
    words: int = WORDS,
    block: int = BLOCK,
) -> DataFrame:
    """One row per input row: the key, ``class_id``, ``class_size``, ``kept``.

    Texts are linked if the weighted Jaccard similarity of their shingles is at least
    ``least``, or if they have the same words; a class is what links connect. Its id is the
    smallest key in it, and the row with that key is kept (one of them, if keys repeat).
    Words are runs of letters, marks and digits in lower case, single letters in scripts without
    spaces (see ``word_hash``); a text of fewer than ``words`` words is one shingle. Texts without words, NULL as the empty one, are linked only if equal.
    NULL keys come last; an empty table gives an empty result. Keys are integers.
    """
    base = _based(df.select(F.col(key).alias("key"), F.col(text).alias("text")))
    found = _classes(base, "key", "text", least, words, block)
    return found.select(F.col("key").alias(key), "class_id", "class_size", "kept")


def drop_near_duplicates(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    least: float = SIMILARITY,
    words: int = WORDS,
    block: int = BLOCK,
) -> DataFrame:
    """The kept row of each class, with all columns of ``df``; most rows stay where they are."""
    base = _based(df)
    gone = _classes(base, key, text, least, words, block).filter(~F.col("kept"))
    gone = stored(gone.select(F.col("id").alias("uid")), "near-gone")
    marked = sifted(base, "uid", sieve(gone, "uid"), "concerned")
    untouched = marked.filter(~F.col("concerned")).select("row")
    some = marked.filter("concerned").join(gone, "uid", "left_anti").select("row")
    return untouched.unionByName(some).select("row.*")
