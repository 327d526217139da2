"""Best-fit packing of token sequences by linear grouping.

Sequences hold ``size`` tokens at most. Only how many pieces there are of each length matters
for the plan, at most ``size`` numbers, whatever the corpus: so the plan is made once from the
histogram, and pieces are numbered and placed where they are.

The plan:

1. Lengths above ``small`` are large. Sorted, they fall into groups of equal cardinality, and
   each is rounded up to the longest of its group: few sizes.
2. For these sizes the best mix of configurations (which sizes fill a sequence) is found by
   linear programming with generated columns; whole multiples are taken.
3. Actual documents take the places of their group, longest first, so each sequence gets back
   what rounding had added to it. Its last places, the shortest, are left open, so that they can
   take what fits best.
4. What is left over and the small ones go, longest first, where they leave the least room
   (best fit), into a new sequence if none has room. Once, the emptiest tenth of the configured
   sequences is taken apart, and its documents are placed again in this way.

Steps 3 and 4 are done with up to three places open, and the plan with the fewest sequences
counts. It comes from the configurations in any case, also where best fit alone would need a few
sequences less.

Equal sequences are never listed one by one: a run is a composition (its lengths) and how
often it occurs. A piece finds its sequence by its rank among the pieces of its length.
"""

from __future__ import annotations

import bisect
import struct
import zlib
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faremill.llm import byte_bpe
from faremill.llm.common import stored, whole

TOKENIZER = "byte_bpe_50k.json"
SIZE = 1024
END_ID = 2
GROUPS = 128  # sizes after rounding
SMALL = 64  # lengths up to this are small
OPEN = (0, 1, 2, 3)  # last places of a configuration that are left to the best fit
AGAIN = 0.1  # share of the configured sequences, the emptiest, that are placed once more
GAP = 0.002  # the linear program ends within this share of its optimum


# --- the plan -------------------------------------------------------------------------


@dataclass
class Runs:
    """Sequences as compositions (tuples of lengths, in their order) with multiplicities.

    ``configured`` of them hold the documents that their configuration's places were filled with.
    """

    runs: list[tuple[tuple[int, ...], int]]
    configured: int = 0

    def sequences(self) -> int:
        return sum(n for _, n in self.runs)


def group_sizes(counts: dict[int, int], groups: int) -> list[tuple[int, list[int]]]:
    """(rounded size, its lengths), longest first; groups of about equal cardinality.

    A length is not divided between groups: one that many pieces share is a group of its own.
    """
    share = sum(counts.values()) / max(1, groups)
    found: list[tuple[int, list[int]]] = []
    held = 0
    for length in sorted(counts, reverse=True):
        if not found or held + counts[length] / 2 > share:
            found.append((length, []))
            held = 0
        found[-1][1].append(length)
        held += counts[length]
    return found


def best_pattern(values: np.ndarray, sizes: np.ndarray, size: int) -> tuple[float, list[int]]:
    """The most valuable configuration: unbounded knapsack over the sizes."""
    best = np.zeros(size + 1)
    taken = np.full(size + 1, -1)
    for i, (step, value) in enumerate(zip(sizes.tolist(), values.tolist(), strict=True)):
        for at in range(step, size + 1, step):  # a block only looks at the block before it
            end = min(at + step, size + 1)
            with_it = best[at - step : end - step] + value
            better = with_it > best[at:end] + 1e-12
            best[at:end][better] = with_it[better]
            taken[at:end][better] = i
    chosen, room = [], size
    while room > 0:
        if taken[room] < 0:
            break
        chosen.append(int(taken[room]))
        room -= int(sizes[taken[room]])
    return float(best[size]), chosen


def configurations(
    sizes: list[int], demand: list[int], size: int = SIZE, gap: float = GAP
) -> list[tuple[dict[int, int], float]]:
    """Configurations (places by size index) and how often each is used, as fractions.

    Minimises the number of sequences by the simplex method; each step prices a new
    configuration by a knapsack and ends when the dual bound is within ``gap``.
    """
    n = len(sizes)
    if not n:
        return []
    s, d = np.array(sizes), np.array(demand, float)
    columns = [{i: size // sizes[i]} for i in range(n)]
    inverse = np.diag([1.0 / (size // x) for x in sizes])
    used = inverse @ d
    for _ in range(50 * n):
        prices = inverse.sum(axis=0)  # every sequence costs one
        value, chosen = best_pattern(np.maximum(prices, 0), s, size)
        if value <= 1 + 1e-9 or used.sum() - prices @ d / value <= gap * used.sum():
            break
        column = Counter(chosen)
        entry = np.zeros(n)
        for i, k in column.items():
            entry[i] = k
        step = inverse @ entry
        rising = np.flatnonzero(step > 1e-9)
        leaving = int(rising[np.argmin(used[rising] / step[rising])])
        amount = used[leaving] / step[leaving]
        used = np.maximum(used - amount * step, 0)
        used[leaving] = amount
        row = inverse[leaving] / step[leaving]
        inverse -= np.outer(step, row)
        inverse[leaving] = row
        columns[leaving] = dict(column)
    return [(c, float(x)) for c, x in zip(columns, used, strict=True) if x > 0]


class Stock:
    """Pieces by length, taken in runs."""

    def __init__(self, counts: dict[int, int]) -> None:
        self.counts = {k: v for k, v in counts.items() if v}

    def take(self, lengths: list[int], wanted: int) -> Iterator[tuple[int, int]]:
        """(length, how many) from ``lengths`` in order until ``wanted`` are taken."""
        for length in lengths:
            n = min(wanted, self.counts.get(length, 0))
            if n:
                self.counts[length] -= n
                wanted -= n
                yield length, n


def substitute(
    chosen: list[tuple[dict[int, int], int]], groups: list[tuple[int, list[int]]], stock: Stock
) -> Runs:
    """Actual lengths in the places of the configurations; a run ends where a length does."""
    out = []
    for places, times in chosen:
        slots: list[list[tuple[int, int]]] = []
        for g in sorted(places):
            for _ in range(places[g]):
                slots.append(list(stock.take(groups[g][1], times)))
        cuts = sorted({0, times, *(c for slot in slots for c in _ends(slot))})
        for a, b in zip(cuts, cuts[1:]):
            lengths = [x for x in (_at(slot, a) for slot in slots) if x]
            if lengths:
                out.append((tuple(lengths), b - a))
    return Runs(out)


def _ends(slot: list[tuple[int, int]]) -> Iterator[int]:
    at = 0
    for _, n in slot:
        at += n
        yield at


def _at(slot: list[tuple[int, int]], position: int) -> int:
    for length, n in slot:
        if position < n:
            return length
        position -= n
    return 0


def best_fit(runs: Runs, counts: dict[int, int], size: int = SIZE) -> Runs:
    """Place the remaining pieces, longest first, each where it leaves the least room.

    Sequences are kept by free room; as many equal pieces as there are equal sequences move
    at once, so the work follows the number of lengths and not of pieces.
    """
    free: dict[int, dict[tuple[int, ...], int]] = defaultdict(dict)
    rooms: list[int] = []

    def put(room: int, composition: tuple[int, ...], n: int) -> None:
        if room not in free:
            bisect.insort(rooms, room)
        free[room][composition] = free[room].get(composition, 0) + n

    for composition, n in runs.runs:
        put(size - sum(composition), composition, n)
    for length in sorted((x for x in counts if counts[x]), reverse=True):
        left = counts[length]
        while left:
            at = bisect.bisect_left(rooms, length)
            if at == len(rooms):
                each = min(size // length, left)
                put(size - each * length, (length,) * each, left // each)
                left -= each * (left // each)
                continue
            room = rooms[at]
            composition, n = free[room].popitem()
            if not free[room]:
                del free[room]
                rooms.pop(at)
            moved = min(n, left)
            if n > moved:
                put(room, composition, n - moved)
            put(room - length, (*composition, length), moved)
            left -= moved
    return Runs([(c, n) for by in free.values() for c, n in by.items()])


# a length of nothing at its beginning marks a configured sequence while a plan is made
MARK = 0


def _opened(places: dict[int, int], last: int) -> dict[int, int]:
    """A configuration without its ``last`` shortest places; one place stays."""
    left = dict(places)
    for _ in range(min(last, sum(places.values()) - 1)):
        shortest = max(left)  # groups are numbered from the longest
        left[shortest] -= 1
        if not left[shortest]:
            del left[shortest]
    return left


def _emptiest(packed: Runs, share: float, size: int) -> tuple[Runs, dict[int, int]]:
    """The plan without that share of its configured sequences, and their pieces."""
    marked = [r for r in packed.runs if r[0][0] == MARK]
    wanted = int(share * sum(n for _, n in marked))
    kept = [r for r in packed.runs if r[0][0] != MARK]
    left: Counter = Counter()
    for composition, n in sorted(marked, key=lambda r: (sum(r[0]), r[0])):
        taken = min(n, wanted) if sum(composition) < size else 0
        wanted -= taken
        for length in composition[1:]:
            left[length] += taken
        if n > taken:
            kept.append((composition, n - taken))
    return Runs(kept), dict(left)


def plan(
    counts: dict[int, int],
    size: int = SIZE,
    groups: int = GROUPS,
    small: int = SMALL,
    again: float = AGAIN,
) -> Runs:
    """Sequences for ``counts`` pieces by length (1 to ``size``)."""
    large = {k: v for k, v in counts.items() if small < k < size}
    sizes = group_sizes(large, groups)
    demand = [sum(large[x] for x in members) for _, members in sizes]
    mix = configurations([s for s, _ in sizes], demand, size)
    # small parts of multiples are left to the best fit
    chosen = [(places, int(times + 1e-6)) for places, times in mix if times + 1e-6 >= 1]
    found = []
    for last in OPEN:
        stock = Stock({k: v for k, v in counts.items() if k < size})
        filled = substitute([(_opened(p, last), n) for p, n in chosen], sizes, stock)
        marked = Runs([((MARK, *composition), n) for composition, n in filled.runs])
        packed = best_fit(marked, stock.counts, size)
        found.append(packed)
        if again:
            found.append(best_fit(*_emptiest(packed, again, size), size))
    best = min(found, key=Runs.sequences)
    configured = sum(n for composition, n in best.runs if composition[0] == MARK)
    plain = [(c[1:] if c[0] == MARK else c, n) for c, n in best.runs]
    if counts.get(size):
        plain.append(((size,), counts[size]))
    return Runs(plain, configured)


@dataclass
class Places:
    """The plan by length: ranks from ``first`` on lie in sequences from ``base`` on."""

    first: np.ndarray
    base: np.ndarray
    each: np.ndarray
    offsets: list[np.ndarray]


def places(packed: Runs) -> dict[int, Places]:
    ranks: Counter = Counter()
    rows: dict[int, list[tuple[int, int, int, list[int]]]] = defaultdict(list)
    base = 0
    for composition, n in packed.runs:
        offsets: dict[int, list[int]] = defaultdict(list)
        at = 0
        for length in composition:
            offsets[length].append(at)
            at += length
        for length, where in offsets.items():
            rows[length].append((ranks[length], base, len(where), where))
            ranks[length] += n * len(where)
        base += n
    return {
        length: Places(
            *(np.array([r[i] for r in found]) for i in range(3)),
            [np.array(r[3]) for r in found],
        )
        for length, found in rows.items()
    }


def locate(at: Places, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of the pieces with these ranks among those of their length."""
    row = np.searchsorted(at.first, ranks, "right") - 1
    within = ranks - at.first[row]
    each = at.each[row]
    starts = np.concatenate([[0], np.cumsum([len(o) for o in at.offsets])])[:-1]
    flat = np.concatenate(at.offsets)
    return at.base[row] + within // each, flat[starts[row] + within % each]


# --- pieces ---------------------------------------------------------------------------

PIECE = "piece int, start long, length long, ids_crc32 long, part int, rank long"


def cut(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; the first takes what does not fill a piece."""
    head = n % size or size
    return [(0, head), *((at, size) for at in range(head, n, size))]


def cut_documents(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    tokenizer: str = TOKENIZER,
    size: int = SIZE,
    end_id: int = END_ID,
    keep_ids: bool = False,
) -> DataFrame:
    """Encoded pieces, numbered by length within their task (``part``, ``rank``).

    The result must be stored before it is used twice: only then are the numbers fixed.
    """
    key_type = df.schema[key].dataType.simpleString()
    names = ["key", "piece", "start", "length", "ids_crc32", "part", "rank"]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe.coder(public_tokenizers.path(tokenizer))
        end = struct.pack("<I", end_id)
        part = TaskContext.get().partitionId()
        ranks: Counter = Counter()
        for batch in batches:
            rows = []
            owners = []
            for i, encoded in enumerate(bpe.encode_batch(batch.column(1).to_pylist())):
                ids = encoded + end
                for number, (start, length) in enumerate(cut(len(ids) // 4, size)):
                    own = ids[4 * start : 4 * (start + length)]
                    row = (number, start, length, zlib.crc32(own), part, ranks[length])
                    rows.append((*row, own) if keep_ids else row)
                    owners.append(i)
                    ranks[length] += 1
            if not rows:
                continue
            types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            types += [pa.binary()] * keep_ids
            arrays = [
                pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(owners)), *arrays], names + ["ids"] * keep_ids
            )

    rows = df.select(F.col(key).alias("key"), whole(text).alias("text"))
    schema = f"key {key_type}, {PIECE}" + ", ids binary" * keep_ids
    return rows.mapInArrow(pieces, schema)


def place(pieces: DataFrame, size: int = SIZE, groups: int = GROUPS) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to stored pieces.

    Ranks among all pieces of a length are a piece's rank in its task and the counts of the
    tasks before, a small table; no group of equal lengths ever meets in one task. What the
    driver gets and sends is bounded by ``size``: the histogram and the plan.
    """
    counted = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    counted = stored(counted, "packing-counts")
    histogram = counted.groupBy("length").agg(F.sum("n").alias("n")).collect()
    found = places(plan({r["length"]: r["n"] for r in histogram}, size, groups))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    bases = counted.select(
        "part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")
    )
    ranked = pieces.join(bases, ["part", "length"])
    ranked = ranked.withColumn("rank", F.col("rank") + F.col("base")).drop("base", "part")

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("length").to_numpy()
            ranks = batch.column("rank").to_numpy()
            sequence, offset = np.empty(len(ranks), np.int64), np.empty(len(ranks), np.int64)
            for length in np.unique(lengths):
                at = lengths == length
                sequence[at], offset[at] = locate(found[int(length)], ranks[at])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(sequence), pa.array(offset)],
                [*batch.schema.names, "sequence_id", "offset"],
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema)
    return ranked.mapInArrow(put, f"{fields}, sequence_id long, offset long").drop("rank")


def pack_documents(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    tokenizer: str = TOKENIZER,
    size: int = SIZE,
    end_id: int = END_ID,
    groups: int = GROUPS,
    keep_ids: bool = False,
) -> DataFrame:
    """One row per piece: the key, ``piece``, ``start``, ``length``, ``ids_crc32``,
    ``sequence_id``, ``offset``, and on request ``ids`` (little-endian unsigned 32 bit).

    Every document is its ids and ``end_id``; one longer than ``size`` is cut, its first piece
    may be shorter. A NULL text is empty: the end id alone. A NULL key stays NULL, rows that
    repeat a key are packed one by one, an empty table gives an empty result. Sequence numbers
    count from 0 without gaps.
    """
    pieces = cut_documents(df, key, text, tokenizer, size, end_id, keep_ids)
    packed = place(stored(pieces, "packing-pieces"), size, groups)
    columns = ["piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    columns += ["ids"] * keep_ids
    return packed.select(F.col("key").alias(key), *columns)


def sequences(packed: DataFrame) -> DataFrame:
    """Rows of ``sequence_id`` and ``ids`` (binary) from pieces packed with ``keep_ids``.

    A group holds the pieces of one sequence, ``size`` tokens at most.
    """
    placed = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(placed, F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"))
