"""N-best segmentation into SentencePiece pieces, and decoding.

A segmentation's score is the sum of its pieces' scores. The lattice of a text falls apart
where no piece of the vocabulary can cross: between two classes of characters that never
stand beside each other inside a piece (a word and what follows it). Each distinct part is
solved once while it is remembered:

* forward, Viterbi gives for every place the best score from the start to it;
* backward, A-star grows segmentations from the end. The forward score is what the rest will
  cost at best, exactly; so complete segmentations leave the queue in the order of their
  scores, and the search ends after the nth.

Parts are looked at many at once. Scores from both ends show what the best segmentation
without a certain piece loses; where that is too much for the texts, the best one is enough
and no queue is needed.

A text's n best follow from those of its parts: at most n - 1 parts deviate from their best,
and only the n - 1 deviations that lose least can take part. So once frequent parts are known,
the losses they offer a text bound what is worth finding in its other parts.

Equal scores are ordered by the ids read from the end, smaller ids first. This is the unigram
reading of a vocabulary, also where the file's own encoder merges pairs.
"""

from __future__ import annotations

import functools
import heapq
import math
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faremill.llm.common import whole
from faremill.llm.word_hash import Spans

MODEL = "piece_bpe_32k.model"
NBEST = 4
MEMO = 1_000_000  # parts that a worker remembers
FREQUENT = 4000  # parts of a batch that are searched without a limit
BATCH_CHARS = 1 << 20
LONGEST = 256  # parts up to this get their forward scores together, longer ones one by one
UNKNOWN_LOSS = 10.0  # an unknown character scores so much less than the worst piece
SPACE = "▁"
BETWEEN = 0x110000  # no character; ends a text of a batch


class Solved:
    """The n best segmentations of many parts, as arrays by the part's number.

    A number's row holds the best score, what the others lose (infinite where there are
    fewer), where the ids of each stand, and how each ranks by its ids read from the end.
    ``limit`` is the loss up to which a part was searched.
    """

    def __init__(self, nbest: int) -> None:
        self.nbest = nbest
        self.number: dict[str, int] = {}
        self.flat = array("I")
        self.best, self.limit = np.empty(0), np.empty(0)
        self.loss = np.empty((0, nbest))
        self.start = np.empty((0, nbest), np.int64)
        self.size = np.empty((0, nbest), np.int32)
        self.rank = np.empty((0, nbest), np.int16)

    def add(self, found: list[tuple[float, tuple[int, ...]]], limit: float) -> tuple:
        """A row; ids come reversed."""
        n, best = self.nbest, found[0][0]
        loss, start, size = [math.inf] * n, [0] * n, [0] * n
        rank = [0] * n
        flat = self.flat
        for k, (score, ids) in enumerate(found):
            loss[k], start[k], size[k] = best - score, len(flat), len(ids)
            flat.extend(ids[::-1])
        if len(found) > 1:
            for r, k in enumerate(sorted(range(len(found)), key=lambda k: found[k][1])):
                rank[k] = r
        return best, math.inf if len(found) == n else limit, loss, start, size, rank

    def put(self, parts: list[str], rows: list[tuple]) -> None:
        """Append rows of new parts, and replace those of known ones."""
        if parts:
            self._put(parts, *(np.array(c) for c in zip(*rows, strict=True)))

    def put_best(
        self, parts: list[str], best: np.ndarray, limit: np.ndarray, ids: np.ndarray, size: np.ndarray
    ) -> None:
        """Parts of which only the best segmentation is within the limit; ``ids`` of one part
        after the other."""
        many = np.zeros((len(parts), self.nbest), np.int64)
        loss = np.full(many.shape, np.inf)
        loss[:, 0] = 0
        start, sizes = many.copy(), many.copy()
        start[:, 0] = len(self.flat) + np.cumsum(size) - size
        sizes[:, 0] = size
        self.flat.frombytes(ids.astype("<u4").tobytes())
        self._put(parts, best, limit, loss, start, sizes, many)

    def _put(self, parts: list[str], *columns: np.ndarray) -> None:
        number = self.number
        at = np.array([number.setdefault(p, len(number)) for p in parts], np.int64)
        names = ("best", "limit", "loss", "start", "size", "rank")
        for name, new in zip(names, columns, strict=True):
            old = getattr(self, name)
            if len(number) > len(old):
                more = np.empty((len(number) + len(number) // 2, *old.shape[1:]), old.dtype)
                more[: len(old)] = old
                old = more
                setattr(self, name, old)
            old[at] = new


class Pieces:
    def __init__(self, path: str, nbest: int = NBEST, memo: int = MEMO) -> None:
        self.processor = p = sentencepiece.SentencePieceProcessor(model_file=path)
        self.nbest, self.most = nbest, memo
        self.solved = Solved(nbest)
        special = [
            p.is_unknown(i) or p.is_control(i) or p.is_byte(i) or p.is_unused(i)
            for i in range(p.get_piece_size())
        ]
        self.vocabulary = {
            p.id_to_piece(i): (i, p.get_score(i)) for i, s in enumerate(special) if not s
        }
        self.longest = max(map(len, self.vocabulary), default=1)
        # beginnings of pieces, with the piece where it is one
        self.begun: dict[str, tuple[int, float] | None] = {}
        for piece, known in self.vocabulary.items():
            for k in range(1, len(piece)):
                self.begun.setdefault(piece[:k], None)
            self.begun[piece] = known
        self.ended = {p[k:] for p in self.vocabulary for k in range(len(p))}
        ends = np.cumsum([len(b) for b in self.begun])
        points = np.frombuffer("".join(self.begun).encode("utf-32-le"), "<u4")
        hashes = Spans(points).hashes(np.concatenate([[0], ends[:-1]]), ends)
        order = np.argsort(hashes)
        self.index = hashes[order]
        scores = [math.nan if known is None else known[1] for known in self.begun.values()]
        self.index_scores = np.array(scores)[order]
        ids = [0 if known is None else known[0] for known in self.begun.values()]
        self.index_ids = np.array(ids)[order]
        self.unknown = min((s for _, s in self.vocabulary.values()), default=0.0) - UNKNOWN_LOSS
        self.bytes = {
            int(p.id_to_piece(i)[1:-1], 16): i
            for i in range(len(special))
            if p.is_byte(i)
        }
        self._surfaces(special)
        self.crossed = np.zeros((5, 5), bool)
        for piece in self.vocabulary:
            kinds = classes()[[ord(c) for c in piece]]
            self.crossed[kinds[:-1], kinds[1:]] = True

    def _surfaces(self, special: list[bool]) -> None:
        """What each id decodes to, in UTF-8, and where it stands in one long string."""
        p = self.processor
        parts = []
        for i, s in enumerate(special):
            if p.is_byte(i):
                parts.append(bytes([int(p.id_to_piece(i)[1:-1], 16)]))
            elif s:
                parts.append(b"" if p.is_control(i) else " ⁇ ".encode())
            else:
                parts.append(p.id_to_piece(i).replace(SPACE, " ").encode())
        self.sizes = np.array([len(x) for x in parts])
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.surface = np.frombuffer(b"".join(parts), np.uint8)

    # --- one part -----------------------------------------------------------------------

    def solve(
        self, part: str, best: list[float], limit: float = math.inf
    ) -> list[tuple[float, tuple[int, ...]]]:
        """(score, ids reversed) of the n best segmentations that lose ``limit`` at most, best
        first. ``best`` are the forward scores."""
        found = self._backward(part, best, limit)
        if any(ids and min(ids) < 0 for _, ids in found):
            return [(score, self._expanded(part, ids[::-1])[::-1]) for score, ids in found]
        return found

    def solve_all(
        self, spans: Spans, parts: list[str], starts: np.ndarray, limits: np.ndarray
    ) -> None:
        """Solve parts that stand at ``starts``, each up to its limit, and keep the results."""
        lengths = np.array([len(p) for p in parts], np.int64)
        solved = self.solved
        order = np.argsort(-lengths, kind="stable")
        magnitude = np.ceil(np.log2(np.maximum(lengths[order], 1))).astype(int)
        magnitude[lengths[order] > LONGEST] = 99
        for size in np.unique(magnitude):
            group = order[magnitude == size]
            if size == 99:
                rest = group.tolist()
                best = (self._forward(parts[k]) for k in rest)
            else:
                places = Places(self, spans, starts[group], lengths[group])
                alone, ids, sizes = places.alone(limits[group])
                some = group[alone]
                total = places.total[alone]
                solved.put_best([parts[k] for k in some], total, limits[some], ids, sizes)
                rest = group[~alone].tolist()
                best = places.best[~alone].tolist()
            rows = [
                solved.add(self.solve(parts[k], row, limits[k]), limits[k])
                for k, row in zip(rest, best, strict=True)
            ]
            solved.put([parts[k] for k in rest], rows)

    def _into(self, part: str, at: int) -> list[tuple[int, int, float]]:
        """The pieces that end at a place: (start, id, score). An unknown character gets an id
        of its own kind."""
        edges = []
        find, ended = self.vocabulary.get, self.ended
        for i in range(at - 1, max(-1, at - self.longest - 1), -1):
            text = part[i:at]
            if text not in ended:
                break
            known = find(text)
            if known:
                edges.append((i, *known))
        if not edges or edges[0][0] != at - 1:
            edges.append((at - 1, -at, self.unknown))
        return edges

    def _forward(self, part: str) -> list[float]:
        """Viterbi: the best score from the start to every place."""
        best = [0.0]
        for at in range(1, len(part) + 1):
            best.append(max(best[i] + score for i, _, score in self._into(part, at)))
        return best

    def _backward(
        self, part: str, best: list[float], limit: float
    ) -> list[tuple[float, tuple[int, ...]]]:
        """A-star from the end. Since the forward score is exact, every open segmentation has a
        completion of its value; so no more need to be open than are still wanted.

        Open segmentations are kept in the order of their ids, which the children of one take
        over in its place: so the first of equal values is the one with the smaller ids, and
        ids are links to a parent, however long the part is.
        """
        n = len(part)
        open_: list[tuple[float, int, float, tuple | None]] = [(-best[n], n, 0.0, None)]
        found = []
        wanted = self.nbest
        most = limit - best[n]
        while open_ and wanted:
            first = min(range(len(open_)), key=lambda k: open_[k][0])
            value, at, behind, link = open_[first]
            if not at:
                ids = []
                while link:
                    ids.append(link[0])
                    link = link[1]
                found.append((-value, tuple(ids[::-1])))
                wanted -= 1
                del open_[first]
                continue
            children = []
            for i, id_, score in self._into(part, at):
                value = -(best[i] + score + behind)
                if value <= most:
                    children.append((id_, (value, i, behind + score, (id_, link))))
            children.sort(key=lambda c: c[0])
            open_[first : first + 1] = [c[1] for c in children]
            while len(open_) > wanted:
                # of equal values the one with the largest ids goes
                del open_[max(range(len(open_)), key=lambda k: (open_[k][0], k))]
        return found

    def _expanded(self, part: str, ids: tuple[int, ...]) -> tuple[int, ...]:
        """Unknown characters as their bytes, or as one unknown id for a run of them."""
        if all(i >= 0 for i in ids):
            return ids
        out: list[int] = []
        unknown = self.processor.unk_id()
        for k, i in enumerate(ids):
            if i >= 0:
                out.append(i)
            elif self.bytes:
                out += [self.bytes[b] for b in part[-1 - i].encode("utf-8", "replace")]
            elif not (k and ids[k - 1] < 0):
                out.append(unknown)
        return tuple(out)

    def numbers(
        self,
        parts: list[str],
        which: np.ndarray,
        bounds: np.ndarray,
        spans: Spans,
        starts: np.ndarray,
    ) -> np.ndarray:
        """The parts' numbers, solved as far as the texts that they stand in need them."""
        if len(self.solved.number) + len(parts) > self.most:
            self.solved = Solved(self.nbest)
        solved = self.solved
        frequent = np.argsort(-np.bincount(which, minlength=len(parts)))[:FREQUENT]
        new = [k for k in frequent.tolist() if parts[k] not in solved.number]
        self.solve_all(spans, [parts[k] for k in new], starts[new], np.full(len(new), np.inf))
        at = np.array([solved.number.get(p, -1) for p in parts], np.int64)
        need = np.zeros(len(parts))
        for a, b in zip(bounds.tolist(), bounds[1:].tolist()):
            own = which[a:b]
            known = at[own]
            losses = solved.loss[known[known >= 0], 1:].ravel()
            n = self.nbest - 2
            most = np.partition(losses, n)[n] if 0 <= n < len(losses) else math.inf
            need[own] = np.maximum(need[own], most)
        searched = np.where(at >= 0, solved.limit[np.maximum(at, 0)], -1.0)
        open_ = np.flatnonzero(searched < need)
        self.solve_all(spans, [parts[k] for k in open_.tolist()], starts[open_], need[open_])
        return np.array([solved.number[p] for p in parts], np.int64)

    # --- texts --------------------------------------------------------------------------

    def encode(self, texts: list[str]) -> Iterator[list[tuple[float, bytes]]]:
        """For each text its n best (score, ids as little-endian unsigned 32 bit)."""
        held: list[str] = []
        size = 0
        for text in texts:
            held.append(self.processor.normalize(text))
            size += len(text)
            if size > BATCH_CHARS:
                yield from self._batch(held)
                held, size = [], 0
        if held:
            yield from self._batch(held)

    def _batch(self, texts: list[str]) -> Iterator[list[tuple[float, bytes]]]:
        joined = "\0".join(texts) + "\0"
        points = np.frombuffer(joined.encode("utf-32-le"), "<u4").copy()
        points[np.cumsum([len(t) + 1 for t in texts]) - 1] = BETWEEN
        kinds = classes()[points]
        starts = np.flatnonzero(
            np.concatenate([[True], ~self.crossed[kinds[:-1], kinds[1:]]])
        )
        ends = np.append(starts[1:], len(points))
        real = points[starts] != BETWEEN
        bounds = np.concatenate([[0], np.cumsum(real)[~real]])
        starts, ends = starts[real], ends[real]
        spans = Spans(points)
        _, first, which = np.unique(
            spans.hashes(starts, ends), return_index=True, return_inverse=True
        )
        starts, ends = starts[first], ends[first]
        words = [joined[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        which = self.numbers(words, which, bounds, spans, starts)[which]
        solved = self.solved
        size = solved.size[which, 0]
        ends = np.cumsum(size)
        first = solved.start[which, 0] - (ends - size)
        flat = np.frombuffer(solved.flat, "<u4")
        best = flat[np.repeat(first, size) + np.arange(ends[-1] if len(ends) else 0)].tobytes()
        places = np.concatenate([[0], ends])
        scores = np.concatenate([[0], np.cumsum(solved.best[which])])
        for a, b in zip(bounds.tolist(), bounds[1:].tolist()):
            score = float(scores[b] - scores[a])
            found = []
            for loss, _, chosen in self._deviations(which[a:b]):
                pieces, done = [], int(places[a])
                for place, m in sorted(chosen):
                    at = which[a + place]
                    start, size_ = int(solved.start[at, m]), int(solved.size[at, m])
                    pieces.append(best[4 * done : 4 * int(places[a + place])])
                    pieces.append(flat[start : start + size_].tobytes())
                    done = int(places[a + place + 1])
                pieces.append(best[4 * done : 4 * int(places[b])])
                found.append((score - loss, b"".join(pieces)))
            yield found

    def _deviations(
        self, which: np.ndarray
    ) -> list[tuple[float, tuple[int, ...], tuple[tuple[int, int], ...]]]:
        """The n best choices: (loss, order, ((place, number of the segmentation), ...))."""
        n, solved = self.nbest, self.solved
        flat = solved.loss[which, 1:].ravel()
        most = np.partition(flat, n - 2)[n - 2] if len(flat) >= n - 1 > 0 else np.inf
        near = np.flatnonzero((flat <= most) & np.isfinite(flat))
        if not len(near):
            return [(0.0, (), ())]
        place, number = near // (n - 1), near % (n - 1) + 1
        ranks = solved.rank[which[place]]
        sign = ranks[np.arange(len(near)), number] > ranks[:, 0]
        # of equal losses: smaller ids read from the end first, the later the better; then
        # larger ones, the earlier the better
        along = np.where(sign, place, -place)
        order = np.lexsort((number, along, sign, flat[near]))[: n - 1]
        ways: dict[int, list[int]] = {}
        for k in order.tolist():
            ways.setdefault(int(place[k]), []).append(int(number[k]))
        beam: list[tuple] = [(0.0, (), ())]
        for where in sorted(ways, reverse=True):
            at = which[where]
            options = [
                (float(solved.loss[at, m]), int(solved.rank[at, m]), m)
                for m in (0, *ways[where])
            ]
            beam = heapq.nsmallest(
                n,
                [
                    (loss + more, (*ranks_, rank), (*chosen, (where, m)) if m else chosen)
                    for loss, ranks_, chosen in beam
                    for more, rank, m in options
                ],
            )
        return beam

    def decode(self, ids: bytes) -> bytes:
        """The text of ids, in UTF-8, without the space that encoding puts in front."""
        at = np.frombuffer(ids, "<u4")
        sizes = self.sizes[at]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        first = self.starts[at] - (ends - sizes)
        text = self.surface[np.repeat(first, sizes) + np.arange(total)].tobytes()
        return text[1:] if text[:1] == b" " else text


class Places:
    """Scores of parts of about one length, longest first, for all of them at once.

    ``best`` holds the best score from a part's start to every place, by Viterbi.
    """

    def __init__(
        self, pieces: Pieces, spans: Spans, starts: np.ndarray, lengths: np.ndarray
    ) -> None:
        most = int(lengths[0])
        self.lengths = lengths
        self.best = best = np.full((len(starts), most + 1), -np.inf)
        best[:, 0] = 0
        self.unknown = np.zeros(len(starts), bool)
        # per start and size of a piece: the parts that hold it, its score and its id
        self.edges: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]] = []
        index = pieces.index
        for i in range(most):
            count = int(np.searchsorted(-lengths, -i, "left"))
            single = np.zeros(count, bool)
            live = np.arange(count)
            for n in range(1, min(pieces.longest, most - i) + 1):
                live = live[lengths[live] >= i + n]
                if not len(live):
                    break
                at = starts[live] + i
                hashes = spans.hashes(at, at + n)
                entry = np.minimum(np.searchsorted(index, hashes), len(index) - 1)
                begun = index[entry] == hashes
                live, entry = live[begun], entry[begun]
                scores = pieces.index_scores[entry]
                whole = ~np.isnan(scores)
                rows, scores = live[whole], scores[whole]
                best[rows, i + n] = np.maximum(best[rows, i + n], best[rows, i] + scores)
                self.edges.append((i, n, rows, scores, pieces.index_ids[entry[whole]]))
                if n == 1:
                    single[rows] = True
            rows = np.flatnonzero(~single)
            self.unknown[rows] = True
            best[rows, i + 1] = np.maximum(best[rows, i + 1], best[rows, i] + pieces.unknown)
        self.total = best[np.arange(len(starts)), lengths]

    def alone(self, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which parts have one best segmentation and no other that loses ``limits`` at most;
        the ids of these, part after part, and how many each has.

        A segmentation that is not the best holds a piece that the best does not hold, and
        loses at least what the best one through that piece loses.
        """
        count = len(self.lengths)
        if np.isinf(limits).all():
            return np.zeros(count, bool), np.empty(0, np.int64), np.empty(0, np.int64)
        onward = np.full(self.best.shape, -np.inf)
        onward[np.arange(count), self.lengths] = 0
        for i, n, rows, scores, _ in reversed(self.edges):
            onward[rows, i] = np.maximum(onward[rows, i], scores + onward[rows, i + n])
        covered, next_ = np.zeros(count, np.int64), np.full(count, np.inf)
        taken = []
        for i, n, rows, scores, ids in self.edges:
            loss = self.total[rows] - (self.best[rows, i] + scores + onward[rows, i + n])
            on = loss == 0
            covered[rows[on]] += n
            taken.append((rows[on], ids[on]))
            off = rows[~on]
            next_[off] = np.minimum(next_[off], loss[~on])
        rounding = 1e-9 * np.abs(self.total)
        alone = ~self.unknown & (covered == self.lengths) & (next_ > limits + rounding)
        rows = np.concatenate([t[0] for t in taken])
        ids = np.concatenate([t[1] for t in taken])
        rows, ids = rows[alone[rows]], ids[alone[rows]]
        order = np.argsort(rows, kind="stable")  # pieces come by their starts
        return alone, ids[order], np.bincount(rows, minlength=count)[alone]


@functools.cache
def classes() -> np.ndarray:
    """Class by code point: 0 between texts, 1 space, 2 letter, 3 number, 4 other."""
    table = np.full(BETWEEN + 1, 4, np.int8)
    for c in range(BETWEEN):
        char = chr(c)
        if char.isalpha():
            table[c] = 2
        elif char.isnumeric():
            table[c] = 3
    table[ord(SPACE)], table[BETWEEN] = 1, 0
    return table


@functools.cache
def coder(path: str, nbest: int) -> Pieces:
    return Pieces(path, nbest)


# --- Spark ----------------------------------------------------------------------------


def encode_nbest(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    model: str = MODEL,
    nbest: int = NBEST,
    keep_ids: bool = True,
) -> DataFrame:
    """Up to ``nbest`` rows per input row: the key, ``rank`` (from 1), ``score``, ``n_pieces``,
    ``ids_crc32``, ``round_trip`` (whether decoding gives the text back) and on request
    ``ids`` (little-endian unsigned 32 bit).

    Texts are segmented whole; one with fewer segmentations has fewer rows, the empty text one
    without pieces. NULL counts as empty, a NULL key stays NULL, rows that repeat are encoded
    one by one, an empty table gives an empty result. Characters that the vocabulary lacks
    become their bytes. Nothing is shuffled.
    """
    key_type = df.schema[key].dataType.simpleString()
    types = [
        ("rank", pa.int32()), ("score", pa.float64()), ("n_pieces", pa.int64()),
        ("ids_crc32", pa.int64()), ("round_trip", pa.bool_()),
    ]
    types += [("ids", pa.binary())] * keep_ids

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = coder(public_tokenizers.path(model), nbest)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            rows, owners, held = [], [], 0
            for i, found in enumerate(pieces.encode(texts)):
                source = texts[i].encode()
                for rank, (score, ids) in enumerate(found, 1):
                    same = pieces.decode(ids) == source
                    row = (rank, score, len(ids) // 4, zlib.crc32(ids), same)
                    rows.append((*row, ids) if keep_ids else row)
                    owners.append(i)
                    held += len(ids) if keep_ids else 0
                if held > 1 << 24:
                    yield _rows(batch, owners, rows, types, key)
                    rows, owners, held = [], [], 0
            if rows:
                yield _rows(batch, owners, rows, types, key)

    rows = df.select(F.col(key), whole(text).alias("_text"))
    schema = f"`{key}` {key_type}, rank int, score double, n_pieces long, ids_crc32 long, "
    return rows.mapInArrow(encode, schema + "round_trip boolean" + ", ids binary" * keep_ids)


def _rows(
    batch: pa.RecordBatch, owners: list[int], rows: list[tuple], types: list, key: str
) -> pa.RecordBatch:
    arrays = [pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True), types, strict=True)]
    keys = batch.column(0).take(pa.array(owners))
    return pa.RecordBatch.from_arrays([keys, *arrays], [key, *(n for n, _ in types)])


def decode_ids(
    df: DataFrame, key: str = "doc_id", ids: str = "ids", model: str = MODEL
) -> DataFrame:
    """The key and ``text`` of every row's ids (binary); NULL ids give a NULL text."""

    @F.pandas_udf("string")
    def decode(values):
        pieces = coder(public_tokenizers.path(model), NBEST)
        return values.map(
            lambda v: None if v is None else pieces.decode(v).decode("utf-8", "replace")
        )

    return df.select(F.col(key), decode(F.col(ids)).alias("text"))
