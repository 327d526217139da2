"""Toxicity by a convolutional text classifier, trained in numpy.

Words are hashed to rows of an embedding table, whole and by their beginnings, so that words
of one family share a part of their embeddings. Filters of several widths slide over the whole
text, each keeps its largest response (max pooling), and a linear layer makes a logit of them,
which Platt scaling turns into a probability. Thresholds for rejecting are calibrated by
language; the language is no input of a score, and neither are key, source or labels.

Training takes a bounded sample of the labelled rows outside the held-out fold and runs in one
task. The thresholds come from a histogram of the scores of all labelled rows outside that fold. For scoring, embeddings and filters are multiplied beforehand: the response at a place
is a sum of table rows, so a text costs a few gathers a word.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faremill.llm.common import as_row, stored, whole
from faremill.llm.word_hash import Words, mix

BUCKETS = 1 << 16
DIMENSION = 16
FILTERS = 8
WIDTHS = (1, 2, 3)
PREFIXES = (4, 5, 6)  # bytes
PIECE = 1 << 16  # words that are scored at once
SAMPLE = {1: 3000, 0: 5000}  # most labelled keys of each class, one row each, to train on
UPDATES = 2000  # steps of training, whatever the size of the sample,
EPOCHS = 30  # but at most so many passes over it
SPREAD = 0.05  # of the embeddings before training
SEEN = 3  # training documents that a row must occur in to be kept
BATCH = 16
RATE = 0.2
HELD_OUT = 2  # the fold, of crc32(key) mod 4
CUT = 0.3
BINS = 1024  # of the histogram of scores; a power of two, so that its edges are exact


@dataclass
class Model:
    embeddings: np.ndarray
    filters: dict[int, np.ndarray]  # width -> (width, dimension, filters)
    bias: np.ndarray
    weights: np.ndarray
    offset: float = 0.0
    slope: float = 1.0
    shift: float = 0.0
    thresholds: dict[str, float] = field(default_factory=dict)
    table: np.ndarray | None = None

    def mixed(self) -> np.ndarray:
        """All filters side by side: per width and place ``FILTERS`` columns."""
        return np.concatenate([self.filters[w][j] for w in WIDTHS for j in range(w)], axis=1)

    def build_table(self) -> None:
        """The responses of every bucket to all filters, for scoring."""
        self.table = self.embeddings @ self.mixed()

    def pooled(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Largest response of each filter, and where it stands. Long texts go in pieces that
        overlap by a filter's reach."""
        reach = max(WIDTHS)
        if len(ids) < reach:
            ids = np.concatenate([ids, np.zeros((reach - len(ids), ids.shape[1]), ids.dtype)])
        best, where = self._piece(ids[:PIECE])
        for start in range(PIECE - reach + 1, len(ids) - reach + 1, PIECE - reach + 1):
            more, at = self._piece(ids[start : start + PIECE])
            where = np.where(more > best, at + start, where)
            best = np.maximum(best, more)
        return best, where

    def _piece(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if self.table is not None:
            responses = self.table[ids[:, 0]]
            for c in range(1, ids.shape[1]):
                responses += self.table[ids[:, c]]
        else:
            responses = self.embeddings[ids].sum(axis=1) @ self.mixed()
        best, where, column = [], [], 0
        for w in WIDTHS:
            n = len(ids) - w + 1
            total = responses[:n, column : column + FILTERS].copy()
            for j in range(1, w):
                at = column + j * FILTERS
                total += responses[j : j + n, at : at + FILTERS]
            column += w * FILTERS
            place = total.argmax(axis=0)
            where.append(place)
            best.append(total[place, np.arange(FILTERS)])
        return np.concatenate(best), np.concatenate(where)

    def logit(self, ids: np.ndarray) -> float:
        return float(np.maximum(self.pooled(ids)[0] + self.bias, 0) @ self.weights + self.offset)

    def score(self, text: str) -> float:
        z = self.slope * self.logit(buckets(text)) + self.shift
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))


def buckets(text: str) -> np.ndarray:
    """Per word the rows of the embedding table: of the word and of its beginnings. Row 0 is
    kept for padding; every kind of feature is hashed on its own."""
    words = Words(text)
    hashes = [words.hashes(), *(words.prefixes(n) for n in PREFIXES)]
    rows = [
        1 + mix(h + np.uint64(i)) % np.uint64(BUCKETS - 1) for i, h in enumerate(hashes)
    ]
    return np.stack(rows, axis=1).astype(np.int32)


# --- training -------------------------------------------------------------------------


def train(
    texts: list[str], toxic: list[int], langs: list[str | None], prior: float, seed: int = 7
) -> Model:
    """A model from a sample; ``prior`` is the share of toxic rows among all labelled ones.

    A quarter of the sample does not train the network: it calibrates the scores, weighted to
    the prior. The languages are no input of it.
    """
    rng = np.random.default_rng(seed)
    ids = [buckets(t) for t in texts]
    y = np.array(toxic, float)
    fold = rng.permutation(len(ids)) % 4
    fit, hold = np.flatnonzero(fold > 0), np.flatnonzero(fold == 0)
    model = _network(rng)
    if len(set(y[fit])) > 1:
        _fit(model, ids, y, fit, rng)
    seen = np.zeros(BUCKETS, np.int64)
    for i in fit:
        seen[np.unique(ids[i])] += 1
    model.embeddings[seen < SEEN] = 0  # what is hardly known says nothing
    model.build_table()
    if not len(hold) or len(set(y[hold])) < 2:
        hold = np.arange(len(ids))
    logits = np.array([model.logit(ids[i]) for i in hold])
    share = y[hold].mean() if len(hold) else 0.5
    prior = min(max(prior, 1e-3), 1 - 1e-3)
    weight = np.where(y[hold] > 0, prior / max(share, 1e-9), (1 - prior) / max(1 - share, 1e-9))
    model.slope, model.shift = _platt(logits, y[hold], weight, prior)
    model.table = None
    return model


def _network(rng: np.random.Generator) -> Model:
    embeddings = rng.normal(0, SPREAD, (BUCKETS, DIMENSION)).astype(np.float32)
    embeddings[0] = 0
    filters = {
        w: rng.normal(0, 1 / np.sqrt(w * DIMENSION), (w, DIMENSION, FILTERS)).astype(np.float32)
        for w in WIDTHS
    }
    n = FILTERS * len(WIDTHS)
    return Model(embeddings, filters, np.zeros(n), rng.normal(0, 0.3, n))


def _fit(
    model: Model, ids: list[np.ndarray], y: np.ndarray, fit: np.ndarray, rng: np.random.Generator
) -> None:
    """Adagrad on the log loss, classes weighted equally; only pooled places get a gradient."""
    balance = np.where(y[fit] > 0, 0.5 / y[fit].mean(), 0.5 / (1 - y[fit].mean()))
    balance = dict(zip(fit.tolist(), balance, strict=True))
    seen_e = np.full(BUCKETS, 1e-2)
    seen_f = {w: np.full_like(model.filters[w], 1e-2) for w in WIDTHS}
    seen_b, seen_w = np.full_like(model.bias, 1e-2), np.full_like(model.weights, 1e-2)
    seen_o = 1e-2
    reach = max(WIDTHS)
    for _ in range(min(EPOCHS, max(1, round(UPDATES * BATCH / len(fit))))):
        order = rng.permutation(fit)
        for start in range(0, len(order), BATCH):
            grad_f = {w: np.zeros_like(model.filters[w]) for w in WIDTHS}
            grad_b, grad_w = np.zeros_like(model.bias), np.zeros_like(model.weights)
            grad_o = 0.0
            rows, row_grads = [], []
            batch = order[start : start + BATCH]
            for i in batch:
                own = ids[i]
                if len(own) < reach:
                    pad = np.zeros((reach - len(own), own.shape[1]), own.dtype)
                    own = np.concatenate([own, pad])
                best, where = model.pooled(own)
                active = np.maximum(best + model.bias, 0)
                p = 1 / (1 + np.exp(-np.clip(active @ model.weights + model.offset, -40, 40)))
                g = (p - y[i]) * balance[int(i)] / len(batch)
                grad_w += g * active
                grad_o += g
                back = g * model.weights * (active > 0)
                grad_b += back
                for k, w in enumerate(WIDTHS):
                    part = slice(k * FILTERS, (k + 1) * FILTERS)
                    for j in range(w):
                        at = own[where[part] + j]  # (filters, features)
                        grad_f[w][j] += model.embeddings[at].sum(axis=1).T * back[part]
                        step = model.filters[w][j].T * back[part][:, None]
                        for c in range(at.shape[1]):
                            rows.append(at[:, c])
                            row_grads.append(step)
            touched, inverse = np.unique(np.concatenate(rows), return_inverse=True)
            grad_e = np.zeros((len(touched), DIMENSION))
            np.add.at(grad_e, inverse, np.concatenate(row_grads))
            seen_e[touched] += (grad_e**2).mean(axis=1)
            model.embeddings[touched] -= RATE * grad_e / np.sqrt(seen_e[touched])[:, None]
            model.embeddings[0] = 0
            for w in WIDTHS:
                seen_f[w] += grad_f[w] ** 2
                model.filters[w] -= RATE * grad_f[w] / np.sqrt(seen_f[w])
            seen_b += grad_b**2
            model.bias -= RATE * grad_b / np.sqrt(seen_b)
            seen_w += grad_w**2
            model.weights -= RATE * grad_w / np.sqrt(seen_w)
            seen_o += grad_o**2
            model.offset -= RATE * grad_o / np.sqrt(seen_o)


def _platt(
    logits: np.ndarray, y: np.ndarray, weight: np.ndarray, prior: float
) -> tuple[float, float]:
    """Slope and shift of the logits for the weighted log loss, by damped Newton steps.

    Few rows say little, so both are drawn to no change as if by one more row each; and the
    slope stays within a factor of ten.
    """
    if len(set(y)) < 2:
        return 1.0, float(np.log(prior / (1 - prior)))
    a, b = 1.0, 0.0
    n, draw = weight.sum(), 1 / len(y)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * logits + b, -40, 40)))
        d, h = weight * (p - y) / n, weight * p * (1 - p) / n
        ga, gb = d @ logits + draw * (a - 1), d.sum() + draw * b
        haa, hab, hbb = h @ logits**2 + draw, h @ logits, h.sum() + draw
        det = haa * hbb - hab**2
        step = np.array([hbb * ga - hab * gb, haa * gb - hab * ga]) / det
        step *= 0.5 / max(1, np.abs(step).max())
        a, b = float(np.clip(a - step[0], 0.1, 10)), float(b - step[1])
    return a, b


def _threshold(counts: np.ndarray) -> float | None:
    """The cut with the best F1 for the rows by label and bin of score; half way to the next
    lower bin that holds rows. Of the rows above a cut at least half must be toxic: a model that
    cannot tell them apart would else reject all. None unless there are rows of both labels and
    such a cut."""
    total = counts[1].sum()
    if not total or not counts[0].sum():
        return None
    rows = counts.sum(axis=0)
    hits, taken = np.cumsum(counts[1, ::-1]), np.cumsum(rows[::-1])
    f1 = np.where(2 * hits >= taken, 2 * hits / (taken + total), 0)
    if not f1.max() > 0:
        return None
    at = BINS - 1 - int(np.argmax(f1))
    below = np.flatnonzero(rows[:at])
    lowest = below[-1] + 1 if len(below) else at
    return float((at + lowest) / 2 / BINS)


# --- Spark ----------------------------------------------------------------------------


def held_out(key: Column) -> Column:
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(4)) == HELD_OUT


def train_model(
    df: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    label: str = "toxic",
    sample: dict[int, int] | None = None,
) -> Model:
    """Fit on a bounded sample: of each class the rows with the smallest hashes of their keys.

    Only labelled rows outside the held-out fold are considered, with NULL keys and labels left
    out; a key with several labels is toxic if any of them says so. A key that several rows
    share is learned from one of them, that with the smallest hash of its text, so the one task
    that fits gets no more rows than the sample has keys, however hot a key is. Whole texts are
    used, a NULL text as empty. Without labels the model scores by chance near 0.

    All labelled rows outside the held-out fold, the sample's among them, are scored for the
    thresholds: each language's is the best for F1 on its rows. A
    language that lacks toxic or other labelled rows, and a NULL or empty one, gets the general
    threshold, of the rows of all languages; so does one without a cut above which at least
    half of its rows are toxic. If the general one cannot be found so, it is ``CUT``.
    """
    sample = sample or SAMPLE
    usable = labels.filter(
        F.col(key).isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col(key))
    )
    usable = usable.groupBy(F.col(key).alias("key")).agg(F.max(label).cast("int").alias("y"))
    usable = stored(usable, "toxicity-labels")
    share = usable.agg(F.avg("y")).first()[0]
    chosen = [
        usable.filter(F.col("y") == y).orderBy(F.xxhash64("key"), "key").limit(n)
        for y, n in sample.items()
    ]
    keys = stored(chosen[0].unionByName(chosen[1]), "toxicity-sample")  # bounded by ``sample``
    documents = df.select(
        F.col(key).alias("key"),
        whole(text).alias("text"),
        F.col(lang).cast("string").alias("lang"),
    )
    one = F.min(F.struct(F.xxhash64("text").alias("hash"), "text", "lang")).alias("one")
    rows = documents.join(F.broadcast(keys), "key").groupBy("key", "y").agg(one)
    rows = rows.select("key", "y", "one.text", "one.lang").repartition(1)
    rows = rows.sortWithinPartitions("key")

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [r for b in batches for r in b.to_pylist()]
        columns = [[r[c] for r in held] for c in ("text", "y", "lang")]
        model = train(*columns, share if share is not None else 0.0)
        yield pa.RecordBatch.from_pydict({"model": [pickle.dumps(model)]})

    fitted = stored(
        rows.select("text", "y", "lang").mapInArrow(fit, "model binary"), "toxicity-model"
    )
    found = fitted.first()
    if not found:
        return train([""], [0], [None], 0.0)
    model = pickle.loads(found["model"])
    model.thresholds = _thresholds(documents, usable, model)
    return model


def _thresholds(documents: DataFrame, usable: DataFrame, model: Model) -> dict[str, float]:
    """The general threshold, under the empty text, and those of languages with both labels.

    Texts are scored where they are read; what is joined to the labels are counts by key,
    language and bin, so a hot key comes as few rows. The driver gets at most ``2 * BINS``
    counts a language.
    """
    rows = documents.filter(F.col("key").isNotNull() & ~held_out(F.col("key")))
    place = F.least(F.floor(_scorer(model)("text") * BINS), F.lit(BINS - 1)).cast("int")
    counts = rows.select("key", F.coalesce("lang", F.lit("")).alias("lang"), place.alias("bin"))
    counts = counts.groupBy("key", "lang", "bin").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.join(usable, "key").groupBy("lang", "y", "bin").agg(F.sum("n").alias("n"))
    by_lang: dict[str, np.ndarray] = {}
    general = np.zeros((2, BINS), np.int64)
    for r in counts.collect():
        own = by_lang.setdefault(r["lang"], np.zeros((2, BINS), np.int64))
        own[r["y"], r["bin"]] += r["n"]
        general[r["y"], r["bin"]] += r["n"]
    by_lang[""] = general
    found = {lang: _threshold(own) for lang, own in by_lang.items()}
    return {"": CUT} | {lang: cut for lang, cut in found.items() if cut is not None}


def score_documents(
    df: DataFrame,
    model: Model,
    key: str = "doc_id",
    text: str = "text",
    cut: float = CUT,
    lang: str | None = None,
) -> DataFrame:
    """One row per input row: the key, ``held_out``, ``score`` (0 to 1), ``predicted``.

    The score is the text's alone. A NULL text counts as empty and gets the score of a text
    without words; a NULL key is not held out. Rows that repeat get the same score; an empty
    table gives an empty result. With ``lang``, the name of a column, also the ``threshold`` of
    the row's language and whether the row is ``rejected``, as ``drop_toxic`` does.
    """
    own = [] if lang is None else [_limit(model, lang).alias("_limit")]
    rows = df.select(F.col(key).alias("_key"), whole(text).alias("_text"), *own)
    scored = rows.withColumn("_score", _scorer(model)("_text"))
    found = [
        F.col("_key").alias(key),
        F.coalesce(held_out(F.col("_key")), F.lit(False)).alias("held_out"),
        F.col("_score").alias("score"),
        (F.col("_score") >= cut).cast("int").alias("predicted"),
    ]
    if lang is not None:
        found.append(F.col("_limit").alias("threshold"))
        found.append((F.col("_score") >= F.col("_limit")).alias("rejected"))
    return scored.select(*found)


def _limit(model: Model, lang: str) -> Column:
    """The threshold of a row's language."""
    thresholds = {k: v for k, v in model.thresholds.items() if k}
    general = F.lit(model.thresholds.get("", CUT))
    if not thresholds:
        return general
    table = F.create_map(*[F.lit(x) for pair in sorted(thresholds.items()) for x in pair])
    return F.coalesce(F.try_element_at(table, F.col(lang).cast("string")), general)


def _scorer(model: Model):
    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model.build_table()
        for batch in texts:
            yield pd.Series([model.score(t) for t in batch], dtype="float64")

    return score


def drop_toxic(
    df: DataFrame, model: Model, text: str = "text", lang: str = "lang"
) -> DataFrame:
    """The rows whose score is below the threshold of their language, with all columns."""
    scored = df.select(
        as_row(df).alias("row"),
        _scorer(model)(whole(text)).alias("score"),
        _limit(model, lang).alias("limit"),
    )
    return scored.filter(F.col("score") < F.col("limit")).select("row.*")
