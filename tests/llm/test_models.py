"""N-best segmentation and the toxicity classifier."""

from __future__ import annotations

import math
import random
import re
import struct
import time
import unicodedata
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from faremill.llm import pieces, toxicity, word_hash
from faremill.llm.common import prepare
from faremill.llm.word_hash import Words
from tests.llm.helpers import edge_documents, empty_documents

PATH = public_tokenizers.path(pieces.MODEL)


@pytest.fixture(scope="module", autouse=True)
def ready(spark):
    prepare(spark)


def numbers(ids: bytes):
    return struct.unpack(f"<{len(ids) // 4}I", ids)


# --- pieces ---------------------------------------------------------------------------


def every_segmentation(p, text, n):
    text = p.processor.normalize(text)
    out = []

    def grow(i, ids, score):
        if i == len(text):
            out.append((-score, ids[::-1]))
            return
        single = False
        for j in range(i + 1, min(len(text), i + p.longest) + 1):
            known = p.vocabulary.get(text[i:j])
            if known:
                single |= j == i + 1
                grow(j, (*ids, known[0]), score + known[1])
        if not single:
            grow(i + 1, (*ids, -1 - i), score + p.unknown)

    grow(0, (), 0.0)
    return [(-v, p._expanded(text, ids[::-1])) for v, ids in sorted(out)[:n]]


@pytest.mark.parametrize("nbest,frequent,longest", [(5, 4000, 256), (4, 1, 256), (3, 4000, 0), (1, 4000, 256)])
def test_n_best_equal_every_segmentation(nbest, frequent, longest, monkeypatch):
    monkeypatch.setattr(pieces, "FREQUENT", frequent)
    monkeypatch.setattr(pieces, "LONGEST", longest)
    p = pieces.Pieces(PATH, nbest)
    rng = random.Random(nbest)
    signs = ["th", "an", "h", " ", " ", "ing", "s", "1", "x", "aa", "a", ",", "日", "▁"]
    texts = ["".join(rng.choices(signs, k=rng.randrange(0, 7))) for _ in range(300)]
    for text, found in zip(texts, p.encode(texts), strict=True):
        assert [(s, numbers(i)) for s, i in found] == every_segmentation(p, text, nbest), text


def test_scores_equal_the_library_on_a_unigram_reading():
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    with open(PATH, "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.model_type = 1
    library = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
    p = pieces.Pieces(PATH, 6)
    rng = random.Random(8)
    for _ in range(200):
        text = " ".join(rng.choices(["thanedble", "hello", "world", "ing", "edly", "x"], k=4))
        [found] = p.encode([text])
        want = library.nbest_encode_as_ids(text, nbest_size=6)
        total = [sum(library.get_score(i) for i in ids) for ids in want]
        assert [s for s, _ in found] == pytest.approx(total, rel=1e-6)
        assert all(library.decode(list(numbers(i))) == text for _, i in found)


def by_lists(p, part):
    """The n best of a part by n best lists for every place."""
    lists = [[(0.0, 0, 0, 0)]]
    for at in range(1, len(part) + 1):
        ways = [
            (lists[i][k][0] - score, id_, k, i)
            for i, id_, score in p._into(part, at)
            for k in range(len(lists[i]))
        ]
        lists.append(sorted(ways)[: p.nbest])
    found = []
    for n, (value, *_) in enumerate(lists[-1]):
        ids, at, k = [], len(part), n
        while at:
            _, id_, k, before = lists[at][k]
            ids.append(id_)
            at = before
        found.append((-value, ids))
    return found


def test_long_parts_by_the_same_search():
    """A-star with links gives what lists for every place give, with many equal values."""
    p = pieces.Pieces(PATH)
    rng = random.Random(3)
    for part in ("a" * 700, "".join(rng.choices("eainst", k=900)), "日本語" * 150, "ab" * 400):
        found = p._backward(part, p._forward(part), float("inf"))
        want = by_lists(p, part)
        assert [f[0] for f in found] == pytest.approx([w[0] for w in want])
        assert len({f[1] for f in found}) == len(found) == len(want)
        for score, ids in found:
            total = sum(p.unknown if i < 0 else p.processor.get_score(i) for i in ids)
            assert total == pytest.approx(score)
    start = time.perf_counter()
    p._backward("a" * 60_000, p._forward("a" * 60_000), float("inf"))
    assert time.perf_counter() - start < 30


def test_forgetting_does_not_change_results(monkeypatch):
    rng = random.Random(2)
    texts = [" ".join(rng.choices(["alpha", "beta", "gammas", "deltaic", "é"], k=30)) for _ in range(60)]
    want = [f for f in pieces.Pieces(PATH, 4).encode(texts)]
    monkeypatch.setattr(pieces, "BATCH_CHARS", 300)
    assert [f for f in pieces.Pieces(PATH, 4, memo=3).encode(texts)] == want


def test_edge_documents_come_back(spark):
    df = edge_documents(spark).filter("doc_id is null or doc_id <> 6")
    encoded = pieces.encode_nbest(df, nbest=3)
    rows = encoded.collect()
    best = [r for r in rows if r["rank"] == 1]
    assert len(best) == df.count()
    assert all(r.round_trip and r.ids_crc32 == zlib.crc32(bytes(r.ids)) for r in rows)
    texts = Counter((r.doc_id, r.text or "") for r in df.collect())
    decoded = pieces.decode_ids(encoded.filter("rank = 1")).collect()
    assert Counter((r.doc_id, r.text) for r in decoded) == texts
    empty = [r for r in rows if r.doc_id == 3]
    assert [(r["rank"], r.n_pieces, r.score) for r in empty] == [(1, 0, 0.0)]
    assert pieces.encode_nbest(empty_documents(spark)).count() == 0
    with_null = encoded.selectExpr("doc_id", "cast(null as binary) ids").limit(1)
    assert pieces.decode_ids(with_null).first().text is None


def test_very_long_parts_and_texts(spark):
    p = pieces.Pieces(PATH, 3)
    text = "abcdefghij" * 400 + " " + "the end " * 20_000
    [found] = p.encode([text])
    assert len(found) == 3
    assert all(p.decode(i).decode() == text for _, i in found)
    scores = [s for s, _ in found]
    assert scores == sorted(scores, reverse=True)


# --- toxicity -------------------------------------------------------------------------


def corpus(n: int, seed: int = 1):
    """Toxic texts hold a word of a family that clean ones never hold."""
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = [f"{rng.choice('bcdfgklm')}{rng.choice('aeiou')}{rng.randrange(300)}" for _ in range(rng.randrange(5, 60))]
        bad = int(i % 5 == 0)
        if bad:
            for _ in range(rng.randrange(1, 3)):
                words[rng.randrange(len(words))] = rng.choice(["idiot", f"vilezz{rng.randrange(10**6)}"])
        rows.append((i, " ".join(words), "en" if i % 2 else "de", "x"))
        labels.append((i, 1, bad))
    return rows, labels


DOCS = "doc_id long, text string, lang string, score string"


@pytest.fixture(scope="module")
def trained(spark):
    rows, labels = corpus(1500)
    docs = spark.createDataFrame(rows, DOCS)
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return docs, dict((i, t) for i, _, t in labels), toxicity.train_model(docs, table)


def test_held_out_rows_are_told_apart(spark, trained):
    docs, toxic, model = trained
    got = toxicity.score_documents(docs, model).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    held = [r for r in got if r.held_out]
    right = [r.predicted == toxic[r.doc_id] for r in held]
    assert np.mean(right) > 0.95


def test_held_out_labels_are_never_learned(spark, trained):
    docs, toxic, model = trained
    rows = [(i, 1, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, t in toxic.items()]
    other = toxicity.train_model(docs, spark.createDataFrame(rows, "doc_id long, quality int, toxic int"))
    assert (other.embeddings == model.embeddings).all() and other.shift == model.shift


def test_a_hot_key_is_learned_from_one_row(spark):
    rows, labels = corpus(400, seed=4)
    hot = next(i for i, _, bad in labels if bad and zlib.crc32(str(i).encode()) % 4 != 2)
    copies = [(hot, f"{rows[hot][1]} more{k % 700}", "en", "x") for k in range(1000)]
    docs = spark.createDataFrame([r for r in rows if r[0] != hot] + copies, DOCS).repartition(6)
    one = docs.filter(f"doc_id = {hot}").orderBy(F.xxhash64("text")).limit(1)
    alone = docs.filter(f"doc_id <> {hot}").unionByName(one)
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got, want = toxicity.train_model(docs, table), toxicity.train_model(alone, table)
    assert (got.embeddings == want.embeddings).all() and got.shift == want.shift


def test_the_score_is_the_texts_alone(spark, trained):
    docs, _, model = trained
    moved = docs.selectExpr("doc_id + 7 as doc_id", "text", "'zz' as lang", "score")
    one = {r.doc_id: r.score for r in toxicity.score_documents(docs, model).collect()}
    two = {r.doc_id - 7: r.score for r in toxicity.score_documents(moved, model).collect()}
    assert one == two


def test_rejecting_keeps_columns_and_clean_documents(spark, trained):
    docs, toxic, model = trained
    left = toxicity.drop_toxic(docs, model)
    assert left.columns == docs.columns
    kept = {r.doc_id for r in left.collect()}
    clean = [i for i, t in toxic.items() if not t]
    assert sum(i in kept for i in clean) / len(clean) > 0.97
    bad = [i for i, t in toxic.items() if t]
    assert sum(i in kept for i in bad) / len(bad) < 0.1
    assert set(model.thresholds) == {"", "en", "de"}


def test_rare_languages_get_thresholds_of_their_own(spark):
    rows, labels = corpus(1500)
    outside = [i for i, *_ in rows if zlib.crc32(str(i).encode()) % 4 != 2]
    toxic = {i: bad for i, _, bad in labels}
    rare = {i: "sv" for i in [i for i in outside if toxic[i]][:7] + [i for i in outside if not toxic[i]][:20]}
    clean = {i: "it" for i in [i for i in outside if not toxic[i]][-30:]}
    docs = spark.createDataFrame([(i, t, (clean | rare).get(i, lang), x) for i, t, lang, x in rows], DOCS)
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.train_model(docs, table)
    assert set(model.thresholds) == {"", "en", "de", "sv"}
    scores = {r.doc_id: r.score for r in toxicity.score_documents(docs, model).collect()}
    want = np.zeros((2, toxicity.BINS), np.int64)
    for i in rare:
        want[toxic[i], min(int(scores[i] * toxicity.BINS), toxicity.BINS - 1)] += 1
    assert model.thresholds["sv"] == toxicity._threshold(want)


def test_thresholds_have_the_best_f1():
    rng = np.random.default_rng(5)
    for _ in range(30):
        scores = rng.integers(320, 910, 60) / 1024
        y = (rng.random(60) < scores).astype(int)
        counts = np.zeros((2, toxicity.BINS), np.int64)
        np.add.at(counts, (y, (scores * toxicity.BINS).astype(int)), 1)

        def f1(cut):
            return 2 * (y * (scores >= cut)).sum() / ((scores >= cut).sum() + y.sum())

        assert f1(toxicity._threshold(counts)) == max(f1(s) for s in scores)
    assert toxicity._threshold(np.zeros((2, toxicity.BINS))) is None
    # scores that do not tell toxic rows apart give no cut, whatever they are
    blind = np.zeros((2, toxicity.BINS), np.int64)
    blind[0, 50:60], blind[1, 50:60] = 9, 1
    assert toxicity._threshold(blind) is None
    blind[1, 59] = 12
    assert 58 < toxicity._threshold(blind) * toxicity.BINS <= 59


def test_edge_documents_get_scores(spark, trained):
    model = trained[2]
    df = edge_documents(spark)
    got = toxicity.score_documents(df, model).collect()
    assert len(got) == df.count()
    empty = {r.score for r in got if r.doc_id in (3, 4, 5, 10)}
    assert len(empty) == 1
    assert not any(r.held_out for r in got if r.doc_id is None)
    assert toxicity.score_documents(empty_documents(spark), model).count() == 0


def test_no_labels_and_one_class(spark):
    rows, labels = corpus(60)
    docs = spark.createDataFrame(rows, DOCS)
    schema = "doc_id long, quality int, toxic int"
    for some in ([], [(i, 1, 0) for i, *_ in labels], [(None, 1, 1), (3, 1, None)]):
        model = toxicity.train_model(docs, spark.createDataFrame(some, schema))
        scores = [r.score for r in toxicity.score_documents(docs, model).collect()]
        assert all(np.isfinite(scores)) and max(scores) < 0.3


def plain_score(model, text):
    """The score by loops over words, filters and places, from the model's arrays alone."""
    mask = (1 << 64) - 1

    def spread(h):
        h = (h ^ h >> 30) * 0xBF58476D1CE4E5B9 & mask
        h = (h ^ h >> 27) * 0x94D049BB133111EB & mask
        return h ^ h >> 31

    def hashed(data):
        total, power = 0, 1
        for byte in data:
            total = (total + int(word_hash._BYTES[byte]) * power) & mask
            power = power * word_hash.BASE & mask
        return spread(total)

    vectors = []
    for word in re.findall("[a-z0-9]+", text.lower()):
        data = word.encode()
        parts = [data, data[:4], data[:5], data[:6]]
        rows = [1 + spread((hashed(p) + i) & mask) % (toxicity.BUCKETS - 1) for i, p in enumerate(parts)]
        vectors.append([sum(float(model.embeddings[r][d]) for r in rows) for d in range(toxicity.DIMENSION)])
    vectors += [[0.0] * toxicity.DIMENSION] * (3 - len(vectors))
    logit, at = model.offset, 0
    for width in (1, 2, 3):
        for f in range(toxicity.FILTERS):
            best = max(
                sum(
                    vectors[place + j][d] * float(model.filters[width][j][d][f])
                    for j in range(width)
                    for d in range(toxicity.DIMENSION)
                )
                for place in range(len(vectors) - width + 1)
            )
            logit += max(0.0, best + float(model.bias[at])) * float(model.weights[at])
            at += 1
    return 1 / (1 + math.exp(-(model.slope * logit + model.shift)))


def test_scores_equal_a_loop_over_words_filters_and_places(spark, trained):
    docs, _, model = trained
    some = docs.filter("doc_id < 25").collect()
    texts = {r.doc_id: r.text for r in some} | {-1: "", -2: "one", -3: "Idiot, idiot! vilezz7", -4: None}
    df = spark.createDataFrame([(i, t, "en", "x") for i, t in texts.items()], DOCS)
    got = {r.doc_id: r.score for r in toxicity.score_documents(df, model).collect()}
    for i, text in texts.items():
        assert got[i] == pytest.approx(plain_score(model, text or ""), abs=1e-4), text


def test_thresholds_and_rejections_are_shown(spark, trained):
    docs, _, model = trained
    rows = docs.unionByName(spark.createDataFrame([(-1, "x", None, "s"), (-2, "x", "zz", "s")], DOCS))
    got = toxicity.score_documents(rows, model, lang="lang").collect()
    lang = {r.doc_id: r.lang for r in rows.collect()}
    cut = model.thresholds
    assert all(r.threshold == cut.get(lang[r.doc_id], cut[""]) for r in got)
    assert all(r.rejected == (r.score >= r.threshold) for r in got)
    kept = {r.doc_id for r in toxicity.drop_toxic(rows, model).collect()}
    assert kept == {r.doc_id for r in got if not r.rejected}


def test_rejecting_keeps_columns_that_clash(spark, trained):
    df = trained[0].limit(20).selectExpr("*", "1 AS row", "2 AS limit", "3 AS _limit")
    left = toxicity.drop_toxic(df, trained[2])
    assert left.columns == df.columns and {(r.row, r.limit, r._limit) for r in left.collect()} == {(1, 2, 3)}


def test_long_texts_are_scored_in_pieces(monkeypatch):
    rng = np.random.default_rng(0)
    model = toxicity._network(rng)
    model.embeddings = rng.normal(0, 1, model.embeddings.shape).astype(np.float32)
    model.build_table()
    ids = toxicity.buckets(" ".join(f"w{i * 7919 % 1000}" for i in range(500)))
    want, where = model.pooled(ids)
    monkeypatch.setattr(toxicity, "PIECE", 37)
    got, at = model.pooled(ids)
    assert np.allclose(got, want) and (at == where).all()


def test_gradients_follow_the_loss():
    """Training lowers the loss on what it was given."""
    rows, labels = corpus(300, seed=3)
    model = toxicity.train([r[1] for r in rows], [x[2] for x in labels], [r[2] for r in rows], 0.2)
    model.build_table()
    scores = np.array([model.score(r[1]) for r in rows])
    y = np.array([x[2] for x in labels])
    assert scores[y == 1].mean() > 0.6 > 0.25 > scores[y == 0].mean()


def test_words():
    words = Words("Ab, ab É9 é9\n--x")
    h = words.hashes()
    assert len(words) == 5 and h[0] == h[1] and h[2] == h[3] and len(set(h.tolist())) == 3
    assert (words.prefixes(99) == h).all()
    assert Words("abcdef abcxyz").prefixes(3)[0] == Words("abcdef abcxyz").prefixes(3)[1]
    assert len(Words("")) == 0 and len(Words("!?").hashes()) == 0


def test_words_beyond_ascii():
    plain = Words("the café isn t far").hashes().tolist()
    for text in ("the\u00a0café\u3000isn’t far", "«The café» — ‘isn’t’… “far”", "the\u2003café、isn・t。far 🙂\ufe0f"):
        assert Words(text).hashes().tolist() == plain, text
    quoted, bare = Words("“vilezzard”"), Words("vilezzard")
    assert (quoted.prefixes(4) == bare.prefixes(4)).all()
    assert len(Words("日本語のテキスト。東京2025年")) == 8 + 2 + 1 + 1
    assert len(Words("भाषा e\u0301te x\u0301")) == 3 and len(Words("ก\u0e34น abc")) == 3
    assert Words("東京abc東").hashes().tolist() == Words("東 京 abc 東").hashes().tolist()
    assert len(Words("“…” — 🙂")) == len(Words("\u00a0")) == 0
    assert len(Words("a\ud800b é")) == 3


def test_words_equal_a_loop_over_characters():
    rng = random.Random(6)
    signs = "aZ9_ -é\u0301ß«”\u00a0—日のーก\u0e34٣я🙂\u200d\ufe0f\u3000。İ"
    for _ in range(2000):
        text = "".join(rng.choices(signs, k=rng.randrange(0, 14)))
        found = [[]]
        for c in text.lower():
            kind = unicodedata.category(c)[0]
            if c == "\ufe0f" or kind not in "LMN":
                found.append([])
            elif kind == "M" or c in "٣9":
                if kind != "M" and found[-1] and found[-1][0] in "日のーก":
                    found.append([])
                found[-1].append(c)
            elif c in "日のーก" or (found[-1] and found[-1][0] in "日のーก"):
                found.append([c])
            else:
                found[-1].append(c)
        want = ["".join(w) for w in found if w]
        data, words = text.lower().encode(), Words(text)
        got = [data[a:b].decode() for a, b in zip(words.starts, words.ends, strict=True)]
        assert got == want, text
