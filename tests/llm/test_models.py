"""Quality classifier, language model and top-k search."""

from __future__ import annotations

import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablebridge.llm import brown, quality, topk
from tablebridge.llm.queries import op4_top_inner_products, op6_classify_quality, op10_score_texts
from tests.conftest import SMALL
from tests.llm.conftest import odd_rows

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def test_gradients_are_the_slopes():
    rng = np.random.default_rng(3)
    model = quality.fit([], np.zeros(0))
    x, place, y = rng.normal(size=(9, quality.FEATURES)), np.array([0, 2, 3, 9]), np.array([1.0, 0.0, 1.0])

    def loss():
        p = model.forward(x, place)["p"]
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    model.decide += rng.normal(size=model.decide.shape) * 0.1
    weights = [model.encode, model.view, model.gate, model.weigh, model.decide, model.bias]
    for w, g in zip(weights, model.step(x, place, y), strict=True):
        for at in list(np.ndindex(w.shape))[:: max(1, w.size // 7)]:
            kept, step = w[at], 1e-5
            w[at] = kept + step
            up = loss()
            w[at] = kept - step
            down = loss()
            w[at] = kept
            assert g[at] == pytest.approx((up - down) / (2 * step), rel=1e-3, abs=1e-7)


def test_attention_weighs_all_passages():
    data = np.frombuffer(("word " * 200).encode() + b"  x", np.uint8)
    x, place = quality.passages(data, np.array([0, 0, 1000, len(data)]))
    assert place.tolist() == [0, 1, 5, 6]
    assert np.isfinite(x).all()
    f = quality.fit([], np.zeros(0)).forward(x, place)
    assert np.add.reduceat(f["a"], place[:-1]) == pytest.approx(np.ones(3))


def test_quality_query_is_right_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in op6_classify_quality(spark, folder).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    for d, r in rows.items():
        assert r.held_out == (zlib.crc32(str(d).encode()) % 4 == 2)
        assert r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1
    held = [(rows[d].predicted, q) for d, q in labels.items() if rows[d].held_out]
    assert len(held) > 50
    assert np.mean([p == q for p, q in held]) > 0.95


def test_held_out_labels_change_nothing(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (sorted(map(tuple, quality.classify_quality(docs, x).collect())) for x in (labels, turned))
    assert a == b


def test_quality_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (6, 0), (6, 0), (7, None), (8, 5), (None, 1), (10, 0), (10, 1)], "doc_id long, quality int")
    rows = quality.classify_quality(odd, labels).collect()
    assert len(rows) == len(odd_rows())
    assert all(0 <= r.score <= 1 for r in rows)
    assert quality.classify_quality(none, labels).count() == 0
    unlabelled = quality.classify_quality(odd, labels.limit(0)).collect()
    assert {r.score for r in unlabelled} == {0.5}
    kept = quality.keep_good(odd, labels, threshold=0.0)
    assert kept.columns == odd.columns and kept.count() == odd.count()


def plain_base(texts: dict) -> dict:
    tokens = {d: [*re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER)), None] for d, t in texts.items()}
    train = Counter(w for d, t in tokens.items() if zlib.crc32(str(d).encode()) % 10 for w in t)
    total, distinct = sum(train.values()), len(train)
    floor = math.log10(total + 0.1 * (distinct + 1))
    return {d: (zlib.crc32(str(d).encode()) % 10 == 0, len(t), sum(train[w] > 0 for w in t), total, sum(math.log10(train[w] + 0.1) - floor for w in t)) for d, t in tokens.items()}


def test_language_model_query(spark):
    folder = "/root/testdata/sf0.01"
    want = plain_base({r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()})
    rows = op10_score_texts(spark, folder).collect()
    assert len(rows) == len(want)
    for r in rows:
        own = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == own[:4]
        assert r.base_score == pytest.approx(own[4], rel=1e-9)
        assert r.score < 0
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_rare_words_are_joined(spark):
    """However few words tasks hold, the base stays the same."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    want = plain_base({r.doc_id: r.text for r in docs.collect()})
    for r in brown.score_texts(docs, most_held=50, own=20, classes=5).collect():
        assert (r.n_known, r.base_score) == (want[r.doc_id][2], pytest.approx(want[r.doc_id][4], rel=1e-9))


def test_word_probabilities_stay_below_one(spark):
    """Over all words of training and an unknown one, the probabilities within a class sum to one."""
    docs = spark.createDataFrame([(i, "a b c a b d" if i % 2 else "a c e f") for i in range(1, 40)], "doc_id long, text string")
    model = brown.train_model(docs, own=3, classes=2)
    for c in range(model.classes.count - 1):
        mine = model.held.counts[model.classes.word == c]
        if len(mine):
            total = sum((n + 0.1) / 10 ** model.emissions[c] for n in mine)
            assert total + 0.1 / 10 ** model.emissions[c] == pytest.approx(1)
    assert (10**model.transitions).sum(axis=1) == pytest.approx(np.ones(len(model.transitions)))


def plain_scores(texts: dict, model: brown.Model) -> dict:
    """Scores of texts by the model's classes, with counts and transitions taken anew from the texts."""
    def class_of(word):
        h, form, _ = brown.tokens(np.frombuffer(word.encode(), np.uint8), np.array([0, len(word.encode())]))
        at, known = model.held.find(h)
        return int(model.classes.word[at[0]] if known[0] else model.classes.form[form[0]])

    words = {d: re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER)) for d, t in texts.items()}
    train = [w for d, w in words.items() if zlib.crc32(str(d).encode()) % 10]
    counts = Counter(x for w in train for x in w)
    classes = {x: class_of(x) for w in words.values() for x in w}
    k = model.classes.count
    end, between = k - 1, np.zeros((k, k))
    mass, distinct = np.zeros(k), np.zeros(k)
    for w in train:
        for a, b in itertools.pairwise([end, *(classes[x] for x in w), end]):
            between[a, b] += 1
    for x, n in counts.items():
        mass[classes[x]] += n
        distinct[classes[x]] += 1
    out = {}
    for d, w in words.items():
        path = [end, *(classes[x] for x in w), end]
        moves = sum(math.log10((between[a, b] + 0.1) / (between[a].sum() + 0.1 * k)) for a, b in itertools.pairwise(path))
        out[d] = moves + sum(math.log10((counts[x] + 0.1) / (mass[classes[x]] + 0.1 * (distinct[classes[x]] + 1))) for x in w)
    return out


@pytest.mark.parametrize("most_held", [brown.HELD_WORDS, 300])
def test_scores_follow_from_the_classes(spark, most_held):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = brown.train_model(docs.where(~brown.held_out()), own=40, classes=6, most_held=most_held)
    want = plain_scores({r.doc_id: r.text for r in docs.collect()}, model)
    for r in brown.score_texts(docs, own=40, classes=6, most_held=most_held).collect():
        assert r.score == pytest.approx(want[r.doc_id], rel=1e-9)


def test_gains_are_what_the_classes_tell_more():
    """Moving one word of a random corpus changes what classes tell by its gain there less its gain at home."""
    rng = np.random.default_rng(12)
    k, words = 4, 30
    text = rng.integers(0, words, 4000)
    own = np.append(rng.integers(0, k - 1, words), k - 1)  # the last word ends texts
    text = np.concatenate(([words], text, [words]))

    def table(classes):
        t = np.zeros((k, k))
        np.add.at(t, (classes[text[:-1]], classes[text[1:]]), 1)
        return t

    for w in range(0, words, 5):
        at = np.flatnonzero(text == w)
        behind, before = text[at + 1], text[at - 1]
        codes = [*own[behind[behind != w]], *(k + own[before[before != w]]), *[2 * k] * int((behind == w).sum())]
        code, n = np.unique(codes, return_counts=True)
        gain = brown.gains(np.zeros(len(code), np.int64), code, n, own[[w]], table(own))[0]
        for b in set(range(k - 1)) - {own[w]}:
            moved = own.copy()
            moved[w] = b
            change = brown.told(table(moved)) - brown.told(table(own))
            assert gain[b] - gain[own[w]] == pytest.approx(change, abs=1e-6)


def test_rare_words_join_the_classes_of_their_contexts(spark):
    """Words that occur three times each, in two kinds of places, part by kind, though their forms are mixed."""
    rng = random.Random(5)
    nouns, verbs = [f"n{i}x" for i in range(300)], [f"v{i}x" for i in range(300)]
    texts = []
    for i in range(900):
        noun, verb = nouns[i % 300], verbs[(i * 7) % 300]
        texts.append(f"the {noun} will {verb} a {rng.choice(nouns)} and {rng.choice(verbs)} it")
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    model = brown.train_model(docs, own=12, classes=6)
    classes = {int(h): int(c) for h, c in zip(model.held.hashes, model.classes.word, strict=True)}

    def of(word):
        data = np.frombuffer(word.encode(), np.uint8)
        return classes[int(brown.tokens(data, np.array([0, len(data)]))[0][0])]

    kinds = [Counter(map(of, group)) for group in (nouns, verbs)]
    assert sum(min(kinds[0][c], kinds[1][c]) for c in range(model.classes.count)) < 15  # of 600 words


def test_exchange_finds_planted_classes():
    rng = np.random.default_rng(4)
    size = 13
    pairs = np.zeros((size, size), np.int64)
    for _ in range(6000):
        a = rng.integers(0, 6)
        pairs[a, 6 + rng.integers(0, 6)] += 1
        pairs[6 + rng.integers(0, 6), rng.integers(0, 6)] += 1
    own = brown.exchange(pairs, classes=2)
    assert len(set(own[:6])) == 1 and len(set(own[6:12])) == 1 and own[0] != own[6]
    assert own[12] not in own[:12]


def test_exchange_never_loses_information():
    rng = np.random.default_rng(6)
    pairs = rng.integers(0, 9, (12, 12))

    def value(own):
        k = own.max() + 1
        t = np.zeros((k, k))
        np.add.at(t, (own[:, None].repeat(12, 1), own[None, :].repeat(12, 0)), pairs)
        return brown.information(t).sum() - brown.information(t.sum(axis=1)).sum() - brown.information(t.sum(axis=0)).sum()

    values = [value(brown.exchange(pairs, classes=4, sweeps=n)) for n in range(5)]
    assert all(b >= a - 1e-6 for a, b in zip(values, values[1:], strict=False))


def test_language_model_odd_rows(odd, none):
    rows = brown.score_texts(odd).collect()
    assert len(rows) == len(odd_rows())
    assert all(r.n_tokens >= 1 and math.isfinite(r.score) for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (3, 4, 5)} == {1}
    assert brown.score_texts(none).count() == 0


def plain_top(rows, k=20):
    vectors = {i: [math.floor(64 * float(x)) for x in v] for i, v in rows}
    out = []
    for q in sorted(v for v in vectors if v % 20 == 0):
        scores = sorted((-sum(a * b for a, b in zip(vectors[q], vectors[c], strict=False)), c) for c in vectors if c != q)
        out += [(q, n + 1, c, -s) for n, (s, c) in enumerate(scores[:k])]
    return out


def test_top_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    assert sorted(map(tuple, op4_top_inner_products(spark, SMALL).collect())) == plain_top(rows)


def test_bounds_hold_at_every_depth():
    rng = np.random.default_rng(7)
    x, q = rng.integers(-20, 20, (50, 8)).astype(float), rng.integers(-20, 20, (5, 8)).astype(float)
    lists = topk.Lists.build(np.arange(50), x)
    for depth in (1, 7, 25, 49, 50):
        low, high = topk.bounds(q, lists, depth)
        assert (low <= q @ x.T).all() and (high >= q @ x.T).all()
    assert (low == high).all()


@pytest.mark.parametrize("block,query_block", [(7, 3), (64, 512)])
def test_top_with_ties_and_odd_vectors(spark, block, query_block):
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) / 64 for x in rng.integers(-2, 3, 4)], "x") for i in range(90)]
    odd = [(200, None, "x"), (220, [1.0, None, 0.0, 0.0], "x"), (240, [float("nan"), 0.0, 0.0, 0.0], "x"), (260, [float("inf"), 0.0, 0.0, 0.0], "x"), (None, [1.0, 1.0, 1.0, 1.0], "x")]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, score string")
    got = topk.top_inner_products(frame, F.col("vec_id") % 20 == 0, block=block, query_block=query_block).collect()
    assert sorted(map(tuple, got)) == plain_top([r[:2] for r in rows])


def test_top_of_large_numbers_and_few_rows(spark):
    rows = [(0, [3e7, 1.0]), (1, [3e7, 2.0]), (2, [-3e7, 5.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, topk.top_inner_products(frame, F.col("vec_id") == 0).collect())) == plain_top(rows)
    assert topk.top_inner_products(frame.limit(0), F.col("vec_id") == 0).count() == 0
    assert topk.top_inner_products(frame, F.col("vec_id") == 9).count() == 0


def test_rows_that_repeat_a_key_are_rows_of_their_own(spark):
    """Two query rows with one key and different vectors: both are answered, and each meets the other."""
    rows = [(20, [3.0, 0.0]), (20, [0.0, 2.0]), (1, [1.0, 1.0]), (2, [-1.0, 4.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(2)
    got = topk.top_inner_products(frame, F.col("vec_id") == 20, k=2, scale=1).collect()
    assert sorted(map(tuple, got)) == [(20, 1, 1, 3), (20, 1, 2, 8), (20, 2, 1, 2), (20, 2, 20, 0)]
