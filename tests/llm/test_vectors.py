"""Nearest neighbours and vector codes against brute force."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablebridge.llm import onebit, vector_codes
from tablebridge.llm.queries import op12_nearest_neighbours
from tests.conftest import SMALL

SCHEMA = "vec_id long, embedding array<double>, label int"
NAN, INF = float("nan"), float("inf")


def read(spark, folder: str):
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    return [r.vec_id for r in rows], np.array([r.embedding for r in rows], np.float64)


def plain_nearest(ids: list, x: np.ndarray, queries: list[int], k: int = 20) -> dict:
    """Per query's place the (vec_id, score) of its k nearest."""
    out = {}
    for i in queries:
        score = (x[i] * x).sum(axis=1)
        out[i] = sorted(((ids[j], float(score[j])) for j in range(len(ids)) if j != i), key=lambda r: (-r[1], r[0]))[:k]
    return out


def gathered(rows) -> dict:
    out: dict = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return out


@pytest.mark.parametrize("folder", [SMALL, "/root/testdata/sf0.1"])
def test_recall_and_scores(spark, folder):
    ids, x = read(spark, folder)
    want = plain_nearest(ids, x, [i for i, n in enumerate(ids) if n % 20 == 0])
    got = gathered(op12_nearest_neighbours(spark, folder).collect())
    assert set(got) == {ids[i] for i in want}
    found = 0
    for i, best in want.items():
        rows = got[ids[i]]
        assert [r[0] for r in rows] == list(range(1, 21))
        assert [r[1:] for r in rows] == sorted((r[1:] for r in rows), key=lambda r: (-r[1], r[0]))
        for _, vec_id, score in rows:
            assert score == float((x[i] * x[ids.index(vec_id)]).sum())
        found += len({r[1] for r in rows} & {n for n, _ in best})
    assert found >= 0.99 * 20 * len(want)


def test_no_bound_is_exact_and_blocks_do_not_matter(spark):
    ids, x = read(spark, SMALL)
    frame = spark.read.parquet(f"{SMALL}/embeddings.parquet").repartition(4)
    want = plain_nearest(ids, x, [i for i, n in enumerate(ids) if n % 20 == 0], 7)
    rows = onebit.nearest_neighbours(frame, F.col("vec_id") % 20 == 0, k=7, confidence=1e6, block=33, query_block=5).collect()
    assert {q: [r[1:] for r in found] for q, found in gathered(rows).items()} == {ids[i]: best for i, best in want.items()}


def test_errors_stay_within_their_bounds():
    rng = np.random.default_rng(3)
    x = rng.standard_normal((3000, 48)) + 0.5
    q = rng.standard_normal((40, 48)) * 3
    mean, turn = x.mean(axis=0), onebit.rotation(48, 192)
    estimate, error = onebit.estimates(q, onebit.encode(x, mean, turn), mean, turn, 3.0)
    beyond = np.abs(estimate - q @ x.T) > error
    assert beyond.mean() < 0.005
    tight, _ = onebit.estimates(q, onebit.encode(x, mean, onebit.rotation(48, 768)), mean, onebit.rotation(48, 768), 3.0)
    assert np.abs(tight - q @ x.T).mean() < 0.7 * np.abs(estimate - q @ x.T).mean()


def test_bounds_spare_most_vectors():
    rng = np.random.default_rng(5)
    x = rng.standard_normal((4000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    turn, mean = onebit.rotation(64, 256), x.mean(axis=0)
    estimate, error = onebit.estimates(x[:50], onebit.encode(x, mean, turn), mean, turn, 3.0)
    kth = np.sort(x[:50] @ x.T, axis=1)[:, -20]
    assert (estimate + error >= kth[:, None]).mean() < 0.2


def test_odd_vectors(spark):
    rows = [
        (0, [1.0, 2.0], 1),
        (20, [2.0, 1.0], 1),
        (20, [2.0, 1.0], 1),
        (20, [0.5, 0.0], None),
        (1, [1.0, 2.0], None),
        (2, None, 1),
        (3, [0.0, 0.0], 1),
        (4, [NAN, 1.0], 1),
        (5, [INF, 1.0], 1),
        (6, [None, 1.0], 1),
        (7, [], 1),
        (8, [3.0], 1),
        (None, [5.0, 5.0], 1),
        (40, None, 1),
        (9, [1e200, 1.0], 1),
    ]
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("clash") for c in ("key", "v", "query", "block", "rank", "score")})
    kept = [(r[0], [*r[1], 0.0][:2]) for r in rows if r[0] in (0, 1, 8, 9, 20) and r[1]]
    x = np.array([v for _, v in kept])
    want = plain_nearest([n for n, _ in kept], x, [i for i, (n, _) in enumerate(kept) if n % 20 == 0])
    got = onebit.nearest_neighbours(frame, F.col("vec_id") % 20 == 0).collect()
    listed = sorted((kept[i][0], rank, n, s) for i, best in want.items() for rank, (n, s) in enumerate(best, 1))
    assert sorted(tuple(r) for r in got) == listed
    nobody = spark.createDataFrame([], SCHEMA)
    for nothing in (nobody, frame.where("vec_id = 1")):
        found = onebit.nearest_neighbours(nothing, F.col("vec_id") % 20 == 0)
        assert found.collect() == [] and found.columns == ["query_id", "rank", "vec_id", "score"]


def plain_codes(ids: list, x: np.ndarray, parts: int = 4, entries: int = 256, rounds: int = 4) -> tuple[list[str], list[int], list[np.ndarray]]:
    """Codes, errors and codebooks, every part compared with every entry in every round."""
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, x[i].tolist()))[:entries]
    width = x.shape[1] // parts
    codes, error, books = [b""] * len(x), np.zeros(len(x), np.int64), []
    for p in range(parts):
        own = x[:, p * width : (p + 1) * width]
        book = own[order].copy()
        for turn in range(rounds + 1):
            d = ((own[:, None, :] - book[None]) ** 2).sum(axis=2)
            best = d.argmin(axis=1)
            if turn < rounds:
                for e in set(best):
                    book[e] = own[best == e].sum(axis=0) // int((best == e).sum())
        error += d[np.arange(len(x)), best]
        codes = [code + bytes([e]) for code, e in zip(codes, best, strict=True)]
        books.append(book)
    return [code.hex() for code in codes], error.tolist(), books


@pytest.mark.parametrize(("width", "entries", "spread"), [(16, 40, 3), (12, 7, 0.2), (5, 256, 1)])
def test_codes_of_made_vectors(spark, width, entries, spread):
    """Small whole numbers, so that ties and repeated vectors are frequent."""
    rng = np.random.default_rng(width)
    x = np.floor(rng.standard_normal((700, width)) * spread) + rng.integers(0, 3, (700, 1)) * 4
    ids = rng.permutation(650).tolist() + [0, 1, 1, 2, *[None] * 46]
    frame = spark.createDataFrame([(n, v.tolist(), None) for n, v in zip(ids, x, strict=True)], SCHEMA).repartition(5)
    coded, books = vector_codes.compress_vectors(frame, entries=entries, scale=2, groups=5)
    padded = np.zeros((700, -(-width // 4) * 4), np.int64)
    padded[:, :width] = 2 * x
    codes, error, want = plain_codes(ids, padded, entries=entries)
    assert sorted((str(r.vec_id), r.code, r.error) for r in coded.collect()) == sorted(zip(map(str, ids), codes, error, strict=True))
    assert all((a == b).all() for a, b in zip(books, want, strict=True))


def test_bounds_spare_distances_and_lose_nothing():
    """Net displacements loosen bounds less than the sums of all moves, and every part keeps its nearest entry."""
    rng = np.random.default_rng(9)
    x = (rng.standard_normal((20, 8))[rng.integers(0, 20, 3000)] * 300 + rng.standard_normal((3000, 8)) * 60).astype(np.int64)
    history = [x[:64].copy()]
    groups = vector_codes.grouping(history[0], 12)
    assert sorted(np.concatenate(groups)) == list(range(64))
    bounds = vector_codes.Bounds.new(len(x), len(groups))
    worked = []
    for _ in range(6):
        worked.append(vector_codes.assign(x, np.stack(history), groups, bounds, True))
        d = ((x[:, None, :] - history[-1][None]) ** 2).sum(axis=2)
        assert (bounds.entry == d.argmin(axis=1)).all()
        for g, own in enumerate(groups):
            others = np.where(own[None, :] == bounds.entry[:, None], np.inf, np.sqrt(d[:, own])).min(axis=1)
            moved = np.sqrt(((history[-1][None, own].astype(float) - np.stack(history)[:, own]) ** 2).sum(axis=2)).max(axis=1)
            assert (bounds.low[:, g] - moved[bounds.low_at[:, g]] <= others + 1e-3).all()
        book = history[-1].copy()
        for e in np.unique(bounds.entry):
            book[e] = x[bounds.entry == e].sum(axis=0) // int((bounds.entry == e).sum())
        history.append(book)
    assert worked[-1] < 0.3 * worked[0]
    moves = np.sqrt((np.diff(np.stack(history).astype(float), axis=0) ** 2).sum(axis=2))
    net = np.sqrt(((history[-1] - history[0]).astype(float) ** 2).sum(axis=1))
    assert (net <= moves.sum(axis=0) + 1e-9).all() and net.sum() < 0.95 * moves.sum()


def test_exact_beyond_doubles():
    x = np.array([[1 << 26, 3], [(1 << 26) + 1, 3], [-(1 << 26), 0]], np.int64)
    assert (vector_codes.distances(x, x, False) == ((x[:, None] - x[None]) ** 2).sum(axis=2)).all()


def test_odd_vectors_are_coded(spark):
    rows = [(5, [1.0, 2.0], 1), (None, [1.0, 2.0], None), (None, [0.0], None), (7, None, 1), (8, [NAN, 1.0], 1), (9, [None, 1.0], 1), (5, [1.0, 2.0], 1), (3, [], None)]
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("clash") for c in ("key", "v", "code", "error", "label_error", "x")})
    coded, books = vector_codes.compress_vectors(frame)
    got = vector_codes.with_label_errors(coded).collect()
    assert sorted((str(r.vec_id), r.label, r.error) for r in got) == [("3", None, 0), ("5", 1, 0), ("5", 1, 0), ("None", None, 0), ("None", None, 0)]
    assert {r.vec_id: r.code for r in got if r.vec_id}[5] == "01010000"
    assert [len(b) for b in books] == [5] * 4
    nothing, none = vector_codes.compress_vectors(frame.where("vec_id > 6"))
    assert vector_codes.with_label_errors(nothing).collect() == [] and none == []
    with pytest.raises(ValueError, match="too large"):
        vector_codes.compress_vectors(spark.createDataFrame([(1, [1e30], 1)], SCHEMA))
