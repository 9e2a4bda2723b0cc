"""Periodic runs against a search of all periods."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from tablebridge.llm import runs
from tablebridge.llm.queries import op11_collapse_runs
from tests.conftest import SMALL
from tests.llm.conftest import odd_rows, words

SCHEMA = "doc_id long, text string"


def plain_runs(w: list, least: int = 12) -> list[tuple]:
    """(start, period, length) of every run, from the stretches in which words of each distance agree."""
    ids = {x: i for i, x in enumerate(dict.fromkeys(w))}
    x = np.array([ids[y] for y in w], np.int64)
    found: dict[tuple, int] = {}
    for p in range(1, len(x) // 2 + 1):
        same = np.concatenate(([False], x[:-p] == x[p:], [False])).astype(np.int8)
        turns = np.flatnonzero(np.diff(same))
        for start, stop in zip(turns[::2], turns[1::2], strict=True):
            if stop - start + p >= max(least, 2 * p):
                found.setdefault((int(start), int(stop + p)), p)  # the smallest period comes first
    return sorted((s, p, e - s) for (s, e), p in found.items())


def plain_collapsed(w: list, found: list[tuple]) -> str:
    gone = {i for s, p, n in found for i in range(s + p, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def planted(doc_id: int | None, w: list) -> list:
    if doc_id is None or not w:
        return w
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10:
        return w
    a = g % len(w)
    p = 1 + (len(w) - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]


def fibonacci(n: int) -> str:
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def made_texts() -> list[tuple]:
    rng = random.Random(4)
    texts = ["", "x", " ".join(fibonacci(200)), "a " * 150, "a b " * 70 + "a", " \n".join(fibonacci(90))]
    for _ in range(60):
        w = [rng.choice("abcde"[: rng.choice([1, 2, 2, 3, 5])]) for _ in range(rng.choice([1, 11, 12, 13, 40, 90]))]
        if rng.random() < 0.6:
            w = (w[: rng.randint(1, len(w))] * 6)[:160]
        texts.append(rng.choice([" ", "\n", " \t "]).join(w))
    return [(i, t) for i, t in enumerate(texts)]


# Tiles of a few words cut every run into fragments.
@pytest.mark.parametrize(("tile", "batch"), [(4096, 1 << 18), (32, 1 << 18), (20, 90)])
def test_runs_of_made_texts(spark, monkeypatch, tile, batch):
    monkeypatch.setattr(runs, "TILE", tile)
    monkeypatch.setattr(runs, "BATCH", batch)
    w = {i: t.split() for i, t in made_texts()}
    own = [runs.mix(np.array([ord(x) for x in w[i]], np.uint64)) for i in w]
    first = np.concatenate(([0], np.cumsum([len(x) for x in own])))
    found: dict[tuple, set] = {}
    for doc, period, start, end in runs.fragments(np.concatenate(own), first):
        for d, p, s, e in zip(doc, period, start, end, strict=True):
            found.setdefault((int(d), int(p)), set()).add((int(s), int(e)))
    stitched = []
    for (d, p), parts in found.items():
        islands: list[list[int]] = []
        for s, e in sorted(parts):
            if islands and islands[-1][1] - s >= p:
                islands[-1][1] = max(islands[-1][1], e)
            else:
                islands.append([s, e])
        stitched += [(d, s, p, e - s) for s, e in islands]
    assert sorted(stitched) == sorted((i, *run) for i in w for run in plain_runs(w[i]))
    assert any(p > 20 for _, _, p, _ in stitched)


def test_collapsed_texts(spark):
    texts = made_texts()
    got = {r.doc_id: r for r in runs.collapse_runs(spark.createDataFrame(texts, SCHEMA).repartition(3)).collect()}
    assert len(got) == len(texts)
    for i, t in texts:
        want = plain_runs(t.split())
        assert [tuple(x) for x in got[i].runs] == want
        assert got[i].collapsed == plain_collapsed(t.split(), want)


def test_long_text_of_many_tiles(spark):
    """Fragments from several tasks' rows and tiles meet in one run, beside a run of a large period."""
    unit = words(5, 3000).split()
    w = words(6, 7000).split() + unit * 3 + unit[:100] + ["ha"] * 9000 + words(7, 500).split()
    copies = spark.createDataFrame([(i, " ".join(w)) for i in range(5)], SCHEMA).repartition(5)
    rows = runs.collapse_runs(copies).collect()
    want = [(7000, 3000, 9100), (16100, 1, 9000)]
    assert len(rows) == 5
    for row in rows:
        assert [tuple(x) for x in row.runs] == want
        assert row.collapsed == plain_collapsed(w, want)


def test_query_against_all_periods(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = {r.doc_id: r for r in op11_collapse_runs(spark, SMALL).collect()}
    assert set(got) == set(docs)
    for doc_id, text in docs.items():
        w = planted(doc_id, (text or "").encode().split())
        w = [x.decode() for x in w]
        found = plain_runs(w)
        best = max(found, key=lambda r: (r[2], -r[0], -r[1]), default=None)
        s, p, n = best or (None, None, None)
        listed = "".join(f"{a},{c},{b}\n" for a, b, c in found)
        row = got[doc_id]
        assert (row.n_runs, row.start, row.length, row.period) == (len(found), s, n, p)
        assert row.exponent_milli == (1000 * n // p if best else None)
        assert row.runs_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(plain_collapsed(w, found).encode()).hexdigest()
    assert sum(r.n_runs > 0 for r in got.values()) > 5


def test_odd_rows(odd, none):
    rows = runs.run_digests(runs.collapse_runs(runs.plant_runs(odd))).collect()
    assert len(rows) == len(odd_rows())
    empty = hashlib.sha256(b"").hexdigest()
    for row in rows:
        if row.doc_id in (3, 4, 5):
            assert (row.n_runs, row.start, row.runs_sha256, row.collapsed_sha256) == (0, None, empty, empty)
    assert runs.collapse_runs(none).collect() == []
    assert runs.run_digests(runs.collapse_runs(none)).columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
