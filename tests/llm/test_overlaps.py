"""Decontamination, line dedup, the Jaccard join and the pipeline against brute force."""

from __future__ import annotations

import itertools
import random
import re

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest

from tablebridge.llm import decontamination, jaccard, lines
from tablebridge.llm.components import components
from tablebridge.llm.filters import bit_filter, passes
from tablebridge.llm.queries import op1_find_contaminated, op2_jaccard_groups, op5_drop_recurring_lines
from tablebridge.llm.words import shingles, words
from tests.conftest import SMALL
from tests.llm.conftest import odd_rows
from tests.llm.conftest import words as prose

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def split(text: str | None, pattern: str = r"[^\x20\x09-\x0D]+") -> list[str]:
    return re.findall(pattern, (text or "").translate(LOWER))


def plain_set(text: str | None, width: int) -> frozenset:
    w = split(text)
    return frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else [])


def plain_groups(texts: list[tuple], width: int, percent: int) -> list[tuple]:
    """(key, set size, smallest key of its group) of every row, all pairs compared."""
    sets = [plain_set(t, width) for _, t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(texts)), 2):
        common = len(sets[i] & sets[j])
        if sets[i] and sets[j] and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
            root[max(find(i), find(j))] = min(find(i), find(j))
    low: dict[int, int] = {}
    for i, (key, _) in enumerate(texts):
        if key is not None:
            low[find(i)] = min(low.get(find(i), key), key)
    return [(key, len(sets[i]), low.get(find(i)) if sets[i] else key) for i, (key, _) in enumerate(texts)]


def variants(seed: int, families: int, each: int, length: int, edits: int) -> list[tuple]:
    rng = random.Random(seed)
    out = []
    for f in range(families):
        base = prose(seed * 1000 + f, length).split()
        for _ in range(each):
            own = list(base)
            for _ in range(rng.randint(0, edits)):
                own[rng.randrange(len(own))] = f"edit{rng.random()}"
            out.append(" ".join(own))
    rng.shuffle(out)
    return list(enumerate(out))


@pytest.mark.parametrize("width,percent", [(3, 90), (5, 80)])
@pytest.mark.parametrize("length,edits", [(12, 1), (60, 4), (400, 12)])
def test_groups_of_variants(spark, width, percent, length, edits):
    texts = variants(length, 6, 25, length, edits)
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    got = sorted(map(tuple, jaccard.jaccard_groups(docs, width, percent).collect()))
    assert got == plain_groups(texts, width, percent)


def test_group_query(spark):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    assert sorted(map(tuple, op2_jaccard_groups(spark, SMALL).collect())) == sorted(plain_groups(texts, 3, 90))


def test_groups_of_odd_rows(odd, none):
    got = sorted(map(tuple, jaccard.jaccard_groups(odd).collect()), key=str)
    assert got == sorted(plain_groups([r[:2] for r in odd_rows()], 3, 90), key=str)
    assert jaccard.jaccard_groups(none).count() == 0
    kept = jaccard.keep_one_of_each(odd)
    assert kept.columns == odd.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=str)
    assert ids == sorted([1, 3, 4, 5, None, None, 6, 7, 8, 9], key=str)
    assert jaccard.keep_one_of_each(none).count() == 0


def test_linked_sets_share_a_key():
    """Whatever is left out or deleted, two sets that link have an entry in common."""
    rng = np.random.default_rng(3)
    for percent in (80, 90):
        bands = jaccard.Bands(percent)
        for size in (9, 10, 40, 130, 700):
            for _ in range(40):
                base = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64) * np.uint64(2))
                swap = rng.integers(0, len(base) * (100 - percent) // 100 + 1)
                other = np.unique(np.concatenate((base[rng.permutation(len(base))[swap:]], rng.integers(0, 1 << 63, rng.integers(0, swap + 1)).astype(np.uint64))))
                common = len(np.intersect1d(base, other))
                if np.array_equal(base, other) or not jaccard.similar(np.array(common), np.array(len(base)), np.array(len(other)), percent):
                    continue
                small, large = sorted((base, other), key=len)
                band = bands.of(np.array([len(small)]))
                assert band[0] in (bands.of(np.array([len(large)]))[0], bands.of(np.array([len(large)]))[0] - 1)
                places = rng.permutation(bands.segments[band[0]])
                swaps = min(len(places) // 2, int(rng.integers(0, 4)))
                codes = (band[0] << 32) + np.sort(places[: 2 * swaps])
                kinds = rng.permutation(np.repeat([-1, 1], swaps))
                found = [jaccard.keys_of(s, np.array([0, len(s)]), band, bands, (codes, kinds)) for s in (small, large)]
                common = set(found[0][1].tolist()) & set(found[1][1].tolist())
                assert len(common) > found[0][2][0] + found[1][2][0]


def test_sketches_never_rule_out_a_link():
    rng = np.random.default_rng(5)
    a = np.unique(rng.integers(0, 1 << 62, 300).astype(np.uint64))
    b = np.unique(np.concatenate((a[20:], rng.integers(0, 1 << 62, 15).astype(np.uint64))))
    x, y = (jaccard.parity_sketches(s, np.array([0, len(s)])) for s in (a, b))
    assert np.unpackbits((x ^ y).view(np.uint8)).sum() <= len(np.setxor1d(a, b))


def test_allocation_trades_dear_segments_for_deletions():
    def costs(third):
        return pa.table({"code": range(5), "band": [0] * 5, "rows": [100] * 5, "elements": [800, 100, 800, 800, 800], "tiny": [0] * 5, **{f"s{j}": [10, 10, 10, third, 10] for j in range(4)}})

    out = jaccard.allocate(costs(95)).to_pydict()
    assert dict(zip(out["code"], out["kind"], strict=True)) == {3: -1, 1: 1}
    assert not len(jaccard.allocate(costs(10)))


def test_components(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(100, 160)] + [(0, i) for i in range(1, 40)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    root: dict[int, int] = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        if a != b:
            root[max(find(a), find(b))] = min(find(a), find(b))
    rng.shuffle(links)
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_filter_misses_nothing(spark):
    rng = np.random.default_rng(6)
    own = rng.integers(-(1 << 63), 1 << 63, 500)
    table = bit_filter(spark.createDataFrame([(int(x),) for x in own], "hash long"), "hash", 16)
    assert len(table) == 1 << 13
    assert len(passes(table, own.view(np.uint64))) == 500
    assert len(passes(table, rng.integers(0, 1 << 63, 5000).astype(np.uint64))) < 50


def test_shingles_are_told_apart():
    texts = ["a b c d", "a b", "", "a b c a b c", "ab c"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    grams, first = shingles(*words(data, offsets), 3)
    seen = {}
    for i, t in enumerate(texts):
        w = t.split()
        own = [tuple(w[j : j + 3]) for j in range(len(w) - 2)] if len(w) >= 3 else [tuple(w)] * bool(w)
        assert len(own) == first[i + 1] - first[i]
        for name, h in zip(own, grams[first[i] : first[i + 1]].tolist(), strict=True):
            assert seen.setdefault(name, h) == h
    assert len(set(seen.values())) == len(seen)


# Decontamination


def plain_contaminated(docs: list[tuple], items: list[tuple], least: int, percent: int) -> dict:
    """Length of the longest overlap of every document with every item, over all shifts, that agrees in `percent` of its places."""
    out = {}
    for d, text in docs:
        a = split(text, r"[0-9a-z\x80-\U0010ffff]+")
        for i, passage in items:
            b = split(passage, r"[0-9a-z\x80-\U0010ffff]+")
            longest = max((plain_longest(a, b, shift, percent) for shift in range(-len(b), len(a))), default=0)
            if len(b) >= decontamination.LEAST_ITEM and longest >= min(least, len(b)):
                out[(d, i)] = longest
    return out


@pytest.mark.parametrize("n", [*range(13, 26), 30])
def test_some_mask_meets_no_substitution(n):
    """Every placement of as many substitutions as 80 percent agreement allows."""
    places = np.array([sum(1 << i for i in c) for c in itertools.combinations(range(n), n // 5)], np.int64)
    for mask in decontamination.MASKS:
        looked = sum(1 << i for i, bit in enumerate(mask) if bit == "1")
        for shift in range(n - len(mask) + 1):
            places = places[places & (looked << shift) != 0]
    assert not len(places)


@pytest.mark.parametrize("n", range(5, 13))
def test_short_items_have_masks_for_all_substitutions(n):
    masks = [{i for i, bit in enumerate(mask) if bit == "1"} for mask in decontamination.short_masks(n)]
    for places in itertools.combinations(range(n), n // 5):
        assert any(not mask & set(places) for mask in masks)


def test_long_copies_are_reported_whole(spark):
    """An item of 1,000 tokens copied from its third token on; one of 8 tokens with a word replaced."""
    item, short = prose(71, 1000).split(), prose(72, 8).split()
    copied = prose(73, 40).split() + item[2:] + prose(74, 700).split()
    changed = prose(75, 30).split() + short[:3] + ["other"] + short[4:]
    docs = spark.createDataFrame([(1, " ".join(copied)), (2, " ".join(changed)), (3, prose(76, 900))], "doc_id long, text string")
    items = spark.createDataFrame([(5, " ".join(item)), (6, " ".join(short))], "item_id long, text string")
    rows = {(r.doc_id, r.item_id): (r.first_token, r.n_matched) for r in decontamination.find_contaminated(docs, items).collect()}
    assert set(rows) == {(1, 5), (2, 6)}
    assert rows[(1, 5)] == (40, 998) and rows[(2, 6)] == (30, 7)


def test_substituted_passages_are_found(spark):
    rng = random.Random(8)
    items = [(i, prose(500 + i, rng.choice([6, 9, 12, 20, 30]))) for i in range(12)] + [(50, "too short"), (51, None), (52, "")]
    docs = []
    for d in range(60):
        body = prose(9000 + d, 30).split()
        if d % 2:
            own = items[d % 12][1].split()
            for _ in range(rng.randint(0, max(0, len(own) // 9))):
                own[rng.randrange(len(own))] = "other"
            own = own[: rng.choice([len(own), 14])]
            at = rng.randrange(len(body))
            body[at:at] = own
        docs.append((d, " ".join(body)))
    got = decontamination.find_contaminated(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string"))
    want = plain_contaminated(docs, [x for x in items if x[1]], 13, 80)
    texts, passages = dict(docs), dict(items)
    found = {(r.doc_id, r.item_id): r for r in got.collect()}
    assert set(found) == set(want)
    for pair, r in found.items():
        a, b = split(texts[pair[0]], r"[0-9a-z\x80-\U0010ffff]+"), split(passages[pair[1]], r"[0-9a-z\x80-\U0010ffff]+")
        places = [sum(x == y for x, y in zip(a[r.first_token : r.first_token + r.n_tokens], b[at : at + r.n_tokens], strict=False)) for at in range(len(b) - r.n_tokens + 1)]
        assert r.n_matched in places and 10 * r.n_matched >= 8 * r.n_tokens
        assert min(13, len(b)) <= r.n_tokens <= want[pair]
    assert len(want) > 15 and all(d % 2 for d, _ in want)


def plain_longest(a: list, b: list, shift: int, percent: int) -> int:
    """Length of the longest overlap at a shift that agrees in `percent` of its places."""
    low, high = max(0, -shift), min(len(b), len(a) - shift)
    equal = [a[j + shift] == b[j] for j in range(low, high)]
    return max((y - x for x in range(len(equal)) for y in range(x + 1, len(equal) + 1) if 100 * sum(equal[x:y]) >= percent * (y - x)), default=0)


def test_longest_overlap_of_any_tokens():
    rng = np.random.default_rng(14)
    for _ in range(300):
        a, b = rng.integers(0, 3, rng.integers(1, 30)), rng.integers(0, 3, rng.integers(1, 30))
        shift = int(rng.integers(-len(b) + 1, len(a)))
        same = rng.random(len(b)) < 0.8
        inside = np.flatnonzero(same & (np.arange(len(b)) + shift >= 0) & (np.arange(len(b)) + shift < len(a)))
        b[inside] = a[inside + shift]
        start, n, equal = decontamination.longest_overlap(a, b, shift)
        assert n == plain_longest(a.tolist(), b.tolist(), shift, 80)
        assert equal == (a[start : start + n] == b[start - shift : start - shift + n]).sum()


def test_substitutions_near_the_ends_are_found(spark):
    """Whole overlaps of 80 percent and more whose substitutions have few equal tokens beyond them."""
    cases = [(16, [3]), (20, [3, 16]), (28, [12, 13, 14, 15]), (13, [0]), (15, [1, 7, 13]), (15, [1, 3, 11, 13])]
    items, docs = [], []
    for i, (n, changed) in enumerate(cases):
        own = prose(7000 + i, n).split()
        items.append((i, " ".join(own)))
        for j in changed:
            own[j] = f"other{j}"
        docs.append((i, " ".join([prose(7100 + i, 40), *own, prose(7200 + i, 40)])))
    got = decontamination.find_contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    found = {r.doc_id: (r.item_id, r.first_token, r.n_tokens, r.n_matched) for r in got.collect()}
    assert {0: (0, 40, 16, 15), 1: (1, 40, 20, 18), 2: (2, 40, 28, 24), 3: (3, 40, 13, 12)}.items() <= found.items()
    assert 5 not in found


def test_contaminated_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    own = {i: " ".join(split(t, r"[0-9a-z\x80-\U0010ffff]+")) for i, t in items}
    whole = {(d, i) for d, t in docs for i, p in own.items() if f" {p} " in f" {' '.join(split(t, r'[0-9a-z\x80-\U0010ffff]+'))} "}
    got = {(r.doc_id, r.item_id) for r in op1_find_contaminated(spark, SMALL).collect()}
    assert whole and whole <= got
    grams = {}
    for i, p in own.items():
        w = p.split()
        for j in range(len(w) - 7):
            grams.setdefault(tuple(w[j : j + 8]), set()).add(i)
    near = {(d, i) for d, t in docs for w in [split(t, r"[0-9a-z\x80-\U0010ffff]+")] for j in range(len(w) - 7) for i in grams.get(tuple(w[j : j + 8]), ())}
    assert got <= near


def test_contaminated_odd_rows(spark, odd, none):
    items = spark.createDataFrame([(1, prose(2, 60)), (2, prose(2, 60)), (None, prose(3, 40)), (3, None), (4, "")], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontamination.find_contaminated(odd, items).collect()}
    assert got == {(1, 1), (2, 1), (10, 1), (None, None)}
    kept = decontamination.drop_contaminated(odd, items)
    assert kept.columns == odd.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([3, 4, 5, None, 6, 7, 8, 9], key=str)
    assert decontamination.find_contaminated(none, items).count() == 0
    assert decontamination.find_contaminated(odd, items.limit(0)).count() == 0
    assert decontamination.drop_contaminated(odd, items.limit(0)).count() == odd.count()


# Line dedup


def plain_dropped(docs: list[tuple]) -> dict:
    """Dropped lines by key: templates grown line by line within each leaf, in order of the lines' hashes."""
    data = np.frombuffer("".join(t or "" for _, t in docs).encode(), np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len((t or "").encode()) for _, t in docs])))
    p = lines.parse_lines(data, offsets)
    found = []
    for k in range(len(p["text"])):
        tokens = tuple(p["tokens"][p["first"][k] : p["first"][k] + p["n"][k]].tolist())
        if len(tokens) >= lines.LEAST_TOKENS:
            found.append((docs[p["text"][k]][0], int(p["line"][k]), tokens, int(p["print"][k : k + 1].view(np.int64)[0])))
    leaves: dict = {}
    for _, _, tokens, mark in found:
        leaves.setdefault((len(tokens), tokens[: lines.DEPTH]), {})[mark] = tokens
    template = {}
    for (n, _), own in leaves.items():
        grown: list[list] = []
        for mark, tokens in sorted(own.items()):
            scores = [sum(x == y for x, y in zip(t, tokens, strict=True)) for t, _ in grown]
            best = max(range(len(grown)), key=lambda i: (scores[i], -i), default=None)
            if n >= lines.LEAST_VARIABLE and best is not None and scores[best] >= np.ceil(lines.AGREEMENT * n):
                grown[best][0] = [x if x == y else None for x, y in zip(grown[best][0], tokens, strict=True)]
            else:
                best = len(grown)
                grown.append([list(tokens), mark])
            template[mark] = (n, tokens[: lines.DEPTH], grown[best][1])
    groups: dict = {}
    for d, i, _, mark in found:
        groups.setdefault(template[mark], []).append((d, i))
    gone: dict = {d: [] for d, _ in docs}
    for own in groups.values():
        if len({d for d, _ in own}) > 1:
            for d, i in sorted(own)[1:]:
                gone[d].append(i)
    return {d: sorted(x) for d, x in gone.items()}


def test_line_query(spark):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect())
    want = plain_dropped(docs)
    rows = op5_drop_recurring_lines(spark, SMALL).collect()
    assert {r.doc_id: r.dropped for r in rows} == want
    texts = dict(docs)
    for r in rows:
        assert r.text == "\n".join(x for i, x in enumerate(texts[r.doc_id].split("\n")) if i not in set(want[r.doc_id]))
    assert any(want.values())


def test_variable_fields(spark):
    docs = [
        (1, "request 17 took 3 ms\nonly here are these words said\ntoday the user alice has signed in from the office\nok"),
        (2, "request 99 took 8 ms\nok\ntoday the user bob has signed in from the office"),
        (3, "ok\ntoday the user carol has gone out of her own home\nquite another thing to say"),
        (4, "request 5 took 1 ms"),
    ]
    rows = lines.drop_recurring_lines(spark.createDataFrame(docs, "doc_id long, text string"), dropped="gone").collect()
    assert {r.doc_id: r.gone for r in rows} == {1: [], 2: [0, 2], 3: [], 4: [0]} == plain_dropped(docs)
    assert {r.doc_id: r.text for r in rows}[4] == ""


def test_large_leaves_are_brought_together(spark, monkeypatch):
    monkeypatch.setattr(lines, "LEAF_ROWS", 8)
    base = prose(77, 40).split()
    docs = [(d, " ".join([*base[:20], f"w{d}x".replace("1", "one"), *base[21:]])) for d in range(60)]
    rows = lines.drop_recurring_lines(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), dropped="gone").collect()
    assert sum(bool(r.gone) for r in rows) >= 57


def test_pairs_of_a_large_leaf_all_meet(spark, monkeypatch):
    """Many lines of one leaf that pair off: each pair shares a template, whichever pieces its lines are dealt to."""
    monkeypatch.setattr(lines, "LEAF_ROWS", 8)
    docs = []
    for d in range(60):
        body = prose(4000 + d, 12).split()
        docs += [(2 * d, " ".join(["at", "5", "on", *body, "left"])), (2 * d + 1, " ".join(["at", "7", "on", *body[:d % 12], "changed", *body[d % 12 + 1 :], "right"]))]
    rows = lines.drop_recurring_lines(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), dropped="gone").collect()
    assert {r.doc_id: r.gone for r in rows} == plain_dropped(docs) == {d: [0] * (d % 2) for d, _ in docs}


def test_templates_that_agree_share_a_key():
    rng = np.random.default_rng(12)
    for n in (*range(lines.LEAST_VARIABLE, 34), 60, 150):
        most = n - lines.need_of(n)
        assert len(lines.segments_of(n)[1]) <= max(lines.MOST_KEYS, most + 1)
        for _ in range(30):
            a = rng.integers(1, 65536, n).astype("<u2")
            b = a.copy()
            bad = lines.DEPTH + rng.permutation(n - lines.DEPTH)[:most]
            b[bad] = rng.integers(0, 2, most) * rng.integers(1, 65536, most)
            rows, keys = lines.template_keys(np.stack([a, b]), np.array([7, 7], np.uint64))
            assert set(keys[rows == 0].tolist()) & set(keys[rows == 1].tolist())


def test_line_odd_rows(odd, none):
    cleaned = lines.drop_recurring_lines(odd, dropped="gone")
    rows = cleaned.collect()
    assert cleaned.columns == [*odd.columns, "gone"]
    assert len(rows) == len(odd_rows())
    assert [r.gone for r in sorted(rows, key=lambda r: str(r.doc_id)) if r.doc_id == 2] == [[0], [0]]
    assert {r.doc_id: (r.text, r.n_chars) for r in rows}[2] == ("", 0)
    assert sum(r.text is None for r in rows) == 2
    assert lines.drop_recurring_lines(none).count() == 0


# The pipeline


def test_stages_follow_from_one_another(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    before = docs
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, before, SMALL)
        out.write.parquet(f"{tmp_path}/{name}")
        after = spark.read.parquet(f"{tmp_path}/{name}")
        if i + 1 < len(corpus_pipeline.STAGES):
            assert after.columns == docs.columns
            assert after.count() <= before.count()
        if name == "near_duplicates":
            texts = [(r.doc_id, r.text) for r in before.collect()]
            groups = plain_groups(texts, 5, 80)
            assert {r.doc_id for r in after.collect()} == {low for _, _, low in groups}
        if name == "decontamination":
            gone = {r.doc_id for r in before.collect()} - {r.doc_id for r in after.collect()}
            found = decontamination.find_contaminated(before, spark.read.parquet(f"{SMALL}/benchmark.parquet"))
            assert gone == {r.doc_id for r in found.collect()}
        before = after
    assert sorted(map(str, corpus_pipeline.run(spark, SMALL).select("doc_id", "piece", "start", "length", "ids_crc32").collect())) == sorted(map(str, before.select("doc_id", "piece", "start", "length", "ids_crc32").collect()))


def test_pipeline_of_odd_rows(spark, odd, tmp_path):
    labels = spark.createDataFrame([(1, 1), (6, 1), (7, 1), (8, 1)], "doc_id long, quality int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "nothing of that is in any of them")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    before = odd
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before = stage(spark, before, str(tmp_path))
        assert before.columns == odd.columns
    assert corpus_pipeline.packing(spark, before, str(tmp_path)).count() > 0
