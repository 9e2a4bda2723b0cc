"""Token counts and packing against the library itself."""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tablebridge.llm.bytebpe import UNASSIGNED, Vocabulary, char_classes, prove_whole_tokens
from tablebridge.llm.packing import cut, fullest, pack_documents, pack_lengths, sequences
from tablebridge.llm.queries import op3_pack, op7_count_tokens, vocabulary_path
from tablebridge.llm.token_counts import count_tokens
from tests.conftest import SMALL
from tests.llm.conftest import odd_rows


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary_path())


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary(vocabulary_path())


def same(vocabulary, library, texts):
    counts, ids = [], []
    for _, _, c, i in vocabulary.encode(pa.array(texts, pa.string())):
        counts += c.tolist()
        ids += i.tolist()
    own = [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert counts == [len(x) for x in own]
    assert ids == [i for x in own for i in x]


def test_odd_texts(vocabulary, library):
    same(vocabulary, library, [r[1] for r in odd_rows()])
    same(vocabulary, library, ["it's 'll I'LL ''s x's'd", "a  b\n\n c \n", "　x y\u0085", "12a½ ٣", "ᲉꟋ unassigned", "'", " '", "'s", "s"])
    same(vocabulary, library, [])


@settings(max_examples=150, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(st.text(alphabet=st.one_of(st.sampled_from("ab 'sdmtlvre\n\t.,12"), st.characters(exclude_categories=("Cs",))), max_size=60), max_size=6))
def test_any_text(vocabulary, library, texts):
    same(vocabulary, library, texts)


def test_classes_agree_with_the_library(library):
    """Each assigned code point joins the neighbours that the library lets it join."""
    table, split = char_classes(), library.pre_tokenizer
    shapes = {((0, 2), (2, 3), (3, 4), (4, 5)): 1, ((0, 1), (1, 4), (4, 5)): 2, ((0, 1), (1, 2), (2, 3), (3, 5)): 0}
    for c in [*range(1, 0x3000), *range(0xA000, 0xAC00), *range(0xF900, 0x10000), *range(0x10000, 0x11000)]:
        if table[c] != UNASSIGNED:
            spans = tuple(s for _, s in split.pre_tokenize_str(f"a{chr(c)}1{chr(c)}."))
            assert shapes.get(spans, 3) == table[c], hex(c)


def test_whole_tokens_are_proven(library):
    keys, ids = prove_whole_tokens(vocabulary_path())
    assert len(set(keys.tolist())) == len(keys) > 40_000
    for i in ids[::997].tolist():
        assert library.encode(library.decode([i]), add_special_tokens=False).ids == [i]


def test_counts_of_odd_rows(odd, none, library):
    got = sorted(count_tokens(odd, vocabulary_path(), limit=5).collect(), key=str)
    want = []
    for row in odd_rows():
        n = len(library.encode(row[1] or "", add_special_tokens=False).ids)
        want.append((row[0], len((row[1] or "").encode()), n, n > 5))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert count_tokens(none, vocabulary_path()).count() == 0


def test_count_query(spark, library):
    texts = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = {(d, len(t.encode()), len(i), len(i) > 1024) for d, t in texts for i in [library.encode(t, add_special_tokens=False).ids]}
    assert set(map(tuple, op7_count_tokens(spark, SMALL).collect())) == want


def test_cut():
    assert cut(1, 10) == [(0, 1)]
    assert cut(10, 10) == [(0, 10)]
    assert cut(11, 10) == [(0, 1), (1, 10)]
    assert cut(30, 10) == [(0, 10), (10, 10), (20, 10)]


def test_fullest_is_the_best_subset():
    rng = np.random.default_rng(1)
    for _ in range(60):
        lengths = rng.integers(1, 30, 9)
        kinds, counts = np.unique(lengths, return_counts=True)
        room = int(rng.integers(1, 90))
        best = max(s for m in range(512) if (s := int(lengths[[m >> i & 1 == 1 for i in range(9)]].sum())) <= room)
        chosen = fullest(kinds[::-1].tolist(), dict(zip(kinds.tolist(), counts.tolist(), strict=True)), room)
        assert sum(chosen) == best
        assert all(chosen.count(k) <= c for k, c in zip(kinds, counts, strict=True))


def test_packs_close_to_the_least():
    rng = np.random.default_rng(2)
    lengths = rng.integers(1, 2049, 4000)
    sequence, offset = pack_lengths(lengths, 2048)
    used = np.bincount(sequence, weights=lengths)
    assert used.max() <= 2048
    assert len(used) <= np.ceil(lengths.sum() / 2048) * 1.02
    for s in range(0, len(used), 97):
        own = np.flatnonzero(sequence == s)
        own = own[np.argsort(offset[own])]
        assert offset[own].tolist() == np.concatenate(([0], np.cumsum(lengths[own])[:-1])).tolist()


def laid(rows, texts, library, capacity):
    """Check every piece against the library and every sequence for gaps; returns the number of sequences."""
    pieces, places = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        places[r.sequence_id].append((r.offset, r.length))
    for key, own in texts.items():
        ids = np.array([*library.encode(own or "", add_special_tokens=False).ids, 0], "<u4")
        parts = sorted(pieces.pop(key), key=lambda r: r.piece)
        assert [(r.start, r.length) for r in parts] == cut(len(ids), capacity)
        assert [r.piece for r in parts] == list(range(len(parts)))
        assert [r.ids_crc32 for r in parts] == [zlib.crc32(ids[r.start : r.start + r.length].tobytes()) for r in parts]
    assert not pieces
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places)


def test_pack_query(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = op3_pack(spark, SMALL).collect()
    used = laid(rows, texts, library, 2048)
    assert used <= np.ceil(sum(r.length for r in rows) / 2048) + 1


def test_pack_odd_rows(odd, none, library):
    plain = odd.where("doc_id is not null and doc_id <> 2")
    laid(pack_documents(plain, vocabulary_path(), capacity=64, group_rows=4).collect(), {r[0]: r[1] for r in odd_rows() if r[0] not in (None, 2)}, library, 64)
    everything = pack_documents(odd, vocabulary_path(), with_ids=True)
    assert sum(r.length for r in everything.collect()) == sum(len(library.encode(r[1] or "", add_special_tokens=False).ids) + 1 for r in odd_rows())
    for r in sequences(everything).collect():
        assert 0 < len(r.ids) <= 2048
    assert pack_documents(none, vocabulary_path()).count() == 0
