"""Byte-level BPE over Arrow text columns: pre-tokens by numpy, merges once per distinct pre-token.

The pre-tokenizer's pattern splits a text by character classes, which numpy does
for a megabyte at a time. Each distinct pre-token is then looked up by hash: first
among the vocabulary's whole tokens, then among those merged before. Only what
is left goes to the library.
"""

from __future__ import annotations

import os
import sys
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa

from tablebridge.llm.words import chunks, span_hashes

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

LETTER, NUMBER, SPACE, UNASSIGNED, OTHER = 1, 2, 3, 4, 0
#: Entries of merged pre-tokens that a worker keeps; the cache starts afresh beyond it.
CACHE_ENTRIES = 1 << 20

#: Characters of the Unicode property White_Space (fixed values).
WHITE_SPACE = [9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


@lru_cache(maxsize=1)
def char_classes() -> np.ndarray:
    """Class of each code point: letter, number, white space, other, or not assigned.

    The library may know a later Unicode version than Python, so texts with code points
    that Python has as unassigned are left to it.
    """
    kinds = {"L": LETTER, "N": NUMBER, "Cn": UNASSIGNED}
    found = (unicodedata.category(chr(c)) for c in range(sys.maxunicode + 1))
    table = np.fromiter((kinds.get(k, kinds.get(k[0], OTHER)) for k in found), np.uint8, sys.maxunicode + 1)
    table[WHITE_SPACE] = SPACE
    return table


def pre_tokens(points: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Starts of the pre-tokens of texts given as code points; each text starts one."""
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    kind = char_classes()[points]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    edge[n] = True
    start = edge[:n].copy()
    start[1:] |= kind[1:] != kind[:-1]
    space = kind == SPACE
    # A blank before anything but white space belongs to what follows, if it is a plain one; else it stands alone.
    last = np.zeros(n, dtype=bool)
    last[:-1] = space[:-1] & ~space[1:] & ~edge[1:n]
    at = np.flatnonzero(last)
    start[at] = True
    joined = at[points[at] == 32] + 1
    start[joined] = False
    # Contractions: an apostrophe that begins a run of its own takes the letters of its ending.
    mark = np.flatnonzero((points == 39) & start)
    for ending in ("s", "d", "m", "t", "ll", "ve", "re"):
        k = len(ending)
        here = mark[mark + k < n]
        fits = np.ones(len(here), dtype=bool)
        for j, letter in enumerate(ending, 1):
            fits &= (points[here + j] == ord(letter)) & ~edge[here + j]
        here = here[fits]
        start[here + 1] = False
        after = here + k + 1
        after = after[after < n]
        start[after[kind[after] == LETTER]] = True
    return np.flatnonzero(start)


class Vocabulary:
    """Token ids of texts as the library gives them for one tokenizer file."""

    def __init__(self, path: str, whole: tuple[np.ndarray, np.ndarray] | None = None) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.whole_keys, self.whole_ids = whole if whole is not None else prove_whole_tokens(path)
        self._reset()

    def _reset(self) -> None:
        """Keys of known pre-tokens in order, where their ids begin in `flat`, and how many they are."""
        self.keys, self.begin, self.size = self.whole_keys, np.arange(len(self.whole_ids)), np.ones(len(self.whole_ids), np.int64)
        self.flat = self.whole_ids.astype(np.uint32)

    def _learn(self, keys: np.ndarray, pieces: list[str]) -> None:
        """Merge pre-tokens that are not known yet; keys are in order."""
        if len(self.keys) > CACHE_ENTRIES + len(self.whole_keys):
            self._reset()
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        begin = len(self.flat) + np.concatenate(([0], np.cumsum(size)[:-1])).astype(np.int64)
        self.flat = np.concatenate((self.flat, np.fromiter((i for x in ids for i in x), np.uint32, int(size.sum()))))
        at = np.searchsorted(self.keys, keys)
        self.keys, self.begin, self.size = np.insert(self.keys, at, keys), np.insert(self.begin, at, begin), np.insert(self.size, at, size)

    def _known(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return at, self.keys[at] == keys

    def _chunk(self, data: np.ndarray, offsets: np.ndarray, want_ids: bool) -> tuple[np.ndarray, np.ndarray]:
        """Counts of ids of each text, and the ids of all texts."""
        text = data.tobytes().decode("utf-8", "replace")
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        lead = np.zeros(len(data) + 1, np.int64)
        np.cumsum((data & 0xC0) != 0x80, out=lead[1:])
        if (char_classes()[points] == UNASSIGNED).any():
            return self._library(data, offsets)
        offsets = lead[offsets]
        starts = pre_tokens(points, offsets)
        ends = np.append(starts[1:], len(points))
        distinct, first, which = np.unique(span_hashes(points, starts, ends), return_index=True, return_inverse=True)
        at, known = self._known(distinct)
        if not known.all():
            rare = first[~known]
            self._learn(distinct[~known], [text[a:b] for a, b in zip(starts[rare], ends[rare], strict=True)])
            at, _ = self._known(distinct)
        size = self.size[at][which]
        total = np.concatenate(([0], np.cumsum(size)))
        counts = np.diff(total[np.searchsorted(starts, offsets)])
        if not want_ids:
            return counts, np.zeros(0, np.uint32)
        begin = self.begin[at][which]
        return counts, self.flat[np.repeat(begin - total[:-1], size) + np.arange(total[-1])]

    def _library(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As `_chunk`, by the library alone."""
        texts = [data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        own = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.fromiter(map(len, own), np.int64, len(own)), np.fromiter((i for x in own for i in x), np.uint32)

    def encode(self, column: pa.Array, want_ids: bool = True):
        """Yield (first row, row after the last, counts of ids of each text, ids of these texts)."""
        special = [s.encode() for s in self.specials]
        for a, b, data, offsets in chunks(column):
            raw = data.tobytes()
            if any(s in raw for s in special):
                # The library finds special tokens before it splits; such texts are its own to encode.
                yield a, b, *self._library(data, offsets)
            else:
                yield a, b, *self._chunk(data, offsets, want_ids)


def prove_whole_tokens(path: str) -> tuple[np.ndarray, np.ndarray]:
    """Keys and ids of the vocabulary strings that, encoded alone, give just their own token.

    Each entry that is text (not a part of a character) is given to the library;
    only those that come back as the one id they stand for are kept.
    """
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    specials = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    texts, ids = [], []
    for i in range(tokenizer.get_vocab_size(with_added_tokens=False)):
        text = tokenizer.decode([i], skip_special_tokens=False)
        if text and "�" not in text and text not in specials:
            texts.append(text)
            ids.append(i)
    whole = [(t, i) for t, i, e in zip(texts, ids, tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True) if e.ids == [i]]
    points = np.frombuffer("".join(t for t, _ in whole).encode("utf-32-le"), dtype=np.uint32)
    ends = np.cumsum([len(t) for t, _ in whole])
    keys = span_hashes(points, np.concatenate(([0], ends[:-1])), ends)
    order = np.argsort(keys)
    return keys[order], np.array([i for _, i in whole], dtype=np.uint32)[order]


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """One vocabulary per worker and file."""
    return Vocabulary(path)
