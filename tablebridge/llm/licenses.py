"""License scans: notice phrases and identifier tags by Aho-Corasick, expressions by a shunting yard."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Phrases that contracts name, and their labels (fixed values).
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

#: Further notices, in the words of the license texts, and their labels.
NOTICES = {
    "gnu general public license version 2": "gpl-2",
    "gnu general public license version 3": "gpl-3",
    "gnu general public license v2": "gpl-2",
    "gnu general public license v3": "gpl-3",
    "gnu general public license as published by the free software foundation version 2": "gpl-2",
    "gnu general public license as published by the free software foundation version 3": "gpl-3",
    "gnu general public license as published by the free software foundation either version 2": "gpl-2",
    "gnu general public license as published by the free software foundation either version 3": "gpl-3",
    "gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "redistribution and use in source and binary forms": "bsd",
    "permission is hereby granted free of charge to any person": "mit",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution sharealike": "cc-by-sa",
    "creative commons attribution noderivatives": "cc-by-nd",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "dedicated to the public domain": "public-domain",
    "all rights reserved": "proprietary",
}

#: What is left if nothing but reserved rights is stated.
RESERVED = "proprietary"

TAG = "spdx license identifier"

#: How far a license binds whoever uses the text, by the start of its label; the longest start counts.
BINDING = {
    "mit": 0.25, "bsd": 0.25, "apache": 0.25, "isc": 0.25, "zlib": 0.25, "cc-by": 0.25, "cc0": 0.1, "public-domain": 0.1, "unlicense": 0.1,
    "lgpl": 0.5, "mpl": 0.5, "epl": 0.5, "gpl": 0.75, "agpl": 0.85, "cc-by-sa": 0.75, "cc-by-nc": 1.0, "cc-by-nd": 1.0, "proprietary": 1.0,
}
UNKNOWN = 0.5
#: What an exception leaves of a license's binding.
WITH_EXCEPTION = 0.8

_RANK = {"or": 1, "and": 2, "with": 3}
_TOKEN = re.compile(r"[ \t]*([()]|[A-Za-z0-9.+:-]+)")
_TAG_TEXT = re.compile(r"spdx-license-identifier:", re.IGNORECASE | re.ASCII)

#: Bytes of words: digits, lower-cased letters and all beyond ASCII; the rest parts words.
_WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def label(identifier: str) -> str:
    """A license identifier without the parts that only tell editions apart."""
    name = identifier.lower().rstrip("+")
    for ending in ("-only", "-or-later"):
        name = name.removesuffix(ending)
    name = re.sub(r"^(cc-by[a-z-]*)-[0-9.]+$", r"\1", name)
    return re.sub(r"-([0-9]+)\.0$", r"-\1", name)


def binding(name: str) -> float:
    fits = [k for k in BINDING if name == k or name.startswith(f"{k}-")]
    return BINDING[max(fits, key=len)] if fits else UNKNOWN


def parse(text: str, at: int = 0, end: int | None = None) -> list[str]:
    """A license expression in postfix order: the longest one that `text` begins with from `at` on, else nothing.

    WITH binds closest, then AND, then OR; parentheses group.
    """
    out: list[str] = []
    stack: list[str] = []
    best: list[str] = []
    operand, end = True, len(text) if end is None else end
    while m := _TOKEN.match(text, at, end):
        token, at = m[1], m.end()
        kind = token.lower()
        if operand:
            if token == "(":
                stack.append(token)
                continue
            if token == ")" or kind in _RANK:
                break
            out.append(token)
            operand = False
        elif kind in _RANK:
            while stack and stack[-1] != "(" and _RANK[stack[-1]] >= _RANK[kind]:
                out.append(stack.pop())
            stack.append(kind)
            operand = True
            continue
        elif token == ")":
            while stack and stack[-1] != "(":
                out.append(stack.pop())
            if not stack:
                break
            stack.pop()
        else:
            break
        if "(" not in stack:
            best = out + stack[::-1]
    return best


def evaluate(postfix: list[str]) -> tuple[set[str], float]:
    """Labels of an expression, and how far it binds: OR lets one choose, AND demands both."""
    values: list[tuple[set[str], float]] = []
    for token in postfix:
        if token not in _RANK:
            values.append(({label(token)}, binding(label(token))))
            continue
        (more, y), (labels, x) = values.pop(), values.pop()
        if token == "with":
            values.append((labels, x * WITH_EXCEPTION))
        else:
            values.append((labels | more, min(x, y) if token == "or" else max(x, y)))
    return values[0] if values else (set(), 0.0)


@lru_cache(maxsize=1)
def automaton():
    """One automaton of all phrases, with a blank on either side so that only whole words match."""
    import ahocorasick

    found = ahocorasick.Automaton()
    for phrase in {*BASE_PHRASES, *NOTICES, TAG}:
        found.add_word(f" {phrase} ", phrase)
    found.make_automaton()
    return found


def scan(raw: bytes) -> tuple[int, int, int | None, int | None, str, str, float]:
    """What `scan_licenses` returns of one text in UTF-8."""
    words = raw.translate(_WORD_BYTES).split()
    line = (b" " + b" ".join(words) + b" ").decode("latin-1")
    base: set[str] = set()
    labels: set[str] = set()
    starts: list[int] = []
    tagged = False
    for end, phrase in automaton().iter(line):
        if phrase in BASE_PHRASES:
            starts.append(end - len(phrase))
            base.add(BASE_PHRASES[phrase])
        elif phrase == TAG:
            tagged = True
        else:
            labels.add(NOTICES[phrase])
    named: set[str] = set()
    score = 0.0
    if tagged:
        text = raw.decode("utf-8", "replace")
        end = -1
        for m in _TAG_TEXT.finditer(text):
            if end < m.end():  # the line's end, looked for once a line
                end = text.find("\n", m.end())
                end = len(text) if end < 0 else end
            names, bound = evaluate(parse(text, m.end(), end))
            named |= names
            score = max(score, bound)
    if len(base | labels | named) > 1:
        labels.discard(RESERVED)  # the usual closing line of a license says no more than that
    score = max(score, max(map(binding, base | labels), default=0.0))
    labels |= base | named
    # The word that starts at a place: as many as there are blanks before it.
    places = np.searchsorted(np.flatnonzero(np.frombuffer(line.encode("latin-1"), np.uint8) == 32), starts).tolist() if starts else []
    places = [place - 1 for place in places]
    if any(x.startswith("gpl-") for x in labels):
        labels.discard("gpl")
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), score


def scan_licenses(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """License notices and tags of each text.

    One row per row of `docs`, repeated rows included: key, n_words, n_base (places of base
    phrases), first_word and last_word (their smallest and largest start, else null), base_labels,
    labels (all, sorted, comma-joined) and score: 0 without any license, else how far the most
    binding statement binds, up to 1. A null text counts as empty: no words, no labels, score 0.
    A null key stays null. Other columns are not read. An empty table gives an empty result.
    """
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [scan(x.as_buffer().to_pybytes() if x.is_valid else b"") for x in batch.column(1)]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 7
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], [key, *names])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")
