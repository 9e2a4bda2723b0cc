"""Words of Arrow text columns as 64-bit numbers, many texts at a time.

A text column arrives in a task as one buffer of bytes with offsets. Words are
found and hashed on that buffer with numpy, so no text becomes a Python string.
Work goes on in chunks of about half a megabyte of whole texts, which bounds memory.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 19
#: Gives free memory back to the system, where the C library can.
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)
_RADIX = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_RADIX), -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}

#: ASCII letters in lower case, all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes of words between blanks: everything but \x20 and \x09-\x0D.
NOT_BLANK = np.ones(256, dtype=bool)
NOT_BLANK[[9, 10, 11, 12, 13, 32]] = False


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads close numbers far apart."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the hash's radix, and of its inverse, modulo 2**64."""
    if "up" not in _powers or len(_powers["up"]) < n:
        size = max(n, CHUNK_BYTES + 1)
        for name, base in (("up", _RADIX), ("down", _INVERSE)):
            table = np.full(size, base, dtype=np.uint64)
            table[0] = 1
            _powers[name] = np.multiply.accumulate(table)
    return _powers["up"], _powers["down"]


def span_hashes(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of symbols[start:end] for each span, equal wherever the content is equal."""
    up, down = powers(len(symbols) + 1)
    total = np.zeros(len(symbols) + 1, dtype=np.uint64)
    np.cumsum((symbols.astype(np.uint64) + np.uint64(1)) * up[: len(symbols)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts])


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text column and the offsets of its texts; null texts are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + n + 1] if n else np.zeros(1, np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data, offsets


def chunks(column: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets from 0) of runs of whole texts of about `size` bytes."""
    data, offsets = text_buffer(column)
    at, n = 0, len(offsets) - 1
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1
        to = min(max(to, at + 1), n)
        yield at, to, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to
    # Workers live on and keep what their allocators hold; what earlier batches took goes back.
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def word_spans(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray = NOT_BLANK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of all texts, and the place of each text's first word among them."""
    n = len(data)
    inside = is_word[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    before = np.empty(n, dtype=bool)
    if n:
        before[0] = False
        before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:n]))
    after = np.empty(n, dtype=bool)
    if n:
        after[-1] = False
        after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def words(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray = NOT_BLANK) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of all texts, and the place of each text's first word among them."""
    starts, ends, first = word_spans(data, offsets, is_word)
    return span_hashes(LOWER[data], starts, ends), first


def shingles(hashes: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `width` words within texts, in order, and the place of each text's first.

    A text with fewer words, but at least one, has its whole sequence as one shingle.
    """
    n = np.diff(first)
    count = np.where(n >= width, n - width + 1, np.minimum(n, 1))
    place = np.concatenate(([0], np.cumsum(count)))
    start = np.repeat(first[:-1] - place[:-1], count) + np.arange(place[-1])
    length = np.repeat(np.minimum(n, width), count)
    out = np.zeros(place[-1], dtype=np.uint64)
    padded = np.concatenate((hashes, np.zeros(width, np.uint64)))
    for k in range(width):
        part = padded[start + k]
        if k:
            part = np.where(length > k, part, np.uint64(0))
        out = mix(out * np.uint64(0xD6E8FEB86659FD93) + part + np.uint64(k + 1))
    return out, place


def signed(x: np.ndarray) -> np.ndarray:
    """Unsigned hashes as Spark's signed longs."""
    return x.view(np.int64)
