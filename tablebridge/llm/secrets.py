"""Secret scans: fixed patterns, and a randomness test battery under false-discovery control."""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablebridge.llm.words import chunks

#: Patterns that contracts name (fixed values), with the least length of what must hold a secret.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}
KINDS = ["assign", "access", "hex", "random"]

#: Runs of token characters of this length and more are tested for randomness.
LEAST_TOKEN = 16
TOKEN = re.compile(rf"[A-Za-z0-9+/_=-]{{{LEAST_TOKEN},}}")
_ASSIGNED = re.compile(r"[^=]+(?:=+\Z)?")
_PATH_PART = re.compile(r"[^+/]+")
#: Ends of the length classes that have thresholds of their own.
LENGTHS = [24, 32, 48]
#: Classes of the combined p-value, even on a log scale; class 0 is the least random.
GRADES = 40
#: Share of false finds that is borne.
FALSE_FINDS = 0.05

_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_TOKEN_BYTES = np.zeros(256, dtype=bool)
_TOKEN_BYTES[[*range(48, 58), *range(65, 91), *range(97, 123), *b"+/_=-"]] = True

#: Encodings from the narrowest, each with its symbols in order (fixed values).
ENCODINGS = [
    "0123456789abcdef",
    "0123456789ABCDEF",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "0123456789abcdefghijklmnopqrstuvwxyz",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
]
_SETS = [frozenset(e) for e in ENCODINGS]


def infer_encoding(token: str) -> str | None:
    """The narrowest encoding that has all symbols of a token, padding aside."""
    used = set(token.rstrip("="))
    return next((e for e, s in zip(ENCODINGS, _SETS, strict=True) if used <= s), None)


def parts(text: str) -> Iterator[tuple[int, str]]:
    """(start, token) of what is tested in runs of token characters.

    No encoding has '=' but at its end, nor '+' or '/' together with '-' or '_': runs are cut at '=' within, and
    what is left at '+' and '/' if it also has one of the others.
    """
    for m in TOKEN.finditer(text):
        for piece in _ASSIGNED.finditer(m[0]):
            mixed = ("-" in piece[0] or "_" in piece[0]) and ("+" in piece[0] or "/" in piece[0])
            for part in _PATH_PART.finditer(piece[0]) if mixed else [None]:
                start, token = (part.start(), part[0]) if part else (0, piece[0])
                if len(token) >= LEAST_TOKEN:
                    yield m.start() + piece.start() + start, token


def upper_tail(x: float, freedom: int) -> float:
    """Chance of a chi-squared value above x, by the cube-root normal approximation."""
    if x <= 0:
        return 1.0
    spread = 2 / (9 * freedom)
    return 0.5 * math.erfc(((x / freedom) ** (1 / 3) - 1 + spread) / math.sqrt(2 * spread))


def randomness(token: str) -> float:
    """Combined p-value of the battery: small if a token is not even, independent symbols of its encoding.

    Chi-squared of the whole alphabet, runs about the middle of the alphabet, and serial
    correlation, joined by Fisher's method. 0 for tokens without an encoding.
    """
    alphabet = infer_encoding(token)
    if alphabet is None:
        return 0.0
    place = {c: i for i, c in enumerate(alphabet)}
    x = np.array([place[c] for c in token.rstrip("=")], dtype=np.float64)
    n, size = len(x), len(alphabet)
    if n < 8:
        return 0.0
    seen = np.bincount(x.astype(np.int64), minlength=size)
    even = upper_tail(float(((seen - n / size) ** 2).sum() * size / n), size - 1)
    high = x >= size / 2
    a, b = int(high.sum()), int((~high).sum())
    runs = 1 + int((high[1:] != high[:-1]).sum())
    mean, scale = 1 + 2 * a * b / n, 2 * a * b * (2 * a * b - n) / (n * n * (n - 1))
    runs_p = math.erfc(abs(runs - mean) / math.sqrt(2 * scale)) if scale > 0 else 0.0
    centred = x - x.mean()
    power = float((centred**2).sum())
    serial = float((centred[1:] * centred[:-1]).sum()) / power if power else 1.0
    serial_p = math.erfc(abs(serial) * math.sqrt(n / 2))
    if min(even, runs_p, serial_p) <= 0:
        return 0.0
    half = -math.log(even) - math.log(runs_p) - math.log(serial_p)
    return math.exp(-half) * (1 + half + half * half / 2)


def grade(p: float) -> int:
    """Class of a combined p-value: 0 below 10**-8, GRADES - 1 at 1."""
    return 0 if p < 1e-8 else min(GRADES - 1, int((math.log10(p) + 8) * GRADES / 8))


def length_class(token: str) -> int:
    return int(np.searchsorted(LENGTHS, len(token), side="right"))


def is_text(token: str) -> bool:
    """Tokens without digits stand for what is not secret: words, names, compounds, rules."""
    return not any(c.isdigit() for c in token)


def is_candidate(token: str) -> bool:
    return not is_text(token) and any(c.isalpha() for c in token)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Spans (start, kind's place in KINDS, end) of the fixed patterns."""
    spans = []
    low = text.lower()
    if any(w in low for w in _WORDS):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if len(m[0]) >= LEAST["hex"]]
    return spans


def runs_of(inside: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of at least `least` true bytes."""
    padded = np.concatenate(([False], inside, [False]))
    change = np.flatnonzero(padded[1:] != padded[:-1])
    starts, ends = change[::2], change[1::2]
    keep = ends - starts >= least
    return starts[keep], ends[keep]


def suspects(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows whose text may hold a secret: a long run, AKIA, or a word that assigns one. None is missed."""
    rows = np.zeros(len(offsets) - 1, dtype=bool)
    low = data.tobytes().lower()

    def mark(places: np.ndarray) -> None:
        rows[np.minimum(np.searchsorted(offsets, places, side="right") - 1, len(rows) - 1)] = True

    starts, ends = runs_of(_TOKEN_BYTES[data], LEAST_TOKEN)
    # A run may go over from one text into the next: all texts it touches count.
    first = np.searchsorted(offsets, starts, side="right") - 1
    last = np.searchsorted(offsets, ends - 1, side="right") - 1
    for a, b in zip(first.tolist(), last.tolist(), strict=True):
        rows[a : b + 1] = True
    for word in (*_WORDS, "akia"):
        at, places = low.find(word.encode()), []
        while at >= 0:
            places.append(at)
            at = low.find(word.encode(), at + 1)
        if places:
            mark(np.array(places))
    return rows


def suspect_texts(column: pa.Array) -> Iterator[tuple[int, str]]:
    """(row, text) of the texts that may hold a secret."""
    for a, _, data, offsets in chunks(column):
        for i in np.flatnonzero(suspects(data, offsets)).tolist():
            yield a + i, data[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace")


def thresholds(docs: DataFrame, text: str = "text", false_finds: float = FALSE_FINDS) -> np.ndarray:
    """The least grade that counts as a find, for each class of length.

    Tokens without digits are the null cases. Where a grade and all above hold a share of the
    null cases, that share of the candidates is expected there by chance; the lowest grade is
    taken at which these are at most `false_finds` of the candidates found. Counts cover all
    texts; a few hundred sums come to the driver.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(LENGTHS) + 1, GRADES, 2), np.int64)
        for batch in batches:
            for _, body in suspect_texts(batch.column(0)):
                for _, token in parts(body):
                    if is_text(token) or is_candidate(token):
                        sums[length_class(token), grade(randomness(token)), int(is_text(token))] += 1
        at = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays([*(pa.array(x.astype(np.int32)) for x in at), pa.array(sums[at])], ["length", "grade", "is_text", "n"])

    counted = docs.select(text).mapInArrow(count, "length int, grade int, is_text int, n long")
    sums = np.zeros((len(LENGTHS) + 1, GRADES, 2), np.int64)
    for row in counted.groupBy("length", "grade", "is_text").agg(F.sum("n").alias("n")).collect():
        sums[row.length, row.grade, row.is_text] = row.n
    return choose_thresholds(sums, false_finds)


def choose_thresholds(sums: np.ndarray, false_finds: float = FALSE_FINDS) -> np.ndarray:
    """`thresholds` from counts by length class, grade, and whether a token is text. GRADES: nothing counts."""
    chosen = np.full(len(sums), GRADES, np.int64)
    for k, own in enumerate(sums):
        null = own[:, 1] if own[:, 1].sum() >= 1 / false_finds else sums[:, :, 1].sum(axis=0)
        tail = (null[::-1].cumsum()[::-1] + 1) / (null.sum() + 1)
        found = own[::-1, 0].cumsum()[::-1]
        fits = np.flatnonzero((found > 0) & (tail * own[:, 0].sum() <= false_finds * found))
        if len(fits):
            chosen[k] = fits[0]
    return chosen


def covered(spans: list[tuple[int, int, int]]) -> tuple[list[int], list[int]]:
    """Starts and ends of what spans (start, kind, end) cover, merged and in order."""
    starts: list[int] = []
    ends: list[int] = []
    for start, _, end in sorted(spans):
        if ends and start <= ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    return starts, ends


def is_free(start: int, end: int, starts: list[int], ends: list[int]) -> bool:
    """Whether a span meets none of the covered ones: the first that ends behind its start must begin behind its end."""
    at = bisect_right(ends, start)
    return at == len(starts) or starts[at] >= end


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


_NOTHING = hashlib.sha256(b"").hexdigest()


def scan_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text", false_finds: float = FALSE_FINDS) -> DataFrame:
    """Secrets of each text, by fixed patterns and by randomness.

    One row per row of `docs`, repeated rows included: key, n_assign, n_access, n_hex, base_sha256
    (of the pattern spans as kind:start:end, comma-joined), spans (these and those of kind random, which
    overlap none of them). Places count code points, ends are exclusive. A null text counts as empty:
    no spans. A null key stays null. Other columns are not read. An empty table gives an empty result.
    """
    least = thresholds(docs, text, false_finds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            counts = np.zeros((3, n), np.int64)
            digest, spans = [_NOTHING] * n, [""] * n
            for i, body in suspect_texts(batch.column(1)):
                base = base_spans(body)
                for _, k, _ in base:
                    counts[k, i] += 1
                digest[i] = hashlib.sha256(joined(base).encode()).hexdigest()
                more, taken = [], covered(base)
                for start, token in parts(body):
                    end = start + len(token)
                    if is_candidate(token) and is_free(start, end, *taken) and grade(randomness(token)) >= least[length_class(token)]:
                        more.append((start, 3, end))
                spans[i] = joined(base + more)
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, counts), pa.array(digest), pa.array(spans, pa.string())], [key, "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
