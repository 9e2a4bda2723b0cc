"""Vectors compressed to codes: each part of a vector becomes the index of its nearest codebook entry.

Codebooks are fitted by rounds of assignment and averaging, in whole numbers. Entries move from round to round, and a
part is compared with few of them: it keeps the distance of its entry and, for each group of alike entries, a lower
bound of the distance to all others of the group. All codebooks of earlier rounds are retained and each bound carries the round
it was taken in, so it is loosened by how far entries really lie from where they stood then: the norm
of the sum of their moves, which is at most the sum of the norms. Groups whose bounds stay above the
distance of the part's own entry are not looked at; the rest is scanned again, exactly.

The vectors and their bounds are a table of blocks, written once a round beside each block's
sums by entry; only codebooks pass through the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablebridge.llm.storage import stored

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
#: Groups of entries that share a lower bound, for each part position.
GROUPS = 16
#: Whole numbers up to here are exact in sums of doubles, and in sums of longs.
EXACT, LARGEST = float(1 << 53), float(1 << 62)
#: Displacements are rounded up by this share.
SLACK = 1e-9


def whole_vectors(vectors: DataFrame, key: str, vector: str, label: str, scale: int) -> DataFrame:
    """key, label and v, floor(scale * x) of each component, of the rows whose vector is whole and finite."""
    x = F.col(vector).cast("array<double>")
    rows = vectors.select(F.col(key).cast("long").alias("key"), F.col(label).alias("label"), x.alias("x"))
    finite = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return rows.where(F.col("x").isNotNull() & finite).select("key", "label", F.transform("x", lambda c: F.floor(c * float(scale))).alias("v"))


def grouping(book: np.ndarray, groups: int) -> list[np.ndarray]:
    """Entries of a codebook in groups of alike ones: around entries far from each other. Each ascending."""
    x = book.astype(np.float64)
    centers = [0]
    near = ((x - x[0]) ** 2).sum(axis=1)
    while len(centers) < min(groups, len(x)):
        centers.append(int(near.argmax()))
        near = np.minimum(near, ((x - x[centers[-1]]) ** 2).sum(axis=1))
    own = ((x[:, None, :] - x[centers][None, :, :]) ** 2).sum(axis=2).argmin(axis=1)
    return [found for g in range(len(centers)) if len(found := np.flatnonzero(own == g))]


def distances(x: np.ndarray, book: np.ndarray, exact: bool) -> np.ndarray:
    """Squared distances of all rows to all entries; doubles if they hold them exactly, else longs."""
    if exact:
        x, book = x.astype(np.float64), book.astype(np.float64)
    return (x * x).sum(axis=1)[:, None] - 2 * (x @ book.T) + (book * book).sum(axis=1)[None, :]


def above(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x.astype(np.float32), np.float32(np.inf))


def below(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x.astype(np.float32), np.float32(-np.inf))


@dataclass
class Bounds:
    """What one part position of a block of vectors remembers between rounds."""

    entry: np.ndarray  # own entry
    near: np.ndarray  # its distance, rounded up
    near_at: np.ndarray  # in which round
    low: np.ndarray  # by group, the least distance of its other entries, rounded down
    low_at: np.ndarray

    @staticmethod
    def new(n: int, groups: int) -> Bounds:
        return Bounds(np.zeros(n, np.uint8), np.full(n, np.inf, np.float32), np.zeros(n, np.uint8), np.full((n, groups), -np.inf, np.float32), np.zeros((n, groups), np.uint8))


def assign(x: np.ndarray, history: np.ndarray, groups: list[np.ndarray], bounds: Bounds, exact: bool) -> int:
    """Move each row to its nearest entry of the last codebook, ties to lower indexes; returns how many distances were worked out.

    `history` has all codebooks so far, by round.
    """
    now = len(history) - 1
    book = history[now]
    moved = np.sqrt(((book.astype(np.float64)[None] - history) ** 2).sum(axis=2)) * (1 + SLACK)
    group_moved = np.stack([moved[:, own].max(axis=1) for own in groups], axis=1)
    group_of = np.zeros(len(book), np.int64)
    for g, own in enumerate(groups):
        group_of[own] = g
    low = bounds.low.astype(np.float64) - group_moved[bounds.low_at, np.arange(len(groups))[None, :]]
    near = bounds.near.astype(np.float64) + moved[bounds.near_at, bounds.entry]
    rows = np.flatnonzero((low <= near[:, None]).any(axis=1))
    if not len(rows):
        return 0
    x, low = x[rows], low[rows]
    old = bounds.entry[rows].astype(np.int64)
    kind = np.float64 if exact else np.int64
    away = x.astype(kind) - book[old].astype(kind)
    old_distance = (away * away).sum(axis=1)
    best, best_distance = old.copy(), old_distance.copy()
    look = low <= above(np.sqrt(old_distance.astype(np.float64)))[:, None]
    worked = len(rows)
    seen: list[tuple] = []
    for g, own in enumerate(groups):
        at = np.flatnonzero(look[:, g])
        if not len(at):
            continue
        d = distances(x[at], book[own], exact)
        worked += d.size
        first = d.argmin(axis=1)
        least = d[np.arange(len(at)), first]
        if len(own) > 1:
            second = np.partition(d, 1, axis=1)[:, 1].astype(np.float64)
        else:
            second = np.full(len(at), np.inf)
        entry = own[first]
        better = (least < best_distance[at]) | ((least == best_distance[at]) & (entry < best[at]))
        best[at[better]], best_distance[at[better]] = entry[better], least[better]
        seen.append((g, at, entry, least, second))
    for g, at, entry, least, second in seen:
        others = np.where(entry == best[at], second, least.astype(np.float64))
        bounds.low[rows[at], g] = below(np.sqrt(others))
        bounds.low_at[rows[at], g] = now
    # An entry that was left belongs to the others of its group from now on.
    left = np.flatnonzero((best != old) & ~look[np.arange(len(rows)), group_of[old]])
    own = group_of[old[left]]
    bounds.low[rows[left], own] = below(np.minimum(low[left, own], np.sqrt(old_distance[left].astype(np.float64))))
    bounds.low_at[rows[left], own] = now
    bounds.entry[rows] = best
    bounds.near[rows] = above(np.sqrt(best_distance.astype(np.float64)))
    bounds.near_at[rows] = now
    return worked


_STATE = "x binary, entry binary, near binary, near_at binary, low binary, low_at binary, used binary, counts binary, sums binary"
_KINDS = {"entry": "u1", "near": "<f4", "near_at": "u1", "low": "<f4", "low_at": "u1"}


@dataclass
class Model:
    """Codebooks of all rounds by part, and how blocks hold numbers."""

    history: list[list[np.ndarray]]  # by part, by round
    groups: list[list[np.ndarray]]
    width: int  # components of a part
    kind: str
    exact: bool

    def bounds(self, n: int, row: dict | None) -> list[Bounds]:
        if row is None:
            return [Bounds.new(n, len(own)) for own in self.groups]
        out, at, wide = [], 0, 0
        for own in self.groups:
            flat = [np.frombuffer(row[name], _KINDS[name])[at : at + n].copy() for name in ("entry", "near", "near_at")]
            grid = [np.frombuffer(row[name], _KINDS[name])[wide : wide + n * len(own)].reshape(n, len(own)).copy() for name in ("low", "low_at")]
            out.append(Bounds(*flat, *grid))
            at, wide = at + n, wide + n * len(own)
        return out

    def advance(self, x: np.ndarray, row: dict | None) -> list[Bounds]:
        """Assign all parts of a block by the last codebooks."""
        bounds = self.bounds(len(x), row)
        for part, own in enumerate(bounds):
            assign(x[:, part * self.width : (part + 1) * self.width], np.stack(self.history[part]), self.groups[part], own, self.exact)
        return bounds


def sums_by_entry(x: np.ndarray, bounds: list[Bounds], width: int, entries: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of the entries in use over all parts, their counts and their sums of parts."""
    total = np.zeros((len(bounds) * entries, width), np.int64)
    counts = np.zeros(len(bounds) * entries, np.int64)
    for part, own in enumerate(bounds):
        place = part * entries + own.entry.astype(np.int64)
        np.add.at(total, place, x[:, part * width : (part + 1) * width].astype(np.int64))
        counts += np.bincount(place, minlength=len(counts))
    used = np.flatnonzero(counts)
    return used, counts[used], total[used]


def compress_vectors(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    groups: int = GROUPS,
) -> tuple[DataFrame, list[np.ndarray]]:
    """A row per vector: key, label, `code` (an entry's index per part, two hex digits each), `error` (squared distances
    to the entries, summed); and the codebooks, one per part.

    Codebooks start from the vectors of the smallest keys (nulls last, then by vector). Vectors that are null or
    hold null or non-finite components are left out; shorter ones, and widths that do not divide by `parts`,
    end in zeros. Repeated rows and null keys or labels count like others; other columns are not read. An empty table
    gives an empty result and no codebooks. Numbers too large for exact distances raise ValueError.
    """
    if not 1 <= entries <= 256:
        raise ValueError("an index has two hex digits: 1 to 256 entries")
    rows = whole_vectors(vectors, key, vector, label, scale)
    label_type = rows.schema["label"].dataType
    size = rows.agg(F.max(F.size("v")).alias("width"), F.max(F.array_max(F.transform("v", lambda c: F.abs(c.cast("double"))))).alias("most")).first()
    schema = T.StructType([T.StructField(key, T.LongType()), T.StructField(label, label_type), T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    if size["width"] is None:
        return vectors.sparkSession.createDataFrame([], schema), []
    width = max(1, -(-size["width"] // parts))
    most = float(size["most"] or 0) + 1
    if parts * width * (2 * most) ** 2 > LARGEST:
        raise ValueError(f"components of {most:.0f} in size are too large for exact distances of {parts * width} components")
    kind = "<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<i8"

    def matrix(column: pa.Array) -> np.ndarray:
        lengths = column.value_lengths().to_numpy()
        x = np.zeros((len(column), parts * width), kind)
        row = np.repeat(np.arange(len(column)), lengths)
        flat = column.flatten().to_numpy()
        x[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
        return x

    first = rows.orderBy(F.col("key").asc_nulls_last(), "v").limit(entries).select("v").toArrow()["v"].combine_chunks()
    start = matrix(first).astype(np.int64)
    books = [start[:, p * width : (p + 1) * width] for p in range(parts)]
    own_groups = [grouping(book, groups) for book in books]
    model = Model([[book] for book in books], own_groups, width, kind, width * (4 * most) ** 2 < EXACT)

    blocks_schema = T.StructType([T.StructField("keys", T.ArrayType(T.LongType())), T.StructField("labels", T.ArrayType(label_type))]).fields
    state_schema = T.StructType([*blocks_schema, *(T.StructField(c.split()[0], T.BinaryType()) for c in _STATE.split(", "))])

    def whole(column: pa.Array) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array([0, len(column)], pa.int32()), column)

    def state(keys: pa.Array, labels: pa.Array, x: np.ndarray, row: dict | None, model: Model) -> pa.RecordBatch:
        bounds = model.advance(x, row)
        held = [np.concatenate([getattr(b, name).ravel() for b in bounds]).astype(_KINDS[name]) for name in _KINDS]
        blobs = [x.astype(kind), *held, *(c.astype("<i8") for c in sums_by_entry(x, bounds, width, entries))]
        return pa.RecordBatch.from_arrays([keys, labels, *(pa.array([b.tobytes()], pa.binary()) for b in blobs)], state_schema.names)

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield state(whole(batch.column(0)), whole(batch.column(1)), matrix(batch.column(2)), None, model)

    def opened(batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, dict]:
        row = {name: batch.column(name)[i].as_buffer() for name in ("x", *_KINDS)}
        return np.frombuffer(row["x"], kind).reshape(-1, parts * width), row

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield state(batch.column("keys").slice(i, 1), batch.column("labels").slice(i, 1), *opened(batch, i), model)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                x, row = opened(batch, i)
                bounds = model.advance(x, row)
                error = np.zeros(len(x), np.int64)
                for part, own in enumerate(bounds):
                    away = x[:, part * width : (part + 1) * width].astype(np.int64) - model.history[part][-1][own.entry]
                    error += (away * away).sum(axis=1)
                joined = np.stack([own.entry for own in bounds], axis=1)
                codes = pa.array([row.tobytes().hex() for row in joined], pa.string())
                yield pa.RecordBatch.from_arrays([batch.column("keys")[i].values, batch.column("labels")[i].values, codes, pa.array(error)], schema.names)

    current = stored(rows.select("key", "label", "v").mapInArrow(begin, state_schema), "codes-0")
    for turn in range(1, rounds + 1):
        renew(model, current, width, entries)
        if turn < rounds:
            current = stored(current.mapInArrow(step, state_schema), f"codes-{turn}")
    return stored(current.mapInArrow(finish, schema), "codes"), [history[-1] for history in model.history]


def renew(model: Model, state: DataFrame, width: int, entries: int) -> None:
    """Append the codebooks that follow from the state's sums; entries that nothing was assigned to stay."""

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(len(model.groups) * entries, np.int64)
        total = np.zeros((len(count), width), np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                used, counts, sums = (np.frombuffer(batch.column(j)[i].as_buffer(), "<i8") for j in range(3))
                count[used] += counts
                total[used] += sums.reshape(-1, width)
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(used, width)), pa.array(np.tile(np.arange(width), len(used))), pa.array(np.repeat(count[used], width)), pa.array(total[used].ravel())], ["entry", "place", "n", "total"])

    sums = state.select("used", "counts", "sums").mapInArrow(totals, "entry long, place long, n long, total long")
    found = sums.groupBy("entry", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).toArrow()
    entry, place, n, total = (found[c].to_numpy() for c in ("entry", "place", "n", "total"))
    for part, history in enumerate(model.history):
        book = history[-1].copy()
        own = entry // entries == part
        book[entry[own] % entries, place[own]] = total[own] // n[own]
        history.append(book)


def codebooks_digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all components in decimal by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(str(c) for book in books for c in book.ravel().tolist()).encode()).hexdigest()


def with_label_errors(coded: DataFrame, label: str = "label") -> DataFrame:
    """The rows with `label_error`, the sum of `error` over rows of an equal label; null labels count as equal."""
    sums = coded.groupBy(F.col(label).alias("__label")).agg(F.sum("error").alias("label_error"))
    return coded.join(sums, F.col(label).eqNullSafe(F.col("__label"))).drop("__label")
