"""Nearest neighbours by inner product, from randomly rotated one-bit codes.

Each vector is taken relative to the mean of all, scaled to length one, padded with zeros and turned by a random
rotation; its code is the signs of the outcome, one packed bit each. Beside the code stand three
numbers: the vector's distance from the mean, its inner product with the mean, and how well the code
agrees with it, which corrects the estimate. A code and a query give an estimate of the inner product and a bound
of its error that holds with a probability set by `CONFIDENCE`. A vector is reranked, by its exact inner product, if
its upper bound reaches the k-th best exact score that its query has so far.

The index is a table of blocks of vectors, written once; blocks of queries meet blocks of vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablebridge.llm.storage import stored

#: Rows of a block of vectors, and of a block of queries.
BLOCK = 4096
QUERY_BLOCK = 512
#: Bits of a code for each dimension, and how many at least.
BITS = 4
LEAST_BITS = 64
#: Errors lie within so many deviations; a larger number reranks more and misses less.
CONFIDENCE = 3.0
SEED = 2011
#: Rows of vectors and of queries that meet in one task, about.
ROWS_PER_TASK = 8192


def rotation(width: int, bits: int) -> np.ndarray:
    """The first `width` columns of a random rotation in `bits` dimensions: what padding with zeros leaves of it."""
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((bits, width)))
    return q * np.sign(np.diag(r))


@dataclass
class Codes:
    """Codes of a block of vectors, and the scalars that correct estimates."""

    packed: np.ndarray  # rows by bits / 8
    far: np.ndarray  # distance from the mean
    fit: np.ndarray  # inner product of the code and the vector, both of length one
    mean: np.ndarray  # inner product with the mean


def encode(x: np.ndarray, mean: np.ndarray, turn: np.ndarray) -> Codes:
    rest = x - mean
    far = np.sqrt((rest * rest).sum(axis=1))
    turned = (rest / np.where(far > 0, far, 1)[:, None]) @ turn.T
    return Codes(np.packbits(turned >= 0, axis=1), far, np.abs(turned).sum(axis=1) / np.sqrt(turn.shape[0]), x @ mean)


def estimates(q: np.ndarray, codes: Codes, mean: np.ndarray, turn: np.ndarray, confidence: float) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products of all queries (rows) with all vectors, and bounds of their errors."""
    bits = turn.shape[0]
    rest = q - mean
    far = np.sqrt((rest * rest).sum(axis=1))
    turned = ((rest / np.where(far > 0, far, 1)[:, None]) @ turn.T).astype(np.float32)
    signs = np.unpackbits(codes.packed, axis=1).astype(np.float32)
    # Signs are twice the bits less one.
    agree = (2 * (turned @ signs.T) - turned.sum(axis=1, dtype=np.float32)[:, None]).astype(np.float64) / np.sqrt(bits)
    fit = np.where(codes.far > 0, codes.fit, 1)
    size = far[:, None] * codes.far[None, :]
    error = np.sqrt(np.maximum(1 - fit * fit, 0)) / fit * (confidence / np.sqrt(bits - 1)) + 1e-5
    constant = (q @ mean - mean @ mean)[:, None] + codes.mean[None, :]
    return size * (agree / fit) + constant, size * error + 1e-9 * np.abs(constant)


def exact(q: np.ndarray, x: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Inner products of chosen pairs, in double precision."""
    out = np.empty(len(rows))
    for at in range(0, len(rows), 1 << 16):
        own = slice(at, at + (1 << 16))
        out[own] = (q[rows[own]] * x[columns[own]]).sum(axis=1)
    return out


def best_places(query: np.ndarray, keys: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of each query's k best, by query: larger scores first, then smaller keys."""
    order = np.lexsort((keys, -score, query))
    q = query[order]
    start = np.flatnonzero(np.concatenate(([True], q[1:] != q[:-1]))) if len(q) else np.zeros(0, np.int64)
    nth = np.arange(len(q)) - np.repeat(start, np.diff(np.append(start, len(q))))
    return order[nth < k]


def search_block(q: np.ndarray, same: np.ndarray, x: np.ndarray, keys: np.ndarray, estimate: np.ndarray, error: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query's row, vector's row, exact score) of a block's vectors whose bounds let them be among a query's k best.

    `same` marks pairs of a row with itself.
    """
    lower, upper = estimate - error, estimate + error
    lower[~np.isfinite(lower)] = -np.inf
    upper[~np.isfinite(upper)] = np.inf  # numbers beyond double precision: no bound
    lower[same] = upper[same] = -np.inf
    m = len(keys)
    # The vectors of the k best lower bounds first: others have to reach the least of their exact scores.
    first = np.argpartition(lower, m - k, axis=1)[:, m - k :] if m > k else np.broadcast_to(np.arange(m), (len(q), m))
    rows, columns = np.repeat(np.arange(len(q)), first.shape[1]), first.ravel()
    own = same[rows, columns]
    score = np.where(own, -np.inf, exact(q, x, rows, columns))
    mark = score.reshape(first.shape).min(axis=1, initial=np.inf)
    upper[np.arange(len(q))[:, None], first] = -np.inf
    more_rows, more_columns = np.nonzero((upper >= mark[:, None]) & (upper > -np.inf))
    rows = np.concatenate((rows[~own], more_rows))
    columns = np.concatenate((columns[~own], more_columns))
    score = np.concatenate((score[~own], exact(q, x, more_rows, more_columns)))
    best = best_places(rows, keys[columns], score, k)
    return rows[best], columns[best], score[best]


def usable(vectors: DataFrame, is_query: Column, key: str, vector: str) -> DataFrame:
    """key, v (doubles) and query of the rows that take part."""
    v = F.col(vector).cast("array<double>")
    rows = vectors.select(F.col(key).cast("long").alias("key"), v.alias("v"), F.coalesce(is_query, F.lit(False)).alias("query"))
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return rows.where(F.col("key").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda c: c != 0.0))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column as rows of doubles, short ones filled up with zeros."""
    lengths = column.value_lengths().to_numpy()
    flat = column.flatten().to_numpy()
    x = np.zeros((len(column), width))
    row = np.repeat(np.arange(len(column)), lengths)
    x[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return x


def mean_of(rows: DataFrame, width: int) -> np.ndarray:
    """The mean of all vectors; one row of sums comes from each task."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(width), 0
        for batch in batches:
            total += matrix(batch.column(0), width).sum(axis=0)
            n += batch.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width, dtype=np.int32)), pa.array(total), pa.array(np.full(width, n))], ["place", "total", "n"])

    parts = rows.select("v").mapInArrow(sums, "place int, total double, n long")
    found = parts.groupBy("place").agg((F.sum("total") / F.sum("n")).alias("mean")).collect()
    mean = np.zeros(width)
    for row in found:
        mean[row["place"]] = row["mean"]
    return np.where(np.isfinite(mean), mean, 0.0)


_INDEX = "keys binary, query binary, v binary, packed binary, far binary, fit binary, mean binary"


def build_index(rows: DataFrame, mean: np.ndarray, turn: np.ndarray, block: int) -> DataFrame:
    """Blocks of vectors with their codes, written to the shared folder; a row is known by its block and place."""
    width = len(mean)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, block):
                own = batch.slice(at, block)
                x = matrix(own.column(1), width)
                codes = encode(x, mean, turn)
                keys = own.column(0).to_numpy().astype("<i8")
                query = own.column(2).to_numpy(zero_copy_only=False).astype(np.uint8)
                blobs = [keys, query, x.astype("<f8"), codes.packed, *(c.astype("<f8") for c in (codes.far, codes.fit, codes.mean))]
                yield pa.RecordBatch.from_arrays([pa.array([b.tobytes()], pa.binary()) for b in blobs], ["keys", "query", "v", "packed", "far", "fit", "mean"])

    blocks = rows.select("key", "v", "query").mapInArrow(pack, _INDEX)
    return stored(blocks.select(F.monotonically_increasing_id().alias("block"), "*"), "onebit-index")


def query_blocks(index: DataFrame, width: int, size: int) -> DataFrame:
    """Blocks of query vectors with the name of their own block and their places there."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        n = 0

        def packed() -> pa.RecordBatch:
            keys, v, origin, place = zip(*held, strict=True)
            return pa.RecordBatch.from_arrays([pa.array([np.concatenate(c).tobytes()], pa.binary()) for c in (keys, v, origin, place)], ["q_keys", "q_v", "q_block", "q_place"])

        for batch in batches:
            for i in range(batch.num_rows):
                block = batch.column(0)[i].as_py()
                keys, query, v = (batch.column(j)[i].as_buffer() for j in (1, 2, 3))
                every = np.flatnonzero(np.frombuffer(query, np.uint8))
                for at in range(0, len(every), size):
                    place = every[at : at + size]
                    held.append((np.frombuffer(keys, "<i8")[place], np.frombuffer(v, "<f8").reshape(-1, width)[place], np.full(len(place), block, "<i8"), place.astype("<i4")))
                    n += len(place)
                    if n >= size:
                        yield packed()
                        held, n = [], 0
        if held:
            yield packed()

    return index.select("block", "keys", "query", "v").mapInArrow(gather, "q_keys binary, q_v binary, q_block binary, q_place binary")


def nearest_neighbours(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    key: str = "vec_id",
    vector: str = "embedding",
    confidence: float = CONFIDENCE,
    block: int = BLOCK,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """For each query row the k other rows of largest inner product that the codes find: query_id, rank, vec_id, score.

    Scores are exact inner products in double precision; ties go to the smaller key. A vector is missed only if its
    estimate errs by more than `confidence` deviations. Vectors that are null, all zeros, or hold null or non-finite
    components take no part, nor do rows with a null key; shorter vectors end in zeros. Rows that repeat a key count
    each on their own, as queries too. Other columns are not read. An empty table, or no query, gives an empty result.
    """
    rows = usable(vectors, is_query, key, vector)
    size = rows.agg(F.max(F.size("v")).alias("width"), F.count(F.lit(1)).alias("n"), F.count_if("query").alias("q")).first()
    if not size["q"]:
        empty = rows.select(F.col("key").alias("query_id"), F.lit(1).alias("rank"), F.col("key").alias("vec_id"), F.lit(0.0).alias("score"))
        return empty.where("false")
    width = size["width"]
    mean = mean_of(rows, width)
    turn = rotation(width, max(LEAST_BITS, -(-BITS * width // 8) * 8))
    # A grid: every part of the queries meets every part of the vectors, each in a task of its own.
    across, down = (-(-size[name] // ROWS_PER_TASK) for name in ("n", "q"))
    index = build_index(rows, mean, turn, block)
    part = ["part", "q_part"]
    queries = query_blocks(index, width, query_block).withColumn("q_part", F.pmod(F.xxhash64("q_keys", "q_place"), F.lit(down)).cast("int"))
    queries = queries.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(across - 1)))).repartition(across * down, *part)
    blocks = index.drop("query").withColumn("part", F.pmod(F.xxhash64("block"), F.lit(across)).cast("int"))
    blocks = blocks.withColumn("q_part", F.explode(F.sequence(F.lit(0), F.lit(down - 1)))).repartition(across * down, *part)
    meeting = queries.join(blocks, part).select("q_keys", "q_v", "q_block", "q_place", "block", "keys", "v", "packed", "far", "fit", "mean")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                query_keys, q_v, origin, place = (np.frombuffer(batch.column(j)[i].as_buffer(), kind) for j, kind in enumerate(("<i8", "<f8", "<i8", "<i4")))
                keys, v, packed, far, fit, close = (np.frombuffer(batch.column(j)[i].as_buffer(), kind) for j, kind in enumerate(("<i8", "<f8", "u1", "<f8", "<f8", "<f8"), start=5))
                q, x = q_v.reshape(-1, width), v.reshape(-1, width)
                estimate, error = estimates(q, Codes(packed.reshape(len(keys), -1), far, fit, close), mean, turn, confidence)
                same = np.zeros(estimate.shape, bool)
                own = np.flatnonzero(origin == batch.column(4)[i].as_py())
                same[own, place[own]] = True
                a, b, score = search_block(q, same, x, keys, estimate, error, k)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (query_keys[a], origin[a], place[a], keys[b], score)], ["query_id", "q_block", "q_place", "vec_id", "score"])

    found = meeting.mapInArrow(search, "query_id long, q_block long, q_place int, vec_id long, score double")
    order = Window.partitionBy("query_id", "q_block", "q_place").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
