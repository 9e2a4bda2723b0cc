"""Exact top-k inner products by no-random-access aggregation, blocks of queries against blocks of vectors.

A block of vectors keeps a sorted list per dimension. A query's score is the sum of what its
dimensions contribute; its lists are read from the end that contributes most, all equally
deep, in rounds. After each round every vector has a lower bound (what was read, and the
least that the unread rest of each list can give) and an upper bound (the unread rest at the point reached).
Reading stops for a query once no vector outside its k best lower bounds can qualify; the scores of
those that still can are then resolved from the rest of the lists.
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
#: Blocks of vectors that a task searches.
PART_BLOCKS = 2
#: How deep the lists are read, in shares of their length, after each round.
DEPTHS = (0.25, 0.5, 0.7, 0.85, 1.0)
#: Blocks of queries whose reached scores a task remembers.
REMEMBERED = 1024
#: Whole numbers up to here are exact in sums of doubles.
EXACT = float(1 << 53)


def whole_numbers(vectors: DataFrame, key: str, vector: str, scale: int, query: str) -> DataFrame:
    """key, query and v: floor(scale * x) of each component as double; rows that hold a null or are not finite are left out."""
    x = F.col(vector).cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return vectors.where(F.col(vector).isNotNull() & finite).select(F.col(key).cast("long").alias("key"), F.col(query).alias("query"), F.transform(x, lambda c: F.floor(c * float(scale))).alias("v")).where("key is not null")


@dataclass
class Lists:
    """A block of vectors with the ranks of their components in each dimension's sorted list."""

    keys: np.ndarray  # numbers of rows
    x: np.ndarray  # rows by dimensions
    ordered: np.ndarray  # each column sorted, largest first
    rank: np.ndarray  # place of each component in its column's list

    @staticmethod
    def build(keys: np.ndarray, x: np.ndarray) -> Lists:
        order = np.argsort(-x, axis=0, kind="stable")
        rank = np.empty_like(order)
        np.put_along_axis(rank, order, np.arange(len(x))[:, None], axis=0)
        return Lists(keys, x, np.take_along_axis(x, order, axis=0), rank)


def bounds(q: np.ndarray, lists: Lists, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of all scores after the first `depth` entries of each list were read.

    A query reads a dimension's list from the top where its weight is positive, else from the bottom.
    """
    n = len(lists.x)
    up, down = np.maximum(q, 0), np.minimum(q, 0)
    from_top, from_bottom = lists.rank < depth, lists.rank >= n - depth
    seen = up @ np.where(from_top, lists.x, 0).T + down @ np.where(from_bottom, lists.x, 0).T
    if depth == n:
        return seen, seen
    top, bottom = ~from_top, ~from_bottom
    high = up @ np.where(top, lists.ordered[depth], 0).T + down @ np.where(bottom, lists.ordered[n - 1 - depth], 0).T
    low = up @ np.where(top, lists.ordered[-1], 0).T + down @ np.where(bottom, lists.ordered[0], 0).T
    return seen + low, seen + high


def best_of_block(query_keys: np.ndarray, q: np.ndarray, lists: Lists, k: int, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query's row, vector's row, score) of all that may be among a query's k best.

    `least` has scores that each query's k-th best is known to reach; it is raised where this block raises it.
    """
    n = len(lists.x)
    open_queries = np.arange(len(q))
    out: list[tuple[np.ndarray, np.ndarray]] = []
    alive = np.arange(n)
    part = lists
    for share in DEPTHS:
        depth = min(len(part.x), max(1, int(np.ceil(share * len(part.x)))))
        low, high = bounds(q[open_queries], part, depth)
        same = query_keys[open_queries][:, None] == part.keys[None, :]
        low = np.where(same, -np.inf, low)
        if low.shape[1] > k:
            reached = np.partition(low, low.shape[1] - k, axis=1)[:, -k]
        else:
            reached = np.full(len(low), -np.inf)
        reached = np.maximum(reached, least[open_queries])
        can = (high >= reached[:, None]) & ~same
        least[open_queries] = reached
        left = can.sum(axis=1)
        done = (left <= 2 * k) | (depth == len(part.x))
        rows, columns = np.nonzero(can[done])
        out.append((open_queries[done][rows], alive[columns]))
        open_queries = open_queries[~done]
        if not len(open_queries):
            break
        # Vectors that no open query can still take leave the lists.
        stay = np.flatnonzero(can[~done].any(axis=0))
        if len(stay) < 0.5 * len(alive):
            alive = alive[stay]
            part = Lists.build(lists.keys[alive], lists.x[alive])
    rows, columns = (np.concatenate(c) for c in zip(*out, strict=True))
    return rows, columns, (q[rows] * lists.x[columns]).sum(axis=1)


def trim(query: np.ndarray, keys: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of each query's k best: larger scores first, then smaller keys."""
    order = np.lexsort((keys, -score, query))
    q = query[order]
    start = np.flatnonzero(np.diff(q, prepend=q[0] - 1 if len(q) else 0))
    nth = np.arange(len(q)) - np.repeat(start, np.diff(np.append(start, len(q))))
    return order[nth < k]


def blocks(rows: DataFrame, size: int, name: str, width: int) -> DataFrame:
    """Rows packed into (name_rows, name_keys, name_v): at most about `size` rows each, all as little-endian longs."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, ...]] = []
        held = 0

        def packed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([np.concatenate(c).astype("<i8").tobytes()], pa.binary()) for c in zip(*parts, strict=True)], [f"{name}_rows", f"{name}_keys", f"{name}_v"])

        for batch in batches:
            for at in range(0, batch.num_rows, size):
                own = batch.slice(at, size)
                lengths = own.column(2).value_lengths().to_numpy()
                flat = own.column(2).flatten().to_numpy()
                x = np.zeros((own.num_rows, width), np.int64)
                row = np.repeat(np.arange(own.num_rows), lengths)
                x[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
                parts.append((own.column(0).to_numpy(), own.column(1).to_numpy(), x))
                held += own.num_rows
                if held >= size:
                    yield packed()
                    parts, held = [], 0
        if held:
            yield packed()

    return rows.select("row", "key", "v").mapInArrow(pack, f"{name}_rows binary, {name}_keys binary, {name}_v binary")


def top_inner_products(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    scale: int = 64,
    key: str = "vec_id",
    vector: str = "embedding",
    block: int = BLOCK,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """For each query row the k other rows of highest integer inner product: query_id, rank, vec_id, score.

    Components are floor(scale * x). Ties go to the smaller key. Vectors that are null or hold null or
    non-finite components take no part, nor do rows with a null key; shorter vectors end in zeros. Rows that
    repeat a key count each on their own, as queries too; a query meets every row but its own. Other columns are not read. An empty table, or no query, gives an empty result.
    """
    rows = whole_numbers(vectors.withColumn("__query", F.coalesce(is_query, F.lit(False))), key, vector, scale, "__query")
    # Written once, so that a row has the same number as query and as candidate.
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "top-rows")
    size = rows.agg(F.max(F.size("v")).alias("width"), F.count(F.lit(1)).alias("n")).first()
    width = size["width"] or 0
    if not width:
        return rows.select(F.col("key").alias("query_id"), F.lit(1).alias("rank"), F.col("key").alias("vec_id"), F.lit(0).cast("long").alias("score")).limit(0)
    # Every block of queries goes to every part of the vectors; a part holds its blocks one after the other.
    parts = max(1, -(-size["n"] // (PART_BLOCKS * block)))
    query_rows = blocks(rows.where("query"), query_block, "q", width).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).repartition(parts, "part")
    vector_rows = blocks(rows, block, "c", width).withColumn("part", F.pmod(F.xxhash64("c_rows"), F.lit(parts)).cast("int")).repartition(parts, "part")
    pairs = query_rows.join(vector_rows, "part").select("q_rows", "q_keys", "q_v", "c_rows", "c_keys", "c_v")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_lists: tuple[bytes, Lists | None] = (b"", None)
        reached: dict[bytes, np.ndarray] = {}  # by block of queries, what earlier blocks of vectors have given
        for batch in batches:
            for i in range(batch.num_rows):
                q_rows, q_keys, q_v, c_rows, c_keys, c_v = (batch.column(j)[i].as_buffer().to_pybytes() for j in range(6))
                query_rows, q = np.frombuffer(q_rows, "<i8"), np.frombuffer(q_v, "<i8").reshape(-1, width)
                query_keys, keys = np.frombuffer(q_keys, "<i8"), np.frombuffer(c_keys, "<i8")
                if last_lists[0] != c_rows:
                    last_lists = (c_rows, Lists.build(np.frombuffer(c_rows, "<i8"), np.frombuffer(c_v, "<i8").reshape(-1, width).astype(np.float64)))
                lists = last_lists[1]
                if width * float(np.abs(q).max(initial=0)) * float(np.abs(lists.x).max(initial=0)) < EXACT:
                    if len(reached) > REMEMBERED:
                        reached.clear()
                    least = reached.setdefault(q_rows, np.full(len(q), -np.inf))
                    a, b, score = best_of_block(query_rows, q.astype(np.float64), lists, k, least)
                    score = score.astype(np.int64)
                else:  # sums beyond what doubles hold: whole numbers, every pair
                    full = q @ np.frombuffer(c_v, "<i8").reshape(-1, width).T
                    a, b = np.nonzero(query_rows[:, None] != lists.keys[None, :])
                    score = full[a, b]
                best = trim(a, keys[b], score, k)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (query_rows[a[best]], query_keys[a[best]], keys[b[best]], score[best])], ["q_row", "query_id", "vec_id", "score"])

    found = pairs.mapInArrow(search, "q_row long, query_id long, vec_id long, score long")
    order = Window.partitionBy("q_row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
