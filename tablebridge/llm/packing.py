"""Best-fit packing by minimum bin slack.

Documents are tokenized and cut; only lengths are packed. Pieces are dealt evenly
into groups of bounded size by a hash, and each group fills one sequence after the
other: it starts with the longest piece left, and a subset-sum program over a bit set
of the lengths at hand finds the fullest combination for the rest of the sequence.
A group ends with at most a few sequences that are not full.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablebridge.llm.bytebpe import prove_whole_tokens
from tablebridge.llm.token_counts import worker_vocabulary

#: Rows packed together: the more, the fewer sequences end half full.
GROUP_ROWS = 16_384


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: all full but the first, unless the document fits."""
    first = length if length <= capacity else length % capacity or capacity
    return [(0, first)] + [(at, capacity) for at in range(first, length, capacity)]


def fullest(lengths: list[int], counts: dict[int, int], room: int) -> list[int]:
    """The lengths, within their counts, whose sum comes closest to `room` from below."""
    mask, reached, steps = (1 << room + 1) - 1, 1, []
    for length in lengths:
        if length > room:
            continue
        for _ in range(min(counts[length], room // length)):
            more = (reached | reached << length) & mask
            if more == reached:
                break
            steps.append((length, reached))
            reached = more
        if reached >> room & 1:
            break
    at, chosen = reached.bit_length() - 1, []
    for length, before in reversed(steps):
        if not before >> at & 1:
            chosen.append(length)
            at -= length
    return chosen


def pack_lengths(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each length."""
    order = np.argsort(-lengths, kind="stable")
    waiting: dict[int, list[int]] = {}
    for i in order[::-1].tolist():
        waiting.setdefault(int(lengths[i]), []).append(i)
    kinds = sorted(waiting, reverse=True)
    counts = {k: len(v) for k, v in waiting.items()}
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    n = 0
    while kinds:
        seed = kinds[0]
        counts[seed] -= 1
        if not counts[seed]:
            kinds.pop(0)
        at = 0
        chosen = fullest(kinds, counts, capacity - seed)
        for length in [seed, *chosen]:
            i = waiting[length].pop()
            sequence[i], offset[i] = n, at
            at += length
        for length in chosen:
            counts[length] -= 1
            if not counts[length]:
                kinds.remove(length)
        n += 1
    return sequence, offset


def token_pieces(docs: DataFrame, vocabulary_path: str, capacity: int, end_id: int, key: str, text: str, with_ids: bool) -> DataFrame:
    """Each text's ids and an end, cut into pieces; `ids` holds them if asked for."""
    whole = docs.sparkSession.sparkContext.broadcast(prove_whole_tokens(vocabulary_path))  # the vocabulary at most
    names = [key, "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = worker_vocabulary(vocabulary_path, whole.value)
        end = np.array([end_id], np.uint32)
        for batch in batches:
            keys = batch.column(0)
            for a, _, counts, ids in vocabulary.encode(batch.column(1)):
                rows, out = [], [[], [], [], []]
                kept = []
                place = np.concatenate(([0], np.cumsum(counts)))
                for i in range(len(counts)):
                    own = np.concatenate((ids[place[i] : place[i + 1]], end)).astype("<u4")
                    for k, (start, length) in enumerate(cut(len(own), capacity)):
                        part = own[start : start + length]
                        rows.append(a + i)
                        for column, value in zip(out, (k, start, length, zlib.crc32(part)), strict=True):
                            column.append(value)
                        if with_ids:
                            kept.append(part.astype(np.int32))
                arrays = [keys.take(pa.array(rows, pa.int64())), pa.array(out[0], pa.int32()), *(pa.array(x, pa.int64()) for x in out[1:])]
                yield pa.RecordBatch.from_arrays(arrays + [pa.array(kept, pa.list_(pa.int32()))] * with_ids, names)

    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return docs.select(key, text).mapInArrow(pieces, schema)


def pack_documents(
    docs: DataFrame,
    vocabulary_path: str,
    capacity: int = 2048,
    end_id: int = 0,
    key: str = "doc_id",
    text: str = "text",
    group_rows: int = GROUP_ROWS,
    with_ids: bool = False,
) -> DataFrame:
    """Place every document's tokens into sequences of at most `capacity` tokens.

    One row per piece: key, piece, start (its document's ids before it), length,
    ids_crc32, sequence_id, offset, and with `with_ids` the ids themselves. A null or empty
    text is its end id alone. Repeated rows and null keys are packed like any others. Other
    columns are not read. An empty table gives an empty result. sequence_id is unique, not dense.
    """
    groups = max(1, -(-docs.count() // group_rows))  # the count comes from file footers
    pieces = token_pieces(docs, vocabulary_path, capacity, end_id, key, text, with_ids)
    dealt = pieces.withColumn("__group", F.pmod(F.xxhash64(key, "piece", "start", "ids_crc32"), F.lit(groups)))

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        sequence, offset = pack_lengths(group["length"].to_numpy(), capacity)
        return group.assign(sequence_id=(group["__group"].to_numpy() << 32) + sequence, offset=offset).drop(columns="__group")

    return dealt.groupBy("__group").applyInPandas(pack, pieces.schema.add("sequence_id", "long").add("offset", "long"))


def sequences(packed: DataFrame, key: str = "doc_id") -> DataFrame:
    """The packed sequences themselves, from `pack_documents(..., with_ids=True)`: sequence_id, ids, keys in order."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids", F.col(key).alias("key"))))  # at most `capacity` parts
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select("sequence_id", F.flatten("parts.ids").alias("ids"), F.col("parts.key").alias("keys"))
