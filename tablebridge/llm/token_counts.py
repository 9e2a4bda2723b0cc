"""Token counts by the whole-token shortcut.

Offline, each vocabulary string is given to the library; those that come back as
one token need no merging ever. A text is split into pre-tokens, each distinct one
is looked up among the proven strings, and only the rest is merged, once per worker.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tablebridge.llm.bytebpe import Vocabulary, prove_whole_tokens
from tablebridge.llm.words import text_buffer

_workers: dict[str, Vocabulary] = {}


def worker_vocabulary(path: str, whole: tuple[np.ndarray, np.ndarray]) -> Vocabulary:
    """The vocabulary of a Python worker, kept between its tasks."""
    if path not in _workers:
        _workers[path] = Vocabulary(path, whole)
    return _workers[path]


def count_tokens(docs: DataFrame, vocabulary_path: str, limit: int = 1024, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Bytes and tokens of each text, and whether it has more than `limit` tokens.

    One row per row of `docs`, repeated rows included: key, n_bytes, n_tokens, over_limit.
    A null text counts as empty: 0 bytes, 0 tokens. A null key stays null. Other
    columns are not read. An empty table gives an empty result.
    """
    whole = docs.sparkSession.sparkContext.broadcast(prove_whole_tokens(vocabulary_path))  # the vocabulary at most

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = worker_vocabulary(vocabulary_path, whole.value)
        for batch in batches:
            _, offsets = text_buffer(batch.column(1))
            counts = [c for _, _, c, _ in vocabulary.encode(batch.column(1), want_ids=False)]
            tokens = np.concatenate([np.zeros(0, np.int64), *counts])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(offsets)), pa.array(tokens), pa.array(tokens > limit)], [key, "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(count, f"`{key}` {kind}, n_bytes long, n_tokens long, over_limit boolean")
