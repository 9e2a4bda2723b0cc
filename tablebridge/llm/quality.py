"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages. Each passage is encoded from its characters and words;
gated attention weighs the passages; the weighted passage decides. Only document labels are needed.
Fitting takes a bounded sample of labelled rows; scoring reads every passage of every text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablebridge.llm.words import LOWER, chunks, span_hashes, word_spans

PASSAGE_WORDS = 64
#: Labelled rows that the model is fitted on at most, and passages of one of them.
TRAIN_ROWS = 4000
TRAIN_PASSAGES = 48
HIDDEN = 24
ATTENTION = 16
#: Steps of the fit, however few the rows are.
STEPS = 1000
BATCH = 256
RATE = 0.01
DECAY = 1e-4
THRESHOLD = 0.7

#: Class of each byte: letters by case and letter, digits, each mark, blanks, line ends, what lies beyond ASCII.
_BYTE_CLASS = np.full(256, 0, dtype=np.int64)
_BYTE_CLASS[97:123] = 1
_BYTE_CLASS[65:91] = 2
_BYTE_CLASS[48:58] = 3
_BYTE_CLASS[32] = 4
_BYTE_CLASS[[9, 11, 12, 13]] = 5
_BYTE_CLASS[10] = 6
_BYTE_CLASS[128:] = 7
_MARKS = [c for c in range(33, 127) if not chr(c).isalnum()]
_BYTE_CLASS[_MARKS] = np.arange(8, 8 + len(_MARKS))
_CLASSES = 8 + len(_MARKS)
#: Beyond the classes: words that repeat in the passage, words that repeat the one before, word
#: length and its spread, capitals that begin words, words without letters, passage length, and a constant.
FEATURES = _CLASSES + 8


def passages(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages of texts, and the place of each text's first; a text without words has one passage."""
    starts, ends, first = word_spans(data, offsets)
    n = np.diff(first)
    count = np.maximum(1, -(-n // PASSAGE_WORDS))
    place = np.concatenate(([0], np.cumsum(count)))
    texts = len(n)
    of_text = np.repeat(np.arange(texts), n)
    passage = place[of_text] + (np.arange(len(starts)) - first[of_text]) // PASSAGE_WORDS
    total = int(place[-1])
    # Each byte belongs to the passage of the last word that began, at a text's start to its first.
    mark = np.zeros(len(data) + 1, np.int64)
    new = np.flatnonzero(np.diff(passage, prepend=-1)) if len(passage) else np.zeros(0, np.int64)
    head = np.zeros(total, np.int64)
    head[place[:-1]] = offsets[:-1]
    inner = new[passage[new] != place[of_text[new]]] if len(new) else new
    head[passage[inner]] = starts[inner]
    np.add.at(mark, head[1:], 1)
    owner = np.cumsum(mark[: len(data)])
    low = LOWER[data]
    counts = np.bincount(owner * _CLASSES + _BYTE_CLASS[data], minlength=total * _CLASSES).reshape(total, _CLASSES) if len(data) else np.zeros((total, _CLASSES))
    size = counts.sum(axis=1, keepdims=True)
    out = np.empty((total, FEATURES), np.float32)
    out[:, :_CLASSES] = np.sqrt(counts / np.maximum(size, 1))
    words = np.bincount(passage, minlength=total).astype(np.float64)
    some = np.maximum(words, 1)
    h = span_hashes(low, starts, ends)
    order = np.lexsort((h, passage))
    again = np.zeros(len(h), bool)
    again[1:] = (h[order][1:] == h[order][:-1]) & (passage[order][1:] == passage[order][:-1])
    out[:, _CLASSES] = np.bincount(passage[order][again], minlength=total) / some
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (passage[1:] == passage[:-1])
    out[:, _CLASSES + 1] = np.bincount(passage[same], minlength=total) / some
    length = (ends - starts).astype(np.float64)
    mean = np.bincount(passage, weights=length, minlength=total) / some
    spread = np.sqrt(np.maximum(np.bincount(passage, weights=length**2, minlength=total) / some - mean**2, 0))
    out[:, _CLASSES + 2], out[:, _CLASSES + 3] = np.log1p(mean) / 3, np.log1p(spread) / 3
    upper = (data[starts] >= 65) & (data[starts] <= 90)
    out[:, _CLASSES + 4] = np.bincount(passage[upper], minlength=total) / some
    letters = np.concatenate(([0], np.cumsum(np.isin(_BYTE_CLASS[data], (1, 2, 7)))))
    bare = letters[ends] == letters[starts]
    out[:, _CLASSES + 5] = np.bincount(passage[bare], minlength=total) / some
    out[:, _CLASSES + 6] = words / PASSAGE_WORDS
    out[:, _CLASSES + 7] = 1
    return out, place


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Attention:
    """Encoder, gated attention and decision of the network."""

    encode: np.ndarray
    view: np.ndarray
    gate: np.ndarray
    weigh: np.ndarray
    decide: np.ndarray
    bias: np.ndarray

    def forward(self, x: np.ndarray, place: np.ndarray) -> dict[str, np.ndarray]:
        """Scores of bags given as rows of passages and the place of each bag's first."""
        heads, sizes = place[:-1], np.diff(place)
        h = np.tanh(x @ self.encode)
        v, u = np.tanh(h @ self.view), _sigmoid(h @ self.gate)
        e = (v * u) @ self.weigh
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, heads), sizes))
        a = e / np.repeat(np.add.reduceat(e, heads), sizes)
        z = np.add.reduceat(h * a[:, None], heads, axis=0)
        return {"h": h, "v": v, "u": u, "a": a, "z": z, "p": _sigmoid(z @ self.decide + self.bias[0])}

    def step(self, x: np.ndarray, place: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        """Gradients of the mean log loss, in the order of the fields."""
        f = self.forward(x, place)
        sizes = np.diff(place)
        error = (f["p"] - y) / len(y)
        dz = np.repeat(error[:, None] * self.decide, sizes, axis=0)
        dh = dz * f["a"][:, None]
        da = (dz * f["h"]).sum(axis=1)
        mean = np.repeat(np.add.reduceat(da * f["a"], place[:-1]), sizes)
        de = f["a"] * (da - mean)
        gated = f["v"] * f["u"]
        dv = de[:, None] * self.weigh * f["u"] * (1 - f["v"] ** 2)
        du = de[:, None] * self.weigh * f["v"] * f["u"] * (1 - f["u"])
        dh = (dh + dv @ self.view.T + du @ self.gate.T) * (1 - f["h"] ** 2)
        return [x.T @ dh, f["h"].T @ dv, f["h"].T @ du, gated.T @ de, f["z"].T @ error, np.array([error.sum()])]


def fit(bags: list[np.ndarray], labels: np.ndarray, seed: int = 7) -> Attention:
    """Fit by Adam; the same bags in the same order give the same model. Without bags all scores are 0.5."""
    rng = np.random.default_rng(seed)
    shapes = [(FEATURES, HIDDEN), (HIDDEN, ATTENTION), (HIDDEN, ATTENTION), (ATTENTION,), (HIDDEN,), (1,)]
    weights = [rng.normal(0, 1 / np.sqrt(s[0]), s) if len(s) > 1 else np.zeros(s) for s in shapes]
    weights[3] = rng.normal(0, 0.1, shapes[3])
    model = Attention(*weights)
    first, second = [np.zeros(s) for s in shapes], [np.zeros(s) for s in shapes]
    parts = max(1, min(len(bags), 8), len(bags) // BATCH)
    epochs, t = -(-STEPS // parts) if len(bags) else 0, 0
    for epoch in range(epochs):
        rate = RATE * (1 - epoch / epochs)
        for at in np.array_split(rng.permutation(len(bags)), parts):
            x = np.concatenate([bags[i] for i in at])
            place = np.concatenate(([0], np.cumsum([len(bags[i]) for i in at])))
            t += 1
            for w, g, m, v in zip(weights, model.step(x, place, labels[at]), first, second, strict=True):
                g = g + DECAY * w
                m *= 0.9
                m += 0.1 * g
                v *= 0.999
                v += 0.001 * g * g
                w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return model


def held_out(key: str = "doc_id", fold: int = 2, folds: int = 4) -> Column:
    """Rows whose label is never seen: crc32 of the key as text, modulo `folds`, is `fold`. Null keys are not held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(folds)) == fold, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id", text: str = "text", most: int = TRAIN_ROWS) -> Attention:
    """Fit on at most `most` labelled rows outside the held-out fold, chosen by a hash of their key.

    Labels other than 0 and 1, null keys and contradicting labels of one key are left out.
    """
    usable = (
        labels.select(F.col(key), F.col(label).alias("__label"))
        .where(F.col("__label").isin(0, 1) & F.col(key).isNotNull() & ~held_out(key))
        .groupBy(key)
        .agg(F.min("__label").alias("__label"), F.max("__label").alias("__most"))
        .where(F.col("__label") == F.col("__most"))
    )
    chosen = usable.orderBy(F.xxhash64(key), key).limit(most).select(key, "__label")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in chunks(batch.column(1)):
                x, place = passages(data, offsets)
                rows = []
                for i in range(b - a):
                    own = x[place[i] : place[i + 1]]
                    if len(own) > TRAIN_PASSAGES:  # spread over the whole text
                        own = own[np.linspace(0, len(own) - 1, TRAIN_PASSAGES).astype(int)]
                    rows.append(own.astype("<f4").tobytes())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a), pa.array(rows, pa.binary())], ["key", "label", "bag"])

    kind = docs.schema[key].dataType.simpleString()
    found = (
        docs.select(F.col(key), F.col(text).alias("__text"))
        .join(F.broadcast(chosen), key)  # `most` rows at most
        .select(key, "__text", F.col("__label").cast("int"))
        .mapInArrow(encode, f"key {kind}, label int, bag binary")
    )
    # Repeated rows of a key count once; at most `most` bags of TRAIN_PASSAGES passages come to the driver.
    rows = found.groupBy("key").agg(F.min(F.struct("bag", "label")).alias("one")).select("key", "one.bag", "one.label").toArrow().sort_by("key")
    bags = [np.frombuffer(b.as_py(), "<f4").reshape(-1, FEATURES) for b in rows["bag"]]
    return fit(bags, rows["label"].to_numpy().astype(np.float64))


def score_quality(docs: DataFrame, model: Attention, columns: list[str], text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """`columns` of each row of `docs`, and score and predicted, from all passages of its text.

    A null text counts as empty, which is one empty passage. An empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a fixed number of weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [np.zeros(0)]
            for _, _, data, offsets in chunks(batch.column(0)):
                scores.append(shared.value.forward(*passages(data, offsets))["p"])
            p = np.concatenate(scores)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(p), pa.array((p >= threshold).astype(np.int32))], [*columns, "__score", "__predicted"])

    kept = docs.select(F.col(text).alias("__text"), *columns)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[1:])
    return kept.mapInArrow(run, f"{kinds}, __score double, __predicted int")


def classify_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, most: int = TRAIN_ROWS) -> DataFrame:
    """Quality of each text, learnt from the labels outside the held-out fold.

    One row per row of `docs`, repeated rows included: key, held_out, score (0 to 1), predicted (1 from
    `threshold` on). Texts alone are inputs. Null and empty texts get the score of an empty passage; null
    keys stay null. Other columns are not read. Without labels every score is 0.5. An empty table gives an empty result.
    """
    scored = score_quality(docs.select(key, text), train(docs, labels, label, key, text, most), [key], text, threshold)
    return scored.select(key, held_out(key).alias("held_out"), F.col("__score").alias("score"), F.col("__predicted").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, most: int = TRAIN_ROWS) -> DataFrame:
    """The rows of `docs`, all columns as they are, whose text scores `threshold` or more."""
    scored = score_quality(docs, train(docs, labels, label, key, text, most), docs.columns, text, threshold)
    return scored.where("__predicted = 1").drop("__score", "__predicted")
