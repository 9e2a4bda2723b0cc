"""Benchmark decontamination by spaced-seed hashing.

A fixed mask looks at some tokens of a window and ignores the others, so a window with
substitutions in ignored places still hashes the same. Windows of all benchmark items and of all
texts are hashed under every mask and joined; around each hit the two token sequences are laid
over each other and an overlap must agree in most places. A bit filter of fixed size,
built from the benchmark's hashes, keeps text windows without any partner out of the join.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablebridge.llm.filters import bit_filter, passes
from tablebridge.llm.storage import stored
from tablebridge.llm.words import chunks, mix, signed, words

#: Windows of up to twelve tokens, of which six are looked at. However the substitutions lie, one of these
#: meets none of them somewhere in any overlap of 13 tokens or more that agrees in 80 percent (tested by enumeration).
MASKS = ("11101011", "11001000111", "101000100111", "111111")
#: An overlap has this many tokens, or a shorter item's all, and agrees in this share of places.
LEAST_TOKENS = 13
AGREEMENT = 0.8
#: Items below this length match too much by chance and are left out.
LEAST_ITEM = 5
#: Bits of the filter: 1 MB whatever the benchmark's size.
FILTER_BITS = 23
#: Tokens kept on either side of hits, and tokens between the outermost hits of one stretch, unless an item is longer.
REACH = 32
STRETCH = 256

#: Bytes of words: digits, letters and all beyond ASCII.
_WORD_BYTES = np.zeros(256, dtype=bool)
_WORD_BYTES[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def masked_hashes(h: np.ndarray, first: np.ndarray, mask: str) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of all windows within texts under a mask."""
    span, n = len(mask), len(h)
    if n < span:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    total = np.full(n - span + 1, hash_of_mask(mask), np.uint64)
    for j, bit in enumerate(mask):
        if bit == "1":
            total += h[j : n - span + 1 + j] * np.uint64(2 * j + 3)
            total = (total ^ (total >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    at = np.flatnonzero(text[: n - span + 1] == text[span - 1 :])
    return at, mix(total[at])


def hash_of_mask(mask: str) -> np.uint64:
    """A start value of its own for each mask."""
    return mix(np.array([int("1" + mask.replace("0", "2"), 3)], np.uint64))[0]


def short_masks(n: int, agreement: float = AGREEMENT) -> list[str]:
    """Masks over all n tokens of a short item, one of which ignores any places that may be substituted.

    Places are dealt to two groups more than substitutions are allowed; each mask looks at two groups.
    """
    allowed = int(n * (1 - agreement) + 1e-9)
    if not allowed:
        return ["1" * n]
    return ["".join("1" if i % (allowed + 2) in looked else "0" for i in range(n)) for looked in itertools.combinations(range(allowed + 2), 2)]


def masks_for(lengths: list[int], least: int = LEAST_TOKENS, agreement: float = AGREEMENT) -> list[tuple[str, int]]:
    """(mask, length of the items it is for): those of `MASKS` for items of `least` tokens or more (0), and own ones for each length below."""
    return [*((mask, 0) for mask in MASKS), *((mask, n) for n in sorted(set(lengths)) if LEAST_ITEM <= n < least for mask in short_masks(n, agreement))]


def best_overlap(a: np.ndarray, b: np.ndarray, shift: int, agreement: float = AGREEMENT) -> tuple[int, int, int]:
    """(start in a, length, equal places) of the overlap of a[i + shift] with b[i] that agrees best.

    A place that agrees counts 1, one that does not costs what keeps the share of agreeing places at
    `agreement`; the stretch with the greatest sum is taken.
    """
    low, high = max(0, -shift), min(len(b), len(a) - shift)
    if high <= low:
        return 0, 0, 0
    equal = a[low + shift : high + shift] == b[low:high]
    total = np.concatenate(([0.0], np.cumsum(np.where(equal, 1.0, -agreement / (1 - agreement)))))
    least = np.minimum.accumulate(total)
    end = int(np.argmax(total - least))
    start = int(np.argmin(total[: end + 1]))
    return low + shift + start, end - start, int(equal[start:end].sum())


def longest_overlap(a: np.ndarray, b: np.ndarray, shift: int, agreement: float = AGREEMENT) -> tuple[int, int, int]:
    """(start in a, length, equal places) of the longest overlap of a[i + shift] with b[i] that agrees in a share of `agreement`.

    Of equally long ones that with more equal places, then the first.
    """
    low, high = max(0, -shift), min(len(b), len(a) - shift)
    if high <= low:
        return 0, 0, 0
    equal = np.concatenate(([0], np.cumsum(a[low + shift : high + shift] == b[low:high])))
    total = equal - agreement * np.arange(len(equal))
    # For each end the first start whose sum is not above the end's own, rounding aside.
    start = np.searchsorted(-np.minimum.accumulate(total), -(total + 1e-9))
    end = np.arange(len(equal))
    best = int(np.lexsort((start, -(equal - equal[start]), start - end))[0])
    return low + shift + int(start[best]), int(best - start[best]), int(equal[best] - equal[start[best]])


def item_sequences(benchmark: DataFrame, item: str, text: str) -> DataFrame:
    """item, tokens of each distinct token sequence; the smallest item id stands for its repeats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in chunks(batch.column(1)):
                h, first = words(data, offsets, _WORD_BYTES)
                lists = pa.LargeListArray.from_arrays(pa.array(first), pa.array(signed(h))).cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), lists], ["item", "tokens"])

    kind = benchmark.schema[item].dataType.simpleString()
    found = benchmark.select(item, text).mapInArrow(run, f"item {kind}, tokens array<long>").where(F.size("tokens") >= LEAST_ITEM)
    return found.groupBy("tokens").agg(F.min("item").alias("item")).select("item", F.xxhash64("tokens").alias("sequence"), "tokens")


def item_windows(items: DataFrame, masks: list[tuple[str, int]], least: int = LEAST_TOKENS) -> DataFrame:
    """hash, sequence, place of all windows of items under the masks for their length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            n = lists.value_lengths().to_numpy()
            first = np.concatenate(([0], np.cumsum(n)))
            h = lists.flatten().to_numpy().view(np.uint64)
            owner = np.repeat(np.arange(len(n)), n)
            for mask, length in masks:
                at, found = masked_hashes(h, first, mask)
                keep = n[owner[at]] == length if length else n[owner[at]] >= least
                at, found = at[keep], found[keep]
                rows = owner[at]
                yield pa.RecordBatch.from_arrays([pa.array(signed(found)), batch.column(0).take(pa.array(rows)), pa.array((at - first[rows]).astype(np.int32))], ["hash", "sequence", "place"])

    return items.select("sequence", "tokens").mapInArrow(run, "hash long, sequence long, place int").dropDuplicates()


def stretches(docs: DataFrame, row: str, text: str, masks: list[str], table: np.ndarray, longest: int = 0) -> DataFrame:
    """row (what column `row` has), start, tokens, hashes, places: the stretches of texts that hold windows which pass the filter.

    A stretch goes on for as many tokens as the `longest` item has on either side of its hits, so it holds all of any overlap.
    """
    shared = docs.sparkSession.sparkContext.broadcast((masks, table))  # the filter's fixed size
    reach, most = max(REACH, longest), max(STRETCH, longest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_masks, bits = shared.value
        for batch in batches:
            for a, _, data, offsets in chunks(batch.column(1)):
                h, first = words(data, offsets, _WORD_BYTES)
                place, hashes, end = [], [], []
                for mask in own_masks:
                    at, found = masked_hashes(h, first, mask)
                    hit = passes(bits, found)
                    place.append(at[hit])
                    hashes.append(found[hit])
                    end.append(at[hit] + len(mask))
                place, hashes, end = np.concatenate(place), np.concatenate(hashes), np.concatenate(end)
                if not len(place):
                    continue
                order = np.argsort(place, kind="stable")
                place, hashes, end = place[order], hashes[order], end[order]
                doc = np.searchsorted(first, place, side="right") - 1
                new = np.ones(len(place), bool)
                new[1:] = (doc[1:] != doc[:-1]) | (place[1:] - place[:-1] > reach)
                # A stretch of many hits goes on as a new one after `most` tokens.
                run_start = np.maximum.accumulate(np.where(new, np.arange(len(place)), 0))
                part = (place - place[run_start]) // most
                new[1:] |= (run_start[1:] == run_start[:-1]) & (part[1:] != part[:-1])
                heads = np.flatnonzero(new)
                tails = np.append(heads[1:], len(place))
                low = np.maximum(first[doc[heads]], place[heads] - reach)
                high = np.minimum(first[doc[heads] + 1], np.maximum.reduceat(end, heads) + reach)
                size = high - low
                bounds = np.concatenate(([0], np.cumsum(size)))
                tokens = h[np.repeat(low - bounds[:-1], size) + np.arange(bounds[-1])]
                own = pa.array(np.append(heads, len(place)))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(a + doc[heads])),
                        pa.array(low - first[doc[heads]]),
                        pa.LargeListArray.from_arrays(pa.array(bounds), pa.array(signed(tokens))).cast(pa.list_(pa.int64())),
                        pa.LargeListArray.from_arrays(own, pa.array(signed(hashes))).cast(pa.list_(pa.int64())),
                        pa.LargeListArray.from_arrays(own, pa.array((place - np.repeat(low, tails - heads)).astype(np.int32))).cast(pa.list_(pa.int32())),
                    ],
                    ["row", "start", "tokens", "hashes", "places"],
                )

    kind = docs.schema[row].dataType.simpleString()
    return docs.select(row, text).mapInArrow(run, f"row {kind}, start long, tokens array<long>, hashes array<long>, places array<int>")


def verified(candidates: DataFrame, least: int, agreement: float) -> DataFrame:
    """row, item, start, length, matched of the candidates whose overlap is long and equal enough.

    The overlap is the one that agrees best; if that is too short, the longest one that agrees in enough places.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, item, start, tokens, shift, sequence = (batch.column(i) for i in range(6))
            kept, out = [], [[], [], []]
            for i in range(batch.num_rows):
                a, b = tokens[i].values.to_numpy(), sequence[i].values.to_numpy()
                at, n, equal = best_overlap(a, b, shift[i].as_py(), agreement)
                if n < min(least, len(b)):  # the sum ends before a substitution with few equal places behind it
                    at, n, equal = longest_overlap(a, b, shift[i].as_py(), agreement)
                if n >= min(least, len(b)):
                    kept.append(i)
                    for column, value in zip(out, (start[i].as_py() + at, n, equal), strict=True):
                        column.append(value)
            rows = pa.array(kept, pa.int64())
            yield pa.RecordBatch.from_arrays([row.take(rows), item.take(rows), *(pa.array(c, pa.int64()) for c in out)], ["row", "item", "start", "length", "matched"])

    kind, row_kind = (candidates.schema[c].dataType.simpleString() for c in ("item", "row"))
    return candidates.select("row", "item", "start", "tokens", "shift", "sequence_tokens").mapInArrow(run, f"row {row_kind}, item {kind}, start long, length long, matched long")


def overlaps(docs: DataFrame, benchmark: DataFrame, row: str, text: str, item: str, item_text: str, least: int, agreement: float) -> DataFrame:
    """row, item, start, length, matched: the longest verified overlap of each text row with each item."""
    items = stored(item_sequences(benchmark, item, item_text), "benchmark-items")
    sizes = items.select(F.size("tokens").alias("n"))
    lengths = [r.n for r in sizes.where(F.col("n") < least).distinct().collect()]  # a dozen at most
    longest = sizes.agg(F.max("n")).first()[0] or 0
    masks = masks_for(lengths, least, agreement)
    windows = stored(item_windows(items, masks, least), "benchmark-windows")
    looks = list(dict.fromkeys(mask for mask, _ in masks))
    found = stored(stretches(docs, row, text, looks, bit_filter(windows, "hash", FILTER_BITS), longest).withColumn("stretch", F.monotonically_increasing_id()), "stretches")
    hits = found.select("stretch", F.explode(F.arrays_zip("hashes", "places")).alias("hit")).select("stretch", F.col("hit.hashes").alias("hash"), F.col("hit.places").alias("at"))
    pairs = hits.join(windows, "hash").select("stretch", "sequence", (F.col("at") - F.col("place")).alias("shift")).distinct()
    laid = pairs.join(found.select("stretch", "row", "start", "tokens"), "stretch").join(items.select("sequence", "item", F.col("tokens").alias("sequence_tokens")), "sequence")
    good = verified(laid, least, agreement)
    longest = F.max(F.struct("length", "matched", (-F.col("start")).alias("back")))
    return good.groupBy("row", "item").agg(longest.alias("best")).select("row", "item", (-F.col("best.back")).alias("start"), "best.length", "best.matched")


def find_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    least: int = LEAST_TOKENS,
    agreement: float = AGREEMENT,
) -> DataFrame:
    """Documents that hold a passage of a benchmark item: key, item, first_token, n_tokens, n_matched.

    One row per contaminated key and item (of items with the same tokens the smallest id), with the
    longest overlap of those `verified` finds, counted in tokens of letters and digits. Clean documents have no row. Null and empty
    texts and items hold nothing; repeated rows count once; a null key stays null; items of fewer
    than LEAST_ITEM tokens are left out. Other columns are not read. An empty table gives an empty result.
    """
    found = overlaps(docs, benchmark, key, text, item, item_text, least, agreement)
    return found.select(F.col("row").alias(key), F.col("item").alias("item_id"), F.col("start").alias("first_token"), F.col("length").alias("n_tokens"), F.col("matched").alias("n_matched"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """The rows of `docs`, all columns as they are, that hold no passage of a benchmark item."""
    rows = docs.withColumn("__row", F.xxhash64(key, text))
    settings = {"item": "item_id", "item_text": "text", "least": LEAST_TOKENS, "agreement": AGREEMENT} | settings
    found = overlaps(rows, benchmark, "__row", text, **settings)
    return rows.join(found.select(F.col("row").alias("__row")).distinct(), "__row", "left_anti").drop("__row")
