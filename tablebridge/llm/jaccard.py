"""N-gram Jaccard join by a partition of the universe.

Sets that are nearly equal differ in few elements. Sets are sorted into bands of size; in each band the
universe of elements is cut into segments, one more than the elements in which two linked sets can
differ. So at least one segment of such a pair is equal: its subset is indexed as one hash. Where a
segment's subsets collide much, it can be left out, if another is indexed with all of
its neighbours with one element deleted, which finds pairs that differ there in one element;
costs measured on all sets decide. What meets is verified on the sets themselves.

Empty segments, and those with nothing but a common passage, are equal in many sets. With segments to
spare, linked sets have several keys in common, so each may leave out its empty segments and then its most
frequent keys, up to half of the spare ones: whatever its partner leaves out, one common key remains.

Texts with the same set stand for one node. Nodes that meet are not paired all with all: in
each round every index key picks one of its nodes at random, every other node verifies the most
alike of those it met, and the links found are closed. Once a round finds nothing more, nodes that met and still
lie in different components are verified against each other, all that a parity sketch cannot rule out.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablebridge.llm.components import components
from tablebridge.llm.filters import bit_filter, passes
from tablebridge.llm.storage import stored
from tablebridge.llm.words import chunks, mix, shingles, signed, words

WIDTH = 3
PERCENT = 90
KEY_BITS = 26
ROW_BITS = 25
#: What verifying a pair costs, counted in rows of the index.
PAIR_COST = 4.0
_SIGNS = 4
#: Rounds of random partners at most, and orders that keys draw them by; what they leave is verified in full.
ROUNDS = 2
ORDERS = 8
#: Longs of a parity sketch. Each differing element flips one bit, so unequal bits never exceed the difference.
SKETCH = [f"p{i}" for i in range(8)]


class Bands:
    """Bands of sizes and the segments of each. A set meets sets of its own band and of the one below."""

    def __init__(self, percent: int = PERCENT) -> None:
        share = Fraction(percent, 100)
        low = [1]
        while low[-1] < 1 << 31:
            low.append(int(low[-1] / share) + 1)
        self.low = np.array(low, np.int64)
        # Two sets of sizes s <= r that reach the share differ in at most (s + r)(1 - share)/(1 + share) elements.
        top = [x - 1 for x in low[1:]]
        enough = np.array([int((s + int(s / share)) * (1 - share) / (1 + share)) + 1 for s in top] + [1], np.int64)
        # The fewer elements a segment has, the more are empty: half of the spare ones should cover these.
        elements = np.array([*top, 1]) / (1.2 * enough)
        self.spare = np.where(enough < 12, 0, np.maximum(4, enough * (0.08 + 5 * np.exp(-elements)))).astype(np.int64)
        self.segments = enough + self.spare

    def of(self, size: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.low, size, side="right") - 1


def similar(common: np.ndarray, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    return 100 * common >= percent * (a + b - common)


def sets_of(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text in order, and the place of each text's first."""
    grams, first = shingles(*words(data, offsets), width)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        grams[a:b].sort()
    new = np.ones(len(grams), bool)
    new[1:] = grams[1:] != grams[:-1]
    new[first[:-1][first[:-1] < len(grams)]] = True
    return grams[new], np.concatenate(([0], np.cumsum(new)))[first]


def fingerprints(grams: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One hash for each set."""
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(grams), dtype=np.uint64)))
    return mix(total[first[1:]] - total[first[:-1]] + np.diff(first).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def segment_sums(grams: np.ndarray, first: np.ndarray, band: np.ndarray, bands: Bands) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Segments of sets cut as in `band`: owner, code (band and place), sum of its hashed elements, its first element and its last's next."""
    count = bands.segments[band]
    base = np.concatenate(([0], np.cumsum(count)))
    size = np.diff(first)
    owner = np.repeat(np.arange(len(band)), size)
    where = base[owner] + (((grams >> np.uint64(32)) * count[owner].astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
    edge = np.searchsorted(where, np.arange(base[-1] + 1))
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(grams), dtype=np.uint64)))
    of_segment = np.repeat(np.arange(len(band)), count)
    code = (band[of_segment] << 32) + np.arange(base[-1]) - base[of_segment]
    return of_segment, code, total[edge[1:]] - total[edge[:-1]], edge[:-1], edge[1:]


def keys_of(grams: np.ndarray, first: np.ndarray, band: np.ndarray, bands: Bands, exceptions: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner and key of all index entries of sets cut as in `band`, and how many entries each set may still leave out.

    A segment gives one key, its subset's. Exceptions name segments that give none (-1), or
    also the keys of the subset with one element deleted (1).
    """
    owner, code, sums, start, end = segment_sums(grams, first, band, bands)
    seeded = sums + mix(code.astype(np.uint64))
    codes, kinds = exceptions
    kind = np.zeros(len(code), np.int64)
    if len(codes):
        at = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
        kind = np.where(codes[at] == code, kinds[at], 0)
    empty = start == end
    half = bands.spare[band] // 2
    # Each set leaves out its first empty segments, as many as half of the spare ones weigh up.
    weight = np.where(empty, 1 + kind, 0)
    so_far = np.cumsum(weight)
    so_far -= np.repeat((so_far - weight)[np.searchsorted(owner, np.arange(len(band)))], bands.segments[band]) if len(band) else 0
    left_out = empty & (so_far <= half[owner])
    lost = np.bincount(owner[left_out], weights=weight[left_out], minlength=len(band))
    keep = (kind >= 0) & ~left_out
    near = np.flatnonzero(kind == 1)
    size = (end - start)[near]
    begin = np.concatenate(([0], np.cumsum(size)))
    element = np.repeat(start[near] - begin[:-1], size) + np.arange(begin[-1])
    fewer = np.repeat(seeded[near], size) - mix(grams[element])
    # Where deletions are indexed, one common segment counts as two, so no more is left out there.
    more = np.where(np.bincount(owner[near], minlength=len(band)) == 0, half - lost, 0).astype(np.int64)
    return np.concatenate((owner[keep], np.repeat(owner[near], size))), mix(np.concatenate((seeded[keep], fewer))), more


def subset(grams: np.ndarray, first: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The chosen sets only."""
    size = np.diff(first)[keep]
    place = np.concatenate(([0], np.cumsum(size)))
    return grams[np.repeat(first[:-1][keep] - place[:-1], size) + np.arange(place[-1])], place


class Seen:
    """Tells the sets that this task has not met before."""

    def __init__(self) -> None:
        self.known = np.zeros(0, np.uint64)

    def new(self, prints: np.ndarray) -> np.ndarray:
        own, first = np.unique(prints, return_index=True)
        fresh = ~np.isin(own, self.known, assume_unique=True)
        self.known = np.union1d(self.known, own[fresh])
        return np.sort(first[fresh])


def parity_sketches(grams: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each set a row of longs: bit b tells whether an odd number of elements hash to b."""
    size, bits = np.diff(first), 64 * len(SKETCH)
    spot = np.repeat(np.arange(len(size)) * bits, size) + (mix(grams ^ np.uint64(0xA5A5A5A5A5A5A5A5)) % np.uint64(bits)).astype(np.int64)
    odd = (np.bincount(spot, minlength=len(size) * bits) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view(np.int64).reshape(len(size), len(SKETCH))


def describe(docs: DataFrame, width: int) -> DataFrame:
    """row, key, n (set size), print (0 for empty sets) and sketch of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in chunks(batch.column(2)):
                grams, first = sets_of(data, offsets, width)
                n = np.diff(first)
                prints = np.where(n > 0, fingerprints(grams, first), np.uint64(0))
                sketch = parity_sketches(grams, first).T
                yield pa.RecordBatch.from_arrays([*(batch.column(j).slice(a, b - a) for j in (0, 1)), pa.array(n), pa.array(signed(prints)), *map(pa.array, sketch)], ["row", "key", "n", "print", *SKETCH])

    kind = docs.schema["key"].dataType.simpleString()
    return docs.select("row", "key", "text").mapInArrow(run, f"row long, key {kind}, n long, print long, " + ", ".join(f"{c} long" for c in SKETCH))


def segment_costs(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """band, place and what indexing a segment costs: rows, elements, rows with one element or none, and signed sums whose squares estimate the pairs that meet."""
    names = ["code", "rows", "elements", "tiny", *(f"s{j}" for j in range(_SIGNS))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, seen, parts = Bands(percent), Seen(), []

        def summed() -> list[np.ndarray]:
            code = np.concatenate([p[0] for p in parts])
            own, which = np.unique(code, return_inverse=True)
            return [own] + [np.bincount(which, weights=np.concatenate([p[j] for p in parts]), minlength=len(own)) for j in range(1, len(names))]

        for batch in batches:
            for _, _, data, offsets in chunks(batch.column(0)):
                grams, first = sets_of(data, offsets, width)
                keep = seen.new(fingerprints(grams, first))
                band = bands.of(np.maximum(np.diff(first), 1))
                keep = keep[bands.segments[band[keep]] > 1]
                grams, first = subset(grams, first, keep)
                _, code, sums, start, end = segment_sums(grams, first, band[keep], bands)
                key = mix(sums + mix(code.astype(np.uint64)))
                size = end - start
                signs = [(((key >> np.uint64(j)) & np.uint64(1)).astype(np.float64) * 2 - 1) * (size > 0) for j in range(_SIGNS)]
                parts.append([code, np.ones(len(code)), size.astype(np.float64), (size <= 1).astype(np.float64), *signs])
            if parts:
                parts = [summed()]
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array(parts[0][0]), *(pa.array(x.astype(np.int64)) for x in parts[0][1:])], names)

    rows = docs.select("text").mapInArrow(run, ", ".join(f"{n} long" for n in names))
    sums = rows.groupBy("code").agg(*(F.sum(n).alias(n) for n in names[1:]))
    return sums.withColumn("band", F.shiftright("code", 32))


def allocate(costs: pa.Table) -> pa.Table:
    """Exceptions of one band: code, kind.

    The costliest segment is left out if another with its deletions costs less than it; and so on with the next.
    """
    codes, rows, elements, tiny = (costs[c].to_numpy() for c in ("code", "rows", "elements", "tiny"))
    squares = np.mean([costs[f"s{j}"].to_numpy().astype(np.float64) ** 2 for j in range(_SIGNS)], axis=0)
    meet = np.maximum(squares - rows, 0) / 2
    equal = rows + PAIR_COST * meet
    # With one element deleted, all segments of one element or none meet.
    deleted = elements + PAIR_COST * (meet * (1 + elements / np.maximum(rows, 1)) + tiny.astype(np.float64) ** 2 / 2)
    dear, cheap = np.argsort(-equal, kind="stable"), np.argsort(deleted, kind="stable")
    out, near, used, at = [], [], set(), 0
    for i in dear.tolist():
        while at < len(cheap) and int(cheap[at]) in used:
            at += 1
        if at == len(cheap) or i in used or int(cheap[at]) == i or deleted[cheap[at]] >= equal[i]:
            break
        used |= {i, int(cheap[at])}
        out.append(i)
        near.append(int(cheap[at]))
    kinds = np.repeat([-1, 1], [len(out), len(near)]).astype(np.int32)
    return pa.table({"code": pa.array(np.concatenate((codes[out], codes[near])), pa.int64()), "kind": pa.array(kinds)})


def index_entries(docs: DataFrame, width: int, percent: int, exceptions: tuple[np.ndarray, np.ndarray], keep_keys: np.ndarray | None = None) -> DataFrame:
    """key, print, own, spare: entries of the sets in their own band, and in the band below where they probe (own is false).

    Without a filter only the keys come.
    """
    shared = docs.sparkSession.sparkContext.broadcast((exceptions, keep_keys))  # the exceptions, and a filter of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unusual, table = shared.value
        bands, seen = Bands(percent), Seen()
        for batch in batches:
            for _, _, data, offsets in chunks(batch.column(0)):
                grams, first = sets_of(data, offsets, width)
                prints = fingerprints(grams, first)
                keep = seen.new(prints)
                n = np.diff(first)[keep]
                keep, n = keep[n > 0], n[n > 0]
                band = bands.of(n)
                least = -(-n * percent // 100)
                for own in (True, False):
                    cut = band if own else band - 1
                    # One segment means that only equal sets are linked, and these are one node already.
                    meets = (bands.segments[cut] > 1) & (own | ((cut >= 0) & (least < bands.low[band])))
                    rows, at = keep[meets], cut[meets]
                    owner, key, spare = keys_of(*subset(grams, first, rows), at, bands, unusual)
                    if table is None:
                        yield pa.RecordBatch.from_arrays([pa.array(signed(key))], ["key"])
                        continue
                    some = passes(table, key)
                    owner = owner[some]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(signed(key[some])), pa.array(signed(prints[rows][owner])), pa.array(np.full(len(owner), own)), pa.array(spare[owner])],
                        ["key", "print", "own", "spare"],
                    )

    return docs.select("text").mapInArrow(run, "key long" if keep_keys is None else "key long, print long, own boolean, spare long")


def node_sets(docs: DataFrame, width: int, wanted: np.ndarray) -> DataFrame:
    """print and set (sorted hashes as bytes) of the rows that the filter lets through."""
    shared = docs.sparkSession.sparkContext.broadcast(wanted)  # a filter of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = passes(shared.value, batch.column(0).to_numpy().view(np.uint64))
            for _, _, data, offsets in chunks(batch.column(1).take(pa.array(at))):
                grams, first = sets_of(data, offsets, width)
                out = [grams[a:b].tobytes() for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(signed(fingerprints(grams, first))), pa.array(out, pa.binary())], ["print", "set"])

    return docs.select("row", "text").mapInArrow(run, "print long, set binary")


def verified(pairs: DataFrame, percent: int) -> DataFrame:
    """a, b of the pairs whose sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                x, y = (np.frombuffer(batch.column(j)[i].as_buffer(), np.uint64) for j in (2, 3))
                both = np.concatenate((x, y))
                both.sort(kind="stable")
                good[i] = similar((both[1:] == both[:-1]).sum(), len(x), len(y), percent)
            at = pa.array(np.flatnonzero(good))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at)], ["a", "b"])

    return pairs.select("a", "b", "set_a", "set_b").mapInArrow(run, "a long, b long").distinct()


def may_be_similar(percent: int, other: str = "_y") -> Column:
    """What sizes and sketches of two nodes, whose columns end in `other` for the second, leave possible."""
    n, m = F.col("n"), F.col(f"n{other}")
    return (F.least(n, m) * 100 >= F.greatest(n, m) * percent) & (unequal_bits(other) * (100 + percent) <= (n + m) * (100 - percent))


def unequal_bits(other: str = "_y") -> Column:
    return sum((F.bit_count(F.col(c).bitwiseXOR(F.col(f"{c}{other}"))) for c in SKETCH[1:]), F.bit_count(F.col(SKETCH[0]).bitwiseXOR(F.col(f"{SKETCH[0]}{other}"))))


def verify(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The linked ones among pairs (a, b) of nodes, written; sets are made anew from the texts that stand for the nodes."""

    def sets(side: str) -> DataFrame:
        own = pairs.select(F.col(side).alias("print")).distinct().join(nodes, "print").select("row")
        return node_sets(docs, width, bit_filter(own, "row", ROW_BITS)).select(F.col("print").alias(side), F.col("set").alias(f"set_{side}"))

    return stored(verified(pairs.join(sets("a"), "a").join(sets("b"), "b"), percent), "jaccard-links")


def meetings(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """key, print, own: the index entries that nodes can meet by, without each node's most frequent spare ones."""
    kinds = segment_costs(docs, width, percent).groupBy("band").applyInArrow(allocate, "code long, kind int").toArrow().sort_by("code")
    exceptions = (kinds["code"].to_numpy(), kinds["kind"].to_numpy().astype(np.int64))
    shared = index_entries(docs, width, percent, exceptions).groupBy("key").agg(F.count("*").alias("times")).where("times > 1")
    shared = stored(shared, "jaccard-keys")
    again = index_entries(docs, width, percent, exceptions, bit_filter(shared, "key", KEY_BITS)).distinct()
    frequent = Window.partitionBy("print", "own").orderBy(F.desc("times"), "key")
    kept = again.join(shared, "key").withColumn("place", F.row_number().over(frequent)).where("place > spare")
    return stored(kept.select("key", "print", "own"), "jaccard-members")


def unsettled(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    """key, print, own, label of the keys whose nodes lie in different components so far."""
    if labels is None:
        return members.withColumn("label", F.col("print"))
    named = members.join(labels.select(F.col("node").alias("print"), "label"), "print", "left").withColumn("label", F.coalesce("label", "print"))
    mixed = named.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("key")
    return stored(named.join(mixed, "key").select("key", "print", "own", "label"), "jaccard-open")


def second(nodes: DataFrame) -> DataFrame:
    """Nodes with columns named as a pair's second."""
    return nodes.select(*(F.col(c).alias(f"{c}_y") for c in ("print", "n", *SKETCH)))


def random_partners(members: DataFrame, nodes: DataFrame, turn: int, percent: int) -> DataFrame:
    """a, b: for each node the most alike of those that its keys pick in this turn, if it may be similar.

    Keys fall into ORDERS kinds, each with a random order of the nodes of its own, and pick their first.
    """
    kind = F.col("key").bitwiseAND(F.lit(ORDERS - 1).cast("long"))
    drawn = members.withColumn("draw", F.xxhash64("print", kind, F.lit(turn)))
    picks = drawn.groupBy("key").agg(F.min("draw").alias("pick"))
    picked = drawn.select(F.col("draw").alias("pick"), F.col("print").alias("print_y"), F.col("label").alias("label_y")).distinct()
    met = drawn.join(picks, "key").where("draw <> pick").select("print", "label", "pick").distinct().join(picked, "pick")
    pairs = met.where("label <> label_y").select("print", "print_y").distinct()
    alike = pairs.join(nodes, "print").join(second(nodes), "print_y").where(may_be_similar(percent))
    best = alike.groupBy(F.col("print").alias("a")).agg(F.min(F.struct(unequal_bits().alias("bits"), "print_y")).alias("best"))
    return stored(best.select("a", F.col("best.print_y").alias("b")), "jaccard-pairs")


def all_pairs_left(members: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """a, b: nodes that met, lie in different components and may be similar."""
    x = members.join(nodes.select("print", "n", *SKETCH), "print")
    y = x.select("key", *(F.col(c).alias(f"{c}_y") for c in x.columns if c != "key"))
    apart = (F.col("print") > F.col("print_y")) & (F.col("label") != F.col("label_y")) & (F.col("own") | F.col("own_y"))
    return x.join(y, "key").where(apart & may_be_similar(percent)).select(F.col("print").alias("a"), F.col("print_y").alias("b")).distinct()


def near_components(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """row, key, n, component (a number) of every row of `docs` (row, key, text); rows with empty sets have none."""
    described = stored(describe(docs, width), "jaccard-sets")
    nodes = described.where("n > 0").groupBy("print").agg(*(F.min(c).alias(c) for c in ("row", "n", *SKETCH)))
    nodes = stored(nodes, "jaccard-nodes")
    members = meetings(docs, width, percent)
    labels, links, tried = None, None, None
    for turn in range(ROUNDS):
        pairs = random_partners(unsettled(members, labels), nodes, turn, percent)
        found = verify(pairs, nodes, docs, width, percent)
        tried = pairs if tried is None else tried.unionByName(pairs)
        links = found if links is None else links.unionByName(found)
        if found.isEmpty():
            break
        labels = components(links)
    rest = all_pairs_left(unsettled(members, labels), nodes, percent).join(tried, ["a", "b"], "left_anti")
    more = verify(stored(rest, "jaccard-pairs"), nodes, docs, width, percent)
    labels = components(links.unionByName(more))
    named = described.join(labels.select(F.col("node").alias("print"), "label"), "print", "left")
    return named.select("row", "key", "n", F.when(F.col("n") > 0, F.coalesce("label", "print")).alias("component"))


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.xxhash64(key, text).alias("row"), F.col(key).alias("key"), F.col(text).alias("text"))


def jaccard_groups(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Groups of texts that links of similar shingle sets connect: key, n_shingles, component_id (a group's smallest key).

    Two texts link when 100 times their common shingles is at least `percent` times their union. One row per row of
    `docs`, repeated rows included. Null, empty and blank texts have no shingles, link with nothing and are their
    own component; fewer words than `width` are one shingle. Null keys stay null and name no component unless
    all its keys are null. Other columns are not read. An empty table gives an empty result.
    """
    found = stored(near_components(_rows(docs, key, text), width, percent), "jaccard-groups")
    # Written, so that the join deals both sides anew and a group of many texts can be split.
    least = stored(found.where("component is not null").groupBy("component").agg(F.min("key").alias("least")), "jaccard-least")
    named = found.join(least, "component", "left")
    return named.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("key")).alias("component_id"))


def keep_one_of_each(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with one row of each group, all columns as they are: the smallest key's, null keys last.

    Rows that repeat key and text are one document. Texts without words all stay.
    """
    found = near_components(_rows(docs, key, text), width, percent)
    place = F.struct(F.col("key").isNull().alias("last"), "key", "row")
    kept = found.groupBy(F.coalesce("component", "row").alias("component"), F.col("component").isNull()).agg(F.min(place).alias("kept")).select(F.col("kept.row").alias("__row"))
    return docs.withColumn("__row", F.xxhash64(key, text)).join(kept, "__row").dropDuplicates(["__row"]).drop("__row")
