"""Periodic runs of words, by tiles per period octave.

A run is a stretch of words that repeats with a period and cannot be extended. Periods are
handled by octaves, 2**k to 2**(k+1) - 1. For each octave a text is exploded into tiles
that overlap by twice the greatest period, and tiles are solved on their own: boundaries stand
every 2**k words, so a stretch of two periods has one in its first period. The Z-function at a
boundary says for each period how far the words from there on agree with those one period later,
the Z-function of the reversed tile how far those before it do; together they give the fragment of a
run that lies in the tile. Values of the Z-functions are found for all boundaries and periods of an octave at
once, by bisection on prefix hashes, and only where enough words can agree.

Fragments are shuffled by text and period, and those that overlap by a period are stitched.
Tiles are solved where their text is: moved, they would weigh the text's length times its octaves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablebridge.llm.filters import bit_filter, passes
from tablebridge.llm.storage import stored
from tablebridge.llm.words import chunks, mix, span_hashes, word_spans

#: Words that a run has at least.
LEAST = 12
#: Words of a tile: at least so many, and so many for each word of the octave's first period.
TILE = 4096
TILE_PERIODS = 16
#: Words of tiles that are solved at a time; a tile of a high octave may be larger.
BATCH = 1 << 18
#: The filter of texts that have runs takes 2**FILTER_BITS bits.
FILTER_BITS = 23

BLANKS = r"[\x20\x09-\x0D]+"
RUNS = "array<struct<start:long,period:long,length:long>>"

_PRIMES = ((2147483647, 1220703125), (2147483629, 1977326743))
_powers: dict[int, np.ndarray] = {}
_factors: list[np.ndarray] = [np.ones(2, np.int64)]


def powers(n: int, prime: int, base: int) -> np.ndarray:
    """base**i modulo the prime for i below n."""
    table = _powers.get(prime, np.ones(1, np.int64))
    while len(table) < n:
        table = np.concatenate((table, table * pow(base, len(table), prime) % prime))
    _powers[prime] = table
    return table


def least_factors(n: int) -> np.ndarray:
    """The least prime factor of each number below n; 1 for 1."""
    if len(_factors[0]) < n:
        size = max(n, 2 * len(_factors[0]))
        table = np.arange(size, dtype=np.int64)
        for i in range(2, int(size**0.5) + 1):
            if table[i] == i:
                multiples = table[i * i :: i]
                multiples[multiples == np.arange(i * i, size, i)] = i
        table[0] = 1
        _factors[0] = table
    return _factors[0]


class Symbols:
    """A sequence of 64-bit symbols whose stretches can be compared at any places, by two hashes of 31 bits."""

    def __init__(self, x: np.ndarray):
        self.x = x
        self.tables = []
        for i, (prime, base) in enumerate(_PRIMES):
            power = powers(len(x) + 1, prime, base)
            value = ((x >> np.uint64(32 * i)) & np.uint64(0xFFFFFFFF)).astype(np.int64) % prime
            total = np.zeros(len(x) + 1, np.int64)
            np.cumsum(value * power[: len(x)] % prime, out=total[1:])
            total %= prime
            self.tables.append((total, power, prime))

    def equal(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether x[a:a+length] and x[b:b+length] agree, for a <= b."""
        same = np.ones(len(a), bool)
        for total, power, prime in self.tables:
            early = (total[a + length] - total[a]) % prime * power[b - a] % prime
            same &= early == (total[b + length] - total[b]) % prime
        return same

    def z(self, a: np.ndarray, b: np.ndarray, backwards: bool) -> np.ndarray:
        """How many symbols from a and from b on agree; backwards, how many before them."""
        low = np.zeros(len(a), np.int64)
        high = a.copy() if backwards else len(self.x) - b
        at = np.flatnonzero(low < high)
        while len(at):
            middle = (low[at] + high[at] + 1) // 2
            shift = middle if backwards else 0
            same = self.equal(a[at] - shift, b[at] - shift, middle)
            low[at[same]] = middle[same]
            high[at[~same]] = middle[~same] - 1
            at = at[low[at] < high[at]]
        return low


def solve(symbols: Symbols, octave: int, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(period, start, end) of all longest stretches whose smallest period lies in the octave.

    They have two periods and `least` symbols at least. Tiles end in symbols that occur once, so none crosses tiles.
    """
    x, step = symbols.x, 1 << octave
    n = len(x)
    rows = -(-n // step)

    def first_agree(y: np.ndarray) -> np.ndarray:
        # The symbol at each boundary against those one period later, which fill the next row.
        grid = np.concatenate((y, np.zeros((rows + 1) * step - n, np.uint64))).reshape(rows + 1, step)
        return grid[1:] == grid[:-1, :1]

    right = first_agree(x)
    left = first_agree(np.concatenate((x[:1], x[:-1])))
    left[0] = False
    i, j = np.nonzero(right | left)
    inside = (i + 1) * step + j < n
    i, j = i[inside], j[inside]
    b, p = i * step, step + j
    # The words that agree before and after are a period together, so one side has half of that.
    half = (np.maximum(p, least - p) + 1) // 2
    ahead = right[i, j] & (b + p + half <= n)
    behind = left[i, j] & (b >= half)
    good = np.zeros(len(b), bool)
    good[ahead] = symbols.equal(b[ahead], (b + p)[ahead], half[ahead])
    behind &= ~good
    good[behind] = symbols.equal((b - half)[behind], (b + p - half)[behind], half[behind])
    b, p = b[good], p[good]
    # A stretch of two periods with a smaller one has one that divides it, p over some prime; its first period shows it.
    smallest = np.ones(len(p), bool)
    rest = p.copy()
    factor = least_factors(2 * step)
    at = np.flatnonzero(rest > 1)
    while len(at):
        f = factor[rest[at]]
        q = p[at] // f
        smallest[at[symbols.equal(b[at], b[at] + q, p[at] - q)]] = False
        rest[at] //= f
        at = at[(rest[at] > 1) & smallest[at]]
    b, p = b[smallest], p[smallest]
    start = b - symbols.z(b, b + p, True)
    end = b + p + symbols.z(b, b + p, False)
    enough = end - start >= np.maximum(least, 2 * p)
    start, end, p = start[enough], end[enough], p[enough]
    _, once = np.unique(p * np.int64(n + 1) + start, return_index=True)
    return p[once], start[once], end[once]


def tiles(first: np.ndarray, octave: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, start and end of the tiles of an octave, given the place of each text's first word.

    Texts too short for two periods of the octave, or for a run, have none.
    """
    n = np.diff(first)
    size, overlap = max(TILE, TILE_PERIODS << octave), max(LEAST, 4 << octave)
    stride = size - overlap
    count = np.where(n <= size, 1, -(-(n - overlap) // stride))
    count[n < max(LEAST, 2 << octave)] = 0
    text = np.repeat(np.arange(len(n)), count)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    start = first[text] + nth * stride
    return text, start, np.minimum(start + size, first[text + 1])


def fragments(words: np.ndarray, first: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(text, period, start, end) of the fragments of runs in all tiles of all octaves; places count within texts."""
    longest = int(np.diff(first).max(initial=0))
    if longest < LEAST:
        return
    symbols: Symbols | None = None
    for octave in range((longest // 2).bit_length()):
        if symbols is None or longest > TILE:
            text, start, end = tiles(first, octave)
            batch = np.cumsum(end - start) // BATCH
        for number in np.unique(batch):
            own = np.flatnonzero(batch == number)
            length = end[own] - start[own] + 1
            place = np.concatenate(([0], np.cumsum(length)))
            if symbols is None or longest > TILE:
                # Behind each tile stands a symbol that occurs nowhere else.
                index = np.repeat(start[own] - place[:-1], length) + np.arange(place[-1])
                index[place[1:] - 1] = 0
                x = words[index]
                x[place[1:] - 1] = mix(own.astype(np.uint64) + np.uint64(1 << 63))
                symbols = Symbols(x)
            period, a, b = solve(symbols, octave)
            tile = np.searchsorted(place, a, side="right") - 1
            doc = text[own][tile]
            shift = start[own][tile] - place[tile] - first[doc]
            yield doc, period, a + shift, b + shift


def runs_of(texts: DataFrame, text: str = "text") -> DataFrame:
    """`print` (the text's md5, 16 bytes) and `runs` of each different text that has runs, by start, then period.

    Equal texts share a row. Null texts and texts without runs have none. Words are what stands between blanks
    and line breaks, letter case included; a run has 12 words and two periods at least.
    """
    own = texts.select(F.unhex(F.md5(F.col(text))).alias("print"), F.col(text).alias("text")).where("text is not null")

    def solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, _, data, offsets in chunks(batch.column(1)):
                starts, ends, first = word_spans(data, offsets)
                for doc, period, start, end in fragments(span_hashes(data, starts, ends), first):
                    names = batch.column(0).take(pa.array(low + doc))
                    yield pa.RecordBatch.from_arrays([names, *(pa.array(c.astype(np.int64)) for c in (period, start, end))], ["print", "period", "start", "end"])

    found = own.mapInArrow(solved, "print binary, period long, start long, end long").distinct()
    before = Window.partitionBy("print", "period").orderBy("start", "end")
    reached = F.max("end").over(before.rowsBetween(Window.unboundedPreceding, -1))
    # Two runs of one period share less than a period, two fragments of one run at least two.
    opens = F.coalesce((reached - F.col("start") < F.col("period")).cast("int"), F.lit(1))
    stitched = found.withColumn("opens", opens).withColumn("nth", F.sum("opens").over(before))
    runs = stitched.groupBy("print", "period", "nth").agg(F.min("start").alias("start"), (F.max("end") - F.min("start")).alias("length"))
    return runs.groupBy("print").agg(F.array_sort(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))


def collapse_runs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each row's key, its `runs` (start, period, length; by start, then period) and `collapsed`, its text without repeats.

    A word goes if any run contains it after that run's first period; the others are joined by one blank. Null
    and empty texts have no runs and an empty text. Repeated rows stay, each with its own result; null keys too. Other
    columns are not read, and an empty table gives an empty result.
    """
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    runs = stored(runs_of(rows), "runs")
    table = bit_filter(runs.select(F.xxhash64("print").alias("h")), "h", FILTER_BITS)

    @F.pandas_udf("boolean")
    def may_have(h):  # a text's md5 as a number; False only if the text has no runs
        found = np.zeros(len(h), bool)
        found[passes(table, h.to_numpy().view(np.uint64))] = True
        return type(h)(found)

    own = rows.withColumn("print", F.unhex(F.md5("text"))).withColumn("may", may_have(F.xxhash64("print")))
    plain = F.trim(F.regexp_replace("text", BLANKS, " "))
    without = own.where("not may").select("key", F.array().cast(RUNS).alias("runs"), plain.alias("collapsed"))

    def collapsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, out = batch.column(2), []
            for i in range(batch.num_rows):
                words = np.array(batch.column(1)[i].as_buffer().to_pybytes().split() or [b""], dtype=object)
                dropped = np.zeros(len(words) + 1, np.int64)
                if found[i].is_valid and len(found[i]):
                    parts = found[i].values
                    start, period, length = (parts.field(name).to_numpy() for name in ("start", "period", "length"))
                    np.add.at(dropped, start + period, 1)
                    np.add.at(dropped, start + length, -1)
                out.append(b" ".join(words[np.cumsum(dropped)[:-1] == 0]).decode())
            yield pa.RecordBatch.from_arrays([batch.column(0), found, pa.array(out, pa.string())], ["key", "runs", "collapsed"])

    joined = own.where("may").join(runs, "print", "left").select("key", "text", F.coalesce("runs", F.array().cast(RUNS)).alias("runs"))
    schema = without.schema
    whole = joined.mapInArrow(collapsed, schema).unionByName(without)
    return whole.withColumnRenamed("key", key)


def plant_runs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and text; in every tenth text, by the CRC-32 of its key, the words from some place on repeat with a period.

    With h the CRC, g = h div 10 and n words, those from a = g mod n on repeat the p = 1 + (n - a) div (3 + g mod 8)
    words that stand there. Other texts stay as they are, as do those of rows without a key.
    """
    h = F.crc32(F.col(key).cast("string"))
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), h.alias("h"))
    rows = rows.withColumn("w", F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))))
    rows = rows.withColumn("n", F.size("w")).withColumn("g", F.expr("h div 10"))
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.expr("cast(g % n as int)")))
    rows = rows.withColumn("p", F.expr("cast(1 + (n - a) div (3 + g % 8) as int)"))
    again = F.expr("slice(flatten(array_repeat(slice(w, a + 1, p), cast(ceil((n - a) / p) as int))), 1, n - a)")
    planted = F.array_join(F.concat(F.expr("slice(w, 1, a)"), again), " ")
    return rows.select(F.col("key").alias(key), F.when(F.col("a").isNotNull(), planted).otherwise(F.col("text")).alias(text))


def run_digests(collapsed: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per row of `collapse_runs`: the number of runs, the longest one, and digests of all runs and of the collapsed text."""
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    rows = collapsed.withColumn("longest", longest)
    return rows.select(
        key,
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("longest.start")).alias("start"),
        F.col("longest.length").alias("length"),
        (-F.col("longest.period")).alias("period"),
        F.expr("1000 * longest.length div -longest.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
