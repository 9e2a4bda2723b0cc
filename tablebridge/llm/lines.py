"""Line dedup by a log-template tree of fixed depth.

Each line goes down a tree: by its number of tokens, then by its leading tokens. Tokens with
digits count as variable on the way. Lines that meet in a leaf and agree in most places share a
template, which has a variable field where they differ. A template that recurs across
documents keeps its first line; its other lines are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tablebridge.llm.filters import bit_filter, passes
from tablebridge.llm.storage import stored
from tablebridge.llm.words import LOWER, NOT_BLANK, chunks, mix, powers, signed, span_hashes, word_spans

#: Leading tokens that the tree parts lines by.
DEPTH = 3
#: Lines of fewer tokens are never dropped.
LEAST_TOKENS = 4
#: Lines of fewer tokens share a template only if they are equal but for numbers.
LEAST_VARIABLE = 8
#: Share of places at which a line must equal a template.
AGREEMENT = 0.8
#: Lines of a leaf that are compared with each other's templates in one piece of work.
LEAF_ROWS = 1024
#: Bits of the filter for leaves with several lines: 1 MB whatever the input's size.
FILTER_BITS = 23
#: Keys of a template of a larger leaf at most, unless its length needs one more than it may have differing places.
MOST_KEYS = 24

_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[48:58] = True
#: What stands for a token with digits, and in templates for a place where lines differ.
_NUMBER = np.uint64(0x5851F42D4C957F2D)
VARIABLE = 0


def parse_lines(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """Lines with words of texts: text, line, n (tokens), leaf, print (hash of all tokens), first and tokens."""
    starts, ends, first = word_spans(data, offsets, NOT_BLANK)
    h = span_hashes(LOWER[data], starts, ends)
    digits = np.concatenate(([0], np.cumsum(_DIGIT[data])))
    h[digits[ends] > digits[starts]] = _NUMBER
    breaks = np.concatenate(([0], np.cumsum(data == 10)))
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    line = breaks[starts] - breaks[offsets[text]]
    new = np.ones(len(h), bool)
    new[1:] = (text[1:] != text[:-1]) | (line[1:] != line[:-1])
    head = np.flatnonzero(new)
    n = np.diff(np.append(head, len(h)))
    place = np.arange(len(h)) - np.repeat(head, n)
    up, _ = powers(int(n.max(initial=0)) + 1)
    whole = mix(np.add.reduceat(h * up[place], head)) if len(head) else h
    leaf = mix(n.astype(np.uint64) + np.uint64(1))
    for k in range(DEPTH):
        has = n > k
        leaf[has] = mix(leaf[has] + h[head[has] + k] * np.uint64(2 * k + 3))
    return {"text": text[head], "line": line[head], "n": n, "leaf": leaf, "print": whole, "first": head, "tokens": h}


def line_rows(docs: DataFrame, row: str, text: str) -> DataFrame:
    """row, line, leaf, print of every line that may be dropped."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, _, data, offsets in chunks(batch.column(1)):
                p = parse_lines(data, offsets)
                keep = p["n"] >= LEAST_TOKENS
                rows = batch.column(0).take(pa.array(a + p["text"][keep]))
                yield pa.RecordBatch.from_arrays([rows, pa.array(p["line"][keep]), pa.array(signed(p["leaf"][keep])), pa.array(signed(p["print"][keep]))], ["row", "line", "leaf", "print"])

    return docs.select(row, text).mapInArrow(run, "row long, line long, leaf long, print long")


def leaf_tokens(docs: DataFrame, text: str, table: np.ndarray) -> DataFrame:
    """leaf, print, codes (two bytes a token) of the lines long enough to vary whose leaf passes the filter."""
    shared = docs.sparkSession.sparkContext.broadcast(table)  # the filter's fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in chunks(batch.column(0)):
                p = parse_lines(data, offsets)
                at = passes(shared.value, p["leaf"])
                at = at[p["n"][at] >= LEAST_VARIABLE]
                _, unique = np.unique(p["print"][at], return_index=True)
                at = at[unique]
                codes = (p["tokens"] % np.uint64(65535) + np.uint64(1)).astype("<u2")
                codes[p["tokens"] == _NUMBER] = 65535
                ends = p["first"] + p["n"]
                out = [codes[p["first"][i] : ends[i]].tobytes() for i in at.tolist()]
                yield pa.RecordBatch.from_arrays([pa.array(signed(p["leaf"][at])), pa.array(signed(p["print"][at])), pa.array(out, pa.binary())], ["leaf", "print", "codes"])

    return docs.select(text).mapInArrow(run, "leaf long, print long, codes binary").dropDuplicates(["leaf", "print"])


def need_of(n: int, agreement: float = AGREEMENT) -> int:
    """Places of n at which a line must equal a template."""
    return int(np.ceil(agreement * n))


def grow_templates(lines: np.ndarray, agreement: float = AGREEMENT) -> tuple[np.ndarray, np.ndarray]:
    """Template number of each line of a leaf, and the templates.

    Lines come in order; each joins the template it agrees with at most places, the earlier one of
    equals, and makes the places where they differ variable, or begins a template of its own. Only places that
    are not variable count as agreeing, so a template never loses more than its share.
    """
    need = need_of(lines.shape[1], agreement)
    templates = np.empty_like(lines)
    own, n = np.zeros(len(lines), np.int64), 0
    for i, line in enumerate(lines):
        equal = ((templates[:n] == line) & (templates[:n] != VARIABLE)).sum(axis=1)
        best = int(np.argmax(equal)) if n else 0
        if n and equal[best] >= need:
            templates[best][templates[best] != line] = VARIABLE
        else:
            best, n = n, n + 1
            templates[best] = line
        own[i] = best
    return own, templates[:n]


def whole_groups(frames: Iterator[pd.DataFrame], key: list[str]) -> Iterator[pd.DataFrame]:
    """The rows of sorted frames again, so that no group of equal `key` goes on in the next frame."""
    held: pd.DataFrame | None = None
    for frame in frames:
        held = frame if held is None else pd.concat([held, frame], ignore_index=True)
        if not len(held):
            continue
        last = (held[key] == held[key].iloc[-1]).all(axis=1)
        if not last.all():
            yield held[~last].reset_index(drop=True)
            held = held[last].reset_index(drop=True)
    if held is not None and len(held):
        yield held


def bounds_of(rows: pd.DataFrame, key: list[str]) -> Iterator[tuple[int, int]]:
    """First row and row after the last of each group of sorted rows."""
    values = rows[key].to_numpy()
    heads = np.flatnonzero(np.append(True, (values[1:] != values[:-1]).any(axis=1)))
    return zip(heads.tolist(), [*heads[1:].tolist(), len(rows)], strict=True)


def matrix(codes: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(codes), "<u2").reshape(len(codes), -1)


def templates_of(leaves: DataFrame) -> DataFrame:
    """From (leaf, print, codes): leaf, print, template (its first line's print), the template's codes, pieces.

    A leaf with many lines is cut into pieces by hash.
    """
    sizes = leaves.groupBy("leaf").agg(F.ceil(F.count("*") / LEAF_ROWS).cast("int").alias("pieces"))
    return grown(leaves.join(sizes, "leaf").withColumn("piece", F.pmod(F.hash("print"), F.col("pieces")).cast("long")))


def grown(cut: DataFrame) -> DataFrame:
    """From (leaf, piece, print, codes, pieces): the same but piece, with the template grown of each piece's lines."""
    dealt = cut.select("leaf", "piece", "print", "codes", "pieces").repartition("leaf", "piece").sortWithinPartitions("leaf", "piece", "print")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key = ["leaf", "piece"]
        for rows in whole_groups(frames, key):
            prints, codes = rows["print"].to_numpy(), rows["codes"].to_list()
            template, shape = prints.copy(), list(codes)
            for a, b in bounds_of(rows, key):
                if b - a > 1:
                    # Leaves are told apart by hash; lines of another length would be another leaf's.
                    same = np.array([len(c) == len(codes[a]) for c in codes[a:b]])
                    at = a + np.flatnonzero(same)
                    own, found = grow_templates(matrix([codes[i] for i in at]))
                    leader = np.array([prints[at[own == t][0]] for t in range(len(found))])
                    template[at] = leader[own]
                    for i, t in zip(at, own, strict=True):
                        shape[i] = found[t].tobytes()
            yield pd.DataFrame({"leaf": rows["leaf"], "print": prints, "template": template, "codes": shape, "pieces": rows["pieces"]})

    return dealt.mapInPandas(run, "leaf long, print long, template long, codes binary, pieces int")


def segments_of(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the segments that the places after the leading ones are cut into, and the sets of segments that are keys.

    Two templates that agree in enough places differ in at most n - need_of(n), each of which spoils one segment;
    so one set of the remaining number of segments is equal in both.
    """
    most = n - need_of(n)
    count = most + 1
    while count < n - DEPTH and comb(count + 1, most) <= MOST_KEYS:
        count += 1
    starts = DEPTH + np.arange(count) * (n - DEPTH) // count
    return starts, np.array(list(combinations(range(count), count - most)))


def template_keys(codes: np.ndarray, leaf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and keys of templates of one length; two of a leaf that agree in enough places have a key in common."""
    n = codes.shape[1]
    starts, sets = segments_of(n)
    up, _ = powers(n)
    sums = mix(np.add.reduceat((codes[:, DEPTH:].astype(np.uint64) + np.uint64(1)) * up[DEPTH:n], starts - DEPTH, axis=1) + np.arange(len(starts), dtype=np.uint64))
    fixed = ~np.logical_or.reduceat(codes[:, DEPTH:] == VARIABLE, starts - DEPTH, axis=1)
    rows, keys = [], []
    for i, own in enumerate(sets):
        at = np.flatnonzero(fixed[:, own].all(axis=1))
        total = mix(leaf[at] + np.uint64(n * 1_000_003 + i))
        for j in own:
            total = mix(total + sums[at, j])
        rows.append(at)
        keys.append(total)
    return np.concatenate(rows), np.concatenate(keys)


def keyed(live: DataFrame) -> DataFrame:
    """key, leaf, print, codes of templates, a row for each of their keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = batch.column(2).to_pylist()
            leaf = batch.column(0).to_numpy().view(np.uint64)
            sizes = np.array([len(c) for c in codes])
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                rows, keys = template_keys(matrix([codes[i] for i in at]), leaf[at])
                for a in range(0, len(rows), 1 << 14):
                    own = batch.take(pa.array(at[rows[a : a + (1 << 14)]]))
                    yield pa.RecordBatch.from_arrays([pa.array(signed(keys[a : a + (1 << 14)])), *own.columns], ["key", "leaf", "print", "codes"])

    return live.select("leaf", "print", "codes").mapInArrow(run, "key long, leaf long, print long, codes binary")


def partners(live: DataFrame) -> DataFrame:
    """leaf, print, partner of the templates (leaf, print, codes) that agree in enough places with another of their leaf.

    The partner is the one that agrees in most places, the smallest print of equals. Templates with a
    key in common are all compared; many of them are cut into blocks, and each two blocks meet in a piece of work of their own.
    """
    keys = stored(keyed(live), "template-keys")
    sizes = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key", F.ceil(F.col("n") / LEAF_ROWS).cast("int").alias("blocks"))
    cut = keys.join(sizes, "key").withColumn("block", F.pmod(F.hash("print"), F.col("blocks")))
    cells = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cells = cells.select("key", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "block", "leaf", "print", "codes")
    dealt = cells.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y", "block", "print")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key = ["key", "x", "y"]
        for rows in whole_groups(frames, key):
            prints, leaves, block, codes = rows["print"].to_numpy(), rows["leaf"].to_numpy(), rows["block"].to_numpy(), rows["codes"].to_list()
            x, y = rows["x"].to_numpy(), rows["y"].to_numpy()
            found = []
            for a, b in bounds_of(rows, key):
                # Keys are hashes; templates of another leaf or length would be another key's.
                at = a + np.flatnonzero([leaves[i] == leaves[a] and len(codes[i]) == len(codes[a]) for i in range(a, b)])
                lower = at[block[at] == x[a]]
                upper = at[block[at] == y[a]]
                if not len(lower) or not len(upper):
                    continue
                right, need = matrix([codes[i] for i in upper]), need_of(len(codes[a]) // 2)
                best = np.zeros(len(upper), np.int64)
                mate = np.zeros(len(upper), np.int64)
                for i in lower.tolist():
                    own = np.frombuffer(codes[i], "<u2")
                    equal = ((right == own) & (own != VARIABLE)).sum(axis=1)
                    equal[upper == i] = 0
                    most = int(np.argmax(equal))  # blocks are in order of prints
                    if equal[most] >= need:
                        found.append((leaves[a], prints[i], prints[upper[most]], equal[most]))
                    better = equal > best
                    best[better], mate[better] = equal[better], prints[i]
                found += [(leaves[a], prints[upper[j]], mate[j], best[j]) for j in np.flatnonzero(best >= need).tolist()]
            yield pd.DataFrame(found, columns=["leaf", "print", "partner", "equal"]).astype(np.int64)

    pairs = dealt.mapInPandas(run, "leaf long, print long, partner long, equal long")
    best = F.max(F.struct("equal", F.bitwise_not("partner").alias("back")))
    return pairs.groupBy("leaf", "print").agg(best.alias("best")).select("leaf", "print", F.bitwise_not("best.back").alias("partner"))


def brought_together(live: DataFrame) -> DataFrame:
    """leaf, template, wider: what each template (leaf, print, codes) has become once no two of a leaf agree in enough places.

    In each round every template meets those it agrees with most, and they grow together in order. The two that
    agree most of all always merge, so rounds come to an end. Templates only lose places, so one that agrees with
    no other is settled.
    """
    named = live.select("leaf", F.col("print").alias("template"), F.col("print").alias("wider"))
    while True:
        links = stored(partners(live), "template-links")
        if links.isEmpty():
            return named
        met = live.join(links, ["leaf", "print"]).withColumn("piece", F.least("print", "partner")).withColumn("pieces", F.lit(1))
        merged = stored(grown(met), "merged-templates")
        live = stored(merged.select("leaf", F.col("template").alias("print"), "codes").dropDuplicates(["leaf", "print"]), "live-templates")
        step = merged.select("leaf", F.col("print").alias("wider"), F.col("template").alias("widest"))
        named = stored(named.join(step, ["leaf", "wider"], "left").select("leaf", "template", F.coalesce("widest", "wider").alias("wider")), "named-templates")


def generalise(docs: DataFrame, text: str, distinct: DataFrame) -> DataFrame:
    """print, template for the distinct lines (leaf, print) that share a leaf with others."""
    shared_leaves = distinct.groupBy("leaf").agg(F.count("*").alias("n")).where("n > 1").select("leaf")
    own = stored(templates_of(leaf_tokens(docs, text, bit_filter(shared_leaves, "leaf", FILTER_BITS))), "line-templates")
    split = own.where("pieces > 1")
    if split.isEmpty():
        return own.select("leaf", "print", "template")
    live = stored(split.select("leaf", F.col("template").alias("print"), "codes").dropDuplicates(["leaf", "print"]), "live-templates")
    return own.join(brought_together(live), ["leaf", "template"], "left").select("leaf", "print", F.coalesce("wider", "template").alias("template"))


def recurring_lines(docs: DataFrame, row: str, text: str, order: str) -> DataFrame:
    """row, dropped: numbers of the lines (from 0) of each row that are dropped; rows that keep all have none."""
    lines = stored(line_rows(docs, row, text), "lines")
    keys = docs.select(F.col(row).alias("row"), F.col(order).alias("order")).dropDuplicates(["row"])
    distinct = stored(lines.groupBy("leaf", "print").agg(F.min("row").alias("low"), F.max("row").alias("high")), "distinct-lines")
    named = distinct.join(generalise(docs, text, distinct), ["leaf", "print"], "left").withColumn("template", F.coalesce("template", "print"))
    recurring = named.groupBy("leaf", "template").agg(F.min("low").alias("low"), F.max("high").alias("high")).where("low <> high").select("leaf", "template")
    wanted = named.join(recurring, ["leaf", "template"]).select("leaf", "print", "template")
    found = stored(lines.join(wanted, ["leaf", "print"]).join(keys, "row").select("row", "order", "line", "leaf", "template"), "recurring-lines")
    place = F.struct(F.col("order").isNull().alias("last"), "order", "row", "line")
    # Written, so that the join deals both sides anew and a template of many lines can be split.
    first = stored(found.groupBy("leaf", "template").agg(F.min(place).alias("kept")), "first-lines")
    late = found.join(first, ["leaf", "template"]).where((F.col("row") != F.col("kept.row")) | (F.col("line") != F.col("kept.line")))
    return late.groupBy("row").agg(F.sort_array(F.collect_set(F.col("line").cast("int"))).alias("dropped"))


@F.pandas_udf(StringType())
def without_lines(text: pd.Series, dropped: pd.Series) -> pd.Series:
    """Texts without the lines of the given numbers."""

    def cut(body: str, numbers: np.ndarray) -> str:
        gone = set(numbers.tolist())
        return "\n".join(line for i, line in enumerate(body.split("\n")) if i not in gone)

    return pd.Series([body if gone is None or body is None else cut(body, gone) for body, gone in zip(text, dropped, strict=True)], dtype=object)


def drop_recurring_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", length: str | None = "n_chars", dropped: str | None = None) -> DataFrame:
    """`docs` with the lines dropped whose template came before, in order of key and line.

    Lines end at line feeds. A template recurs if two rows that differ in key or text have lines of it; rows
    that repeat count as one document and are treated alike. Rows stay, with all columns: a null text stays
    null, an empty one empty, and a text of which nothing is left becomes empty. Null keys come last in the
    order. Column `length`, if there is one, follows the text's new length. `dropped` names a column for the
    numbers of the dropped lines. Lines of fewer than LEAST_TOKENS words stay. An empty table gives an empty result.
    """
    rows = docs.withColumn("__row", F.xxhash64(key, text))
    late = recurring_lines(rows, "__row", text, key).select(F.col("row").alias("__row"), F.col("dropped").alias("__dropped"))
    joined = rows.join(late, "__row", "left").withColumn("__text", without_lines(F.col(text), F.col("__dropped")))
    new = {text: F.col("__text")}
    if length and length in docs.columns:
        new[length] = F.when(F.col("__dropped").isNull(), F.col(length)).otherwise(F.length("__text")).cast(docs.schema[length].dataType)
    columns = [new.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns]
    if dropped:
        columns.append(F.coalesce("__dropped", F.array().cast("array<int>")).alias(dropped))
    return joined.select(*columns)
