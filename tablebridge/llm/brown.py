"""Language-model scores by Brown classes.

Words fall into classes; a text's probability is that of its sequence of classes times
that of each word within its class. Word counts and class transitions are counted by
Spark over all training texts.

Exchange clustering goes in two steps. The most frequent words start the classes: they are exchanged one by one, on
the counts of one another and of forms that stand for all other words. Then every other word that tasks hold is
exchanged by sweeps in Spark: its counts of classes before and behind it, over all texts, say what
each class would gain by it; words move together, and a sweep is kept if the classes
tell more about one another. Words too rare to be held, and those never seen, go by their form.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablebridge.llm.storage import stored
from tablebridge.llm.words import LOWER, chunks, signed, span_hashes, word_spans

#: Words that start the classes; all others share the symbol of their form at first.
OWN_SYMBOLS = 512
FORMS = 32
CLASSES = 48
SWEEPS = 8
#: Sweeps over all other held words.
WORD_SWEEPS = 2
#: Word counts that tasks hold in memory at most; rarer words are joined.
HELD_WORDS = 1 << 19
SMOOTHING = 0.1
#: Steps a doubling of the count is cut into when the rarest held word is chosen.
_STEPS = 8


def held_out(key: str = "doc_id", fold: int = 0, folds: int = 10) -> Column:
    """Rows kept from training: crc32 of the key as text, modulo `folds`, is `fold`. Null keys train."""
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(folds)) == fold, F.lit(False))


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes and forms of the words of texts, and the place of each text's first word."""
    starts, ends, first = word_spans(data, offsets)
    low = LOWER[data]
    form = (low[ends - 1] % 16).astype(np.int64) * 2 + (ends - starts > 8)
    return signed(span_hashes(low, starts, ends)), form, first


@dataclass
class Held:
    """Counts, symbols and forms of the frequent words, in the order of their hashes."""

    hashes: np.ndarray
    counts: np.ndarray
    symbols: np.ndarray
    forms: np.ndarray

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each hash, and whether it is there."""
        if not len(self.hashes):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return at, self.hashes[at] == hashes


@dataclass
class Classes:
    """Class of each held word and of each form; the end, which is also where texts begin, has the last."""

    word: np.ndarray
    form: np.ndarray
    count: int

    def sequence(self, held: Held, h: np.ndarray, form: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Classes of texts, an end before the first and after each; likewise the places of held words, else -1; each text's end."""
        at, known = held.find(h)
        own = self.form[form]
        if known.any():
            own = np.where(known, self.word[at], own)
        ends = first[1:] + 1 + np.arange(len(first) - 1)
        end = self.count - 1
        return np.concatenate(([end], np.insert(own, first[1:], end))).astype(np.int64), np.concatenate(([-1], np.insert(np.where(known, at, -1), first[1:], -1))), ends


@dataclass
class Model:
    """A trained model."""

    held: Held
    classes: Classes
    transitions: np.ndarray  # log10 P(class | class before)
    emissions: np.ndarray  # log10 of what a word's smoothed count is divided by, by class
    total: int
    distinct: int
    ends: int
    counts: DataFrame


def count_words(train: DataFrame, text: str) -> DataFrame:
    """word, form, n of all training texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counted(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
            h = np.concatenate([np.zeros(0, np.int64), *(p[0] for p in parts)])
            form = np.concatenate([np.zeros(0, np.int64), *(p[1] for p in parts)])
            h, first, n = np.unique(h, return_index=True, return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(h), pa.array(form[first].astype(np.int32)), pa.array(n.astype(np.int64))], ["word", "form", "n"])

        parts, held = [], 0
        for batch in batches:
            for _, _, data, offsets in chunks(batch.column(0)):
                h, form, _ = tokens(data, offsets)
                parts.append((h, form))
                held += len(h)
                if held > 4_000_000:
                    yield counted(parts)
                    parts, held = [], 0
        yield counted(parts)

    rows = train.select(text).mapInArrow(count, "word long, form int, n long")
    return rows.groupBy("word").agg(F.first("form").alias("form"), F.sum("n").alias("n"))


def hold(counts: DataFrame, own: int, most: int) -> Held:
    """The most frequent words, at most `most`, from counts of every word."""
    step = F.floor(F.log2("n") * _STEPS).cast("int")
    sizes = sorted((r.step, r.words) for r in counts.groupBy(step.alias("step")).agg(F.count("*").alias("words")).collect())
    least, so_far = None, 0
    for at, size in reversed(sizes):
        if so_far + size > most:
            break
        least, so_far = at, so_far + size
    if least is None:
        return Held(*(np.zeros(0, np.int64) for _ in range(4)))
    found = counts.where(step >= least).select("word", "n", "form").toArrow()  # `most` rows at most
    h, n, form = (found[c].to_numpy() for c in ("word", "n", "form"))
    symbols = own + form.astype(np.int64)
    rank = np.lexsort((h, -n))[:own]
    symbols[rank] = np.arange(len(rank))
    order = np.argsort(h)
    return Held(h[order], n[order], symbols[order], form[order].astype(np.int64))


def symbol_sequence(held: Held, h: np.ndarray, form: np.ndarray, first: np.ndarray, own: int) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of texts, an end before the first and after each, and the place of each text's end."""
    at, known = held.find(h)
    symbols = own + form
    if known.any():
        symbols = np.where(known, held.symbols[at] if len(held.symbols) else 0, symbols)
    end = own + FORMS
    return np.concatenate(([end], np.insert(symbols, first[1:], end))), first[1:] + 1 + np.arange(len(first) - 1)


def count_pairs(train: DataFrame, text: str, held: Held, own: int) -> np.ndarray:
    """How often one symbol follows another in all training texts; at most the square of the alphabet comes back."""
    size = own + FORMS + 1
    frequent = held.symbols < own
    small = train.sparkSession.sparkContext.broadcast(Held(held.hashes[frequent], held.counts[frequent], held.symbols[frequent], held.forms[frequent]))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(size * size, np.int64)
        for batch in batches:
            for _, _, data, offsets in chunks(batch.column(0)):
                sequence, _ = symbol_sequence(small.value, *tokens(data, offsets), own)
                sums += np.bincount(sequence[:-1] * size + sequence[1:], minlength=size * size)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], ["pair", "n"])

    found = train.select(text).mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    pairs = np.zeros(size * size, np.int64)
    pairs[found["pair"].to_numpy()] = found["n"].to_numpy()
    return pairs.reshape(size, size)


def information(counts: np.ndarray) -> np.ndarray:
    """n log n, and 0 at 0."""
    return counts * np.log(np.maximum(counts, 1))


def exchange(pairs: np.ndarray, classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """Class of each symbol: each in turn moves to where the class transitions become likeliest, until none moves.

    The most frequent symbols begin with a class each, and the others join them one by one. The last
    symbol, the end, keeps a class of its own.
    """
    n = pairs.astype(np.float64)
    size = len(n)
    end, k = size - 1, max(1, min(classes, size - 1))
    waiting = k + 1
    weight = n.sum(axis=0) + n.sum(axis=1)
    order = np.argsort(-weight[:end], kind="stable")
    own = np.full(size, waiting)
    own[end] = k
    table = np.zeros((k + 2, k + 2))
    np.add.at(table, (own[:, None].repeat(size, 1), own[None, :].repeat(size, 0)), n)

    def place(w: int, to_class: int | None = None) -> bool:
        """Take w out of its class and put it where it fits best; whether it moved."""
        a = own[w]
        to = np.bincount(own, weights=n[w], minlength=k + 2)
        by = np.bincount(own, weights=n[:, w], minlength=k + 2)
        loop = n[w, w]
        to[a] -= loop
        by[a] -= loop
        table[a] -= to
        table[:, a] -= by
        table[a, a] -= loop
        b = to_class
        if b is None:
            right, left = table.sum(axis=1), table.sum(axis=0)
            out, into = to.sum() + loop, by.sum() + loop
            # What each class would gain by taking w in: its row and column, its corner, and its totals.
            gain = (information(table + to) - information(table)).sum(axis=1) + (information(table + by[:, None]) - information(table)).sum(axis=0)
            corner = np.diagonal(table)
            gain -= information(corner + to) + information(corner + by) - 2 * information(corner)
            gain += information(corner + to + by + loop) - information(corner)
            gain -= information(right + out) - information(right) + information(left + into) - information(left)
            b = int(np.argmax(gain[:k]))
            if a < k and gain[a] >= gain[b] - 1e-9:
                b = int(a)
        own[w] = b
        table[b] += to
        table[:, b] += by
        table[b, b] += loop
        return b != a

    for i, w in enumerate(order.tolist()):
        place(w, i if i < k else None)
    for _ in range(sweeps):
        if not sum(place(w) for w in order[weight[order] > 0].tolist()):
            break
    return own


def contexts(train: DataFrame, text: str, held: Held, classes: Classes, moving: np.ndarray) -> DataFrame:
    """word, code, n: how often each class follows a word (code: the class), comes before it (classes more) or the word itself
    follows (twice the classes), for the held words `moving` marks, in all training texts.
    """
    k = classes.count
    shared = train.sparkSession.sparkContext.broadcast((held, classes, moving))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, classes, moving = shared.value
        codes = 2 * k + 1

        def counted(parts: list[np.ndarray]) -> pa.RecordBatch:
            key, n = np.unique(np.concatenate(parts), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array((key // codes).astype(np.int32)), pa.array((key % codes).astype(np.int32)), pa.array(n)], ["word", "code", "n"])

        parts, size = [], 0
        for batch in batches:
            for _, _, data, offsets in chunks(batch.column(0)):
                path, place, _ = classes.sequence(held, *tokens(data, offsets))
                moves = (place >= 0) & moving[place]
                at = np.flatnonzero(moves[:-1])
                loop = place[at] == place[at + 1]
                behind = place[at] * codes + np.where(loop, 2 * k, path[at + 1])
                at = np.flatnonzero(moves[1:]) + 1
                at = at[place[at] != place[at - 1]]
                parts += [behind, place[at] * codes + k + path[at - 1]]
                size += len(parts[-1]) + len(parts[-2])
                if size > 4_000_000:
                    yield counted(parts)
                    parts, size = [], 0
        if size:
            yield counted(parts)

    return train.select(text).mapInArrow(count, "word int, code int, n long")


def class_pairs(train: DataFrame, text: str, held: Held, classes: Classes) -> np.ndarray:
    """How often each class follows each in all training texts."""
    k = classes.count
    shared = train.sparkSession.sparkContext.broadcast((held, classes))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, classes = shared.value
        sums = np.zeros(k * k, np.int64)
        for batch in batches:
            for _, _, data, offsets in chunks(batch.column(0)):
                path, _, _ = classes.sequence(held, *tokens(data, offsets))
                sums += np.bincount(path[:-1] * k + path[1:], minlength=k * k)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], ["pair", "n"])

    found = train.select(text).mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    between = np.zeros(k * k)
    between[found["pair"].to_numpy()] = found["n"].to_numpy()
    return between.reshape(k, k)


def told(between: np.ndarray) -> float:
    """What classes tell about the classes that follow them, as far as classes decide it."""
    return float(information(between).sum() - information(between.sum(axis=1)).sum() - information(between.sum(axis=0)).sum())


def gains(word: np.ndarray, code: np.ndarray, n: np.ndarray, own: np.ndarray, between: np.ndarray) -> np.ndarray:
    """What classes would tell more with each word (rows) in each class (columns) than without it, while all other words stand still.

    `word` numbers rows, in order; `code` and `n` are its contexts as `contexts` counts them; `own` is each row's class.
    """
    k, rows = len(between), len(own)
    value = n.astype(np.float64)
    gain = np.zeros((rows, k))
    beside = [np.zeros((rows, k)), np.zeros((rows, k))]
    for side, table in enumerate((between.T, between)):  # table[c, b]: class b before class c, then class b behind class c
        at = np.flatnonzero((code >= side * k) & (code < (side + 1) * k))
        c, w, x = code[at] - side * k, word[at], value[at]
        np.add.at(beside[side], (w, c), x)
        for low in range(0, len(at), 1 << 15):
            part = slice(low, low + (1 << 15))
            change = information(table[c[part]] + x[part, None]) - information(table[c[part]])
            mine = table[c[part], own[w[part]]]
            change[np.arange(len(change)), own[w[part]]] = information(mine) - information(np.maximum(mine - x[part], 0))
            np.add.at(gain, w[part], change)
    to, by = beside
    loop = np.zeros(rows)
    at = code == 2 * k
    np.add.at(loop, word[at], value[at])
    corner = np.diagonal(between)[None, :]
    alone = information(corner + to) + information(corner + by) - 2 * information(corner)
    gain += information(corner + to + by + loop[:, None]) - information(corner) - alone
    for total, size in ((between.sum(axis=1), to.sum(axis=1) + loop), (between.sum(axis=0), by.sum(axis=1) + loop)):
        gain -= information(total[None, :] + size[:, None]) - information(total)[None, :]
    # Without the word, its own class has fewer contexts in all others.
    row = np.arange(rows)
    for table, mine, others in ((between.T[own], to[row, own], by), (between[own], by[row, own], to)):
        without = np.maximum(table - others, 0)
        fewer = information(without + mine[:, None]) - information(without) - information(table + mine[:, None]) + information(table)
        fewer[row, own] = 0
        gain += fewer
    # The same for the class a word is in, by what goes if it leaves.
    c, t, b = corner[0, own], to[row, own], by[row, own]
    gain[row, own] += alone[row, own] - information(c + t + b + loop) + information(c)
    gain[row, own] -= 2 * information(c) - information(np.maximum(c - t, 0)) - information(np.maximum(c - b, 0))
    gain[row, own] += information(c) - information(np.maximum(c - t - b - loop, 0))
    for total, size in ((between.sum(axis=1), to.sum(axis=1) + loop), (between.sum(axis=0), by.sum(axis=1) + loop)):
        mine = total[own]
        gain[row, own] += information(mine + size) - information(mine) - (information(mine) - information(np.maximum(mine - size, 0)))
    return gain


def sweep(found: DataFrame, classes: Classes, between: np.ndarray) -> np.ndarray:
    """Class of each held word after all moved to where they gain most; only `HELD_WORDS` pairs of numbers come back."""
    k = classes.count
    shared = found.sparkSession.sparkContext.broadcast((classes.word, between))

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, between = shared.value
        for batch in batches:
            words = batch.column(0).to_numpy()
            entries = batch.column(1)
            row = np.repeat(np.arange(len(words)), entries.value_lengths().to_numpy())
            flat = entries.flatten()
            for low in range(0, len(words), 2048):
                part = np.flatnonzero((row >= low) & (row < low + 2048))
                mine = own[words[low : low + 2048]]
                gain = gains(row[part] - low, flat.field("code").to_numpy()[part], flat.field("n").to_numpy()[part], mine, between)[:, : k - 1]
                to = gain.argmax(axis=1)
                rows = np.arange(len(mine))
                to = np.where(gain[rows, to] > gain[rows, mine] + 1e-9, to, mine)
                moved = np.flatnonzero(to != mine)
                yield pa.RecordBatch.from_arrays([pa.array(words[low : low + 2048][moved]), pa.array(to[moved].astype(np.int32))], ["word", "class"])

    counted = found.repartition("word").groupBy("word", "code").agg(F.sum("n").alias("n"))
    grouped = counted.groupBy("word").agg(F.collect_list(F.struct("code", "n")).alias("entries"))
    moved = grouped.mapInArrow(best, "word int, class int").toArrow()
    word = classes.word.copy()
    word[moved["word"].to_numpy()] = moved["class"].to_numpy()
    return word


def cluster(train: DataFrame, text: str, held: Held, own: int, classes: int) -> tuple[Classes, np.ndarray]:
    """Classes of all held words and of forms, and how often one follows another."""
    pairs = count_pairs(train, text, held, own)
    symbol_class = exchange(pairs, classes)
    k, size = int(symbol_class[-1]) + 1, len(pairs)
    between = np.zeros((k, k))
    np.add.at(between, (symbol_class[:, None].repeat(size, 1), symbol_class[None, :].repeat(size, 0)), pairs)
    now = Classes(symbol_class[held.symbols], symbol_class[own : own + FORMS], k)
    moving = held.symbols >= own
    for _ in range(WORD_SWEEPS if moving.any() else 0):
        moved = Classes(sweep(contexts(train, text, held, now, moving), now, between), now.form, k)
        after = class_pairs(train, text, held, moved)
        if told(after) <= told(between):
            break
        now, between = moved, after
    return now, between


def train_model(train: DataFrame, text: str = "text", own: int = OWN_SYMBOLS, classes: int = CLASSES, most_held: int = HELD_WORDS) -> Model:
    """Count all training texts and cluster; an empty table gives the uniform model."""
    counts = stored(count_words(train, text), "word-counts")
    texts = train.count()
    held = hold(counts, own, most_held)
    found, between = cluster(train, text, held, own, classes)
    k = found.count
    words, mass = np.zeros(FORMS), np.zeros(FORMS)
    total, distinct = texts, int(texts > 0)
    for r in counts.groupBy("form").agg(F.count("*").alias("words"), F.sum("n").alias("n")).collect():  # a row per form
        words[r.form], mass[r.form] = r.words, r.n
        total, distinct = total + r.n, distinct + r.words
    # Words that are not held count for the class of their form.
    words -= np.bincount(held.forms, minlength=FORMS)
    mass -= np.bincount(held.forms, weights=held.counts, minlength=FORMS)
    class_words = np.bincount(found.word, minlength=k) + np.bincount(found.form, weights=words, minlength=k)
    class_mass = np.bincount(found.word, weights=held.counts, minlength=k) + np.bincount(found.form, weights=mass, minlength=k)
    emissions = np.log10(class_mass + SMOOTHING * (class_words + 1))
    transitions = np.log10((between + SMOOTHING) / (between.sum(axis=1, keepdims=True) + SMOOTHING * k))
    return Model(held, found, transitions, emissions, int(total), int(distinct), texts, counts)


def score_texts(docs: DataFrame, key: str = "doc_id", text: str = "text", held_out_rows: Column | None = None, **settings: int) -> DataFrame:
    """Log10 probabilities of each text, learnt from the rows that are not held out.

    One row per row of `docs`, repeated rows included: key, held_out, n_tokens (words and an end), n_known
    (those seen in training), train_tokens, base_score (smoothed counts of single words), score (Brown
    classes) and perplexity. A null or empty text is its end alone. Null keys train unless
    `held_out_rows` says otherwise, and stay null. Other columns are not read. An empty table gives an empty result.
    """
    rule = held_out(key) if held_out_rows is None else held_out_rows
    rows = docs.select(F.col(key).alias("__key"), F.col(text).alias("__text"), rule.alias("__out"))
    model = train_model(rows.where(~F.col("__out")), "__text", **settings)
    context = docs.sparkSession.sparkContext
    shared = context.broadcast((model.held, model.classes, model.transitions, model.emissions))
    kind = docs.schema[key].dataType.simpleString()

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, classes, transitions, emissions = shared.value
        logs = np.log10(held.counts + SMOOTHING)
        for batch in batches:
            for a, b, data, offsets in chunks(batch.column(1)):
                h, form, first = tokens(data, offsets)
                path, _, ends = classes.sequence(held, h, form, first)
                steps = transitions[path[:-1], path[1:]]
                at_word = np.ones(len(steps), bool)
                at_word[ends - 1] = False
                steps[at_word] -= emissions[path[1:][at_word]]
                moves = np.add.reduceat(steps, np.concatenate(([0], ends[:-1]))) if len(steps) else steps
                at, known = held.find(h)
                value = np.where(known, logs[at] if len(logs) else 0.0, 0.0)
                sums = np.concatenate(([0.0], np.cumsum(value)))
                seen = np.concatenate(([0], np.cumsum(known)))
                n = np.diff(first)
                rare = pa.LargeListArray.from_arrays(pa.array(first - seen[first]), pa.array(h[~known])).cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(2).slice(a, b - a), pa.array(n + 1), pa.array(np.diff(seen[first])), pa.array(moves), pa.array(np.diff(sums[first])), rare],
                    ["__key", "__out", "n_tokens", "n_held", "moves", "held_sum", "rare"],
                )

    found = rows.mapInArrow(parts, f"__key {kind}, __out boolean, n_tokens long, n_held long, moves double, held_sum double, rare array<long>")
    found = stored(found.withColumn("__row", F.monotonically_increasing_id()), "text-parts")
    rare = found.select("__row", F.explode("rare").alias("word")).groupBy("__row", "word").agg(F.count("*").alias("times"))
    log = F.log10(F.coalesce("n", F.lit(0)) + SMOOTHING)
    resolved = (
        rare.join(model.counts.select("word", "n"), "word", "left")
        .groupBy("__row")
        .agg(F.sum(log * F.col("times")).alias("rare_sum"), F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("n_rare"))
    )
    words = F.col("held_sum") + F.coalesce("rare_sum", F.lit(0.0))
    floor = float(np.log10(model.total + SMOOTHING * (model.distinct + 1)))
    end = float(np.log10(model.ends + SMOOTHING))
    score = F.col("moves") + words
    return found.join(resolved, "__row", "left").select(
        F.col("__key").alias(key),
        F.col("__out").alias("held_out"),
        "n_tokens",
        (F.col("n_held") + F.coalesce("n_rare", F.lit(0)) + int(model.ends > 0)).alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"),
        (words + end - F.col("n_tokens") * floor).alias("base_score"),
        score.alias("score"),
        F.pow(F.lit(10.0), -score / F.col("n_tokens")).alias("perplexity"),
    )
