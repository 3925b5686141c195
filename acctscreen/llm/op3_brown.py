"""Scoring texts with a Brown class model.

Words fall into units: the most frequent words each have their own, all
others share the unit of their last letters, so every word, seen or not, has
one.  Exchange clustering assigns units to classes: class counts of each
unit's neighbours are added up over the whole training corpus, then units
move one after the other to the class that raises the likelihood of the
class bigrams most, round after round.  Then every other word that occurs
often enough, however many there are, gets the class that its own neighbours
speak for; only words that are rarer or unseen keep that of their last
letters.  A text's probability is the product of P(class | class before) and
P(word | class), both smoothed.

Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctscreen.llm.common import SPACE, Scratch, chunks, fold_case, hash_spans, held_out, mix, text_bytes, word_bounds

#: Bounds of the model: words with a unit of their own, units of last letters,
#: classes, rounds of exchange, and words whose counts every task gets.
WORDS, ENDINGS, CLASSES, ROUNDS, HEAD = 2048, 1024, 64, 6, 1 << 18
#: A word that occurs so often, at any size of the corpus, has a class by its own neighbours.
OWN = 2
DELTA, ALPHA = 0.1, 1.0
#: Entries that a task holds before it passes its counts on.
HELD = 1_000_000
#: The end of a text is a token with this hash; no word has it but by chance (2**-64).
END = np.int64(0)
FOLDS = 10


@dataclass(frozen=True)
class Units:
    """The unit of a word: its place in ``words`` (sorted hashes), or that of its ending."""

    words: np.ndarray
    endings: int = ENDINGS

    @property
    def n(self) -> int:
        return len(self.words) + self.endings + 1

    def of(self, h: np.ndarray, ending: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return ending.astype(np.int64)
        k = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
        return np.where(self.words[k] == h, k, len(self.words) + ending)

    @property
    def end(self) -> int:
        return self.n - 1


def tokens(column: pa.Array, endings: int = ENDINGS) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Per chunk of rows: first row, hashes and endings of the words, and the
    n + 1 places at which each row's words begin."""
    data, offs = text_bytes(column)
    for a, b in chunks(offs):
        low = fold_case(data[offs[a] : offs[b]])
        starts, ends, at = word_bounds(low, offs[a : b + 1] - offs[a], SPACE)
        h = hash_spans(low, starts, ends).view(np.int64)
        # The last three bytes, fewer if the word is shorter.
        tail = low[ends - 1].astype(np.int64) if len(ends) else np.zeros(0, np.int64)
        for back in (2, 3):
            has = ends - back >= starts
            tail = tail * 257 + np.where(has, low[np.maximum(ends - back, 0)], 256) if len(ends) else tail
        yield a, h, (tail * 2654435761 >> 7) % endings, at


def with_ends(values: np.ndarray, at: np.ndarray, end) -> tuple[np.ndarray, np.ndarray]:
    """``values`` with ``end`` after each row's own, and the new places."""
    n = len(at) - 1
    return np.insert(values, at[1:], end), at + np.arange(n + 1)


def _counter(endings: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            for _, h, ending, at in tokens(batch.column(0), endings):
                words, first, n = np.unique(h, return_index=True, return_counts=True)
                held.append((words, ending[first], n))
                rows += len(at) - 1
                if sum(len(x[0]) for x in held) >= HELD:
                    yield _word_counts(held, rows)
                    held, rows = [], 0
        if rows:
            yield _word_counts(held, rows)

    return count


def _word_counts(held: list[tuple], rows: int) -> pa.RecordBatch:
    """One row for each word of these parts, and one for the ends of ``rows`` texts."""
    h, ending, n = (np.concatenate([x[k] for x in held]) for k in range(3))
    words, first, back = np.unique(h, return_index=True, return_inverse=True)
    total = np.bincount(back, n, len(words)).astype(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(np.append(words, END)), pa.array(np.append(ending[first], -1).astype(np.int32)), pa.array(np.append(total, rows).astype(np.int64))], names=["h", "ending", "n"])


def count_words(texts: DataFrame, endings: int = ENDINGS) -> DataFrame:
    """h, ending, n of every distinct token; ``texts`` has the one column text."""
    part = texts.mapInArrow(_counter(endings), "h long, ending int, n long")
    return part.groupBy("h").agg(F.max("ending").alias("ending"), F.sum("n").alias("n"))


def _pair_counter(units: Units):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            for _, h, ending, at in tokens(batch.column(0), units.endings):
                u, _ = with_ends(units.of(h, ending), at, units.end)
                before = np.empty_like(u)
                if len(u):
                    before[0], before[1:] = units.end, u[:-1]  # a text begins after an end
                held.append(before * units.n + u)
                if sum(map(len, held)) >= 2 * HELD:
                    yield _code_counts(held)
                    held = []
        if held:
            yield _code_counts(held)

    return count


def _code_counts(held: list[np.ndarray]) -> pa.RecordBatch:
    code, n = np.unique(np.concatenate(held), return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(code.astype(np.int64)), pa.array(n.astype(np.int64))], names=["code", "n"])


def _neighbours(units: int, classes: int, class_of: np.ndarray):
    """Counts of (unit, class after) and (class before, unit), summed in the task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, units * classes))
        for batch in batches:
            code, n = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            a, b = code // units, code % units
            total[0] += np.bincount(a * classes + class_of[b], n, units * classes)
            total[1] += np.bincount(b * classes + class_of[a], n, units * classes)
        flat = total.ravel()
        k = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(flat[k].astype(np.int64))], names=["cell", "n"])

    return count


def _xlogx(x: np.ndarray) -> np.ndarray:
    return np.where(x > 0, x * np.log(np.maximum(x, 1e-300)), 0.0)


def likelihood(g: np.ndarray) -> float:
    """Log-likelihood of the class bigrams, up to what classes do not change."""
    return float(_xlogx(g).sum() - _xlogx(g.sum(1)).sum() - _xlogx(g.sum(0)).sum())


def exchange(after: np.ndarray, before: np.ndarray, class_of: np.ndarray, classes: int) -> np.ndarray:
    """One round: units, frequent first, move to the class that gains most.
    Counts by class follow each move; those by unit are of the round's start.
    The last unit (the end of a text) keeps class 0 for itself."""
    class_of = class_of.copy()
    g = np.zeros((classes, classes))
    np.add.at(g, class_of, after)
    size = after.sum(1)
    for u in np.argsort(-size, kind="stable"):
        if u == len(size) - 1 or size[u] == 0:
            continue
        a, out, come = class_of[u], after[u], before[u]
        g[a] -= out
        g[:, a] -= come
        g[a] = np.maximum(g[a], 0)
        g[:, a] = np.maximum(g[:, a], 0)
        rows, columns = g.sum(1), g.sum(0)
        gain = (
            (_xlogx(g + out) - _xlogx(g)).sum(1)
            + (_xlogx(g + come[:, None]) - _xlogx(g)).sum(0)
            - (_xlogx(rows + size[u]) - _xlogx(rows))
            - (_xlogx(columns + size[u]) - _xlogx(columns))
        )
        gain[0] = -np.inf
        b = int(gain.argmax())
        class_of[u] = b
        g[b] += out
        g[:, b] += come
    return class_of


@dataclass(frozen=True)
class Model:
    units: Units
    class_of: np.ndarray
    transition: np.ndarray  # log10 P(class | class before)
    emission: np.ndarray  # log10 of the divisor of P(word | class)
    head: np.ndarray  # sorted hashes of the most frequent words
    head_n: np.ndarray
    n: int
    v: int


def _logs(g: np.ndarray, tokens_of: np.ndarray, types_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    share = (g.sum(0) + ALPHA) / (g.sum() + ALPHA * len(g))
    return np.log10((g + ALPHA * share) / (g.sum(1, keepdims=True) + ALPHA)), np.log10(tokens_of + DELTA * (types_of + 1))


def _count_of(counts: DataFrame, k: int) -> int:
    """A power of two that ``k`` words or all reach, so that few more than
    ``k`` are sorted.  One row for each power comes to the driver."""
    powers = counts.groupBy(F.floor(F.log2("n")).cast("int").alias("p")).agg(F.count(F.lit(1)).alias("words")).collect()
    total, least = 0, 1
    for p, words in sorted(map(tuple, powers), reverse=True):
        total, least = total + words, 1 << p
        if total >= k:
            break
    return least


def fit(texts: DataFrame, scratch: Scratch, words: int = WORDS, endings: int = ENDINGS, classes: int = CLASSES, rounds: int = ROUNDS, head: int = HEAD) -> tuple[Model, DataFrame]:
    """The model of ``texts`` (column text) and the stored word counts.  To the
    driver come ``head`` words and, each round, two counts for each unit and
    class at most: all bounded by parameters, whatever the corpus."""
    counts = scratch.store(count_words(texts, endings), "words")
    real = counts.filter(F.col("h") != int(END))
    top = real.filter(F.col("n") >= _count_of(real, head)).orderBy(F.desc("n"), "h").limit(head).toArrow()
    h, n = top["h"].to_numpy(), top["n"].to_numpy()
    units = Units(np.sort(h[:words]), endings)
    by_ending = real.groupBy("ending").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).toPandas()
    end_n = int(counts.filter(F.col("h") == int(END)).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])

    pairs = texts.mapInArrow(_pair_counter(units), "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    pairs = scratch.store(pairs, "pairs")
    class_of = 1 + np.arange(units.n) % (classes - 1)
    class_of[units.end] = 0

    def neighbours(class_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cells = pairs.mapInArrow(_neighbours(units.n, classes, class_of), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
        flat = np.zeros(2 * units.n * classes)
        flat[cells["cell"].to_numpy(np.int64)] = cells["n"].to_numpy(np.float64)
        both = flat.reshape(2, units.n, classes)
        return both[0], both[1]

    found = None
    for left in range(rounds, -1, -1):
        after, before = neighbours(class_of)
        g = np.zeros((classes, classes))
        np.add.at(g, class_of, after)
        value = likelihood(g)
        if found is not None and value <= found[0]:
            break
        found = (value, class_of, g)
        if left:
            class_of = exchange(after, before, class_of, classes)
    _, class_of, g = found

    # Tokens and distinct words of each class: own words, then what is left of each ending.
    tokens_of, types_of = np.zeros(classes), np.zeros(classes)
    if len(by_ending):
        e = by_ending["ending"].to_numpy(np.int64)
        end_tokens, end_types = np.zeros(endings), np.zeros(endings)
        end_tokens[e], end_types[e] = by_ending["n"], by_ending["v"]
        own_e, own_n = top["ending"].to_numpy()[:words], n[:words]
        np.subtract.at(end_tokens, own_e, own_n)
        np.subtract.at(end_types, own_e, 1)
        k = class_of[np.searchsorted(units.words, h[:words])]
        np.add.at(tokens_of, k, own_n)
        np.add.at(types_of, k, 1)
        tail = class_of[len(units.words) : units.end]
        np.add.at(tokens_of, tail, end_tokens)
        np.add.at(types_of, tail, end_types)
    if end_n:
        tokens_of[0], types_of[0] = end_n, 1
    transition, emission = _logs(g, tokens_of, types_of)
    order = np.argsort(h)
    total = real.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    return Model(units, class_of, transition, emission, h[order], n[order], int(total["n"]) + end_n, int(total["v"]) + bool(end_n)), counts


def _cell_counter(units: Units, class_of: np.ndarray, classes: int):
    """Per word without a unit of its own, the classes after it (cell: the
    class) and before it (cell: ``classes`` and the class)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            for _, h, ending, at in tokens(batch.column(0), units.endings):
                u, _ = with_ends(units.of(h, ending), at, units.end)
                h, _ = with_ends(h, at, END)
                c = class_of[u]
                far = np.flatnonzero((u >= len(units.words)) & (u != units.end))
                # A text's first word comes after an end; its last token is an end.
                held += [(h[far], c[far + 1]), (h[far], classes + np.where(far > 0, c[far - 1], 0))]
                if sum(len(x[0]) for x in held) >= 2 * HELD:
                    yield _cell_counts(held, 2 * classes)
                    held = []
        if held:
            yield _cell_counts(held, 2 * classes)

    return count


def _cell_counts(held: list[tuple[np.ndarray, np.ndarray]], cells: int) -> pa.RecordBatch:
    words, back = np.unique(np.concatenate([x[0] for x in held]), return_inverse=True)
    code, n = np.unique(back * cells + np.concatenate([x[1] for x in held]), return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(words[code // cells]), pa.array((code % cells).astype(np.int32)), pa.array(n.astype(np.int64))], names=["h", "cell", "n"])


def _best_class(weights: np.ndarray, size: np.ndarray):
    """The class that makes a word's neighbours and the word in it likeliest."""

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, lists = batch.column(1), batch.column(2)
            row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            code = lists.flatten().to_numpy()
            cells = len(weights)
            found = np.zeros((len(lists), cells))
            found[row, code % cells] = code // cells
            gain = found @ weights - n.to_numpy()[:, None] * size
            gain[:, 0] = -np.inf  # the end's
            yield pa.RecordBatch.from_arrays([batch.column(0), n, pa.array(gain.argmax(1).astype(np.int32))], names=["h", "n", "c"])

    return choose


_PAIR = "lh long, lc int, rh long, rc int, n long"


def _parts(model: Model, h: np.ndarray, ending: np.ndarray, at: np.ndarray):
    """Classes of the tokens and of those before them, which are known without
    a look-up, their hashes, and the places of ends.  A word beyond the head has
    the class of its ending here."""
    u, ends = with_ends(model.units.of(h, ending), at, model.units.end)
    h, _ = with_ends(h, at, END)
    known = (u < len(model.units.words)) | (u == model.units.end)
    c = np.append(0, model.class_of[u])
    known, h = np.append(True, known), np.append(END, h)
    return c, known, np.where(known, END, h), ends


def _transition_counter(model: Model):
    """Class pairs of tokens; a word to be looked up has its hash beside the
    class (others: END).  Equal pairs of a task are added up before they leave it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = len(model.transition)
        total = np.zeros(classes * classes, np.int64)
        held: list[tuple] = []
        for batch in batches:
            for _, h, ending, at in tokens(batch.column(0), model.units.endings):
                c, known, h, _ = _parts(model, h, ending, at)
                both = known[:-1] & known[1:]
                total += np.bincount((c[:-1] * classes + c[1:])[both], minlength=len(total))
                k = np.flatnonzero(~both)
                if len(k):
                    held.append((h[k], c[k], h[k + 1], c[k + 1], np.ones(len(k), np.int64)))
                if sum(len(x[0]) for x in held) >= HELD:
                    yield _summed_pairs(held)
                    held = []
        if held:
            yield _summed_pairs(held)
        k = np.flatnonzero(total)
        end = np.full(len(k), END)
        yield _pair_rows(end, k // classes, end, k % classes, total[k])

    return count


def _summed_pairs(held: list[tuple]) -> pa.RecordBatch:
    """Equal pairs of (lh, lc, rh, rc, n) made one.  Put in order by a hash; pairs that share it stay apart."""
    *keys, n = (np.concatenate(x) for x in zip(*held, strict=True))
    wide = [np.ascontiguousarray(k, np.int64).view(np.uint64) for k in keys]
    order = np.argsort(mix(mix(wide[0] + np.uint64(1)) + mix(wide[2]) * np.uint64(3) + (wide[1] << np.uint64(32)) + wide[3]), kind="stable")
    keys = [k[order] for k in keys]
    first = np.flatnonzero(np.append(True, np.any([k[1:] != k[:-1] for k in keys], axis=0)))
    return _pair_rows(*[k[first] for k in keys], np.add.reduceat(n[order], first))


def _pair_rows(*columns) -> pa.RecordBatch:
    types = (np.int64, np.int32, np.int64, np.int32, np.int64)
    return pa.RecordBatch.from_arrays([pa.array(np.asarray(x).astype(t)) for x, t in zip(columns, types, strict=True)], names=["lh", "lc", "rh", "rc", "n"])


def _looked_up(pairs: DataFrame, tail: DataFrame) -> DataFrame:
    """``pairs`` with the classes of ``tail`` (h, n, c) where it has one, and
    with seen, the count of the right word (null: it needed no look-up).
    Rows without a hash take no part in the joins."""
    look = tail.select(F.col("h").alias("_h"), F.col("n").alias("_n"), F.col("c").alias("_c"))
    pairs = pairs.withColumn("seen", F.lit(None).cast("long"))
    for side in "lr":
        opened = pairs.filter(F.col(f"{side}h") != int(END)).join(look, F.col(f"{side}h") == F.col("_h"), "left")
        opened = opened.withColumn(f"{side}c", F.coalesce("_c", f"{side}c"))
        if side == "r":
            opened = opened.withColumn("seen", F.coalesce("_n", F.lit(0)).cast("long"))
        pairs = pairs.filter(F.col(f"{side}h") == int(END)).unionByName(opened.drop("_h", "_n", "_c"))
    return pairs


def refine(texts: DataFrame, model: Model, counts: DataFrame, scratch: Scratch, own: int = OWN) -> tuple[Model, DataFrame]:
    """``model`` (of ``fit``) with a class by its own neighbours for every word
    that occurs ``own`` times, and the stored h, n, c of the words beyond the
    head (c null: that of the ending).  Words of the head go to every task
    with their classes; the others' are joined."""
    old, classes = model.units, len(model.transition)
    real = counts.filter(F.col("h") != int(END))
    cells = texts.mapInArrow(_cell_counter(old, model.class_of, classes), "h long, cell int, n long").groupBy("h", "cell").agg(F.sum("n").alias("n"))
    # At most two numbers for each class and word; each occurrence has one class before it.
    words = cells.groupBy("h").agg(F.sum(F.when(F.col("cell") >= classes, F.col("n")).otherwise(0)).alias("n"), F.collect_list(F.col("n") * (2 * classes) + F.col("cell")).alias("cells"))
    step = model.transition * np.log(10.0)
    weights = np.concatenate([step.T, step])
    further = scratch.store(words.filter(F.col("n") >= own).mapInArrow(_best_class(weights, model.emission * np.log(10.0)), "h long, n long, c int"), "further")

    # Classes of the head: units of their own, then what is far enough up of the further words.
    endings = model.class_of[len(old.words) : old.end]
    by_ending = real.groupBy("ending").agg(F.sum(F.when(F.col("n") < own, F.col("n")).otherwise(0)).alias("n"), F.sum(F.when(F.col("n") < own, 1).otherwise(0)).alias("v")).toPandas()
    of_head = np.full(len(model.head), -1)
    if len(model.head):
        least = int(model.head_n.min())
        of_head[np.searchsorted(model.head, old.words)] = model.class_of[: len(old.words)]
        far = further.filter(F.col("n") >= max(least, _count_of(further, len(model.head)))).orderBy(F.desc("n"), "h").limit(len(model.head)).toArrow()
        far_h, far_c = far["h"].to_numpy(), far["c"].to_numpy().astype(np.int64)
        k = np.minimum(np.searchsorted(model.head, far_h), len(model.head) - 1)
        same = model.head[k] == far_h
        of_head[k[same]] = far_c[same]
    else:
        least = 0
    rare = of_head < 0  # of the head, but too rare: these stay outside, with the class of their ending
    units = Units(model.head[~rare], old.endings)
    class_of = np.concatenate([of_head[~rare], endings, [0]])
    tail = real.filter(F.col("n") <= max(least, own - 1)) if len(model.head) else real
    tail = scratch.store(tail.select("h", "n").join(further.select("h", "c"), "h", "left"), "tail")

    # Tokens and distinct words of each class.
    tokens_of, types_of = np.zeros(classes), np.zeros(classes)
    for r in further.groupBy("c").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect():
        tokens_of[r["c"]] += r["n"]
        types_of[r["c"]] += r["v"]
    np.add.at(tokens_of, endings[by_ending["ending"].to_numpy(np.int64)], by_ending["n"].to_numpy(np.float64))
    np.add.at(types_of, endings[by_ending["ending"].to_numpy(np.int64)], by_ending["v"].to_numpy(np.float64))
    if len(old.words):
        own_n = model.head_n[np.searchsorted(model.head, old.words)]
        mine = model.class_of[: len(old.words)]
        np.add.at(tokens_of, mine, own_n)
        np.add.at(types_of, mine, 1)
        # Units of their own that are rare were counted with their endings.
        few = [int(x) for x in old.words[own_n < own]]
        if few:
            for r in real.filter(F.col("n") < own).join(F.broadcast(texts.sparkSession.createDataFrame([(x,) for x in few], "h long")), "h").select("ending", "n").collect():
                tokens_of[endings[r["ending"]]] -= r["n"]
                types_of[endings[r["ending"]]] -= 1
    end_n = model.n - int(real.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    if end_n:
        tokens_of[0], types_of[0] = end_n, 1
    model = Model(units, class_of, model.transition, model.emission, model.head, model.head_n, model.n, model.v)
    pairs = scratch.store(texts.mapInArrow(_transition_counter(model), _PAIR), "transitions")
    g = np.zeros((classes, classes))
    for r in _looked_up(pairs, tail).groupBy("lc", "rc").agg(F.sum("n").alias("n")).collect():
        g[r["lc"], r["rc"]] = r["n"]
    transition, emission = _logs(g, tokens_of, types_of)
    return Model(units, class_of, transition, emission, model.head, model.head_n, model.n, model.v), tail


def _scorer(model: Model, end_n: int):
    """Rows of kind 0: what a text's tokens and pairs of tokens give without
    words beyond the head; kind 1: pairs with such a word, to be looked up."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The counts of the units' own words.
        own_n = model.head_n[np.searchsorted(model.head, model.units.words)] if len(model.units.words) else np.zeros(0)
        logs_of = np.append(np.log10(own_n + DELTA), np.zeros(model.units.endings + 1))
        logs_of[model.units.end] = np.log10(end_n + DELTA)
        for batch in batches:
            key, doc_id = batch.column(0).to_numpy(), batch.column(1)
            for a, h, ending, at in tokens(batch.column(2), model.units.endings):
                rows, size = len(at) - 1, np.diff(at)
                u, _ = with_ends(model.units.of(h, ending), at, model.units.end)
                c, known, h, ends = _parts(model, h, ending, at)
                logs = np.where(known[1:], logs_of[u], 0.0)
                both = known[:-1] & known[1:]
                part = np.where(both, model.transition[c[:-1], c[1:]], 0.0) + np.where(known[1:], logs - model.emission[c[1:]], 0.0)
                total, base, seen = (np.append(0, np.cumsum(x)) for x in (part, logs, known[1:]))
                shared, plain = total[ends[1:]] - total[ends[:-1]], base[ends[1:]] - base[ends[:-1]]
                n_known = seen[ends[1:]] - seen[ends[:-1]] - (0 if end_n else 1)
                yield _rows(0, key[a : a + rows], doc_id.slice(a, rows), *[np.zeros(rows, np.int64)] * 4, size + 1, n_known, plain, shared)
                k = np.flatnonzero(~both)
                if len(k):
                    row = np.repeat(np.arange(rows), size + 1)[k]
                    five = [row, h[k], c[k], h[k + 1], c[k + 1]]
                    order = np.lexsort(five[::-1])
                    five = [x[order] for x in five]
                    new = np.append(True, np.any([x[1:] != x[:-1] for x in five], axis=0))
                    first = np.flatnonzero(new)
                    times = np.diff(np.append(first, len(row)))
                    zero = np.zeros(len(first))
                    yield _rows(1, key[a + five[0][first]], pa.nulls(len(first), pa.int64()), *[x[first] for x in five[1:]], times, zero.astype(np.int64), zero, zero)

    return score


def _pair_logs(model: Model):
    """What looked-up pairs add: log and known for right words that were looked
    up, and more, with the transition and such a word's class."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right, n = (batch.column(k).to_numpy() for k in (1, 2, 3))
            wide = batch.column(4).is_valid().to_numpy(zero_copy_only=False)
            seen = batch.column(4).fill_null(0).to_numpy()
            log = np.where(wide, np.log10(seen + DELTA), 0.0)
            more = model.transition[left, right] + np.where(wide, log - model.emission[right], 0.0)
            arrays = [batch.column(0), pa.array(n * log), pa.array(n * more), pa.array(np.where(seen > 0, n, 0))]
            yield pa.RecordBatch.from_arrays(arrays, names=["key", "log", "more", "known"])

    return add


_SCORED = "kind int, key long, doc_id long, lh long, lc int, rh long, rc int, n long, n_known long, base double, score double"


def _rows(kind: int, key, doc_id: pa.Array, *rest) -> pa.RecordBatch:
    types = [np.int64, np.int32, np.int64, np.int32, np.int64, np.int64, np.float64, np.float64]
    arrays = [pa.array(np.full(len(key), kind, np.int32)), pa.array(key, pa.int64()), doc_id.cast(pa.int64())]
    arrays += [pa.array(np.asarray(x).astype(t)) for x, t in zip(rest, types, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=["kind", "key", "doc_id", "lh", "lc", "rh", "rc", "n", "n_known", "base", "score"])


def score_texts(docs: DataFrame, folds: int = FOLDS, own: int = OWN, **sizes: int) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): held_out, n_tokens,
    n_known, train_tokens, base_score, score, perplexity.

    A null text counts as empty: its one token is its end.  A null doc_id is
    held out.  Rows that repeat a doc_id or a text are scored one by one.
    With nothing to learn from, every token is unknown."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "brown")
    docs = docs.select("doc_id", "text")
    train = docs.filter(~held_out("doc_id", folds)).select("text")
    model, counts = fit(train, scratch, **sizes)
    model, tail = refine(train, model, counts, scratch, own)
    end_n = int(counts.filter(F.col("h") == int(END)).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    # Both kinds of rows come from one stored pass, so they agree on the keys.
    keyed = docs.select(F.monotonically_increasing_id().alias("key"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    scored = scratch.store(keyed.mapInArrow(_scorer(model, end_n), _SCORED), "scored")
    pairs = _looked_up(scored.filter("kind = 1").select("key", "lh", "lc", "rh", "rc", "n"), tail)
    parts = pairs.select("key", "lc", "rc", "n", "seen").mapInArrow(_pair_logs(model), "key long, log double, more double, known long")
    more = parts.groupBy("key").agg(*[F.sum(c).alias(c) for c in ("log", "more", "known")])
    out = scored.filter("kind = 0").select("key", "doc_id", "n", "n_known", "base", "score").join(more, "key", "left")
    divisor = float(np.log10(model.n + DELTA * (model.v + 1)))
    base = F.col("base") + F.coalesce("log", F.lit(0.0)) - F.col("n") * F.lit(divisor)
    score = F.col("score") + F.coalesce("more", F.lit(0.0))
    return out.select(
        "doc_id",
        held_out("doc_id", folds).alias("held_out"),
        F.col("n").alias("n_tokens"),
        (F.col("n_known") + F.coalesce("known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(model.n).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        score.alias("score"),
        F.pow(F.lit(10.0), -score / F.col("n")).alias("perplexity"),
    )
