"""LM scoring with a hierarchical Pitman-Yor model of word pairs, beside a smoothed unigram score.

Restaurants. Every word of the training corpus, and the start of a text, is the
context of a restaurant; its dishes are all words and the end of a text. The
context restaurants share one parent over all words, whose base spells a word
byte by byte: restaurants per two preceding bytes have a parent per preceding
byte, and these share one.

Seating. A cell is a dish of a restaurant: its customers, and the tables they
sit at. A sweep draws the tables of every cell from their conditional given all
other cells: with c customers and new tables at rate a, t tables have the weight
a^t S(c, t), S the generalized Stirling numbers of the discount. That is Gibbs
sampling with the seats of a cell summed out. Restaurants' totals and the
parent's probabilities are those of the sweep before (less what the cell itself
sends to its parent), so all cells are drawn at once. Predictive probabilities
are averaged over the sweeps after the first ``BURN``. Letters are few: their cells are drawn
alike on the driver, at most 257 after each two, and their parents seated one customer at a time (``seated``).

Scale. Cells are rows of a table, counted over all training texts, and nothing
bounds their number; draws are seeded by the cell itself, so scores do not
depend on how rows are dealt. Words above a count that at most ``WARM_WORDS``
words reach, and pairs above one that at most ``WARM_PAIRS`` reach, are looked up
inside the tasks or by a broadcast of that many rows. All others go through
joins, which give the same sums; their keys are rare by construction. A pair
that occurs once in the training texts has one table whatever is drawn, so it
is a cell only if a held-out text has it too: what such pairs add to their words
is what the cells leave of the words' counts, and a training text scores a pair
that is no cell as one of a single customer.

Nulls: a null text is empty and has the end as its only token; a null id counts
as an empty one for the split. Repeated rows are learned and scored each. Empty
tables give an empty result. Texts are scored whole; extra columns are ignored.
Words are known by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from murmura.llm.base import drop, query, table
from murmura.llm.bytescan import FOLD_BYTES, SPACED, Words, mix, row_blocks, words
from murmura.session import materialize

WARM_WORDS = 1 << 18
WARM_PAIRS = 1 << 20
ALPHA = 0.1
HELD_OUT_OF = 10

STRENGTH = 1.0
ROUNDS, STEPS = 3, 8
SWEEPS, BURN = 4, 2
SEED = 7

# Share of the end of a text in the base over all dishes; spelled words have the rest.
END_SHARE = 0.01
# Customers up to which a cell's tables are drawn from tabulated weights.
_TABULATED = 64
# Rate up to which larger cells are the tabulated one and a Poisson number of tables more.
_LOW_RATE = 6.0
# Rows drawn at once.
_DRAWN_ROWS = 1 << 17
# Bytes of text whose pairs are counted before the shuffle.
_COUNTED_BYTES = 6 << 20
# Spark deletes the shuffle files of a write or an action as it ends; nothing here reads them twice.
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Letters of a word: its bytes, and its end, which also stands before its first byte.
_SPELLED, _END = 257, 256


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % HELD_OUT_OF == 0


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go as soon as the step that made them is written."""
    before = spark.conf.get(_FREE_SHUFFLES)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(_FREE_SHUFFLES, before)


# --- seating -----------------------------------------------------------------------


def discount(counts_of_one: float, counts_of_two: float) -> float:
    """The usual estimate of a discount from how many dishes have one and two customers."""
    return min(0.95, max(0.05, counts_of_one / (counts_of_one + 2 * counts_of_two))) if counts_of_one else 0.5


def first_tables(c: np.ndarray, base: np.ndarray, strength: float, d: float, rng: np.random.Generator) -> np.ndarray:
    """Tables per dish when ``c`` customers come one after the other; past the first 32, in groups of a sixteenth."""
    n, t = np.minimum(c, 1).astype(np.int64), np.minimum(c, 1).astype(np.int64)
    while True:
        open_ = np.flatnonzero(n < c)
        if not len(open_):
            return t
        group = np.minimum(np.maximum(1, np.where(n[open_] < 32, 1, n[open_] // 16)), c[open_] - n[open_])
        new = (strength + d * t.sum()) * base[open_]
        p = new / (new + n[open_] - d * t[open_])
        t[open_] += rng.binomial(group, np.clip(p, 0.0, 1.0))
        n[open_] += group


def seated(c: np.ndarray, base: np.ndarray, strength: float, d: float, steps: int, rng: np.random.Generator) -> np.ndarray:
    """Tables per dish of a restaurant with ``c`` customers per dish, after Gibbs steps that reseat one customer of each dish.

    ``base`` is the parent's probability of each dish.
    """
    dishes = len(c)
    t = first_tables(c, base, strength, d, rng)
    owner = np.repeat(np.arange(dishes), t)
    # Tables of a dish share its customers: one each, the rest by gamma weights.
    size = np.ones(len(owner), np.int64)
    weight = rng.gamma(1 - d, size=len(owner)) + 1e-9
    spare = c - t
    share = np.floor(weight / np.bincount(owner, weight, dishes)[owner] * spare[owner]).astype(np.int64)
    size += share
    first = np.concatenate([[0], np.cumsum(t)[:-1]]) if dishes else np.zeros(0, np.int64)
    has = np.flatnonzero(t)
    size[first[has]] += (spare - np.bincount(owner, share, dishes).astype(np.int64))[has]
    movers = np.flatnonzero(c > 1)
    for _ in range(steps if len(movers) else 0):
        # A customer leaves: a table is met as often as it has customers.
        size[_drawn(size.astype(float), owner, movers, dishes, rng)] -= 1
        owner, size = owner[size > 0], size[size > 0]
        t = np.bincount(owner, minlength=dishes)
        # It sits down at a new table, or at one of its dish as often as that has customers, less the discount.
        new = (strength + d * t.sum()) * base[movers]
        old = c[movers] - 1 - d * t[movers]
        alone = (t[movers] == 0) | (rng.random(len(movers)) * (new + old) < new)
        stay = movers[~alone]
        if len(stay):
            size[_drawn(size - d, owner, stay, dishes, rng)] += 1
        owner = np.concatenate([owner, movers[alone]])
        size = np.concatenate([size, np.ones(int(alone.sum()), np.int64)])
        order = np.argsort(owner, kind="stable")
        owner, size = owner[order], size[order]
    return np.bincount(owner, minlength=dishes)


def _drawn(weight: np.ndarray, owner: np.ndarray, dishes: np.ndarray, n: int, rng: np.random.Generator) -> np.ndarray:
    """One table of each of ``dishes``, drawn by weight; tables lie dish by dish."""
    total = np.cumsum(weight)
    count = np.bincount(owner, minlength=n)
    last = np.cumsum(count)[dishes] - 1
    first = last - count[dishes] + 1
    low = np.where(first > 0, total[np.maximum(first - 1, 0)], 0.0)
    at = np.searchsorted(total, low + rng.random(len(dishes)) * (total[last] - low), side="right")
    return np.clip(at, first, last)


def _predictive(c: np.ndarray, t: np.ndarray, d: float, parent: np.ndarray) -> np.ndarray:
    """Probabilities of the dishes of each restaurant (a row) given its parent's."""
    return (c - d * t + (STRENGTH + d * t.sum(1, keepdims=True)) * parent) / (STRENGTH + c.sum(1, keepdims=True))


def _discount_of(c: np.ndarray) -> float:
    return discount(float((c == 1).sum()), float((c == 2).sum()))


def hierarchy(counts: DataFrame, contexts: int, dishes: int, above: np.ndarray, rounds: int = ROUNDS, steps: int = STEPS) -> np.ndarray:
    """Averaged log10 probabilities (context, dish) from counts (u, w, c) of at most ``contexts * dishes`` rows.

    Restaurant u's parent is restaurant ``above[u]`` of the level between, and
    those share one parent. Each round draws the tables of all cells of the
    context restaurants, given their parents' probabilities; the tables of each
    level are the customers of the next.
    """
    rows = counts.toArrow().to_pandas()
    at = rows["u"].to_numpy(), rows["w"].to_numpy()
    cells, seeds = rows["c"].to_numpy(), (at[0].astype(np.uint64) * np.uint64(dishes) + at[1].astype(np.uint64))
    c, t = np.zeros((contexts, dishes), np.float32), np.zeros((contexts, dishes), np.float32)
    c[at], t[at] = cells, 1
    d, middle = _discount_of(rows["c"].to_numpy()), int(above.max()) + 1
    parents = np.full((middle, dishes), 1 / dishes)
    total = np.zeros((contexts, dishes), np.float32)
    for k in range(rounds):
        tables = t.sum(1)[at[0]] - t[at]
        drawn = drawn_tables(cells, (STRENGTH + d * tables) * parents[above[at[0]], at[1]], d, mix(seeds), k)
        t[at] = drawn
        rng = np.random.default_rng([SEED, k])
        customers = np.zeros((middle, dishes), np.int64)
        np.add.at(customers, (above[at[0]], at[1]), drawn)
        root, between = np.full(dishes, 1 / dishes), _discount_of(customers)
        if middle > 1:
            # The level between: seated given the root of the round before, then the root given its tables.
            tables = np.stack([seated(own, parents.mean(0), STRENGTH, between, steps, rng) for own in customers])
            last = tables.sum(0)
            d0 = _discount_of(last)
            root = _predictive(last[None], seated(last, root, STRENGTH, d0, steps, rng)[None], d0, root)[0]
        else:
            tables = seated(customers[0], root, STRENGTH, between, steps, rng)[None]
        parents = _predictive(customers, tables, between, root)
        if k:
            total += _predictive(c, t, d, parents[above])
    return np.log10(total / (rounds - 1))


# --- counting ----------------------------------------------------------------------


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in row_blocks(whole, "text", 16 << 20):
            found = words(batch.column("text"), SPACED)
            _, first, n = np.unique(found.hashes, return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays([found.spelled(first), pa.array(n.astype(np.int64))], names=["word", "n"])


def word_counts(train: DataFrame) -> DataFrame:
    """(word, n) of all training texts."""
    return train.select("text").mapInArrow(_word_counts, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def count_reached_by(vocabulary: DataFrame, most: int) -> int:
    """The least count that at most ``most`` words reach."""
    levels = vocabulary.groupBy("n").count().orderBy(F.col("n").desc()).limit(most + 1).collect()
    reached, least = 0, (levels[0]["n"] + 1) if levels else 1
    for row in levels:
        reached += row["count"]
        if reached > most:
            return least
        least = row["n"]
    return least


def _hashes(names: list[str]) -> np.ndarray:
    return words(pa.array(names, pa.string()), SPACED).hashes


@dataclass
class Places:
    """Places among sorted numbers that are spread evenly over 64 bits, by their leading bits."""

    numbers: np.ndarray

    def __post_init__(self) -> None:
        bits = max(1, len(self.numbers).bit_length())
        self.shift = np.uint64(64 - bits)
        self.first = np.searchsorted(self.numbers, np.arange(1 << bits, dtype=np.uint64) << self.shift).astype(np.int32)

    def of(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place of the least number that is not below each ``x``, the last place at most, and where it is ``x``."""
        last = len(self.numbers) - 1
        at = np.minimum(self.first[(x >> self.shift).view(np.int64)], last)
        found = self.numbers[at]
        below = np.flatnonzero(found < x)
        while len(below):
            below = below[at[below] < last]
            at[below] += 1
            found[below] = self.numbers[at[below]]
            below = below[found[below] < x[below]]
        return at, found == x


@dataclass
class Codes:
    """Numbers of words: frequent ones by their place among the sorted hashes, then one for the start and end of a text; any other word a negative one."""

    hashes: np.ndarray

    def __post_init__(self) -> None:
        self.places = Places(self.hashes)

    @property
    def edge(self) -> int:
        return len(self.hashes)

    @property
    def width(self) -> int:
        return len(self.hashes) + 1

    def of(self, hashes: np.ndarray) -> np.ndarray:
        rare = (hashes | np.uint64(1 << 63)).view(np.int64)
        if not len(self.hashes):
            return rare
        at, found = self.places.of(hashes)
        return np.where(found, at, rare)

    def seeds(self, codes: np.ndarray) -> np.ndarray:
        """A number of each word that does not depend on which words are frequent."""
        frequent = np.append(self.hashes | np.uint64(1 << 63), np.uint64(1))
        return np.where(codes >= 0, frequent[np.maximum(codes, 0)], codes.view(np.uint64))

    def pairs(self, found: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Context and dish of every token, the ends included, the text of each, and which are words."""
        texts = len(found.counts)
        dishes = np.full(len(found.hashes) + texts, self.edge)
        is_word = np.ones(len(dishes), dtype=bool)
        is_word[found.bounds[1:] + np.arange(texts)] = False
        dishes[is_word] = self.of(found.hashes)
        contexts = np.concatenate([[self.edge], dishes[:-1]]) if len(dishes) else dishes
        return contexts, dishes, np.repeat(np.arange(texts), found.counts + 1), is_word


def pair_counts(texts: DataFrame, codes: Codes) -> DataFrame:
    """(u, w, c, held): how often ``w`` follows ``u`` in the training texts of (text, held_out), and whether any other has it.

    Counted a block at a time before the shuffle, where two frequent words are one number, u * width + w, beside a zero.
    """

    def counted(u: np.ndarray, w: np.ndarray, held: int) -> pa.RecordBatch:
        frequent = (u >= 0) & (w >= 0)
        both, n = np.unique(u[frequent] * codes.width + w[frequent], return_counts=True)
        rest = np.stack([u[~frequent], w[~frequent]])
        rest = rest[:, np.lexsort(rest)]
        first = np.flatnonzero(np.concatenate([[True], (rest[:, 1:] != rest[:, :-1]).any(0)])) if rest.shape[1] else np.zeros(0, np.int64)
        n = np.concatenate([n, np.diff(np.append(first, rest.shape[1]))])
        columns = [np.concatenate([both, rest[0, first]]), np.concatenate([np.zeros_like(both), rest[1, first]]), n * (1 - held), np.full(len(n), held)]
        return pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in columns], names=["u", "w", "c", "held"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches, _COUNTED_BYTES):
            apart = batch.column("held_out").to_numpy(zero_copy_only=False)
            u, w, owner, _ = codes.pairs(words(batch.column("text"), SPACED))
            apart = apart[owner]
            yield counted(u[~apart], w[~apart], 0)
            yield counted(u[apart], w[apart], 1)

    found = texts.select("text", "held_out").mapInArrow(rows, "u bigint, w bigint, c bigint, held bigint").groupBy("u", "w").agg(F.sum("c").alias("c"), F.max("held").alias("held"))
    # A pair with a rare word has a negative number.
    packed, width = (F.col("u") >= 0) & (F.col("w") >= 0), F.lit(codes.width).cast("bigint")
    u = F.when(packed, F.expr(f"u div {codes.width}")).otherwise(F.col("u"))
    return found.select(u.alias("u"), F.when(packed, F.col("u") % width).otherwise(F.col("w")).alias("w"), "c", "held")


def _blocks(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows of about ``limit`` bytes, joined from batches or cut out of one."""
    held, size = [], 0
    for batch in batches:
        if held and size + batch.nbytes > limit:
            yield pa.concat_batches(held)
            held, size = [], 0
        if batch.nbytes > limit:
            yield from row_blocks(batch, "text", limit)
        else:
            held.append(batch)
            size += batch.nbytes
    if held:
        yield pa.concat_batches(held)


def _spelling(found: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per letter of the folded words, each followed by its end: the two letters before it, the letter, and its word's first place."""
    lengths = found.ends - found.starts
    ends = np.cumsum(lengths + 1)
    first = ends - lengths - 1
    letters = np.full(ends[-1] if len(ends) else 0, _END, np.int64)
    places = np.arange(len(letters))
    inside = np.ones(len(letters), dtype=bool)
    inside[ends - 1] = False
    source = places[inside] + np.repeat(found.starts - first, lengths)
    folded = np.frombuffer(found.raw[source].tobytes().translate(FOLD_BYTES), np.uint8)
    letters[inside] = folded
    before = np.concatenate([[_END], letters[:-1]]) if len(letters) else letters
    before[first] = _END
    twice = np.concatenate([[_END], before[:-1]]) if len(letters) else letters
    twice[first] = _END
    return twice, before, letters, first


def spelling_counts(vocabulary: DataFrame) -> DataFrame:
    """(a, b, w, c): how often a byte, or the end, follows two bytes in the distinct words."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in row_blocks(whole, "word"):
                twice, before, letters, _ = _spelling(words(batch.column("word"), SPACED))
                keys, n = np.unique((twice * _SPELLED + before) * _SPELLED + letters, return_counts=True)
                parts = (keys // _SPELLED**2, keys // _SPELLED % _SPELLED, keys % _SPELLED)
                yield pa.RecordBatch.from_arrays([*[pa.array(x.astype(np.int32)) for x in parts], pa.array(n.astype(np.int64))], names=["a", "b", "w", "c"])

    return vocabulary.select("word").mapInArrow(rows, "a int, b int, w int, c bigint").groupBy("a", "b", "w").agg(F.sum("c").alias("c"))


@dataclass
class Spelling:
    """Letter probabilities by two letters before; ``number`` makes the bytes seen consecutive, the last number any other."""

    number: np.ndarray
    log10: np.ndarray

    def of(self, found: Words) -> np.ndarray:
        """log10 probability of spelling each word."""
        if not len(found.starts):
            return np.zeros(0)
        twice, before, letters, first = _spelling(found)
        n = int(self.number.max()) + 1
        return np.add.reduceat(self.log10[self.number[twice] * n + self.number[before], self.number[letters]].astype(np.float64), first)


def learned_spelling(vocabulary: DataFrame) -> Spelling:
    """Letters of the distinct words: a restaurant per two letters, their parents one per letter, and one above all."""
    counts = materialize(spelling_counts(vocabulary))
    seen = [r["w"] for r in counts.select("w").distinct().collect()]  # at most 257
    number = np.full(_SPELLED, len(seen))
    number[sorted(seen)] = np.arange(len(seen))
    n = len(seen) + 1
    numbered = F.array(*map(F.lit, number.tolist()))
    of = lambda c: F.get(numbered, F.col(c))
    compact = counts.select((of("a") * n + of("b")).cast("int").alias("u"), of("w").cast("int").alias("w"), "c")
    return Spelling(number, hierarchy(compact, n * n, n, np.tile(np.arange(n), n)))


# --- seating of cells --------------------------------------------------------------


def stirling_log(d: float, most: int = _TABULATED) -> np.ndarray:
    """log S(c, t) of discount ``d``: S(c + 1, t) = S(c, t - 1) + (c - d t) S(c, t)."""
    out = np.full((most + 1, most + 1), -np.inf)
    out[1, 1] = 0.0
    t = np.arange(1, most + 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        for c in range(1, most):
            out[c + 1, 1:] = np.logaddexp(out[c, :-1], np.where(t <= c, np.log(np.maximum(c - d * t, 1e-300)) + out[c, 1:], -np.inf))
    return out


def uniforms(seeds: np.ndarray, k: int) -> np.ndarray:
    """The ``k``-th number in (0, 1) of each seed."""
    return (mix(seeds ^ mix(np.full(1, SEED << 32 | k, np.uint64))) >> np.uint64(12)) * 2.0**-52 + 2.0**-53


def _poisson(mean: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Poisson draws of small means by inversion."""
    n, p, left = np.zeros(len(mean)), np.exp(-mean), u.copy()
    for j in range(1, 1_000):
        more = left >= p
        if not more.any():
            break
        left -= np.where(more, p, 0)
        n += more
        p = np.where(more, p * mean / j, np.inf)
    return n


def many_tables(c: np.ndarray, rate: np.ndarray, d: float) -> tuple[np.ndarray, np.ndarray]:
    """Mean and variance of the tables of large cells at a high rate.

    Tables of a cell are a Poisson number of sizes, of which z**size weighs as in the series (1 - (1 - z)**d) / d, given
    that they sum to c. At the z where the expected sum is c, count and sum are nearly normal; the mean has the saddle
    point's first correction, half the change of the log spread with the log rate, as far as one table: more is beyond
    the normal limit.
    """

    def saddle(rate: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        low, high = np.full(len(c), -700.0), np.zeros(len(c))
        for _ in range(60):
            middle = (low + high) / 2
            with np.errstate(divide="ignore"):
                above = np.log(rate) + np.log1p(-np.exp(middle)) + (d - 1) * middle > np.log(c)
            low, high = np.where(above, middle, low), np.where(above, high, middle)
        x = np.exp((low + high) / 2)
        return rate * (1 - x**d) / d, c + rate * (1 - x) ** 2 * (1 - d) * x ** (d - 2)

    mean, spread = saddle(rate)
    step = 0.02
    change = np.log(saddle(rate * math.exp(step))[1] / saddle(rate * math.exp(-step))[1]) / (2 * step)
    return mean + np.clip(-change / 2, 0.0, 1.0), np.maximum(mean - c * (c / spread), 0.0)


def drawn_tables(c: np.ndarray, rate: np.ndarray, d: float, seeds: np.ndarray, k: int = 0) -> np.ndarray:
    """Tables of cells with ``c`` customers whose new tables come at ``rate``: t with weight rate^t S(c, t).

    Up to ``_TABULATED`` customers the weights are tabulated. Beyond, with m = _TABULATED and r the product of
    (1 - d / j) for j from m to c - 1, the recurrence of S at a low rate is that of tables which each keep the weight r
    while others come independently: the tables of m customers at rate r * rate, and a Poisson number of mean
    rate / d * (1 - r). At a high rate counts are drawn from their normal limit.
    """
    logs, size = stirling_log(d), np.minimum(c, _TABULATED).astype(np.int64)
    shift = (1 + d) / 2
    kept = np.where(c > _TABULATED, ((_TABULATED - shift) / (np.maximum(c, _TABULATED) - shift)) ** d, 1.0)
    log_rate, u = np.log(np.maximum(rate * kept, 1e-300)), uniforms(seeds, 4 * k)
    out = np.minimum(size, 1)
    high = (c > _TABULATED) & (rate > _LOW_RATE)
    size[high] = 0
    order = np.argsort(size, kind="stable")
    bounds = np.searchsorted(size[order], np.arange(2, _TABULATED + 2))
    for m in range(2, _TABULATED + 1):
        at = order[bounds[m - 2] : bounds[m - 1]]
        if len(at):
            weights = logs[m, 1 : m + 1] + np.arange(1, m + 1) * log_rate[at, None]
            reached = np.cumsum(np.exp(weights - weights.max(1, keepdims=True)), 1)
            out[at] = np.minimum(1 + (reached < (u[at] * reached[:, -1])[:, None]).sum(1), m)
    low = np.flatnonzero((c > _TABULATED) & ~high)
    out[low] += _poisson(rate[low] / d * (1 - kept[low]), uniforms(seeds[low], 4 * k + 1)).astype(np.int64)
    high = np.flatnonzero(high)
    mean, variance = many_tables(c[high], rate[high], d)
    normal = np.sqrt(-2 * np.log(uniforms(seeds[high], 4 * k + 2))) * np.cos(2 * np.pi * uniforms(seeds[high], 4 * k + 3))
    out[high] = np.rint(mean + np.sqrt(variance) * normal)
    return np.clip(out, np.minimum(c, 1), c).astype(np.int64)


def _gathered(batches: Iterator[pa.RecordBatch], rows: int = _DRAWN_ROWS) -> Iterator[pa.Table]:
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _with_draws(df: DataFrame, kept: list[str], draw) -> DataFrame:
    """The columns ``kept`` of ``df`` and ``t``, drawn from all its columns."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in _gathered(batches):
            t = draw({name: found.column(name).to_numpy() for name in found.column_names})
            yield from found.select(kept).append_column("t", pa.array(t)).to_batches()

    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return df.mapInArrow(rows, ", ".join([*(f"{name} {kinds[name]}" for name in kept), "t bigint"]))


def coded_words(vocabulary: DataFrame, codes: Codes, spelling: Spelling, n_texts: int) -> DataFrame:
    """(k, n, base): code, count and base probability of every word, and of the end of a text."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = words(batch.column("word"), SPACED)
            base = (1 - END_SHARE) * 10.0 ** spelling.of(found)
            yield pa.RecordBatch.from_arrays([pa.array(codes.of(found.hashes)), batch.column("n"), pa.array(base)], names=["k", "n", "base"])

    end = vocabulary.sparkSession.range(1).select(F.lit(codes.edge).cast("bigint").alias("k"), F.lit(n_texts).cast("bigint").alias("n"), F.lit(END_SHARE).alias("base"))
    return vocabulary.select("word", "n").mapInArrow(rows, "k bigint, n bigint, base double").unionByName(end)


def with_words(rows: DataFrame, key: str, of_words: DataFrame, how: str = "inner") -> DataFrame:
    """``rows`` with the columns of ``of_words`` (k, ...), where k = ``key``; frequent words (k >= 0, at most ``WARM_WORDS`` + 1) are broadcast."""
    named = of_words.withColumnRenamed("k", key)
    frequent = rows.filter(F.col(key) >= 0).join(F.broadcast(named.filter(F.col(key) >= 0)), key, how)
    return frequent.unionByName(rows.filter(F.col(key) < 0).join(named.filter(F.col(key) < 0), key, how))


def _sent(cells: DataFrame, t: Column) -> DataFrame:
    """(k, tables, customers): tables of each restaurant, and of each dish, which are the parent's customers."""
    none = F.lit(0).cast("bigint")
    sides = F.array(
        F.struct(F.col("u").alias("k"), t.alias("tables"), none.alias("customers")), F.struct(F.col("w").alias("k"), none.alias("tables"), t.alias("customers"))
    )
    return cells.select(F.inline(sides)).groupBy("k").agg(F.sum("tables").alias("tables"), F.sum("customers").alias("customers"))


def _told(of_words: DataFrame, sent: DataFrame) -> DataFrame:
    """``of_words``, one row a word, with the sums of ``sent`` by one shuffle of both."""
    own = [c for c in of_words.columns if c != "k"]
    both = of_words.unionByName(sent, allowMissingColumns=True)
    return both.groupBy("k").agg(*(F.max(c).alias(c) for c in own), F.coalesce(F.sum("tables"), F.lit(0)).alias("tables"), F.coalesce(F.sum("customers"), F.lit(0)).alias("customers"))


def discount_of_cells(cells: DataFrame, coded: DataFrame) -> float:
    """The discount, where pairs of one customer are what ``cells`` (u, w, c) of more leave of the words' counts."""
    sums = cells.filter(F.col("c") > 1).agg(F.coalesce(F.sum("c"), F.lit(0)).alias("all"), F.count(F.when(F.col("c") == 2, 1)).alias("two")).first()
    return discount((coded.agg(F.sum("n")).first()[0] or 0) - sums["all"], sums["two"])


def seated_cells(pairs: DataFrame, coded: DataFrame, codes: Codes) -> tuple[DataFrame, DataFrame, list[float]]:
    """Seat all cells of materialised ``pairs`` (u, w, c).

    Returns (u, w, c, log10) of all pairs, words (k, n, back_i, parent_i for each averaged sweep i), and the share that
    the base has in the parent in each of these sweeps.
    """
    by_size = {r["c"]: r["count"] for r in pairs.filter(F.col("c") <= 2).groupBy("c").count().collect()}
    d = discount(by_size.get(1, 0), by_size.get(2, 0))
    single = _told(coded, _sent(pairs.filter(F.col("c") == 1), F.lit(1).cast("bigint")))
    every, state, shares = _seated(pairs, coded, codes, d, single)
    backs, parents = ([F.col(f"{x}_{i}") for i in range(len(shares))] for x in ("back", "parent"))
    every = with_words(with_words(every, "u", state.select("k", "n", *backs)), "w", state.select("k", *parents))
    own = (F.col("c") - d * F.col("mean")) / (STRENGTH + F.col("n"))
    return every.select("u", "w", "c", F.log10(own + backed_off(backs, parents)).alias("log10")), state, shares


def _seated(pairs: DataFrame, coded: DataFrame, codes: Codes, d: float, single: DataFrame) -> tuple[DataFrame, DataFrame, list[float]]:
    """(u, w, c, mean) of ``pairs`` with their mean tables, and the words and shares of ``seated_cells``.

    ``single`` has the words with what they send and get as tables of pairs of one customer, among ``pairs`` or not.
    """
    one = F.lit(1).cast("bigint")
    shared = pairs.sparkSession.sparkContext.broadcast(codes)
    # A single customer has one table whatever else is drawn.
    single = single.withColumnsRenamed({"tables": "lone_tables", "customers": "lone_customers"})
    cells = pairs.filter(F.col("c") > 1).select("u", "w", "c", one.alias("t"), F.lit(0).cast("bigint").alias("total"))

    def after(of_words: DataFrame) -> DataFrame:
        summed = _told(of_words, _sent(cells, F.col("t")))
        return summed.withColumns({"tables": F.col("tables") + F.col("lone_tables"), "customers": F.col("customers") + F.col("lone_customers")})

    alone = materialize(single)
    state = materialize(after(alone))
    drop(alone)
    parent_tables, shares, samples = coded.count(), [], []
    for k in range(SWEEPS):
        m = state.agg(F.sum("customers").alias("all"), F.count(F.when(F.col("customers") == 1, 1)).alias("one"), F.count(F.when(F.col("customers") == 2, 1)).alias("two")).first()
        above = discount(m["one"], m["two"])
        weight = STRENGTH + above * parent_tables

        def seat_parent(x: dict[str, np.ndarray], above: float = above, weight: float = weight, k: int = k) -> np.ndarray:
            return drawn_tables(x["customers"], weight * x["base"], above, mix(shared.value.seeds(x["k"])), k)

        parent = materialize(_with_draws(state, state.columns, seat_parent))
        parent_tables = parent.agg(F.sum("t")).first()[0] or 0
        everyone = STRENGTH + (m["all"] or 0)
        share = (STRENGTH + above * parent_tables) / everyone
        probability = (F.col("customers") - above * F.col("t")) / everyone + share * F.col("base")

        def seat(x: dict[str, np.ndarray], k: int = k) -> np.ndarray:
            # What the parent would serve without this cell's tables, and the other tables of its restaurant.
            own = x["t"] / np.maximum(x["customers"], 1)
            without = x["parent"] * (1 - own) + x["rest"] * own
            return drawn_tables(x["c"], (STRENGTH + d * (x["tables"] - x["t"])) * without, d, mix(mix(shared.value.seeds(x["u"])) + shared.value.seeds(x["w"])), k)

        near = with_words(cells, "u", parent.select("k", "tables"))
        near = with_words(near, "w", parent.select("k", "customers", probability.alias("parent"), (share * F.col("base")).alias("rest")))
        drawn = _with_draws(near.withColumn("before", F.col("total")), ["u", "w", "c", "before"], seat)
        total = F.col("before") + (F.col("t") if k >= BURN else 0)
        last, cells = cells, materialize(drawn.select("u", "w", "c", "t", total.alias("total")))
        if k:
            drop(last)
        if k >= BURN:
            samples.append(f"parent_{len(shares)}")
            parent = parent.withColumn(samples[-1], probability)
            shares.append(share)
        earlier, served = state, parent
        state = after(parent.drop("tables", "customers", "t"))
        if k >= BURN:
            state = state.withColumn(f"back_{len(shares) - 1}", (STRENGTH + d * F.col("tables")) / (STRENGTH + F.col("n")))
        state = materialize(state)
        drop(earlier)
        drop(served)

    n = len(shares)
    every = pairs.filter(F.col("c") == 1).withColumn("total", F.lit(0).cast("bigint")).unionByName(cells.select("u", "w", "c", "total"))
    every = every.select("u", "w", "c", F.when(F.col("c") == 1, 1.0).otherwise(F.col("total") / n).alias("mean"))
    return every, state.select("k", "n", *(f"back_{i}" for i in range(n)), *samples), shares


def backed_off(back: list[Column], parent: list[Column]) -> Column:
    """The share of the parent in a probability, averaged over sweeps."""
    return sum((b * p for b, p in zip(back, parent, strict=True)), F.lit(0.0)) / len(back)


# --- scoring -----------------------------------------------------------------------


@dataclass
class Model:
    """What every task needs of a trained model: bounded whatever the corpus."""

    codes: Codes
    spelling: Spelling
    counts: np.ndarray
    back: np.ndarray
    parent: np.ndarray
    shares: np.ndarray
    pairs: Places
    pair_log10: np.ndarray
    discount: float
    tokens: int
    distinct: int

    def own(self, c: np.ndarray, mean: np.ndarray, n: np.ndarray) -> np.ndarray:
        """What a cell has of its own restaurant, which has ``n`` customers."""
        return (c - self.discount * mean) / (STRENGTH + n)

    def backed_off(self, u: np.ndarray, w: np.ndarray) -> np.ndarray:
        """The share of the parent in the probabilities of pairs of frequent words."""
        return (self.back[u] * self.parent[w]).mean(1)

    def base_log10(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + ALPHA) / (self.tokens + ALPHA * (self.distinct + 1)))


_NEAR, _FAR = "array<struct<pair:bigint,times:bigint>>", "array<struct<u:bigint,w:bigint,times:bigint,spelled:double>>"
_SCORES = f"doc_id bigint, row bigint, held_out boolean, n_tokens bigint, n_known bigint, base double, score double, near {_NEAR}, far {_FAR}"


def _lists(owner: np.ndarray, texts: int, columns: dict[str, np.ndarray]) -> pa.Array:
    """One list of structs for each text, from rows in the order of their texts."""
    items = pa.StructArray.from_arrays([pa.array(x) for x in columns.values()], names=list(columns))
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(texts + 1)).astype(np.int32)), items)


def _once(owner: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One index of each different row, in the order of their texts, and how often it occurs."""
    if not len(owner):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.lexsort((*columns, owner))
    same = np.ones(len(order) - 1, dtype=bool)
    for x in (owner, *columns):
        same &= x[order[1:]] == x[order[:-1]]
    first = np.flatnonzero(np.concatenate([[True], ~same]))
    return order[first], np.diff(np.append(first, len(order)))


def _scored(model: Model):
    """Scores of texts as far as frequent words and pairs go, and lists of the rest.

    ``near`` holds pairs of frequent words to be looked up; the score takes them as pairs of one customer in a training
    text, as unseen in another. ``far`` holds pairs with a rare word, with the log10 probability of spelling the second
    word; they are not in the score.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The end is a frequent word.
        base_log10, is_known, width = model.base_log10(model.counts), model.counts > 0, model.codes.width
        lone = model.own(1, 1, model.counts)
        for whole in batches:
            for batch in row_blocks(whole, "text"):
                found = words(batch.column("text"), SPACED)
                texts = batch.num_rows
                u, w, owner, is_word = model.codes.pairs(found)
                apart = batch.column("held_out").to_numpy(zero_copy_only=False)
                frequent = w >= 0
                base = np.bincount(owner[frequent], base_log10[w[frequent]], texts)
                known = np.bincount(owner[frequent], is_known[w[frequent]], texts)

                frequent &= u >= 0
                rare = np.flatnonzero(~frequent)
                at, times = _once(owner[rare], u[rare], w[rare])
                rare = rare[at]
                spelled = np.full(len(w), np.log10(END_SHARE))
                spelled[is_word] = math.log10(1 - END_SHARE) + model.spelling.of(found)
                far = _lists(owner[rare], texts, {"u": u[rare], "w": w[rare], "times": times, "spelled": spelled[rare]})

                both = np.flatnonzero(frequent)
                keys, of = u[both] * width + w[both], owner[both]
                score = np.zeros(texts)
                if len(model.pair_log10):
                    place, hit = model.pairs.of(mix(keys.view(np.uint64)))
                    score += np.bincount(of[hit], model.pair_log10[place[hit]], texts)
                    keys, of = keys[~hit], of[~hit]
                keys, times = np.unique(of * (width * width) + keys, return_counts=True)
                of, keys = np.divmod(keys, width * width)
                context, dish = np.divmod(keys, width)
                with np.errstate(divide="ignore"):
                    other = np.log10(np.where(apart[of], 0.0, lone[context]) + model.backed_off(context, dish))
                score += np.bincount(of, other * times, texts)
                columns = [
                    batch.column("doc_id").cast(pa.int64()),
                    batch.column("row"),
                    batch.column("held_out"),
                    pa.array((found.counts + 1).astype(np.int64)),
                    pa.array(known.astype(np.int64)),
                    pa.array(base),
                    pa.array(score),
                    _lists(of, texts, {"pair": keys, "times": times}),
                    far,
                ]
                names = ["doc_id", "row", "held_out", "n_tokens", "n_known", "base", "score", "near", "far"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows


def train(texts: DataFrame) -> tuple[Model, DataFrame, DataFrame]:
    """The model of the training texts of (text, held_out).

    Returns it, the pairs (u, w, c, mean) beyond its own that occur more than once or also in other texts, with their mean
    tables, and the words (k, n, back_i, parent_i).
    """
    learned = texts.filter(~F.col("held_out"))
    vocabulary = materialize(word_counts(learned))
    n_texts = learned.count()
    sizes = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("words")).first()
    least = max(1, count_reached_by(vocabulary, WARM_WORDS))
    frequent = vocabulary.filter(F.col("n") >= least).select("word").toArrow().column("word").to_pylist()
    codes = Codes(np.unique(_hashes(frequent)))
    spelling = learned_spelling(vocabulary)
    coded = materialize(coded_words(vocabulary, codes, spelling, n_texts))
    drop(vocabulary)
    shared = (F.col("c") > 1) | ((F.col("c") == 1) & (F.col("held") == 1))
    cells = materialize(pair_counts(texts, codes).filter(shared).select("u", "w", "c"))
    d = discount_of_cells(cells, coded)
    # Pairs of one customer are what the cells leave of the words' counts, as contexts and as dishes.
    more = _told(coded, _sent(cells.filter(F.col("c") > 1), F.col("c")))
    single = more.withColumns({"tables": F.col("n") - F.col("tables"), "customers": F.col("n") - F.col("customers")})
    pairs, of_words, shares = _seated(cells, coded, codes, d, single)
    drop(coded)

    n = len(shares)
    known = of_words.filter(F.col("k") >= 0).toArrow().to_pandas()
    counts, back, parent = np.zeros(codes.width, np.int64), np.ones((codes.width, n)), np.zeros((codes.width, n))
    counts[known["k"]] = known["n"]
    back[known["k"]] = known[[f"back_{i}" for i in range(n)]]
    parent[codes.edge] = np.array(shares) * END_SHARE
    parent[known["k"]] = known[[f"parent_{i}" for i in range(n)]]
    least = max(1, count_reached_by(cells.select(F.col("c").alias("n")), WARM_PAIRS))
    warm = pairs.filter((F.col("c") >= least) & (F.col("u") >= 0) & (F.col("w") >= 0)).toArrow()
    u, w = warm.column("u").to_numpy(), warm.column("w").to_numpy()
    keys = mix((u * codes.width + w).view(np.uint64))
    order = np.argsort(keys)
    model = Model(
        codes=codes,
        spelling=spelling,
        counts=counts,
        back=back,
        parent=parent,
        shares=np.array(shares),
        pairs=Places(keys[order]),
        pair_log10=np.zeros(0),
        discount=d,
        tokens=sizes["n"] + n_texts,
        distinct=sizes["words"] + (n_texts > 0),
    )
    own = model.own(warm.column("c").to_numpy(), warm.column("mean").to_numpy(), counts[u])
    model.pair_log10 = np.log10(own + model.backed_off(u, w))[order]
    cold = (F.col("c") < least) | (F.col("u") < 0) | (F.col("w") < 0)
    return model, pairs.filter(cold), of_words


def _gains(model: Model):
    """(pair, alone, unseen) of cells of frequent words: their log10 probability less that with one customer, and with none."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u, w, c, mean = (batch.column(x).to_numpy() for x in ("u", "w", "c", "mean"))
            unseen, n = model.backed_off(u, w), model.counts[u]
            log10 = np.log10(model.own(c, mean, n) + unseen)
            columns = [u * model.codes.width + w, log10 - np.log10(model.own(1, 1, n) + unseen), log10 - np.log10(unseen)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["pair", "alone", "unseen"])

    return rows


def _far_scores(model: Model):
    """(row, score, known, base) of pairs with a rare word, from their cells and what the table of words has of the rare ones.

    A pair that is no cell has one customer in a training text, none in another; an unknown word has its spelling.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = {name: batch.column(name).to_numpy(zero_copy_only=False) for name in batch.schema.names}
            u, w, n = x["u"], x["w"], len(model.shares)
            common, dish = u >= 0, w >= 0
            back = np.stack([x[f"back_{i}"] for i in range(n)], 1).astype(float)
            parent = np.stack([x[f"parent_{i}"] for i in range(n)], 1).astype(float)
            n_u, n_w = x["n_u"].astype(float), np.nan_to_num(x["n_w"].astype(float))
            back[common], n_u[common], parent[dish] = model.back[u[common]], model.counts[u[common]], model.parent[w[dish]]
            back = np.where(np.isnan(back), 1.0, back)
            apart, cell = x["held_out"].astype(bool), ~np.isnan(x["c"].astype(float))
            c, mean = np.where(cell, x["c"], 1.0), np.where(cell, x["mean"], 1.0)
            own = np.where(apart & ~cell, 0.0, model.own(c, mean, n_u))
            spelled = np.isnan(parent[:, 0])
            score = np.log10(np.where(spelled, 1.0, own + (back * parent).mean(1)))
            score[spelled] = np.log10((back[spelled] * model.shares).mean(1)) + x["spelled"][spelled]
            times = x["times"]
            columns = [x["row"], score * times, np.where(~dish & (n_w > 0), times, 0), np.where(dish, 0.0, model.base_log10(n_w) * times)]
            yield pa.RecordBatch.from_arrays([pa.array(y) for y in columns], names=["row", "score", "known", "base"])

    return rows


def with_rare_words(rows: DataFrame, key: str, of_words: DataFrame) -> DataFrame:
    """``rows`` with the columns of ``of_words`` (k, ...) where k = ``key`` is a rare word of it, else nulls."""
    rare = rows.filter(F.col(key) < 0).join(of_words.filter(F.col("k") < 0).withColumnRenamed("k", key), key, "left")
    return rare.unionByName(rows.filter(F.col(key) >= 0), allowMissingColumns=True)


def scores(docs: DataFrame) -> DataFrame:
    """Per document (doc_id, text): both scores in log10, learned from the texts that are not held out."""
    with freed_shuffles(docs.sparkSession):
        return _scores(docs)


def _scores(docs: DataFrame) -> DataFrame:
    split = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    model, cold_pairs, of_words = train(split)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = split.select("doc_id", "text", "held_out", F.monotonically_increasing_id().alias("row"))
    first = materialize(rows.mapInArrow(lambda batches: _scored(shared.value)(batches), _SCORES))

    # Pairs of frequent words: what a pair that is a cell has more than the score took it for.
    cells = cold_pairs.filter((F.col("u") >= 0) & (F.col("w") >= 0)).mapInArrow(lambda batches: _gains(shared.value)(batches), "pair bigint, alone double, unseen double")
    near = first.select("row", "held_out", F.inline("near")).join(cells, "pair")
    more = F.when(F.col("held_out"), F.col("unseen")).otherwise(F.col("alone"))
    near = materialize(near.groupBy("row").agg(F.sum(more * F.col("times")).alias("near_score")))

    # Pairs with a rare word.
    backs, parents = ([f"{x}_{i}" for i in range(len(model.shares))] for x in ("back", "parent"))
    cells = cold_pairs.filter((F.col("u") < 0) | (F.col("w") < 0))
    far = materialize(first.select("row", "held_out", F.inline("far")).join(cells, ["u", "w"], "left"))
    of_pairs = with_rare_words(far, "u", of_words.select("k", F.col("n").alias("n_u"), *backs))
    of_pairs = with_rare_words(of_pairs, "w", of_words.select("k", F.col("n").alias("n_w"), *parents))
    of_pairs = of_pairs.mapInArrow(lambda batches: _far_scores(shared.value)(batches), "row bigint, score double, known bigint, base double")
    of_rows = materialize(of_pairs.groupBy("row").agg(F.sum("score").alias("far_score"), F.sum("known").alias("far_known"), F.sum("base").alias("far_base")))
    drop(far)
    far = of_rows
    joined = first.drop("near", "far").join(near, "row", "left").join(far, "row", "left")
    return joined.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("far_known", F.lit(0))).cast("bigint").alias("n_known"),
        F.lit(model.tokens).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("far_base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("near_score", F.lit(0.0)) + F.coalesce("far_score", F.lit(0.0))).alias("score"),
    )


def perplexity(scored: DataFrame) -> DataFrame:
    """Perplexity per token of the held-out and the training texts, by both scores."""
    per = lambda c: F.pow(F.lit(10.0), -F.sum(c) / F.sum("n_tokens"))
    return scored.groupBy("held_out").agg(per("base_score").alias("base_perplexity"), per("score").alias("perplexity"))


@query("op8_lm_scoring", None)
def op8_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return scores(table(spark, folder, "documents"))
