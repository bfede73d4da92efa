"""Topics by online variational Bayes, the vocabulary and the topics being tables.

The published algorithm with the settings of Spark's ``LDA(optimizer="online")``: mini-batches of a twentieth of the texts,
drawn with replacement, offset 1024 and decay 0.51 of the learning rate, symmetric priors of one over the topics, that of
the texts being fitted. A word outside a mini-batch only decays, so a word's parameters are ``A (init + U) + B``: two numbers
of the whole table, a start drawn from the word's hash, and the sum ``U`` of what its batches gave. Only words that some
batch held have a row of ``U``. The driver holds a few numbers a topic.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmura.operators.chunks import apply_chunks, coded, text_counts
from murmura.session import drop, materialize

# Executors need not have the package installed: the functions travel with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FRACTION, OFFSET, DECAY = 0.05, 1024, 0.51
# Shape of the gamma distribution that starts are drawn from, its mean being one.
SHAPE = 100
# Mean change of a text's parameters at which it has settled.
SETTLED = 1e-3


def digamma(x: np.ndarray) -> np.ndarray:
    """By recurrence up to 6 and the asymptotic series beyond."""
    x, below = np.array(x, np.float64), 0.0
    for _ in range(6):
        small = x < 6
        below = below - np.where(small, 1 / x, 0.0)
        x = np.where(small, x + 1, x)
    s = 1 / (x * x)
    return below + np.log(x) - 0.5 / x - s * (1 / 12 - s * (1 / 120 - s * (1 / 252 - s * (1 / 240 - s / 132))))


def trigamma(x: np.ndarray) -> np.ndarray:
    x, below = np.array(x, np.float64), 0.0
    for _ in range(6):
        small = x < 6
        below = below + np.where(small, 1 / (x * x), 0.0)
        x = np.where(small, x + 1, x)
    s = 1 / (x * x)
    return below + 1 / x + s / 2 + s / x * (1 / 6 - s * (1 / 30 - s * (1 / 42 - s / 30)))


def _uniform(*of: Column) -> Column:
    return (F.pmod(F.xxhash64(*of), F.lit(1 << 52)) + 0.5) / float(1 << 52)


def start(token: Column, topic: int, seed: int) -> Column:
    """A gamma value of mean one from the word's hash: a normal one, cubed (Wilson and Hilferty)."""
    radius = F.sqrt(-2 * F.log(_uniform(token, F.lit(seed), F.lit(2 * topic))))
    normal = radius * F.cos(2 * math.pi * _uniform(token, F.lit(seed), F.lit(2 * topic + 1)))
    return F.pow(1 - 1 / (9 * SHAPE) + normal / (3 * SHAPE**0.5), 3)


def _times(row: Column, seed: int, batch: int) -> Column:
    """How often a batch holds a row: a Poisson number from the row's hash."""
    drawn, out, at, chance = _uniform(row, F.lit(seed), F.lit(batch)), F.lit(0), 0.0, math.exp(-FRACTION)
    for k in range(8):
        at += chance
        out = out + (drawn >= at).cast("int")
        chance *= FRACTION / (k + 1)
    return out


def settle(text: np.ndarray, words: np.ndarray, counts: np.ndarray, texts: int, alpha: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(gamma, share)``: the topic parameters of each text, and each entry's count by topic over its word's weight.

    An entry is a text, the exponents of its word's expected log weights by topic, and its count; entries stand text by text.
    """
    gamma = np.ones((texts, len(alpha)))
    active = np.arange(texts)
    own = np.arange(len(text))
    theta = lambda g: np.exp(digamma(g) - digamma(g.sum(axis=1))[:, None])
    while len(active):
        place = np.zeros(texts, np.int64)
        place[active] = np.arange(len(active))
        at, t = place[text[own]], theta(gamma[active])
        weighted = words[own] * (counts[own] / (np.einsum("ek,ek->e", words[own], t[at]) + 1e-100))[:, None]
        starts = np.flatnonzero(np.diff(at, prepend=-1))
        sums = np.add.reduceat(weighted, starts, axis=0)
        new = t * sums + alpha
        moving = np.abs(new - gamma[active]).mean(axis=1) > SETTLED
        gamma[active] = new
        active = active[moving]
        still = np.zeros(texts, bool)
        still[active] = True
        own = own[still[text[own]]]
    t = theta(gamma)
    return gamma, t[text] * (counts / (np.einsum("ek,ek->e", words, t[text]) + 1e-100))[:, None]


def vocabulary(tokens: DataFrame, min_df: float, max_df: float) -> tuple[DataFrame, int]:
    """``(token)`` in at least ``min_df`` and at most ``max_df`` texts, below 1 a share of them; and the number of texts."""
    n = tokens.count()
    low, high = (x if x >= 1 else x * n for x in (min_df, max_df))
    texts, words = coded(tokens.select("tokens"), ["tokens"])
    counts = words.groupBy("token").agg(F.sum("docs").alias("df"))
    kept = materialize(counts.filter(F.col("df").between(low, high)).select("token"))
    drop(texts)
    return kept, n


def fit(tokens: DataFrame, k: int, terms: int, min_df: float, max_df: float, seed: int, iterations: int) -> DataFrame:
    """``(topic, term, weight)``: the ``terms`` heaviest words of each topic of the stored ``tokens (tokens)``."""
    kept, n = vocabulary(tokens, min_df, max_df)
    numbered = materialize(tokens.select("tokens", F.monotonically_increasing_id().alias("_row")))
    starts = F.array(*[start(F.col("token"), j, seed) for j in range(k)])
    sizes = kept.agg(F.count("*"), *[F.sum(start(F.col("token"), j, seed)) for j in range(k)]).first()
    words, begun = sizes[0], np.array([x or 0.0 for x in sizes[1:]])
    eta = 1 / k
    alpha, decay, gained, added = np.full(k, 1 / k), 1.0, 0.0, np.zeros(k)
    none = F.array_repeat(F.lit(0.0), k)
    updates = None
    for step in range(1, iterations + 1):
        batch = numbered.select("tokens", _times(F.col("_row"), seed, step).alias("_times")).filter("_times > 0")
        texts, held = coded(batch, ["tokens"])
        met = held.join(kept, "token")
        met = met.withColumn("_u", none) if updates is None else met.join(updates.withColumnRenamed("u", "_u"), "token", "left")
        value = F.zip_with(starts, F.coalesce("_u", none), lambda a, b: (a + b) * decay + gained)
        known = materialize(met.select("_chunk", "_code", "token", value.alias("value")))
        totals = decay * (begun + added) + words * gained
        found = materialize(apply_chunks(texts, known, _gather(totals, alpha), "token string, stat array<double>"))
        drop(texts, known)
        summed = found.filter("token IS NULL").agg(*[F.sum(F.col("stat")[j]) for j in range(2 * k + 1)]).first()
        if summed[0]:
            rate = (OFFSET + step) ** -DECAY
            decay, gained = decay * (1 - rate), gained * (1 - rate) + rate * eta
            share = rate * n / math.ceil(FRACTION * n) / decay
            added = added + share * np.array(summed[1 + k :])
            new = found.filter("token IS NOT NULL").select("token", F.transform("stat", lambda x: x * share).alias("u"))
            former, both = updates, new if updates is None else updates.unionByName(new)
            sums = both.groupBy("token").agg(*[F.sum(F.col("u")[j]).alias(f"u{j}") for j in range(k)])
            updates = materialize(sums.select("token", F.array(*[f"u{j}" for j in range(k)]).alias("u")))
            if former is not None:
                drop(former)
            alpha = _moved(alpha, np.array(summed[1 : 1 + k]) / summed[0], summed[0], rate)
        drop(found)
    drop(numbered)
    weighed = kept.withColumn("u", none) if updates is None else kept.join(updates, "token", "left")
    value = F.zip_with(starts, F.coalesce("u", none), lambda a, b: (a + b) * decay + gained)
    totals = decay * (begun + added) + words * gained
    return materialize(weighed.select("token", value.alias("value")).mapInArrow(_heaviest(totals, terms), "topic int, term string, weight double"))


def _moved(alpha: np.ndarray, logs: np.ndarray, n: float, rate: float) -> np.ndarray:
    """A Newton step of the prior of the texts by the mean of their expected logs; kept where it would not be positive."""
    slope = n * (logs - digamma(alpha) + digamma(alpha.sum()))
    c, q = n * trigamma(alpha.sum()), -n * trigamma(alpha)
    b = (slope / q).sum() / (1 / c + (1 / q).sum())
    moved = alpha - rate * (slope - b) / q
    return moved if (moved > 0).all() else alpha


def _gather(totals: np.ndarray, alpha: np.ndarray):
    """Chunk body: what the texts of a batch give to each word; and in a row without a word how many texts had words, the
    sum of their expected logs, and the sum of what they give."""
    k = len(alpha)

    def gather(texts: pa.Table, known: pa.Table) -> pa.Table:
        lists = texts["tokens"].combine_chunks()
        codes = known["_code"].to_numpy()
        text, term, counts = text_counts(lists, int(codes.max(initial=-1)) + 1 if not len(lists) else max(int(codes.max(initial=-1)), int(lists.flatten().drop_null().to_numpy().max(initial=-1))) + 1)
        place = np.full(int(max(codes.max(initial=-1), term.max(initial=-1))) + 1, -1)
        place[codes] = np.arange(len(codes))
        of = place[term]
        text, of, counts = text[of >= 0], of[of >= 0], counts[of >= 0]
        rows, text = np.unique(text, return_inverse=True)
        times = texts["_times"].to_numpy()[rows]
        value = known["value"].combine_chunks().flatten().to_numpy().reshape(-1, k)
        weight = np.exp(digamma(value) - digamma(totals))
        stat, logs = np.zeros((len(codes), k)), np.zeros(k)
        if len(rows):
            gamma, share = settle(text, weight[of], counts, len(rows), alpha)
            np.add.at(stat, of, share * times[text][:, None])
            stat *= weight
            logs = (times[:, None] * (digamma(gamma) - digamma(gamma.sum(axis=1))[:, None])).sum(axis=0)
        whole = [float(times.sum()), *logs, *stat.sum(axis=0)]
        return pa.table({"token": pa.array([None, *known["token"].to_pylist()], pa.string()), "stat": pa.array([whole, *stat.tolist()], pa.list_(pa.float64()))})

    return gather


def _heaviest(totals: np.ndarray, terms: int):
    """Task body: the heaviest words of each topic among those of the task, equal ones by the word."""

    def heaviest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple[float, str]]] = [[] for _ in totals]
        for batch in batches:
            weights = batch.column("value").flatten().to_numpy().reshape(-1, len(totals)) / totals
            for topic, own in enumerate(best):
                w = weights[:, topic]
                least = np.partition(w, -terms)[-terms] if len(w) > terms else -np.inf
                at = np.flatnonzero(w >= least)
                own += zip(-w[at], batch.column("token").take(pa.array(at)).to_pylist(), strict=True)
                own[:] = sorted(own)[:terms]
        rows = [(topic, term, -w) for topic, own in enumerate(best) for w, term in own]
        topics, names, found = zip(*rows) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(topics, pa.int32()), pa.array(names, pa.string()), pa.array(found, pa.float64())], names=["topic", "term", "weight"])

    return heaviest
