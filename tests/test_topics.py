"""Topics whose vocabulary and matrix are tables: the driver holds a few numbers a topic."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from murmura.operators import chunks
from murmura.operators import features as M
from murmura.operators import topics as K


@pytest.fixture(scope="module")
def texts(spark):
    rng = random.Random(1)
    themes = [[f"{t}{i}" for i in range(12)] for t in "ab"]
    rows = [(" ".join(["each", f"once{i}", *rng.choices(themes[i % 2], k=12)]),) for i in range(600)]
    return spark.createDataFrame([*rows, ("",), ("the",)], "text string")


def test_topics_beyond_the_drivers_words_are_weighed_over_all_words(spark, texts, monkeypatch):
    monkeypatch.setattr(M, "WORDS_ON_DRIVER", 0)
    fitted = []
    for most in (chunks.CHUNK_TOKENS, 40):
        monkeypatch.setattr(K, "coded", lambda df, columns, most=most: chunks.coded(df, columns, most))
        got = M.topics(texts.coalesce(1), "text", k=2, terms=30, iterations=20).collect()
        fitted.append({(r["topic"], r["term"]): r["weight"] for r in got})
        for topic in (0, 1):
            own = sorted((r for r in got if r["topic"] == topic), key=lambda r: r["rank"])
            assert {r["term"] for r in own} == {f"{t}{i}" for t in "ab" for i in range(12)}
            assert sum(r["weight"] for r in own) == pytest.approx(1)
            assert [r["weight"] for r in own] == sorted((r["weight"] for r in own), reverse=True)
    # However texts are dealt to chunks.
    assert fitted[0] == pytest.approx(fitted[1], rel=1e-6)
    # Words of a theme go together.
    share = lambda t: sum(w for (topic, term), w in fitted[0].items() if topic == 0 and term[0] == t)
    assert abs(share("a") - share("b")) > 0.3


def test_keywords_of_topics_beyond_the_drivers_words(texts, monkeypatch):
    monkeypatch.setattr(M, "WORDS_ON_DRIVER", 0)
    got = M.topic_keywords(texts, "text", k=2, terms=30).collect()
    assert len(got) == 24 and sum(r["count"] for r in got) == 600 * 12


def test_special_functions():
    x = np.array([0.01, 0.2, 1.0, 2.5, 40.0])
    assert K.digamma(np.array([1.0, 0.5])) == pytest.approx([-0.5772156649015329, -1.9635100260214235], rel=1e-9)
    assert K.trigamma(np.array([1.0, 0.5])) == pytest.approx([math.pi**2 / 6, math.pi**2 / 2], rel=1e-9)
    assert K.digamma(x) == pytest.approx((np.vectorize(math.lgamma)(x * (1 + 1e-5)) - np.vectorize(math.lgamma)(x * (1 - 1e-5))) / (2e-5 * x), rel=1e-4)


def test_texts_settle_together_as_one_by_one():
    rng = np.random.default_rng(3)
    sizes, alpha = [1, 5, 9, 3], np.array([0.3, 0.5, 0.2])
    text = np.repeat(np.arange(4), sizes)
    words, counts = rng.gamma(0.5, size=(18, 3)) / 100, rng.integers(1, 6, 18)
    gamma, share = K.settle(text, words, counts, 4, alpha)
    for d in range(4):
        w, c, g = words[text == d], counts[text == d], np.ones(3)
        theta = lambda g: np.exp(K.digamma(g) - K.digamma(g.sum()))
        moved = 1.0
        while moved > K.SETTLED:
            new = theta(g) * (w.T @ (c / (w @ theta(g)))) + alpha
            moved, g = np.abs(new - g).mean(), new
        assert gamma[d] == pytest.approx(g)
        assert share[text == d] == pytest.approx(np.outer(c / (w @ theta(g)), theta(g)))


def test_starts_have_mean_one_and_a_batch_its_share(spark):
    df = spark.range(20_000).withColumn("token", F.concat(F.lit("w"), "id"))
    mean, spread, times = df.agg(F.avg(K.start(F.col("token"), 1, 42)), F.stddev(K.start(F.col("token"), 1, 42)), F.avg(K._times(F.col("id"), 42, 3))).first()
    assert mean == pytest.approx(1, abs=0.005) and spread == pytest.approx(0.1, abs=0.005) and times == pytest.approx(0.05, abs=0.005)
