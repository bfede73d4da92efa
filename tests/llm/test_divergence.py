"""Source divergence against brute force in whole numbers."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from test_llm_operators import DOCS, FOLD

from murmura.llm import bytescan, divergence
from murmura.llm.base import settle

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute_audit(rows, min_documents=3, top=200):
    counts, holders = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        found = TERM.findall((text or "").translate(FOLD))
        counts[lang or "", source or ""].update(found)
        holders[lang or ""].update(set(found))
    out = set()
    for lang in {g[0] for g in counts}:
        kept = [t for t, n in holders[lang].items() if n >= min_documents]
        sources = [s for own, s in counts if own == lang]
        shares = {}
        for name, c in [(s, counts[lang, s]) for s in sources] + [(None, sum((counts[lang, s] for s in sources), Counter()))]:
            n = sum(c[t] for t in kept)
            shares[name] = {t: 1 + 10**9 * (c[t] + 1) // (n + len(kept)) for t in kept}
        for s in sources:
            f = lambda t, other: (shares[s][t] - shares[other][t]) ** 2 // shares[other][t]  # noqa: E731, B023
            pairs = [(-sum(f(t, o) for t in kept), o.encode(), o) for o in sources if o != s]
            terms = [(-f(t, None), t.encode(), t) for t in kept if counts[lang, s][t] and shares[s][t] > shares[None][t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out |= {(lang, s, part, item, -value, k + 1) for k, (value, _, item) in enumerate(found)}
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdeé漢") for _ in range(rng.choice([1, 2, 3, 7, 8, 9, 15, 16, 17, 31, 33, 70]))) for _ in range(120)]
    rows = []
    for k in range(150):
        text = " ".join(w.upper() if rng.random() < 0.2 else w for w in rng.choices(words, weights=[1 / (i + 1) for i in range(120)], k=rng.randint(0, 60)))
        rows.append((text.replace(" ", rng.choice([" ", "1", "_", "\n", "'"])), rng.choice(["en", "en", "en", "fr", None]), rng.choice(["hot", "hot", "b", "c", "é", None])))
    rows += [(None, "en", "silent"), ("", "de", "x"), ("only once", "de", "y"), ("", "it", "lone"), ("x" * 300_000 + " " + "Ab " * 40_000, "en", "long")]
    return rows + rows[:10]


def frame(spark, rows, parts=3):
    settle(spark)
    whole = [(k, t, lang, source, 0, "s", "r", "k", "w") for k, (t, lang, source) in enumerate(rows)]
    return spark.createDataFrame(whole, DOCS).withColumnRenamed("size", "term").withColumnRenamed("rate", "total").repartition(parts)


@pytest.mark.parametrize("parts", [1, 5])
def test_audit(spark, rows, parts, monkeypatch):
    monkeypatch.setattr(divergence, "_ROWS", 50)
    monkeypatch.setattr(divergence, "_PAIRS", 20)
    got = {tuple(r) for r in divergence.audit(frame(spark, rows, parts)).collect()}
    assert got == brute_audit(rows)


def test_ranks_are_cut_after_ties(spark):
    rows = [(" ".join(f"w{chr(97 + k)}" for k in range(20)), "en", "a")] * 3 + [("other words here", "en", "b")] * 3
    got = {tuple(r) for r in divergence.audit(frame(spark, rows), top=7).collect()}
    assert got == brute_audit(rows, top=7)


def test_nothing(spark):
    assert divergence.audit(frame(spark, [])).count() == 0
    assert {tuple(r) for r in divergence.audit(frame(spark, [("", "en", "a"), (None, "en", "b")])).collect()} == {("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)}


def test_radix_order_and_packing():
    rng = np.random.default_rng(0)
    a, b = rng.integers(0, 4, 1_000, dtype=np.uint64) << np.uint64(50), rng.integers(0, 2**64 - 1, 1_000, dtype=np.uint64)
    assert (divergence.radix_order(a, b) == np.lexsort((b, a))).all()
    body = np.frombuffer(b"abcdefghij" + bytes(16), np.uint8)
    got = divergence.packed(body, np.array([0, 2, 9]), np.array([8, 3, 1]))
    assert [int(x).to_bytes(8, "big") for x in got] == [b"abcdefgh", b"cde\0\0\0\0\0", b"j" + bytes(7)]
    assert bytescan.LETTERS[ord("z")] and bytescan.LETTERS[0x80] and not bytescan.LETTERS[ord("0")]
