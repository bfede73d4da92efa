"""Whitening and near-dedup of embeddings against brute force."""

import math
import random

import numpy as np
import pytest
from test_llm_operators import roots_of

from murmura.llm import collisions, whitening
from murmura.llm.base import settle
from murmura.llm.queries import CATALOG

VECTORS = "vec_id bigint, embedding array<float>, label int, rank string, block int"


def vectors(spark, rows):
    """Vectors with extra columns whose names operators use themselves."""
    settle(spark)
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0, "r", 1) for i, v in rows], VECTORS)


def odd_rows(d):
    return [(900, None), (901, [None] * d), (902, [1.0] * (d - 1) + [float("nan")]), (903, [float("inf")] + [0.0] * (d - 1)), (None, None)]


# --- whitening ---------------------------------------------------------------------


@pytest.mark.parametrize("shape", ["spread", "equal", "low rank", "clustered"])
def test_leading_components_are_those_of_a_full_solver(spark, shape):
    rng = np.random.default_rng(3)
    turn = np.linalg.qr(rng.standard_normal((40, 40)))[0]
    spectrum = {"spread": np.geomspace(1e-6, 1e3, 40), "equal": np.full(40, 2.0), "low rank": np.r_[np.zeros(31), np.arange(1, 10.0)], "clustered": np.r_[np.ones(30), 5 + 1e-9 * np.arange(10)]}[shape]
    v = turn @ np.diag(spectrum) @ turn.T
    v = (v + v.T) / 2
    want = np.sort(spectrum)[::-1][:16]
    for shift in (0.5, 1.7, 4.0, 900.0):
        assert whitening.inertia_above(v, shift) == (spectrum > shift).sum()
    values, axes = whitening.leading_components(spark, v, 16)
    assert len(values) == (9 if shape == "low rank" else 16) and np.allclose(values, want[: len(values)], rtol=1e-6 if shape == "spread" else 1e-10)
    assert np.abs(axes.T @ axes - np.eye(len(values))).max() < 1e-12
    assert np.linalg.norm(v @ axes - axes * values) < 1e-9 * max(want)


def brute_whitened(rows):
    x = np.array([[math.floor(64 * np.float32(c).astype(float)) + 1_000_000 for c in v] for _, v in rows], object)
    fit = np.array(sorted(set(map(tuple, x.tolist()))), object)
    n, s = len(fit), fit.sum(0)
    centred = ((n * fit - s) / n).astype(float)
    e, w = np.linalg.eigh(centred.T @ centred / n)
    keep = min(16, int((e > 1e-10 * e[-1]).sum()))
    e, w = e[::-1][:keep], w[:, ::-1][:, :keep]
    return n, ((n * x - s) ** 2).sum(1), ((n * x - s) / n).astype(float) @ w / np.sqrt(e), e / np.trace(centred.T @ centred / n)


def test_whitening_against_a_full_solver(spark):
    rng = np.random.default_rng(8)
    rows = [(k, (rng.standard_normal(20) * np.geomspace(0.3, 3, 20)).astype(np.float32).tolist()) for k in range(200)]
    rows += [(300 + k, rows[5][1]) for k in range(50)] + [(None, rows[6][1]), (7, rows[7][1])]
    got = whitening.whitened(vectors(spark, rows + odd_rows(20) + [(950, [1.0, 2.0])])).collect()
    n, deviation, white, explained = brute_whitened(rows)
    assert len(got) == 16 * len(rows) and {r["n"] for r in got} == {n} and len({r["identity_error"] for r in got}) == 1
    assert got[0]["identity_error"] < 1e-10
    found = {}
    for r in got:
        found.setdefault((r["vec_id"], r["component"]), []).append(r)
    sign = [None] * 17
    for (i, _), d, own in zip(rows, deviation, white, strict=True):
        for k in range(1, 17):
            r = found[i, k][0]
            sign[k] = sign[k] or math.copysign(1, r["whitened"] * own[k - 1])
            assert r["deviation"] == d and math.isclose(r["whitened"], sign[k] * own[k - 1], abs_tol=1e-8)
            assert math.isclose(r["explained"], explained[k - 1], rel_tol=1e-9)


def test_whitening_of_little(spark):
    assert whitening.whitened(vectors(spark, [])).count() == 0
    assert whitening.whitened(vectors(spark, odd_rows(4))).count() == 0
    assert whitening.whitened(vectors(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    two = whitening.whitened(vectors(spark, [(1, [0.0, 1.0]), (2, [1.0, 1.0])])).collect()
    assert [r["component"] for r in two] == [1, 1] and {round(abs(r["whitened"]), 9) for r in two} == {1.0} and two[0]["explained"] == 1.0
    wide = whitening.whitened(vectors(spark, [(1, [1e12, 0.0]), (2, [-1e12, 3.0])])).collect()
    assert all(r["deviation"] is None or r["deviation"] < 2**63 for r in wide) and wide


def test_whitening_of_the_table(spark, data):
    table = spark.read.parquet(f"{data}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    got = CATALOG["op11_embedding_whitening"][0](spark, data).toPandas()
    n, deviation, white, explained = brute_whitened(rows)
    found = got.pivot(index="vec_id", columns="component", values="whitened").loc[[i for i, _ in rows]].to_numpy()
    assert np.abs(found * np.sign((found * white).sum(0)) - white).max() < 1e-8
    assert dict(zip(got["vec_id"], got["deviation"], strict=True)) == {i: d for (i, _), d in zip(rows, deviation, strict=True)}
    assert np.allclose(got[got["vec_id"] == rows[0][0]].sort_values("component")["explained"], explained) and (got["n"] == n).all()


# --- near-dedup --------------------------------------------------------------------


def brute_links(rows, cosine=0.9):
    width = max((len(v) for _, v in rows if v), default=0)
    sound = [v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, v in rows]
    u = np.array([[*(np.float32(v).astype(float) if ok else []), *[0.0] * (width - (len(v) if ok else 0))] for (_, v), ok in zip(rows, sound, strict=True)])
    u = u / np.maximum(np.abs(u).max(1, keepdims=True), 1e-300)
    u = u / np.maximum(np.sqrt((u * u).sum(1, keepdims=True)), 1e-300)
    near = (u @ u.T >= cosine) & ~np.eye(len(rows), dtype=bool)
    roots = roots_of(len(rows), list(zip(*np.nonzero(near), strict=True)))
    least = {}
    for (i, _), root in zip(rows, roots, strict=True):
        if i is not None:
            least[root] = min(least.get(root, i), i)
    return [(i, int(k), least.get(root), i == least.get(root)) for (i, _), k, root in zip(rows, near.sum(1), roots, strict=True)]


@pytest.mark.parametrize("d", [1, 3, 24, 96])
def test_links_of_all_pairs(spark, d):
    rng, pick = np.random.default_rng(d), random.Random(d)
    base = [rng.standard_normal(d) for _ in range(60)]
    rows = [(k, v) for k, v in enumerate(base)]
    for k in range(200):
        v = pick.choice(base[:20]) if k % 2 else base[0]
        rows.append((1_000 - k, (v + rng.standard_normal(d) * rng.choice([0.05, 0.3, 0.48, 0.6])) * rng.choice([1e-20, 1.0, 1e20])))
    rows = [(i, np.float32(v).tolist()) for i, v in rows]
    rows += [(2_000 + k, rows[3][1]) for k in range(30)] + [rows[4], (None, rows[5][1]), (3_000, [0.0] * d)] + (odd_rows(d) if d > 1 else [])
    if d > 3:
        rows += [(4_000, rows[0][1][:3]), (4_001, [*rows[0][1][:3], 0.0])]
    got = [(r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in collisions.near_vectors(vectors(spark, rows)).collect()]
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(got, key=key) == sorted(brute_links(rows), key=key)


def test_blocks_apart_never_meet_and_nothing_is_lost(spark, monkeypatch):
    monkeypatch.setattr(collisions, "BLOCK", 7)
    monkeypatch.setattr(collisions, "_TILE_ROWS", 4)
    monkeypatch.setattr(collisions, "_TILE_COLUMNS", 5)
    monkeypatch.setattr(collisions, "_DENSE", 3)
    rng = np.random.default_rng(1)
    centres = np.eye(16)[:6] * np.array([1, -1, 1, -1, 1, -1])[:, None]
    rows = [(k, np.float32(centres[k % 6] + 0.08 * rng.standard_normal(16)).tolist()) for k in range(150)]
    got = [(r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in collisions.near_vectors(vectors(spark, rows)).collect()]
    assert sorted(got) == sorted(brute_links(rows))
    ends = spark.createDataFrame([(0, -0.9, -0.5), (1, -0.5, 0.1), (2, 0.1, 0.8), (3, 0.9, 1.0)], "block bigint, low double, high double")
    assert [tuple(r) for r in collisions._spans(ends, 0.3).orderBy("block").collect()] == [(0, 0, 1), (1, 0, 2), (2, 1, 3), (3, 2, 3)]


def test_no_vectors(spark):
    assert collisions.near_vectors(vectors(spark, [])).count() == 0
    got = collisions.near_vectors(vectors(spark, odd_rows(3))).collect()
    assert all((r["n_links"], r["component_id"], r["kept"]) == (0, r["vec_id"], True) for r in got) and len(got) == 5


def test_links_of_the_table(spark, data):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{data}/embeddings.parquet").collect()]
    got = [(r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in CATALOG["op12_embedding_near_dedup"][0](spark, data).collect()]
    assert sorted(got) == sorted(brute_links(rows))
