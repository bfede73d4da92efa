"""Registered queries against their SQL, and those without against brute force, on the smallest tables."""

import html
import importlib.util
import re
from collections import Counter
from pathlib import Path

import pytest

import corpus_pipeline
from murmura.llm.queries import CATALOG
from murmura.session import materialize
from test_llm_operators import FOLD, SPACED, brute_contained, brute_fingerprint, roots_of

_spec = importlib.util.spec_from_file_location("verify_llm", Path(__file__).resolve().parents[2] / "tools" / "verify.py")
verify = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(verify)
verify.CATALOG = CATALOG


@pytest.fixture(scope="module")
def duck(data):
    return verify.duck(data)


@pytest.mark.parametrize("name", [name for name, (_, sql) in CATALOG.items() if sql is not None])
def test_query(spark, duck, data, name):
    ok, note = verify.compare(spark, duck, data, name)
    assert ok, note


def test_main_text_of_all_pages(spark, data):
    for row in spark.read.parquet(f"{data}/pages.parquet").join(CATALOG["op10_html_main_text"][0](spark, data).drop("url"), "page_id").collect():
        article = re.search(r"<article>(.*?)(?:</article>|\Z)", row["html"], re.DOTALL)
        body = re.sub(r"<[^>]*\Z", "", article[1]) if article else ""
        blocks = [" ".join(html.unescape(re.sub(r"</?b>", "", x).replace("<br>", " ")).split()) for x in re.split(r"</?(?:h1|p)>", body)]
        assert row["text"] == "\n".join(filter(None, blocks)) and row["n_chars"] == len(row["text"])


def test_url_verdicts(spark, data):
    rows = CATALOG["op5_url_filters"][0](spark, data).collect()
    assert len(rows) == spark.read.parquet(f"{data}/pages.parquet").count()
    for r in rows:
        unwanted = re.search(r"casino-win|ads-track|free-bets|spam-farm|cheap-pills|adult-x", r["host"])
        if r["rule"] is None:
            assert (r["verdict"] == "block") == bool(unwanted)


def test_scores_cover_all(spark, data):
    rows = CATALOG["op8_lm_scoring"][0](spark, data).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(r["doc_id"] for r in spark.read.parquet(f"{data}/documents.parquet").collect())
    assert all(r["score"] < 0 and r["n_known"] <= r["n_tokens"] for r in rows)


def test_components_cover_all(spark, data):
    rows = CATALOG["op7_simhash_near_dedup"][0](spark, data).collect()
    ids = {r["doc_id"] for r in rows}
    least = {}
    for r in rows:
        least[r["component_id"]] = min(least.get(r["component_id"], r["doc_id"]), r["doc_id"])
    assert all(c in ids and c == first for c, first in least.items())
    prints = [int(r["fingerprint"], 16) for r in rows]
    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= 2:
                assert rows[i]["component_id"] == rows[j]["component_id"]


def test_pipeline_against_brute_force(spark, data):
    """Every stage on what the one before kept, held against plain Python."""
    docs = spark.read.parquet(f"{data}/documents.parquet")
    columns = docs.columns
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "near dedup", "decontamination", "mix sources"]
    stages = dict(corpus_pipeline.STAGES)

    def after(name, df):
        out = materialize(stages[name](spark, df, data))
        assert out.columns == columns
        return out, {r["doc_id"]: r for r in out.collect()}

    whole = {r["doc_id"]: r for r in docs.collect()}
    good, kept = after("quality rules", docs)
    verdict = {r["doc_id"]: r["kept"] for r in CATALOG["op3_quality_rules"][0](spark, data).collect()}
    assert kept == {i: r for i, r in whole.items() if verdict[i]}

    lined, rewritten = after("line dedup", good)
    key = lambda x: x.strip(" \t\n\x0b\f\r").translate(FOLD)
    holders = Counter(k for r in kept.values() for k in {key(x) for x in r["text"].split("\n")} if k)
    want = {i: "\n".join(x for x in r["text"].split("\n") if holders[key(x)] < 10) for i, r in kept.items()}
    assert {i: r["text"] for i, r in rewritten.items()} == want

    apart, single = after("near dedup", lined)
    ids = sorted(want)
    prints = [brute_fingerprint(want[i]) for i in ids]
    roots = roots_of(len(ids), [(m, n) for m in range(len(ids)) for n in range(m) if (prints[m] ^ prints[n]).bit_count() <= 2])
    assert set(single) == {ids[k] for k, root in enumerate(roots) if k == root}

    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()]
    clean, left = after("decontamination", apart)
    found = {doc for doc, _ in brute_contained([(i, r["text"]) for i, r in single.items()], items)}
    assert found and set(left) == set(single) - found

    mixed = Counter(r["doc_id"] for r in stages["mix sources"](spark, clean, data).collect())
    sizes = Counter()
    for r in left.values():
        sizes[r["source"]] += len(SPACED.findall(r["text"]))
    weights = {s: 1 + k % 3 for k, s in enumerate(sorted(sizes))}
    total, full = sum(sizes.values()), set()
    while True:
        level = (total - 3 * sum(sizes[s] for s in full)) / sum(w for s, w in weights.items() if s not in full)
        more = {s for s in sizes if s not in full and level * weights[s] >= 3 * sizes[s]}
        if not more:
            break
        full |= more
    for i, r in left.items():
        rate = 3 if r["source"] in full else level * weights[r["source"]] / sizes[r["source"]]
        assert int(rate) <= mixed[i] <= -(-rate // 1)
    assert set(mixed) <= set(left)


def test_pipeline_runs_whole_and_on_nothing(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    out = corpus_pipeline.run(spark, data)
    assert out.columns == docs.columns and out.count() > 0
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        result = stage(spark, empty, data)
        assert result.columns == docs.columns and result.count() == 0
