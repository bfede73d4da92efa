"""Queries that fit models or stem: their rows against facts that must hold, or against the parts they are made of."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from murmura.functions.stemming import stem
from murmura.operators import features as M
from murmura.suite import CATALOG
from murmura.suite import features as S
from murmura.suite.base import bodies, manual_labels


def got(spark, data, name):
    return CATALOG[name][0](spark, data).collect()


def ids(spark, data, table, column):
    return Counter(r[0] for r in spark.read.parquet(f"{data}/{table}.parquet").select(column).collect())


def words_of(text):
    kept = "".join(c if c.isalnum() or c in "_ \t\n\r\f\v" else " " for c in text.lower())
    return kept.split()


def test_stems_stand_where_their_words_stood(spark, data):
    plain = defaultdict(dict)
    for r in bodies(spark, data).select("comment_id", "comment_body").collect():
        plain[r["comment_id"]] = dict(enumerate(r["comment_body"].lower().split()))
    rows = got(spark, data, "q1_index_analysis_stemmed")
    assert len(rows) > 1_000
    for r in random.Random(1).sample(rows, 1_000):
        assert r["token"] == stem(plain[r["doc_id"]][r["pos"]])


def test_topics(spark, data):
    rows = got(spark, data, "m2_topics")
    known = {w for r in bodies(spark, data).select("comment_body").collect() for w in words_of(r[0])}
    by_topic = defaultdict(list)
    for r in sorted(rows, key=lambda r: r["rank"]):
        by_topic[r["topic"]].append(r)
    assert sorted(by_topic) == list(range(5))
    for own in by_topic.values():
        assert len(own) == 20 and [r["weight"] for r in own] == sorted((r["weight"] for r in own), reverse=True) and {r["term"] for r in own} <= known
    keywords = {r["keyword"]: r["count"] for r in got(spark, data, "m3_topic_keywords")}
    counts = Counter(w for r in bodies(spark, data).select("comment_body").collect() for w in words_of(r[0]))
    assert set(keywords) == {r["term"] for r in rows} and all(counts[w] == n for w, n in keywords.items())


def test_learned_vectors(spark, data):
    want = Counter(f"c{i}" for i in ids(spark, data, "documents", "doc_id").elements())
    for name, column, width in (("m5_embed", "vector", 64), ("m10_reduce", "reduced", 50)):
        rows = got(spark, data, name)
        assert Counter(r["comment_id"] for r in rows) == want and all(len(r[column]) == width for r in rows)
        assert len({tuple(r[column]) for r in rows}) > len(rows) // 2


def test_assembled_vectors_hold_their_numbers(spark, data):
    scored = S._features(spark, data).select("comment_id", "comment_score", "polarity", "subjectivity", vector_to_array("features").alias("v")).collect()
    at = M.SET_WIDTH + M.TEXT_WIDTH
    for r in scored:
        assert len(r["v"]) == M.TEXT_WIDTH + 2 * M.SET_WIDTH + 3
        numbers = [x if x is not None else float("nan") for x in (r["subjectivity"], r["polarity"], r["comment_score"])]
        assert r["v"][at : at + 3] == pytest.approx(numbers, nan_ok=True)
    rows = {r["comment_id"]: r["features"] for r in got(spark, data, "m9_assemble")}
    assert len(rows) == len(scored)
    for r in scored[:50]:
        filled = [int(x.split(":")[0]) for x in rows[r["comment_id"]].split()]
        assert filled == [k for k, v in enumerate(r["v"]) if v != 0]


def test_clusters(spark, data):
    rows = got(spark, data, "m11_cluster")
    vectors = {r["vec_id"]: r["embedding"] for r in spark.read.parquet(f"{data}/embeddings.parquet").collect()}
    assert Counter(r["vec_id"] for r in rows) == Counter(vectors.keys())
    groups = defaultdict(list)
    for r in rows:
        groups[r["cluster"]].append(vectors[r["vec_id"]])
    centre = {k: [sum(x) / len(v) for x in zip(*v, strict=True)] for k, v in groups.items()}
    assert len(groups) == 3
    # nearly every vector lies nearest to the mean of its own cluster
    near = sum(min(centre, key=lambda k: sum((a - b) ** 2 for a, b in zip(centre[k], vectors[r["vec_id"]], strict=True))) == r["cluster"] for r in rows)  # noqa: B023
    assert near > 0.9 * len(rows)
    pooled = got(spark, data, "m16_embedding_clusters")
    assert Counter(r["doc_id"] for r in pooled) == Counter({i // 4 for i in vectors}) and len({r["cluster"] for r in pooled}) <= 6


@pytest.mark.parametrize("name", ["m11_cluster_metrics", "m13_balanced_regression", "n4_train_sentiment"])
def test_metrics_of_models(spark, data, name):
    rows = got(spark, data, name)
    assert len(rows) == 1 and all(0 <= v <= 1 for v in rows[0].asDict().values() if isinstance(v, float)) and any(isinstance(v, float) for v in rows[0].asDict().values())


def test_predicted_sentiment_learns_and_reaches_the_answers(spark, data):
    named = {r["comment_id"]: r["sentiment"] for r in got(spark, data, "n3_predict_sentiment")}
    assert Counter(named.keys()) == Counter(f"c{i}" for i in ids(spark, data, "documents", "doc_id")) and set(named.values()) <= {"negative", "positive"}
    labels = {r["comment_id"]: r["label"] for r in manual_labels(spark, data).collect()}
    train, _ = S._halves(spark.createDataFrame([(c,) for c in labels], "comment_id string"))
    fit = [(labels[r[0]], named[r[0]]) for r in train.collect()]
    assert sum((label < 0) == (s == "negative") for label, s in fit) > 0.9 * len(fit)
    answers = {r["query_id"]: r for r in got(spark, data, "q15_answers_model")}
    pages = defaultdict(list)
    for r in sorted(got(spark, data, "q11_search_topk"), key=lambda r: r["rank"]):
        pages[r["query_id"]].append(named[r["doc_id"]])
    for query, own in answers.items():
        assert own["sentiments"] == ",".join(pages[query])
        assert own["sentiment"] == ("negative" if 2 * pages[query].count("negative") > len(pages[query]) else "positive")


def test_trained_pieces(spark, data):
    rules = sorted(got(spark, data, "t3_merge_rules"))
    words = {r["word"]: r["pieces"].split(" ") for r in got(spark, data, "t3_train_bpe")}
    assert all("".join(p) == w for w, p in words.items())
    characters = {c for w in words for c in w}
    assert len(characters) + len(rules) == 2_000
    made = characters | {r["left"] + r["right"] for r in rules}
    assert {p for own in words.values() for p in own} <= made and sum(map(len, words.values())) < 0.6 * sum(map(len, words))
    known = sorted(characters) + list(dict.fromkeys(r["left"] + r["right"] for r in rules))
    token = {str(k): t for k, t in enumerate(known)}
    docs = spark.read.parquet(f"{data}/documents.parquet")
    cleaned = {r[0]: r[1] for r in docs.select("doc_id", S.tx.clean_line(F.col("text"))).collect()}
    for r in got(spark, data, "t4_encode_bpe"):
        back = "".join(token.get(x, "") for x in r["ids"].split(" "))
        assert back == cleaned[r["doc_id"]].replace(" ", "")


def test_topics_read_their_texts_once(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    texts = spark.createDataFrame([(f"fruit apple pear {'plum' if i % 2 else 'fig'} w{i % 7}",) for i in range(200)], "text string").mapInArrow(counted, "text string")
    got = {r["keyword"]: r["count"] for r in M.topic_keywords(texts, "text", k=2).collect()}
    # Words of every text stand in more than 95 % of them.
    assert got == {"plum": 100, "fig": 100} | {f"w{i}": len(range(i, 200, 7)) for i in range(7)}
    assert read.value == 200
