"""Small fixtures for decisions that the given tables do not exercise."""

import difflib
import json
import random
import uuid
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from murmura import schemas, session
from murmura.operators import chunks
from murmura.operators import corpus as C
from murmura.operators import features as M
from murmura.operators import labels as L
from murmura.operators import sampling as P
from murmura.operators import search as S
from murmura.operators import sentiment as N
from murmura.operators import tokenizers as T
from murmura.operators import vectors as V
from murmura.operators import lemmas as B
from murmura.operators import terms as K
from murmura.operators.analysis import Analyzer, analyze_index
from murmura.operators.scale import consecutive_ids, frequent_values, join_frequent_apart, running, top_n_per_group
from murmura.plans import answer as A
from murmura.sources import files, runs

PLAIN = Analyzer(stopwords=(), synonyms=(), stem=False)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


# --- sentiment ---------------------------------------------------------------------


@pytest.fixture
def valences(spark):
    return spark.createDataFrame([("good", 1.9), ("bad", -2.5), ("great", 3.1)], "word string, valence double")


TEXTS = [(1, "not good"), (2, "GOOD thing but very bad!!"), (3, "nothing"), (4, ""), (5, None), (6, "isn't great??")]


def test_published_compound_value(spark, valences):
    df = spark.createDataFrame(TEXTS, "id int, t string")
    scored = {r["id"]: r["compound"] for r in N.lexicon_compound(df, "t", valences, "id").collect()}
    assert scored[1] == pytest.approx(-0.3412, abs=1e-4)
    assert scored[3] == scored[4] == scored[5] == 0.0
    assert all(-1 <= v <= 1 for v in scored.values())


def test_inline_and_joined_lexicons_agree(spark, valences):
    df = spark.createDataFrame(TEXTS, "id int, t string")
    inline = N.lexicon_compound(df, "t", valences, "id").select("id", F.round("compound", 9))
    joined = N.lexicon_compound(df, "t", valences, "id", inline_limit=0).select("id", F.round("compound", 9))
    assert rows(inline) == rows(joined)


def test_overall_sentiment_tie_is_positive(spark):
    df = spark.createDataFrame([("a", "negative"), ("a", "positive"), ("b", "negative")], "q string, sentiment string")
    assert rows(N.majority_sentiment(df, "q")) == [("a", "positive"), ("b", "negative")]


# --- search ------------------------------------------------------------------------


@pytest.fixture
def docs(spark):
    return spark.createDataFrame(
        [
            ("d1", "webull", "2024-01-01 00:00:00", 5, "very bad app"),
            ("d2", "ibkr", "2024-02-01 00:00:00", 40, "good worthless thing good"),
            ("d3", "ibkr", "2024-03-01 00:00:00", 9, "great appaapp"),
            ("d4", "webull", "2024-03-01 00:00:00", 1, "neutral app words"),
        ],
        "id string, subreddit string, datetime string, score int, comment_content string",
    ).withColumn("datetime", F.to_timestamp("datetime"))


def ask(spark, *queries):
    return spark.createDataFrame(
        [(f"q{i}", *q) for i, q in enumerate(queries)], "query_id string, query string, subreddits array<string>, start_date string"
    )


def hits(index, requests, **options):
    return rows(S.search(index, requests, analyzer=PLAIN, **options).select("query_id", "doc_id"))


def test_substring_match_filters_and_dates(spark, docs):
    index = S.build_index(docs, analyzer=PLAIN)
    asked = ask(spark, ("worth", [], None), ("app", ["webull"], None), ("app", None, "2024-02-15"), ("app", [], "soon"), ("  ", [], None), ("x" * 16, [], None))
    assert hits(index, asked) == [("q0", "d2"), ("q1", "d1"), ("q2", "d3"), ("q3", "d1"), ("q3", "d3")]


def test_stored_index_gives_the_same_hits(spark, docs, tmp_path):
    index = S.build_index(docs, analyzer=PLAIN)
    stored = index.write(str(tmp_path / "index"))
    asked = ask(spark, ("app good", [], None), ("thing", [], None))
    assert hits(index, asked) == hits(stored, asked) == hits(S.SearchIndex.read(spark, str(tmp_path / "index")), asked)


def test_many_terms_without_hits(spark, docs):
    index = S.build_index(docs, analyzer=PLAIN)
    asked = ask(spark, *[(f"zz{i}", [], None) for i in range(105)], ("app", [], None))
    assert {d for _, d in hits(index, asked)} == {"d1", "d3"}


def test_overlapping_occurrences_count(spark):
    tokens = spark.createDataFrame([("d", 0, "aaa")], "doc_id string, pos int, token string")
    found = {r["gram"]: r["tf"] for r in S.build_postings(tokens).collect()}
    assert found == {"aa": 2, "aaa": 1}


def test_phrase_needs_consecutive_positions(spark, docs):
    tokens = analyze_index(docs, "comment_content", "id", PLAIN)
    phrases = spark.createDataFrame([("yes", 0, "bad"), ("yes", 1, "app"), ("no", 0, "very"), ("no", 1, "app")], "query_id string, i int, term string")
    assert rows(S.match_phrase(tokens, phrases)) == [("yes", "d1")]


def test_range_is_inclusive_and_open(spark, docs):
    assert rows(docs.filter(S.match_range(F.col("score"), low=9)).select("id")) == [("d2",), ("d3",)]
    assert rows(docs.filter(S.match_range(F.col("score"), 5, 9)).select("id")) == [("d1",), ("d3",)]


def test_today_means_no_date_filter(spark):
    df = spark.sql("SELECT TIMESTAMP '2001-01-01 00:00:00' AS t, date_format(current_date(), 'yyyy-MM-dd') AS today")
    assert df.filter(S.since(F.col("t"), F.col("today"))).count() == 1


def test_answer_covers_requests_without_hits(spark, docs):
    lexicon = spark.createDataFrame([("bad", -0.7, 0.6), ("good", 0.7, 0.6)], "word string, polarity double, subjectivity double")
    index = S.build_index(docs, analyzer=PLAIN)
    out = {r["query_id"]: r for r in A.answer(index, docs, ask(spark, ("app", [], None), ("nope", [], None), (" ", [], None)), lexicon, analyzer=PLAIN).collect()}
    assert set(out) == {"q0", "q1"}
    assert out["q0"]["record_count"] == 2 and out["q1"]["record_count"] == 0 and out["q1"]["comments"] == []
    assert out["q0"]["sentiment"] == "positive"


# --- labels and metrics --------------------------------------------------------------


def test_fusion(spark):
    a = spark.createDataFrame([("x", 3), ("y", 2)], "keyword string, count bigint")
    b = spark.createDataFrame([("y", 4), ("z", 1)], "keyword string, count bigint")
    assert rows(L.fuse_keywords(a, b)) == [("x", 3), ("y", 10), ("z", 1)]


def test_class_never_predicted(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (0, 1)], "pred int, label int")
    weighted = L.weighted_metrics(df, "pred", "label").first()
    assert weighted["precision"] == pytest.approx((1 / 3 * 1 + 1.0 * 2) / 3)
    assert L.binary_metrics(df, "pred", "label").first()["precision"] == 0.0


def test_majority_tie_takes_smallest(spark):
    df = spark.createDataFrame([("k", x) for x in (1, 2, 2, 1)], "key string, label int")
    assert rows(L.majority_label(df, "key", "label")) == [("k", 1)]


def test_early_stop_ties_do_not_count(spark):
    series = [0.5, 0.6, 0.6, 0.5, 0.6, 0.4, 0.3]
    df = spark.createDataFrame([("r", i, v) for i, v in enumerate(series)], "run string, epoch int, value double")
    assert rows(L.early_stop_epoch(df, patience=3)) == [("r", 6)]
    assert rows(L.early_stop_epoch(df, patience=4)) == []


@pytest.mark.parametrize("greater", [True, False])
@pytest.mark.parametrize("delta", [0.0, 0.15])
def test_early_stop_equals_a_plain_scan(spark, greater, delta):
    random.seed(5)
    series = [(run, epoch, round(random.random(), 1)) for run in range(6) for epoch in range(40)]
    expected = []
    for run in range(6):
        best, count = (0.0, 0) if greater else (float("inf"), 0)
        for _, epoch, value in (s for s in series if s[0] == run):
            if (value > best) if greater else (value < best):
                best, count = value, 0
            elif (value < best + delta) if greater else (value > best + delta):
                count += 1
                if count >= 4:
                    expected.append((run, epoch))
                    break
    df = spark.createDataFrame(series, "run int, epoch int, value double")
    assert rows(L.early_stop_epoch(df, patience=4, greater_is_better=greater, min_delta=delta)) == expected


def test_running_matches_a_plain_scan_across_stretches(spark):
    random.seed(1)
    values = [random.randint(-5, 9) for _ in range(200)]
    df = spark.createDataFrame([("k", i, v) for i, v in enumerate(values)], "key string, i int, v int")
    got = {r["i"]: (r["s"], r["m"]) for r in running(df, ["key"], "i", {"s": ("sum", F.col("v")), "m": ("max", F.col("v"))}, width=7).collect()}
    assert got == {i: (sum(values[: i + 1]), max(values[: i + 1])) for i in range(200)}


# --- samples and ids -----------------------------------------------------------------


def test_large_sample_equals_top_n(spark, monkeypatch):
    df = spark.range(5000)
    small = rows(P.sample_n(df, 700, "id"))
    monkeypatch.setattr(P, "_TAKE_LIMIT", 10)
    assert rows(P.sample_n(df, 700, "id")) == small and len(small) == 700
    assert P.sample_n(df, 9000, "id").count() == 5000


def test_splits_ignore_partitioning(spark):
    df = spark.range(1000)
    assert rows(P.train_val_test(df, "id")) == rows(P.train_val_test(df.repartition(7), "id"))


def test_salted_top_n_keeps_a_hot_group_whole(spark):
    df = spark.range(6000).select((F.col("id") % 3 == 0).cast("int").alias("g"), "id")
    got = top_n_per_group(df, ["g"], [F.col("id")], 1500)
    assert got.groupBy("g").count().filter("count = 1500").count() == 2
    assert got.filter("g = 1").agg(F.max("id")).first()[0] == 1499 * 3


def test_consecutive_ids(spark):
    df = spark.range(3000).select((F.col("id") * 7 % 101).alias("lead"), "id").repartition(5)
    got = [r["n"] for r in consecutive_ids(df, "lead", ["id"], "n", start=3, parts=9).orderBy("lead", "id").collect()]
    assert got == list(range(3, 3003))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_with_frequent_keys_apart(spark, how):
    key = F.when(F.col("id") % 2 == 0, "the").when(F.col("id") % 11 == 0, F.lit(None)).otherwise(F.concat(F.lit("w"), F.col("id") % 401))
    left = spark.range(6000).select(key.alias("k"), "id").repartition(7)
    right = spark.createDataFrame([("the", 1), ("w1", 2), ("w1", 3), ("w400", 4), ("absent", 5)], "k string, v int")
    plain = rows(left.join(right, "k", how).fillna({"k": "?", "v": -1}))
    assert rows(join_frequent_apart(left, right, "k", how).fillna({"k": "?", "v": -1})) == plain
    given = spark.createDataFrame([("w1",), ("w1",), ("unseen",)], "k string")
    assert rows(join_frequent_apart(left, right, "k", how, given).fillna({"k": "?", "v": -1})) == plain
    assert "the" in [r[0] for r in frequent_values(left, "k", 5).collect()]
    empty = left.limit(0)
    assert join_frequent_apart(empty, right, "k", how).count() == 0


def test_frequent_rows_are_not_shuffled(spark):
    left = spark.range(4000).select(F.when(F.col("id") % 2 == 0, "the").otherwise(F.concat(F.lit("w"), "id")).alias("k"))
    joined = join_frequent_apart(left, spark.createDataFrame([("the", 1), ("w1", 2)], "k string, v int").hint("merge"), "k", "left")
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert plan.startswith("Union") and "strategy=broadcast" in plan
    assert joined.filter("v = 1").count() == 2000


def test_label_index_of_many_categories(spark):
    df = spark.createDataFrame([("b", 5), ("a", 2), ("b", 1), (None, 0), ("c", 2)], "c string, at int")
    assert rows(L.label_index(df, "c", "at")) == [("a", 2, 1), ("b", 1, 0), ("b", 5, 0), ("c", 2, 2)]
    assert L.label_index(df.limit(0), "c", "at").count() == 0


# --- word tables -----------------------------------------------------------------------


def test_lemmas_are_checked_against_the_table(spark):
    table = spark.createDataFrame([(None, w) for w in ("size", "cache", "box", "lady", "class", "wolf", "man")] + [("feet", "foot"), ("feet", "hoof"), ("men", "me")], "form string, lemma string")
    df = spark.createDataFrame([(1, "sizes caches boxes ladies class wolves men feet was s".split(), "x"), (2, [], "y"), (3, None, "z"), (1, ["boxes", None, "boxes"], "x")], "id int, t array<string>, _lemma string")
    got = rows(B.lemmatize(df.filter("id = 1"), "t", table).select("t"))
    assert got == [(["box", None, "box"],), ("size cache box lady class wolf me foot was s".split(),)]
    assert {r["id"]: r["t"] for r in B.lemmatize(df, "t", table).filter("id > 1").collect()} == {2: [], 3: None}
    assert rows(B.lemmatize(df.filter("id = 1"), "t", table.limit(0)).select("id")) == [(1,), (1,)]
    assert rows(B.lemma_map(spark.createDataFrame([("mans",), ("boxes",)], "word string"), table.select("lemma"))) == [("boxes", "box"), ("mans", "man")]


def test_terms_of_a_table(spark):
    terms = spark.createDataFrame([("Ab", "x"), ("b c", "y"), ("ab", "x"), ("ab", "z"), ("", "all"), (None, "all"), ("q", None), ("É", "e")], "term string, group string")
    df = spark.createDataFrame([(1, "xAB c"), (2, None), (3, ""), (4, "é"), (5, "q")], "id int, t string")
    expected = [(1, ["x", "y", "z"]), (2, []), (3, []), (4, ["e"]), (5, [])]
    assert rows(K.tag_terms(df, "t", terms).select("id", "groups")) == expected
    assert rows(K.tag_terms(df, "t", terms, block=2).select("id", "groups")) == expected
    assert rows(K.tag_terms(df, "t", terms.limit(0)).select("id", "groups")) == [(i, []) for i in range(1, 6)]
    assert rows(K.holding_terms(df, "t", terms).select("id")) == [(1,), (4,), (5,)]


def test_many_terms_in_one_pass(spark):
    terms = spark.range(100_000).select(F.concat(F.lit("t"), F.col("id") * 7919 % 1_000_003, F.lit(".")).alias("term"), (F.col("id") % 5).alias("group"))
    texts = [(k, " ".join(f"t{(k * 31 + j) * 7919 % 1_000_003}." for j in range(0, k % 4 * 3, 3)) + " t5") for k in range(200)]
    listed = {r["term"]: str(r["group"]) for r in terms.collect()}
    held = [(k, sorted({listed[w] for w in t.split() if w in listed})) for k, t in texts]
    assert rows(K.tag_terms(spark.createDataFrame(texts, "id int, t string"), "t", terms).select("id", "groups")) == held


# --- vectors -------------------------------------------------------------------------


def test_topk_in_blocks_equals_one_block(spark):
    random.seed(2)
    vectors = spark.createDataFrame([(i, [random.random() for _ in range(4)]) for i in range(300)], "id int, vector array<double>")
    queries = vectors.filter("id < 30").select(F.col("id").alias("query_id"), "vector")
    assert rows(V.cosine_topk(queries, vectors, 5)) == rows(V.cosine_topk(queries, vectors, 5, block=7))


WORDS = ["broker", "brokers", "trading", "tradings", "platform", "platforms", "fee", "app", "account", "accounts", "interactive", "international"]
ODD = ["brokker", "tradnig", "platfrom", "acount", "interactivve", "internatoinal", "xyz", "brokerz"]


@pytest.mark.parametrize("similarity", ["levenshtein", "ratio"])
def test_closest_word_equals_brute_force(spark, similarity):
    def edits(a, b):
        line = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            prev, line[0] = line[0], i
            for j, y in enumerate(b, 1):
                prev, line[j] = line[j], min(line[j] + 1, line[j - 1] + 1, prev + (x != y))
        return line[-1]

    def score(a, b):
        return 1 - edits(a, b) / max(len(a), len(b)) if similarity == "levenshtein" else difflib.SequenceMatcher(None, b, a).ratio()

    expected = []
    for word in ODD:
        near = [(-score(word, w), w) for w in WORDS if abs(len(w) - len(word)) <= 1 and score(word, w) >= 0.8]
        if near:
            expected.append((word, min(near)[1]))
    oov = spark.createDataFrame([(w,) for w in ODD], "token string")
    vocab = spark.createDataFrame([(w,) for w in WORDS], "token string")
    assert rows(V.closest_word(oov, vocab, similarity=similarity).select("token", "match")) == sorted(expected)


def test_unknown_vectors_without_known_neighbours_are_zero(spark):
    df = spark.createDataFrame([("d", 0, None), ("e", 0, [1.0, 2.0]), ("e", 1, None)], "doc_id string, pos int, vector array<double>")
    got = {(r["doc_id"], r["pos"]): r["vector"] for r in V.oov_average_context(df, 2).collect()}
    assert got[("d", 0)] == [0.0, 0.0] and got[("e", 1)] == [1.0, 2.0]


def test_unknown_words_of_every_kind(spark):
    tokens = spark.createDataFrame([("d", 0, "broker"), ("d", 1, "brokker"), ("d", 2, "zzz"), ("e", 0, "zzz")], "doc_id string, pos int, token string")
    vectors = spark.createDataFrame([("broker", [2.0, 4.0]), ("fee", [1.0, 1.0])], "token string, vector array<float>")

    def of(oov):
        return {(r["doc_id"], r["pos"]): r["vector"] for r in V.embed_tokens(tokens, vectors, 2, oov).collect()}

    fixed = of("unk")[("e", 0)]
    assert all(0 <= x < 1 for x in fixed) and of("unk")[("d", 1)] == fixed
    assert of("average") == {("d", 0): [2.0, 4.0], ("d", 1): [2.0, 4.0], ("d", 2): [2.0, 4.0], ("e", 0): [0.0, 0.0]}
    assert of("context") == of("average")
    assert of("closest") == {("d", 0): [2.0, 4.0], ("d", 1): [2.0, 4.0], ("d", 2): fixed, ("e", 0): fixed}


# --- tokenizers ----------------------------------------------------------------------


def test_pair_merges_follow_a_plain_run(spark):
    text = "low low low lower lower newest newest newest newest widest aaa aaa"
    words: dict[str, int] = {}
    for w in text.split():
        words[w] = words.get(w, 0) + 1
    spelled = {w: list(w) for w in words}
    expected = []
    for _ in range(12):
        pairs: dict[tuple[str, str], int] = {}
        for w, p in spelled.items():
            for pair in zip(p, p[1:]):
                pairs[pair] = pairs.get(pair, 0) + words[w]
        if not pairs:
            break
        best = min(pairs, key=lambda x: (-pairs[x], x))
        expected.append((*best, pairs[best]))
        for w, p in spelled.items():
            out, i = [], 0
            while i < len(p):
                if tuple(p[i : i + 2]) == best:
                    out.append(p[i] + p[i + 1])
                    i += 2
                else:
                    out.append(p[i])
                    i += 1
            spelled[w] = out
    rules, pieces = T.train_bpe(spark.createDataFrame([(text,)], "t string"), "t", 12)
    assert [(r["left"], r["right"], r["n"]) for r in rules.orderBy("step").collect()] == expected
    assert {r["word"]: r["pieces"] for r in pieces.collect()} == spelled


def brute_bpe(words, merges):
    """One pair at a time, the most frequent one, the smaller of equals."""
    parts, rules = {w: list(w) for w in words}, []
    for _ in range(merges):
        counts = Counter()
        for w, p in parts.items():
            for pair in zip(p, p[1:], strict=False):
                counts[pair] += words[w]
        if not counts:
            break
        (a, b), n = min(counts.items(), key=lambda x: (-x[1], x[0]))
        rules.append((a, b, n))
        for w, p in parts.items():
            out, k = [], 0
            while k < len(p):
                both = p[k : k + 2] == [a, b]
                out.append(a + b if both else p[k])
                k += 1 + both
            parts[w] = out
    return rules, parts


@pytest.mark.parametrize("seed", [1])
def test_merges_of_a_pass_are_those_of_one_at_a_time(spark, seed):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefgh", weights=[8, 7, 6, 5, 4, 3, 2, 1], k=rng.randint(1, 9))) for _ in range(120)] + ["aaaaa", "abab", "bbb"]
    lines = [" ".join(rng.choices(words, weights=[1 / (k + 1) for k in range(len(words))], k=40)) for _ in range(12)]
    counts = Counter(w for line in lines for w in line.split())
    rules, parts = brute_bpe(counts, 60)
    df = spark.createDataFrame([(x,) for x in lines], "t string")
    got, found = T.train_bpe(df, "t", 60)
    assert [(r["left"], r["right"], r["n"]) for r in got.orderBy("step").collect()] == rules
    assert {r["word"]: r["pieces"] for r in found.collect()} == parts
    loose, pieces = T.train_bpe(df, "t", vocabulary=60, spread=0.5)
    made = loose.orderBy("step").collect()
    assert len(made) == 60 - 8
    replay = {w: list(w) for w in counts}
    for r in made:
        replay = {w: T._merged(p, {(r["left"], r["right"]): r["left"] + r["right"]}) for w, p in replay.items()}
    assert {r["word"]: r["pieces"] for r in pieces.collect()} == replay
    vocab = {r["token"]: r["id"] for r in T.piece_ids(loose, pieces).collect()}
    assert sorted(vocab.values()) == list(range(len(vocab))) and vocab["a"] == 0 and vocab[T.PAD] == vocab[T.UNK] + 1 == len(vocab) - 1
    asked = spark.createDataFrame([(1, "abab zebra abab aaaaa"), (2, ""), (3, None)], "id int, t string")
    ids = {r["doc_id"]: r["ids"] for r in T.encode_bpe_ids(asked, "t", "id", pieces, vocab=T.piece_ids(loose, pieces)).collect()}
    want = [x for w in ("abab", "zebra", "abab", "aaaaa") for x in ([vocab[p] for p in replay[w]] if w in replay else [vocab[T.UNK]])]
    assert ids[1] == want and ids[2] == [vocab[T.UNK]]


def test_unseen_words_are_one_unknown_piece(spark):
    _, pieces = T.train_bpe(spark.createDataFrame([("low lower",)], "t string"), "t", 2)
    encoded = T.encode_bpe(spark.createDataFrame([(1, "low zebra")], "id int, t string"), "t", "id", pieces).first()
    assert encoded["pieces"][-1] == T.UNK


def test_tokenizer_registry(spark):
    assert set(T.TOKENIZERS) == {"bpe", "word2vec", "nltk"}


# --- files and runs --------------------------------------------------------------------


def test_csv_round_trip_and_empty_sink(spark, tmp_path):
    body = 'line one\nline "two", three'
    df = spark.createDataFrame([("s", body, 1)], "subreddit string, comment_body string, comment_score int")
    full = files.enforce_schema(df, schemas.COMMENTS)[0]
    assert files.write_comments_csv(full, str(tmp_path / "c"))
    assert files.read_comments_csv(spark, str(tmp_path / "c")).first()["comment_body"] == body
    assert not files.write_comments_csv(full.limit(0), str(tmp_path / "none"))
    assert not (tmp_path / "none").exists()


def test_upsert_keeps_highest_version(spark):
    a = spark.createDataFrame([("k", 1, "old"), ("j", 5, "keep")], "id string, version int, body string")
    b = spark.createDataFrame([("k", 2, "new"), ("j", 4, "stale")], "id string, version int, body string")
    assert rows(files.upsert(a, b, "id", "version")) == [("j", 5, "keep"), ("k", 2, "new")]


def test_labelled_lines_take_the_file_stem(spark, tmp_path):
    (tmp_path / "good news.txt").write_text("  Café One \nTwo\n")
    (tmp_path / "bad.txt").write_text("Three\n")
    assert rows(files.read_labelled_lines(spark, f"{tmp_path}/*.txt")) == [("cafeone", "good news"), ("three", "bad"), ("two", "good news")]


def _run(folder, name, metrics=True):
    run = folder / name
    run.mkdir()
    (run / "config.json").write_text(json.dumps({"model": {"type": "m", "args": {"layers": 1}}, "epochs": 3}, indent=1))
    if metrics:
        series = {"accuracy": [0.1, 0.5, 0.4], "f1": [], "precision": [], "recall": []}
        document = {"train_loss": [3.0, 2.0], "val_loss": [], "test_loss": [], "train_metrics": series, "val_metrics": series, "test_metrics": series}
        (run / "metrics.json").write_text(json.dumps({**document, "steps": [1, 2], "val_steps": [], "grad_norms": None, "grad_steps": None}, indent=1))


def test_runs_need_both_files(spark, tmp_path):
    _run(tmp_path, "a b=1")
    _run(tmp_path, "half", metrics=False)
    found = runs.read_runs(spark, str(tmp_path))
    assert [r["run"] for r in found.select("run").collect()] == ["a b=1"]
    assert "config.model.args.layers" in found.columns
    final = {r["metric"]: r for r in L.final_metrics(runs.metric_series(found)).collect()}
    assert final["train_loss"]["final"] == 2.0
    assert (final["val_metrics.accuracy"]["final"], final["val_metrics.accuracy"]["best"], final["val_metrics.accuracy"]["best_step"]) == (0.4, 0.5, 1)


def test_stream_lands_each_document_once(spark, tmp_path, valences):
    from murmura.operators.segments import SegmentStore
    from murmura.streaming.ingest import stream_documents

    columns = {f.name: None for f in schemas.COMMENTS}
    row = {**columns, "comment_id": "c1", "post_id": "p1", "title": "t", "subreddit": "s", "created": 1700000000.0, "comment_score": 1}
    bodies = ["my broker review : this is good and great", "my broker review : this is a plain sentence"]
    data = [{**row, "comment_id": f"c{i}", "comment_body": b} for i, b in enumerate(bodies)]
    files.write_comments_csv(spark.createDataFrame(data, schemas.COMMENTS), str(tmp_path / "in"))
    name = f"test-{uuid.uuid4().hex}"
    store = SegmentStore(spark, str(tmp_path / "out"), analyzer=PLAIN)
    stream_documents(spark, str(tmp_path / "in"), valences, store, name).awaitTermination()
    assert rows(store.documents().select("id")) == [("c0",)]
    again = [{**data[0], "comment_body": "my broker review : this is great and good"}, {**data[0], "comment_id": "c2"}]
    spark.createDataFrame(again, schemas.COMMENTS).write.mode("append").options(header="true", quote='"', escape='"').csv(str(tmp_path / "in"))
    stream_documents(spark, str(tmp_path / "in"), valences, store, name).awaitTermination()
    assert rows(store.documents().select("id", "comment_content")) == [("c0", again[0]["comment_body"]), ("c2", bodies[0])]
    assert store.segments() == [0, 1] and store.add(store.documents(), f"{name}-1") is None


def test_segments_search_like_one_index(spark, docs, tmp_path):
    from murmura.operators.segments import SegmentStore

    older = docs.withColumn("datetime", F.expr("datetime - interval 1 day"))
    first = older.withColumn("comment_content", F.concat(F.lit("app "), "comment_content"))
    stale = docs.filter("id = 'd4'").withColumns({"datetime": F.to_timestamp(F.lit("2020-01-01")), "comment_content": F.lit("stale app app")})
    store = SegmentStore(spark, str(tmp_path / "store"), analyzer=PLAIN)
    store.add(first, "a")
    store.add(docs.filter("id in ('d1', 'd2')").unionByName(stale), "b")
    state = first.filter("id in ('d3', 'd4')").unionByName(docs.filter("id in ('d1', 'd2')"))
    whole = S.build_index(state, analyzer=PLAIN)
    asked = ask(spark, ("app", [], None), ("good thing", [], None), ("stale", [], None), ("very", ["webull"], None))
    found = lambda index: rows(S.search(index, asked, analyzer=PLAIN, opinion_only=False).select("query_id", "doc_id", "rank", F.round("relevance", 9)))
    phrases = spark.createDataFrame([("p", 0, "app"), ("p", 1, "grea")], "query_id string, i int, term string")
    assert found(store.index()) == found(whole) and len(found(whole)) > 4
    assert rows(S.match_phrase(store.index(), phrases)) == rows(S.match_phrase(whole, phrases)) == [("p", "d3")]
    kept = sum(1 for _ in (tmp_path / "store/postings/segment=0").glob("*.parquet"))
    assert store.merge() == 2 and store.segments() == [2] and store.merge() is None
    assert found(store.index()) == found(whole) and store.documents().count() == 4
    assert kept == sum(1 for _ in (tmp_path / "store/postings/segment=0").glob("*.parquet"))
    store.add(docs.filter("id = 'd3'"), "c")
    after = S.build_index(state.filter("id <> 'd3'").unionByName(docs.filter("id = 'd3'")), analyzer=PLAIN)
    assert found(store.index()) == found(after)


def test_clauses(spark, docs):
    from murmura.operators.requests import CLAUSES, answer_clauses

    titled = docs.withColumn("title", F.concat(F.lit("about "), "subreddit"))
    indexes = {"comment_content": S.build_index(titled, analyzer=PLAIN), "title": S.build_index(titled, "title", analyzer=PLAIN)}
    attributes = titled.select(F.col("id").alias("doc_id"), "subreddit", "score", "datetime")
    clauses = [
        ("phrase and exact", 0, True, "phrase", "comment_content", "bad app", None, None),
        ("phrase and exact", 1, True, "exact", "subreddit", "webull", None, None),
        ("wrong case", 0, True, "words", "comment_content", "app", None, None),
        ("wrong case", 1, True, "exact", "subreddit", "WEBULL", None, None),
        ("range", 0, True, "range", "score", None, "9", None),
        ("all", 0, True, "all", None, None, None, None),
        ("either", 0, False, "phrase", "comment_content", "worthless thing", None, None),
        ("either", 1, False, "phrase", "comment_content", "app words", None, None),
        ("either", 1, False, "phrase", "comment_content", "app words", None, None),
        ("mixed", 0, True, "words", "comment_content", "great", None, None),
        ("mixed", 0, True, "range", "score", None, None, "1"),
        ("mixed", 1, True, "words", "title", "about", None, None),
        ("mixed", 2, False, "words", "comment_content", "neutral", None, None),
        ("dates", 0, True, "range", "datetime", None, "2024-02-01 00:00:00", "2024-03-01 00:00:00"),
        ("dates", 1, True, "words", "comment_content", "app", None, None),
        ("gap", 0, True, "phrase", "comment_content", "very app", None, None),
        ("unreadable", 0, True, "range", "score", None, "x", None),
        ("unknown", 0, True, "exact", "nowhere", "x", None, None),
    ]
    found = answer_clauses(indexes, attributes, spark.createDataFrame(clauses, CLAUSES), PLAIN)
    got = {}
    for r in found.collect():
        got.setdefault(r["query_id"], {})[r["doc_id"]] = r["relevance"]
    assert {q: sorted(d) for q, d in got.items()} == {
        "phrase and exact": ["d1"], "range": ["d2", "d3"], "all": ["d1", "d2", "d3", "d4"], "either": ["d2", "d4"], "mixed": ["d3", "d4"], "dates": ["d3", "d4"],
    }
    assert got["all"]["d1"] == 0 and got["phrase and exact"]["d1"] > 0 and got["mixed"]["d3"] != got["mixed"]["d4"]
    assert answer_clauses(indexes, attributes, spark.createDataFrame([], CLAUSES), PLAIN).count() == 0


def test_phrases_check_positions_of_whole_candidates(spark):
    texts = [("a", "xx alpha beta y alpha beta"), ("b", "beta alpha"), ("c", "alpha xx beta"), ("d", "alphabeta beta"), ("e", None)]
    index = S.build_index(spark.createDataFrame(texts, "id string, comment_content string"), analyzer=PLAIN, attributes=())
    phrases = [("p", 0, "alpha"), ("p", 1, "beta"), ("one", 0, "beta"), ("or", 0, "xx"), ("or", 0, "beta"), ("or", 1, "beta"), ("or", 1, "alpha"), ("none", 0, "alpha"), ("none", 1, "zz")]
    got = S.phrase_hits(index, spark.createDataFrame(phrases, "query_id string, i int, term string"))
    want = [("one", "a", 2), ("one", "b", 1), ("one", "c", 1), ("one", "d", 2), ("or", "a", 1), ("or", "b", 1), ("or", "c", 1), ("or", "d", 1), ("p", "a", 2), ("p", "d", 1)]
    assert rows(got.select("query_id", "doc_id", "tf")) == want


def test_filters_come_before_scores(spark, docs):
    index = S.build_index(docs, analyzer=PLAIN)
    plan = S.score_requests(index, ask(spark, ("app", ["webull"], None)), PLAIN)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("sum(weight") < plan.index("array_contains")  # the filter lies below the aggregation


def test_request_facets(spark):
    docs = spark.createDataFrame([("a", "x", ["k", "k", "l"]), ("b", "x", []), ("c", None, ["l"])], "doc_id string, sub string, tags array<string>")
    found = spark.createDataFrame([("q", "a"), ("q", "b"), ("r", "c"), ("r", "a")], "query_id string, doc_id string")
    assert rows(S.request_facets(found, docs, "sub")) == [("q", "x", 2), ("r", "x", 1)]
    assert rows(S.request_facets(found, docs, "tags")) == [("q", "k", 1), ("q", "l", 1), ("r", "k", 1), ("r", "l", 2)]


def test_histogram_maximum_falls_in_last_bin(spark):
    df = spark.createDataFrame([(float(x),) for x in (0, 5, 20)], "v double")
    assert rows(C.histogram(df, "v").select("bin", "n")) == [(0, 1), (5, 1), (19, 1)]
    assert rows(C.histogram(spark.createDataFrame([(1.0,), (1.0,)], "v double"), "v").select("bin", "n")) == [(10, 2)]


def test_single_text_keeps_every_term(spark):
    df = spark.createDataFrame([(1, "alpha beta beta")], "id int, t string")
    assert rows(M.bow(df, "t", "id").select("term", "tf")) == [("alpha", 1), ("beta", 2)]


def test_smoothed_tfidf_vectors_match_rows(spark):
    df = spark.createDataFrame([(1, "alpha beta beta"), (2, "beta gamma")], "id int, t string")
    tokens = df.withColumn("tokens", M.feature_tokens(F.col("t")))
    exact = M.term_weights(tokens, "tokens", "id").select("id", F.col("weight").alias("w"))
    by_row = M.tfidf(df, "t", "id").select("id", "weight")
    assert rows(exact.select("id", F.round("w", 9))) == rows(by_row.select("id", F.round("weight", 9)))


def test_boosters_keep_their_own_size(spark):
    lexicon = spark.createDataFrame([("good", 2.0)], "word string, valence double")
    df = spark.createDataFrame([(1, "a very good day"), (2, "a super good day"), (3, "a hardly good day")], "id int, text string")
    boosters = {"very": 0.1, "super": 0.9, "hardly": -0.4}
    for limit in (10_000, 0):
        got = {r["id"]: r["compound"] for r in N.lexicon_compound(df, "text", lexicon, "id", boosters, inline_limit=limit).collect()}
        raised = {1: 2.0 + 0.1, 2: 2.0 + 0.9, 3: 2.0 - 0.4}
        assert all(abs(got[k] - v / (v * v + 15) ** 0.5) < 1e-9 for k, v in raised.items())


def test_lexicon_forms_agree_on_repeats(spark):
    lexicon = spark.createDataFrame([("good", 1.0, 0.5), ("good", 3.0, 0.7), ("bad", -2.0, 0.9)], "word string, a double, b double")
    df = spark.createDataFrame([(1, "good day"), (1, "bad good day"), (1, "bad good day"), (None, "bad"), (2, None)], "id int, text string")
    valence = lexicon.select("word", "a")
    inline, joined = [sorted(map(str, N.lexicon_compound(df, "text", valence, "id", inline_limit=n).collect())) for n in (10_000, 0)]
    assert inline == joined
    inline, joined = [sorted(map(str, N.lexicon_polarity(df, "text", lexicon, "id", inline_limit=n).collect())) for n in (10_000, 0)]
    assert inline == joined


def test_many_boolean_clauses(spark):
    from murmura.operators.search import match_bool

    clauses = [spark.range(5 + k % 2).withColumnRenamed("id", "doc_id") for k in range(70)]
    assert sorted(r["doc_id"] for r in match_bool(must=clauses).collect()) == [0, 1, 2, 3, 4]
    assert sorted(r["doc_id"] for r in match_bool(should=clauses).collect()) == [0, 1, 2, 3, 4, 5]


def test_queries_that_share_an_id(spark):
    from murmura.operators.vectors import cosine_topk

    vectors = spark.createDataFrame([(k, [1.0, float(k)]) for k in range(6)], "id int, vector array<double>")
    queries = spark.createDataFrame([("q", [1.0, 0.0]), ("q", [0.0, 1.0]), ("q", [1.0, 1.0]), ("q", [1.0, 1.0])], "query_id string, vector array<double>")
    whole, cut = [sorted((r["id"], round(r["cosine"], 6)) for r in cosine_topk(queries, vectors, 20, block=b).collect()) for b in (2_000, 2)]
    assert whole == cut and len(whole) == 18


def test_topic_words_of_a_page(spark):
    from murmura.plans.answer import page_topic_keywords

    words = [f"keyword{chr(97 + k // 26)}{chr(97 + k % 26)}x" for k in range(40)]
    rows = [("a", k, " ".join(words)) for k in range(3)] + [("a", 3, "nothing here")] + [("b", 10 + k, "alone together " + words[k]) for k in range(4)]
    found = spark.createDataFrame(rows, "query_id string, doc_id int, text string")
    batch = {(r["query_id"], r["keyword"]) for r in page_topic_keywords(found).collect()}
    assert {w for q, w in batch if q == "a"} == set(words)
    alone = {(r["query_id"], r["keyword"]) for r in page_topic_keywords(found.filter("query_id = 'a'")).collect()}
    assert alone == {x for x in batch if x[0] == "a"}


def test_postings_of_an_index_stay_in_the_rows_of_their_documents(spark):
    texts = [("a", "cat catcat cat dog"), ("b", None), ("c", "dog  é dog"), ("d", ""), ("a", "dog bird"), (None, "dog"), (None, "dog cat")]
    df = spark.createDataFrame(texts, "id string, comment_content string")
    plain = Analyzer(stopwords=(), synonyms=(("cat", "feline"),), stem=False)
    for docs in (df, df.filter("id <> 'a'")):
        found = S.build_index(docs, analyzer=plain, attributes=(), filter_words=())
        items = plain.index_items(docs, "comment_content", "_items").select(F.col("id").alias("doc_id"), F.size("_items").alias("length"), "_items")
        wanted = S.token_postings(items.select("doc_id", "length", F.inline("_items")))
        assert sorted(map(str, found.postings.collect())) == sorted(map(str, wanted.select(found.postings.columns).collect()))
    assert "Exchange" not in found.postings._jdf.queryExecution().executedPlan().toString()


def test_grams_of_a_vocabulary_are_counted_in_the_row_of_their_token(spark):
    words = ["aaaa", "abab", "x", "", "mississippi", "zażółć"]
    grams = S.vocabulary_grams(spark.createDataFrame([(w,) for w in words], "token string"))
    wanted = Counter((w[i : i + n], w) for w in words for n in range(2, 16) for i in range(len(w) - n + 1))
    assert {(r["gram"], r["token"]): r["n"] for r in grams.collect()} == wanted
    assert "Exchange" not in grams._jdf.queryExecution().executedPlan().toString()


def test_texts_meet_a_page_without_being_shuffled(spark):
    docs = spark.range(1000).select(F.concat(F.lit("c"), "id").alias("id"), F.repeat(F.lit("w "), 50).alias("comment_content"))
    page = spark.createDataFrame([("r1", "c5", 1), ("r2", "c5", 1), ("r1", "c9", 2), ("r1", "none", 3)], "query_id string, doc_id string, rank int")
    found = A.page_documents(page, docs)
    assert sorted((r["query_id"], r["doc_id"]) for r in found.collect()) == [("r1", "c5"), ("r1", "c9"), ("r2", "c5")]
    assert "SortMergeJoin" not in found._jdf.queryExecution().executedPlan().toString()


def test_ids_of_pieces_do_not_shuffle_the_words_of_a_text_one_by_one(spark):
    words = spark.createDataFrame([("low", ["lo", "w"]), ("new", ["n", "ew"]), ("odd", ["zz"])], "word string, pieces array<string>")
    vocab = spark.createDataFrame([("lo", 0), ("w", 1), ("n", 2), ("ew", 3), (T.UNK, 9)], "token string, id bigint")
    texts = [(1, "low new low"), (2, None), (3, ""), (4, "odd  other new"), (5, "low"), (5, "new low"), (None, "new")]
    found = T.encode_bpe_ids(spark.createDataFrame(texts, "id long, t string"), "t", "id", words, vocab)
    wanted = {1: [0, 1, 2, 3, 0, 1], 2: [], 3: [9], 4: [9, 9, 9, 2, 3], 5: [0, 1, 2, 3, 0, 1], None: [2, 3]}
    assert {r["doc_id"]: r["ids"] for r in found.collect()} == wanted
    alone = T.encode_bpe_ids(spark.createDataFrame(texts[:4], "id long, t string"), "t", "id", words, vocab)
    assert "posexplode" not in alone._jdf.queryExecution().analyzed().toString()


def test_words_of_a_training_are_dealt_to_all_tasks(spark):
    _, pieces = T.train_bpe(spark.range(200).select(F.concat(F.lit("w"), "id").alias("t")), "t", 3)
    assert len(pieces.inputFiles()) > 1


@pytest.mark.parametrize("similarity", ["levenshtein", "ratio"])
def test_close_words_of_every_length_are_found_by_few_candidates(spark, similarity):
    draw = random.Random(5)
    known = ["".join(draw.choice("ab") for _ in range(n)) for n in range(1, 24) for _ in range(6)]
    changed = [w[:k] + draw.choice("abc") + w[k + draw.randint(0, 1) :] for w in known for k in [draw.randint(0, len(w) - 1)]]

    def score(a, b):
        if similarity == "ratio":
            return difflib.SequenceMatcher(None, b, a).ratio()
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row = _edit_row(row, i, x, b)
        return 1 - row[-1] / max(len(a), len(b))

    def limit(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row = _edit_row(row, i, x, b)
        size = max(len(a), len(b)) if similarity == "levenshtein" else len(a) + len(b)
        return row[-1] <= int(size * 0.2 + 1e-9)

    wanted = {}
    for a in set(changed):
        near = [(-round(score(a, b), 9), b) for b in set(known) if a != b and abs(len(a) - len(b)) <= 1 and limit(a, b) and score(a, b) >= 0.8 - 1e-9]
        if near:
            wanted[a] = min(near)[1]
    frames = [spark.createDataFrame([(w,) for w in ws], "token string") for ws in (changed, known)]
    assert {r["token"]: r["match"] for r in V.closest_word(*frames, similarity=similarity).collect()} == wanted


def _edit_row(above, i, x, b):
    row = [i]
    for j, y in enumerate(b, 1):
        row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (x != y)))
    return row


def test_terms_are_projected_in_the_row_of_their_text(spark):
    texts = [(1, [("a", 0.5), ("b", 0.25), ("ü", -1.0)]), (2, []), (3, None), (4, [("a", 1.0)] * 3)]
    df = spark.createDataFrame(texts, "id int, terms array<struct<term: string, weight: double>>")
    marked = df.select("id", F.inline("terms")).select("id", "weight", F.explode(F.array(*[F.xxhash64("term", F.lit(42), F.lit(k)) for k in range(M.MARKS_PER_TERM)])).alias("h"))
    wanted = {k: [0.0] * 16 for k, _ in texts}
    for r in sorted(marked.collect(), key=lambda r: r["weight"]):
        wanted[r["id"]][r["h"] % 16] += (-1 if r["h"] < 0 else 1) * r["weight"] / M.MARKS_PER_TERM**0.5
    found = df.select("id", M.project_terms(F.col("terms"), 16).alias("v"))
    assert {r["id"]: r["v"] for r in found.collect()} == {k: pytest.approx(v) for k, v in wanted.items()}
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    grouped = M.project(df.select("id", F.inline("terms")), 16)
    assert {r["id"]: r["projected"] for r in grouped.collect()} == {k: pytest.approx(wanted[k]) for k in (1, 4)}


def test_grams_of_a_document_meet_where_its_tokens_are(spark):
    draw = random.Random(3)
    words = ["aaa", "x", "", "żółć", "abab", "w" * 40 + "xyz" * 20] + ["".join(draw.choice("abc") for _ in range(draw.randint(1, 18))) for _ in range(20)]
    tokens = [(doc, pos, draw.choice(words)) for doc in ("a", "b", None) for pos in range(30)] + [("c", 0, None), ("d", 0, "x")]
    df = spark.createDataFrame(tokens, "doc_id string, pos int, token string")
    wanted = Counter((t[i : i + n], doc) for doc, _, t in tokens if t for n in range(2, 16) for i in range(len(t) - n + 1))
    found = S.build_postings(df)
    assert {(r["gram"], r["doc_id"]): r["tf"] for r in found.collect()} == wanted
    assert "Generate" not in found._jdf.queryExecution().executedPlan().toString()


def test_configs_of_many_runs_are_read_by_many_tasks(spark, tmp_path):
    for k in range(20):
        folder = tmp_path / "runs" / f"run {k}"
        folder.mkdir(parents=True)
        (folder / "config.json").write_text(json.dumps({"data": {"size": k}, **({"late": 1.5} if k == 19 else {})}, indent=1))
        (folder / "metrics.json").write_text(json.dumps({"train_loss": [0.5, k]}))
    tasks = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("runs", "read runs")
    found = runs.read_runs(spark, str(tmp_path / "runs"))
    stages = [s for j in tasks.getJobIdsForGroup("runs") for s in tasks.getJobInfo(j).stageIds]
    assert max(tasks.getStageInfo(s).numTasks for s in stages) > 1
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert {(r["run"], r["config.data.size"], r["config.late"]) for r in found.select("run", "`config.data.size`", "`config.late`").collect()} == {
        (f"run {k}", k, 1.5 if k == 19 else None) for k in range(20)
    }


def test_chunks_send_each_of_their_words_once(spark, monkeypatch):
    texts = [(1, ["a", "b", None, "a"]), (2, []), (3, None), (4, ["c"] * 5), (5, ["b", "a"])]
    coded, words = chunks.coded(spark.createDataFrame(texts, "id int, t array<string>").coalesce(1), ["t"], 4)
    names = {(r["_chunk"], r["_code"]): (r["token"], r["docs"]) for r in words.collect()}
    assert sorted(names.values()) == [("a", 1), ("a", 1), ("b", 1), ("b", 1), ("c", 1)]
    back = {r["id"]: r["t"] and [x if x is None else names[r["_chunk"], x][0] for x in r["t"]] for r in coded.collect()}
    assert back == dict(texts)


def test_a_training_keeps_the_words_of_its_last_pass_only(spark):
    folder = Path(session.shared_folder(spark).removeprefix("file:"))
    before = set(folder.glob("murmura-*"))
    _, pieces = T.train_bpe(spark.createDataFrame([("low lower lowest newest widest",)], "t string"), "t", 6)
    left = set(folder.glob("murmura-*")) - before
    assert len(left) == 1 and pieces.count() == 5


def test_a_row_a_place_stands_for_all_grams_of_a_token(spark, tmp_path):
    words = ["aaaa", "abab", "x", "", "mississippi", "zażółć", "a" * 20, "abcdefghijklmnopqrstuvwxyz"]
    vocabulary = spark.createDataFrame([(w,) for w in words], "token string")
    longest = S.longest_grams(vocabulary)
    wanted = Counter((w[i : i + 15], w) for w in words for i in range(len(w) - 1))
    assert {(r["gram"], r["token"]): r["n"] for r in longest.collect()} == wanted
    asked = spark.createDataFrame([(t,) for t in ("a", "aa", "ab", "ss", "issi", "a" * 15, "a" * 16, "klmnopqrstuvwxy", "zz", "żół")], "term string")
    postings = vocabulary.select("token", F.lit(1).alias("doc_id"), F.lit(1).cast("bigint").alias("tf"), F.lit(1).alias("length"))
    docs = spark.createDataFrame([(1, 1, True)], "doc_id int, length int, opinion boolean")
    plain = S.SearchIndex(postings, docs)
    stored = plain.write(str(tmp_path / "index"))
    assert stored.grams.count() == len(wanted) < S.vocabulary_grams(vocabulary).count() / 4
    assert rows(stored.holding_tokens(asked)) == rows(plain.holding_tokens(asked))
    twice = S.SearchIndex(stored.postings, stored.docs, stored.grams.unionByName(stored.grams), stored.vocabulary, segmented=True)
    assert rows(twice.holding_tokens(asked)) == rows(plain.holding_tokens(asked))


def test_assembled_blocks_are_those_of_terms_met_one_by_one(spark, monkeypatch):
    texts = [(1, "Apple pear apple fig", "s 1", ["A", "B", "A"], 1.0), (2, "pear", "s 2", None, None), (3, None, None, [], 2.0), (4, "of the", "src", ["B"], 3.0), (1, "fig plum", "src", ["C"], 4.0)]
    df = spark.createDataFrame(texts, "id int, comment_body string, subreddit string, entities array<string>, x double")
    monkeypatch.setattr(M, "coded", lambda rows, columns: chunks.coded(rows.coalesce(1), columns, 3))
    found = M.assemble(df, numeric=["x"])
    assert found.columns == [*df.columns, "features"]
    keyed = df.withColumn("key", F.concat_ws("|", "id", "comment_body")).withColumn("_text", M.feature_tokens(F.col("comment_body"))).withColumn("_community", M.feature_tokens(F.col("subreddit"), stopwords=("",)))
    block = lambda name, width: {r["id"]: r["v"] for r in M.term_lists(keyed, name, "key").select("id", M.project_terms(F.col("terms"), width).alias("v")).collect()}
    text, community = block("_text", M.TEXT_WIDTH), block("_community", M.SET_WIDTH)
    got = {f"{r['id']}|{r['comment_body']}" if r["comment_body"] else str(r["id"]): r["features"].toArray() for r in found.collect()}
    assert len(got) == 5
    for key, v in got.items():
        assert v[: M.SET_WIDTH] == pytest.approx(community.get(key, [0.0] * M.SET_WIDTH))
        assert v[M.SET_WIDTH : M.SET_WIDTH + M.TEXT_WIDTH] == pytest.approx(text.get(key, [0.0] * M.TEXT_WIDTH))
    # A chunk sends a term once, and the texts are not joined with their blocks.
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()
