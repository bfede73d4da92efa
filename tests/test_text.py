"""Literal rows for the cleaning and predicate decisions."""

import pytest
from pyspark.sql import functions as F

from murmura.functions import text as tx
from murmura.functions.stemming import stem
from murmura.operators.analysis import Analyzer


def one(spark, value, expression):
    df = spark.createDataFrame([(value,)], "c string")
    return df.select(expression(F.col("c")).alias("out")).first()["out"]


@pytest.mark.parametrize(
    ("given", "expression", "expected"),
    [
        ("a😀b漢c", tx.strip_emoji, "abc"),
        ("see http://x.y/z now www.q.com", tx.strip_urls, "see  now "),
        ("too short here", tx.min_tokens, False),
        ("now it is long enough", tx.min_tokens, True),
        ("possible", lambda c: tx.contains_any(c, ["ib"]), True),
        ("Possible", lambda c: tx.contains_any(c, ["tos", "xyz"]), False),
        ("don't stop, it's 1,000 dollars.", tx.tokenize_words, ["do", "n't", "stop", ",", "it", "'s", "1,000", "dollars", "."]),
        ("was boxes men ladies class children", lambda c: tx.lemmas(F.split(c, " ")), ["wa", "box", "man", "lady", "class", "child"]),
        (None, tx.clean_text, ""),
        ("Crème brûlée; Ω!", tx.ascii_fold, "Cremebrulee;"),
        ("  Hey, You!\n", tx.clean_line, "hey you"),
        ("aZ.!", tx.char_ids, [0, 51, 52, -1]),
        ("2024-01-15", lambda c: tx.parse_start_date(c).cast("string"), "2024-01-15 00:00:00"),
        ("soon", tx.parse_start_date, None),
        ("2nd fee the https x 12 good", lambda c: tx.meaningful_tokens(F.split(c, " ")), ["fee", "good"]),
        ("1", tx.coerce_double, 1.0),
        ("-1", tx.coerce_double, -1.0),
        ("x", tx.coerce_double, None),
        (None, tx.coerce_double, None),
        ("fees on my webull app", tx.tag_topics, ["fees"]),
    ],
)
def test_expression(spark, given, expression, expected):
    assert one(spark, given, expression) == expected


def test_opinion_bound_is_strict(spark):
    df = spark.createDataFrame([(0.25,), (-0.25,), (0.26,), (-0.3,)], "c double")
    assert [r[0] for r in df.select(tx.is_opinionated(F.col("c"))).collect()] == [False, False, True, True]


def test_compat_iso_repeats_seconds(spark):
    df = spark.sql("SELECT TIMESTAMP '2024-05-06 07:08:09' AS t")
    row = df.select(tx.to_iso_z(F.col("t")), tx.to_iso_z(F.col("t"), compat=True)).first()
    assert tuple(row) == ("2024-05-06T07:08:09Z", "2024-05-06T07:08:09.09Z")


def test_gram_bounds(spark):
    df = spark.createDataFrame([("a",), ("ab",), ("x" * 15,), ("y" * 16,), ("aaa",)], "t string")
    rows = {r["t"]: r["g"] for r in df.select("t", tx.ngrams(F.col("t")).alias("g")).collect()}
    assert rows["a"] == [] and rows["ab"] == ["ab"]
    assert "x" * 15 in rows["x" * 15] and "y" * 16 not in rows["y" * 16]
    assert rows["aaa"].count("aa") == 2


@pytest.mark.parametrize(
    ("word", "expected"),
    [
        ("consignment", "consign"), ("consistency", "consist"), ("knackeries", "knackeri"), ("generously", "generous"),
        ("happy", "happi"), ("running", "run"), ("hoping", "hope"), ("ties", "tie"), ("skies", "sky"), ("news", "news"),
        ("interface", "interfac"), ("communication", "communic"), ("hopefulness", "hope"), ("say", "say"),
    ],
)
def test_stem(word, expected):
    assert stem(word) == expected


def _tokens(spark, analyzer, value, side):
    df = spark.createDataFrame([(value,)], "t string")
    items = getattr(analyzer, side)(df, "t").first()["items"]
    return [(i["pos"], i["token"]) for i in items]


def test_synonyms_meet_the_stemmer_on_different_sides(spark):
    analyzer = Analyzer()
    indexed = _tokens(spark, analyzer, "user interface", "index_items")
    queried = _tokens(spark, analyzer, "user interface", "query_items")
    assert (0, "ui") not in indexed and (0, "ui") in queried


def test_longest_synonym_wins_and_words_keep_positions(spark):
    plain = Analyzer(stem=False)
    assert _tokens(spark, plain, "the user account", "index_items") == [(1, "user"), (2, "account"), (1, "account"), (1, "profile")]
    assert _tokens(spark, plain, "UI", "index_items") == [(0, "ui"), (0, "user"), (1, "interface")]


def test_stemmed_batches_keep_nulls_and_empties(spark):
    df = spark.createDataFrame([("running dogs",), (None,), ("",), ("the",)], "t string")
    rows = [r["items"] for r in Analyzer(synonyms=()).index_items(df, "t").collect()]
    assert [i["token"] for i in rows[0]] == ["run", "dog"]
    assert rows[1] is None and rows[2] == [] and rows[3] == []
