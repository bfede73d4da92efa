"""Corpus profile and lexicon sentiment."""

from __future__ import annotations

from pyspark.sql import functions as F

from murmura import wordlists as W
from murmura.functions import text as tx
from murmura.operators import corpus as C
from murmura.operators.sampling import page, sample_n, split_by_hash, train_val_test
from murmura.operators.sentiment import lexicon_compound, lexicon_polarity, majority_sentiment
from murmura.suite.base import BODIES, COMMENTS, LABELS, STOP, bodies, comments, manual_labels, query, small, sql_words, table
from murmura.suite.lexicon import BOOSTERS, INTENSIFIERS, NEGATIONS, polarity_table, sql_compound, sql_polarity, valence_table
from murmura.suite.text import _MEANINGFUL

_WORDS = f"w AS (SELECT unnest({sql_words('text')}) AS word FROM documents)"
_COUNTS = f"{_WORDS}, counts AS (SELECT word, count(*) AS n FROM w GROUP BY word)"


@query("a1_record_count", "SELECT count(*) AS records FROM documents")
def a1(spark, d):
    return C.record_count(bodies(spark, d))


@query("a2_value_counts", f"WITH {BODIES} SELECT subreddit, count(*) AS n FROM bodies GROUP BY subreddit")
def a2(spark, d):
    return C.value_counts(bodies(spark, d), "subreddit")


@query("a2_label_counts", f"WITH {LABELS} SELECT label, count(*) AS n FROM manual_labels GROUP BY label")
def a2_labels(spark, d):
    return C.value_counts(manual_labels(spark, d), "label")


@query("a3_word_totals", f"WITH {_COUNTS} SELECT CAST(sum(n) AS BIGINT) AS words, count(*) AS distinct_words FROM counts")
def a3(spark, d):
    return C.word_totals(bodies(spark, d))


@query("a3_word_totals_approx", "SELECT TRUE AS near")
def a3_approx(spark, d):
    """The sketch is within five percent of the exact number."""
    b = bodies(spark, d)
    exact = C.word_totals(b).select("distinct_words").scalar()
    return C.approx_distinct_words(b).select((F.abs(F.col("distinct_words") / exact - 1) <= 0.05).alias("near"))


@query("a4_meaningful_words", f"WITH {_COUNTS} SELECT word FROM counts WHERE word NOT IN {STOP}")
def a4(spark, d):
    return C.meaningful_words(bodies(spark, d), small(spark, word=W.STOPWORDS))


@query("a5_top_words", f"WITH {_COUNTS} SELECT word, n FROM counts ORDER BY n DESC, word LIMIT 20")
def a5(spark, d):
    return C.top_words(bodies(spark, d))


@query(
    "a6_top_meaningful_words",
    f"WITH m AS (SELECT unnest({_MEANINGFUL}) AS word FROM documents) SELECT word, count(*) AS n FROM m GROUP BY word ORDER BY n DESC, word LIMIT 20",
)
def a6(spark, d):
    return C.top_words(bodies(spark, d), filtered=True)


@query(
    "a7_histogram",
    """WITH b AS (SELECT min(value) AS lo, max(value) AS hi FROM events),
x AS (SELECT CAST(least(floor((value - lo) / ((hi - lo) / 20)), 19) AS INTEGER) AS bin, lo, (hi - lo) / 20 AS width FROM events, b)
SELECT bin, round(any_value(lo) + bin * any_value(width), 6) AS low, count(*) AS n FROM x GROUP BY bin""",
)
def a7(spark, d):
    return C.histogram(table(spark, d, "events"), "value").withColumn("low", F.round("low", 6))


_SIGNS = "SELECT unnest(['positive', 'negative', 'neutral']) AS sentiment"


@query(
    "a8_sign_summary",
    f"""WITH s AS (SELECT CASE WHEN value > 20 THEN 'positive' WHEN value < 20 THEN 'negative' ELSE 'neutral' END AS sentiment FROM events),
names AS ({_SIGNS})
SELECT names.sentiment, count(s.sentiment) AS n, round(count(s.sentiment) * 100.0 / (SELECT count(*) FROM events), 2) AS percent
FROM names LEFT JOIN s ON names.sentiment = s.sentiment GROUP BY names.sentiment""",
)
def a8(spark, d):
    return C.sign_summary(table(spark, d, "events").withColumn("score", F.col("value") - 20), "score")


@query(
    "a9_corpus_profile",
    f"""WITH {_COUNTS} SELECT (SELECT count(*) FROM documents) AS records, CAST(sum(n) AS BIGINT) AS words, count(*) AS distinct_words,
  count(*) FILTER (WHERE word NOT IN {STOP}) AS meaningful_distinct_words, round(sum(n) / count(*), 2) AS words_per_type FROM counts""",
)
def a9(spark, d):
    return C.corpus_profile(bodies(spark, d))


_PROFILED = {"comment_id": "string", "post_content": "string", "comment_body": "string", "comment_score": "int", "created": "double"}


@query(
    "a17_column_profile",
    f"WITH {COMMENTS} "
    + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", '{t}' AS type, count(*) AS \"rows\", count({c}) AS non_null FROM comments" for c, t in _PROFILED.items()),
)
def a17(spark, d):
    return C.column_profile(comments(spark, d).select(*_PROFILED))


# --- lexicon scores ------------------------------------------------------------------


@query("n1_compound", f"WITH {BODIES}, {sql_compound('bodies', 'comment_id', 'comment_body')} SELECT comment_id, round(compound, 6) AS compound FROM compound")
def n1(spark, d):
    scored = lexicon_compound(bodies(spark, d), "comment_body", valence_table(spark), "comment_id", BOOSTERS, NEGATIONS)
    return scored.select("comment_id", F.round("compound", 6).alias("compound"))


@query("n1_compound_joined", f"WITH {BODIES}, {sql_compound('bodies', 'comment_id', 'comment_body')} SELECT comment_id, round(compound, 6) AS compound FROM compound")
def n1_joined(spark, d):
    """The same with the lexicon as a joined table, the way a large lexicon goes."""
    scored = lexicon_compound(bodies(spark, d), "comment_body", valence_table(spark), "comment_id", BOOSTERS, NEGATIONS, inline_limit=0)
    return scored.select("comment_id", F.round("compound", 6).alias("compound"))


_POLARITY = f"""WITH {BODIES}, {sql_polarity('bodies', 'comment_id', 'comment_body')}
SELECT comment_id, round(polarity, 6) AS polarity, round(subjectivity, 6) AS subjectivity FROM polarity"""


def _polarity(spark, d, **options):
    scored = lexicon_polarity(bodies(spark, d), "comment_body", polarity_table(spark), "comment_id", INTENSIFIERS, NEGATIONS, **options)
    return scored.select("comment_id", F.round("polarity", 6).alias("polarity"), F.round("subjectivity", 6).alias("subjectivity"))


@query("n2_polarity", _POLARITY)
def n2(spark, d):
    return _polarity(spark, d)


@query("n2_polarity_joined", _POLARITY)
def n2_joined(spark, d):
    return _polarity(spark, d, inline_limit=0)


@query(
    "q16_overall_sentiment",
    """WITH s AS (SELECT event_type, value > 20 AS good FROM events)
SELECT event_type, CASE WHEN count(*) FILTER (WHERE NOT good) > count(*) FILTER (WHERE good) THEN 'negative' ELSE 'positive' END AS sentiment
FROM s GROUP BY event_type""",
)
def q16(spark, d):
    signed = table(spark, d, "events").select("event_type", F.when(F.col("value") > 20, "positive").otherwise("negative").alias("sentiment"))
    return majority_sentiment(signed, "event_type")


# --- samples, splits, pages ------------------------------------------------------------


@query("w1_top_sources", "SELECT source, count(*) AS n FROM documents GROUP BY source ORDER BY n DESC, source LIMIT 10")
def w1(spark, d):
    return C.value_counts(table(spark, d, "documents"), "source").limit(10)


@query("w9_sample_n", "SELECT event_id FROM events ORDER BY md5('8888:' || event_id) LIMIT 700")
def w9(spark, d):
    return sample_n(table(spark, d, "events").select("event_id"), 700, "event_id")


_POINT = "('0x' || substr(md5('42:' || comment_id), 1, 8))::BIGINT % 1000"


@query(
    "w10_train_test",
    f"WITH {BODIES} SELECT comment_id, CASE WHEN {_POINT} < 800 THEN 'train' ELSE 'test' END AS split FROM bodies",
)
def w10(spark, d):
    return split_by_hash(bodies(spark, d), "comment_id", {"train": 0.8, "test": 0.2}).select("comment_id", "split")


@query(
    "w10_train_val_test",
    f"WITH {BODIES} SELECT comment_id, CASE WHEN {_POINT} < 100 THEN 'test' WHEN {_POINT} < 190 THEN 'val' ELSE 'train' END AS split FROM bodies",
)
def w10_three(spark, d):
    return train_val_test(bodies(spark, d), "comment_id").select("comment_id", "split")


@query("w11_page", "SELECT event_id, value FROM events ORDER BY value DESC, event_id LIMIT 20 OFFSET 40")
def w11(spark, d):
    return page(table(spark, d, "events").select("event_id", "value"), [F.desc("value"), F.col("event_id")], 20, 40)
