"""Cleaning, typing and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from murmura import wordlists as W
from murmura.functions import text as tx
from murmura.operators.lemmas import DETACHMENTS, lemmatize
from murmura.operators.labels import drop_neutral, drop_zero_label, keep_binary, label_index
from murmura.operators.search import since
from murmura.operators.terms import holding_terms, tag_terms
from murmura.operators.tokenizers import pad_truncate
from murmura.plans.ingest import opinion_filter
from murmura.session import materialize
from murmura.suite.base import (
    BODIES, COMMENTS, LABELS, STOP, bodies, comments, manual_labels, query, small, sql_clean, sql_contains_any,
    sql_lemma, sql_lemmas, sql_list, sql_split, sql_tokens, sql_words, table,
)
from murmura.suite.lexicon import BOOSTERS, NEGATIONS, sql_compound, valence_table

# Stand-in topics whose words occur in the invented text.
TOPIC_TERMS = {"places": ["land", "wald", "ville"], "people": ["idiot", "clown"], "links": ["http", "www"]}

_MARKED = "text || ' see HTTP://x.y/z?q=1 now 😀漢 www.q.com'"


def _marked(spark, d):
    marked = F.concat(F.col("text"), F.lit(" see HTTP://x.y/z?q=1 now 😀漢 www.q.com"))
    return table(spark, d, "documents").select("doc_id", marked.alias("text"))


def _documents(spark, d):
    return table(spark, d, "documents")


@query(
    "p8_strip_emoji",
    f"""SELECT doc_id, regexp_replace({_MARKED}, '[' || chr(128512) || '-' || chr(128591) || chr(127744) || '-' || chr(128511)
  || chr(128640) || '-' || chr(129791) || chr(9986) || '-' || chr(10160) || chr(9410) || '-' || chr(127569) || ']+', '', 'g') AS text
FROM documents""",
)
def p8(spark, d):
    return _marked(spark, d).select("doc_id", tx.strip_emoji(F.col("text")).alias("text"))


@query("p9_strip_urls", f"SELECT doc_id, regexp_replace(lower({_MARKED}), 'http\\S+|www\\S+', '', 'g') AS text FROM documents")
def p9(spark, d):
    return _marked(spark, d).select("doc_id", tx.strip_urls(F.col("text")).alias("text"))


@query("p10_words", f"SELECT doc_id, array_to_string({sql_words('text')}, ' ') AS words FROM documents")
def p10(spark, d):
    return _documents(spark, d).select("doc_id", F.array_join(tx.words(F.col("text")), " ").alias("words"))


@query("p11_tokenize_words", f"SELECT doc_id, array_to_string({sql_tokens('text')}, ' ') AS tokens FROM documents")
def p11(spark, d):
    return _documents(spark, d).select("doc_id", F.array_join(tx.tokenize_words(F.col("text")), " ").alias("tokens"))


@query("p12_lemmas", f"SELECT doc_id, array_to_string({sql_lemmas(sql_words('text'))}, ' ') AS lemmas FROM documents")
def p12(spark, d):
    return _documents(spark, d).select("doc_id", F.array_join(tx.lemmas(tx.words(F.col("text"))), " ").alias("lemmas"))


_CUTS = ", ".join(f"CASE WHEN ends_with(word, '{e}') AND len(word) > {len(e)} THEN substr(word, 1, len(word) - {len(e)}) || '{t}' END" for e, t in DETACHMENTS)


@query(
    "p12_lemmas_by_table",
    f"""WITH w AS (SELECT doc_id, unnest(t) AS word, generate_subscripts(t, 1) AS pos FROM (SELECT doc_id, {sql_words('text')} AS t FROM documents)),
v AS (SELECT word, count(*) AS n FROM w GROUP BY word), c AS (SELECT word, unnest([word, {_CUTS}]) AS lemma FROM v),
best AS (SELECT word, lemma FROM c WHERE lemma IN (SELECT word FROM v WHERE n >= 3) QUALIFY row_number() OVER (PARTITION BY word ORDER BY len(lemma), lemma) = 1)
SELECT d.doc_id, coalesce(string_agg(coalesce(lemma, w.word), ' ' ORDER BY pos), '') AS lemmas
FROM documents d LEFT JOIN w ON d.doc_id = w.doc_id LEFT JOIN best ON best.word = w.word GROUP BY d.doc_id""",
)
def p12_table(spark, d):
    """Lemmas known from the texts themselves: words that occur three times or more."""
    words = materialize(_documents(spark, d).select("doc_id", tx.words(F.col("text")).alias("words")))
    known = words.select(F.explode("words").alias("lemma")).groupBy("lemma").count().filter("count >= 3").select("lemma")
    return lemmatize(words, "words", known).select("doc_id", F.array_join("words", " ").alias("lemmas"))


@query(
    "p13_drop_stopwords",
    f"SELECT doc_id, array_to_string(list_filter({sql_words('text')}, lambda w: w NOT IN {STOP}), ' ') AS words FROM documents",
)
def p13(spark, d):
    return _documents(spark, d).select("doc_id", F.array_join(tx.drop_stopwords(tx.words(F.col("text"))), " ").alias("words"))


@query("p14_clean_text", f"SELECT doc_id, {sql_clean('text')} AS cleaned FROM documents")
def p14(spark, d):
    return _documents(spark, d).select("doc_id", tx.clean_text(F.col("text")).alias("cleaned"))


@query("p15_ascii_fold", "SELECT doc_id, regexp_replace(strip_accents(text), '[^A-Za-z.,;:'']', '', 'g') AS folded FROM documents")
def p15(spark, d):
    return _documents(spark, d).select("doc_id", tx.ascii_fold(F.col("text")).alias("folded"))


_PUNCT = tx.ASCII_PUNCTUATION.replace("'", "''") + "\n"


@query(
    "p16_clean_line",
    f"SELECT doc_id, translate(regexp_replace(lower(text), '^\\s+|\\s+$', '', 'g'), '{_PUNCT}', '') AS line FROM documents",
)
def p16(spark, d):
    return _documents(spark, d).select("doc_id", tx.clean_line(F.col("text")).alias("line"))


_ALPHABET = tx.ALPHABET.replace("'", "''")


@query(
    "p17_char_ids",
    f"""SELECT doc_id, array_to_string(list_transform(list_filter(string_split(source || ':' || lang, ''), lambda c: c <> ''),
  lambda c: instr('{_ALPHABET}', c) - 1), ' ') AS ids FROM documents""",
)
def p17(spark, d):
    name = F.concat_ws(":", "source", "lang")
    return _documents(spark, d).select("doc_id", F.array_join(tx.char_ids(name).cast("array<string>"), " ").alias("ids"))


@query(
    "p17_char_one_hot",
    f"""WITH m AS (SELECT doc_id, list_transform(list_filter(string_split(source || ':' || lang, ''), lambda c: c <> ''),
  lambda c: instr('{_ALPHABET}', c)) AS places FROM documents)
SELECT doc_id, array_to_string(list_transform(places, lambda a: repeat('0', greatest(a - 1, 0)) || CASE WHEN a > 0 THEN '1' ELSE '' END
  || repeat('0', {len(tx.ALPHABET)} - a)), ' ') AS marks FROM m""",
)
def p17_one_hot(spark, d):
    marks = tx.char_one_hot(F.concat_ws(":", "source", "lang"))
    return _documents(spark, d).select("doc_id", F.array_join(F.transform(marks, lambda m: F.array_join(m.cast("array<string>"), "")), " ").alias("marks"))


@query(
    "p18_label_index",
    """WITH firsts AS (SELECT source, min(doc_id) AS f FROM documents GROUP BY source)
SELECT d.doc_id, d.source, i.index FROM documents d JOIN
  (SELECT source, CAST(row_number() OVER (ORDER BY f, source) - 1 AS INTEGER) AS index FROM firsts) i USING (source)""",
)
def p18(spark, d):
    return label_index(_documents(spark, d).select("doc_id", "source"), "source", "doc_id")


@query(
    "p19_sign_label",
    "SELECT event_id, CASE WHEN value - 20 > 0 THEN 'positive' WHEN value - 20 < 0 THEN 'negative' ELSE 'neutral' END AS sentiment FROM events",
)
def p19(spark, d):
    return table(spark, d, "events").select("event_id", tx.sign_label(F.col("value") - 20).alias("sentiment"))


@query(
    "p20_recode_labels",
    f"""WITH {LABELS} SELECT comment_id, CASE label WHEN 1 THEN 1 WHEN -1 THEN 0 END AS "binary",
  CAST(label + 1 AS INTEGER) AS class, CASE WHEN label = 1 THEN 1.0::DOUBLE WHEN label = -1 THEN -1.0::DOUBLE END AS sign FROM manual_labels""",
)
def p20(spark, d):
    label = F.col("label")
    return manual_labels(spark, d).select(
        "comment_id",
        tx.recode_label(label.cast("double"), tx.SIGN_TO_BINARY).alias("binary"),
        tx.recode_label(label, tx.SIGN_TO_CLASS).alias("class"),
        tx.recode_label(tx.sign_label(label), tx.SENTIMENT_TO_SIGN).alias("sign"),
    )


@query(
    "p21_coerce_double",
    "SELECT event_id, TRY_CAST(CASE WHEN event_id % 7 = 0 THEN 'x' || event_id ELSE CAST(user_id AS VARCHAR) END AS DOUBLE) AS number FROM events",
)
def p21(spark, d):
    dirty = F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("x"), F.col("event_id"))).otherwise(F.col("user_id").cast("string"))
    return table(spark, d, "events").select("event_id", tx.coerce_double(dirty).alias("number"))


@query(
    "p24_softmax_argmax",
    """WITH s AS (SELECT event_id, [value / 100, 0.3, user_id / 200.0] AS z FROM events),
p AS (SELECT event_id, list_transform(z, lambda x: exp(x - list_max(z))) AS e FROM s),
q AS (SELECT event_id, list_transform(e, lambda x: x / list_sum(e)) AS p FROM p)
SELECT event_id, round(list_max(p), 6) AS confidence, CAST(list_position(p, list_max(p)) - 1 AS INTEGER) AS class,
  CASE WHEN list_position(p, list_max(p)) = 1 THEN 'negative' ELSE 'positive' END AS sentiment FROM q""",
)
def p24(spark, d):
    scores = F.array(F.col("value") / 100, F.lit(0.3), F.col("user_id") / 200.0)
    p = table(spark, d, "events").select("event_id", tx.softmax(scores).alias("p"))
    best = tx.argmax(F.col("p"))
    return p.select("event_id", F.round(F.array_max("p"), 6).alias("confidence"), best.alias("class"), tx.class_label(best).alias("sentiment"))


_DATES = "CASE WHEN event_id % 5 = 0 THEN 'soon' WHEN event_id % 5 = 1 THEN NULL WHEN event_id % 5 = 2 THEN '2024-13-01' ELSE strftime(ts, '%Y-%m-%d') END"


@query(
    "p25_parse_start_date",
    f"""SELECT event_id, strftime(TRY_CAST(CASE WHEN regexp_full_match({_DATES}, '\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN {_DATES} END AS DATE),
  '%Y-%m-%d') AS start FROM events""",
)
def p25(spark, d):
    n = F.col("event_id") % 5
    raw = F.when(n == 0, "soon").when(n == 2, "2024-13-01").when(n > 2, F.date_format("ts", "yyyy-MM-dd"))
    return table(spark, d, "events").select("event_id", F.date_format(tx.parse_start_date(raw), "yyyy-MM-dd").alias("start"))


@query(
    "p26_pad_truncate",
    f"""WITH t AS (SELECT doc_id, doc_id // 32 AS batch, list_transform({sql_words('text')}, lambda w: CAST(len(w) AS INTEGER))[1:512] AS ids FROM documents),
m AS (SELECT batch, max(len(ids)) AS longest FROM t GROUP BY batch)
SELECT doc_id, batch, CAST(longest AS INTEGER) AS width, CAST(longest - len(ids) AS INTEGER) AS padding,
  CAST(coalesce(list_sum(ids), 0) AS BIGINT) AS total FROM t JOIN m USING (batch)""",
)
def p26(spark, d):
    ids = F.transform(tx.words(F.col("text")), lambda w: F.length(w))
    rows = _documents(spark, d).select("doc_id", F.floor(F.col("doc_id") / 32).alias("batch"), ids.alias("ids"))
    padded = pad_truncate(rows, pad=-1)
    padding = F.size(F.filter("ids", lambda x: x == -1))
    total = F.aggregate(F.filter("ids", lambda x: x != -1), F.lit(0).cast("bigint"), lambda a, x: a + x)
    return padded.select("doc_id", "batch", F.size("ids").alias("width"), padding.alias("padding"), total.alias("total"))


# --- predicates --------------------------------------------------------------------


@query("f1_min_tokens", f"SELECT doc_id FROM documents WHERE len({sql_split('text')}) >= 5")
def f1(spark, d):
    return _documents(spark, d).filter(tx.min_tokens(F.col("text"), 5)).select("doc_id")


@query("f2_contains_platform", f"SELECT doc_id FROM documents WHERE {sql_contains_any('text', W.PLATFORMS)}")
def f2(spark, d):
    return _documents(spark, d).filter(tx.contains_any(F.col("text"), W.PLATFORMS)).select("doc_id")


@query("f3_contains_opinion", f"SELECT doc_id FROM documents WHERE {sql_contains_any('text', W.OPINION_WORDS)}")
def f3(spark, d):
    return _documents(spark, d).filter(tx.contains_any(F.col("text"), W.OPINION_WORDS)).select("doc_id")


_TOPIC_CASES = ", ".join(f"CASE WHEN {sql_contains_any('text', terms)} THEN '{name}' END" for name, terms in {**W.TOPICS, **TOPIC_TERMS}.items())


@query("f4_tag_topics", f"SELECT doc_id, array_to_string(list_filter([{_TOPIC_CASES}], lambda t: t IS NOT NULL), ',') AS topics FROM documents")
def f4(spark, d):
    tags = tx.tag_topics(F.col("text"), {**W.TOPICS, **TOPIC_TERMS})
    return _documents(spark, d).select("doc_id", F.array_join(tags, ",").alias("topics"))


@query(
    "f4_tag_topics_by_table",
    f"SELECT doc_id, array_to_string(list_sort(list_filter([{_TOPIC_CASES}], lambda t: t IS NOT NULL)), ',') AS topics FROM documents",
)
def f4_table(spark, d):
    """The same terms as a table, of any number."""
    listed = [(term, name) for name, terms in {**W.TOPICS, **TOPIC_TERMS}.items() for term in terms]
    tagged = tag_terms(_documents(spark, d), "text", small(spark, term=[t for t, _ in listed], group=[g for _, g in listed]), "topics")
    return tagged.select("doc_id", F.array_join("topics", ",").alias("topics"))


@query(
    "f2_contains_item_words",
    f"""WITH terms AS (SELECT DISTINCT lower(w) AS term FROM (SELECT unnest({sql_words('text')}) AS w FROM benchmark) WHERE len(w) >= 9)
SELECT doc_id FROM documents WHERE EXISTS (SELECT 1 FROM terms WHERE contains(lower(documents.text), term))""",
)
def f2_table(spark, d):
    """Documents that hold a word of nine letters or more of any benchmark item."""
    word = table(spark, d, "benchmark").select(F.explode(tx.words(F.col("text"))).alias("term")).filter(F.length("term") >= 9)
    return holding_terms(_documents(spark, d), "text", word).select("doc_id")


@query(
    "f5_is_opinionated",
    "SELECT event_id FROM events WHERE (value - 20) / 40 > 0.25 OR (value - 20) / 40 < -0.25",
)
def f5(spark, d):
    return table(spark, d, "events").filter(tx.is_opinionated((F.col("value") - 20) / 40)).select("event_id")


@query(
    "f6_opinion_filter",
    f"""WITH {BODIES}, kept AS (SELECT * FROM bodies WHERE len({sql_split('comment_body')}) >= 5
  AND {sql_contains_any('comment_body', W.PLATFORMS)} AND {sql_contains_any('comment_body', W.OPINION_WORDS)}),
{sql_compound('kept', 'comment_id', 'comment_body')}
SELECT comment_id, round(compound, 6) AS sentiment FROM compound WHERE compound > 0.25 OR compound < -0.25""",
)
def f6(spark, d):
    kept = opinion_filter(bodies(spark, d), valence_table(spark), boosters=BOOSTERS, negations=NEGATIONS)
    return kept.select("comment_id", F.round("sentiment", 6).alias("sentiment"))


@query("f8_communities", f"WITH {BODIES} SELECT comment_id FROM bodies WHERE subreddit IN ('src2', 'src5')")
def f8(spark, d):
    return bodies(spark, d).filter(F.col("subreddit").isin("src2", "src5")).select("comment_id")


@query(
    "f9_since_date",
    f"""WITH {COMMENTS}, starts AS (SELECT unnest(['src1', 'src2', 'src3']) AS subreddit, unnest([TIMESTAMP '2024-01-02', NULL, NULL]) AS start)
SELECT comment_id FROM comments JOIN starts USING (subreddit)
WHERE start IS NULL OR make_timestamp(CAST(created * 1000000 AS BIGINT)) >= start""",
)
def f9(spark, d):
    starts = small(spark, subreddit=["src1", "src2", "src3"], start=["2024-01-02", None, "soon"])
    joined = comments(spark, d).join(starts, "subreddit")
    return joined.filter(since(F.timestamp_seconds("created"), F.col("start"))).select("comment_id")


_MEANINGFUL = f"list_filter({sql_words('text')}, lambda t: t NOT IN {sql_list([*W.STOPWORDS, *W.LINK_TOKENS])} AND NOT regexp_matches(t, '^\\p{{Nd}}+[a-z]*$') AND len(t) > 1)"


@query("f10_meaningful_tokens", f"SELECT doc_id, array_to_string({_MEANINGFUL}, ' ') AS words FROM documents")
def f10(spark, d):
    return _documents(spark, d).select("doc_id", F.array_join(tx.meaningful_tokens(tx.words(F.col("text"))), " ").alias("words"))


@query(
    "f11_drop_neutral",
    f"""WITH {LABELS} SELECT comment_id, label, CASE WHEN label > 0 THEN 'positive' ELSE 'negative' END AS sentiment
FROM manual_labels WHERE label <> 0""",
)
def f11(spark, d):
    signed = manual_labels(spark, d).withColumn("sentiment", tx.sign_label(F.col("label")))
    return drop_zero_label(drop_neutral(signed)).select("comment_id", "label", "sentiment")


@query("f12_keep_binary", f"WITH {LABELS} SELECT comment_id, label FROM manual_labels WHERE label IN (1, -1)")
def f12(spark, d):
    return keep_binary(manual_labels(spark, d)).select("comment_id", "label")


CANDIDATES = (
    f"list_filter(list_transform(list_filter({sql_tokens('lower({c})')}, "
    f"lambda t: regexp_full_match(t, '\\p{{L}}+') AND t NOT IN {STOP}), lambda w: {sql_lemma('w')}), lambda v: len(v) > 2)"
)


@query("f13_keyword_candidates", f"SELECT doc_id, array_to_string({CANDIDATES.replace('{c}', 'text')}, ' ') AS words FROM documents")
def f13(spark, d):
    return _documents(spark, d).select("doc_id", F.array_join(tx.keyword_candidates(F.col("text")), " ").alias("words"))
