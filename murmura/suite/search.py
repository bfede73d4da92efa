"""Search: analysis, postings, matching, ranking, pages, answers."""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmura.operators import requests as R
from murmura.operators import search as S
from murmura.operators.analysis import Analyzer, analyze_index, analyze_query
from murmura.operators.labels import fuse_keywords
from murmura.operators.segments import SegmentStore
from murmura.operators.vectors import semantic_keywords
from murmura.plans import answer as A
from murmura.session import materialize
from murmura.sources.files import to_search_docs
from murmura.suite.base import BODIES, COMMENTS, STOP, bodies, comments, query, scratch, small, sql_array, sql_split, sql_words, table
from murmura.suite.lexicon import INTENSIFIERS, NEGATIONS, polarity_table, sql_polarity
from murmura.suite.text import CANDIDATES

# Stand-in synonym sets over frequent words of the text.
SYNONYMS = (("idiot", "fool"), ("trash", "rubbish", "junk"), ("wald", "forest"))
PLAIN = Analyzer(synonyms=(), stem=False)
WHOLE = Analyzer(stopwords=(), synonyms=(), stem=False)
WITH_SYNONYMS = Analyzer(synonyms=SYNONYMS, stem=False)
FILTER_WORDS = ("the", "der", "les", "los")

REQUESTS = {
    "query_id": ["r1", "r2", "r3", "r4", "r5", "r6", "r7"],
    "query": ["idiot trash", "worth", "disgust", "tion", "broker", "trash", "   "],
    "subreddits": [[], [], ["src1", "src2", "src3", "src4"], ["src0", "src5"], [], None, []],
    "start_date": [None, "soon", None, "2024-01-03", None, "2024-01-02", None],
}


def requests(spark):
    columns = dict(REQUESTS)
    lists = pa.array(columns.pop("subreddits"), pa.list_(pa.string()))
    return spark.createDataFrame(pa.table({**columns, "subreddits": lists}))


_BUILT: dict[tuple[str, str, str], str] = {}


def build(spark, d, kind: str = "body") -> S.SearchIndex:
    docs = to_search_docs(comments(spark, d))
    if kind == "whole":
        return S.build_index(docs, analyzer=WHOLE, attributes=(), filter_words=())
    if kind == "post":
        return S.build_index(docs, "post_content", analyzer=PLAIN, attributes=(), filter_words=())
    return S.build_index(docs, analyzer=PLAIN, filter_words=FILTER_WORDS)


def index(spark, d, kind: str = "body") -> S.SearchIndex:
    """A stored index of the folder's comments, with its grams: built once per session, then read by every search."""
    key = (spark.sparkContext.applicationId, d, kind)
    if key not in _BUILT:
        path = scratch(spark)
        build(spark, d, kind).write(path)
        _BUILT[key] = path
    return S.SearchIndex.read(spark, _BUILT[key])


_SQL_REQUESTS = f"""requests AS (SELECT unnest({sql_array(REQUESTS['query_id'])}) AS query_id, unnest({sql_array(REQUESTS['query'])}) AS query,
  unnest([{', '.join('NULL' if s is None else sql_array(s) + '::VARCHAR[]' for s in REQUESTS['subreddits'])}]) AS subreddits,
  unnest([{', '.join('NULL' if s in (None, 'soon') else f"TIMESTAMP '{s}'" for s in REQUESTS['start_date'])}]) AS start),
terms AS (SELECT query_id, term, count(*) AS boost FROM (SELECT query_id, unnest({sql_split('lower(query)')}) AS term FROM requests)
  WHERE term NOT IN {STOP} GROUP BY ALL)"""

_TOKENS = f"""split_docs AS (SELECT 'c' || doc_id AS doc_id, {sql_split('lower(text)')} AS ts FROM documents),
all_tokens AS (SELECT doc_id, unnest(ts) AS token, generate_subscripts(ts, 1) - 1 AS pos FROM split_docs),
tokens AS (SELECT * FROM all_tokens WHERE token NOT IN {STOP})"""


def _overlaps(token: str, term: str) -> str:
    return f"len(list_filter(range(1, CAST(len({token}) - len({term}) + 2 AS BIGINT)), lambda i: substr({token}, i, len({term})) = {term}))"


_HITS = f"""{_TOKENS},
postings AS (SELECT token, doc_id, count(*) AS tf FROM tokens GROUP BY ALL),
lengths AS (SELECT doc_id, count(*) AS length FROM tokens GROUP BY doc_id),
vocabulary AS (SELECT DISTINCT token FROM tokens),
held AS (SELECT t.query_id, t.term, t.boost, v.token, {_overlaps('v.token', 't.term')} AS n
  FROM terms t JOIN vocabulary v ON contains(v.token, t.term) WHERE len(t.term) BETWEEN 2 AND 15),
hits AS (SELECT query_id, term, boost, doc_id, CAST(sum(n * tf) AS BIGINT) AS tf FROM held JOIN postings USING (token) GROUP BY ALL)"""

_SCORED = f"""{COMMENTS}, {_SQL_REQUESTS}, {_HITS},
corpus AS (SELECT (SELECT count(*) FROM documents) AS n, (SELECT count(*) FROM tokens) / (SELECT count(*) FROM documents) AS mean),
df AS (SELECT query_id, term, count(*) AS df FROM hits GROUP BY ALL),
relevance AS (SELECT query_id, doc_id, sum(boost * ln(1 + (n - df + 0.5) / (df + 0.5)) * tf / (tf + 1.2 * (0.25 + 0.75 * length / mean))) AS relevance
  FROM hits JOIN df USING (query_id, term) JOIN lengths USING (doc_id), corpus GROUP BY query_id, doc_id),
opinions AS (SELECT DISTINCT doc_id FROM tokens WHERE {' OR '.join(f"contains(token, '{w}')" for w in FILTER_WORDS)}),
scored AS (SELECT r.query_id, r.doc_id, r.relevance, c.comment_score AS score, c.subreddit, c.comment_body AS text
  FROM relevance r JOIN opinions USING (doc_id) JOIN comments c ON c.comment_id = r.doc_id JOIN requests q ON q.query_id = r.query_id
  WHERE (q.subreddits IS NULL OR len(q.subreddits) = 0 OR list_contains(q.subreddits, c.subreddit))
    AND (q.start IS NULL OR make_timestamp(CAST(c.created * 1000000 AS BIGINT)) >= q.start))"""

_RANK = "row_number() OVER (PARTITION BY query_id ORDER BY round(relevance, 9) DESC, doc_id)"
_PAGE = f"page AS (SELECT *, CAST({_RANK} AS INTEGER) AS rank, count(*) OVER (PARTITION BY query_id) AS total FROM scored QUALIFY {_RANK} <= 5)"


# --- analysis and postings ---------------------------------------------------------


_SYNONYM_ROWS = ", ".join(f"('{a}', '{b}')" for group in SYNONYMS for a in group for b in group if a != b)


@query(
    "q1_index_analysis",
    f"""WITH {_TOKENS}, synonyms(token, other) AS (VALUES {_SYNONYM_ROWS})
SELECT doc_id, CAST(pos AS INTEGER) AS pos, token FROM tokens
UNION ALL SELECT doc_id, CAST(pos AS INTEGER), other FROM tokens JOIN synonyms USING (token)""",
)
def q1(spark, d):
    return analyze_index(bodies(spark, d), "comment_body", "comment_id", WITH_SYNONYMS)


@query("q1_index_analysis_stemmed", None)
def q1_stemmed(spark, d):
    """Stems at the places of their words; the stemmer is no SQL, a test holds it against the words one by one."""
    return analyze_index(bodies(spark, d), "comment_body", "comment_id", Analyzer(synonyms=()))


@query(
    "q2_query_analysis",
    f"""WITH q AS (SELECT 'q' || conv_id || '-' || turn AS query_id, text FROM conversations WHERE trim(text) <> ''),
t AS (SELECT query_id, unnest(ts) AS token, generate_subscripts(ts, 1) - 1 AS pos FROM (SELECT query_id, {sql_split('lower(text)')} AS ts FROM q)),
kept AS (SELECT * FROM t WHERE token NOT IN {STOP}), synonyms(token, other) AS (VALUES {_SYNONYM_ROWS})
SELECT query_id, CAST(pos AS INTEGER) AS pos, token FROM kept
UNION ALL SELECT query_id, CAST(pos AS INTEGER), other FROM kept JOIN synonyms USING (token)""",
)
def q2(spark, d):
    turns = table(spark, d, "conversations")
    asked = turns.select(F.concat(F.lit("q"), F.col("conv_id"), F.lit("-"), F.col("turn")).alias("query_id"), F.col("text").alias("query"))
    return analyze_query(asked, analyzer=WITH_SYNONYMS)


@query(
    "q3_ngrams",
    f"""WITH {_TOKENS}, v AS (SELECT DISTINCT token FROM tokens), sizes AS (SELECT unnest(range(2, 16)) AS n),
g AS (SELECT n, unnest(list_transform(range(1, CAST(len(token) - n + 2 AS BIGINT)), lambda i: substr(token, i, n))) AS gram FROM v JOIN sizes ON len(token) >= n)
SELECT CAST(n AS INTEGER) AS size, count(*) AS grams, count(DISTINCT gram) AS distinct_grams FROM g GROUP BY n""",
)
def q3(spark, d):
    vocabulary = analyze_index(bodies(spark, d), "comment_body", "comment_id", PLAIN).select("token").distinct()
    grams = S.vocabulary_grams(vocabulary)
    return grams.groupBy("gram").agg(F.sum("n").alias("n")).groupBy(F.length("gram").alias("size")).agg(F.sum("n").alias("grams"), F.count("*").alias("distinct_grams"))


@query(
    "q4_match_term",
    f"WITH {_SQL_REQUESTS}, {_HITS} SELECT query_id, term, doc_id, tf FROM hits",
)
def q4(spark, d):
    found = S.match_term(index(spark, d), S.query_terms(requests(spark), PLAIN))
    return found.select("query_id", "term", "doc_id", "tf")


@query(
    "q5_postings",
    f"""WITH {_TOKENS}, postings AS (SELECT token, doc_id, count(*) AS tf FROM tokens GROUP BY ALL), sizes AS (SELECT unnest(range(2, 16)) AS n),
v AS (SELECT DISTINCT token FROM tokens),
g AS (SELECT token, gram, count(*) AS n FROM (SELECT token, unnest(list_transform(range(1, CAST(len(token) - n + 2 AS BIGINT)), lambda i: substr(token, i, n))) AS gram
  FROM v JOIN sizes ON len(token) >= n) GROUP BY ALL),
full_postings AS (SELECT gram, doc_id, sum(n * tf) AS tf FROM g JOIN postings USING (token) GROUP BY ALL)
SELECT gram, count(*) AS docs, CAST(sum(tf) AS BIGINT) AS occurrences, CAST(max(tf) AS BIGINT) AS most FROM full_postings GROUP BY gram""",
)
def q5(spark, d):
    """Postings of all grams, summed per gram."""
    postings = S.build_postings(analyze_index(bodies(spark, d), "comment_body", "comment_id", PLAIN))
    return postings.groupBy("gram").agg(F.count("*").alias("docs"), F.sum("tf").alias("occurrences"), F.max("tf").alias("most"))


def _term_docs(idx: S.SearchIndex, spark, term: str) -> DataFrame:
    return S.match_term(idx, small(spark, query_id=["t"], term=[term], boost=[1])).select("doc_id")


def _sql_term(term: str) -> str:
    return f"SELECT DISTINCT doc_id FROM tokens WHERE contains(token, '{term}')"


@query(
    "q6_match_bool",
    f"""WITH {_TOKENS}, a AS ({_sql_term('idiot')}), b AS ({_sql_term('tion')}), c AS ({_sql_term('trash')}), e AS ({_sql_term('worth')})
SELECT 'and' AS kind, doc_id FROM a JOIN b USING (doc_id) UNION ALL SELECT 'or', doc_id FROM (SELECT * FROM c UNION SELECT * FROM e)""",
)
def q6(spark, d):
    idx = index(spark, d)
    both = S.match_bool(must=[_term_docs(idx, spark, "idiot"), _term_docs(idx, spark, "tion")])
    either = S.match_bool(should=[_term_docs(idx, spark, "trash"), _term_docs(idx, spark, "worth")])
    return both.select(F.lit("and").alias("kind"), "doc_id").unionByName(either.select(F.lit("or").alias("kind"), "doc_id"))


_PHRASES = {"p1": ["of", "the"], "p2": ["en", "er", "an"]}
_PHRASE_SQL = f"""WITH {_TOKENS}, p AS (SELECT doc_id, pos, token FROM all_tokens)
SELECT 'p1' AS query_id, doc_id FROM (SELECT DISTINCT x.doc_id FROM p x JOIN p y ON x.doc_id = y.doc_id AND y.pos = x.pos + 1
  WHERE contains(x.token, 'of') AND contains(y.token, 'the'))
UNION ALL SELECT 'p2', doc_id FROM (SELECT DISTINCT x.doc_id FROM p x JOIN p y ON x.doc_id = y.doc_id AND y.pos = x.pos + 1
  JOIN p z ON z.doc_id = x.doc_id AND z.pos = x.pos + 2 WHERE contains(x.token, 'en') AND contains(y.token, 'er') AND contains(z.token, 'an'))"""


@query("q7_match_phrase", _PHRASE_SQL)
def q7(spark, d):
    """Two phrases over the texts themselves, row by row."""
    items = WHOLE.index_items(bodies(spark, d).select(F.col("comment_id").alias("doc_id"), "comment_body"), "comment_body", "_items")
    tokens = F.col("_items.token")
    hits = F.array(*[F.when(S.phrase_in_tokens(tokens, terms), F.lit(name)) for name, terms in _PHRASES.items()])
    return items.select("doc_id", F.explode(F.array_compact(hits)).alias("query_id")).select("query_id", "doc_id")


@query("q7_match_phrase_batch", _PHRASE_SQL)
def q7_batch(spark, d):
    """The same phrases as a batch of requests, answered by the positions of a stored index that keeps all words."""
    phrases = small(spark, query_id=["p1", "p1", "p2", "p2", "p2"], i=[0, 1, 0, 1, 2], term=["of", "the", "en", "er", "an"])
    return S.match_phrase(index(spark, d, "whole"), phrases)


@query(
    "q8_match_range",
    f"""WITH {COMMENTS} SELECT comment_id, 'score' AS kind FROM comments WHERE comment_score >= 30
UNION ALL SELECT comment_id, 'both' FROM comments WHERE comment_score BETWEEN 5 AND 10""",
)
def q8(spark, d):
    c = comments(spark, d)
    score = F.col("comment_score")
    high = c.filter(S.match_range(score, low=30)).select("comment_id", F.lit("score").alias("kind"))
    return high.unionByName(c.filter(S.match_range(score, 5, 10)).select("comment_id", F.lit("both").alias("kind")))


@query(
    "q9_match_keyword",
    f"""WITH {BODIES} SELECT comment_id, 'one' AS kind FROM bodies WHERE subreddit = 'src3' UNION ALL SELECT comment_id, 'all' FROM bodies
UNION ALL SELECT comment_id, 'case' FROM bodies WHERE subreddit = 'SRC3'""",
)
def q9(spark, d):
    b = bodies(spark, d)
    parts = [
        b.filter(S.match_keyword(F.col("subreddit"), value)).select("comment_id", F.lit(kind).alias("kind"))
        for kind, value in (("one", "src3"), ("all", "*"), ("case", "SRC3"))
    ]
    return reduce(DataFrame.unionByName, parts)


@query(
    "q10_other_field",
    f"""WITH {BODIES} SELECT comment_id FROM bodies WHERE contains(lower(coalesce(post_content, '')), 'thread')
  AND NOT 'thread' IN {STOP}""",
)
def q10(spark, d):
    docs = bodies(spark, d).select(F.col("comment_id").alias("id"), "post_content")
    idx = S.build_index(docs, field="post_content", analyzer=PLAIN, attributes=(), filter_words=())
    return _term_docs(idx, spark, "thread").withColumnRenamed("doc_id", "comment_id")


@query("f7_filter_words", f"WITH {_TOKENS} SELECT DISTINCT doc_id FROM tokens WHERE {' OR '.join(f"contains(token, '{w}')" for w in FILTER_WORDS)}")
def f7(spark, d):
    """Documents with a token that holds one of the opinion filter words."""
    return index(spark, d).docs.filter("opinion").select("doc_id")


# --- ranking and pages ---------------------------------------------------------------


@query(
    "q5_stored_postings",
    f"""WITH {_TOKENS}, lengths AS (SELECT doc_id, count(*) AS length FROM tokens GROUP BY doc_id)
SELECT token, count(DISTINCT doc_id) AS docs, count(*) AS occurrences, CAST(max(length) AS INTEGER) AS longest FROM tokens JOIN lengths USING (doc_id) GROUP BY token""",
)
def q5_stored(spark, d):
    """The index written and read back, summed per token."""
    stored = build(spark, d).write(scratch(spark), grams=False)
    return stored.postings.groupBy("token").agg(F.count("*").alias("docs"), F.sum("tf").alias("occurrences"), F.max("length").alias("longest"))


@query("q11_search_topk", f"WITH {_SCORED}, {_PAGE} SELECT query_id, doc_id, rank, round(relevance, 6) AS relevance FROM page")
def q11(spark, d):
    found = S.search(index(spark, d), requests(spark), analyzer=PLAIN)
    return found.select("query_id", "doc_id", "rank", F.round("relevance", 6).alias("relevance"))


_VOTES = "row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id)"


@query("q11_search_votes", f"WITH {_SCORED} SELECT query_id, doc_id, CAST({_VOTES} AS INTEGER) AS rank, score FROM scored QUALIFY {_VOTES} <= 5")
def q11_votes(spark, d):
    return S.search(index(spark, d), requests(spark), rank="votes", analyzer=PLAIN).select("query_id", "doc_id", "rank", "score")


@query(
    "q12_search_page",
    f"""WITH {_SCORED} SELECT query_id, doc_id, CAST({_RANK} AS INTEGER) AS rank, count(*) OVER (PARTITION BY query_id) AS total
FROM scored QUALIFY {_RANK} > 5 AND {_RANK} <= 15""",
)
def q12(spark, d):
    return S.search_page(index(spark, d), requests(spark), rows=10, start=5, analyzer=PLAIN).select("query_id", "doc_id", "rank", "total")


@query(
    "q13_facet_counts",
    f"WITH w AS (SELECT unnest(list_distinct({sql_words('text')})) AS value FROM documents) SELECT value, count(*) AS n FROM w GROUP BY value",
)
def q13(spark, d):
    keywords = bodies(spark, d).select(F.array_distinct(S.text.words(F.col("comment_body"))).alias("keywords"))
    return S.facet_counts(keywords, "keywords")


@query(
    "q14_query_batch",
    f"""WITH {_TOKENS}, asked AS (SELECT DISTINCT role AS query_id, role AS query FROM conversations
  UNION ALL SELECT DISTINCT event_type, event_type FROM events UNION ALL SELECT 'n' || n_nationkey, lower(n_name) FROM nation
  UNION ALL SELECT DISTINCT 'l' || lang, lang FROM documents),
terms AS (SELECT query_id, term, count(*) AS boost FROM (SELECT query_id, unnest({sql_split('lower(query)')}) AS term FROM asked) GROUP BY ALL),
postings AS (SELECT token, doc_id, count(*) AS tf FROM tokens GROUP BY ALL), vocabulary AS (SELECT DISTINCT token FROM tokens),
held AS (SELECT t.query_id, t.term, t.boost, v.token, {_overlaps('v.token', 't.term')} AS n FROM terms t JOIN vocabulary v ON contains(v.token, t.term)
  WHERE len(t.term) BETWEEN 2 AND 15 AND t.term NOT IN {STOP}),
hits AS (SELECT query_id, term, boost, doc_id, sum(n * tf) AS tf FROM held JOIN postings USING (token) GROUP BY ALL),
lengths AS (SELECT doc_id, count(*) AS length FROM tokens GROUP BY doc_id),
corpus AS (SELECT (SELECT count(*) FROM documents) AS n, (SELECT count(*) FROM tokens) / (SELECT count(*) FROM documents) AS mean),
df AS (SELECT query_id, term, count(*) AS df FROM hits GROUP BY ALL),
scored AS (SELECT query_id, doc_id, sum(boost * ln(1 + (n - df + 0.5) / (df + 0.5)) * tf / (tf + 1.2 * (0.25 + 0.75 * length / mean))) AS relevance
  FROM hits JOIN df USING (query_id, term) JOIN lengths USING (doc_id), corpus GROUP BY query_id, doc_id)
SELECT query_id, doc_id, CAST({_RANK} AS INTEGER) AS rank, count(*) OVER (PARTITION BY query_id) AS total FROM scored QUALIFY {_RANK} <= 5""",
)
def q14(spark, d):
    """Requests of one or more words taken from four tables, all against one index."""
    parts = [
        table(spark, d, "conversations").select(F.col("role").alias("query_id"), F.col("role").alias("query")).distinct(),
        table(spark, d, "events").select(F.col("event_type").alias("query_id"), F.col("event_type").alias("query")).distinct(),
        table(spark, d, "nation").select(F.concat(F.lit("n"), F.col("n_nationkey")).alias("query_id"), F.lower("n_name").alias("query")),
        table(spark, d, "documents").select(F.concat(F.lit("l"), F.col("lang")).alias("query_id"), F.col("lang").alias("query")).distinct(),
    ]
    batch = reduce(DataFrame.unionByName, parts).withColumns({"subreddits": F.lit(None).cast("array<string>"), "start_date": F.lit(None).cast("string")})
    found = S.search_page(index(spark, d), batch, analyzer=PLAIN, opinion_only=False)
    return found.select("query_id", "doc_id", "rank", "total")


# Phrase and exact field, range, exact field, an OR of two phrases, match-all with a word, words of another field.
_CLAUSES = [
    ("s1", 0, True, "phrase", "comment_content", "idiot", None, None),
    ("s2", 0, True, "phrase", "comment_content", "en er", None, None),
    ("s2", 1, True, "exact", "subreddit", "src3", None, None),
    ("s3", 0, True, "range", "score", None, "30", None),
    ("s4", 0, True, "exact", "subreddit", "src1", None, None),
    ("s5", 0, False, "phrase", "comment_content", "trash", None, None),
    ("s5", 1, False, "phrase", "comment_content", "tion en", None, None),
    ("s6", 0, True, "all", None, None, None, None),
    ("s6", 1, False, "words", "comment_content", "worth disgust", None, None),
    ("s7", 0, True, "words", "comment_content", "tion", None, None),
    ("s7", 1, True, "range", "score", None, "5", "10"),
    ("s7", 2, True, "words", "post_content", "thread", None, None),
]


def _phrase_starts(name: str, group: int, words: str) -> str:
    """Hits of one phrase over the tokens left by the stop words: its occurrences per document."""
    first, *rest = words.split()
    joins = " ".join(f"JOIN tokens t{k} ON t{k}.doc_id = t0.doc_id AND t{k}.pos = t0.pos + {k} AND contains(t{k}.token, '{w}')" for k, w in enumerate(rest, 1))
    return f"SELECT '{name}' AS query_id, {group} AS grp, '' AS term, t0.doc_id, count(*) AS tf, 1 AS boost FROM tokens t0 {joins} WHERE contains(t0.token, '{first}') GROUP BY t0.doc_id"


def _word_hits(name: str, group: int, words: str, tokens: str = "tokens") -> str:
    parts = [
        f"SELECT '{name}' AS query_id, {group} AS grp, '{w}' AS term, doc_id, sum({_overlaps('token', repr(w))}) AS tf, 1 AS boost FROM {tokens} WHERE contains(token, '{w}') GROUP BY doc_id"
        for w in words.split()
    ]
    return " UNION ALL ".join(parts)


_TEXT_HITS = " UNION ALL ".join(
    [_phrase_starts(q, g, v) for q, g, _, kind, _, v, _, _ in _CLAUSES if kind == "phrase"]
    + [_word_hits(q, g, v) for q, g, _, kind, f, v, _, _ in _CLAUSES if kind == "words" and f == "comment_content"]
)


@query(
    "q14_sanity_requests",
    f"""WITH {COMMENTS}, {_TOKENS},
post_split AS (SELECT comment_id AS doc_id, {sql_split("lower(coalesce(post_content, '[No content written by the author]'))")} AS ts FROM bodies),
post_tokens AS (SELECT * FROM (SELECT doc_id, unnest(ts) AS token FROM post_split) WHERE token NOT IN {STOP}),
sizes AS (SELECT 'body' AS f, (SELECT count(*) FROM documents) AS n, (SELECT count(*) FROM tokens) / (SELECT count(*) FROM documents) AS mean
  UNION ALL SELECT 'post', (SELECT count(*) FROM documents), (SELECT count(*) FROM post_tokens) / (SELECT count(*) FROM documents)),
body_hits AS (SELECT *, 'body' AS f FROM ({_TEXT_HITS})), post_hits AS (SELECT *, 'post' AS f FROM ({_word_hits('s7', 2, 'thread', 'post_tokens')})),
hits AS (SELECT * FROM body_hits UNION ALL SELECT * FROM post_hits),
lengths AS (SELECT 'body' AS f, doc_id, count(*) AS length FROM tokens GROUP BY doc_id UNION ALL SELECT 'post', doc_id, count(*) FROM post_tokens GROUP BY doc_id),
df AS (SELECT query_id, grp, term, f, count(*) AS df FROM hits GROUP BY ALL),
text_scores AS (SELECT query_id, grp, doc_id, sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf / (tf + 1.2 * (0.25 + 0.75 * length / mean))) AS relevance
  FROM hits JOIN df USING (query_id, grp, term, f) JOIN lengths USING (f, doc_id) JOIN sizes USING (f) GROUP BY ALL),
others AS (SELECT 's2' AS query_id, 1 AS grp, comment_id AS doc_id FROM comments WHERE subreddit = 'src3'
  UNION ALL SELECT 's3', 0, comment_id FROM comments WHERE comment_score >= 30 UNION ALL SELECT 's4', 0, comment_id FROM comments WHERE subreddit = 'src1'
  UNION ALL SELECT 's6', 0, comment_id FROM comments UNION ALL SELECT 's7', 1, comment_id FROM comments WHERE comment_score BETWEEN 5 AND 10),
held AS (SELECT query_id, grp, doc_id, relevance FROM text_scores UNION ALL SELECT query_id, grp, doc_id, 0 FROM others),
needs(query_id, needed) AS (VALUES ('s1', 1), ('s2', 2), ('s3', 1), ('s4', 1), ('s5', 0), ('s6', 1), ('s7', 3)),
must(query_id, grp) AS (VALUES ('s1', 0), ('s2', 0), ('s2', 1), ('s3', 0), ('s4', 0), ('s6', 0), ('s7', 0), ('s7', 1), ('s7', 2)),
scored AS (SELECT h.query_id, h.doc_id, sum(relevance) AS relevance FROM held h JOIN needs USING (query_id) LEFT JOIN must m ON m.query_id = h.query_id AND m.grp = h.grp
  GROUP BY h.query_id, h.doc_id, needed HAVING count(DISTINCT m.grp) = needed)
SELECT query_id, doc_id, CAST({_RANK} AS INTEGER) AS rank, count(*) OVER (PARTITION BY query_id) AS total, round(relevance, 6) AS relevance FROM scored QUALIFY {_RANK} <= 5""",
)
def q14_sanity(spark, d):
    """Requests of clauses over two text fields and the attributes."""
    body = index(spark, d)
    clauses = spark.createDataFrame(_CLAUSES, R.CLAUSES)
    found = R.clause_page({"comment_content": body, "post_content": index(spark, d, "post")}, body.docs, clauses, analyzer=PLAIN)
    return found.select("query_id", "doc_id", "rank", "total", F.round("relevance", 6).alias("relevance"))


@query(
    "q13_request_facets",
    f"WITH {_SCORED} SELECT query_id, subreddit AS value, count(*) AS n FROM scored GROUP BY ALL",
)
def q13_requests(spark, d):
    """Communities of all hits of each request, with their counts."""
    idx = index(spark, d)
    return S.request_facets(S.score_requests(idx, requests(spark), PLAIN), idx.docs, "subreddit")


@query(
    "q14_incremental_index",
    f"""WITH {_SQL_REQUESTS}, split_docs AS (SELECT 'c' || doc_id AS doc_id, {sql_split("lower(CASE WHEN lang = 'en' THEN text ELSE 'trash ' || lang END)")} AS ts FROM documents),
tokens AS (SELECT * FROM (SELECT doc_id, unnest(ts) AS token FROM split_docs) WHERE token NOT IN {STOP}),
{_HITS[len(_TOKENS) + 2 :]},
corpus AS (SELECT (SELECT count(*) FROM documents) AS n, (SELECT count(*) FROM tokens) / (SELECT count(*) FROM documents) AS mean),
df AS (SELECT query_id, term, count(*) AS df FROM hits GROUP BY ALL),
scored AS (SELECT query_id, doc_id, sum(boost * ln(1 + (n - df + 0.5) / (df + 0.5)) * tf / (tf + 1.2 * (0.25 + 0.75 * length / mean))) AS relevance
  FROM hits JOIN df USING (query_id, term) JOIN lengths USING (doc_id), corpus GROUP BY query_id, doc_id)
SELECT query_id, doc_id, CAST({_RANK} AS INTEGER) AS rank, count(*) OVER (PARTITION BY query_id) AS total, round(relevance, 6) AS relevance FROM scored QUALIFY {_RANK} <= 5""",
)
def q14_incremental(spark, d):
    """Two batches of documents, the second with newer versions of the English ones, searched over both segments."""
    docs = to_search_docs(comments(spark, d)).withColumn("datetime", F.coalesce("datetime", F.timestamp_seconds(F.lit(0))))
    english = bodies(spark, d).select(F.col("comment_id").alias("id"), "lang")
    named = docs.join(english, "id")
    older = named.withColumns({"datetime": F.expr("datetime - interval 1 day"), "comment_content": F.concat(F.lit("trash "), "lang")}).drop("lang")
    store = SegmentStore(spark, scratch(spark), analyzer=PLAIN, filter_words=FILTER_WORDS)
    store.add(older, "first")
    store.add(named.filter("lang = 'en'").drop("lang"), "second")
    unfiltered = requests(spark).withColumns({"subreddits": F.lit(None).cast("array<string>"), "start_date": F.lit(None).cast("string")})
    found = S.search_page(store.index(), unfiltered, analyzer=PLAIN, opinion_only=False)
    return found.select("query_id", "doc_id", "rank", "total", F.round("relevance", 6).alias("relevance"))


# --- answers -------------------------------------------------------------------------


_LABELLED = f"""labelled AS (SELECT page.*, CASE WHEN p.polarity < 0 THEN 'negative' ELSE 'positive' END AS sentiment
  FROM page JOIN polarity p ON p.doc_id = page.doc_id)"""


@query(
    "q15_answers",
    f"""WITH {_SCORED}, {_PAGE}, page_texts AS (SELECT DISTINCT doc_id, text FROM page), {sql_polarity('page_texts', 'doc_id', 'text')}, {_LABELLED},
asked AS (SELECT query_id FROM requests WHERE trim(query) <> '')
SELECT a.query_id, CASE WHEN count(*) FILTER (WHERE sentiment = 'negative') > count(*) FILTER (WHERE sentiment = 'positive') THEN 'negative' ELSE 'positive' END AS sentiment,
  coalesce(max(total), 0) AS record_count, count(l.doc_id) AS comments,
  coalesce(string_agg(DISTINCT subreddit, ',' ORDER BY subreddit), '') AS subreddits,
  coalesce(string_agg(sentiment, ',' ORDER BY rank), '') AS sentiments
FROM asked a LEFT JOIN labelled l USING (query_id) GROUP BY a.query_id""",
)
def q15(spark, d):
    docs = to_search_docs(comments(spark, d))
    scoring = {"intensifiers": INTENSIFIERS, "negations": NEGATIONS}
    full = A.answer(index(spark, d), docs, requests(spark), polarity_table(spark), analyzer=PLAIN, scoring=scoring)
    return full.select(
        "query_id", "sentiment", "record_count", F.size("comments").cast("bigint").alias("comments"),
        F.array_join("subreddits", ",").alias("subreddits"), F.array_join("comments.sentiment", ",").alias("sentiments"),
    )


_WORDS_OF_PAGE = f"""page_words AS (SELECT query_id, doc_id, unnest({CANDIDATES.replace('{c}', 'text')}) AS keyword FROM page),
word_counts AS (SELECT query_id, keyword, count(*) AS count, count(DISTINCT doc_id) AS df FROM page_words GROUP BY ALL)"""


@query(
    "q15_answer_keywords",
    f"""WITH {_SCORED}, {_PAGE}, {_WORDS_OF_PAGE}
SELECT query_id, keyword, count, CAST(row_number() OVER (PARTITION BY query_id ORDER BY count DESC, keyword) AS INTEGER) AS rank
FROM word_counts QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY count DESC, keyword) <= 10""",
)
def q15_keywords(spark, d):
    docs = to_search_docs(comments(spark, d))
    page = S.search_page(index(spark, d), requests(spark), analyzer=PLAIN)
    return A.answer_keywords(A.page_documents(page, docs), requests(spark), None)


# --- keywords by vectors ---------------------------------------------------------------


def token_vectors(spark, d, tokens: DataFrame) -> DataFrame:
    """``(token, vector)``: every token takes one of the given embeddings, by hash."""
    e = table(spark, d, "embeddings")
    size = e.agg(F.count("*")).scalar()
    slot = F.pmod(F.conv(F.substring(F.md5("token"), 1, 8), 16, 10).cast("bigint"), size)
    ranked = e.select("vec_id", F.col("embedding").cast("array<double>").alias("vector"))
    return tokens.select("token", slot.alias("vec_id")).join(ranked, "vec_id").select("token", "vector")


def sql_slot(token: str) -> str:
    return f"('0x' || substr(md5({token}), 1, 8))::BIGINT % (SELECT count(*) FROM embeddings)"


_ASKED = ", ".join(f"'{w}'" for w in ("good", "great", "bad", "terrible"))
_SEMANTIC = f"""{_WORDS_OF_PAGE},
asked AS (SELECT query_id, unnest(list_concat({sql_words('query')}, [{_ASKED}])) AS word FROM requests),
asked_dims AS (SELECT query_id, generate_subscripts(embedding, 1) AS dim, CAST(unnest(embedding) AS DOUBLE) AS x
  FROM asked JOIN embeddings ON vec_id = {sql_slot('word')}),
asked_vectors AS (SELECT query_id, list(x ORDER BY dim) AS q FROM (SELECT query_id, dim, avg(x) AS x FROM asked_dims GROUP BY ALL) GROUP BY query_id),
sims AS (SELECT w.query_id, w.keyword, w.count, round(list_cosine_similarity(a.q, e.embedding::DOUBLE[]), 9) AS similarity
  FROM word_counts w JOIN asked_vectors a USING (query_id) JOIN embeddings e ON e.vec_id = {sql_slot('w.keyword')}),
semantic AS (SELECT * FROM sims QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, keyword) <= 20)"""


def _page_keywords(spark, d):
    docs = to_search_docs(comments(spark, d))
    found = materialize(A.page_documents(S.search_page(index(spark, d), requests(spark), analyzer=PLAIN), docs))
    asked = A.request_words(requests(spark))
    counts = A.page_words(found).select("query_id", "keyword", "count")
    tokens = counts.select(F.col("keyword").alias("token")).union(asked.select("word")).distinct()
    return found, asked, counts, token_vectors(spark, d, tokens)


@query("m4_semantic_keywords", f"WITH {_SCORED}, {_PAGE}, {_SEMANTIC} SELECT query_id, keyword, count, round(similarity, 6) AS similarity FROM semantic")
def m4(spark, d):
    _, asked, counts, vectors = _page_keywords(spark, d)
    return semantic_keywords(asked, counts, vectors).select("query_id", "keyword", "count", F.round("similarity", 6).alias("similarity"))


_FUSED = f"""{_SEMANTIC},
topical AS (SELECT w.* FROM word_counts w JOIN (SELECT query_id, count(*) AS n FROM page GROUP BY query_id) s USING (query_id)
  WHERE s.n > 2 AND w.df >= 2 AND w.df <= 0.95 * s.n),
fused AS (SELECT coalesce(t.query_id, s.query_id) AS query_id, coalesce(t.keyword, s.keyword) AS keyword,
  CAST(CASE WHEN t.count IS NOT NULL AND s.count IS NOT NULL THEN t.count + 2 * s.count ELSE coalesce(t.count, s.count) END AS BIGINT) AS count
  FROM topical t FULL OUTER JOIN semantic s ON t.query_id = s.query_id AND t.keyword = s.keyword),
best AS (SELECT query_id, keyword, count, CAST(row_number() OVER w AS INTEGER) AS rank FROM fused
  WINDOW w AS (PARTITION BY query_id ORDER BY count DESC, keyword) QUALIFY row_number() OVER w <= 10)"""


@query("j2_fuse_keywords", f"WITH {_SCORED}, {_PAGE}, {_FUSED} SELECT query_id, keyword, count, rank FROM best")
def j2(spark, d):
    found, asked, counts, vectors = _page_keywords(spark, d)
    semantic = semantic_keywords(asked, counts, vectors).select("query_id", "keyword", "count")
    return fuse_keywords(A.page_topic_keywords(found), semantic, keys=["query_id"])


@query(
    "q15_answers_with_topics",
    f"""WITH {_SCORED}, {_PAGE}, {_FUSED}, page_texts AS (SELECT DISTINCT doc_id, text FROM page), {sql_polarity('page_texts', 'doc_id', 'text')}, {_LABELLED},
asked_ids AS (SELECT query_id FROM requests WHERE trim(query) <> ''),
lists AS (SELECT query_id, string_agg(keyword || ':' || count, ',' ORDER BY rank) AS keywords FROM best GROUP BY query_id)
SELECT a.query_id, CASE WHEN count(*) FILTER (WHERE sentiment = 'negative') > count(*) FILTER (WHERE sentiment = 'positive') THEN 'negative' ELSE 'positive' END AS sentiment,
  coalesce(max(total), 0) AS record_count, coalesce(max(keywords), '') AS keywords
FROM asked_ids a LEFT JOIN labelled l USING (query_id) LEFT JOIN lists USING (query_id) GROUP BY a.query_id""",
)
def q15_topics(spark, d):
    """The whole answer, with topic words fused with semantic ones."""
    docs = to_search_docs(comments(spark, d))
    _, _, _, vectors = _page_keywords(spark, d)
    scoring = {"intensifiers": INTENSIFIERS, "negations": NEGATIONS}
    full = A.answer(index(spark, d), docs, requests(spark), polarity_table(spark), vectors, analyzer=PLAIN, scoring=scoring)
    listed = F.array_join(F.transform("keywords", lambda k: F.concat(k["keyword"], F.lit(":"), k["count"].cast("string"))), ",")
    return full.select("query_id", "sentiment", "record_count", listed.alias("keywords"))
