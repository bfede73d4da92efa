"""Registry, table views and SQL fragments shared by the registered queries."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from murmura import wordlists as W
from murmura.functions.text import TREEBANK_STEPS
from murmura.session import shared_folder

Query = Callable[[SparkSession, str], DataFrame]
CATALOG: dict[str, tuple[Query, str | None]] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` is None where SQL cannot express the result."""

    def register(fn: Query) -> Query:
        def pinned(spark: SparkSession, folder: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, folder)

        CATALOG[name] = (pinned, sql)
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    return f"{shared_folder(spark).rstrip('/')}/suite-{uuid.uuid4().hex}"


# --- views of the given tables -----------------------------------------------------


def bodies(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as comments, without the columns that need the events."""
    d = table(spark, folder, "documents")
    post = (F.col("doc_id") % 50).cast("string")
    return d.select(
        F.concat(F.lit("c"), F.col("doc_id").cast("string")).alias("comment_id"),
        F.concat(F.lit("p"), post).alias("post_id"),
        F.col("source").alias("subreddit"),
        F.concat(F.lit("post "), post).alias("title"),
        F.concat(F.lit("https://forum.example/p"), post).alias("post_url"),
        F.when(F.col("doc_id") % 7 != 0, F.concat(F.lit("thread in "), F.col("lang"))).alias("post_content"),
        F.col("text").alias("comment_body"),
        "doc_id",
        "lang",
    )


def comments(spark: SparkSession, folder: str) -> DataFrame:
    """Comments with author, votes and time from the event of the same number."""
    e = table(spark, folder, "events").select(
        F.col("event_id").alias("doc_id"),
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("comment_author"),
        F.floor("value").cast("int").alias("comment_score"),
        F.col("ts").cast("timestamp").cast("double").alias("created"),
    )
    return bodies(spark, folder).join(e, "doc_id", "left")


def manual_labels(spark: SparkSession, folder: str) -> DataFrame:
    label = F.when(F.col("toxic") == 1, -1).when(F.col("quality") == 1, 1).otherwise(0)
    return table(spark, folder, "labels").select(
        F.concat(F.lit("c"), F.col("doc_id").cast("string")).alias("comment_id"), label.alias("label"), "doc_id"
    )


def small(spark: SparkSession, **columns: list) -> DataFrame:
    """A literal table, such as the requests of a batch."""
    return spark.createDataFrame(pa.table(columns))


BODIES = """bodies AS (
  SELECT 'c' || doc_id AS comment_id, 'p' || (doc_id % 50) AS post_id, source AS subreddit,
         'post ' || (doc_id % 50) AS title, 'https://forum.example/p' || (doc_id % 50) AS post_url,
         CASE WHEN doc_id % 7 <> 0 THEN 'thread in ' || lang END AS post_content,
         text AS comment_body, doc_id, lang
  FROM documents)"""
COMMENTS = (
    BODIES
    + """, comments AS (
  SELECT b.*, 'u' || e.user_id AS comment_author, CAST(floor(e.value) AS INTEGER) AS comment_score,
         CAST(epoch(e.ts) AS DOUBLE) AS created
  FROM bodies b LEFT JOIN events e ON b.doc_id = e.event_id)"""
)
LABELS = """manual_labels AS (
  SELECT 'c' || doc_id AS comment_id, CAST(CASE WHEN toxic = 1 THEN -1 WHEN quality = 1 THEN 1 ELSE 0 END AS INTEGER) AS label,
         doc_id FROM labels)"""


# --- SQL fragments -----------------------------------------------------------------


def sql_list(words: Sequence[str]) -> str:
    return "(" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + ")"


def sql_array(words: Sequence[str]) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


STOP = sql_list(W.STOPWORDS)


def sql_split(c: str) -> str:
    return f"list_filter(regexp_split_to_array({c}, '\\s+'), lambda t: t <> '')"


def sql_words(c: str) -> str:
    spaced = f"regexp_replace(lower({c}), '[^\\p{{L}}\\p{{N}}_\\s]', ' ', 'g')"
    return sql_split(spaced)


def sql_tokens(c: str) -> str:
    for pattern, replacement in TREEBANK_STEPS:
        back = replacement.replace("$", "\\").replace("'", "''")
        c = f"regexp_replace({c}, '{pattern.replace(chr(39), chr(39) * 2)}', '{back}', 'g')"
    return sql_split(c)


def sql_lemma(t: str) -> str:
    cut = lambda n, tail="": f"substr({t}, 1, len({t}) - {n}) || '{tail}'"
    ends = lambda *tails: " OR ".join(f"ends_with({t}, '{x}')" for x in tails)
    irregular = " ".join(f"WHEN {t} = '{a}' THEN '{b}'" for a, b in W.IRREGULAR_PLURALS.items())
    return (
        f"CASE {irregular} WHEN {ends('sses', 'xes', 'zzes', 'ches', 'shes')} THEN {cut(2)} "
        f"WHEN ends_with({t}, 'ies') AND len({t}) > 4 THEN {cut(3, 'y')} "
        f"WHEN {ends('ss', 'us', 'is')} OR len({t}) < 3 THEN {t} "
        f"WHEN ends_with({t}, 's') THEN {cut(1)} ELSE {t} END"
    )


def sql_lemmas(tokens: str) -> str:
    return f"list_transform({tokens}, lambda t: {sql_lemma('t')})"


def sql_clean(c: str) -> str:
    linkless = f"regexp_replace(lower({c}), 'http\\S+|www\\S+', '', 'g')"
    return f"coalesce(array_to_string(list_filter({sql_lemmas(sql_tokens(linkless))}, lambda w: w NOT IN {STOP}), ' '), '')"


def sql_contains_any(c: str, terms: Sequence[str]) -> str:
    return "(" + " OR ".join("contains(lower({}), '{}')".format(c, t.lower().replace("'", "''")) for t in terms) + ")"
